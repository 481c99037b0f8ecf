"""BPE encoding and decoding by speculation and verification.

A word is first cut by greedy longest match over the vocabulary. The cut equals the exact
merge result if every pair of neighbouring tokens is compatible, that is, if merging the
two tokens' own text gives back these two tokens. All neighbouring pairs of a batch of new
words are tested at once against a table of known pairs; only words with an incompatible
pair are merged exactly. Words are cut together, each array step reading one letter of every
word; texts of new pairs and failing words are merged together, each step doing one merge in
every text that has one left.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for the end-of-word suffix, so that it is one character.
END = ""
#: Code points that newer Unicode tables than the library's call letters or
#: numbers; the library counts them among the other characters.
OTHERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED),
    (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
#: Lower-case letters that the library knows and Python's tables do not yet.
LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
#: Words whose ids a worker keeps from one group to the next, their characters, and known pairs of
#: tokens. From there a table starts anew, and words of the table before it move over when met again.
MAX_CACHED_WORDS, MAX_CACHED_CHARS, MAX_CACHED_FITS = 100_000, 10_000_000, 200_000
#: The same words, and bytes of a group, where a worker shares its memory with those of other stages.
LEAN_WORDS, LEAN_BYTES = 10_000, 200_000
#: Symbols from which a word is cut alone and merged by a heap, and shorter texts merged together.
LONG_WORD, MERGED_TEXTS = 64, 4_096
#: Code points of byte letters are below; in the tree of tokens it stands for the end mark.
MARK = 512
#: Stands for the rank of a pair that does not merge.
NO_RANK = 1 << 30
#: Fixed value: code points below it, none of them in the tables above, take the shorter patterns.
LOW = 0x558
#: Texts are turned into Python's strings and handed back in groups of about so many bytes.
GROUP_BYTES = 1_000_000


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else the next from U+0100. Fixed values of byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def low_pattern(split: str, end: int) -> re.Pattern:
    """The splitting pattern for lower-cased texts of code points below ``end``, its classes listed."""
    chars = "".join(sorted({x for c in range(end) for x in chr(c).lower()}))
    kind = {k: re.escape("".join(regex.findall(k, chars))) for k in (r"\p{L}", r"\p{N}", r"\s")}
    for k, listed in kind.items():
        split = split.replace(k, listed)
    return re.compile(split)


class WordBpe:
    """A word-level BPE model read from a public tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        mark = lambda t: t[: -len(suffix)] + END if t.endswith(suffix) else t
        self.ids = {mark(t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(mark(a), mark(b)): r for r, (a, b) in enumerate(merges)}
        self.texts = {i: t for t, i in self.ids.items()}
        # Merges by the ids of their pair, in order, with a last one that no pair has.
        found = sorted((self.ids[a] * len(self.names) + self.ids[b], r, self.ids[a + b]) for (a, b), r in self.rank.items())
        self.pair_keys, self.pair_ranks, self.pair_ids = np.array([*found, (1 << 62, NO_RANK, 0)], np.int64).T.copy()
        self.longest = max(map(len, self.ids))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        spans = lambda rs: "".join(f"{chr(a)}-{chr(b)}" for a, b in rs)
        self.rare = regex.compile(f"[{spans(OTHERS)}{spans((c, c) for c in LOWER)}]")
        kind = {k: rf"[\p{{{k}}}--[{spans(OTHERS)}]]" for k in "LN"}
        self.rare_pattern = regex.compile("(?V1)" + split.replace(r"[\p{L}]", kind["L"]).replace(r"[^\s\p{L}\p{N}]", rf"[^\s{kind['L']}{kind['N']}]").replace(r"[\p{N}]", kind["N"]))
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = byte_letters()
        self.edges, self.edge_tokens = self.token_tree()
        # Ids of single letters by code point: inside a word, and with the end mark.
        self.inner, self.final = np.zeros((2, ord(END) + 1), np.int64)
        for c in self.letters:
            self.inner[ord(c)], self.final[ord(c)] = self.ids[c], self.ids[c + END]
        self.high = re.compile(f"[{chr(LOW)}-\U0010ffff]")
        self.ascii_pattern = low_pattern(split, 128)
        self.low_pattern = low_pattern(split, LOW)
        self.fits: dict[int, bool] = {}
        self.word_ids: dict[str, bytes] = {}
        self.word_text: dict[str, str] = {}
        self.old_ids: dict[str, bytes] = {}
        self.old_text: dict[str, str] = {}
        self.cached_chars = 0
        self.max_words = MAX_CACHED_WORDS

    def token_tree(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (node, letter) of all beginnings of tokens, and the token that ends there or -1. Edge i leads to node i + 1, the root is 0."""
        names = [*self.ids]
        width = np.fromiter(map(len, names), np.int64, len(names))
        letters = np.full((len(names), self.longest), -1, np.int16)
        flat = np.frombuffer("".join(names).encode("utf-32-le"), "<u4")
        letters[np.arange(self.longest) < width[:, None]] = np.where(flat == ord(END), MARK, flat)
        tokens = np.fromiter(self.ids.values(), np.int64, len(names))
        node, keys, ends, size = np.zeros(len(names), np.int64), [], [], 0
        for depth in range(self.longest):
            more = width > depth
            letters, tokens, width, node = letters[more], tokens[more], width[more], node[more]
            found, place = np.unique(node * (MARK + 1) + letters[:, depth], return_inverse=True)
            end = np.full(len(found), -1)
            last = width == depth + 1
            end[place[last]] = tokens[last]
            keys.append(found)
            ends.append(end)
            node, size = size + place + 1, size + len(found)
        # The last key is that of no edge.
        return np.append(np.concatenate(keys), 1 << 62), np.append(np.concatenate(ends), -1)

    # -- one word ---------------------------------------------------------------
    def symbols(self, text: str) -> list[str]:
        """Characters, the last one joined with the end mark."""
        return [*text[:-2], text[-2:]] if text.endswith(END) else list(text)

    def merge(self, symbols: list[str]) -> list[int]:
        """Exact merging: the pair of lowest rank first, leftmost on ties."""
        if len(symbols) >= LONG_WORD:
            return self.merge_long(symbols)
        none, rank = 1 << 60, self.rank.get
        ranks = [rank(p, none) for p in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
        return [self.ids[s] for s in symbols]

    def merge_long(self, symbols: list[str]) -> list[int]:
        """The same with a heap of pairs over linked symbols: n log n in the word's length."""
        rank, n = self.rank.get, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, p in enumerate(zip(symbols, symbols[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # An entry is out of date if its first symbol is gone or the pair there has another rank.
            if not symbols[i] or j >= n or rank((symbols[i], symbols[j])) != r:
                continue
            symbols[i], symbols[j] = symbols[i] + symbols[j], ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := rank((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := rank((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (new, h))
        return [self.ids[s] for s in symbols if s]

    def merge_many(self, texts: list[str]) -> list[list[int]]:
        """``merge`` of each text. Short ones lie in rows; each step merges the best pair of every row and takes finished rows out."""
        out: list[list[int]] = [[]] * len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(lengths, kind="stable")
        short = int(np.searchsorted(lengths[order], LONG_WORD))
        for i in order[short:]:
            out[i] = self.merge(self.symbols(texts[i]))
        for k in range(0, short, MERGED_TEXTS):
            place = order[k:min(k + MERGED_TEXTS, short)]
            self.merge_rows([texts[i] for i in place], lengths[place], place, out)
        return out

    def merge_rows(self, texts: list[str], lengths: np.ndarray, place: np.ndarray, out: list[list[int]]) -> None:
        """Puts the ids of each text at its place of ``out``."""
        flat = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        inside = flat != ord(END)
        ended = ~np.append(inside[1:], True)
        ids = np.where(ended, self.final[flat], self.inner[flat])[inside]
        owner = np.repeat(np.arange(len(texts)), lengths)[inside]
        sizes = np.bincount(owner, minlength=len(texts))
        rows = np.full((len(texts), sizes.max()), -1)
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = ids
        # The rank of each symbol with the next; the last column has none.
        ranks = np.full(rows.shape, NO_RANK)
        ranks[:, :-1], _ = self.look_up(rows[:, :-1], rows[:, 1:])
        while len(rows):
            best = ranks.argmin(1)
            going = ranks[np.arange(len(rows)), best] < NO_RANK
            for i, row, n in zip(place[~going].tolist(), rows[~going].tolist(), sizes[~going].tolist()):
                out[i] = row[:n]
            rows, ranks, best, place, sizes = (x[going] for x in (rows, ranks, best, place, sizes))
            at, sizes = np.arange(len(rows)), sizes - 1
            _, new = self.look_up(rows[at, best], rows[at, best + 1])
            # One symbol and one rank less in every row; the ranks beside the new symbol change.
            left = np.arange(rows.shape[1] - 1) < best[:, None]
            rows = np.where(left, rows[:, :-1], rows[:, 1:])
            ranks = np.where(left, ranks[:, :-1], ranks[:, 1:])
            rows[at, best] = new
            a, b = at[best > 0], best[best > 0]
            ranks[a, b - 1], _ = self.look_up(rows[a, b - 1], rows[a, b])
            a, b = at[best < rows.shape[1] - 1], best[best < rows.shape[1] - 1]
            ranks[a, b], _ = self.look_up(rows[a, b], rows[a, b + 1])

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, or NO_RANK, and the id it merges into; -1 stands for no symbol."""
        key = a * len(self.names) + b
        i = np.searchsorted(self.pair_keys, key)
        hit = (self.pair_keys[i] == key) & (b >= 0)
        return np.where(hit, self.pair_ranks[i], NO_RANK), self.pair_ids[i]

    def propose(self, text: str) -> list[int]:
        """Greedy longest match; the end mark never stands alone."""
        out, i, n, ids = [], 0, len(text), self.ids
        last = n - 1 if text.endswith(END) else -1
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                if j != last and (k := ids.get(text[i:j])) is not None:
                    out.append(k)
                    i = j
                    break
            else:
                raise ValueError(f"no token for {text[i]!r}")
        return out

    # -- many words -------------------------------------------------------------
    def propose_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``propose`` of each word: all tokens in order, and the word of each. Words walk the tree together, each step by one letter."""
        long = [(i, self.propose(w)) for i, w in enumerate(words) if len(w) >= LONG_WORD]
        owners = [np.repeat(np.array([i for i, _ in long], np.int64), [len(p) for _, p in long])]
        tokens = [np.array([k for _, p in long for k in p], np.int64)]
        word = np.array([i for i, w in enumerate(words) if len(w) < LONG_WORD], np.int64)
        letters = np.frombuffer("".join([w for w in words if len(w) < LONG_WORD]).encode("utf-32-le"), "<u4").astype(np.int64)
        letters[letters == ord(END)] = MARK
        end = np.flatnonzero(letters == MARK) + 1
        at = np.append(0, end[:-1]) if len(end) else end
        node, token, token_end = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), at
        while len(word):
            key = node * (MARK + 1) + letters[at]
            edge = np.searchsorted(self.edges, key)
            hit = self.edges[edge] == key
            at, node = at + 1, edge + 1
            ends = self.edge_tokens[edge]
            # The end mark never stands alone.
            longer = hit & (ends >= 0) & (at != end - 1)
            token, token_end = np.where(longer, ends, token), np.where(longer, at, token_end)
            stop = np.flatnonzero(~hit | (at == end))
            if len(stop):
                owners.append(word[stop])
                tokens.append(token[stop])
                at[stop], node[stop] = token_end[stop], 0
                if len(done := stop[token_end[stop] == end[stop]]):
                    stay = np.ones(len(word), bool)
                    stay[done] = False
                    word, at, end, node, token, token_end = (x[stay] for x in (word, at, end, node, token, token_end))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of byte-letter words that end with END."""
        flat, owner = self.propose_many(words)
        lengths = np.bincount(owner, minlength=len(words))
        ends, ids = lengths.cumsum().tolist(), flat.tolist()
        proposed = [ids[a:b] for a, b in zip([0, *ends], ends)]
        inside = owner[1:] == owner[:-1]
        pairs = (flat[:-1] << 32 | flat[1:])[inside]
        distinct, place = np.unique(pairs, return_inverse=True)
        fits = np.array(self.compatible(distinct.tolist()), bool)
        failing = np.unique(owner[1:][inside][~fits[place]]).tolist() if len(pairs) else []
        for i, ids in zip(failing, self.merge_many([words[i] for i in failing])):
            proposed[i] = ids
        # A token that merging itself never makes cannot stand in a proposal of one token.
        for i in np.flatnonzero(lengths == 1):
            if not self.reachable(proposed[i][0]):
                proposed[i] = self.merge(self.symbols(words[i]))
        return proposed

    def reachable(self, token: int) -> bool:
        key = -1 - token
        if key not in self.fits:
            self.fits[key] = self.merge(self.symbols(self.texts[token])) == [token]
        return self.fits[key]

    def compatible(self, pairs: list[int]) -> list[bool]:
        """Whether merging the text of both tokens gives exactly them, for each pair."""
        new = [(p, p >> 32, p & 0xFFFFFFFF) for p in pairs if p not in self.fits]
        for (p, a, b), ids in zip(new, self.merge_many([self.texts[a] + self.texts[b] for _, a, b in new])):
            self.fits[p] = ids == [a, b]
        return [self.fits[p] for p in pairs]

    def learn(self, words: set[str]) -> None:
        """Have words in the tables of ids bytes and decoded text."""
        if len(self.word_ids) > self.max_words or self.cached_chars > MAX_CACHED_CHARS:
            self.old_ids, self.old_text = self.word_ids, self.word_text
            self.word_ids, self.word_text, self.cached_chars = {}, {}, 0
        if len(self.fits) > MAX_CACHED_FITS:
            self.fits.clear()
        missing, new = words.difference(self.word_ids), []
        self.cached_chars += sum(map(len, missing))
        for w in missing:
            if (known := self.old_ids.get(w)) is None:
                new.append(w)
            else:
                self.word_ids[w], self.word_text[w] = known, self.old_text[w]
        letters, names = self.letters, self.names
        # Printable ASCII letters are their own byte letters.
        coded = [(w if w.isascii() and w.isprintable() else "".join([letters[b] for b in w.encode("utf-8", "replace")])) + END for w in new]
        for w, ids in zip(new, self.encode_words(coded)):
            self.word_ids[w] = struct.pack(f"<{len(ids)}I", *ids)
            self.word_text[w] = " ".join([names[i] for i in ids])

    def split(self, text: str) -> list[list[str] | str]:
        """Special strings as they are; between them lists of normalised words."""
        out: list[list[str] | str] = []
        for part in self.at_special.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                # White space of any kind only parts words, so it needs no replacing here.
                part = unicodedata.normalize("NFC", part)
                plain = part.isascii()
                high = not plain and self.high.search(part)
                rare = high and self.rare.search(part)
                part = (part.translate(LOWER) if rare else part).replace("Σ", "σ").lower()
                pattern = self.ascii_pattern if plain else self.rare_pattern if rare else self.pattern if high else self.low_pattern
                out.append(pattern.findall(part))
        return out

    def encode_texts(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each whole text."""
        parts = [self.split(t or "") for t in texts]
        self.learn(set().union(*(x for p in parts for x in p if not isinstance(x, str))))
        ids, text = self.word_ids.__getitem__, self.word_text.__getitem__
        out = []
        for p in parts:
            a, b = [], []
            for x in p:
                if isinstance(x, str):
                    a.append(struct.pack("<I", self.special[x]))
                    b.append(x)
                elif x:
                    a.append(b"".join(map(ids, x)))
                    b.append(" ".join(map(text, x)))
            out.append((b"".join(a), " ".join(b)))
        return out

    def decode(self, ids: bytes) -> str:
        """Token strings joined by blanks, special ones included."""
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The model of a file, once per worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _groups(batch: pa.RecordBatch, most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
        size += n
        if size >= most:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, lean: bool) -> Iterator[pa.RecordBatch]:
    model = load(path)
    model.max_words = LEAN_WORDS if lean else MAX_CACHED_WORDS
    for b in batches:
        for part in _groups(b, LEAN_BYTES if lean else GROUP_BYTES):
            found = model.encode_texts(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.string())], ["doc_id", "ids", "decoded"])
    if lean:
        del model
        _loaded.clear()
    pa.default_memory_pool().release_unused()  # an idle worker keeps no batches


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lean: bool = False) -> DataFrame:
    """(doc_id, ids, decoded) per row: ids as little-endian unsigned 32-bit integers.

    Every code point alone is split and lower-cased as in the library (tested); tables that
    differ between Unicode versions are stated above.
    Null and empty texts have no ids and decode to the empty string; repeated rows get
    equal results. Whole texts are encoded; only tokens of words are kept between batches.
    ``lean`` keeps fewer words and gives the model back after each task, for workers that idle
    beside those of other stages; it costs CPU time and changes no result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _encoded(batches, path, lean), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def decode(coded: DataFrame, path: str, ids_col: str = "ids", to_col: str = "decoded") -> DataFrame:
    """Adds the decoded text of the id bytes; null ids give null."""
    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        model = load(path)
        return ids.map(lambda x: None if x is None else model.decode(bytes(x)))

    return coded.withColumn(to_col, text(F.col(ids_col)))
