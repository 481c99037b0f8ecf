"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last bytes ends a piece wherever its lowest bits are all ones; each piece
gives one letter, and rows of one letter are cut to three, for they say little. The block size,
a power of two, is the least whose signature has at most MAX_LETTERS letters, so the fingerprint
covers the whole text. It holds the letters at this block size and at twice it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize
from .shingles import _power_tables, mix

#: Bytes of the rolling window, and letters that a signature may have.
WINDOW, MAX_LETTERS = 7, 64
#: Letters that two signatures must share in a row to be compared, where they are that long.
SHARED = 7
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_LETTERS = np.frombuffer(LETTERS.encode(), np.uint8)
_SCALE = (mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
#: Bytes of text worked on at once, so that a batch of long texts stays bounded.
GROUP_CHARS = 2_000_000


def _levels(data: np.ndarray) -> np.ndarray:
    """How many of the rolling hash's lowest bits are ones, at each byte."""
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32) + np.uint32(1)])
    n = len(data)
    h = sum((padded[k:k + n] * _SCALE[k] for k in range(WINDOW)), np.zeros(n, np.uint32))
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = ((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)) >> np.uint32(3)
    zeros = ~h
    return np.bitwise_count((zeros & (~zeros + np.uint32(1))) - np.uint32(1))


def _squeezed(letters: str) -> str:
    """Rows of one letter cut to three."""
    return "".join([c for i, c in enumerate(letters) if i < 3 or not letters[i - 3] == letters[i - 2] == letters[i - 1] == c])


def fingerprint(text: bytes) -> str:
    """``block:letters:letters at twice the block`` of a whole text; an empty text has no letters."""
    n = len(text)
    if not n:
        return "1::"
    data = np.frombuffer(text, np.uint8)
    level = _levels(data)
    at_least = np.cumsum(np.bincount(level, minlength=34)[::-1])[::-1]
    k = int(np.argmax(at_least < MAX_LETTERS))
    up, down = _power_tables(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)])

    def letters(least: int) -> str:
        ends = np.flatnonzero(level >= least) + 1
        if not len(ends) or ends[-1] < n:
            ends = np.append(ends, n)
        starts = np.concatenate([[0], ends[:-1]])
        return _squeezed(_LETTERS[(mix((total[ends] - total[starts]) * down[starts]) >> np.uint64(58)).astype(np.int64)].tobytes().decode())

    signs = [letters(k), letters(k + 1)]
    # Repeated pieces are cut, so a smaller block may do.
    while k and at_least[k - 1] < n // 2 and len(finer := letters(k - 1)) <= MAX_LETTERS:
        k, signs = k - 1, [finer, signs[0]]
    return f"{1 << k}:{signs[0]}:{signs[1]}"


def _closeness(a: str, b: str) -> float:
    """1 - edit distance / letters of both, a change costing a drop and an addition; 0 without a shared stretch."""
    if not a or not b:
        return 0.0
    g = min(SHARED, (min(len(a), len(b)) + 1) // 2)
    grams = {a[i:i + g] for i in range(len(a) - g + 1)}
    if not any(b[i:i + g] in grams for i in range(len(b) - g + 1)):
        return 0.0
    # Row of the distance table as the bits of one number: zeros mark letters in common.
    full = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    common = len(a) - row.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1; 1 for equal ones, 0 where no block size is common."""
    if a == b:
        return 1.0
    block_a, *signs_a = a.split(":")
    block_b, *signs_b = b.split(":")
    one = {int(block_a) << i: s for i, s in enumerate(signs_a)}
    two = {int(block_b) << i: s for i, s in enumerate(signs_b)}
    return max((_closeness(one[k], two[k]) for k in one.keys() & two.keys()), default=0.0)


def with_fingerprint(docs: DataFrame, text_col: str = "text", to_col: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of the whole text; null counts as empty."""
    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint((t or "").encode("utf-8", "replace")))

    return docs.withColumn(to_col, prints(F.col(text_col)))


def with_likeness(pairs: DataFrame, a_col: str, b_col: str, to_col: str = "likeness") -> DataFrame:
    """Adds the likeness of two fingerprint columns; null where one is null."""
    @F.pandas_udf("double")
    def like(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness(x, y) for x, y in zip(a, b)], dtype="float64")

    return pairs.withColumn(to_col, like(F.col(a_col), F.col(b_col)))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first as many characters of the following one."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _compare(ids: list, texts: list[str], prints: list[str]) -> dict[str, list]:
    """Results of all rows but the last, each compared with the row after it."""
    new = [edited(a, b) for a, b in zip(texts, texts[1:])]
    new_prints = [fingerprint(t.encode("utf-8", "replace")) for t in new]
    return {
        "doc_id": ids[:-1], "n_chars": [len(t) for t in texts[:-1]], "edited": new, "fingerprint": prints[:-1], "edited_fingerprint": new_prints,
        "near_edited": [likeness(a, b) for a, b in zip(prints, new_prints)], "near_next": [likeness(a, b) for a, b in zip(prints, prints[1:])]}


def _groups(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= GROUP_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string()), ("doc_id", id_type), ("n_chars", pa.int64()), ("edited", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _batch(rows: dict[str, list], schema: pa.Schema, part: int | None = None) -> pa.RecordBatch:
    n = len(rows["doc_id"])
    full = {f.name: rows.get(f.name, [None] * n) for f in schema} | {"part": [part] * n}
    return pa.RecordBatch.from_pydict(full, schema)


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a range's rows but its last one, and its first and last rows themselves."""
    last, part, schema = None, None, None
    for b in batches:
        schema = schema or _arrow(b.schema.field("doc_id").type)
        ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
        for group in _groups(texts):
            some_ids, some = ids[group], texts[group]
            prints = [fingerprint(t.encode("utf-8", "replace")) for t in some]
            if last is None:
                part = b.column("part")[0].as_py()
                yield _batch({"edge": ["first"], "doc_id": some_ids[:1], "text": some[:1]}, schema, part)
                out = _compare(some_ids, some, prints)
            else:
                out = _compare([last[0], *some_ids], [last[1], *some], [last[2], *prints])
            last = some_ids[-1], some[-1], prints[-1]
            yield _batch(out, schema, part)
    if last is not None:
        yield _batch({"edge": ["last"], "doc_id": [last[0]], "text": [last[1]]}, schema, part)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows that stand beside the text of their next row."""
    for b in batches:
        schema = _arrow(b.schema.field("doc_id").type)
        for i, *texts in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
            prints = [fingerprint(t.encode("utf-8", "replace")) for t in texts]
            yield _batch(_compare([i, None], texts, prints), schema)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text has its last third replaced by the first characters of the next row's. The
    next row is that of the next lower id, the first one after the last; rows of one id go by
    their text, and null ids come last. Null texts are empty; an empty text is edited to
    itself. A single row is its own next one, and an empty table gives no rows. Other columns
    are not read.

    Rows are dealt by ranges of the order. A range reads its rows in order and keeps one row;
    the last row of each range is compared with the first of the next range in a second, small
    step, so no task sees more than a range.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    place = [F.col("doc_id").desc_nulls_last(), F.col("__h")]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("__h", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *place).sortWithinPartitions(*place, "text").select("doc_id", "text", F.spark_partition_id().alias("part"))

    schema = (f"part int, edge string, text string, doc_id {id_type}, n_chars long, edited string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    digested = lambda df: df.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    staged = materialize(digested(dealt.mapInArrow(_work, schema)), "fingerprints")

    firsts = staged.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    # One number for each range that holds rows, in order.
    order = firsts.select(
        F.col("next_part").alias("part"), F.lead("next_part").over(Window.orderBy("next_part")).alias("after"), F.min("next_part").over(Window.partitionBy()).alias("head"))
    follows = order.select("part", F.coalesce("after", "head").alias("next_part"))
    edges = staged.where("edge = 'last'").select("part", "doc_id", "text").join(follows, "part").join(firsts, "next_part").select("doc_id", "text", "following")
    return staged.where("edge IS NULL").unionByName(digested(edges.mapInArrow(_meet, schema))).drop("part", "edge", "text")
