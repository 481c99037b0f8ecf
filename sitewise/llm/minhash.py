"""Near-duplicate documents by weighted MinHash over TF-IDF shingles.

1. Equal texts become one node. Each task sends a text once, however often it holds it.
2. Nodes are dealt into batches. A batch sends each of its distinct shingles once, with the
   number of its texts that hold it, to the shingle's bucket; the bucket adds up document
   frequencies and answers only for shingles in two or more texts. A shingle of a third of
   all texts thus costs one entry a batch.
3. A text whose shared shingles carry less than the link similarity of its own weight can
   link with nothing and stops here; this is exact. The others get improved consistent
   weighted samples (Ioffe 2010) and band keys.
4. Each band bucket has a leader, the member whose shingles are the most frequent. Members
   are verified against it by weighted Jaccard similarity. Members that end in another
   component than their leader are compared with the whole bucket in blocks, by matrix
   products that bound the similarity and exact checks where the bound allows a link.
5. Connected components of the verified links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import arrow_rows, materialize
from .components import connected_components
from .shingles import doc_shingles, mix

#: Words of a shingle, least similarity of a link, bands and samples in a band.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 10, 3
#: Members of a block in the exact rest of a bucket, and shingles of a matrix there.
BLOCK, COLUMNS = 128, 8_192
#: Texts or pairs of texts of an Arrow batch, and pairs of blocks.
BATCH_ROWS, BATCH_BLOCKS = 500, 8
#: A shingle's weight is count * idf; idf falls from 1 + IDF_SPAN, in one text, to 1, in all.
IDF_SPAN = 0.2
#: Texts of a batch and shingles of a bucket, about; shingles that are sampled at once.
BATCH_TEXTS, BUCKET_SHINGLES, SAMPLED = 1_000, 500_000, 100_000
#: Steps of the logarithm of a document frequency in its one-byte code.
LEVELS_PER_E = 8
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Told to the second hash of a text; hashes that different texts may share before it is an error.
MARK, MAX_CLASHES = "second", 1_000


def _key(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket number in the upper half, the hash's lower 32 bits in the lower half."""
    low = np.uint64(0xFFFFFFFF)
    return ((((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)) << np.uint64(32)) | (h & low)


def _texts(docs: DataFrame, batches: int) -> DataFrame:
    """(b, node, text): each text once a task, with its batch."""
    def once(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for p in parts:
            nodes = p.column("node").to_pylist()
            keep = []
            for i, x in enumerate(nodes):
                if x not in seen:
                    seen.add(x)
                    keep.append(i)
            yield p.take(pa.array(keep, pa.int32())) if len(keep) < len(nodes) else p

    rows = docs.select(F.pmod(F.xxhash64("node"), F.lit(batches)).cast("int").alias("b"), "node", "text")
    return rows.mapInArrow(once, "b int, node long, text string")


def _distinct(table: pa.Table) -> pa.Table:
    """A batch's rows without the copies that several tasks sent."""
    nodes = table.column("node").to_numpy()
    _, at = np.unique(nodes, return_index=True)
    return table.take(pa.array(at)).combine_chunks()


def _postings(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, b, h, c): a batch's distinct shingles of a bucket, lower halves, and texts holding each."""
    def run(table: pa.Table) -> pa.Table:
        b = table.column("b")[0].as_py()
        found = [h for _, h, _ in doc_shingles(_distinct(table).column("text").combine_chunks(), SHINGLE)]
        keys, n = np.unique(_key(np.concatenate(found), buckets), return_counts=True)
        of = (keys >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.diff(of, prepend=-1))
        ends = np.append(at[1:], len(keys))
        low, n = keys.astype("<u4"), n.astype("<u4")
        return pa.table({
            "bucket": pa.array(of[at], pa.int32()), "b": pa.array(np.full(len(at), b), pa.int32()),
            "h": pa.array([low[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()),
            "c": pa.array([n[i:j].tobytes() for i, j in zip(at, ends)], pa.binary())})

    return texts.groupBy("b").applyInArrow(run, "bucket int, b int, h binary, c binary")


def _shared(postings: DataFrame) -> DataFrame:
    """(b, bucket, h, level): of each batch's shingles those in two or more texts, with their code."""
    def run(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, "<u4") for x in table.column("h").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("c").to_pylist()])
        every = np.concatenate(rows)
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.diff(every[order].astype(np.int64), prepend=-1))
        df = np.add.reduceat(counts[order].astype(np.int64), new)
        level = np.zeros(len(every), np.uint8)
        code = np.where(df > 1, np.clip(np.rint(np.log(np.maximum(df, 1)) * LEVELS_PER_E), 1, 255), 0)
        level[order] = np.repeat(code, np.diff(np.append(new, len(every)))).astype(np.uint8)
        out_h, out_l, start = [], [], 0
        for r in rows:
            lv = level[start:start + len(r)]
            start += len(r)
            on = lv > 0
            out_h.append(r[on].tobytes())
            out_l.append(lv[on].tobytes())
        return pa.table({"b": table.column("b"), "bucket": table.column("bucket"), "h": pa.array(out_h, pa.binary()), "level": pa.array(out_l, pa.binary())})

    return postings.groupBy("bucket").applyInArrow(run, "b int, bucket int, h binary, level binary")


def _uniform(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1) from each 64-bit integer."""
    scale = 2.0 ** -32
    return ((x >> np.uint64(32)).astype(np.float64) + 0.5) * scale, ((x & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * scale


def weighted_samples(h: np.ndarray, w: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """n improved consistent weighted samples of each set; sets are runs of (h, w) from ``starts``.

    All draws come from the shingle's own hash, so equal shingles draw alike everywhere.
    """
    lengths = np.diff(np.append(starts, len(h)))
    log_w = np.log(w)
    out = np.empty((len(starts), n), np.uint64)
    for k in range(n):
        seed = mix(h ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        u1, u2 = _uniform(seed)
        u3, u4 = _uniform(mix(seed))
        u5, _ = _uniform(mix(seed ^ np.uint64(0x5851F42D4C957F2D)))
        r, c = -np.log(u1 * u2), -np.log(u3 * u4)
        t = np.floor(log_w / r + u5)
        log_a = np.log(c) - r * (t - u5) - r
        least = np.minimum.reduceat(log_a, starts)
        hit = np.flatnonzero(log_a == np.repeat(least, lengths))
        of = np.repeat(np.arange(len(starts)), lengths)[hit]
        first = hit[np.concatenate([[True], of[1:] != of[:-1]])]
        out[:, k] = mix(h[first] ^ mix(t[first].astype(np.int64).astype(np.uint64)))
    return out


def _signed(texts: DataFrame, shared: DataFrame, buckets: int, n_texts: int) -> DataFrame:
    """(node, total, pop, ids, weights, bands) of the texts that could link with another.

    ``pop``, the mean document-frequency code of the shingles, is highest near a group's centre.
    """
    per_level = IDF_SPAN / (LEVELS_PER_E * max(math.log(max(n_texts, 2)), 1e-9))
    schema = pa.schema([("node", pa.int64()), ("total", pa.float64()), ("pop", pa.float64()), ("ids", pa.binary()), ("weights", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        keys = [np.frombuffer(h, "<u4").astype(np.uint64) | np.uint64(b << 32) for h, b in zip(right.column("h").to_pylist(), right.column("bucket").to_pylist())]
        levels = [np.frombuffer(x, np.uint8) for x in right.column("level").to_pylist()]
        keys, levels = (np.concatenate(keys), np.concatenate(levels)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.uint8))
        order = np.argsort(keys)
        keys, levels = np.append(keys[order], np.uint64(0xFFFFFFFFFFFFFFFF)), np.append(levels[order], 0)
        left = _distinct(left)
        nodes = left.column("node").to_numpy()
        kept: list[tuple] = []
        for row, h, n in doc_shingles(left.column("text").combine_chunks(), SHINGLE):
            k = _key(h, buckets)
            at = np.searchsorted(keys, k)
            level = np.where(keys[at] == k, levels[at], 0)
            w = n * np.maximum(1.0, 1.0 + IDF_SPAN - per_level * level)
            on = level > 0
            if w[on].sum() >= SIMILARITY * w.sum() * (1 - 1e-9):
                kept.append((nodes[row], h, w, on, float(level.mean())))
        out = {name: [] for name in schema.names}
        last = np.cumsum([len(x[1]) for x in kept]) // SAMPLED
        for part in ([x for x, k in zip(kept, last) if k == chunk] for chunk in np.unique(last)):
            sizes = np.array([len(x[1]) for x in part])
            samples = weighted_samples(np.concatenate([x[1] for x in part]), np.concatenate([x[2] for x in part]), np.cumsum(sizes) - sizes, BANDS * ROWS)
            for (node, h, w, on, pop), s in zip(part, samples):
                ids = h[on].astype("<u4")
                order = np.argsort(ids, kind="stable")
                out["node"].append(node)
                out["total"].append(float(w.sum()))
                out["pop"].append(pop)
                out["ids"].append(ids[order].tobytes())
                out["weights"].append(w[on].astype("<f4")[order].tobytes())
                keys_of = np.zeros(BANDS, np.uint64)
                for j in range(ROWS):
                    keys_of = mix(keys_of ^ s.reshape(BANDS, ROWS)[:, j])
                out["bands"].append(mix(keys_of + np.arange(BANDS, dtype=np.uint64)).astype(np.int64).tolist())
        pa.default_memory_pool().release_unused()  # a worker keeps what a group needed only while it needs it
        return pa.table(out, schema=schema)

    return texts.groupBy("b").cogroup(shared.groupBy("b")).applyInArrow(run, "node long, total double, pop double, ids binary, weights binary, bands array<long>")


def weighted_jaccard(a_ids: bytes, a_w: bytes, a_total: float, b_ids: bytes, b_w: bytes, b_total: float) -> float:
    """Sum of least over sum of largest weights; ids are sorted 32-bit shingle numbers.

    Only shingles that occur in other texts are listed; the totals hold all weights.
    """
    x, y = np.frombuffer(a_ids, "<u4"), np.frombuffer(b_ids, "<u4")
    _, i, j = np.intersect1d(x, y, return_indices=True)
    both = float(np.minimum(np.frombuffer(a_w, "<f4")[i], np.frombuffer(b_w, "<f4")[j]).sum(dtype=np.float64))
    return both / (a_total + b_total - both)


def _verified(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """(x, y, sim) for pairs of nodes; the join on the leader, ``y``, may be split where it is hot."""
    cols = ("total", "ids", "weights")
    left = signed.select(F.col("node").alias("x"), *[F.col(c).alias(f"{c}_x") for c in cols])
    right = signed.select(F.col("node").alias("y"), *[F.col(c).alias(f"{c}_y") for c in cols])

    @F.pandas_udf("double")
    def sim(ax: pd.Series, aw: pd.Series, at: pd.Series, bx: pd.Series, bw: pd.Series, bt: pd.Series) -> pd.Series:
        return pd.Series([weighted_jaccard(*r) for r in zip(ax, aw, at, bx, bw, bt)], dtype=float)

    return pairs.join(left, "x").join(right, "y").select("x", "y", sim("ids_x", "weights_x", "total_x", "ids_y", "weights_y", "total_y").alias("sim"))


def _leaders(members: DataFrame) -> DataFrame:
    """(key, leader): each bucket's member of highest ``pop``, the larger node on ties."""
    return members.groupBy("key").agg(F.max(F.struct("pop", "node")).alias("m")).select("key", F.col("m.node").alias("leader"))


def _linked(signed: DataFrame) -> DataFrame:
    """(node, component) of all nodes with a verified link.

    A bucket's leader links most members by as many pairs as there are members. The exact
    rest compares every member that is in another component than its bucket's leader with
    the whole bucket, in blocks.
    """
    banded = signed.select("node", "pop", F.explode("bands").alias("key"))
    several = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = materialize(banded.join(several, "key"), "minhash-members")
    first = materialize(members.join(_leaders(members), "key").select("key", "node", "leader"), "minhash-first")
    stars = first.where("node <> leader").select(F.col("node").alias("x"), F.col("leader").alias("y")).distinct()
    with arrow_rows(signed.sparkSession, BATCH_ROWS):
        known = materialize(_verified(stars, signed).where(F.col("sim") >= SIMILARITY), "minhash-stars")
    links = known.select(F.col("x").alias("a"), F.col("y").alias("b"))
    parts = materialize(connected_components(links), "minhash-parts")
    part_of = parts.select(F.col("node").alias("n"), "component")
    placed = first.join(part_of, F.col("node") == F.col("n"), "left").withColumn("part", F.coalesce("component", "node")).drop("n", "component")
    placed = placed.join(part_of, F.col("leader") == F.col("n"), "left").withColumn("main", F.coalesce("component", "leader")).select("key", "node", "part", "main")
    placed = materialize(placed, "minhash-placed")
    with arrow_rows(signed.sparkSession, BATCH_BLOCKS):
        rest = materialize(_rest(placed, signed), "minhash-rest")
    return parts if rest.isEmpty() else connected_components(links.unionByName(rest))


def _rest(placed: DataFrame, signed: DataFrame) -> DataFrame:
    """(a, b): links between the parts of each bucket that hold members apart from its leader.

    Members are packed into blocks of about BLOCK; a row is one pair of blocks. Inside it a
    matrix product bounds all similarities from above, and those over the limit are verified
    one by one until the parts are joined, so at most one link per member leaves a row.
    """
    off = F.col("part") != F.col("main")
    sizes = placed.groupBy("key").agg(F.count("*").alias("n_all"), F.count_if(off).alias("n_off")).where("n_off > 0")
    rows = placed.join(sizes, "key").join(signed.select("node", "total", "ids", "weights"), "node")
    item = F.struct("node", "part", "total", "ids", "weights")

    def packed(df: DataFrame, n: str, to: str) -> DataFrame:
        block = F.pmod(F.xxhash64("node", F.lit(to)), F.ceil(F.col(n) / BLOCK))
        return df.groupBy("key", block.alias("block")).agg(F.collect_list(item).alias(to)).drop("block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for r in part.itertuples(index=False):
                found = _block_links(r.some, r.whole)
                if found:
                    yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return packed(rows.where(off), "n_off", "some").join(packed(rows, "n_all", "whole"), "key").mapInPandas(run, "a long, b long").distinct()


def _block_links(some: list[dict], whole: list[dict]) -> list[tuple[int, int]]:
    """Links that join the parts of two blocks of (node, part, total, ids, weights)."""
    def flat(block: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = [np.frombuffer(m["ids"], "<u4") for m in block]
        return np.concatenate(ids), np.repeat(np.arange(len(block)), [len(x) for x in ids]), np.sqrt(np.concatenate([np.frombuffer(m["weights"], "<f4") for m in block]))

    (ia, ra, wa), (ib, rb, wb) = flat(some), flat(whole)
    common = np.intersect1d(ia, ib)
    if not len(common):
        return []
    bound = np.zeros((len(some), len(whole)))
    places = []
    for ids in (ia, ib):
        at = np.minimum(np.searchsorted(common, ids), len(common) - 1)
        places.append(np.where(common[at] == ids, at, -1))
    for start in range(0, len(common), COLUMNS):
        dense = []
        for at, r, w, n in ((places[0], ra, wa, len(some)), (places[1], rb, wb, len(whole))):
            on = (at >= start) & (at < start + COLUMNS)
            d = np.zeros((n, min(COLUMNS, len(common) - start)), np.float32)
            np.maximum.at(d, (r[on], at[on] - start), w[on])
            dense.append(d)
        bound += dense[0] @ dense[1].T
    ta, tb = np.array([m["total"] for m in some]), np.array([m["total"] for m in whole])
    bound = bound / np.maximum(ta[:, None] + tb[None, :] - bound, 1e-12)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(bound >= SIMILARITY - 1e-4)):
        a, b = some[i], whole[j]
        x, y = find(a["part"]), find(b["part"])
        if x != y and weighted_jaccard(a["ids"], a["weights"], a["total"], b["ids"], b["weights"], b["total"]) >= SIMILARITY:
            root[x] = y
            out.append((a["node"], b["node"]))
    return out


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a text, null where it has no word."""
    has = F.coalesce(text, F.lit("")).rlike(HAS_WORD)
    return F.when(has, F.xxhash64(text)), F.when(has, F.xxhash64(F.lit(MARK), text))


def clashing(rows: DataFrame) -> list[int]:
    """First hashes that texts of different second hashes share: one in 10**10 texts or so."""
    found = rows.where("node is not null").groupBy("node").agg(F.min("__second").alias("lo"), F.max("__second").alias("hi")).where("lo <> hi")
    found = [r.node for r in found.select("node").limit(MAX_CLASHES + 1).collect()]
    if len(found) > MAX_CLASHES:
        raise RuntimeError(f"over {MAX_CLASHES} pairs of texts share a hash")
    return found


def apart(first: Column, second: Column, clashes: list[int]) -> Column:
    """The node of a text: its first hash, or one of both where that is shared, so nodes go by 128 bits."""
    return F.when(first.isin(clashes), F.xxhash64(first, second)).otherwise(first) if clashes else first


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, class_id, kept, copies) for every row of ``docs``.

    ``class_id`` is the smallest doc_id of the row's class and ``kept`` marks it; equal texts
    are of one class, and so are texts with a chain of links of weighted Jaccard similarity
    SIMILARITY or more. ``copies`` counts the rows with this id and text; of those, and of
    equal smallest ids, a caller keeps one. Null texts and texts without a word are each a
    class of their own. Null ids come last in the order of a class. An empty table gives no rows.
    """
    return _near_duplicates(docs, id_col, text_col)[0]


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    text = F.col(text_col)
    first, second = text_hashes(text)
    seen = materialize(docs.select(F.col(id_col).alias("doc_id"), first.alias("node"), second.alias("__second"), F.octet_length(text).alias("bytes")), "minhash-rows")
    clashes = clashing(seen)
    rows = seen.select("doc_id", apart(F.col("node"), F.col("__second"), clashes).alias("node"), "bytes")
    named = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), apart(first, second, clashes).alias("node"))
    n, size = rows.where("node is not null").agg(F.count("*"), F.sum("bytes")).first()
    n, size = n or 0, size or 0
    batches = max(1, math.ceil(n / BATCH_TEXTS))
    buckets = max(1, math.ceil(size / 6 / BUCKET_SHINGLES))
    texts = _texts(named.where("node is not null"), batches)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        signed = materialize(_signed(texts, _shared(_postings(texts, buckets)), buckets, n), "minhash-signed")

    return _classes(rows, _linked(signed)), clashes


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each class left, all columns as they were.

    Rows without a word stay. Of rows that repeat the kept id and text one stays.
    """
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    first, second = text_hashes(F.col("__text"))
    found, clashes = _near_duplicates(docs, id_col, text_col)
    whole = whole.withColumn("__node", apart(first, second, clashes))
    keepers = found.where("kept and node is not null").groupBy("doc_id", "node").agg(F.max("copies").alias("copies"))
    keepers = materialize(keepers, "minhash-keepers")

    def rows_of(which: DataFrame) -> DataFrame:
        same = (F.col("__node") == F.col("node")) & F.col("__id").eqNullSafe(F.col("doc_id"))
        return whole.join(which, same, "left_semi")

    kept = rows_of(keepers.where("copies = 1")).unionByName(whole.where("__node is null"))
    repeated = keepers.where("copies > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows_of(repeated).dropDuplicates(["__id", "__node"]))
    return kept.select("row.*")


def _classes(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Names each class by its first row in the order of (null id, id, node)."""
    of_node = rows.where("node is not null").groupBy("doc_id", "node").agg(F.count("*").alias("copies"))
    part = of_node.join(parts.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")
    first = part.groupBy("component").agg(F.min(order).alias("first"))
    classes = part.join(first, "component").select(
        "doc_id", "node", "copies", F.col("first.doc_id").alias("class_id"), (order == F.col("first")).alias("kept"))
    by_row = rows.where("node is not null").alias("r").join(
        classes.alias("c"), F.expr("r.node = c.node and r.doc_id <=> c.doc_id")).select("r.doc_id", "r.node", "c.class_id", "c.kept", "c.copies")
    alone = rows.where("node is null").select("doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), F.lit(1).cast("long").alias("copies"))
    return by_row.unionByName(alone)
