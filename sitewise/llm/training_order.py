"""Training-order materialisation.

Texts become token sequences of one length. A keyed Feistel permutation with cycle-walking
maps each sequence's number to its global slot, so the order is random, needs no sort key
column and can be inverted. Slots are dealt into range partitions and written as shards of
fixed-stride records: slot s is record s % RECORDS of shard s // RECORDS, so a reader can go
on from any slot.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import materialize

#: Tokens of a sequence, its bytes on disk, records of a shard.
LENGTH, RECORDS = 512, 256
STRIDE = 2 * LENGTH
#: Rounds of the Feistel network and rows of a batch in Python.
ROUNDS, SLICE_ROWS = 6, 200
#: Up to so many files' offsets are broadcast.
MAX_BROADCAST_FILES = 100_000

_loaded: dict[str, tiktoken.Encoding] = {}


def _tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    if path not in _loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def sequences(docs: DataFrame, path: str, pattern: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, n_tokens, data): each text's tokens and an end token, cut into sequences.

    The last sequence of a text is filled with end tokens; ``n_tokens`` counts those before
    the filling. Null and empty texts give one sequence of the end token alone. ``data`` is
    compressed so that the shuffle moves less.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, pack = _tokenizer(path, pattern), zstandard.ZstdCompressor(level=1)
        for b in batches:
            for start in range(0, len(b), SLICE_ROWS):
                out = []
                for doc, text in zip(b["doc_id"].iloc[start:start + SLICE_ROWS], b["text"].iloc[start:start + SLICE_ROWS]):
                    ids = coder.encode_ordinary(text or "")
                    ids.append(end)
                    a = np.full(-(-len(ids) // LENGTH) * LENGTH, end, "<u2")
                    a[:len(ids)] = ids
                    for k in range(0, len(a), LENGTH):
                        out.append((doc, k // LENGTH, min(LENGTH, len(ids) - k), pack.compress(a[k:k + LENGTH].tobytes())))
                yield pd.DataFrame(out, columns=["doc_id", "part", "n_tokens", "data"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, part int, n_tokens int, data binary")


def _round(half: np.ndarray, key: int, k: int, mask: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + (k + 1) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64(mask)


def permute(index: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Slots of the numbers 0..n-1 under the key, or numbers of slots.

    The network permutes the smallest even number of bits that holds n; results of n or
    more are put in again until they fall below (cycle-walking), so it is one to one on 0..n-1.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = (1 << half) - 1, np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & np.uint64(mask)
        for k in (reversed(range(ROUNDS)) if inverse else range(ROUNDS)):
            if inverse:
                left, right = right ^ _round(left, key, k, mask), left
            else:
                left, right = right, left ^ _round(right, key, k, mask)
        return (left << shift) | right

    out = once(np.asarray(index).astype(np.uint64))
    while (high := out >= np.uint64(n)).any():
        out[high] = once(out[high])
    return out.astype(np.int64)


def _slot(index: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def slot(i: pd.Series) -> pd.Series:
        return pd.Series(permute(i.to_numpy(), n, key))

    return slot(index)


def write_order(docs: DataFrame, path: str, tokenizer: str, pattern: str, end: int, key: int = 20_240, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Write ``shards``, ``index`` and return the number of sequences.

    Numbers are a file's offset plus the row's place in it, over the written table of
    sequences, so a repeated task gives the same slots. ``index`` says which text and part
    is at a slot. Repeated rows are sequences of their own. An empty table gives no shard.
    """
    rows = materialize(sequences(docs, tokenizer, pattern, end, id_col, text_col), "sequences")
    placed = rows.select("doc_id", "part", "n_tokens", "data", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    sizes = placed.groupBy("file").agg(F.count("*").alias("n"))
    offsets = materialize(sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("offset"), "n"), "sequence-offsets")  # a row per file
    n, files = offsets.agg(F.sum("n"), F.count("*")).first()
    n = n or 0
    numbered = placed.join(F.broadcast(offsets) if files <= MAX_BROADCAST_FILES else offsets, "file")
    slotted = numbered.select("doc_id", "part", "n_tokens", "data", _slot(F.col("offset") + F.col("at"), max(n, 1), key).alias("slot"))
    slotted.select("slot", "doc_id", "part", "n_tokens").write.option("compression", "zstd").parquet(f"{path}/index")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Joins the sorted records of each shard; a partition holds whole shards only."""
        unpack, shard, parts = zstandard.ZstdDecompressor(), None, []
        for b in batches:
            for s, data in zip(b["shard"], b["data"]):
                if s != shard and parts:
                    yield pd.DataFrame({"shard": [shard], "data": [b"".join(parts)]})
                    parts = []
                shard = s
                parts.append(unpack.decompress(data, max_output_size=STRIDE))
        if parts:
            yield pd.DataFrame({"shard": [shard], "data": [b"".join(parts)]})

    ranged = slotted.select("slot", F.floor(F.col("slot") / RECORDS).alias("shard"), "data").repartitionByRange("shard").sortWithinPartitions("slot")
    ranged.mapInPandas(pack, "shard long, data binary").write.option("compression", "zstd").parquet(f"{path}/shards")
    return n


def read_order(spark: SparkSession, path: str, start: int = 0) -> DataFrame:
    """(slot, record) from slot ``start`` on; earlier shards are not read."""
    shards = spark.read.schema("shard long, data binary").parquet(f"{path}/shards").where(F.col("shard") >= start // RECORDS)
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, data in zip(b.column("shard").to_pylist(), b.column("data")):
                whole = np.frombuffer(data.as_buffer(), np.uint8)
                n = len(whole) // STRIDE
                record = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * STRIDE), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays([pa.array(shard * RECORDS + np.arange(n, dtype=np.int64)), record], ["slot", "record"])

    return shards.mapInArrow(split, "slot long, record binary").where(F.col("slot") >= start)
