"""Ranked lexical search: exact inner products over sparse ball trees.

A document is a sparse vector of weighted, length-normed term counts; a query is the set of its
terms. Documents of a task are dealt into ball trees. The largest score below a node is at most
the query's product with the node's centroid plus the query's norm times the node's radius. In
so many dimensions that alone is wide, so a node also keeps its radius along each term, above
the centroid: the sum of the query's terms is a second bound, and the lower one holds. Nodes are
opened by falling bound until none can reach the results kept so far; leaves are scored in 64-bit
integers, so the bounds decide only what is skipped, never a score.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize

#: Distinct terms of the queries that are searched in one pass; more queries take more passes.
MAX_BLOCK_TERMS = 100_000
#: Documents and postings of a tree, and documents of a leaf.
TREE_DOCS, TREE_POSTINGS, LEAF_DOCS = 8_192, 2_000_000, 256
_UPPER = bytes(range(65, 91))
#: Bytes of a term stay, A-Z become small letters, all others part terms.
_TERMS = bytes(b if b >= 0x80 or chr(b).isalnum() and b not in _UPPER else b + 32 if b in _UPPER else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and code points from U+0080; A-Z are lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_TERMS).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class BallTree:
    """A tree over sparse rows: ``start`` has the first entry of each row, ``cols`` and ``vals`` the entries."""

    def __init__(self, start: np.ndarray, cols: np.ndarray, vals: np.ndarray, n_cols: int):
        self.rows = len(start) - 1
        y, owner = vals.astype(np.float64), np.repeat(np.arange(self.rows), np.diff(start))
        norms = np.bincount(owner, y * y, self.rows)
        self.centre, self.radius, self.reach, self.children, self.leaf = [], [], [], [], []

        def grow(docs: np.ndarray) -> int:
            node = len(self.radius)
            at, mine = _entries(start, docs)
            c, v = cols[at], y[at]
            centre = np.bincount(c, v, n_cols) / len(docs)
            own = norms[docs]
            # Squared distances with a margin for the rounding of their three parts.
            far = lambda p, pp: own - 2 * np.bincount(mine, v * p[c], len(docs)) + pp
            cc = float(centre @ centre)
            d = far(centre, cc)
            self.centre.append(centre)
            self.radius.append(math.sqrt(max(float(d.max()), 0.0) + 1e-11 * (float(own.max()) + cc)))
            top = np.zeros(n_cols, np.int64)
            np.maximum.at(top, c, vals[at])
            self.reach.append(top)  # centroid plus radius along each term: whole numbers, so exact
            self.children.append(None)
            self.leaf.append(None)
            if len(docs) <= LEAF_DOCS:
                order = np.argsort(c, kind="stable")
                self.leaf[node] = docs, c[order], mine[order], vals[at][order]
                return node

            def dense(k: int) -> np.ndarray:
                row, p = int(docs[k]), np.zeros(n_cols)
                p[cols[start[row]:start[row + 1]]] = y[start[row]:start[row + 1]]
                return p

            one = int(np.argmax(d))
            d_one = far(dense(one), float(own[one]))
            two = int(np.argmax(d_one))
            d_two = far(dense(two), float(own[two]))
            # Parts by which of two far rows is nearer; no part under an eighth, so the tree stays flat for any data.
            order = np.argsort(d_one - d_two, kind="stable")
            cut = int(np.clip(np.count_nonzero(d_one < d_two), len(docs) // 8, len(docs) - len(docs) // 8))
            self.children[node] = grow(np.sort(docs[order[:cut]])), grow(np.sort(docs[order[cut:]]))
            return node

        if self.rows:
            grow(np.arange(self.rows))

    def bound(self, node: int, terms: np.ndarray) -> float:
        """At least the largest score of the node's rows, rounding included."""
        ball = (float(self.centre[node][terms].sum()) + math.sqrt(len(terms)) * self.radius[node]) * (1 + 1e-9) + 1
        return min(ball, float(self.reach[node][terms].sum()) * (1 + 1e-15) + 1)

    def scores(self, node: int, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of a leaf."""
        docs, cols, mine, vals = self.leaf[node]
        at, _ = _ranges(np.searchsorted(cols, terms, "left"), np.searchsorted(cols, terms, "right"))
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, mine[at], vals[at])
        return docs, out


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges first..end-1 one after the other, with the number of the range."""
    n = end - first
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n), owner


def _entries(start: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _ranges(start[docs], start[docs + 1])


class Best:
    """The k rows of largest score above 0 so far; equal scores by ascending id, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def floor(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, ids: list, scores: list[int]) -> None:
        new = [(-s, i is None, 0 if i is None else i) for i, s in zip(ids, scores)]
        self.rows = heapq.nsmallest(self.k, self.rows + new)


def search_tree(tree: BallTree, ids: np.ndarray, terms: np.ndarray, best: Best) -> int:
    """Adds the tree's best rows for the terms of a query; returns how many leaves were scored."""
    opened = 0
    if not tree.rows or not len(terms):
        return opened
    queue = [(-tree.bound(0, terms), 0)]
    while queue and -queue[0][0] >= best.floor():
        _, node = heapq.heappop(queue)
        if tree.children[node] is None:
            docs, scores = tree.scores(node, terms)
            good = np.flatnonzero(scores >= best.floor())
            if len(good) > best.k:
                cut = np.partition(scores[good], len(good) - best.k)[len(good) - best.k]
                good = good[scores[good] >= cut]
            opened += 1
            if len(good):
                best.add(ids[docs[good]].tolist(), scores[good].tolist())
        else:
            for child in tree.children[node]:
                if (b := tree.bound(child, terms)) >= best.floor():
                    heapq.heappush(queue, (-b, child))
    return opened


def count_terms(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, codes, counts) of every document with a term: all its terms counted, those of the vocabulary by code."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = {t: i for i, t in enumerate(vocabulary)}
        for b in batches:
            out = []
            for i, text in zip(b["doc_id"], b["text"]):
                terms = terms_of(text)
                if terms:
                    found = Counter(filter(None, [code.get(t, -1) + 1 for t in terms]))
                    out.append((i, len(terms), [c - 1 for c in found], list(found.values())))
            yield pd.DataFrame(out, columns=["doc_id", "n", "codes", "counts"])

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id string, n long, codes array<int>, counts array<long>")


def _search_block(counted: DataFrame, queries: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(query, doc_id, score): the k best of each task for every query."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = [(q, np.array(sorted(t), np.int64), Best(k)) for q, t in queries]
        held: list[tuple] = []
        entries = 0

        def flush() -> None:
            ids = np.empty(len(held), object)
            ids[:] = [None if h[0] is None else int(h[0]) for h in held]
            start = np.concatenate([[0], np.cumsum([len(h[2]) for h in held])]).astype(np.int64)
            cols = np.concatenate([h[2] for h in held]).astype(np.int64)
            tf = np.concatenate([h[3] for h in held]).astype(np.int64)
            n = np.array([h[1] for h in held], np.int64)
            m = 10 + 90 * n * n_docs // total
            vals = weights[cols] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(start))))
            tree = BallTree(start, cols, vals, len(weights))
            for _, terms, best in asked:
                search_tree(tree, ids, terms, best)

        for b in batches:
            for row in zip(b["doc_id"].astype(object).where(b["doc_id"].notna(), None), b["n"], b["codes"], b["counts"]):
                held.append(row)
                entries += len(row[2])
                if len(held) >= TREE_DOCS or entries >= TREE_POSTINGS:
                    flush()
                    held, entries = [], 0
        if held:
            flush()
        out = [(q, None if none else i, -s) for q, _, best in asked for s, none, i in best.rows]
        frame = pd.DataFrame(out, columns=["query", "doc_id", "score"])
        yield frame.assign(doc_id=frame["doc_id"].astype(object).where(frame["doc_id"].notna(), None).map(lambda i: None if i is None else str(i)))

    return counted.where(F.size("codes") > 0).mapInPandas(run, "query long, doc_id string, score long")


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Blocks of (item, distinct terms) in the order of the items, each of at most MAX_BLOCK_TERMS terms or one item."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"item": b["item"], "terms": [sorted(set(terms_of(t))) for t in b["text"]]})

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).orderBy("item", "text")
    held, n = [], 0
    # Read partition by partition: the driver holds one of them and a block.
    for r in rows.mapInPandas(run, "item string, terms array<binary>").toLocalIterator():
        if held and n + len(r.terms) > MAX_BLOCK_TERMS:
            yield held
            held, n = [], 0
        held.append((r["item"], [bytes(t) for t in r.terms]))
        n += len(r.terms)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its k best documents of score above 0.

    Terms are the maximal stretches of ASCII letters, digits and other code points from U+0080
    on, A-Z lower-cased. Of N documents with a term, holding L terms, a term in df of them
    weighs floor(1000 ln((2 N + 2) / (2 df + 1))); a document of n terms that has it tf times
    scores weight * (10^9 tf div (1000 tf + 8 m)), m being 10 + 90 n N div L, over the item's
    distinct terms. Equal scores go by ascending id, null ids last. Ids are whole numbers.

    Null and empty texts have no terms and are never found; items without terms, or with none
    that a document holds, give no rows, and so does an empty table. A repeated document is
    ranked as often as it is there; a repeated item is answered as often. Other columns are not
    read. Queries go in blocks of bounded size, each in one pass over all documents; a task
    sends k rows a query, so results grow with tasks, not with documents.
    """
    spark = docs.sparkSession
    schema = f"item_id {items.schema[item_col].dataType.simpleString()}, rank int, doc_id {docs.schema[id_col].dataType.simpleString()}, score long"
    found: DataFrame | None = None
    for block in query_blocks(items, item_col, item_text_col):
        vocabulary = sorted({t for _, ts in block for t in ts})
        code = {t: i for i, t in enumerate(vocabulary)}
        counted = materialize(count_terms(docs, vocabulary, id_col, text_col), "terms")
        n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r.code: r.df for r in counted.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df")).collect()}
        weights = np.array([term_weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        queries = [(q, [code[t] for t in ts]) for q, (_, ts) in enumerate(block) if ts]
        hits = _search_block(counted, queries, weights, n_docs, total, k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last(F.col("doc_id").cast("long")))
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query long, item_id string")
        part = best.join(names, "query").select("item_id", "rank", "doc_id", "score")
        part = part.select(*[F.col(c).cast(t).alias(c) for c, t in (f.split(" ") for f in schema.split(", "))])
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found
