"""Toxicity: a linear classifier with a counterfactual penalty.

Features are words and word beginnings that differ between the labels, counted in Spark
over a bounded labelled sample. The fit adds to its loss the squared change of the score
when identity terms of a text are swapped for others of their group, and when they are
swapped for nothing, so that neither which group is named nor naming one moves the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize

#: Labelled rows of the fit, by smallest hash; features kept, and rows a feature needs.
MAX_LABELLED, MAX_FEATURES, MIN_ROWS = 12_000, 1_200, 4
#: Lengths of word beginnings that are features beside the word itself.
BEGINNINGS = (4, 5, 6)
#: Weights of the ridge and of the counterfactual penalty.
RIDGE, SWAP_PENALTY, STEPS = 3e-4, 1.0, 400
THRESHOLD = 0.3
#: Fixed groups of identity terms; a term is swapped for the next of its group.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"),
    ("disabled", "deaf", "blind", "elderly", "young"),
)
SWAP = {a: g[(i + 1) % len(g)] for g in IDENTITY for i, a in enumerate(g)}
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """Words as they are, and beginnings with a caret."""
    return words.union(*[{"^" + w[:n] for w in words if len(w) >= n} for n in BEGINNINGS])


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column | None, limit: int) -> DataFrame:
    """(text, label) of at most ``limit`` labelled rows, those of the smallest hashes; of rows with one id the least text."""
    marks = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("label")).where("__id is not null and label is not null")
    if usable is not None:
        marks = marks.where(usable)
    marks = marks.groupBy("__id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    chosen = marks.orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(limit).select("__id", "label")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__id")
    return rows.groupBy("__id", "label").agg(F.min("text").alias("text")).select("text", "label")  # an id given many times is one row


def choose_features(sample: DataFrame, limit: int = MAX_FEATURES) -> list[str]:
    """The features with the largest standardised difference between the labels.

    Each task adds up its own rows first, so the shuffle holds one row per task and feature.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, bad = Counter(), Counter()
        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                found = features_of(words_of(text))
                rows.update(found)
                if label:
                    bad.update(found)
        if rows:
            yield pd.DataFrame({"feature": list(rows), "n": list(rows.values()), "bad": [bad[f] for f in rows]})

    n, p = sample.agg(F.count("*"), F.sum(F.col("label").cast("double"))).first()
    share = (p or 0.0) / n if n else 0.0
    expect = F.col("n") * share
    z = F.abs(F.col("bad") - expect) / F.sqrt(expect * (1 - share) + 1)
    best = (
        sample.mapInPandas(count, "feature string, n long, bad long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .where(F.col("n") >= MIN_ROWS).withColumn("z", z).orderBy(F.desc("z"), "feature").limit(limit)
    )
    terms = sorted(set().union(*({t} | {"^" + t[:n] for n in BEGINNINGS if len(t) >= n} for t in SWAP)))
    return list(dict.fromkeys([r.feature for r in best.collect()] + terms))


def fit(x: np.ndarray, swaps: np.ndarray, y: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by Nesterov steps on logistic loss + ridge + mean squared swap change."""
    p = np.clip(y.mean() if len(y) else 0.1, 1e-3, 1 - 1e-3)
    bias, w = float(np.log(p / (1 - p))), np.zeros(x.shape[1], np.float32)
    if not len(y):
        return w, bias
    rate = 4.0 / (float((x * x).sum(1).mean()) + 1.0)
    look, ahead = w.copy(), bias
    for k in range(steps):
        off = (1 / (1 + np.exp(-(x @ look + ahead))) - y).astype(np.float32)
        grad = x.T @ off / len(y) + RIDGE * look
        if len(swaps):
            grad += 2 * SWAP_PENALTY * swaps.T @ (swaps @ look) / len(swaps)
        new_w, new_b = look - rate * grad, ahead - rate * float(off.mean())
        pull = k / (k + 3)
        look, ahead = new_w + pull * (new_w - w), new_b + pull * (new_b - bias)
        w, bias = new_w, new_b
    return w, bias


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable: Column | None = None, max_labelled: int = MAX_LABELLED) -> dict[str, float]:
    """Weights by feature, with the bias under the empty string.

    Fitted on at most ``max_labelled`` labelled rows; ``usable`` says which rows of
    ``labels`` (id as ``__id``) may be used. No labels give a bias only.
    """
    sample = materialize(labelled_sample(docs, labels, id_col, text_col, label_col, usable, max_labelled), "toxicity-sample")
    names = choose_features(sample)
    place = {f: i for i, f in enumerate(names)}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, label in zip(b["text"], b["label"]):
                words = words_of(text)
                swapped, without = {SWAP.get(w, w) for w in words}, words.difference(SWAP)
                index = lambda ws: [place[f] for f in features_of(ws) if f in place]
                named = len(without) < len(words)
                out.append((int(label), index(words), index(swapped) if named else None, index(without) if named else None))
            yield pd.DataFrame(out, columns=["label", "on", "swapped", "without"])

    got = sample.mapInPandas(rows, "label int, on array<int>, swapped array<int>, without array<int>").toPandas()
    x = np.zeros((len(got), len(names)), np.float32)
    for i, on in enumerate(got["on"]):
        x[i, list(on)] = 1
    changed = [(i, s) for c in ("swapped", "without") for i, s in enumerate(got[c]) if s is not None]
    swaps = np.zeros((len(changed), len(names)), np.float32)
    for k, (i, s) in enumerate(changed):
        swaps[k, list(s)] = 1
        swaps[k] -= x[i]
    w, bias = fit(x, swaps, got["label"].to_numpy(np.float32))
    return {f: float(v) for f, v in zip(names, w) if v} | {"": bias}


def score(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) over whole texts; null and empty texts score the bias alone."""
    bias, known = weights[""], {f: v for f, v in weights.items() if f}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total = [bias + sum(map(known.__getitem__, known.keys() & features_of(words_of(t)))) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": 1 / (1 + np.exp(-np.clip(np.array(total, float), -50, 50)))})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(id_col: Column) -> Column:
    """Rows that no fit may use: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def judge_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; repeated rows score alike.

    Null and empty texts score the bias alone, and so does every text without labels (a share
    of 0.1 is then assumed). A null id is not held out. An empty table gives no rows.
    """
    weights = train(docs, labels, id_col, text_col, label_col, ~held_out(F.col("__id")))
    return score(docs, weights, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
