"""Quality rules: a decision list learned by sequential covering over text statistics.

Each rule is a conjunction of thresholds, grown on one part of the labelled rows to gain
information and pruned on the other. The list becomes one ordered Spark conditional
expression, so applying it is a projection over all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows that the rules are learned from; those of the smallest hashes if there are more.
MAX_LABELLED = 40_000
#: A rule stays only if this share of the held-back rows it matches is bad, and at least MIN_COVER rows.
MIN_PRECISION, MIN_COVER = 0.9, 5
MAX_RULES, MAX_TERMS, MAX_CUTS = 12, 4, 64
#: Rows whose texts are Python strings at once.
SLICE_ROWS = 500
#: Fixed character sets of the base statistics.
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_letters long, n_digits long, n_marks long, n_distinct long"


def text_stats(text: str | None) -> tuple[int, ...]:
    """The columns of STATS for one whole text; all 0 for null or empty."""
    if not text:
        return (0,) * 11
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly SPACES
    lines, dups = Counter(x for x in text.split("\n") if x.strip(SPACES)), 0
    if lines:
        dups = sum(lines.values()) - len(lines)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    counts = Counter(windows)
    if len(counts) < len(windows):
        end = 0  # first word not yet counted
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    upper = letters = digits = 0
    for ch, n in Counter(text).items():
        if ch.isalpha():
            letters += n
            upper += n * ch.isupper()
        elif ch.isdigit():
            digits += n
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dups, repeated,
        sum(lines.values()), upper, letters, digits, text.count("!") + text.count("?"), len(set(words)),
    )


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, STATS): every row as a struct beside its statistics, over whole texts in Arrow batches."""
    names = [x.split()[0] for x in STATS.split(", ")]

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, SLICE_ROWS):
                part = b.column("row").slice(start, SLICE_ROWS)
                found = np.array([text_stats(t) for t in part.field(place).to_pylist()], np.int64).reshape(-1, len(names))
                yield pa.RecordBatch.from_arrays([part, *[pa.array(found[:, i]) for i in range(len(names))]], ["row", *names])

    place = docs.columns.index(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([rows.schema["row"], *[T.StructField(n, T.LongType()) for n in names]])
    return rows.mapInArrow(stats, schema)


def features() -> dict[str, Column]:
    """Named ratios that rules may test; 0 where the denominator is 0."""
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return {
        "symbols_per_word": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "chars_per_word": share("word_chars", "n_words"),
        "upper_share": share("n_upper", "n_letters"), "digit_share": share("n_digits", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"), "distinct_share": share("n_distinct", "n_words"),
        "letter_share": share("n_letters", "word_chars"), "words_per_line": share("n_words", "n_lines"),
    }


def _covers(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
    return reduce(np.logical_and, (x[:, f] > t if op == ">" else x[:, f] <= t for f, op, t in rule), np.ones(len(x), bool))


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple[int, str, float]]:
    rule: list[tuple[int, str, float]] = []
    on = np.ones(len(x), bool)
    while len(rule) < MAX_TERMS:
        p0, n0 = bad[on].sum(), (~bad[on]).sum()
        if not n0:
            break
        best, pick = 0.0, None
        for f in range(x.shape[1]):
            values = x[on, f]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, MAX_CUTS)))
            order = np.argsort(values)
            at = np.searchsorted(values[order], cuts, side="right")
            pos = np.concatenate([[0], np.cumsum(bad[on][order])])[at]
            for p, n, op in ((pos, at - pos, "<="), (p0 - pos, n0 - (at - pos), ">")):
                gain = p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - np.log2(p0 / (p0 + n0)))
                k = int(np.argmax(np.where(p > 0, gain, -1)))
                if p[k] > 0 and gain[k] > best + 1e-9:
                    best, pick = gain[k], (f, op, float(cuts[k]))
        if pick is None:
            break
        rule.append(pick)
        on &= _covers(x, [pick])
    return rule


def _settle(x: np.ndarray, bad: np.ndarray, rule: list[tuple[int, str, float]]) -> list[tuple[int, str, float]]:
    """Move each threshold into the gap: half-way from the nearest row it leaves out to the
    covered bad rows' 5 % quantile, so that a good row just past the sample's edge stays out."""
    settled = list(rule)
    for i, (f, op, t) in enumerate(rule):
        others = _covers(x, settled[:i] + settled[i + 1:])
        on = others & _covers(x, [settled[i]])
        if not (on & bad).any() or not (others & ~on).any():
            continue
        if op == ">":
            inner, outer = np.quantile(x[on & bad, f], 0.05), x[others & ~on, f].max()
        else:
            inner, outer = np.quantile(x[on & bad, f], 0.95), x[others & ~on, f].min()
        settled[i] = (f, op, float((inner + outer) / 2))
    return settled


def learn_rules(x: np.ndarray, bad: np.ndarray, seed: int = 7) -> list[list[tuple[int, str, float]]]:
    """Rules for ``bad`` rows by sequential covering, each (feature index, operator, threshold) terms."""
    grow = np.random.default_rng(seed).random(len(x)) < 2 / 3
    left, rules = np.ones(len(x), bool), []
    while len(rules) < MAX_RULES and (bad & left & grow).sum() >= MIN_COVER:
        rule = _grow(x[left & grow], bad[left & grow])
        held = left & ~grow

        def worth(r: list) -> tuple[float, int]:
            on = _covers(x[held], r)
            p, n = (bad[held] & on).sum(), (~bad[held] & on).sum()
            return ((p - n) / (p + n) if p + n else -1.0, int(p))

        while len(rule) > 1:
            shorter = max((rule[:k] for k in range(1, len(rule))), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        on = _covers(x[held], rule) if rule else np.zeros(held.sum(), bool)
        if not rule or on.sum() < MIN_COVER or bad[held][on].mean() < MIN_PRECISION:
            break
        rule = _settle(x[left], bad[left], rule)
        rules.append(rule)
        left &= ~_covers(x, rule)
    return rules


def verdict(rules: list[list[tuple[int, str, float]]]) -> Column:
    """False for the first rule that matches, in order; true if none does."""
    named = list(features().items())
    out = None
    for rule in rules:
        test = reduce(Column.__and__, (named[f][1] > F.lit(t) if op == ">" else named[f][1] <= F.lit(t) for f, op, t in rule))
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def describe(rules: list[list[tuple[int, str, float]]]) -> list[str]:
    names = list(features())
    return ["reject if " + " and ".join(f"{names[f]} {op} {t:.6g}" for f, op, t in rule) for rule in rules]


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> list[list[tuple[int, str, float]]]:
    """Rules learned from at most ``max_labelled`` labelled rows, those of the smallest hashes.

    Rows that fail the base rules are left out, as are labels that are null or given twice
    with different values. Of rows with one id the least text is used. The sample's size bounds what is broadcast and sent to the driver.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id is not null and label is not null")
    marks = marks.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    chosen = marks.orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_labelled).select("id", "label")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")  # an id given many times is one row
    named = features()
    sample = with_stats(rows).where(~base_failed()).select("row.label", *[c.alias(n) for n, c in named.items()]).toPandas()
    if not len(sample):
        return []
    sample = sample.sort_values(list(sample.columns), ignore_index=True)  # the fit does not depend on row order
    return learn_rules(sample[list(named)].to_numpy(float), sample["label"].to_numpy() == 0)


def base_failed() -> Column:
    """Under 50 words, or over half of the words in repeated 3-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(row, STATS, base_failed, kept) for every row of ``docs``, ``row`` with all its columns.

    ``kept``: not base_failed and not rejected by the learned list; without both labels the
    list is empty. Null and empty texts have all statistics 0 and fail. Repeated rows get
    equal verdicts. One pass over the texts, without a shuffle.
    """
    rules = fit_rules(docs, labels, id_col, text_col, label_col, max_labelled)
    return with_stats(docs, text_col).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
