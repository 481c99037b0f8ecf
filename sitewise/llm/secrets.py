"""Secret scans: fixed patterns plus character Markov models, with DataFrame functions only.

Two first-order models over characters, one of random strings and one of ordinary
identifiers, are trained by counting transitions. A token is a secret when the log of
their likelihood ratio is high. Values of the fixed patterns label the random strings;
words that all documents together hold twice or more label the ordinary ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .arrays import between, inner_prefixes, pieces, prefixes

#: Fixed patterns: each kind with its pattern, in the order of ties.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z][A-Za-z0-9+/_=-]{3,}"
#: Characters of the models; all others share one state.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
STATES = len(ALPHABET) + 1
#: Characters that the value of an assignment needs.
MIN_ASSIGNED = 12
#: Distinct labelled secrets, by smallest hash, that train the random model, unless the caller says otherwise.
MAX_SECRETS = 50_000
#: Weight of the single characters in the estimate of a transition.
BACKOFF = 5.0
#: A token is a secret at this log-likelihood ratio a character and in all.
MIN_MEAN, MIN_TOTAL = 0.5, 12.0


def _with_spans(rows: DataFrame, text: str, pattern: str, kind: int, to: str, more: str | None = None) -> DataFrame:
    """Adds (start, kind, end, value) of all leftmost non-overlapping matches, in code points.

    The text between matches comes from the same pattern, so running lengths give places.
    ``more`` is a pattern whose first group needs MIN_ASSIGNED characters for a match to be listed. Linear in the text.
    """
    t = F.col(text)
    on, none = t.rlike(pattern), F.array().cast("array<string>")
    rows = rows.withColumns({"__hit": F.when(on, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none), "__gap": F.when(on, F.split(t, pattern, -1)).otherwise(none)})
    rows = rows.withColumn("__step", F.transform("__hit", lambda v, i: F.length(v) + F.length(F.element_at("__gap", i + 1))))
    rows = rows.withColumn("__inner", inner_prefixes("__step", Column.__add__))
    spans = F.zip_with("__hit", prefixes(F.col("__inner"), Column.__add__), lambda v, e: F.struct(
        (e - F.length(v)).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), v.alias("value")))
    spans = spans if more is None else F.filter(spans, lambda s: F.length(F.regexp_extract(s["value"], more, 1)) >= MIN_ASSIGNED)
    return rows.withColumn(to, spans).drop("__hit", "__gap", "__step", "__inner")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, base, tokens, *keep): spans of the fixed patterns, and tokens to judge: those not wholly inside one such span.

    Spans and tokens are sorted together; a token lies inside a base span exactly when the
    largest end of the spans that start no later reaches its own end.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, text.alias("__text"))
    for pattern, kind, more in ((ASSIGN, 0, ASSIGN), (ACCESS, 1, None), (HEX, 2, None), (TOKEN, 3, None)):
        rows = _with_spans(rows, "__text", pattern, kind, f"__k{kind}", more)
    rows = rows.select("doc_id", *keep, F.array_sort(F.concat("__k0", "__k1", "__k2")).alias("base"), F.col("__k3").alias("tokens"))
    mixed = (F.size("base") > 0) & (F.size("tokens") > 0)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    rows = rows.withColumn("__both", F.when(mixed, F.array_sort(F.concat("base", "tokens"))).otherwise(none))
    rows = rows.withColumn("__step", F.transform("__both", lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)))
    rows = rows.withColumn("__inner", inner_prefixes("__step", F.greatest))
    reach = F.zip_with("__both", prefixes(F.col("__inner"), F.greatest), lambda s, r: F.struct(s.alias("s"), r.alias("r")))
    judged = F.transform(F.filter(reach, lambda x: (x["s"]["kind"] == 3) & (x["r"] < x["s"]["end"])), lambda x: x["s"])
    return rows.withColumn("tokens", F.when(mixed, judged).otherwise(F.col("tokens"))).drop("__both", "__step", "__inner")


def transitions(value: Column) -> Column:
    """Index (previous * STATES + next) of each transition; states are places in ALPHABET, 0 for others."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    pairs = F.arrays_zip(codes.alias("a"), F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))).alias("b"))
    return F.transform(F.filter(pairs, lambda p: p["b"].isNotNull()), lambda p: p["a"] * STATES + p["b"])


def train(scanned: DataFrame, docs: DataFrame, text_col: str = "text", max_secrets: int = MAX_SECRETS) -> list[float]:
    """Log ratios of the transition probabilities, random over ordinary, STATES**2 values.

    Counting runs in Spark; at most 2 * STATES**2 sums reach the driver. A transition falls
    back to the model's single characters, and those to a uniform choice, so the random
    model is uniform where the corpus labels no secret.
    """
    value = F.when(F.col("s.kind") == 0, F.regexp_extract("s.value", ASSIGN, 1)).otherwise(F.col("s.value"))
    secret = (
        scanned.select(F.explode("base").alias("s")).select(value.alias("value")).distinct()
        .orderBy(F.md5("value"), "value").limit(max_secrets).select("value", F.lit(1).cast("long").alias("n"), F.lit(True).alias("random"))
    )
    clear = F.coalesce(F.col(text_col), F.lit(""))
    for pattern in (ASSIGN, ACCESS, HEX):
        clear = F.regexp_replace(clear, pattern, " ")
    words = (
        docs.select(F.explode(F.regexp_extract_all(clear, F.lit(ORDINARY), F.lit(0))).alias("value"))
        .groupBy("value").agg(F.count("*").alias("n")).where("n > 1").withColumn("random", F.lit(False))
    )
    both = secret.unionByName(words).select("random", "n", F.explode(transitions(F.col("value"))).alias("step"))
    counts = {True: [0.0] * STATES**2, False: [0.0] * STATES**2}
    for random, step, n in both.groupBy("random", "step").agg(F.sum("n")).collect():
        counts[random][step] += n
    model = {}
    for random, table in counts.items():
        total = sum(table) + STATES
        single = [(sum(table[b::STATES]) + 1) / total for b in range(STATES)]
        model[random] = [
            (table[a * STATES + b] + BACKOFF * single[b]) / (sum(table[a * STATES:(a + 1) * STATES]) + BACKOFF)
            for a in range(STATES) for b in range(STATES)
        ]
    return [math.log(p / q) for p, q in zip(model[True], model[False])]


def llr(value: Column, ratios: list[float]) -> Column:
    """Sum of the log ratios over the transitions of a string."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    return F.aggregate(transitions(value), F.lit(0.0), lambda s, k: s + F.element_at(table, k + 1))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), max_secrets: int = MAX_SECRETS) -> DataFrame:
    """(doc_id, *keep, base, spans): arrays of (start, kind, end, value) sorted by start, then kind.

    Places are code points, ends exclusive. ``base`` holds the fixed patterns' spans and
    ``spans`` those plus the models'. A token wholly inside a base span is not judged again;
    one that only meets it is, as a whole.
    Null and empty texts have no spans; repeated rows get equal ones.
    """
    scanned = materialize(scan(docs, id_col, text_col, keep), "secret-scan")
    ratios = train(scanned, docs, text_col, max_secrets)
    score = lambda s: llr(s["value"], ratios)
    hit = F.filter("tokens", lambda s: score(s) >= F.greatest(F.lit(MIN_TOTAL), MIN_MEAN * F.length(s["value"])))
    return scanned.select("doc_id", *keep, "base", F.array_sort(F.concat("base", hit)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_redacted(rows: DataFrame, text: str, spans: str, to: str, mark: str = "[SECRET]") -> DataFrame:
    """Adds the text with each span's characters replaced by the mark; spans that overlap become one.

    Spans are sorted by start. Each hides what the ones before it left open, so the text
    kept before a span runs from the largest end so far. Linear in the text; null stays null.
    """
    ends = rows.withColumns({"__pieces": F.when(F.size(spans) > 0, pieces(F.col(text))), "__step": F.transform(spans, lambda s: s["end"])})
    ends = ends.withColumn("__inner", inner_prefixes("__step", F.greatest)).withColumn("__reach", F.concat(F.array(F.lit(0)), prefixes(F.col("__inner"), F.greatest)))
    parts = F.transform(spans, lambda s, i: F.when(
        s["start"] >= F.element_at("__reach", i + 1), F.concat(between(F.col("__pieces"), F.element_at("__reach", i + 1), s["start"]), F.lit(mark))).otherwise(F.lit("")))
    tail = between(F.col("__pieces"), F.element_at("__reach", -1), F.length(text))
    return ends.withColumn(to, F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(F.col(text))).drop("__pieces", "__step", "__inner", "__reach")
