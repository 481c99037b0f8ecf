"""Chat formatting with DataFrame expressions only.

A conversation is written as blocks. A block has one role header and the texts of all
adjacent turns of that role, each between turn marks::

    ### user:
    <turn>first text</turn>
    <turn>second text</turn>
    ### assistant:
    <turn>answer</turn>

Inside roles and texts ``\\``, ``<`` and ``#`` are escaped as ``\\b``, ``\\l`` and ``\\h``, so
no mark can occur there and the output reads back to exactly the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import between, blocks, inner_prefixes, let, pieces, prefixes

BLOCK, HEADER_END, TURN, TURN_END = "### ", ":\n", "<turn>", "</turn>\n"
#: Fixed escape pairs, in the order of escaping; the backslash comes first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", train_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation, null ids together.

    Turns are sorted by (turn, role, text), null turns first; repeated rows stay. A null
    role or text is empty. ``loss_spans`` holds (start, end), 0-based code points, of each
    text of ``train_role``. No turns give no rows. Other columns are ignored.
    """
    piece = F.struct(F.col(turn_col).alias("turn"), _text(F.col(role_col)).alias("role"), _text(F.col(text_col)).alias("text"))
    grouped = turns.select(F.col(conv_col).alias("conv_id"), piece.alias("p")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("p")).alias("turns"))
    runs = grouped.select("conv_id", merged_runs("turns").alias("runs"))
    written = runs.select("conv_id", F.transform("runs", lambda r: F.struct(
        F.concat(F.lit(BLOCK), escape(r["role"]), F.lit(HEADER_END)).alias("head"), (r["role"] == train_role).alias("loss"),
        F.transform(r["texts"], escape).alias("texts"))).alias("runs"))
    # Lengths of the head before each text, with the turn mark, and of the text itself.
    marks = F.flatten(F.transform("runs", lambda r: F.transform(r["texts"], lambda t, i: F.struct(
        (F.when(i == 0, F.length(r["head"])).otherwise(0) + len(TURN)).alias("head"), F.length(t).alias("body"), r["loss"].alias("loss")))))
    placed = written.select("conv_id", "runs", marks.alias("marks"))
    placed = placed.withColumn("steps", F.transform("marks", lambda m: m["head"] + m["body"] + len(TURN_END)))
    placed = placed.withColumn("inner", inner_prefixes("steps", Column.__add__))
    ends = prefixes(F.col("inner"), Column.__add__)
    spans = F.zip_with("marks", ends, lambda m, e: F.struct((e - len(TURN_END) - m["body"]).alias("start"), (e - len(TURN_END)).alias("end"), m["loss"].alias("loss")))
    body = F.transform("runs", lambda r: F.concat(r["head"], F.array_join(F.transform(r["texts"], lambda t: F.concat(F.lit(TURN), t, F.lit(TURN_END))), "")))
    return placed.select(
        "conv_id", F.array_join(body, "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
    )


def merged_runs(turns: str) -> Column:
    """Sorted turns as runs of one role: an array of (role, texts). Runs are merged inside blocks of turns, then the blocks' ends."""
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(runs: Column, more: Column, role: Column, texts: Column) -> Column:
        """``runs`` with (role, texts) put into the last run if that has the role, then ``more`` behind it."""
        last = F.element_at(runs, -1)
        merges = (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["role"] == role)
        joined = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(role.alias("role"), F.concat(last["texts"], texts).alias("texts"))))
        return F.concat(F.when(merges, joined).otherwise(F.concat(runs, F.array(F.struct(role.alias("role"), texts.alias("texts"))))), more)

    inner = F.transform(blocks(turns), lambda b: F.aggregate(b, empty, lambda s, t: add(s, empty, t["role"], F.array(t["text"]))))
    return F.aggregate(inner, empty, lambda s, b: add(s, F.slice(b, F.lit(2), F.greatest(F.size(b) - 1, F.lit(0))), F.element_at(b, 1)["role"], F.element_at(b, 1)["texts"]))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), unescaped."""
    blocks_of = F.filter(F.split(formatted, BLOCK), lambda b: b != "")

    def of_block(block: Column) -> Column:
        fields = F.split(block, TURN)
        parts = let(fields, lambda f: F.struct(F.element_at(f, 1).alias("head"), F.slice(f, F.lit(2), F.size(f) - 1).alias("texts")))
        named = let(parts, lambda p: F.struct(
            unescape(F.substring(p["head"], F.lit(1), F.length(p["head"]) - len(HEADER_END))).alias("role"), p["texts"].alias("texts")))
        return let(named, lambda n: F.transform(n["texts"], lambda t: F.struct(
            n["role"].alias("role"), unescape(F.substring(t, F.lit(1), F.length(t) - len(TURN_END))).alias("text"))))

    return F.flatten(F.transform(blocks_of, of_block))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between.

    Spans hold whole texts, so they can be cut out escaped and unescaped together.
    """
    return let(pieces(formatted), lambda p: unescape(F.array_join(F.transform(spans, lambda s: between(p, s["start"], s["end"])), "")))
