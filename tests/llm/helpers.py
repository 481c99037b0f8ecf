"""Small tables with the odd cases every operator must handle."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, kept string, row string"
BASE = " ".join(f"word{i % 97}x{i}" for i in range(120))


def odd_docs(spark, more=()):
    rows = [
        (1, BASE), (2, BASE), (2, BASE), (3, None), (4, ""), (5, " \t\n "), (None, BASE + " tail"), (None, None),
        (6, "one"), (7, "x" * 3000), (8, "ñandú 漢字 🙂 " * 30), (9, " ".join(f"long{i}" for i in range(20_000))), *more,
    ]
    return spark.createDataFrame(
        [(i, t, "en", None if k % 3 == 0 else f"s{k % 3}", len(t or ""), k, "clash", "clash") for k, (i, t) in enumerate(rows)], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
