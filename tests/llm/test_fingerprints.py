"""Fingerprints: whole texts, edit distance and the order of documents."""

import hashlib
import random

from helpers import empty_docs, odd_docs

from sitewise.llm import fingerprints, queries


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_closeness_is_the_edit_distance():
    rng = random.Random(2)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 60)))
        b = a[:rng.randrange(60)] + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 30)))
        shared = max((n for n in range(len(a) + 1) if any(a[i:i + n] in b for i in range(len(a) - n + 1))), default=0)
        want = 2 * lcs(a, b) / (len(a) + len(b)) if shared >= min(7, (min(len(a), len(b)) + 1) // 2) else 0.0
        assert abs(fingerprints.likeness(f"1:{a}:", f"1:{b}:") - (1.0 if a == b else want)) < 1e-12


def test_whole_text_counts_and_sizes_stay_bounded():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(50_000)).encode()
    prints = [fingerprints.fingerprint(t) for t in (text, text[:-1] + b"#", b"#" + text[1:], text[:150_000] + b"#" + text[150_001:])]
    assert len(set(prints)) == 4 and all(fingerprints.likeness(prints[0], p) > 0.9 for p in prints[1:])
    for t in (b"a", b"a" * 100_000, b"ab" * 5_000, bytes(range(256)) * 40, text):
        _, one, two = fingerprints.fingerprint(t).split(":")
        assert 1 <= len(one) <= 64 and len(two) <= 64


def test_block_sizes_must_meet():
    assert fingerprints.likeness("4:abcdefgh:abcd", "8:abcd:ab") == 1.0
    assert fingerprints.likeness("4:abcdefgh:abcd", "64:abcdefgh:abcd") == 0.0
    assert fingerprints.likeness("1::", "1::") == 1.0 and fingerprints.likeness("1::", "1:a:a") == 0.0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        new = t[:len(t) - cut] + nxt[:cut]
        p, e, n = (fingerprints.fingerprint(x.encode()) for x in (t, new, nxt))
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), p, e, fingerprints.likeness(p, e), fingerprints.likeness(p, n)))
    return out


def test_registered_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(5)
    words = [f"wö{i}" for i in range(300)]
    rows = [(k * 3, " ".join(rng.choices(words, k=rng.randrange(1, 300)))) for k in range(300)]
    rows += [(k * 3 + 1, rows[k][1]) for k in range(0, 60, 2)] + [(901, None), (902, ""), (904, "ab"), (None, "x" * 500)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_fingerprints(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    copies = {r[0]: r for r in got}
    assert all(copies[k * 3][3] == copies[k * 3 + 1][3] and copies[k * 3 + 1][6] == 1.0 for k in range(0, 60, 2))
    near = sorted(r[5] for r in got if r[1] > 300)
    assert near[len(near) // 20] > 0.5


def test_one_row_odd_rows_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    r, = fingerprints.compare_with_next(one).collect()
    assert (r.edited_sha256, r.near_next) == (hashlib.sha256(b"abcdab").hexdigest(), 1.0)
    docs = odd_docs(spark)
    assert fingerprints.compare_with_next(docs).count() == docs.count()
    assert fingerprints.compare_with_next(empty_docs(spark)).count() == 0


def test_columns_are_added(spark):
    docs = fingerprints.with_fingerprint(odd_docs(spark)).withColumn("other", fingerprints.F.lit("1::"))
    got = fingerprints.with_likeness(docs, "fingerprint", "other").where("doc_id IN (1, 3, 4)").collect()
    assert sorted((r.doc_id, r.likeness) for r in got) == [(1, 0.0), (3, 1.0), (4, 1.0)]
