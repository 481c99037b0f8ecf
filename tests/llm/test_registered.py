"""Registered queries of op3 and op8 and the pipeline's rows against plain loops, on tables that hold what they look for."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
from helpers import odd_docs
from test_vectors import brute, near
from tokenizers import Tokenizer

from sitewise.llm import minhash, mixing, queries
from sitewise.llm import training_order as T
from sitewise.shared import materialize

SF = "/root/testdata/sf0.001"


def test_op8_finds_planted_links(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows, k = [], 0
    for size in (2, 3, 5, 40):
        v = rng.normal(size=64)
        v /= np.linalg.norm(v)
        for c in rng.uniform(0.97, 1.0, size):
            rows.append((k, (near(rng, v, c) * rng.uniform(0.5, 3)).tolist()))
            k += 1
    rows += [(k + i, rng.normal(size=64).tolist()) for i in range(150)] + [(900, None), (901, [0.0] * 64)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op8_embedding_near_dup(spark, str(tmp_path)).collect()}
    want = {i: (n, c, i == c) for i, n, c in brute(rows)}
    assert got == want and sum(n for n, _, _ in got.values()) > 1000


def test_op3_holds_every_sequence_once(spark, tmp_path):
    docs = odd_docs(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_training_order(spark, str(tmp_path)).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    coder = T._tokenizer(queries.BYTE_TOKENIZER, public_tokenizers.PATTERN)
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    want = Counter()  # whole texts, each row with one mark of its end
    for r in docs.collect():
        want[r.doc_id] += len(coder.encode_ordinary(r.text or "")) + 1
    assert tokens == want and all(0 < r.n_tokens <= 512 for r in got)
    assert len({(r.doc_id, r.part, r.slot) for r in got}) == len(got)


BASE = [
    re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})"""), re.compile(r"(AKIA[A-Z0-9]{14,})"), re.compile(r"((?<![0-9a-f])[0-9a-f]{16,})")]


def test_pipeline_rows_follow_from_each_stage(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, d = {}, docs
    for name, stage in cp.STAGES:
        d = materialize(stage(spark, d, SF), f"test-{name}")
        out[name] = d
    ids = lambda name: sorted(r.doc_id for r in out[name].select("doc_id").collect())
    kept = sorted(r.doc_id for r in queries.op2_quality_rules(spark, SF).where("kept").collect())
    assert ids("quality_rules") == kept
    # Near copies: one row of each class, and by brute force no two left are alike and none gone without a like.
    first = {r.doc_id: r.text for r in out["quality_rules"].collect()}
    left = set(ids("near_dedup"))
    assert sorted(left) == sorted(r.doc_id for r in minhash.near_duplicates(out["quality_rules"]).where("kept").collect())
    grams = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t in first.items() if (w := (t or "").encode().split())}
    alike = lambda a, b: len(grams[a] & grams[b]) / len(grams[a] | grams[b])
    for a in left & grams.keys():
        assert all(a >= b or alike(a, b) < 0.9 for b in left & grams.keys())
    assert all(any(alike(a, b) > 0.6 for b in grams if b != a) for a in set(grams) - left)
    for r in out["secret_scan"].collect():
        assert not any(p.search(r.text or "") for p in BASE) and r.n_chars == len(r.text or "")
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.mix(out["secret_scan"]).collect() if r["size"]}
    assert Counter(ids("source_mix")) == Counter({i: n for i, n in taken.items() if n})
    lib = Tokenizer.from_file(cp.TOKENIZER)
    want = Counter()
    for r in out["source_mix"].collect():
        e = lib.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()] += 1
    final = cp.run(spark, SF)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in final.collect()) == want
