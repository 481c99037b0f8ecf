import hashlib

import numpy as np
import public_tokenizers
import pytest
from helpers import empty_docs, odd_docs

from sitewise.llm import training_order as T
from sitewise.llm.queries import BYTE_TOKENIZER, END_OF_TEXT
from sitewise.shared import new_path

ARGS = (BYTE_TOKENIZER, public_tokenizers.PATTERN, END_OF_TEXT)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097, 100_003])
def test_permutation_is_one_to_one_and_inverts(n):
    slots = T.permute(np.arange(n), n, 5)
    assert sorted(slots.tolist()) == list(range(n))
    assert T.permute(slots, n, 5, inverse=True).tolist() == list(range(n))
    if n > 50:
        assert (slots != T.permute(np.arange(n), n, 6)).mean() > 0.9 and abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.35


def test_shards_read_back(spark, monkeypatch):
    docs = odd_docs(spark)
    path = new_path(spark, "order")
    n = T.write_order(docs, path, *ARGS)
    index = {r.slot: r for r in spark.read.parquet(f"{path}/index").collect()}
    records = {r.slot: bytes(r.record) for r in T.read_order(spark, path).collect()}
    assert sorted(index) == sorted(records) == list(range(n))
    assert all(len(r) == T.STRIDE for r in records.values())
    coder = T._tokenizer(*ARGS[:2])
    by_doc = {}
    for slot, r in index.items():
        by_doc.setdefault(r.doc_id, []).append((r.part, np.frombuffer(records[slot], "<u2")[:r.n_tokens]))
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (2, None)}
    for doc, text in texts.items():
        ids = np.concatenate([a for _, a in sorted(by_doc[doc], key=lambda x: x[0])]).tolist()
        assert ids == [*coder.encode_ordinary(text or ""), END_OF_TEXT]
    assert len([p for p, _ in by_doc[2] if p == 0]) == 2  # repeated rows are sequences of their own
    rest = T.read_order(spark, path, start=n - 3).collect()
    assert sorted(r.slot for r in rest) == [n - 3, n - 2, n - 1]
    assert hashlib.sha256(bytes(rest[0].record)).hexdigest() == hashlib.sha256(records[rest[0].slot]).hexdigest()


def test_empty_table(spark):
    path = new_path(spark, "order")
    assert T.write_order(empty_docs(spark), path, *ARGS) == 0
    assert T.read_order(spark, path).count() == 0
