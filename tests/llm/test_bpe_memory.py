"""The BPE stage of the pipeline keeps little in a worker between groups and tasks."""

import public_tokenizers
import pyarrow as pa

import corpus_pipeline as cp
from sitewise.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def letters(n):
    return "".join(chr(97 + n // 26**i % 26) for i in range(4))


def test_words_kept_are_few_and_ids_do_not_depend_on_it():
    plain, lean = bpe.WordBpe(PATH), bpe.WordBpe(PATH)
    lean.max_words = 50
    for k in range(40):
        texts = [f"the same words again {letters(20 * k + i)} Zürich 東京 {i * k}" for i in range(20)] + [None, ""]
        assert lean.encode_texts(texts) == plain.encode_texts(texts)
        # Both tables hold at most the limit and one group each.
        assert len(lean.word_ids) + len(lean.old_ids) <= 2 * (50 + 40)
        assert lean.cached_chars == sum(map(len, lean.word_ids))
    assert "again" in lean.word_ids and len(plain.word_ids) > 800


def test_lean_task_gives_the_model_back():
    batch = pa.RecordBatch.from_pydict({"doc_id": [7, None, 2**60 + 1], "text": ["One text, two", None, "x" * 300]})
    bpe._loaded.clear()
    plain = list(bpe._encoded(iter([batch]), PATH, False))
    assert PATH in bpe._loaded
    lean = list(bpe._encoded(iter([batch]), PATH, True))
    assert not bpe._loaded and pa.Table.from_batches(lean).equals(pa.Table.from_batches(plain))


def test_stage_keeps_large_ids_beside_null_ones(spark):
    docs = spark.createDataFrame([(2**60 + 1, "One text, two"), (None, "no id"), (3, None), (4, "")], "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r.n_tokens for r in cp.bpe_tokens(spark, docs, "").collect()}
    assert set(rows) == {2**60 + 1, None, 3, 4} and rows[2**60 + 1] > 0 and rows[3] == rows[4] == 0
