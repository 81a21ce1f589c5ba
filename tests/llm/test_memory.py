"""What a Python worker holds at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from metroflux.llm import common
from tests.llm.fixtures import frame

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("words", [common.RAW_WORDS, common.LOWER_WORDS, common.ALNUM_WORDS])
def test_a_words_hash_does_not_depend_on_its_piece(monkeypatch, words):
    data = np.random.default_rng(0).choice(np.frombuffer(b"abcXYZ1. \n", np.uint8), 5000)
    data[700:2600] = ord("q")  # longer than a piece
    offsets = np.array([0, 10, 10, 1500, 4000, 5000])
    want = common.word_hashes(data, offsets, words)
    for size in (1, 7, 1000):
        monkeypatch.setattr(common, "PIECE_BYTES", size)
        for a, b in zip(want, common.word_hashes(data, offsets, words), strict=True):
            assert (a == b).all()


def test_hashing_a_block_holds_little_more_than_its_words():
    data = np.random.default_rng(0).choice(np.frombuffer(b"abcdef ", np.uint8), common.BLOCK_BYTES)
    common._powers.clear()
    tracemalloc.start()
    common.word_hashes(data, np.array([0, len(data)]), common.RAW_WORDS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * common.BLOCK_BYTES


@pytest.mark.parametrize(("stage", "module", "call"), [
    ("language_id", corpus_pipeline.langid, "keep_identified"), ("exact_dedup", corpus_pipeline.exact_dedup, "drop_exact_duplicates"),
    ("ngram_jaccard_join", corpus_pipeline.ngram_join, "drop_near_duplicates"), ("decontamination", corpus_pipeline.decontaminate, "drop_contaminated"),
    ("byte_bpe", corpus_pipeline.bpe, "round_trip")])
def test_pipeline_stages_hand_python_small_batches(spark, monkeypatch, stage, module, call):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    docs = frame(spark, [(i, str(i) + " x" * 250_000) for i in range(30)]).coalesce(1)
    monkeypatch.setattr(corpus_pipeline.langid, "train", lambda *a: None)
    monkeypatch.setattr(module, call, lambda docs, *a, **k: docs.select("doc_id", "text").mapInArrow(sizes, "rows long, bytes long"))
    spark.conf.unset(BATCH)
    try:
        got = dict(corpus_pipeline.STAGES)[stage](spark, docs, "/root/testdata/sf0.01").collect()
    finally:
        spark.conf.unset(BATCH)
    assert sum(r.rows for r in got) == 30 and max(r.bytes for r in got) < 5_000_000
