"""What Python workers keep and hold at a time is bounded."""

import random
import tracemalloc

import corpus_pipeline
import numpy as np
import pytest
import xxhash

from landfall.llm import common, pieces

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_word_hashes_keep_nothing():
    common.word_hashes([b"first"])
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for part in range(10):
            words = [b"%d-%d" % (part, i) for i in range(5_000)] * 2
            found = common.word_hashes(words)
            assert found[0] == found[5_000] == xxhash.xxh3_64_intdigest(words[0])
        del words, found
        assert tracemalloc.get_traced_memory()[0] - before < 100_000
    finally:
        tracemalloc.stop()
    assert common.word_hashes([]).dtype == np.uint64


def test_pieces_forget_rare_segments_first(monkeypatch):
    vocabulary = pieces.load_vocabulary()
    monkeypatch.setattr(pieces, "REMEMBERED", 400)
    encoder, rng = pieces.Encoder(vocabulary), random.Random(3)
    made = lambda n: "".join(rng.choices("abcdefghé漢", k=n))
    often = [made(6) for _ in range(50)]
    texts = [" ".join([*often, *(made(rng.randint(5, 60)) for _ in range(60)), ""]) for _ in range(40)]
    found = []
    for text in texts:
        found.append(encoder.encode(text))
        assert len(encoder.seen) <= 400 + 2 * 111
        assert len(encoder.seen) == len(encoder.met) == len(encoder.totals) == len(encoder.paths.lengths)
        assert all(" " + word in encoder.seen for word in often)
        assert encoder.decode(found[-1][0]) == text
    before = set(encoder.seen)
    encoder.forget_rare()
    assert len(encoder.seen) <= 200 and {" " + word for word in often} <= set(encoder.seen) < before
    for text, (ids, score) in zip(texts, found, strict=True):
        fresh = pieces.Encoder(vocabulary) if text is texts[0] else fresh
        fresh.forget()
        again = fresh.encode(text)
        assert again[0] == ids and again[1] == pytest.approx(score)


def test_stages_send_small_batches(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(f"word{j * i % 97}" for j in range(60)), "en", "a", 1) for i in range(20)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    before = spark.conf.get(BATCH)
    try:
        spark.conf.set(BATCH, "10000")
        corpus_pipeline.secret_scans(spark, docs, "")
        assert spark.conf.get(BATCH) == str(common.BATCH_ROWS)
        spark.conf.set(BATCH, "7")
        seven = sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect()))
        assert spark.conf.get(BATCH) == "7"
        spark.conf.set(BATCH, "-1")
        assert sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect())) == seven
        assert spark.conf.get(BATCH) == str(common.BATCH_ROWS)
    finally:
        spark.conf.set(BATCH, before)
