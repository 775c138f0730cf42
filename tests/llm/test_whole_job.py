"""Cases in which operators once did less than the whole job."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from windrow.llm import chunks, kneser_ney, queries, repeats, suffixes, text

SF_DIR = "/root/testdata/sf0.001"


def words(rng, n, size=5000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def test_one_rare_document_does_not_set_the_rate_of_the_mixture(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, 400)), "en", f"s{i % 2}", 0) for i in range(400)]
    rows[7] = (7, " ".join(words(rng, 400)), "fr", "s0", 0)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = corpus_pipeline.mixture(spark, docs, "").persist()
    n = found.count()
    assert 0.9 * len(rows) < n < 1.1 * len(rows)
    assert 0.2 < found.where("lang = 'fr'").count() / n < 0.35  # 0.2 to 0.5 of English
    assert found.select("doc_id").distinct().count() > 200


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")
def test_registered_language_model_has_trigrams(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    learnt = [(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 10 != 0) for r in rows]
    found = queries.op3_lm_scoring(spark, SF_DIR).select("doc_id", "score").collect()
    want = sorted((w[0], w[5]) for w in brute.kneser_ney(learnt, 3))
    assert sorted(map(tuple, found)) == [pytest.approx(w, rel=1e-9) for w in want]


def test_a_model_that_is_not_kept_takes_no_disk(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(words(rng, 60, 40))) for i in range(40)], "doc_id bigint, text string")
    learn = F.col("doc_id") % 5 != 0
    kept, model = kneser_ney.learn_and_score(docs, learn, order=3, chunk_bytes=3000)
    found, none = kneser_ney.learn_and_score(docs, learn, order=3, chunk_bytes=3000, keep=False)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, kept.collect()))
    kinds = [
        {r["kind"] for m in (1, 2, 3) for r in spark.read.parquet(f"{x.folder}/order={m}").select("kind").collect()}
        for x in (model, none)
    ]
    assert kinds == [{"model", "figures", "answer"}, {"figures", "answer"}]
    with pytest.raises(ValueError):
        kneser_ney.score(docs, none)


def test_words_are_cut_and_lowered_as_bytes_are(spark):
    texts = [" a  B\x0bc\n", "", "  ", "x\x1cY\x85z  W É", "Ab\tab\r\x0cAB", None, "ß"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found, _ = kneser_ney.learn_and_score(docs, F.lit(True), order=2, keep=False)
    got = sorted(map(tuple, found.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()))
    want = brute.kneser_ney([(i, t, True) for i, t in enumerate(texts)], 2)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4:] for g in got] == [pytest.approx(w[4:], rel=1e-9) for w in want]


def test_order_of_numbers_that_differ_in_low_bits_only():
    values = np.array([(1 << 63) + 3, 5, (1 << 63) + 1, 5, (1 << 63) + 2, 0, 5, (1 << 63) + 1], np.uint64)
    assert chunks.in_order(values).tolist() == np.argsort(values, kind="stable").tolist()
    spread = np.random.Generator(np.random.PCG64(1)).integers(0, 2**64, 5000, dtype=np.uint64)
    values = np.concatenate([spread, spread[::-1]])
    assert chunks.in_order(values).tolist() == np.argsort(values, kind="stable").tolist()


def test_ranges_of_several_chunks():
    """A message costs the same whatever it holds, so that a quarter of the ranges has a quarter of the messages."""
    assert [chunks.parts_for(n) for n in (0, 1, 84, 420)] == [1, 1, 84, 320]
    assert [chunks.parts_for(n, repeats.TOGETHER) for n in (0, 1, 84, 420, 25_600)] == [1, 1, 21, 105, 2560]


def test_memory_goes_back_by_bytes_not_by_messages(monkeypatch):
    calls = []
    monkeypatch.setattr(chunks, "give_back", lambda: calls.append(1))
    batch = chunks.messages(1, list(range(1000)), [b"x" * 2000] * 1000)
    assert [row["part"] for row in chunks.each(iter([batch]))] == list(range(1000))
    assert 1 <= len(calls) <= 3


def test_matches_below_the_least_length_are_not_measured():
    data = np.frombuffer(b"abcdeXabcdeYabcdf", np.uint8)
    at, document = np.array([0, 6, 12]), np.array([1, 2, 3])
    assert suffixes.longest_previous(data, at, document, 5).tolist() == [0, 5, 4]
    assert suffixes.longest_previous(data, at, document, 5, 5).tolist() == [0, 5, 0]


def test_texts_as_a_list():
    import pyarrow as pa

    for texts in ([], [""], ["a", "", "bc"], ["é", "", "x😀", "ß"]):
        array = pa.array(["zé", *texts, "ü"], pa.string())
        assert text.listed(array) == ["zé", *texts, "ü"] and text.listed(array.slice(1, len(texts))) == texts
    with pytest.raises(ValueError):
        text.listed(pa.array(["a", None]))
