"""SentencePiece encoding and decoding against the library."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from windrow.llm import sentence_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    *("a", "ing", " ", "  ", "\n", "\t", "é", "汉字", "▁", "12", "!", "'s", "x" * 90, "\x85", "\x1c", "͸", "<s>", "</s>"),
    *("<0x41>", "the", "tion", "😀", "\x00", "  the", "ー", "​", "﻿", "　"),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(200)]
    texts += ["", None, " ", "▁", " " * 100, "ab" * 5000, "word " * 4000, " lead", "trail ", *["again and again"] * 40]
    found = list(enumerate(texts)) + [(None, "no key"), (None, None), (5, texts[5]), (5, "other text, same key")]
    rng.shuffle(found)
    return found


@pytest.fixture(scope="module")
def documents(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return table.select("*", *[F.lit("own").alias(c) for c in ("chunk", "rows", "words", "part", "data", "ids", "_key", "_text")])


@pytest.mark.parametrize("block_bytes", [700, sentence_pieces.BLOCK_BYTES])
def test_ids_and_texts_are_the_librarys(documents, rows, library, block_bytes):
    found = sentence_pieces.round_trip(documents, PATH, block_bytes=block_bytes).collect()
    want = [(i, library.encode(t or "", add_eos=True)) for i, t in rows]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted([(r["doc_id"], r["ids"]) for r in found], key=order) == sorted(want, key=order)
    assert all(r["decoded"] == library.decode(r["ids"]) for r in found)


def test_encode_without_end_then_decode(spark, documents, rows, library):
    encoded = sentence_pieces.encode(documents.where("doc_id <> 5"), PATH, end=False)
    assert encoded.columns == ["doc_id", "ids"]
    own = dict(rows)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {
        i: library.encode(t or "") for i, t in own.items() if i is not None and i != 5
    }
    texts = {r["doc_id"]: r["text"] for r in sentence_pieces.decode(encoded, PATH).collect()}
    assert all(t == library.decode(library.encode(own[i] or "")) for i, t in texts.items())
    none = spark.createDataFrame([("k", None), (None, [])], "doc_id string, ids array<int>")
    assert sorted(r["text"] for r in sentence_pieces.decode(none, PATH).collect()) == ["", ""]


def test_empty_table_and_text_keys(spark, documents, library):
    assert sentence_pieces.round_trip(documents.limit(0), PATH).count() == 0
    table = spark.createDataFrame([("a", "x y")], "doc_id string, text string")
    assert sentence_pieces.encode(table, PATH).first()["ids"] == library.encode("x y", add_eos=True)


def test_decoding_of_any_ids(library):
    pieces = sentence_pieces.Pieces(open(PATH, "rb").read())
    rng = random.Random(9)
    some = lambda: rng.choice([rng.randrange(32000), rng.randrange(300), 0, 1, 2, 28705, 259])
    rows = [[some() for _ in range(rng.randrange(9))] for _ in range(4000)]
    flat = np.array([x for row in rows for x in row], np.int32)
    bounds = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
    assert pieces.decode(flat, bounds).to_pylist() == [library.decode(row) for row in rows]
    with pytest.raises(ValueError, match="vocabulary"):
        pieces.decode(np.array([32000], np.int32), np.array([0, 1]))


def test_chunks_are_distinct_and_in_place():
    texts = ["a b  c a", "", None, " a", "a ", "▁a", "b"]
    words, index, counts = sentence_pieces.cut(pa.array(texts, pa.string()))
    words = words.to_pylist()
    assert len(words) == len(set(words)) and counts.tolist() == [4, 0, 0, 1, 2, 1, 1]
    assert [words[i] for i in index] == ["a", "b", " c", "a", " a", "a", "", " a", "b"]


def test_long_chunks_are_merged_as_short_ones(library):
    pieces = sentence_pieces.Pieces(open(PATH, "rb").read())
    rng = random.Random(4)
    words = ["".join(rng.choices("aeinrst ", k=n)).strip() for n in (60, 64, 65, 200, 3000)]
    words = [w.replace(" ", "") for w in words]
    ids, count = pieces.segment(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [library.encode(w) for w in words]
