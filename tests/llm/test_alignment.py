"""Alignment of two tokenizers against the libraries and plain loops over all pairs of tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from windrow.llm import alignment, bpe

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens(rows):
    """For each row: tokens of both sides as (id, bytes), or none."""
    library, pieces = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    library.encode_special_tokens = True
    letters = bpe.byte_letters()
    entry = {i: bytes(letters[c] for c in t) for t, i in library.get_vocab().items() if t != "<|endoftext|>"}
    out = []
    for _, text in rows:
        a = [(i, entry[i]) for i in library.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = []
        for i in pieces.encode(text or ""):
            piece = pieces.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + (text or "")).encode()
        fits = text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b)
        out.append((a, b) if fits else ([], []))
    return out


def plain(rows):
    sides = tokens(rows)
    linked, grouped = [], []
    for a, b in sides:
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, data in side:
                found.append((i, at, at + len(data)))
                at += len(data)
            spans.append(found)
        links, low = [], 0
        for k, (i, s, e) in enumerate(spans[0]):
            while low < len(b) and spans[1][low][2] <= s:
                low += 1
            j = low
            while j < len(b) and spans[1][j][1] < e:
                links.append((k, j, i, spans[1][j][0]))
                j += 1
        linked.append(links)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in spans))
            begin = end
        grouped.append(groups)
    count = Counter(pair for links in linked for pair in {x[2:] for x in links})
    best = {}
    for (i, _), n in count.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for (key, _), (a, b), links, groups in zip(rows, sides, linked, grouped):
        n_best = sum(count[x[2:]] == best[x[2]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((key, len(a), len(b), len(groups), len(links), n_best, sum(count[x[2:]] for x in links), digest))
    return out, linked, grouped


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    parts = [
        *("the", " cat", "ing", " ", "  ", "\n", "\t", "é", " 汉字", "12", "!", "'s", "x" * 40, "\x85", "<|endoftext|>", "</s>"),
        *("😀", "\x00", "tokenization", " Straße", " naïve", "ー", "　", "​"),
    ]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(120)]
    texts += ["", None, " ", "a ▁ b", "▁", "word " * 3000, "x" * 3000, *["same text, many times"] * 30, "<|endoftext|>"]
    found = list(enumerate(texts)) + [(None, "no key"), (3, texts[3]), (3, "other")]
    rng.shuffle(found)
    return found


@pytest.fixture(scope="module")
def documents(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return table.select("*", *[F.lit("own").alias(c) for c in ("chunk", "rows", "asked", "part", "data", "start", "document", "_key")])


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("batch_bytes", [500, alignment.BATCH_BYTES])
def test_alignment_of_all_pairs(documents, rows, batch_bytes, monkeypatch):
    monkeypatch.setattr(alignment, "MOST_HELD", 40)
    found = alignment.align(documents, FIRST, SECOND, batch_bytes=batch_bytes)
    assert found.columns == ["doc_id", *FIGURES]
    assert ordered(map(tuple, found.collect())) == ordered(plain(rows)[0])


def test_overlaps_and_groups(documents, rows):
    few = documents.where("doc_id <> 3")
    own = [r for r in rows if r[0] is not None and r[0] != 3]
    _, linked, grouped = plain(own)
    found = {}
    for r in alignment.overlaps(few, FIRST, SECOND, batch_bytes=2000).collect():
        found.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert {i: sorted(x) for i, x in found.items()} == {key: sorted(x) for (key, _), x in zip(own, linked) if x}
    texts = {r["doc_id"]: (r["n_groups"], r["groups"]) for r in alignment.groups(few, FIRST, SECOND).collect()}
    assert texts == {key: (len(g), ";".join(g)) for (key, _), g in zip(own, grouped)}


def test_nothing_to_align(spark, documents):
    assert alignment.align(documents.limit(0), FIRST, SECOND).count() == 0
    table = spark.createDataFrame([("a", None), ("b", ""), ("c", "▁")], "doc_id string, text string")
    assert {tuple(r)[1:] for r in alignment.align(table, FIRST, SECOND).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    assert alignment.overlaps(table, FIRST, SECOND).count() == 0
