"""The filter audit against plain counting, with files in orders that make masks change."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from windrow.llm import interactions

SCHEMA = "doc_id bigint, text string, source string"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_masks(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, source in rows:
        text = t or ""
        words = WORD.findall(text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if i is not None and i > least[text] else set()
        out.append((source or "", fails, i))
    return out


def plain(rows, labels):
    """Every row of the audit, by going through all documents in every order."""
    masks, out = plain_masks(rows), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = sorted({m[0] for m in masks})
    shapley = {(p, x): 0 for p in parts for x in "ABCDE"}
    for order in map("".join, permutations("ABCDE")):
        for part in parts:
            left = [m for m in masks if m[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                removed = [m for m in left if x in m[1]]
                left = [m for m in left if x not in m[1]]
                shapley[part, x] += len(removed)
                out[part, order, step] = [
                    len(left), len(removed), sum(x in m[1] for m in gone),
                    sum(m[1] == {x} for m in masks if m[0] == part),
                    sum(m[2] in good for m in removed), sum(m[2] in toxic for m in removed), x,
                ]
                gone += removed
    return {k: (*v[:-1], shapley[k[0], v[-1]]) for k, v in out.items()}


def found(frame):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[m] for m in MEASURES) for r in frame.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 150, 230, 300]))) for _ in range(25)]
    base += ["W " * 220, "# " * 3, "", " \t\n", "a|b " * 210, "É" * 50 + " x", "word\x85word " * 250, "x" * 100_000]
    texts = [rng.choice(base) for _ in range(150)] + [base[0]] * 60 + [None, None]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    out = [(i, t, rng.choice(["hot", "hot", "a", None, ""])) for i, t in zip(ids, texts)]
    out += [(None, base[0], "a"), (None, "own", None), (out[0][0], out[0][1], "a"), (out[1][0], "another text", "hot")]
    return out


@pytest.fixture(scope="module")
def labels():
    rng = random.Random(2)
    out = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 2)]
    return out + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (10_000, 1, 1)]


def write(spark, rows, path, n_files):
    """Files that are read in the order they were written, each with a time of its own."""
    import glob
    import os

    for number in range(n_files):
        part = spark.createDataFrame(rows[number::n_files], SCHEMA).coalesce(1).withColumn("part", F.lit(3)).withColumn("n", F.lit("x"))
        part.write.mode("append").parquet(str(path))
        for file in glob.glob(f"{path}/*.parquet"):
            if os.path.getmtime(file) > 1e9 + n_files:
                os.utime(file, (1e9 + number, 1e9 + number))
    return str(path)


@pytest.mark.parametrize(("order", "together"), [("falling", 1), ("shuffled", 64)])
def test_audit_in_any_order_of_files(spark, rows, labels, tmp_path, monkeypatch, order, together):
    monkeypatch.setattr(interactions, "TEXTS_TOGETHER", together)
    # Falling ids: every file brings smaller ids than all before.
    dealt = sorted(rows, key=lambda r: -(r[0] or 0)) if order == "falling" else rows
    n, size = 5, -(-len(rows) // 5)
    dealt = [dealt[i * size + k] for k in range(size) for i in range(n) if i * size + k < len(dealt)] if order == "falling" else dealt
    path = write(spark, dealt, tmp_path / "documents", n)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = found(interactions.audit(spark, path, table, micro_batches=5))
    want = plain(rows, labels)
    assert got == want
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_counters_go_on_in_the_same_folder(spark, rows, labels, tmp_path):
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    late, early = sorted(rows, key=lambda r: r[0] or 0)[100:], sorted(rows, key=lambda r: r[0] or 0)[:100]
    path, folder = write(spark, late, tmp_path / "documents", 2), f"file://{tmp_path}/run"
    options = {"folder": folder, "micro_batches": 2}
    assert found(interactions.audit(spark, path, table, **options)) == plain(late, labels)
    before = interactions.mask_counters(spark, path, table, **options).count()
    assert interactions.mask_counters(spark, path, table, **options).count() == before
    spark.createDataFrame(early, SCHEMA).withColumn("part", F.lit(3)).withColumn("n", F.lit("x")).write.mode("append").parquet(path)
    assert found(interactions.audit(spark, path, table, **options)) == plain(rows, labels)


def test_own_filters_and_empty_tables(spark, tmp_path):
    rows = [(1, "a b", "s"), (2, "a b", "s"), (3, "c", "s")]
    path = write(spark, rows, tmp_path / "few", 1)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = found(interactions.audit(spark, path, none, filters={"S": lambda m: m[0] < 2}))
    assert got["s", "SE", 1][:3] == (2, 1, 0) and got["s", "SE", 2][:3] == (1, 1, 0) and len(got) == 4
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none"))
    assert interactions.audit(spark, str(tmp_path / "none"), none).count() == 0
