import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.functions import vectors as V
from windrow.functions.hashing import hash_unit, hash_vector, hash_vectors
from windrow.operators import arrow_examples, features, lookup
from windrow.operators.windows import blocks_from_arrays


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def array(numbers):
    return F.array(*[F.lit(float(x)) for x in numbers]).cast("array<double>")


def code(position, width, per_slot=2.0):
    out = []
    for j in range(0, width, 2):
        angle = position / 10000 ** (per_slot * j / width)
        out += [math.sin(angle), math.cos(angle)]
    return out


def test_position_code(spark):
    assert value(spark, V.position_code(F.lit(0), 4)) == [0, 1, 0, 1]
    for p in (1, 5):
        want = [math.sin(p), math.cos(p), math.sin(p / 10000), math.cos(p / 10000)]
        assert value(spark, V.position_code(F.lit(p), 4)) == pytest.approx(want, abs=1e-15)
    assert value(spark, V.position_code(F.lit(3), 16, published=True)) == pytest.approx(code(3, 16, 1.0))
    with pytest.raises(ValueError):
        V.position_code(F.lit(1), 3)


@pytest.mark.parametrize("published", [False, True])
def test_position_code_far_out(spark, published):
    at = 1 << 40  # a power that is off in its last bit moves an angle by far more than the bound
    want = code(at, 64, 1.0 if published else 2.0)
    assert value(spark, V.position_code(F.lit(at), 64, published)) == pytest.approx(want, abs=1e-12)


def test_window_codes_are_the_rows_of_position_codes(spark):
    flat = spark.range(1).select(V.window_codes(spark, 3, 4).alias("c")).first()["c"]
    rows = V.position_codes(spark, 3, 4).orderBy("position").collect()
    assert flat == [x for r in rows for x in r["code"]]


def test_add_needs_equal_width(spark):
    assert value(spark, V.add(array([1, 2]), array([3, 4]))) == [4, 6]
    with pytest.raises(Exception, match="different width"):
        value(spark, V.add(array([1, 2]), array([3])))


def test_fit_width(spark):
    numbers = [float(i + 1) for i in range(138)]
    assert value(spark, V.fit_width(array(numbers), 128)) == numbers[:128]
    assert value(spark, V.fit_width(array(numbers[:59]), 64)) == numbers[:59] + [0.0] * 5
    assert value(spark, V.fit_width(array(numbers[:64]), 64)) == numbers[:64]
    assert value(spark, V.fit_width(array([]), 3)) == [0.0] * 3


def test_hash_vector_depends_on_token_and_seed_only(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "token string")
    rows = [r["v"] for r in df.select(hash_vector("token", 6).alias("v")).collect()]
    assert rows[0] == rows[2] != rows[1]
    assert all(len(v) == 6 and all(0 <= x < 1 for x in v) for v in rows)
    assert value(spark, hash_vector(F.lit("a"), 4, seed=1)) != rows[0][:4]
    assert value(spark, hash_vector(F.lit("a"), 2)) == rows[0][:2]


def test_hash_unit_is_uniform_enough(spark):
    u = spark.range(20000).select(hash_unit(1, "id").alias("u"))
    mean, low, high = u.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(mean - 0.5) < 0.01 and 0 <= low < 0.001 and 0.999 < high < 1


def test_last_vector_wins(spark):
    rows = [(0, 1, [1.0, 1.0]), (1, 2, [2.0, 2.0]), (2, 1, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "at int, token int, embedding array<double>")
    found = {r["token"]: r["embedding"] for r in lookup.last_vectors(df, "at").collect()}
    assert found == {1: [3.0, 3.0], 2: [2.0, 2.0]}
    assert lookup.last_vectors(df, ["at", "token"]).count() == 2


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_attach_vectors(spark, limit):
    # One token is a third of all rows, so it counts as hot.
    tokens = [(i, "hot" if i % 3 == 0 else f"t{i % 1500}") for i in range(6000)]
    df = spark.createDataFrame(tokens, "pos long, token string")
    vocabulary = lookup.hash_vocabulary(df, 4)
    found = lookup.attach_vectors(df, vocabulary, broadcast_bytes=limit)
    want = df.withColumn("want", hash_vector("token", 4))
    joined = found.join(want, ["pos", "token"])
    assert joined.where("embedding = want").count() == 6000 == found.count()
    assert lookup.hot_tokens(df, share=4) == ["hot"]
    assert lookup.hot_tokens(df, share=2) == lookup.hot_tokens(df.limit(0)) == []


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_unknown_token(spark, limit):
    df = spark.createDataFrame([(0, "a"), (1, "b")], "pos long, token string")
    vocabulary = lookup.hash_vocabulary(df.where("token = 'a'"), 4)
    with pytest.raises(Exception, match="no vector for token b"):
        lookup.attach_vectors(df, vocabulary, broadcast_bytes=limit).collect()
    loose = lookup.attach_vectors(df, vocabulary, strict=False, broadcast_bytes=limit)
    assert loose.where("embedding is null").select("token").collect() == [("b",)]


def test_vocabulary_bytes_with_known_width(spark):
    df = spark.createDataFrame([("a",), ("bc",)], "token string")
    vocabulary = lookup.hash_vocabulary(df, 4)
    assert lookup.vocabulary_bytes(vocabulary) == lookup.vocabulary_bytes(vocabulary, vector_width=4) == 195


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_create_examples(spark, limit):
    tokens = "The quick brown fox The jumps".split()
    df = spark.createDataFrame(list(enumerate(tokens)), "pos long, token string")
    vocabulary = lookup.hash_vocabulary(df, 4)
    vectors = {r["token"]: np.array(r["embedding"]) for r in vocabulary.collect()}
    rows = features.create_examples(df, vocabulary, 2, 4, block_rows=2, broadcast_bytes=limit)
    found = rows.orderBy("start").collect()
    assert len(found) == 4
    for r in found:
        i = r["start"]
        want = np.concatenate([vectors[tokens[i + k]] + code(k, 4) for k in range(2)])
        assert len(r["features"]) == 8 and len(r["label"]) == 4
        assert r["features"] == pytest.approx(want, abs=1e-15)
        assert r["label"] == pytest.approx(vectors[tokens[i + 2]])


def test_only_tokens_are_shuffled_with_a_small_lookup(spark):
    df = spark.range(100).select(F.col("id").alias("pos"), (F.col("id") % 7).cast("string").alias("token"))
    vocabulary = lookup.hash_vocabulary(df, 4)
    plan = features.compact_from_lookup(df, vocabulary, 2, 4)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning(_block") == 1
    assert main.index("collect_list") < main.index("BroadcastHashJoin") < main.index("Exchange hashpartitioning")


def test_examples_do_not_depend_on_the_cutting(spark, monkeypatch):
    df = spark.createDataFrame([(1, [f"t{i}" for i in range(40)])], "seq int, tokens array<string>")
    whole = features.compact_from_tokens(df, 3, 4, seq=["seq"])
    cut = features.compact_from_tokens(df, 3, 4, seq=["seq"], block_rows=5)
    want = sorted(map(tuple, features.examples_of(whole, 3, 4, ["seq"]).collect()))
    assert len(want) == 37
    assert sorted(map(tuple, features.examples_of(cut, 3, 4, ["seq"]).collect())) == want
    monkeypatch.setattr(features, "ROW_DOUBLES", 24)
    for compact in (whole, cut):
        assert sorted(map(tuple, features.examples_by_expression(compact, 3, 4, ["seq"]).collect())) == want


def test_windows_are_cut_in_pieces(spark, monkeypatch):
    vectors, codes = np.arange(40.0), arrow_examples.code_matrix(spark, 3, 4)
    whole = list(arrow_examples.cut_windows(vectors, codes))
    monkeypatch.setattr(arrow_examples, "CHUNK_DOUBLES", 24)
    pieces = list(arrow_examples.cut_windows(vectors, codes))
    assert [p[0] for p in pieces] == [0, 2, 4, 6] and [w[0] for w in whole] == [0]
    for i in (1, 2):
        assert np.array_equal(np.concatenate([p[i] for p in pieces]), whole[0][i])
    assert list(arrow_examples.cut_windows(vectors[:12], codes)) == []


def test_examples_keep_keys_of_any_type(spark):
    df = spark.sql("select named_struct('a', 1) as s, 'x' as t, split('p q r', ' ') as tokens")
    compact = features.compact_from_tokens(df, 1, 2, seq=["s", "t"])
    found = features.examples_of(compact, 1, 2, ["s", "t"], published=True)
    assert found.columns == ["s", "t", "start", "features", "label"]
    assert sorted((r["s"]["a"], r["t"], r["start"]) for r in found.collect()) == [(1, "x", 0), (1, "x", 1)]


def test_ragged_vectors_fail(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [1.0], [3.0, 4.0]],)], "v array<array<double>>")
    blocks = blocks_from_arrays(df, 1, "v")
    with pytest.raises(Exception, match="not 2 wide"):
        features.vector_blocks(blocks, 2).collect()


def test_fit_examples(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0])], "features array<double>, label array<double>")
    row = features.fit_examples(df, 2, 3).first()
    assert (row["features"], row["label"]) == ([1.0, 2.0], [1.0, 0.0, 0.0])


def test_a_repeated_lookup_token_is_an_error(spark):
    tokens = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "pos int, token string")
    twice = spark.createDataFrame([("a", [1.0]), ("a", [2.0]), ("b", [3.0])], "token string, embedding array<double>")
    for call in (lambda: lookup.attach_vectors(tokens, twice), lambda: features.compact_from_lookup(tokens, twice, 1, 1)):
        with pytest.raises(ValueError, match="several vectors for token 'a'"):
            call()


@pytest.mark.parametrize("width", [1, 4, 6])
def test_vectors_made_in_tasks_are_those_of_the_expression(spark, width):
    tokens = spark.createDataFrame([("a",), ("é:1",), ("",), ("a",), (None,)], "token string").coalesce(1)
    found = tokens.select("token", hash_vectors("token", width).alias("made"), hash_vector("token", width).alias("want"))
    for r in found.collect():
        assert r["made"] == (None if r["token"] is None else r["want"])
