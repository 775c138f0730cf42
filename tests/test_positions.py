import random

import pytest
from pyspark.sql import functions as F

from windrow.operators import positions
from windrow.operators.positions import dense_positions, ranged_total, running_total


def expected(rows):
    """Plain single-process answer: rows of (seq, key, weight)."""
    out, sums = {}, {}
    for seq, key, weight in sorted(rows):
        out[seq, key] = sums.get(seq, 0)
        sums[seq] = sums.get(seq, 0) + weight
    return out


@pytest.mark.parametrize("bits, spread", [(3, 400), (6, 10**6), (16, 400), (16, 10**6), (16, 2**40)])
def test_running_total_per_sequence(spark, bits, spread):
    rng = random.Random(bits * spread)
    # One sequence holds most rows.
    rows = {(rng.choice("aaaaaabc"), rng.randrange(-spread, spread)): rng.randrange(5) for _ in range(300)}
    rows = [(s, k, w) for (s, k), w in rows.items()]
    df = spark.createDataFrame(rows, "seq string, key long, w int")
    found = running_total(df, "key", F.col("w"), ["seq"], range_bits=bits).collect()
    assert {(r["seq"], r["key"]): r["offset"] for r in found} == expected(rows)
    assert len(found) == len(rows)


def test_dense_positions_of_one_order(spark):
    df = spark.range(0, 100000, 7).withColumnRenamed("id", "key")
    found = dense_positions(df, "key")
    assert found.where(F.col("pos") * 7 != F.col("key")).count() == 0
    assert found.count() == df.count()


def test_order_by_several_columns(spark):
    rng = random.Random(1)
    keys = list({(f"f{rng.randrange(3)}", rng.randrange(4), rng.randrange(1000)) for _ in range(400)})
    df = spark.createDataFrame(keys, "file string, piece int, row long").repartition(5)
    found = dense_positions(df, ["file", "piece", "row"], span=(0, 2**33), range_bits=4).collect()
    assert {(r[0], r[1], r[2]): r["pos"] for r in found} == {k: i for i, k in enumerate(sorted(keys))}


def test_empty_table(spark):
    assert dense_positions(spark.range(0), "id").collect() == []


def test_null_key_fails(spark):
    df = spark.createDataFrame([(1,), (None,)], "key long")
    with pytest.raises(Exception, match="null in the columns"):
        dense_positions(df, "key").collect()


@pytest.mark.parametrize("kind", ["string", "double", "timestamp", "date", "binary", "decimal(20,3)"])
@pytest.mark.parametrize("n_ranges", [1, 7])
def test_any_key_that_can_be_ordered(spark, kind, n_ranges):
    rng = random.Random(n_ranges)
    # One sequence has most rows, and ties are broken by a second column.
    rows = [(rng.choice("aaaaaabc"), rng.randrange(40), i, rng.randrange(5)) for i in range(500)]
    key = F.col("k") if kind != "timestamp" else F.col("k") * 86400
    made = {"string": F.lpad(F.col("k").cast("string"), 3, "0"), "binary": F.lpad(F.col("k").cast("string"), 3, "0").cast("binary")}
    made["date"] = F.date_add(F.lit("2020-01-01").cast("date"), F.col("k"))
    df = spark.createDataFrame(rows, "seq string, k int, tie int, w int").withColumn("key", made.get(kind, key.cast(kind)))
    found = ranged_total(df, ["key", "tie"], F.col("w"), ["seq"], n_ranges=n_ranges)
    assert found.columns == [*df.columns, "offset"] and found.schema["key"].dataType == df.schema["key"].dataType
    want = expected([(s, (k, t), w) for s, k, t, w in rows])
    assert {(r["seq"], (r["k"], r["tie"])): r["offset"] for r in found.collect()} == want
    whole = dense_positions(df, ["key", "tie"]).collect()
    assert [(r["k"], r["tie"]) for r in sorted(whole, key=lambda r: r["pos"])] == sorted((k, t) for _, k, t, _ in rows)
    assert sorted(r["pos"] for r in whole) == list(range(500))


def test_one_text_as_a_key_of_its_own(spark):
    words = sorted({f"w{i * 7919 % 5000}" for i in range(3000)})
    df = spark.createDataFrame([(w,) for w in words], "key string").repartition(6)
    assert {r["key"]: r["pos"] for r in dense_positions(df, "key").collect()} == {w: i for i, w in enumerate(words)}
    assert dense_positions(df.limit(0), "key").count() == 0
    for bad, says in ((df.union(df.limit(1)), "same order"), (df.union(spark.sql("SELECT cast(null AS string)")), "null in the")):
        with pytest.raises(Exception, match=says):
            dense_positions(bad, "key").collect()


def test_no_range_holds_a_whole_sequence(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(positions, "run_folder", lambda spark, name: f"file://{tmp_path}/{name}")
    df = spark.range(20_000).select(F.lit("one").alias("seq"), (F.col("id") * 1.5).alias("key"), F.lit("own").alias("_w0"))
    found = ranged_total(df, ["key"], F.lit(1), ["seq"], "pos", n_ranges=10)
    assert found.where(F.col("pos") * 1.5 != F.col("key")).count() == 0
    parts = spark.read.parquet(f"file://{tmp_path}/positions").groupBy("_part").count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 5000


def test_a_wrong_span_costs_balance_only(spark):
    df = spark.range(0, 3 * 2**20, 2**10).withColumnRenamed("id", "key")
    found = dense_positions(df, "key", span=(0, 2**10))
    assert found.where(F.col("pos") * 2**10 != F.col("key")).count() == 0


def test_no_group_grows_with_the_sequence(spark):
    """Rows are never grouped by their sequence alone, only totals of key ranges are."""
    df = spark.range(10).withColumn("seq", F.lit(1)).withColumn("payload", F.rand())
    plan = dense_positions(df, "id", ["seq"], span=(0, 2**40))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3
    assert sum("_range" in line for line in windows) == 2
    assert "_range" in windows[0]


@pytest.mark.parametrize("bits", [2, 16])
def test_ties_in_an_order_are_an_error(spark, bits):
    df = spark.createDataFrame([(1, 0), (2, 0), (2, 0), (9, 0)], "key int, n int")
    with pytest.raises(Exception, match="same order"):
        dense_positions(df, "key", range_bits=bits).collect()
