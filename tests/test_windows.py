import random

import pytest
from pyspark.sql import functions as F

from windrow.operators.positions import dense_positions
from windrow.operators.windows import blocks_from_arrays, blocks_from_rows, windows_from_arrays, windows_from_rows


def brute(tokens, width):
    return {(i, tuple(tokens[i : i + width]), tokens[i + width]) for i in range(max(0, len(tokens) - width))}


def as_set(df):
    rows = df.collect()
    found = {(r["start"], tuple(r["ctx"]), r["target"]) for r in rows}
    assert len(found) == len(rows)
    return found


def token_rows(spark, tokens):
    return spark.createDataFrame(list(enumerate(tokens)), "pos long, token string")


def test_five_tokens(spark):
    tokens = "The quick brown fox jumps".split()
    found = as_set(windows_from_rows(token_rows(spark, tokens), 2, "token"))
    assert found == {(0, ("The", "quick"), "brown"), (1, ("quick", "brown"), "fox"), (2, ("brown", "fox"), "jumps")}


@pytest.mark.parametrize("width", [1, 4])
@pytest.mark.parametrize("length", [1, 4, 5, 50])
def test_both_forms_match_brute_force(spark, length, width):
    lengths = [0, 1, width, width + 1, 5, 120]
    tokens = {s: [f"t{random.Random(s * 31 + i).randrange(9)}" for i in range(n)] for s, n in enumerate(lengths)}
    want = {(s, *row) for s, own in tokens.items() for row in brute(own, width)}
    rows = [(s, i, t) for s, own in tokens.items() for i, t in enumerate(own)]
    by_row = spark.createDataFrame(rows, "seq int, pos long, token string")
    by_array = spark.createDataFrame(list(tokens.items()), "seq int, tokens array<string>")
    for found in (
        windows_from_rows(by_row, width, "token", ["seq"], block_rows=length),
        windows_from_arrays(by_array, width, "tokens", ["seq"], block_rows=length),
    ):
        got = [(r["seq"], r["start"], tuple(r["ctx"]), r["target"]) for r in found.collect()]
        assert len(got) == len(want) and set(got) == want


def test_empty_input(spark):
    empty = spark.createDataFrame([], "pos long, token string")
    assert windows_from_rows(empty, 2, "token").collect() == []


def test_sequences_do_not_mix(spark):
    rows = [("a", i, f"a{i}") for i in range(7)] + [("b", i, f"b{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "seq string, pos long, token string")
    found = windows_from_rows(df, 2, "token", ["seq"], block_rows=3).collect()
    assert len(found) == 5 + 1
    assert all({t[0] for t in [*r["ctx"], r["target"]]} == {r["seq"]} for r in found)


def test_one_long_sequence_among_short_ones(spark):
    rows = [(0, i, str(i)) for i in range(5000)] + [(s, i, str(i)) for s in range(1, 40) for i in range(3)]
    df = spark.createDataFrame(rows, "seq long, pos long, token string")
    blocks = blocks_from_rows(df, 2, "token", ["seq"], block_rows=100)
    assert blocks.agg(F.max(F.size("items"))).first()[0] == 102
    found = windows_from_rows(df, 2, "token", ["seq"], block_rows=100)
    assert found.where("seq = 0").count() == 4998
    assert found.where("seq > 0").count() == 39
    assert found.where("cast(target as long) != start + 2 or size(ctx) != 2").count() == 0


def test_blocks_hold_their_windows(spark):
    df = spark.createDataFrame([(list(range(10)),)], "t array<int>")
    found = blocks_from_arrays(df, 3, "t", block_rows=4).orderBy("block_start").collect()
    assert [(r["block_start"], r["items"]) for r in found] == [(0, list(range(7))), (4, list(range(4, 10)))]


def test_global_order_matches_one_partition_window(spark):
    df = spark.range(0, 3000, 3).withColumn("token", F.col("id").cast("string")).repartition(7)
    found = as_set(windows_from_rows(dense_positions(df, "id", range_bits=5), 4, "token", block_rows=16))
    assert found == brute([str(i) for i in range(0, 3000, 3)], 4)


def test_nulls_in_items_are_kept(spark):
    df = spark.createDataFrame([(["a", None, "c"],)], "t array<string>")
    assert as_set(windows_from_arrays(df, 1, "t")) == {(0, ("a",), None), (1, (None,), "c")}


@pytest.mark.parametrize("width, length", [(0, 5), (2, 0)])
def test_bad_settings(spark, width, length):
    with pytest.raises(ValueError):
        windows_from_rows(token_rows(spark, ["a"]), width, "token", block_rows=length)


def test_gathered_rows_keep_nulls_in_place_and_move_no_pairs(spark):
    from windrow.operators.windows import blocks_from_rows

    values = [None if i % 5 == 0 else f"t{i % 7}" for i in range(60)]
    rows = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "seq string, pos long, token string")
    found = blocks_from_rows(rows.repartition(5), 3, "token", ["seq"], block_rows=16)
    assert {r["block_start"]: r["items"] for r in found.collect()} == {b: values[b : b + 19] for b in range(0, 60, 16)}
    assert "collect_list(struct" not in found._jdf.queryExecution().optimizedPlan().toString()
