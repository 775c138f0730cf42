import math

import pytest

from windrow.operators import scoring

PAIRS = [
    ([1.0, 0.0], [1.0, 0.0], 0.0, 1.0),
    ([1.0, 0.0], [0.0, 1.0], 1.0, 0.0),
    ([0.0, 0.0], [1.0, 1.0], 1.0, 0.0),
    ([3.0, 4.0], [4.0, 3.0], 1.0, 0.96),
    (None, [1.0, 1.0], None, None),
]


@pytest.fixture
def pairs(spark):
    rows = [(i, p, y) for i, (p, y, _, _) in enumerate(PAIRS)]
    return spark.createDataFrame(rows, "id int, pred array<double>, label array<double>")


def test_loss(pairs):
    assert scoring.loss(pairs).first()["loss"] == pytest.approx(0.75)
    for i, (_, _, want, _) in enumerate(PAIRS):
        assert scoring.loss(pairs.where(f"id = {i}")).first()["loss"] == want
    assert scoring.loss(pairs.limit(0)).first()["loss"] is None


def test_cosine(pairs):
    found = {r["id"]: r["cosine"] for r in scoring.with_cosine(pairs).collect()}
    for i, (_, _, _, want) in enumerate(PAIRS):
        assert found[i] == (want if want is None else pytest.approx(want))


def test_cosine_of_different_widths_is_zero(spark):
    df = spark.createDataFrame([([1.0], [1.0, 2.0])], "pred array<double>, label array<double>")
    assert scoring.with_cosine(df).first()["cosine"] == 0


def test_hit_rate(pairs):
    assert scoring.hit_rate(pairs).first()["accuracy"] == pytest.approx(40.0)
    assert scoring.hit_rate(pairs, threshold=0.97).first()["accuracy"] == pytest.approx(20.0)
    assert scoring.hit_rate(pairs.limit(0)).first()["accuracy"] == 0.0


def test_vector_stats(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [5.0])], "g string, v array<double>")
    row = scoring.vector_stats(df.where("g = 'a'"), "v").first()
    assert tuple(row) == pytest.approx((math.sqrt(30), 1, 4, 2.5, math.sqrt(1.25)))
    sample = scoring.vector_stats(df.where("g = 'a'"), "v", sample=True).first()
    assert sample["std"] == pytest.approx(math.sqrt(5 / 3))
    grouped = {r["g"]: r["norm"] for r in scoring.vector_stats(df, "v", ["g"]).collect()}
    assert grouped == pytest.approx({"a": math.sqrt(30), "b": 5.0})
