import pytest

from windrow.operators.positions import dense_positions
from windrow.sources import vector_text as S

GOOD = {
    "1\t[1.0,2.0]": (1, [1.0, 2.0]),
    "1\t1.0,2.0": (1, [1.0, 2.0]),
    "1\t[1.0,2.0,]": (1, [1.0, 2.0]),
    "1\t[1.0]\t": (1, [1.0]),
    "1\t[ 1.0 , 2.0 ]": (1, [1.0, 2.0]),
    "-7\t[1e-3,.5,2.,3d]": (-7, [0.001, 0.5, 2.0, 3.0]),
    "+7\t[-Infinity]": (7, [float("-inf")]),
    "1\t[,]": (1, []),
}
BAD = [
    " 1\t[1.0]",
    "1\t[]",
    "1\t[1,,2]",
    "1\t[,1]",
    "x\t[1.0]",
    "1 [1.0]",
    "1\t[1.0]\t[2.0]",
    "",
    "1",
    "1\t",
    "99999999999\t[1.0]",
    "1\t[inf]",
    "1\t[nan]",
    "1\t[[1.0]]",
    "1.0\t[1.0]",
]


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_good_lines(spark):
    rows = S.parse_lines(lines(spark, GOOD)).collect()
    assert {r["line"]: (r["token"], r["embedding"]) for r in rows} == GOOD


def test_bad_lines_are_found(spark):
    all_lines = lines(spark, [*GOOD, *BAD])
    assert sorted(r["line"] for r in S.bad_lines(all_lines).collect()) == sorted(BAD)
    kept = S.parse_lines(all_lines, strict=False)
    assert kept.where("token is null and embedding is null").count() == len(BAD)


@pytest.mark.parametrize("bad", BAD)
def test_strict_fails_on_each_bad_line(spark, bad):
    with pytest.raises(Exception, match="bad vector line"):
        S.parse_lines(lines(spark, ["1\t[1.0]", bad])).collect()


def test_special_number(spark):
    (row,) = S.parse_lines(lines(spark, ["1\t[NaN,1]"])).collect()
    assert row["embedding"][0] != row["embedding"][0]


def test_file_order_over_many_splits(spark, tmp_path):
    n = 3000
    for part in range(2):
        text = "".join(f"{(i * 7919) % n}\t[{i}.0]\n" for i in range(part * n // 2, (part + 1) * n // 2))
        (tmp_path / f"part-{part}.txt").write_text(text.rstrip("\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = S.read_vectors(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 4
        rows = dense_positions(found, S.FILE_ORDER, span=S.ROW_SPAN).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["pos"], r["embedding"][0]) for r in rows) == [(i, float(i)) for i in range(n)]


def test_format_is_the_inverse(spark):
    vectors = spark.createDataFrame([(1, [0.5, -2.0]), (2, [1e-9])], "token int, embedding array<double>")
    back = S.parse_lines(S.format_lines(vectors).select("line")).select("token", "embedding")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, vectors.collect()))
