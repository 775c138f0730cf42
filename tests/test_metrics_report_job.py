import random
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from windrow.functions.text import duration_text
from windrow.operators import metrics, report
from windrow.operators.parameters import State
from windrow.operators.training import EPOCH_SCHEMA, Settings
from windrow.plans.job import run_job
from windrow.session import shared_folder
from windrow.sinks import model_store, report_text

BATCHES = "epoch int, worker int, steps long, rows long, loss double, ms long"


def started_model(spark, sizes):
    """The parameter table of a model before its first step."""
    table = pa.Table.from_batches(State.initial(sizes, 1).slices(sizes, -1, 1))
    return spark.createDataFrame(table).drop("worker", "n")


def at(second):
    return datetime(2024, 1, 1, 0, 0, second)


@pytest.fixture
def epochs(spark):
    grad = (0.5, -0.25, 0.75, 0.125, 0.0625)
    rows = [
        (1, 0.039029, 0.0, None, None, grad, 0.001, at(0), at(2), at(3)),
        (2, 0.00953, 100.0, 0.25, 50.0, grad, 0.001, at(2), at(10), at(11)),
        (3, None, None, None, None, None, 0.001, at(10), at(11), None),
    ]
    return spark.createDataFrame(rows, EPOCH_SCHEMA)


@pytest.fixture
def batches(spark):
    return spark.createDataFrame([(1, 0, 2, 40, 0.5, 30), (1, 1, 1, 10, 0.5, 90)], BATCHES)


@pytest.mark.parametrize(
    "ms, text",
    [(0, "0s"), (59999, "59s"), (60000, "1m 0s"), (3599999, "59m 59s"), (3661000, "1h 1m 1s"), (360000000, "100h 0m 0s")],
)
def test_duration_text(spark, ms, text):
    assert spark.range(1).select(duration_text(F.lit(ms))).first()[0] == text


def test_total_duration_counts_the_first_epoch(epochs):
    assert metrics.total_duration(epochs).first()["total_ms"] == 11000
    assert metrics.total_duration(epochs.where("epoch = 1")).first()["total_ms"] == 2000


def test_batch_figures(spark, batches):
    assert tuple(metrics.mean_batch_time(batches).first()) == (3, 50, 40.0, 2.4)
    assert tuple(metrics.peaks(batches).first()) == (90, 40)
    assert tuple(metrics.peaks(batches.limit(0)).first()) == (0, 0)
    assert metrics.mean_batch_time(batches.limit(0)).first()["ms_per_step"] is None
    nested = batches.groupBy("epoch").agg(F.collect_list(F.struct("ms", "rows")).alias("batches"))
    assert nested.select(metrics.nested_peak("batches", "ms")).first()[0] == 90
    empty = spark.range(1).select(F.array().cast("array<struct<ms:long>>").alias("batches"))
    assert empty.select(metrics.nested_peak("batches", "ms")).first()[0] == 0


def test_model_statistics(spark):
    row = metrics.model_statistics(started_model(spark, [512, 256, 256, 128])).first()
    assert (row["n_parameters"], row["layer_sizes"]) == (230016, [512, 256, 256, 128])


def in_order(lines):
    return [r["line"] for r in lines.orderBy("section", "item", "n").collect()]


def test_report(spark, epochs, batches):
    model = started_model(spark, [8, 4, 4, 2])
    counts = spark.createDataFrame([(0, 3), (1, 1)], "partition int, cnt long")
    summary = metrics.run_metrics(epochs.where("epoch < 3"), batches, model, counts)
    lines = in_order(report.report_lines(epochs.where("epoch < 3"), summary, generated=F.lit("now")))
    assert lines == """\
=== Training Metrics Report ===
Generated: now

=== Training Summary ===
Total Duration: 10s
Total Epochs: 2
Final Training Accuracy: 100.00%
Final Validation Accuracy: 50.00%
Final Loss: 0.009530
Final Validation Loss: 0.250000
Average Batch Time: 40.00 ms
Average Row Time: 2.40 ms
Peak Batch Time: 90.00 ms

=== Model Statistics ===
Total Parameters: 66
Layer Sizes: 8 → 4 → 4 → 2
Total Batches Processed: 3
Average Processing Time per Batch: 40.00 ms
Total Rows Processed: 50

=== Spark Execution Statistics ===
Data Partitions: 2
Data Partition Skew: 50.00%

=== Epoch Details ===

Epoch 1:
  Loss: 0.039029
  Accuracy: 0.00%
  Learning Rate: 1.000000e-03
  Duration: 2s
  Gradient Statistics:
    Norm: 0.500000
    Min/Max: -0.250000 / 0.750000
    Mean: 0.125000
    Std Dev: 0.062500

Epoch 2:
  Loss: 0.009530
  Accuracy: 100.00%
  Validation Loss: 0.250000
  Validation Accuracy: 50.00%
  Learning Rate: 1.000000e-03
  Duration: 8s
  Gradient Statistics:
    Norm: 0.500000
    Min/Max: -0.250000 / 0.750000
    Mean: 0.125000
    Std Dev: 0.062500""".split("\n")


def test_failed_epoch_keeps_its_place(epochs):
    lines = in_order(report.epoch_lines(epochs.where("epoch = 3")))
    assert lines == ["", "Epoch 3:", "  Learning Rate: 1.000000e-03", "  Duration: 1s"]


def test_log_lines(epochs):
    line = report.log_lines(epochs.where("epoch = 1")).first()["line"]
    assert line == (
        "Epoch 1 Summary; Training Loss: 0.039029; Training Accuracy: 0.00%; Validation Loss: N/A; "
        "Validation Accuracy: N/A; Learning Rate: 0.001000; Duration: 2000ms"
    )


def test_batch_and_run_log_lines(spark, epochs, batches):
    lines = [r["line"] for r in report.batch_log_lines(batches).orderBy("worker").collect()]
    assert lines[1] == "Epoch 1, worker 1; Steps: 1; Rows: 10; Loss: 0.500000; Time: 90ms"
    counts = spark.createDataFrame([(0, 0)], "partition int, cnt long")
    summary = metrics.run_metrics(epochs, batches, started_model(spark, [8, 4, 4, 2]), counts)
    assert report.run_log_lines(summary).first()["line"] == (
        "Training Complete; Total Duration: 11000ms; Average Batch Time: 40.00ms; Peak Batch Time: 90ms; "
        "Total Parameters: 66; Batches Processed: 3; Partition Skew: N/A"
    )


def test_report_file(spark, epochs, tmp_path):
    lines = report.epoch_lines(epochs)
    path = report_text.write_report(lines, str(tmp_path / "new"), at=datetime(2024, 11, 3, 0, 8, 4))
    assert path.endswith("/new/training_metrics_2024-11-03_00-08-04.txt")
    (part,) = (tmp_path / "new").glob("*/part-*")
    assert part.read_text().split("\n")[:-1] == in_order(lines)
    with pytest.raises(Exception, match="(?i)already exists"):
        report_text.write_report(lines, str(tmp_path / "new"), at=datetime(2024, 11, 3, 0, 8, 4))


def test_shared_folder_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark) == (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.windrow")


def write_vectors(path, n, width, token=lambda i: i):
    rng = random.Random(n)
    rows = [f"{token(i)}\t[{','.join(str(round(rng.random(), 8)) for _ in range(width))}]" for i in range(n)]
    path.write_text("\n".join(rows))


def test_whole_job(spark, tmp_path):
    write_vectors(tmp_path / "vectors.txt", 60, 4, token=lambda i: i % 50)
    settings = Settings(window=3, vector=6, hidden=8, epochs=2)
    where = [str(tmp_path / name) for name in ("vectors.txt", "models", "metrics")]
    with pytest.raises(ValueError, match="4 wide, not 6"):
        run_job(spark, *where, settings)
    done = run_job(spark, *where, settings, fit=True, block_rows=5)
    assert sum(r["n_rows"] for r in done.split_counts.collect()) == 57
    assert done.partition_counts.agg(F.sum("cnt")).first()[0] == 57
    assert done.summary.first()["n_rows"] > 0
    assert done.run.epoch_metrics.where("loss is not null and val_loss is not null").count() == 2
    text = spark.read.text(done.report_path)
    assert text.where("value like 'Layer Sizes: 18 → 8 → 8 → 6'").count() == 1
    assert text.where("value = 'Epoch 2:'").count() == 1
    assert done.log.count() == 2
    stored = metrics.model_statistics(model_store.read_model(spark, done.model_path)).first()
    assert stored["layer_sizes"] == [18, 8, 8, 6]
    trained = done.run.batch_metrics.where("epoch = 1").agg(F.sum("rows")).first()[0]
    skew = done.run.batch_metrics.agg(F.sum("rows")).first()[0]
    assert skew == 2 * trained and 30 < trained < 57


def test_job_refuses_bad_files(spark, tmp_path):
    settings = Settings(window=2, vector=2, hidden=2, epochs=1)
    (tmp_path / "ragged.txt").write_text("1\t[1,2]\n2\t[1]\n")
    (tmp_path / "empty.txt").write_text("")
    for name in ("ragged.txt", "empty.txt"):
        with pytest.raises(ValueError, match="empty or its vectors differ"):
            run_job(spark, str(tmp_path / name), str(tmp_path), str(tmp_path), settings)
    write_vectors(tmp_path / "short.txt", 2, 2)
    with pytest.raises(ValueError, match="no training rows"):
        run_job(spark, str(tmp_path / "short.txt"), str(tmp_path), str(tmp_path), settings)
