"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import functools
import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from windrow.functions.hashing import hash_vector
from windrow.operators import features, token_index, training
from windrow.operators.network import parameter_count
from windrow.operators.positions import dense_positions
from windrow.plans import queries as Q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Queries that take longer are timed once after the run to warm up.
LONG_SEC = 6


def run_all(df: DataFrame) -> None:
    """Compute every column of every row, without collecting or storing."""
    df.write.format("noop").mode("overwrite").save()


def rows_query(query: Q.Query) -> Callable[[SparkSession], None]:
    return lambda spark: run_all(query(spark, SF_DIR))


def train_as_published(spark: SparkSession) -> dict:
    """The published runs' model and settings: 512-256-256-128, 10 epochs, on the stored vectors."""
    settings = training.Settings(window=4, vector=128, hidden=256, epochs=10)
    compact = Q.embedding_compact(spark, SF_DIR, block_rows=64)
    data = training.blocks_for_training(compact, settings, Q.VECTOR)
    run = training.train(data, settings)
    data.unpersist()
    epochs = run.epoch_metrics.orderBy("epoch").collect()
    rows = sum(r["rows"] for r in run.batch_metrics.select("rows").collect())
    later = (epochs[-1]["ended"] - epochs[0]["ended"]).total_seconds()
    return {
        "epochs_2_to_10_sec": round(later, 3),
        "train_rows_per_epoch": rows // len(epochs),
        "ms_per_row": round(later * 1000 / (rows * 0.9), 4),
        "final_loss": round(epochs[-1]["loss"], 6),
        "final_val_loss": round(epochs[-1]["val_loss"], 6),
    }


def train_documents(spark: SparkSession) -> dict:
    """One epoch over the windows of all documents."""
    run = Q.train_on_documents(spark, SF_DIR, epochs=1)
    rows = sum(r["rows"] for r in run.batch_metrics.select("rows").collect())
    epoch = run.epoch_metrics.first()
    seconds = (epoch["ended"] - epoch["started"]).total_seconds()
    return {"train_rows": rows, "epoch_sec": round(seconds, 3), "ms_per_row": round(seconds * 1000 / rows, 5)}


def attach_vectors_broadcast(spark: SparkSession) -> None:
    """The lookup broadcast whatever its size: here 67 MB, just above the default limit."""
    run_all(Q._attached(spark, SF_DIR, broadcast_bytes=256 << 20))


def train_averaging_often(spark: SparkSession) -> dict:
    """One epoch that averages after every mini-batch."""
    settings = training.Settings(Q.WINDOW, Q.VECTOR, hidden=Q.VECTOR, epochs=1, batch=64, averaging_every=1)
    data = training.blocks_for_training(Q.embedding_compact(spark, SF_DIR, block_rows=64), settings)
    run = training.train(data, settings)
    data.unpersist()
    return {"rounds": run.batch_metrics.select("round").distinct().count()}


def train_large_model(spark: SparkSession) -> dict:
    """One epoch of the configured 65536-1024-1024-512 model on few rows: its slices go out in pieces."""
    settings = training.Settings(window=128, vector=512, hidden=1024, epochs=1, workers=1, split=(1.0, 0.0))
    few = Q.vectors(spark, SF_DIR).where("vec_id < 160")
    rows = dense_positions(few.select("vec_id", "embedding"), "vec_id")
    compact = features.compact_from_rows(rows, 128, Q.VECTOR, block_rows=64)
    data = training.blocks_for_training(compact, settings, Q.VECTOR)
    run = training.train(data, settings)
    data.unpersist()
    return {"n_parameters": parameter_count(settings.sizes), "loss": run.epoch_metrics.first()["loss"]}


def document_features(spark: SparkSession, sf_dir: str = SF_DIR) -> None:
    compact = Q.document_compact(spark, sf_dir)
    run_all(features.examples_of(compact, Q.WINDOW, Q.MADE, ["doc_id"]))


def document_features_by_index(spark: SparkSession) -> None:
    """The same examples through token numbers and one vector for each distinct token."""
    numbers, blocks = Q._document_index(spark, SF_DIR)
    matrix = token_index.store_matrix(numbers.select("no", hash_vector("token", Q.MADE).alias("embedding")), Q.MADE)
    run_all(token_index.examples_of_index(blocks, matrix, Q.WINDOW, ["doc_id"]))


@functools.cache
def several_files() -> str:
    """The documents as a large table lies: in several files. The given file has one row group, which is one task."""
    spark, folder = SparkSession.getActiveSession(), tempfile.mkdtemp(prefix="windrow-bench-")
    Q.table(spark, SF_DIR, "documents").repartition(int(CPUS)).write.parquet(f"{folder}/documents.parquet")
    return folder


QUERIES: dict[str, Callable[[SparkSession], dict | None]] = {
    "vector_file_scan": rows_query(Q.vector_file_scan),
    "document_windows": rows_query(Q.document_windows),
    "document_windows_by_row": rows_query(Q.document_windows_by_row),
    "conversation_windows": rows_query(Q.conversation_windows),
    "event_windows": rows_query(Q.event_windows),
    "hash_vectors": rows_query(Q.hash_vectors),
    "attach_vectors": rows_query(Q.attach_vectors),
    "attach_vectors_broadcast": attach_vectors_broadcast,
    "attach_vectors_shuffled": rows_query(Q.attach_vectors_shuffled),
    "document_features": document_features,
    "document_features_by_index": document_features_by_index,
    "document_windows_8_files": lambda spark: run_all(Q.document_windows(spark, several_files())),
    "document_features_8_files": lambda spark: document_features(spark, several_files()),
    "embedding_examples": rows_query(Q.embedding_examples),
    "fit_features": rows_query(Q.fit_features),
    "split_counts": rows_query(Q.split_counts),
    "pair_hit_rate": rows_query(Q.pair_hit_rate),
    "vector_stats": rows_query(Q.vector_stats),
    "report_lines": rows_query(Q.report_lines),
    "train_as_published": train_as_published,
    "train_documents": train_documents,
    "train_averaging_often": train_averaging_often,
    "train_large_model": train_large_model,
}


def _timed(query: Callable[[SparkSession], dict | None], spark: SparkSession) -> tuple[float, dict | None]:
    began = time.monotonic()
    detail = query(spark)
    return time.monotonic() - began, detail


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("windrow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_all(Q.table(spark, SF_DIR, "events"))
    seconds, details = {}, {}
    for name, query in QUERIES.items():
        # Once to warm up, then the median of three runs, or one run of a long one.
        cold, _ = _timed(query, spark)
        runs = [_timed(query, spark) for _ in range(3 if cold < LONG_SEC else 1)]
        seconds[name] = round(statistics.median(t for t, _ in runs), 3)
        detail = runs[-1][1]
        if detail:
            details[name] = detail
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "details": details,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
