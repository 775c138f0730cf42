"""The whole job: vector file to model and report."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from windrow.operators.checks import vector_table_check
from windrow.operators.features import compact_from_lookup
from windrow.operators.lookup import last_vectors
from windrow.operators.metrics import run_metrics
from windrow.operators.positions import dense_positions
from windrow.operators.report import log_lines, report_lines
from windrow.operators.training import Settings, TrainingRun, blocks_for_training, train
from windrow.operators.windows import BLOCK_ROWS
from windrow.session import run_folder
from windrow.sinks.model_store import write_model
from windrow.sinks.report_text import write_report
from windrow.sources.vector_text import FILE_ORDER, ROW_SPAN, read_vectors


log = logging.getLogger(__name__)


@dataclass
class JobResult:
    run: TrainingRun
    summary: DataFrame
    log: DataFrame
    model_path: str
    report_path: str
    #: ``split, n_rows`` and ``partition, cnt`` of the training data.
    split_counts: DataFrame
    partition_counts: DataFrame


def run_job(
    spark: SparkSession,
    vectors_path: str,
    model_folder: str,
    metrics_folder: str,
    settings: Settings,
    fit: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> JobResult:
    """Read vectors, check them, window them in file order, train, and write model and report.

    The tokens are those of the file, in its order; a repeated token has the vector it has last.
    Vectors of another width than the settings' are refused, unless ``fit`` asks to cut or fill them.
    Windows are dealt to the settings' workers in blocks of ``block_rows``; neither cores nor the size
    of the input play a part, so the same settings give the same model anywhere. The text is parsed
    once, to a table in the shared folder.
    """
    settings.check()
    folder = run_folder(spark, "job")
    read_vectors(spark, vectors_path).write.parquet(f"{folder}/vectors")
    vectors = spark.read.parquet(f"{folder}/vectors")
    found = vector_table_check(vectors).first()
    if not found["valid"]:
        raise ValueError(f"vector file is empty or its vectors differ in width: {vectors_path}")
    width = found["min_width"]
    if width != settings.vector:
        if not fit:
            raise ValueError(f"vectors are {width} wide, not {settings.vector}; ask for fitting to cut or fill them")
        log.warning("vectors are %d wide, not %d: examples are cut or filled with zeros", width, settings.vector)
    lookup = last_vectors(vectors, FILE_ORDER)
    tokens = dense_positions(vectors.drop("embedding"), FILE_ORDER, span=ROW_SPAN).select("pos", "token")
    compact = compact_from_lookup(tokens, lookup, settings.window, width, block_rows=block_rows)
    data = blocks_for_training(compact, settings, width)
    try:
        run = train(data, settings)
        # Figures are stored while the data is there, so that reading them computes nothing again.
        stored = {
            "partitions": data.rows_per_partition(),
            "splits": data.split_counts(),
            "epochs": run.epoch_metrics,
            "log": log_lines(run.epoch_metrics),
        }
        stored = {name: _stored(table, f"{folder}/{name}") for name, table in stored.items()}
        summary = run_metrics(stored["epochs"], run.batch_metrics, run.parameters, stored["partitions"])
        summary = _stored(summary, f"{folder}/summary")
        report_path = write_report(report_lines(stored["epochs"], summary), metrics_folder)
        model_path = write_model(run.parameters, model_folder, epoch=settings.epochs)
    finally:
        data.unpersist()
    return JobResult(run, summary, stored["log"], model_path, report_path, stored["splits"], stored["partitions"])


def _stored(table: DataFrame, path: str) -> DataFrame:
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)
