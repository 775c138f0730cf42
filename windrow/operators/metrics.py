"""Figures of a run, from its tables of epochs and of batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_duration(epochs: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``groups, total_ms``: from the start of the first epoch to the end of the last."""
    return epochs.groupBy(*groups).agg(
        F.timestamp_diff("MILLISECOND", F.min("started"), F.max("ended")).alias("total_ms")
    )


def mean_batch_time(batches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``groups, n_steps, n_rows, ms_per_step, ms_per_row``; null where nothing was counted."""
    return batches.groupBy(*groups).agg(
        F.sum("steps").alias("n_steps"),
        F.sum("rows").alias("n_rows"),
        F.try_divide(F.sum("ms"), F.sum("steps")).alias("ms_per_step"),
        F.try_divide(F.sum("ms"), F.sum("rows")).alias("ms_per_row"),
    )


def peaks(batches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``groups, peak_ms, peak_rows`` over batches, 0 if there are none."""
    return batches.groupBy(*groups).agg(
        F.coalesce(F.max("ms"), F.lit(0)).alias("peak_ms"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("peak_rows"),
    )


def nested_peak(nested: Column | str, value: str) -> Column:
    """Largest ``value`` of the structs in an array column, 0 if there are none.

    For batches nested in their epoch's row; the maximum over rows is an ordinary ``max`` of this.
    """
    column = F.col(nested) if isinstance(nested, str) else nested
    return F.coalesce(F.array_max(F.transform(column, lambda b: b[value])), F.lit(0))


def model_statistics(parameters: DataFrame) -> DataFrame:
    """One row, ``n_parameters, layer_sizes``; one small row per layer meets in the last step."""
    layers = (
        parameters.where("state = 'value'")
        .groupBy("layer")
        .agg(
            F.sum(F.size("vals")).alias("_n"),
            F.max(F.when(F.col("kind") == "weight", F.col("rows"))).alias("_in"),
            F.max("cols").alias("_out"),
        )
    )
    ordered = F.sort_array(F.collect_list(F.struct("layer", "_in", "_out")))
    return layers.agg(F.sum("_n").alias("n_parameters"), ordered.alias("_layers")).select(
        "n_parameters",
        F.concat(
            F.slice(F.transform("_layers", lambda x: x["_in"]), 1, 1),
            F.transform("_layers", lambda x: x["_out"]),
        ).alias("layer_sizes"),
    )


def run_metrics(
    epochs: DataFrame, batches: DataFrame, parameters: DataFrame, partition_counts: DataFrame
) -> DataFrame:
    """One row with the summary of a run. Each part is a one-row aggregate."""
    from windrow.operators.partitions import partition_skew

    last = F.max_by(F.struct("loss", "accuracy", "val_loss", "val_accuracy"), "epoch")
    summary = epochs.agg(F.count("*").alias("n_epochs"), last.alias("last")).select("n_epochs", "last.*")
    parts = [
        total_duration(epochs),
        mean_batch_time(batches),
        peaks(batches),
        model_statistics(parameters),
        partition_skew(partition_counts).select("n_partitions", "skew_pct"),
    ]
    for part in parts:
        summary = summary.select("*", *[part.select(c).scalar().alias(c) for c in part.columns])
    return summary
