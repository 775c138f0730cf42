"""The text report of a run, as rows of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.text import duration_text

# Section headings and number formats of the report.
SUMMARY = "=== Training Summary ==="
MODEL = "=== Model Statistics ==="
EXECUTION = "=== Spark Execution Statistics ==="
EPOCHS = "=== Epoch Details ==="
PERCENT, LOSS, TIME, RATE = "%.2f%%", "%.6f", "%.2f ms", "%.6e"
ABSENT = "N/A"


def report_lines(
    epochs: DataFrame, run: DataFrame, title: str = "Training Metrics Report", generated: Column | None = None
) -> DataFrame:
    """``section, item, n, line``; ordered by the first three it is the report.

    Figures that are absent, such as those of a validation that was not run, have no line.
    """
    made = generated if generated is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd_HH-mm-ss")
    head = [F.lit(f"=== {title} ==="), F.concat(F.lit("Generated: "), made), F.lit("")]
    summary = [
        F.lit(SUMMARY),
        _line("Total Duration: ", duration_text("total_ms")),
        _line("Total Epochs: ", F.col("n_epochs").cast("string")),
        _number("Final Training Accuracy: ", PERCENT, "accuracy"),
        _number("Final Validation Accuracy: ", PERCENT, "val_accuracy"),
        _number("Final Loss: ", LOSS, "loss"),
        _number("Final Validation Loss: ", LOSS, "val_loss"),
        _number("Average Batch Time: ", TIME, "ms_per_step"),
        _number("Average Row Time: ", TIME, "ms_per_row"),
        _number("Peak Batch Time: ", TIME, F.col("peak_ms").cast("double")),
        F.lit(""),
    ]
    model = [
        F.lit(MODEL),
        _line("Total Parameters: ", F.col("n_parameters").cast("string")),
        _line("Layer Sizes: ", F.array_join(F.col("layer_sizes").cast("array<string>"), " → ")),
        _line("Total Batches Processed: ", F.col("n_steps").cast("string")),
        _number("Average Processing Time per Batch: ", TIME, "ms_per_step"),
        _line("Total Rows Processed: ", F.col("n_rows").cast("string")),
        F.lit(""),
    ]
    execution = [
        F.lit(EXECUTION),
        _line("Data Partitions: ", F.col("n_partitions").cast("string")),
        _number("Data Partition Skew: ", PERCENT, "skew_pct"),
        F.lit(""),
    ]
    top = run.select(_rows(0, F.lit(0), head + summary + model + execution + [F.lit(EPOCHS)]))
    return top.unionByName(epoch_lines(epochs))


def epoch_lines(epochs: DataFrame) -> DataFrame:
    """``section, item, n, line`` of each epoch."""
    grad = {k: F.col(f"grad.{k}") for k in ("norm", "min", "max", "mean", "std")}
    both = F.concat(F.format_string(LOSS, grad["min"]), F.lit(" / "), F.format_string(LOSS, grad["max"]))
    duration = F.timestamp_diff("MILLISECOND", "started", "ended")
    lines = [
        F.lit(""),
        F.concat(F.lit("Epoch "), F.col("epoch").cast("string"), F.lit(":")),
        _number("  Loss: ", LOSS, "loss"),
        _number("  Accuracy: ", PERCENT, "accuracy"),
        _number("  Validation Loss: ", LOSS, "val_loss"),
        _number("  Validation Accuracy: ", PERCENT, "val_accuracy"),
        _number("  Learning Rate: ", RATE, "learning_rate"),
        _line("  Duration: ", duration_text(duration)),
        F.when(F.col("grad").isNotNull(), F.lit("  Gradient Statistics:")),
        _number("    Norm: ", LOSS, grad["norm"]),
        F.when(grad["min"].isNotNull(), F.concat(F.lit("    Min/Max: "), both)),
        _number("    Mean: ", LOSS, grad["mean"]),
        _number("    Std Dev: ", LOSS, grad["std"]),
    ]
    return epochs.select(_rows(1, F.col("epoch"), lines))


def log_lines(epochs: DataFrame) -> DataFrame:
    """``epoch, line``: one log line an epoch, absent figures shown as such."""
    head = F.concat(F.lit("Epoch "), F.col("epoch").cast("string"), F.lit(" Summary"))
    figures = [
        ("Training Loss", LOSS, "loss"),
        ("Training Accuracy", PERCENT, "accuracy"),
        ("Validation Loss", LOSS, "val_loss"),
        ("Validation Accuracy", PERCENT, "val_accuracy"),
        ("Learning Rate", "%.6f", "learning_rate"),
        ("Duration", "%dms", F.timestamp_diff("MILLISECOND", "started", "ended")),
    ]
    return epochs.select("epoch", _log_line(head, figures))


def gradient_log_lines(epochs: DataFrame) -> DataFrame:
    """``epoch, line``: one log line for the last gradients of each epoch that has them."""
    head = F.concat(F.lit("Epoch "), F.col("epoch").cast("string"), F.lit(" Gradient Statistics"))
    names = {"Norm": "norm", "Min": "min", "Max": "max", "Mean": "mean", "Std Dev": "std"}
    figures = [(name, LOSS, F.col(f"grad.{field}")) for name, field in names.items()]
    return epochs.where("grad is not null").select("epoch", _log_line(head, figures))


def batch_log_lines(batches: DataFrame) -> DataFrame:
    """``epoch, worker, line``: one log line a task of a round."""
    head = F.format_string("Epoch %d, worker %d", "epoch", "worker")
    figures = [("Steps", "%d", "steps"), ("Rows", "%d", "rows"), ("Loss", LOSS, "loss"), ("Time", "%dms", "ms")]
    return batches.select("epoch", "worker", _log_line(head, figures))


def run_log_lines(run: DataFrame) -> DataFrame:
    """``line``: one log line for the whole run."""
    figures = [
        ("Total Duration", "%dms", "total_ms"),
        ("Average Batch Time", "%.2fms", "ms_per_step"),
        ("Peak Batch Time", "%dms", "peak_ms"),
        ("Total Parameters", "%d", "n_parameters"),
        ("Batches Processed", "%d", "n_steps"),
        ("Partition Skew", PERCENT, "skew_pct"),
    ]
    return run.select(_log_line(F.lit("Training Complete"), figures))


def _log_line(head: Column, figures: list[tuple[str, str, Column | str]]) -> Column:
    texts = [
        F.concat(F.lit(f"{name}: "), F.coalesce(_format(form, F.col(c) if isinstance(c, str) else c), F.lit(ABSENT)))
        for name, form, c in figures
    ]
    return F.concat_ws("; ", head, *texts).alias("line")


def _format(form: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string(form, value))


def _number(name: str, form: str, value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return _line(name, _format(form, column))


def _line(name: str, text: Column) -> Column:
    return F.concat(F.lit(name), text)


def _rows(section: int, item: Column, lines: list[Column]) -> Column:
    structs = [
        F.struct(
            F.lit(section).alias("section"),
            item.cast("int").alias("item"),
            F.lit(n).alias("n"),
            line.alias("line"),
        )
        for n, line in enumerate(lines)
    ]
    return F.inline(F.filter(F.array(*structs), lambda x: x["line"].isNotNull()))
