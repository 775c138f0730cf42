"""Places in an order, without sorting a whole sequence in one task.

A window over ``partitionBy(seq).orderBy(key)`` puts each sequence in one task, and a global order
in one task altogether. Two ways avoid that. An integer key is cut into ranges of 2^16 values: rows
are numbered within their range, and the totals of the ranges, a table about 2^16 times smaller for
dense keys, are summed up the same way. Any other order, also one of several columns, is cut where
a sample of it says: every range is sorted and summed by a task, and stored. A range begins in at
most one sequence that began before, so the totals to carry on are two rows a range; neither
the number of files, nor one file, nor one sequence meets in a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.session import dropping_shuffles, run_folder, ship_package

RANGE_BITS = 16
NULLS = "null in the columns of a sequence or of its order"
TIES = "rows of a sequence have the same order"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def dense_positions(
    df: DataFrame,
    order: str | Sequence[str],
    seq: Sequence[str] = (),
    name: str = "pos",
    span: tuple[int, int] | None = None,
    range_bits: int = RANGE_BITS,
    folder: str | None = None,
) -> DataFrame:
    """Adds ``name``: 0, 1, 2, … in the given order within each sequence."""
    return running_total(df, order, F.lit(1), seq, name, span, range_bits, folder)


def running_total(
    df: DataFrame,
    order: str | Sequence[str],
    weight: Column,
    seq: Sequence[str] = (),
    name: str = "offset",
    span: tuple[int, int] | None = None,
    range_bits: int = RANGE_BITS,
    folder: str | None = None,
) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over the earlier rows of the same sequence.

    ``order`` lists one or more columns of any type that can be ordered, coarse to fine, unique
    together within a sequence. For a single integer, ``span`` is its range, looked up with a min/max
    job if not given; other orders need none, see ``ranged_total``. Nulls and ties are errors. ``folder`` is
    where stored ranges go, for a caller that removes them.
    """
    columns = [order] if isinstance(order, str) else list(order)
    if len(columns) > 1 or not isinstance(df.schema[columns[0]].dataType, _INTEGRAL):
        return ranged_total(df, columns, weight, seq, name, folder=folder)
    out = _within(df.withColumn("_w", weight.cast("bigint")), list(seq), columns[0], name, span, range_bits)
    missing = F.raise_error(F.lit(NULLS))
    return out.withColumn(name, F.coalesce(name, missing)).drop("_w")


def ranged_total(
    df: DataFrame,
    order: Sequence[str],
    weight: Column,
    seq: Sequence[str] = (),
    name: str = "offset",
    n_ranges: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """``running_total`` over any order, through ranges of it: as many as the session's shuffle partitions, if not given.

    The rows are stored with their sums within the range, so that ranges stay what they are; the
    totals of the sequences that go on from one range to another are joined to them.
    """
    spark = df.sparkSession
    ship_package(spark)
    folder, keys = folder or run_folder(spark, "positions"), [*seq, *order]
    n_ranges = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows and keys travel in structs, so that no name can clash.
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    made = df.select(key.alias("_k"), weight.cast("bigint").alias("_w"), F.struct("*").alias("_row"))
    fields = [f"_k.k{i}" for i in range(len(keys))]
    placed = made.repartitionByRange(n_ranges, *fields).sortWithinPartitions(*fields)
    placed = placed.withColumn("_part", F.spark_partition_id())
    n_seq = len(seq)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, first = None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.column("_k").flatten()
            if any(c.null_count for c in columns):
                raise ValueError(NULLS)
            changes = [_changes(c, None if last is None else last[i]) for i, c in enumerate(columns)]
            # At the very first row a sequence begins, or goes on from the range before.
            new = np.any(changes[:n_seq], axis=0) if n_seq else np.zeros(batch.num_rows, bool)
            same = ~np.any(changes, axis=0)
            if last is None:
                same[0] = new[0] = False
            if same.any():
                raise ValueError(TIES)
            weights = batch.column("_w").fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(weights) + total
            begin = np.flatnonzero(new)
            before = ends - weights
            base = np.zeros(batch.num_rows, np.int64)
            base[begin] = np.diff(before[begin], prepend=0)
            local = before - np.cumsum(base)
            heads = np.cumsum(new) == 0 if first else np.zeros(batch.num_rows, bool)
            first = first and bool(heads[-1])
            total = int(local[-1] + weights[-1])
            last = [c[-1] for c in columns]
            yield batch.append_column("_local", pa.array(local, pa.int64())).append_column("_head", pa.array(heads))

    schema = placed.withColumn("_local", F.lit(0).cast("bigint")).withColumn("_head", F.lit(True)).schema
    with dropping_shuffles(spark):
        placed.mapInArrow(sums, schema).write.parquet(folder)
    stored = spark.read.parquet(folder)
    sequence = [F.col(f"_k.k{i}").alias(f"_s{i}") for i in range(n_seq)]
    names = ["_part", *(f"_s{i}" for i in range(n_seq))]
    totals = stored.select("_part", *sequence, "_w", "_head")
    if n_seq:
        # Sequences that a range begins with; others lie in one range, or end where they began.
        open_ = totals.where("_head").select(*names[1:]).distinct()
        totals = totals.join(open_, names[1:], "left_semi")
    totals = totals.groupBy(*names).agg(F.sum("_w").alias("_w"))
    before = Window.partitionBy(*names[1:] or [F.lit(0)]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.sum("_w").over(before)).drop("_w")
    out = stored.select("*", *sequence).join(totals, names, "left")
    return out.select("_row.*", (F.col("_local") + F.coalesce("_before", F.lit(0))).alias(name))


def _changes(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Does a value differ from the one before it?"""
    found = np.ones(len(column), bool)
    if pa.types.is_nested(column.type):
        values = column.to_pylist()
        found[1:] = [x != y for x, y in zip(values[1:], values)]
        found[0] = before is None or values[0] != before.as_py()
        return found
    found[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    found[0] = before is None or column[0] != before
    return found


def _within(
    df: DataFrame, seq: list[str], key: str, name: str, span: tuple[int, int] | None, bits: int
) -> DataFrame:
    if span is None:
        low, high = df.agg(F.min(key), F.max(key)).first()
        span = (low, high) if low is not None else (0, 0)
    low, high = span
    levels = _levels(int(high) - int(low), bits)
    ranged = df.withColumn("_key", F.col(key).cast("bigint") - F.lit(int(low)))
    return _ranged(ranged, seq, name, levels, bits).drop("_key")


def _levels(width: int, bits: int) -> int:
    return max(1, -(-width.bit_length() // bits))


def _ranged(df: DataFrame, seq: list[str], name: str, levels: int, bits: int) -> DataFrame:
    if levels == 1:
        return df.withColumn(name, _sum_before(seq, "_key"))
    ranged = df.withColumn("_range", F.shiftright("_key", bits))
    totals = (
        ranged.groupBy(*seq, "_range").agg(F.sum("_w").alias("_w")).withColumnRenamed("_range", "_key")
    )
    above = _ranged(totals, seq, "_above", levels - 1, bits).select(
        *seq, F.col("_key").alias("_range"), F.col("_above").alias("_upper")
    )
    return (
        ranged.withColumn(name, _sum_before([*seq, "_range"], "_key"))
        .join(above, [*seq, "_range"], "left")
        .withColumn(name, F.col(name) + F.col("_upper"))
        .drop("_range", "_upper")
    )


def _sum_before(groups: list[str], key: str) -> Column:
    ordered = Window.partitionBy(*groups or [F.lit(0)]).orderBy(key)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("_w").over(before), F.lit(0).cast("bigint"))
    # Rows that tie would be numbered in any order, and in another one when they are computed again.
    tie = F.lag(key).over(ordered) == F.col(key)
    total = F.when(tie, F.raise_error(F.lit(TIES)).cast("bigint")).otherwise(total)
    return F.when(F.col(key).isNotNull(), total)
