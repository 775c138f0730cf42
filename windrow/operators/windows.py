"""Context windows: ``width`` items in a row and the item after them, at every start.

Both input forms first become blocks, rows that hold up to ``block_rows`` consecutive items and the
``width`` items that follow. A block owns the windows that start in it, so every window comes out
once, and no row or group grows with the length of a sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def blocks_from_arrays(
    df: DataFrame, width: int, items: str, seq: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``seq, block_start, items`` from one row per sequence. No shuffle."""
    _check(width, block_rows)
    n = F.size(items)
    cut = F.transform(
        F.sequence(F.lit(0), n - (width + 1), F.lit(block_rows)),
        lambda s: F.struct(
            s.cast("bigint").alias("block_start"),
            F.slice(F.col(items), s + 1, F.lit(block_rows + width)).alias("items"),
        ),
    )
    # A condition inside the generator: as a filter it would be pushed below the tokens and make them twice.
    return df.select(*seq, F.inline(F.when(n > width, cut)))


def blocks_from_rows(
    df: DataFrame,
    width: int,
    value: str,
    seq: Sequence[str] = (),
    pos: str = "pos",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``seq, block_start, items`` from one row per item. ``pos`` counts 0, 1, 2, … in each sequence.

    One shuffle, by sequence and block.
    """
    return gather_blocks(assign_blocks(df, width, pos, block_rows), width, value, seq, pos, block_rows)


def assign_blocks(df: DataFrame, width: int, pos: str = "pos", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``_block``; the first ``width`` rows of a block come out for the one before as well.

    That is why blocks are at least ``width`` long.
    """
    _check(width, block_rows)
    length = max(width, block_rows)
    block = F.expr(f"`{pos}` div {length}")
    lent = (F.col(pos) % length < width) & (F.col(pos) >= length)
    return df.withColumn("_block", F.explode(F.when(lent, F.array(block - 1, block)).otherwise(F.array(block))))


def gather_blocks(
    assigned: DataFrame,
    width: int,
    value: str,
    seq: Sequence[str] = (),
    pos: str = "pos",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``seq, block_start, items`` of assigned rows. No shuffle if they are already spread by block."""
    length = max(width, block_rows)
    # Places and values in lists of their own: a pair for each item would be shuffled with three more words. Lists
    # leave nulls out, so the places of null values have a third one.
    place, here = (F.col(pos) - F.col("_block") * length).cast("int"), F.col(value).isNotNull()
    none = F.lit(None).cast(assigned.schema[value].dataType)
    pairs = F.zip_with("_at", "_values", lambda p, v: F.struct(p.alias("p"), v.alias("v")))
    empty = F.transform("_nulls", lambda p: F.struct(p.alias("p"), none.alias("v")))
    return (
        assigned.groupBy(*seq, "_block")
        .agg(
            F.collect_list(F.when(here, place)).alias("_at"),
            F.collect_list(value).alias("_values"),
            F.collect_list(F.when(~here, place)).alias("_nulls"),
        )
        .select(
            *seq,
            (F.col("_block") * length).alias("block_start"),
            F.transform(F.sort_array(F.concat(pairs, empty)), lambda x: x["v"]).alias("items"),
        )
    )


def windows_of(blocks: DataFrame, width: int, seq: Sequence[str] = ()) -> DataFrame:
    """``seq, start, ctx, target`` of every window in the blocks."""
    cut = F.transform(
        F.sequence(F.lit(0), F.size("items") - (width + 1)),
        lambda i: F.struct(
            F.slice("items", i + 1, F.lit(width)).alias("ctx"),
            F.get("items", i + width).alias("target"),
        ),
    )
    cut = F.when(F.size("items") > width, cut)
    return (
        blocks.select(*seq, "block_start", F.posexplode(cut).alias("_i", "_w"))
        .select(*seq, (F.col("block_start") + F.col("_i")).alias("start"), "_w.ctx", "_w.target")
    )


def windows_from_arrays(
    df: DataFrame, width: int, items: str, seq: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    return windows_of(blocks_from_arrays(df, width, items, seq, block_rows), width, seq)


def windows_from_rows(
    df: DataFrame,
    width: int,
    value: str,
    seq: Sequence[str] = (),
    pos: str = "pos",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    return windows_of(blocks_from_rows(df, width, value, seq, pos, block_rows), width, seq)


def _check(width: int, block_rows: int) -> None:
    if width < 1:
        raise ValueError("window width must be positive")
    if block_rows < 1:
        raise ValueError("block length must be positive")
