"""From windows to examples: a feature row and a label row per window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions import vectors as V
from windrow.operators.arrow_examples import code_matrix, write_token_windows, write_vectors, write_windows
from windrow.operators.lookup import BROADCAST_BYTES, _attach_broadcast, attach_shuffled, check_unique, fits_broadcast
from windrow.operators.windows import (
    BLOCK_ROWS,
    assign_blocks,
    blocks_from_arrays,
    blocks_from_rows,
    gather_blocks,
)
from windrow.session import ship_package

# Doubles that one row may hold while windows are cut from it.
ROW_DOUBLES = 1 << 20


def vector_blocks(blocks: DataFrame, vector_width: int, seq: Sequence[str] = ()) -> DataFrame:
    """``seq, block_start, flat``: the vectors of a block, one after another, each stored once.

    This is the compact form of examples: ``examples_of`` writes every window out, the trainer cuts
    windows from it on the fly. A vector of another width than ``vector_width`` is an error.
    """
    same_width = F.forall("items", lambda v: F.size(v) == vector_width)
    flat = F.when(same_width, F.flatten(F.col("items").cast("array<array<double>>"))).otherwise(
        F.raise_error(F.lit(f"a vector is null or not {vector_width} wide"))
    )
    return blocks.select(*seq, "block_start", flat.alias("flat"))


def examples_of(
    compact: DataFrame, width: int, vector_width: int, seq: Sequence[str] = (), published: bool = False
) -> DataFrame:
    """``seq, start, features, label`` of every window in vector blocks.

    Features are the context vectors, each plus the code of its slot, in slot order; the label is
    the plain vector of the target. Cut from Arrow buffers: array functions box each element, and
    took three to four times as long (``examples_by_expression``).
    """
    ship_package(compact.sparkSession)
    codes = code_matrix(compact.sparkSession, width, vector_width, published)
    keys = list(seq)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return write_windows(batches, keys, codes)

    return compact.select(*keys, "block_start", "flat").mapInArrow(write, _example_schema(compact, keys))


def _example_schema(blocks: DataFrame, keys: Sequence[str]) -> T.StructType:
    numbers = T.ArrayType(T.DoubleType())
    made = [
        T.StructField("start", T.LongType()),
        T.StructField("features", numbers),
        T.StructField("label", numbers),
    ]
    return T.StructType([*(blocks.schema[c] for c in keys), *made])


def token_blocks(
    df: DataFrame, width: int, tokens: str = "tokens", seq: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``seq, block_start, items array<string>`` from one row per sequence. No shuffle."""
    blocks = blocks_from_arrays(df, width, tokens, seq, block_rows)
    return blocks.select(*seq, "block_start", F.col("items").cast("array<string>").alias("items"))


def examples_of_tokens(
    blocks: DataFrame, width: int, vector_width: int, seq: Sequence[str] = (), seed: int = 12345, published: bool = False
) -> DataFrame:
    """``examples_of`` from blocks of tokens, whose stand-in vectors are made in the same task; a null token is an error."""
    ship_package(blocks.sparkSession)
    codes = code_matrix(blocks.sparkSession, width, vector_width, published)
    keys = list(seq)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return write_token_windows(batches, keys, codes, seed)

    return blocks.select(*keys, "block_start", "items").mapInArrow(write, _example_schema(blocks, keys))


def examples_by_expression(
    compact: DataFrame, width: int, vector_width: int, seq: Sequence[str] = (), published: bool = False
) -> DataFrame:
    """The same rows from built-in expressions alone, for sessions without Python workers."""
    w, d = width, vector_width
    step = max(1, ROW_DOUBLES // (w * d))
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("flat") / d).cast("int") - (w + 1), F.lit(step)),
        lambda s: F.struct(s.alias("s"), F.slice("flat", s * d + 1, F.lit((step + w) * d)).alias("part")),
    )
    cut = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("part") / d).cast("int") - (w + 1)),
        lambda i: F.struct(
            F.slice("part", i * d + 1, F.lit(w * d)).alias("ctx"),
            F.slice("part", (i + w) * d + 1, F.lit(d)).alias("label"),
        ),
    )
    codes = V.window_codes(compact.sparkSession, w, d, published)
    return (
        compact.select(*seq, "block_start", F.inline(F.when(F.size("flat") > w * d, pieces)))
        .select(*seq, (F.col("block_start") + F.col("s")).alias("_at"), F.posexplode(cut).alias("_i", "_w"))
        .select(*seq, (F.col("_at") + F.col("_i")).alias("start"), "_w.ctx", "_w.label", codes.alias("_codes"))
        .select(*seq, "start", V.add("ctx", "_codes").alias("features"), "label")
    )


def compact_from_rows(
    rows: DataFrame,
    width: int,
    vector_width: int,
    seq: Sequence[str] = (),
    pos: str = "pos",
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Vector blocks from one row per token that already has its vector."""
    blocks = blocks_from_rows(rows, width, embedding, seq, pos, block_rows)
    return vector_blocks(blocks, vector_width, seq)


def compact_from_tokens(
    df: DataFrame,
    width: int,
    vector_width: int,
    tokens: str = "tokens",
    seq: Sequence[str] = (),
    seed: int = 12345,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Vector blocks from one row per sequence, with stand-in vectors made from each token. No shuffle."""
    blocks, keys = token_blocks(df, width, tokens, seq, block_rows), list(seq)
    ship_package(df.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return write_vectors(batches, keys, vector_width, seed)

    made = [T.StructField("block_start", T.LongType()), T.StructField("flat", T.ArrayType(T.DoubleType()))]
    return blocks.mapInArrow(write, T.StructType([*(blocks.schema[c] for c in keys), *made]))


def compact_from_lookup(
    tokens: DataFrame,
    vocabulary: DataFrame,
    width: int,
    vector_width: int,
    seq: Sequence[str] = (),
    pos: str = "pos",
    token: str = "token",
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Vector blocks from token rows and a lookup; an unknown token is an error.

    With a lookup that can be broadcast, tokens are spread by block first and get their vectors
    there, so that only tokens are shuffled. A larger lookup is joined before, and vectors move.
    """
    placed = assign_blocks(tokens.select(*seq, pos, token), width, pos, block_rows)
    check_unique(vocabulary, token)
    if fits_broadcast(vocabulary, broadcast_bytes, vector_width, token):
        rows = _attach_broadcast(placed.repartition(*seq, "_block"), vocabulary, token)
    else:
        rows = attach_shuffled(placed, vocabulary, token)
    blocks = gather_blocks(rows, width, "embedding", seq, pos, block_rows)
    return vector_blocks(blocks, vector_width, seq)


def create_examples(
    tokens: DataFrame,
    vocabulary: DataFrame,
    width: int,
    vector_width: int,
    seq: Sequence[str] = (),
    pos: str = "pos",
    token: str = "token",
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    published: bool = False,
) -> DataFrame:
    """``seq, start, features, label`` from token rows and a lookup."""
    compact = compact_from_lookup(
        tokens, vocabulary, width, vector_width, seq, pos, token, block_rows, broadcast_bytes
    )
    return examples_of(compact, width, vector_width, seq, published)


def fit_examples(examples: DataFrame, input_size: int, output_size: int) -> DataFrame:
    """Cut or zero-fill features and label at the right end to the widths of a model."""
    return examples.withColumn("features", V.fit_width("features", input_size)).withColumn(
        "label", V.fit_width("label", output_size)
    )
