"""Expressions on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: base of the position code.
POSITION_BASE = 10000.0


def as_doubles(vector: Column | str) -> Column:
    return _col(vector).cast("array<double>")


def position_code(position: Column | str, width: int, published: bool = False) -> Column:
    """Sine and cosine code of a position, ``width`` numbers long.

    Pair (j, j+1), j even, holds sin and cos of position / 10000^(2j/width). The usual published
    form (Vaswani et al. 2017) has half that exponent: ask for it with ``published=True``.
    The powers are constants of the width, made here: Spark's own are off in their last bit, which
    at a position of a million moves an angle by 1e-10.
    """
    if width < 2 or width % 2:
        raise ValueError(f"position codes need an even width, got {width}")
    per_slot = 1.0 if published else 2.0
    at = _col(position).cast("double")
    powers = F.array(*[F.lit(POSITION_BASE ** (per_slot * (j - j % 2) / width)) for j in range(width)])

    def slot(power: Column, j: Column) -> Column:
        angle = at / power
        return F.when(j % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))

    return F.transform(powers, slot)


def position_codes(spark: SparkSession, slots: int, width: int, published: bool = False) -> DataFrame:
    """One row per slot of a window: ``position, code``."""
    return spark.range(slots).select(
        F.col("id").alias("position"), position_code("id", width, published).alias("code")
    )


def window_codes(spark: SparkSession, slots: int, width: int, published: bool = False) -> Column:
    """The codes of all slots in one flat array, computed once per query as a scalar subquery."""
    codes = F.transform(
        F.sequence(F.lit(0), F.lit(slots - 1)), lambda k: position_code(k, width, published)
    )
    return spark.range(1).select(F.flatten(codes)).scalar()


def add(left: Column | str, right: Column | str) -> Column:
    """Element-wise sum; vectors of different width are an error."""
    a, b = _col(left), _col(right)
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: x + y)).otherwise(
        F.raise_error(F.lit("cannot add vectors of different width"))
    )


def fit_width(vector: Column | str, width: int) -> Column:
    """Keep the first ``width`` elements, or fill up with zeros at the right end."""
    v = _col(vector)
    if width < 1:
        raise ValueError("width must be positive")
    return (
        F.when(F.size(v) == width, v)
        .when(F.size(v) > width, F.slice(v, 1, width))
        .otherwise(F.concat(v, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(v))))
    )


def dot(left: Column | str, right: Column | str) -> Column:
    return total(F.zip_with(_col(left), _col(right), lambda x, y: x * y))


def total(vector: Column | str) -> Column:
    return F.aggregate(_col(vector), F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column | str) -> Column:
    v = _col(vector)
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def squared_error(pred: Column | str, label: Column | str) -> Column:
    """Mean over the elements of the squared difference; null if a side is null or widths differ."""
    p, y = _col(pred), _col(label)
    squares = F.zip_with(p, y, lambda a, b: (a - b) * (a - b))
    return F.when(F.size(p) == F.size(y), total(squares) / F.size(y))


def cosine_similarity(pred: Column | str, label: Column | str) -> Column:
    """Cosine of the angle; 0 if a norm is 0 or the widths differ, null if a side is null."""
    p, y = _col(pred), _col(label)
    lengths = norm(p) * norm(y)
    return (
        F.when(p.isNull() | y.isNull(), F.lit(None).cast("double"))
        .when((F.size(p) == F.size(y)) & (lengths > 0), dot(p, y) / lengths)
        .otherwise(F.lit(0.0))
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
