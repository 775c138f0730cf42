"""Vector text files: one token a line, its id, a tab, and its numbers in optional brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The separators of the format, and what counts as a token id or as a special number.
FIELD_SEPARATOR = "\t"
ELEMENT_SEPARATOR = ","
TOKEN_PATTERN = r"^[+-]?[0-9]+\z"
SPECIAL_NUMBER = r"^[\x00-\x20]*[+-]?(NaN|Infinity)[\x00-\x20]*\z"

# Columns that put the lines of text files in order, and the range of the finest one.
FILE_ORDER = ("file", "piece", "row")
ROW_SPAN = (0, (1 << 32) - 1)
# monotonically_increasing_id counts the rows of a partition in its lower bits.
ROW_BITS = 33


def read_vectors(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``file, piece, row, token int, embedding array<double>``, read in parallel.

    The first three columns, ``FILE_ORDER``, give the place of the line: file, then byte offset of
    the input split, then a number that ascends within the split. They cost no extra pass.
    With ``strict`` a bad line fails the query; without, its token and embedding are null.
    """
    return parse_lines(read_lines(spark, path), "line", strict).drop("line")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, piece, row, line`` of text files."""
    row_in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"),
        row_in_partition.alias("row"),
        F.col("value").alias("line"),
    )


def parse_lines(lines: DataFrame, line: str = "line", strict: bool = True) -> DataFrame:
    """Adds ``token`` and ``embedding``, parsed from the column ``line``."""
    if strict:
        fail = F.raise_error(F.concat(F.lit("bad vector line: "), F.coalesce(F.col(line), F.lit("null"))))
    else:
        fail = F.lit(None)
    parsed = F.struct(
        _token_text(line).try_cast("int").alias("token"),
        F.transform(_number_texts(line), lambda x: x.try_cast("double")).alias("embedding"),
    )
    return (
        lines.withColumn("_parsed", F.when(is_good_line(line), parsed).otherwise(fail))
        .withColumn("token", F.col("_parsed.token"))
        .withColumn("embedding", F.col("_parsed.embedding"))
        .drop("_parsed")
    )


def bad_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The lines that strict parsing fails on."""
    return lines.where(~is_good_line(line))


def is_good_line(line: str = "line") -> Column:
    """True when the line has a token id, one tab and numbers, and nothing else."""
    token = _token_text(line)
    token_ok = token.rlike(TOKEN_PATTERN) & token.try_cast("int").isNotNull()
    numbers_ok = F.forall(_number_texts(line), _is_number)
    return F.coalesce((F.size(_parts(line)) == 2) & token_ok & numbers_ok, F.lit(False))


def _is_number(x: Column) -> Column:
    # The cast also knows short and lower-case names of the special numbers, which the format does not.
    named = x.rlike("(?i)inf|nan")
    return x.try_cast("double").isNotNull() & (~named | x.rlike(SPECIAL_NUMBER))


def format_lines(vectors: DataFrame, token: str = "token", embedding: str = "embedding") -> DataFrame:
    """The inverse of parsing: adds a ``line`` in the text format."""
    numbers = F.array_join(F.col(embedding).cast("array<string>"), ELEMENT_SEPARATOR)
    text = F.concat(F.col(token).cast("string"), F.lit(FIELD_SEPARATOR + "["), numbers, F.lit("]"))
    return vectors.withColumn("line", text)


def _parts(line: str) -> Column:
    # Empty parts at the end do not count.
    return F.split(F.regexp_replace(F.col(line), r"\t+\z", ""), FIELD_SEPARATOR)


def _token_text(line: str) -> Column:
    return F.get(_parts(line), F.lit(0))


def _number_texts(line: str) -> Column:
    body = F.get(_parts(line), F.lit(1))
    for bracket in (r"^\[", r"\]\z"):
        body = F.regexp_replace(body, bracket, "")
    # Empty pieces at the end do not count, so separators alone make an empty vector.
    kept = F.regexp_replace(body, r",+\z", "")
    return F.when((kept == "") & (body != ""), F.array().cast("array<string>")).otherwise(
        F.split(kept, ELEMENT_SEPARATOR)
    )
