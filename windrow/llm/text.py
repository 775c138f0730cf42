"""Words and tables as all operators of this subpackage read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def words_of(text: Column | str) -> Column:
    """Array of words; null gives an empty array."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD), F.lit(0))


def listed(texts: pa.Array) -> list[str]:
    """Texts without nulls as a list, cut from one buffer: ``to_pylist`` takes many times as long for short ones."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return []
    if texts.null_count:
        raise ValueError("a text is null")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(bounds[0]), int(bounds[-1])
    data = bytes(memoryview(texts.buffers()[2] or b"")[first:last])
    bounds = (bounds - first).tolist()
    if data.isascii():
        whole = data.decode()
        return [whole[a:b] for a, b in zip(bounds, bounds[1:])]
    return [str(data[a:b], "utf-8") for a, b in zip(bounds, bounds[1:])]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
