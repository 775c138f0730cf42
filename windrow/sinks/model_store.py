"""Keep a model: its parameter table, with the optimizer's state, and a manifest of its slices.

The slices are written first, then the manifest, from what is stored: one row for each slice, with its
place, size and digest. A model without a manifest was never finished, and one whose slices differ
from it was changed or lost since; both are refused when it is read.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES, MANIFEST = "slices", "manifest"
PLACE = ("state", "layer", "kind", "slice_id")


class TornModel(ValueError):
    """The folder holds no whole model."""


def write_model(
    parameters: DataFrame, folder: str, at: int | None = None, mode: str = "errorifexists", epoch: int | None = None
) -> str:
    """Write a model under a name with the time in epoch seconds; returns the path.

    Whoever finds the manifest finds all slices. ``epoch`` is kept with it.
    """
    path = f"{folder.rstrip('/')}/model_{int(time.time()) if at is None else at}"
    spark = parameters.sparkSession
    parameters.write.mode(mode).parquet(f"{path}/{SLICES}")
    stored = spark.read.schema(parameters.schema).parquet(f"{path}/{SLICES}")
    name, number = F.lit(path.rsplit("/", 1)[1]), F.lit(epoch).cast("int")
    rows = _digests(stored).select(name.alias("model"), number.alias("epoch"), *PLACE, "rows", "cols", "n", "digest")
    rows.write.mode(mode).parquet(f"{path}/{MANIFEST}")
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``model, epoch, state, layer, kind, slice_id, rows, cols, n, digest`` of a stored model."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}/_SUCCESS")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        raise TornModel(f"the model has no manifest, it was not finished: {path}")
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_model(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The parameter table of a stored model, ready for ``predict``.

    With ``check``, every slice is held against the manifest by one job over both.
    """
    manifest = read_manifest(spark, path)
    stored = spark.read.parquet(f"{path}/{SLICES}")
    if check:
        own, kept = _digests(stored), manifest.select(*PLACE, "n", "digest")
        both = own.select(*PLACE, "n", "digest").unionByName(kept).groupBy(*PLACE, "n", "digest").agg(F.count("*").alias("times"))
        odd = both.where("times <> 2").agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("first")).first()
        if odd["n"]:
            raise TornModel(f"slices differ from the manifest, first {tuple(odd['first'])}: {path}")
    return stored


def _digests(slices: DataFrame) -> DataFrame:
    return slices.select(
        *PLACE, "rows", "cols", F.size("vals").cast("bigint").alias("n"), F.xxhash64("vals").alias("digest")
    )
