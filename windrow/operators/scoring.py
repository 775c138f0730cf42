"""Predictions of a model, and figures on predictions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import vectors as V
from windrow.operators import parameters as P
from windrow.operators.arrow_examples import Layout, chunks, list_array, matrix
from windrow.operators.network import Network, hits
from windrow.session import ship_package

# Fixed value: a prediction whose cosine with its label is above this counts as a hit.
HIT_THRESHOLD = 0.5


def predict(
    examples: DataFrame,
    parameters: DataFrame,
    features: str = "features",
    pred: str = "pred",
    broadcast_bytes: int = P.BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``pred array<double>`` to every row; features are fitted to the model's input width."""
    ship_package(examples.sparkSession)
    sizes = P.sizes_of(parameters)
    # A forward pass needs no optimizer.
    handle = P.deliver(parameters.where("state = 'value'"), sizes, broadcast_bytes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = None
        for batch in batches:
            network = network or Network(sizes, handle.theta())
            out = network.forward(matrix(batch.column("_fitted"), sizes[0]))
            kept = [c for n, c in zip(batch.schema.names, batch.columns) if n != "_fitted"]
            names = [n for n in batch.schema.names if n != "_fitted"]
            yield pa.RecordBatch.from_arrays([*kept, list_array(out)], names=[*names, pred])

    schema = examples.select("*", F.lit(None).cast("array<double>").alias(pred)).schema
    return examples.withColumn("_fitted", V.fit_width(features, sizes[0])).mapInArrow(score, schema)


def evaluate(
    frame: DataFrame, layout: Layout, handle: P.Handle, sizes: Sequence[int], threshold: float = HIT_THRESHOLD
) -> DataFrame:
    """``split, n_rows, loss, accuracy`` of a model over all rows of a training frame, in one job.

    The same figures as ``loss`` and ``hit_rate`` of predictions, which are not written out here.
    """
    widths = list(sizes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        network = None
        for features, label, splits in chunks(batches, layout):
            network = network or Network(widths, handle.theta())
            out = network.forward(features)
            away = out - label
            error = np.einsum("ij,ij->i", away, away) / out.shape[1]
            places = splits.astype(np.int64)
            found = [np.bincount(places, values) for values in (None, error, hits(out, label, threshold))]
            for split in np.flatnonzero(found[0]).tolist():
                sums[split] = sums.get(split, 0.0) + np.array([x[split] for x in found], float)
        for split, (n, error, n_hits) in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"split": pa.array([split], pa.int32()), "n": [n], "error": [error], "hits": [n_hits]}
            )

    parts = frame.select(*layout.columns()).mapInArrow(score, "split int, n double, error double, hits double")
    rows = F.sum("n")
    return parts.groupBy("split").agg(
        rows.cast("bigint").alias("n_rows"),
        (F.sum("error") / rows).alias("loss"),
        (100.0 * F.sum("hits") / rows).alias("accuracy"),
    )


def loss(scored: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """One row, ``loss``: mean squared error over elements, then over rows; null if there are none."""
    return scored.agg(F.avg(V.squared_error(pred, label)).alias("loss"))


def with_cosine(scored: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    return scored.withColumn("cosine", V.cosine_similarity(pred, label))


def hit_rate(
    scored: DataFrame, pred: str = "pred", label: str = "label", threshold: float = HIT_THRESHOLD
) -> DataFrame:
    """One row, ``accuracy``: percent of rows with a cosine above the threshold; a null is a miss."""
    hit = F.coalesce(V.cosine_similarity(pred, label) > threshold, F.lit(False))
    return scored.agg(F.coalesce(100.0 * F.avg(hit.cast("double")), F.lit(0.0)).alias("accuracy"))


def vector_stats(
    vectors: DataFrame, vector: str, groups: Sequence[str] = (), sample: bool = False
) -> DataFrame:
    """``groups, norm, min, max, mean, std`` of all elements of a group's vectors, as one long vector."""
    x = F.col("_x")
    spread = F.stddev_samp(x) if sample else F.stddev_pop(x)
    elements = vectors.select(*groups, F.explode(vector).alias("_x"))
    return elements.groupBy(*groups).agg(
        F.sqrt(F.sum(x * x)).alias("norm"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        spread.alias("std"),
    )
