"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors lie in blocks, dimension by dimension. For a query, scores add up dimension block by
dimension block. What the remaining dimensions can still add is at most the product of the
remaining masses (norms) of query and candidate; candidates that cannot reach the k-th best score
any more are compacted away before the next dimensions are read. Every block of candidates meets
every block of queries, so nothing is broadcast and no task holds more than one block of either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.session import ship_package

K = 10
#: Rows in a block of candidates and of queries.
CANDIDATES, QUERIES = 1 << 14, 1 << 9
#: Dimensions read between two rounds of pruning.
DIMENSIONS = 16
EXACT, LARGEST = 1 << 53, np.iinfo(np.int64).max


def floored(vector: Column | str, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as array<bigint>; null if the vector or a component is none.

    Null and non-finite components count as none; products beyond a long become its limits.
    """
    column = F.col(vector) if isinstance(vector, str) else vector
    whole = F.transform(column, lambda x: x.cast("double"))
    bad = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(whole, lambda x: F.floor(x * scale).cast("bigint")))


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Dimensions by rows, filled with zeros."""
    found = np.zeros((width, len(vectors)), np.int64)
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy()
    length = np.diff(offsets)
    row = np.repeat(np.arange(len(vectors)), length)
    column = np.arange(int(offsets[0]), int(offsets[-1])) - np.repeat(offsets[:-1], length)
    found[column, row] = values[offsets[0] : offsets[-1]]
    return found


def _exact_scores(block: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Scores that don't fit into a long become its limits."""
    total = (block.astype(object) * query.astype(object)[:, None]).sum(axis=0)
    return np.array([max(-LARGEST - 1, min(LARGEST, int(t))) for t in total], np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(
    ids: np.ndarray, block: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, scores): the k best of a block for each query, its own row left out.

    ``block`` and ``queries`` hold whole numbers, dimensions by rows.
    """
    width, n = block.shape
    largest = float(np.abs(block.astype(float)).max(initial=0)), float(np.abs(queries.astype(float)).max(initial=0))
    if width * largest[0] * largest[1] >= EXACT:  # doubles could round: no pruning, exact whole numbers
        for i, own in enumerate(query_ids.tolist()):
            scores = _exact_scores(block, queries[:, i])
            others = np.flatnonzero(ids != own)
            # Whole numbers below the limits sort by themselves; negation must not overflow.
            best = others[np.lexsort((ids[others], ~scores[others]))[:k]]
            yield own, ids[best], scores[best]
        return
    block, queries = block.astype(np.float64), queries.astype(np.float64)
    cuts = list(range(0, width, DIMENSIONS)) + [width]
    # What is left of the squared norms from each cut on.
    mass = np.stack([np.sqrt((block[a:] ** 2).sum(axis=0)) for a in cuts])
    own_mass = np.stack([np.sqrt((queries[a:] ** 2).sum(axis=0)) for a in cuts])
    for i, own in enumerate(query_ids.tolist()):
        alive = np.flatnonzero(ids != own)
        score = np.zeros(len(alive))
        for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = block[a:b] if len(alive) == n else block[a:b, alive]
            score += queries[a:b, i] @ part
            if len(alive) > k and b < width:
                reach = mass[c + 1, alive] * own_mass[c + 1, i] * (1 + 1e-9) + 1
                least = np.partition(score - reach, len(score) - k)[len(score) - k]
                stay = score + reach >= least
                alive, score = alive[stay], score[stay]
        if len(alive) > k:  # ties at the k-th score all stay for the order by id
            stay = score >= np.partition(score, len(score) - k)[len(score) - k]
            alive, score = alive[stay], score[stay]
        best = _best(ids[alive], score, k)
        yield own, ids[alive[best]], score[best].astype(np.int64)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates for each query, ties to smaller ids.

    Both inputs are ``vec_id, vector`` with array<bigint>; a null vector or id takes no part; a
    shorter vector counts as filled with zeros. A candidate with the query's own id is left out.
    Rows that repeat an id are candidates each for itself, and a query id is answered once, by its
    first vector in the order of arrays. With fewer than k candidates all are returned; empty tables
    give no rows. Candidates stay in their blocks; queries travel once to each of them.
    """
    spark = candidates.sparkSession
    ship_package(spark)
    whole = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    candidates = candidates.select("vec_id", "vector").where(whole)
    queries = queries.select("vec_id", "vector").where(whole).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n_rows = candidates.count()
    n_blocks = max(1, -(-n_rows // CANDIDATES))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    placed = candidates.withColumn("block", block).withColumn("query", F.lit(False))
    sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn(
        "query", F.lit(True)
    )
    # In each partition the candidates of a block come before the queries that it is searched for.
    rows = placed.unionByName(sent).repartitionById(n_blocks, "block").sortWithinPartitions("query", "vec_id", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        ids = None
        for batch in batches:
            n_own = batch.num_rows - int(np.count_nonzero(batch.column("query").to_numpy(zero_copy_only=False)))
            if n_own:
                held.append(batch.slice(0, n_own))
            asked = batch.slice(n_own)
            for at in range(0, asked.num_rows, QUERIES):
                part = asked.slice(at, QUERIES)
                if not held:
                    return
                if ids is None:
                    own = pa.Table.from_batches(held).combine_chunks()
                    ids = own.column("vec_id").to_numpy()
                    vectors = own.column("vector").combine_chunks()
                width = int(max(np.diff(vectors.offsets.to_numpy()).max(), np.diff(part.column("vector").offsets.to_numpy()).max()))
                query_ids = part.column("vec_id").to_numpy()
                found = list(search_block(ids, _matrix(vectors, width), query_ids, _matrix(part.column("vector"), width), k))
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": np.concatenate([np.full(len(i), q) for q, i, _ in found]),
                        "vec_id": np.concatenate([i for _, i, _ in found]),
                        "score": np.concatenate([s for _, _, s in found]),
                    }
                )

    found = rows.select("vec_id", "vector", "query").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    # A block gives k rows a query at most; of those, each task passes on no more than k.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
