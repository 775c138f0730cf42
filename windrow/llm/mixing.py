"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Documents are summed to cells, one for each combination of source, language and topic. Sweeps over
the margins rake the cells' weights until the weighted tokens have the target shares in every
margin. A margin's window runs over cells, which are few beside any table of documents. A document's
chance of being sampled follows from its cell's weight and from a hash of its key, so the sample
doesn't depend on the layout of the table. All steps are built-in expressions; the texts are read,
but only cells are shuffled.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.hashing import hash_unit
from windrow.llm.text import WORD
from windrow.session import run_folder

log = logging.getLogger(__name__)

#: Stands for a null category.
NONE = "(none)"
TOLERANCE, SWEEPS = 1e-8, 50
#: Sweeps that a job makes; the error is looked at after each of these.
SWEEPS_TOGETHER = 5
#: Copies of a document that one task makes.
MOST_AT_ONCE = 64


def word_count(text: Column | str) -> Column:
    """Tokens, counted as words; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(WORD)).cast("bigint")


def genre(text: Column | str) -> Column:
    """A topic that a text shows by its marks: tabular, symbolic, loud or prose."""
    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return (
        F.when(column.contains(" | "), "tabular")
        .when(column.rlike(r"[#$%&*]{3}"), "symbolic")
        .when(column.contains("!!"), "loud")
        .otherwise("prose")
    )


def category(column: Column | str) -> Column:
    found = F.col(column) if isinstance(column, str) else column
    return F.coalesce(found.cast("string"), F.lit(NONE))


def cells_of(documents: DataFrame, margins: Sequence[str], tokens: str) -> DataFrame:
    """One row per combination of categories: ``margins, tokens, n_docs``."""
    keys = [category(m).alias(m) for m in margins]
    return documents.groupBy(*keys).agg(
        F.coalesce(F.sum(tokens), F.lit(0)).cast("double").alias("tokens"), F.count("*").alias("n_docs")
    )


def smoothed(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """``category, share``: the margin's own shares of tokens, raised to a power below 1 to even them out."""
    sums = cells.groupBy(F.col(margin).alias("category")).agg(F.sum("tokens").alias("t"))
    raised = sums.withColumn("r", F.when(F.col("t") > 0, F.pow("t", F.lit(power))).otherwise(0.0))
    whole = raised.agg(F.sum("r").alias("all"))
    return raised.crossJoin(F.broadcast(whole)).select("category", F.try_divide("r", "all").alias("share"))


def fixed(cells: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """``category, share`` as the caller gives them."""
    return cells.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()], "category string, share double")


def margin_targets(cells: DataFrame, margin: str, shares: DataFrame) -> DataFrame:
    """``category, share`` for every category that has tokens, adding up to 1.

    Categories without a share of their own keep the one they have; shares of categories without
    tokens are left out and the others scaled up.
    """
    sums = cells.groupBy(F.col(margin).alias("category")).agg(F.sum("tokens").alias("t")).where("t > 0")
    named = sums.join(shares.groupBy("category").agg(F.sum("share").alias("share")), "category", "left")
    whole = named.agg(
        F.sum("t").alias("all"),
        F.coalesce(F.sum(F.when(F.col("share").isNull(), F.col("t"))), F.lit(0.0)).alias("left"),
        F.coalesce(F.sum("share"), F.lit(0.0)).alias("given"),
    )
    rest = F.col("left") / F.col("all")
    own = F.when(F.col("share").isNull(), F.col("t") / F.col("all")).otherwise(
        F.try_divide(F.col("share"), F.col("given")) * (1 - rest)
    )
    return named.crossJoin(F.broadcast(whole)).select("category", own.alias("share"))


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS
) -> DataFrame:
    """The cells with ``weight``, such that weighted tokens have the target shares in every margin.

    A sweep fits one margin after the other. Sweeps end when no margin was farther off than
    ``tolerance`` (as a part of its target), or after ``sweeps`` of them where targets contradict
    each other; ``remaining`` is how far off they ended. Cells without tokens get the weight of their
    margins' factors as well. The total of weighted tokens stays that of the tokens.
    """
    spark = cells.sparkSession
    folder = run_folder(spark, "raking")
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    # Targets are columns of the cells, so that a sweep needs no join.
    rows = cells.withColumn("weight", F.lit(1.0)).withColumn("off", F.lit(1.0))
    for i, (margin, shares) in enumerate(targets.items()):
        goal = margin_targets(cells, margin, shares).select(F.col("category").alias("_category"), F.col("share").alias(f"_share{i}"))
        rows = rows.join(goal, F.col(margin) == F.col("_category"), "left").drop("_category")
    rows.write.parquet(f"{folder}/0")
    number, off = 0, 1.0
    while off > tolerance and number < sweeps and total > 0:
        rows = spark.read.parquet(f"{folder}/{number}")
        for _ in range(min(SWEEPS_TOGETHER, sweeps - number)):
            number += 1
            rows = rows.withColumn("off", F.lit(0.0))
            for i, margin in enumerate(targets):
                held = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(margin))
                factor = F.coalesce(F.try_divide(F.col(f"_share{i}") * F.lit(total), held), F.lit(1.0))
                rows = rows.withColumn("_factor", factor).withColumns({
                    "weight": F.col("weight") * F.col("_factor"), "off": F.greatest("off", F.abs(F.col("_factor") - 1)),
                }).drop("_factor")
        rows.write.parquet(f"{folder}/{number}")
        off = spark.read.parquet(f"{folder}/{number}").agg(F.max("off")).first()[0] or 0.0
    if total > 0 and off > tolerance:
        log.warning("after %d sweeps a margin is still off its target by %g of it", number, off)
    found = spark.read.parquet(f"{folder}/{number}").select(*cells.columns, "weight")
    return found.withColumn("remaining", F.lit(float(off) if total > 0 else 0.0))


def probabilities(cells: DataFrame) -> DataFrame:
    """The cells with ``probability``: their weight over the largest one, so that shares stay as fitted."""
    top = cells.agg(F.max("weight").alias("top"))
    return cells.crossJoin(F.broadcast(top)).select(
        *cells.columns, F.coalesce(F.try_divide("weight", "top"), F.lit(0.0)).alias("probability")
    )


def expected_copies(cells: DataFrame, budget: float) -> DataFrame:
    """The cells with ``probability``: weights scaled so that expected tokens are ``budget`` times those there are.

    Above 1 it is a number of copies. Only cells with tokens set the scale; others get 1 at most.
    """
    held = F.sum(F.col("tokens") * F.col("weight"))
    scale = cells.where("tokens > 0").agg(F.try_divide(F.lit(budget) * F.sum("tokens"), held).alias("scale"))
    found = F.coalesce(F.col("weight") * F.col("scale"), F.lit(0.0))
    return cells.crossJoin(F.broadcast(scale)).select(
        *cells.columns, F.when(F.col("tokens") > 0, found).otherwise(F.least(found, F.lit(1.0))).alias("probability")
    )


def with_probability(documents: DataFrame, cells: DataFrame, margins: Sequence[str]) -> DataFrame:
    """The documents with ``weight`` and ``probability`` of their cell, and the fit's ``remaining`` error.

    Cells are few; Spark broadcasts them as long as their file's size allows, and else shuffles.
    """
    names = {m: f"_cell_{i}" for i, m in enumerate(margins)}
    right = cells.select(*[F.col(m).alias(n) for m, n in names.items()], "weight", "probability", "remaining")
    on = [category(documents[m]) == right[n] for m, n in names.items()]
    return documents.join(right, on, "left").drop(*names.values())


def sampled(key: str, probability: str = "probability", seed: int = 42) -> Column:
    """The document is in the sample: its hashed key lies below its probability. A null key is ``(none)``."""
    return hash_unit(seed, category(key)) < F.col(probability)


def copies(key: str, probability: str = "probability", seed: int = 42) -> Column:
    """How often the document is in a sample with repeats: the whole part, and one more by its hashed key."""
    whole = F.floor(probability)
    return (whole + (hash_unit(seed, category(key)) < F.col(probability) - whole).cast("bigint")).cast("bigint")


def repeated(documents: DataFrame, copies: str = "copies", key: str = "doc_id") -> DataFrame:
    """Every document as often as ``copies`` says, with ``copy`` from 0. Large numbers are made in several tasks."""
    few = documents.where(F.col(copies).between(1, MOST_AT_ONCE))
    few = few.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1)))
    n, low = F.lit(MOST_AT_ONCE), F.col("copy")
    many = documents.where(F.col(copies) > MOST_AT_ONCE)
    many = many.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, n.cast("bigint"))))
    many = many.repartition(key, "copy")
    many = many.withColumn("copy", F.explode(F.sequence(low, F.least(low + n, F.col(copies)) - 1)))
    return few.unionByName(many)


def mix(
    documents: DataFrame,
    targets: Mapping[str, Callable[[DataFrame], DataFrame]],
    key: str = "doc_id",
    tokens: str = "n_tokens",
    seed: int = 42,
    tolerance: float = TOLERANCE,
    budget: float | None = None,
) -> DataFrame:
    """The documents with ``weight, probability, remaining, sampled``; margins are the keys of ``targets``.

    Without a ``budget``, the cell with the largest weight is kept whole and sets the rate of all others.
    With one, the sample's tokens are expected to be ``budget`` times the table's, whatever single cells
    weigh; ``probability`` is then the expected number of copies, and ``copies`` is added, see ``repeated``.

    A target gets the table of cells and gives ``category, share``; see ``smoothed`` and ``fixed``.
    Null categories are one category, ``(none)``. Null token counts are zero. Repeated rows share one
    decision if they share a key. An empty table gives no rows. Columns that are no margins, key or
    token count pass through; ``weight``, ``probability``, ``remaining`` and ``sampled`` are replaced if there.
    """
    documents = documents.drop("weight", "probability", "remaining", "sampled", *([] if budget is None else ["copies"]))
    margins = list(targets)
    spark = documents.sparkSession
    folder = run_folder(spark, "mixing")
    cells_of(documents, margins, tokens).write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")
    goals = {margin: shares(cells) for margin, shares in targets.items()}
    raked = rake(cells, goals, tolerance)
    if budget is None:
        return with_probability(documents, probabilities(raked), margins).withColumn("sampled", sampled(key, seed=seed))
    found = with_probability(documents, expected_copies(raked, budget), margins).withColumn("copies", copies(key, seed=seed))
    return found.withColumn("sampled", F.col("copies") > 0)
