"""From raw documents to token ids: quality rules, near duplicates, repeated passages, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Nulls, empty and
very long texts, repeated rows, empty tables and extra columns are treated as each operator says.
Columns besides those of ``documents`` go no further than the first stage, ``copy`` numbers of the
mixture neither: copies of a document are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import bpe, mixing, quality, simhash, suffixes
from windrow.llm.queries import MIXTURE, TOKENIZER
from windrow.session import run_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Tokens of the mixture, as a part of those that come to it.
BUDGET = 1.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy rejects go."""
    return quality.keep(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays that fingerprints of four words within four bits connect."""
    return simhash.keep_one(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has go, documents without any words left too.

    A character that a cut would part goes whole; ``n_chars`` is counted anew.
    """
    cut = suffixes.remove_repeats(docs, carry=("lang", "source"), whole_characters=True)
    kept = cut.withColumn("text", F.col("kept").cast("string")).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, some of them repeated, whose tokens have the target shares of sources, languages and topics.

    Their number of tokens is expected to be ``BUDGET`` times that of the stage before.
    """
    rows = docs.select(*COLUMNS).withColumns({"topic": mixing.genre("text"), "n_tokens": mixing.word_count("text")})
    return mixing.repeated(mixing.mix(rows, MIXTURE, budget=BUDGET)).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, decoded_sha256``: what training reads, and a digest of the way back."""
    inner = docs.select(F.struct("doc_id", "lang", "source").alias("_row"), "text")
    found = bpe.round_trip(inner, TOKENIZER, "_row")
    return found.select(
        "_row.*", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("mixing_sources", mixture),
    ("bpe_encoding", token_ids),
]

#: Sorting suffixes, linking fingerprints and merging pairs are beyond SQL; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next."""
    folder = run_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
