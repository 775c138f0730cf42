"""One query for each operator of this subpackage: all rows and whole texts of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import alignment, bpe, interactions, kneser_ney, langid, mixing, quality, sentence_pieces, simhash, substrings, suffixes, topk
from windrow.llm import token_counts as counts
from windrow.llm.text import table
from windrow.session import run_folder

#: Where the tokenizer of the queries lies; the file itself stays outside this package.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024
#: One text in so many is not learnt from.
HELD_OUT = 10
#: Words of the language model's longest n-grams.
LM_ORDER = 3
#: Searches take as queries the rows whose id this divides.
QUERY_STEP = 100
#: Shares of tokens that the mixture aims at.
SOURCE_POWER = 0.5
LANGUAGE_SHARES = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
TOPIC_SHARES = {"prose": 0.9, "tabular": 0.06, "symbolic": 0.02, "loud": 0.02}


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.train(table(spark, sf_dir, "documents"))
    rows = langid.identify(table(spark, sf_dir, "pages"), model)
    return rows.withColumn("probability", F.round("probability", 6))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id is held out."""
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    learn = digest % HELD_OUT != 0
    rows, _ = kneser_ney.learn_and_score(table(spark, sf_dir, "documents"), learn, order=LM_ORDER, keep=False)
    return rows.select(
        "doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


#: Targets by margin: sources evened out, languages and topics fixed.
MIXTURE = {
    "source": lambda cells: mixing.smoothed(cells, "source", SOURCE_POWER),
    "lang": lambda cells: mixing.fixed(cells, LANGUAGE_SHARES),
    "topic": lambda cells: mixing.fixed(cells, TOPIC_SHARES),
}


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", mixing.genre("text").alias("topic"), mixing.word_count("text").alias("n_tokens")
    )
    found = mixing.mix(rows, MIXTURE).drop("remaining")
    return found.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.floored("embedding").alias("vector"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hexadecimal().alias("fingerprint"), F.col("component").alias("component_id"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with an empty cache of its own, so that every distinct text is encoded."""
    cache = run_folder(spark, "token-counts")
    rows = counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER, cache)
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        (~quality.passes("base")).alias("base_failed"),
        quality.passes().alias("kept"),
        *("n_lines", "n_upper", "n_letters", "failed_bits"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sentence_pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_language_id": op2_language_id,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_mixing": op4_mixing,
    "op5_top_k": op5_top_k,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_alignment": op11_alignment,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_filter_audit": op13_filter_audit,
}
