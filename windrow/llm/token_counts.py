"""Token counts through a cache of digests: a text that was counted once is not encoded again.

The cache is a Parquet table ``digest, tokenizer, n_tokens`` in a folder that all executors reach.
A text's digest is that of its normalised content; the tokenizer's is that of its file, so a new
version of a tokenizer starts a cache of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.bpe import codec_of, supports
from windrow.session import ship_package

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens bigint"
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 20


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file. The driver reads it; it has a bounded size (a vocabulary)."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def content(text: Column | str) -> Column:
    """Normalised content: null is an empty text.

    Nothing else is changed, as the tokenizers in use tell any two other texts apart.
    """
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def digest_of(normalised: Column) -> Column:
    return F.unhex(F.sha2(normalised, 256))


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer; empty if there is no cache yet.

    Runs that append at the same time can store a digest twice, so digests are made unique.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(name: str, data: bytes):
    """A function from texts to token counts, without added tokens, truncation and padding.

    Byte-level BPE files go to this package's encoder, which gives the library's ids in less time;
    for all others the library is asked.
    """
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    file = data.decode("utf-8")
    if supports(file):
        codec = codec_of(file)
        codec.forget()  # what an earlier task remembered
        return lambda texts: np.diff(codec.encode(texts).offsets.to_numpy()).tolist()
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _batches(texts: pa.Array) -> Iterator[list[str]]:
    batch, size = [], 0
    for text in texts:
        batch.append(text.as_py())
        size += len(batch[-1])
        if size >= BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def count_misses(misses: DataFrame, path: str) -> DataFrame:
    """``digest, n_tokens`` of ``digest, content``: the one place where texts are encoded."""
    with open(path, "rb") as file:
        data = misses.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, data.value)
        for batch in batches:
            counts = [n for texts in _batches(batch.column("content")) for n in count(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return misses.select("digest", "content").mapInArrow(encode, "digest binary, n_tokens bigint")


def fill_cache(documents: DataFrame, path: str, cache: str, text: str = "text") -> None:
    """Append to the cache what it lacks: every distinct content that it doesn't know is encoded once."""
    spark = documents.sparkSession
    ship_package(spark)
    version = tokenizer_version(path)
    contents = documents.select(content(text).alias("content")).withColumn("digest", digest_of(F.col("content")))
    known = read_cache(spark, cache, version).select("digest")
    misses = contents.join(known, "digest", "left_anti").dropDuplicates(["digest"])
    counted = count_misses(misses, path).withColumn("tokenizer", F.lit(version))
    counted.select("digest", "tokenizer", "n_tokens").write.mode("append").parquet(cache)


def token_counts(documents: DataFrame, path: str, cache: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens`` for every row of ``documents``, filling the cache first.

    A null text counts as an empty one (0 tokens); a null key stays null; repeated rows give
    repeated rows and are encoded once; an empty table gives no rows. Other columns take no part.
    """
    spark = documents.sparkSession
    inner = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    fill_cache(inner, path, cache, "_text")
    known = read_cache(spark, cache, tokenizer_version(path))
    whole = content("_text")
    keyed = inner.select("_key", F.octet_length(whole).cast("bigint").alias("n_bytes"), digest_of(whole).alias("digest"))
    return keyed.join(known, "digest", "left").select(F.col("_key").alias(key), "n_bytes", "n_tokens")
