"""Language identification of web pages by Bayesian fusion of evidence.

Four kinds of evidence are combined: the likelihood of the text under byte-trigram models, the
language that the markup declares, the suffix of the address, and a prior of the host. How far
declarations and suffixes can be trusted, and what languages a host has, is counted over all pages
by grouped aggregation, with the text's verdict standing in for the unknown language. The prior of
a host is smoothed towards that of its domain, and that towards the corpus; a page's own vote is
left out of its prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.bpe import text_parts
from windrow.session import run_folder, ship_package

#: Trigrams are hashed to so many bits, so a model is of bounded size: one count for each and language.
BUCKET_BITS = 15
#: A language is the primary part of a tag, two or three letters. More than these are refused, none is left out.
MOST_LANGUAGES = 512
PRIMARY = r"^([a-z]{2,3})(?:[-_].*)?$"
#: Pages that a task fuses: the work is in the arrays, not in the bytes that partitions are merged by.
PAGES_IN_TASK, MOST_TASKS = 1 << 13, 20_000
#: Trigrams are not independent: a text counts as much as so many of them at most.
EVIDENCE = 150.0
#: Pseudo-counts of the priors' upper levels, and of declarations and suffixes.
HOST_WEIGHT, DOMAIN_WEIGHT, SMOOTHING = 5.0, 20.0, 1.0
NONE = "-"


@dataclass(frozen=True)
class Model:
    """Log-likelihoods of the trigram buckets, one row per language."""

    languages: list[str]
    log_likelihood: np.ndarray


def buckets(text: str) -> np.ndarray:
    """Bucket of every byte trigram of the lower-cased text with single spaces around its words."""
    data = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def train(documents: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram counts of all documents by labelled language; unlabelled ones and what is no tag take no part.

    ``en-US`` counts as ``en``, ``ceb`` as itself.

    Tasks count in arrays, and only counts are shuffled. The driver gets at most one count for each
    bucket and language, which is a fixed bound. No labelled documents give a model without languages.
    """
    ship_package(documents.sparkSession)
    tag = F.regexp_extract(F.lower(documents[lang]), PRIMARY, 1)
    inner = documents.select(tag.alias("_lang"), documents[text].alias("_text"))
    inner = inner.where((F.col("_lang") != "") & F.col("_text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, words in zip(batch.column("_lang").to_pylist(), batch.column("_text")):
                sums = held.setdefault(language, np.zeros(1 << BUCKET_BITS, np.int64))
                sums += np.bincount(buckets(words.as_py()), minlength=1 << BUCKET_BITS)
        for language, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict({"lang": [language] * len(at), "bucket": at, "n": sums[at]})

    counts = inner.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket")
    folder = run_folder(documents.sparkSession, "languages")
    counts.agg(F.sum("n").alias("n")).write.parquet(folder)
    stored = documents.sparkSession.read.parquet(folder)
    languages = sorted(r["lang"] for r in stored.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = stored.toPandas() if languages else None
    matrix = np.full((len(languages), 1 << BUCKET_BITS), 0.5)
    if languages:
        place = {language: i for i, language in enumerate(languages)}
        matrix[found["lang"].map(place).to_numpy(), found["bucket"].to_numpy()] += found["n"].to_numpy()
    return Model(languages, np.log(matrix / matrix.sum(axis=1, keepdims=True)))


def text_scores(rows: DataFrame, model: Model, key: str, text: str, *others: str) -> DataFrame:
    """``key, others, n_grams, scores``: a log-likelihood for each language of the model.

    Scores are those of the mean trigram, times their number up to ``EVIDENCE``. A null or empty text
    scores 0 for all.
    """
    spark = rows.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    inner = rows.select(key, *others, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kept = [f.name for f in inner.schema if f.name != "_text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.log_likelihood
        for whole in batches:
            for batch in text_parts(whole, "_text"):
                found, numbers = [], []
                for words in batch.column("_text"):
                    at = buckets(words.as_py())
                    numbers.append(len(at))
                    total = table @ np.bincount(at, minlength=1 << BUCKET_BITS) if len(at) else np.zeros(len(table))
                    found.append(total * (min(len(at), EVIDENCE) / max(len(at), 1)))
                columns = [batch.column(k) for k in kept]
                columns += [pa.array(numbers, pa.int64()), pa.array(found, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "n_grams", "scores"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema if f.name != "_text")
    return inner.mapInArrow(score, f"{types}, n_grams bigint, scores array<double>")


def visible_text(html: Column) -> Column:
    """Text of a page without comments, scripts, styles, tags and entities."""
    found = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    found = F.regexp_replace(found, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    found = F.regexp_replace(found, r"<[^>]*>", " ")
    return F.regexp_replace(found, r"&(#\d+|#[xX][0-9a-fA-F]+|\w+);", " ")


def declared(html: Column) -> Column:
    """The primary part of the language tag of the root element."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html[^>]*?\slang\s*=\s*["']?([a-z]{2,3})(?![a-z0-9])""", 1))
    return F.when(found != "", found).otherwise(NONE)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.when(found != "", found).otherwise(NONE)


def _normalised(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def _by_language(rows: DataFrame, by: str, n: int, name: str) -> DataFrame:
    """``by, name``: how many pages the text gives to each language."""
    sums = [F.count_if(F.col("text_lang_no") == i).cast("double").alias(f"_{i}") for i in range(n)]
    return rows.groupBy(by).agg(*sums).select(by, F.array(*[F.col(f"_{i}") for i in range(n)]).alias(name))


def identify(pages: DataFrame, model: Model, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key, lang, probability, text_lang, declared, suffix, host, n_grams`` for every row.

    A null or empty page is judged by its address alone, a null address has host and suffix ``-``; ties
    go to the language that comes first by name. Rows that repeat a key are judged each for itself.
    An empty table gives no rows, a model without languages null languages. Other columns take no
    part. Hosts of any size are aggregated before they move; pages join their host's row.
    """
    spark = pages.sparkSession
    n = len(model.languages)
    page = F.coalesce(pages[html], F.lit(""))
    host = host_of(F.coalesce(pages[url], F.lit("")))
    inner = pages.select(pages[key].alias("_key"), host.alias("host"), declared(page).alias("declared"), visible_text(page).alias("_page"))
    if not n:
        none = F.lit(None).cast("string")
        return inner.select(
            F.col("_key").alias(key), none.alias("lang"), F.lit(None).cast("double").alias("probability"),
            none.alias("text_lang"), "declared", F.regexp_extract("host", r"[^.]+$", 0).alias("suffix"), "host",
            F.lit(0).cast("bigint").alias("n_grams"),
        )
    languages = F.array(*[F.lit(x) for x in model.languages])
    best = F.array_position("scores", F.array_max("scores")).cast("int") - 1
    scored = text_scores(inner, model, "_key", "_page", "host", "declared").withColumn(
        # A page without text has no vote.
        "text_lang_no", F.when(F.col("n_grams") > 0, best)
    )
    scored = scored.withColumn("suffix", F.regexp_extract("host", r"[^.]+$", 0)).withColumn(
        "domain", F.regexp_extract("host", r"[^.]+\.?[^.]*$", 0)
    )
    folder = run_folder(spark, "langid")
    scored.write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    # One count per host; domains, suffixes and the corpus are sums of those.
    _by_language(scored, "host", n, "at_host").write.parquet(f"{folder}/hosts")
    hosts = spark.read.parquet(f"{folder}/hosts")

    def summed(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
        sums = [F.sum(F.get("at_host", F.lit(i))).alias(f"_{i}") for i in range(n)]
        found = rows.groupBy(*by).agg(*sums)
        return found.select(*found.columns[: len(by)], F.array(*[F.coalesce(f"_{i}", F.lit(0.0)) for i in range(n)]).alias(name))

    hosts = hosts.withColumn("suffix", F.regexp_extract("host", r"[^.]+$", 0)).withColumn(
        "domain", F.regexp_extract("host", r"[^.]+\.?[^.]*$", 0)
    )
    corpus = summed(hosts, [], "at_all")
    domains = summed(hosts, ["domain"], "at_domain")
    suffixes = summed(hosts, ["suffix"], "at_suffix")
    claims = _by_language(scored, "declared", n, "at_declared")
    n_claims, n_suffixes = claims.agg(F.count("*").alias("n_claims")), suffixes.agg(F.count("*").alias("n_suffixes"))

    wide = scored.join(claims, "declared").join(suffixes, "suffix").join(domains, "domain").join(
        hosts.select("host", "at_host"), "host"
    )
    for one_row in (corpus, n_claims, n_suffixes):
        wide = wide.crossJoin(F.broadcast(one_row))

    n_tasks = max(1, min(MOST_TASKS, scored.count() // PAGES_IN_TASK))  # by the files' footers
    wide = wide.repartition(n_tasks)

    def at(name: str, i: Column) -> Column:
        """Votes for language i without the page's own."""
        return F.get(name, i) - F.coalesce(F.col("text_lang_no") == i, F.lit(False)).cast("double")

    def total(name: str) -> Column:
        own = F.col("text_lang_no").isNotNull().cast("double")
        return F.aggregate(name, F.lit(0.0), lambda a, x: a + x) - own

    every = F.sequence(F.lit(0), F.lit(n - 1))
    prior = F.transform(every, lambda i: (at("at_all", i) + 1.0) / (total("at_all") + n))
    wide = wide.withColumn("_all", prior)
    domain = lambda i: (at("at_domain", i) + DOMAIN_WEIGHT * F.get("_all", i)) / (total("at_domain") + DOMAIN_WEIGHT)
    wide = wide.withColumn("_domain", F.transform(every, domain))
    of_host = lambda i: (at("at_host", i) + HOST_WEIGHT * F.get("_domain", i)) / (total("at_host") + HOST_WEIGHT)
    wide = wide.withColumn("_host", F.transform(every, of_host))

    def evidence(i: Column) -> Column:
        """Log of prior and likelihoods of language i."""
        claim = (at("at_declared", i) + SMOOTHING) / (at("at_all", i) + SMOOTHING * F.col("n_claims"))
        suffix = (at("at_suffix", i) + SMOOTHING) / (at("at_all", i) + SMOOTHING * F.col("n_suffixes"))
        return F.log(F.get("_host", i)) + F.log(claim) + F.log(suffix) + F.get("scores", i)

    wide = wide.withColumn("_evidence", F.transform(every, evidence))
    top = F.array_max("_evidence")
    chances = _normalised(F.transform("_evidence", lambda x: F.exp(x - top)))
    wide = wide.withColumn("_chances", chances)
    return wide.select(
        F.col("_key").alias(key),
        F.get(languages, F.array_position("_evidence", top).cast("int") - 1).alias("lang"),
        F.array_max("_chances").alias("probability"),
        F.get(languages, F.col("text_lang_no")).alias("text_lang"),
        *("declared", "suffix", "host", "n_grams"),
    )
