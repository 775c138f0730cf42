"""How filters act on each other: a stream of documents, failure masks, and retraction of masks that change.

All files are read as micro-batches of a stream that ends when they are used up. A document's mask
has a bit for each filter it fails; one bit, that of a repeated text, depends on all documents.
State keyed by text holds the smallest id so far and the masks that count as its first copy. When a
smaller id arrives, these masks are retracted from the counters of their parts and come back with
the bit set. Counters of masks are all that later figures need: every order of the filters, what
each step removes, and each filter's share over all orders.

Some tens of texts, by a range of their digests, share an entry of Spark's state, as a call for
each text would cost more than all the rest. The state store is the session's; state that does not
fit into the executors' memory needs the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from windrow.session import run_folder, ship_package

#: Micro-batches that the files of a table are dealt to, whatever their number.
MICRO_BATCHES = 4
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
#: Rows of counters that a task holds before it sends them on.
MOST_HELD = 1 << 16
MEASURED = "doc_id bigint, part string, digest binary, mask int"
COUNTED = "place bigint, digest binary, doc_id bigint, part string, mask int, good boolean, toxic boolean, n bigint"
DELTAS = "part string, mask int, good boolean, toxic boolean, n bigint"
#: Texts that share an entry of state, about.
TEXTS_TOGETHER = 64

Measures = tuple[int, int, int, int, bool]


def measures(data: bytes) -> Measures:
    """Words, distinct words, letters A-Z, code points of UTF-8 text, and whether a symbol is in it.

    Words are cut at space and the five controls from tab to carriage return, as ``bytes.split`` does.
    """
    words = data.split()
    upper = len(data) - len(data.translate(None, UPPER))
    points = len(data.decode("utf-8", "replace"))
    return len(words), len(set(words)), upper, points, len(data.translate(None, SYMBOLS)) < len(data)


#: Filters of one text: does it fail?
FILTERS: dict[str, Callable[[Measures], bool]] = {
    "A": lambda m: m[0] < 200,
    "B": lambda m: 100 * m[1] < 50 * m[0],
    "C": lambda m: 100 * m[2] > 2 * m[3],
    "D": lambda m: m[4],
}
#: The filter that a text fails which a smaller id has, too.
REPEATED = "E"


def measured(documents: DataFrame, key: str, text: str, part: str, filters: Mapping[str, Callable[[Measures], bool]]) -> DataFrame:
    """``doc_id, part, digest, mask`` of every document; texts go no further."""
    conditions = list(filters.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, masks = [], []
            for value in batch.column("text"):
                data = (value.as_buffer().to_pybytes() if value.is_valid else b"") or b""
                found = measures(data)
                digests.append(hashlib.sha256(data).digest())
                masks.append(sum(1 << bit for bit, fails in enumerate(conditions) if fails(found)))
            columns = [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "digest", "mask"])

    whole = F.coalesce(F.col(part).cast("string"), F.lit(""))
    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), whole.alias("part"), F.col(text).alias("text"))
    return rows.mapInArrow(run, MEASURED)


def _labels(labels: DataFrame, key: str) -> DataFrame:
    """``doc_id, good, toxic``, one row for each id."""
    flag = lambda name: F.coalesce(F.max(F.col(name) == 1), F.lit(False))
    kept = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("doc_id"))
    return kept.agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split(" ")[0] for field in COUNTED.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _first_copies(repeated: int, bits: int):
    """In each batch of rows, only a text's smallest ids can change again; all others are counted at once.

    What is counted has no id and travels with any of the batch's texts, so that a text which a third of
    all documents share sends a row of every batch to its state. ``place`` are the first ``bits`` of a digest.
    """
    place_of = lambda digest: int.from_bytes(digest[:8], "big") >> (64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[bytes, int] = {}
            rows = list(zip(*(batch.column(n).to_pylist() for n in ("digest", "doc_id", "part", "mask", "good", "toxic"))))
            for digest, key, *_ in rows:
                if key is not None and key < least.get(digest, key + 1):
                    least[digest] = key
            first, settled = Counter(), Counter()
            for digest, key, part, mask, good, toxic in rows:
                if key is not None and key == least[digest]:
                    first[digest, key, part, mask, bool(good), bool(toxic)] += 1
                else:
                    # A null id is no repeat.
                    settled[part, mask if key is None else mask | repeated, bool(good), bool(toxic)] += 1
            found = [(place_of(what[0]), *what, n) for what, n in first.items()]
            places = sorted({place for place, *_ in found}) or [0]
            for i, (what, n) in enumerate(settled.items()):
                found.append((places[i % len(places)], None, None, *what, n))
            yield _table(found)

    return run


def _retract(repeated: int):
    """State of a text: the smallest id, and the counters of its documents as ``part, mask, good, toxic, n``."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        texts = json.loads(state.get[0]) if state.exists else {}
        changed, deltas = False, Counter()
        for rows in batches:
            columns = [rows[c].tolist() for c in ("digest", "doc_id", "part", "mask", "good", "toxic", "n")]
            for digest, doc, *what, n in zip(*columns):
                what, n = (what[0], int(what[1]), bool(what[2]), bool(what[3])), int(n)
                if digest is None:
                    deltas[what] += n
                    continue
                doc, text = int(doc), bytes(digest).hex()
                least, held = texts.get(text, (None, []))
                if least is None or doc < least:
                    for part, mask, *flags, count in held:
                        deltas[part, mask, *flags] -= count
                        deltas[part, mask | repeated, *flags] += count
                    least, held = doc, []
                if doc == least:
                    texts[text] = (least, [*held, (*what, n)])
                    deltas[what] += n
                    changed = True
                else:
                    deltas[what[0], what[1] | repeated, *what[2:]] += n
        if changed:
            state.update((json.dumps(texts, separators=(",", ":")),))
        found = [(*what, n) for what, n in deltas.items() if n]
        if found:
            yield pd.DataFrame(found, columns=[field.split(" ")[0] for field in DELTAS.split(", ")])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deltas of a task, added up."""
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        found = [(*what, n) for what, n in held.items() if n]
        names = [field.split(" ")[0] for field in DELTAS.split(", ")]
        types = [pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(types)], names)

    for batch in batches:
        for *what, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
            held[tuple(what)] += n
        if len(held) > MOST_HELD:
            yield rows()
            held.clear()
    yield rows()


def _bits(spark: SparkSession, documents: DataFrame, folder: str) -> int:
    """Bits of a digest that name an entry of state; a run that goes on keeps them."""
    n = max(1, documents.count() // TEXTS_TOGETHER)  # by the files' footers
    made = spark.range(1).select(F.lit((n - 1).bit_length()).alias("bits"))
    made.write.mode("ignore").parquet(f"{folder}/bits")
    return spark.read.parquet(f"{folder}/bits").first()["bits"]


def mask_counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    filters: Mapping[str, Callable[[Measures], bool]] = FILTERS,
    micro_batches: int = MICRO_BATCHES,
    folder: str | None = None,
) -> DataFrame:
    """``part, mask, good, toxic, n``: documents of every part by the filters that they fail.

    Bits of ``mask`` are the filters in their order, then that of repeated texts. ``path`` holds the
    Parquet files of the documents; they are dealt to ``micro_batches``. A run with the ``folder`` of
    one that was lost goes on where that one ended, and one that was done only reads its counters.

    Null: a null text is an empty one, a null part the empty string; a null id has no label, is no
    repeat of another and makes none a repeat. Ids are whole numbers. Rows of one id and text are
    first copies together; rows of one id with different texts stand for themselves. Several labels
    of an id count as one that has what any of them has. A table without rows gives none. Other
    columns take no part.
    """
    ship_package(spark)
    folder = folder or run_folder(spark, "interactions")
    repeated = 1 << len(filters)
    found = spark.read.parquet(path)
    files = max(1, math.ceil(len(found.inputFiles()) / micro_batches))
    _labels(labels, key).write.mode("overwrite").parquet(f"{folder}/labels")
    known = spark.read.parquet(f"{folder}/labels")
    # Characters of a pattern, so that a single file is taken for one that it matches.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(found.schema).option("maxFilesPerTrigger", files).parquet(pattern)
    masks = measured(stream, key, text, part, filters).join(known, "doc_id", "left")
    first = masks.mapInArrow(_first_copies(repeated, _bits(spark, found, folder)), COUNTED)
    deltas = first.groupBy("place").applyInPandasWithState(
        _retract(repeated), DELTAS, "texts string", "append", GroupStateTimeout.NoTimeout
    )
    writer = deltas.mapInArrow(_summed, DELTAS).writeStream.trigger(availableNow=True).outputMode("append")
    query = writer.option("checkpointLocation", f"{folder}/checkpoint").format("parquet").start(f"{folder}/deltas")
    query.awaitTermination()
    counters = spark.read.schema(DELTAS).parquet(f"{folder}/deltas").groupBy("part", "mask", "good", "toxic")
    return counters.agg(F.sum("n").alias("n")).where("n <> 0")


def steps(letters: str) -> Column:
    """All orders of the filters, step by step: ``filter_order, step, before, bit``."""
    found = []
    for order in permutations(range(len(letters))):
        before, name = 0, "".join(letters[i] for i in order)
        for step, i in enumerate(order):
            values = {"filter_order": name, "step": step + 1, "before": before, "bit": 1 << i}
            found.append(F.struct(*[F.lit(v).alias(k) for k, v in values.items()]))
            before |= 1 << i
    return F.array(*found)


def effects(counters: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """``part, filter_order, step`` and what the step's filter does there, one row for each, zeros included.

    ``kept`` after the step; ``removed`` by it; ``redundant``: failing, but removed before;
    ``unique_fails``: failing this filter only; ``good_lost`` and ``toxic_lost``: removed ones with
    such a label; ``shapley``: what the filter removes, summed over all orders.
    """
    rows = counters.withColumn("_step", F.explode(steps(letters))).select("*", "_step.*")
    fails, passed = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) == 0
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")
    # In one of so many orders as it fails filters, this one is the first that a document meets.
    share = F.lit(math.factorial(len(letters))).cast("bigint") * F.col("n") / F.greatest(F.bit_count("mask"), F.lit(1))
    return rows.groupBy("part", "filter_order", "step").agg(
        count(passed & ~fails).alias("kept"),
        count(passed & fails).alias("removed"),
        count(~passed & fails).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(passed & fails & F.col("good")).alias("good_lost"),
        count(passed & fails & F.col("toxic")).alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.round(share).cast("bigint"))), F.lit(0)).cast("bigint").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """``effects`` of the filters on the documents at ``path``. Options and rules are those of ``mask_counters``."""
    letters = "".join(options.get("filters", FILTERS)) + REPEATED
    return effects(mask_counters(spark, path, labels, **options), letters)
