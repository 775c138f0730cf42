"""Near duplicates by SimHash fingerprints and a covering code.

Two fingerprints that differ in at most ``max_bits`` bits differ in at most one bit of some segment,
if there are ``max_bits // 2 + 1`` segments. On each segment the anchors are a covering code: a
perfect Hamming code on most of its bits, all values on the rest, so that every value is within
radius 1 of an anchor. A fingerprint is replicated to every anchor within radius plus threshold,
which is 2, and compared at each anchor with the fingerprints that have it as their nearest one.
So every link shows at an anchor. Links are thinned to a spanning forest before they leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.chunks import give_back
from windrow.llm.components import connected, local_forest
from windrow.session import run_folder, ship_package

SHINGLE, MAX_BITS, BITS, SEED = 4, 4, 64, 42
#: Fingerprints whose nearest anchor is the same, beyond which the anchor is split over tasks.
HOT = 4096
#: Comparisons made at a time.
BLOCK = 1 << 21
#: Hashes whose bits are counted at a time.
HASHES = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words give zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], ">u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES):
        part = hashes[at : at + HASHES]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key, fp``: a signed 64-bit fingerprint for every row. Null and empty texts have zero."""
    ship_package(documents.sparkSession)
    inner = documents.select(documents[key].alias("_key"), documents[text].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(found, pa.int64())], ["_key", "fp"])
        give_back()

    key_type = inner.schema["_key"].dataType.simpleString()
    return inner.mapInArrow(run, f"_key {key_type}, fp bigint").withColumnRenamed("_key", key)


class Code:
    """Anchors on one segment of ``bits`` bits: a Hamming code on 2^r - 1 of them, any values on the rest."""

    def __init__(self, bits: int):
        self.bits = bits
        self.coded = (1 << (bits + 1).bit_length() - 1) - 1
        self.free = [1 << i for i in range(self.coded, bits)]

    def syndrome(self, values: np.ndarray) -> np.ndarray:
        """Which of the coded bits, counted from 1, to flip for a code word; 0 for none."""
        found = np.zeros(len(values), np.int64)
        for i in range(self.coded):
            found ^= ((values >> i) & 1) * (i + 1)
        return found

    def nearest(self, values: np.ndarray) -> np.ndarray:
        s = self.syndrome(values)
        return values ^ np.where(s > 0, 1 << np.maximum(s - 1, 0), 0)

    def within_two(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``values``, anchor) for all anchors at distance 2 or less."""
        s, at = self.syndrome(values), np.arange(len(values))
        home = self.nearest(values)
        places, anchors = [at], [home]
        for bit in self.free:  # one free bit beside a distance of at most 1
            places.append(at)
            anchors.append(home ^ bit)
        exact = at[s == 0]
        for i, one in enumerate(self.free):  # two free bits beside a code word
            for two in self.free[:i]:
                places.append(exact)
                anchors.append(home[exact] ^ one ^ two)
        off = at[s > 0]
        for i in range(1, self.coded + 1):  # two coded bits whose numbers make the syndrome
            j = i ^ s[off]
            pair = (j > i) & (j <= self.coded)
            places.append(off[pair])
            anchors.append(values[off[pair]] ^ (1 << (i - 1)) ^ (1 << (j[pair] - 1)))
        return np.concatenate(places), np.concatenate(anchors)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    n = max_bits // 2 + 1
    bounds = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def members(prints: DataFrame, max_bits: int) -> DataFrame:
    """``anchor, fp, home`` of distinct fingerprints: at every anchor they are replicated to."""
    cuts = segments(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, HASHES):
                fp = whole.column("fp").slice(start, HASHES).to_numpy()
                for number, (first, bits) in enumerate(cuts):
                    code = Code(bits)
                    values = ((fp.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                    place, anchor = code.within_two(values)
                    home = np.zeros(len(place), bool)
                    home[: len(values)] = True  # the nearest ones come first
                    yield pa.RecordBatch.from_pydict({"anchor": anchor | number << 40, "fp": fp[place], "home": home})

    return prints.select("fp").mapInArrow(run, "anchor bigint, fp bigint, home boolean")


def _salted(rows: DataFrame) -> DataFrame:
    """Members of an anchor with many of its own are split: those by salt, visitors to every salt."""
    n_salts = F.ceil(F.count("*") / HOT).cast("int")
    hot = rows.where("home").groupBy("anchor").agg(n_salts.alias("n_salts")).where("n_salts > 1")
    n = F.coalesce("n_salts", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("fp"), n).cast("int"))
    every = F.sequence(F.lit(0), n - 1)
    both = rows.join(hot, "anchor", "left").select("anchor", "fp", "home", own.alias("own"), every.alias("e"))
    return both.select("anchor", "fp", "own", "home", F.explode("e").alias("salt")).select(
        "anchor", "salt", "fp", (F.col("home") & (F.get("own", F.lit(0)) == F.col("salt"))).alias("home")
    )


def _near_at(
    anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all links at whole anchors, some homes at a time; rows are sorted by anchor."""
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    size = np.diff(np.append(first, len(anchor)))
    group = np.repeat(np.arange(len(first)), size)
    own = np.flatnonzero(home)
    work = np.cumsum(size[group[own]])
    start = 0
    while start < len(own):
        done = work[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(work, done + BLOCK, side="right")))
        h = own[start:stop]
        start = stop
        n = size[group[h]]
        left = np.repeat(h, n)
        right = np.repeat(first[group[h]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        differ = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64))
        near = (differ <= max_bits) & (differ > 0)
        yield left[near], right[near]


def _links_at(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links at whole anchors; rows are sorted by anchor."""
    root, chosen = np.arange(len(fp)), []
    for left, right in _near_at(anchor, fp, home, max_bits):
        taken, root = local_forest(root, left, right)
        chosen.append(np.stack([fp[left[taken]], fp[right[taken]]]))
    return tuple(np.concatenate([np.zeros((2, 0), np.int64), *chosen], axis=1))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: pairs within ``max_bits``, as many as connect all that is linked at an anchor."""
    rows = _salted(members(prints, max_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(rows)
            group = whole.column("anchor").to_numpy() * 1000003 + whole.column("salt").to_numpy()
            fp, home = whole.column("fp").to_numpy(), whole.column("home").to_numpy()
            a, b = _links_at(group, fp, home, max_bits)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

        for batch in batches:
            # The last anchor of a batch may go on in the next one.
            marks = np.stack([batch.column("anchor").to_numpy(), batch.column("salt").to_numpy().astype(np.int64)])
            change = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            if held:
                last = held[-1]
                end = (last.column("anchor")[-1].as_py(), last.column("salt")[-1].as_py())
                if end != (marks[0, 0], marks[1, 0]):
                    yield from compared(held)
                    held = []
            cut = int(change[-1]) if len(change) else 0
            if cut:
                yield from compared([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from compared(held)

    placed = rows.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    return placed.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``key, fp, component``: each document's fingerprint and the smallest key reachable over links.

    Documents with equal fingerprints are linked; so are those whose fingerprints differ in up to
    ``max_bits`` bits, without a limit to their number. Words are cut at white space and lower-cased
    (A-Z). A null, empty or blank text has fingerprint 0 and is linked like any other. Null keys
    stay and take no part in the choice of the smallest; a component of null keys only has null.
    Rows that repeat a key are compared each with its own text. An empty table gives no rows. Other
    columns take no part.
    """
    spark = documents.sparkSession
    folder = run_folder(spark, "simhash")
    fingerprints(documents, key, text, shingle).withColumnRenamed(key, "_key").write.parquet(f"{folder}/prints")
    prints = spark.read.parquet(f"{folder}/prints")
    classes = prints.groupBy("fp").agg(F.min("_key").alias("least"))
    classes.write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    roots = connected(links(classes, max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    components = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_print = rooted.join(components, "root").select("fp", "component")
    return prints.join(of_print, "fp").select(F.col("_key").alias(key), "fp", "component")


def keep_one(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One document of each component of ``near_duplicates`` stays, with all its columns: that with the smallest key.

    Rows with a null key stay only in components without any key. Of rows of one key with different
    texts that are linked, the one with the smallest digest stays, whatever the layout of the table;
    rows of one key and text are one document, of which one row stays. An empty table gives no rows.
    """
    own, whole = documents[key], F.coalesce(documents[text], F.lit(""))
    known = F.when(own.isNull(), "-").otherwise(F.concat(F.lit("+"), own.cast("string")))
    row = F.sha2(F.concat_ws(":", known, whole).cast("binary"), 256)
    inner = documents.select(F.struct(own.isNull().alias("last"), own.alias("k"), row.alias("id")).alias("_k"), whole.alias("_t"))
    found = near_duplicates(inner, "_k", "_t", shingle, max_bits)
    # Only those that go are named, which are fewer.
    gone = found.where(F.col("_k.id") != F.col("component.id")).select(F.col("_k.id").alias("_row")).distinct()
    # The columns travel in a struct, so that no name of theirs can clash.
    rows = documents.select(F.struct(*documents.columns).alias("_document"), row.alias("_row"))
    return rows.join(gone, "_row", "left_anti").dropDuplicates(["_row"]).select("_document.*")


def hexadecimal(fp: str = "fp"):
    """Column: a fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
