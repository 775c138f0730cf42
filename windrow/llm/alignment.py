"""Which tokens of two tokenizers lie over each other, and how common such pairs are.

Both tokenizers cut the same bytes. In a batch of documents, each token start of one side finds the
other side's token that covers it, by an as-of merge keyed by document; both directions together
give all overlapping pairs once. Ends that both sides share cut tokens into groups. A batch is a
block of the shared folder: it keeps its links as places of its distinct pairs, and sends the pairs
with the number of their documents to ranges of first ids. A range adds them up, batch by batch,
and answers with corpus-wide counts; texts and tokens are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm import chunks as C
from windrow.llm.bpe import Codec, codec_of
from windrow.llm.sentence_pieces import (
    Pieces, batches_of, cut, from_planes, packed_rows, pieces_of, planes, stored_blocks,
)
from windrow.llm.text import listed
from windrow.session import ship_package

#: Bytes of text that are aligned at a time; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
#: Ids are below 2^24; a pair's key begins with 12 bits of its first id's hash, which say to which range it goes.
ID_BITS, RANGE_BITS = 24, 12
ID_MASK = np.uint64((1 << ID_BITS) - 1)
#: Keys that a range holds before it adds them up.
MOST_HELD = 1 << 20
BLOCK_SCHEMA = "chunk bigint, rows binary, asked binary"


class Batch:
    """Tokens of a batch of texts by both sides, in order, as places in the bytes of all texts that both reproduce."""

    def __init__(self, texts: pa.Array, first: Codec, second: Pieces):
        self.n = len(texts)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spaced = [f" {t}" if t else "" for t in texts.to_pylist()]
        whole = [t.encode() for t in spaced]
        ids = first.encode(spaced)
        del spaced
        a, n_a = ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy())
        words, index, counts = cut(texts)
        flat, count = second.segment(listed(words))
        ends = np.concatenate([[0], np.cumsum(count[index])])
        start = np.cumsum(count) - count
        b = flat[np.repeat(start[index] - ends[:-1], count[index]) + np.arange(ends[-1])]
        n_b = np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])
        size = np.fromiter(map(len, whole), np.int64, self.n)
        self.fits = size > 0
        for tokens, n, surfaces in ((a, n_a, first.tokens), (b, n_b, second.surfaces)):
            self.fits &= self._reproduced(whole, size, tokens, n, surfaces)
        # Only these documents have tokens.
        self.a, self.b = a[np.repeat(self.fits, n_a)], b[np.repeat(self.fits, n_b)]
        self.n_a, self.n_b = np.where(self.fits, n_a, 0), np.where(self.fits, n_b, 0)
        documents = np.arange(self.n)
        self.doc_a, self.doc_b = np.repeat(documents, self.n_a), np.repeat(documents, self.n_b)
        width = lambda surfaces, tokens: pc.binary_length(surfaces).to_numpy()[tokens].astype(np.int64)
        self.end_a, self.end_b = np.cumsum(width(first.tokens, self.a)), np.cumsum(width(second.surfaces, self.b))
        self.start_a = np.concatenate([[0], self.end_a[:-1]]) if len(self.a) else self.end_a
        self.start_b = np.concatenate([[0], self.end_b[:-1]]) if len(self.b) else self.end_b

    @staticmethod
    def _reproduced(whole: list[bytes], size: np.ndarray, tokens: np.ndarray, n: np.ndarray, surfaces: pa.Array) -> np.ndarray:
        """Do a text's tokens, one after the other, have its bytes?"""
        parts = surfaces.take(pa.array(tokens))
        bounds = np.concatenate([[0], np.cumsum(n)])
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[: len(parts) + 1]
        at = offsets[bounds]
        data = memoryview(parts.buffers()[2] or b"").cast("B")
        same = np.diff(at) == size
        begin, end = at[:-1].tolist(), at[1:].tolist()
        for i in np.flatnonzero(same).tolist():
            same[i] = data[begin[i] : end[i]].tobytes() == whole[i]
        return same

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of tokens that overlap, one of each side: ordered by document, every pair of tokens once."""
        sides = {
            "a": pd.DataFrame({"start": self.start_a, "document": self.doc_a, "a": np.arange(len(self.a))}),
            "b": pd.DataFrame({"start": self.start_b, "document": self.doc_b, "b": np.arange(len(self.b))}),
        }
        if not len(self.a):
            return np.zeros((2, 0), np.int64)
        of_a = pd.merge_asof(sides["a"], sides["b"], on="start", by="document")
        # Where both start together, the other direction has the pair.
        alone = sides["b"][~np.isin(self.start_b, self.start_a, assume_unique=True)]
        of_b = pd.merge_asof(alone, sides["a"], on="start", by="document")
        left = np.concatenate([of_a["a"].to_numpy(), of_b["a"].to_numpy()]).astype(np.int64)
        right = np.concatenate([of_a["b"].to_numpy(), of_b["b"].to_numpy()]).astype(np.int64)
        order = np.argsort(self.doc_a[left], kind="stable")
        return left[order], right[order]

    def shared_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """For the tokens of each side: does a token of the other end where it ends?"""
        ends = np.zeros((2, int(self.end_a[-1]) + 1 if len(self.a) else 1), bool)
        ends[0, self.end_a] = ends[1, self.end_b] = True
        return ends[1, self.end_a], ends[0, self.end_b]

    def groups(self, separators: Separated) -> tuple[np.ndarray, list[bytes]]:
        """How many groups each document has, and ``a1,a2|b1;a3|b2,b3``, or nothing if it has no tokens."""
        shared_a, shared_b = self.shared_ends()
        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        n_groups = np.bincount(self.doc_a[shared_a], minlength=self.n)
        if not len(self.a):
            return n_groups, [b""] * self.n
        # In a group the tokens of one side come before those of the other.
        total = int(shared_a.sum())
        before_a = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=total))])[group_a]
        before_b = np.cumsum(np.bincount(group_a, minlength=total))[group_b]
        last = np.zeros(len(self.b), bool)
        last[np.cumsum(self.n_b)[self.fits] - 1] = True
        table = np.empty(len(self.a) + len(self.b), np.int64)
        table[np.arange(len(self.a)) + before_a] = separators.first(self.a, shared_a)
        table[np.arange(len(self.b)) + before_b] = separators.second(self.b, shared_b, last)
        parts = separators.texts.take(pa.array(table))
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy().astype(np.int64))])
        at = ends[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        data = b"".join(parts.to_pylist()) if parts.offset else parts.buffers()[2].to_pybytes()
        return n_groups, [data[i:j] for i, j in zip(at, at[1:])]


class Separated:
    """Decimal ids with what may follow them in the text of groups."""

    def __init__(self, n_first: int, n_second: int):
        self.n_first, self.n_second = n_first, n_second
        texts = [f"{i}{mark}" for n, marks in ((n_first, ",|"), (n_second, [",", ";", ""])) for mark in marks for i in range(n)]
        self.texts = pa.array([t.encode() for t in texts], pa.large_binary())

    def first(self, ids: np.ndarray, ends_group: np.ndarray) -> np.ndarray:
        return ids + self.n_first * ends_group

    def second(self, ids: np.ndarray, ends_group: np.ndarray, ends_document: np.ndarray) -> np.ndarray:
        return 2 * self.n_first + ids + self.n_second * (ends_group.astype(np.int64) + ends_document)


def _range_of(first: np.ndarray) -> np.ndarray:
    mixed = (first.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(64 - RANGE_BITS)


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    high = _range_of(a) << np.uint64(2 * ID_BITS)
    return high | a.astype(np.uint64) << np.uint64(ID_BITS) | b.astype(np.uint64)


def _models(documents: DataFrame, first: str, second: str) -> tuple[Broadcast, Broadcast]:
    """Both files, which have a bounded size; the driver reads them."""
    ship_package(documents.sparkSession)
    found = []
    for path in (first, second):
        with open(path, "rb") as file:
            found.append(documents.sparkSession.sparkContext.broadcast(file.read()))
    return found[0], found[1]


def _sides(models: tuple[Broadcast, Broadcast]) -> tuple[Codec, Pieces]:
    # Strings of special tokens in a text are plain text.
    return codec_of(models[0].value.decode(), added=False), pieces_of(models[1].value)


def _keyed(documents: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    rows = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows, rows.schema["_key"].dataType.simpleString()


def _blocks(documents: DataFrame, models: tuple[Broadcast, Broadcast], key: str, text: str, batch_bytes: int) -> C.Chunks:
    """``chunk, rows, asked``: figures and links of each batch, and its distinct pairs with the number of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, (codec, pieces) = TaskContext.get().partitionId() << 32, _sides(models)
        separators = Separated(codec.size, pieces.size)
        for table in batches_of(batches, "_text", batch_bytes):
            batch = Batch(table.column("_text").combine_chunks(), codec, pieces)
            left, right = batch.links()
            document = batch.doc_a[left]
            place, pairs = pd.factorize(pair_keys(batch.a[left], batch.b[right]))
            order = np.argsort(pairs)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            place = rank[place]
            # A pair counts once in a document.
            n_pairs = max(1, len(pairs))
            n = np.bincount(pd.unique(document * n_pairs + place) % n_pairs, minlength=len(pairs)).astype(np.uint32)
            n_groups, groups = batch.groups(separators)
            figures = {
                "_key": table.column("_key").combine_chunks(),
                "n_a": pa.array(batch.n_a, pa.int64()),
                "n_b": pa.array(batch.n_b, pa.int64()),
                "n_groups": pa.array(n_groups, pa.int64()),
                "n_links": pa.array(np.bincount(document, minlength=batch.n), pa.int64()),
                "digest": pa.array([hashlib.sha256(g).digest() if g else b"" for g in groups], pa.binary()),
            }
            rows = C.pack_arrays(rows=packed_rows(pa.table(figures)), links=planes(place))
            asked = C.pack_arrays(keys=pairs[order], n=planes(n))
            columns = {"chunk": pa.array([number], pa.int64()), "rows": pa.array([rows], pa.binary())}
            yield pa.RecordBatch.from_pydict(columns | {"asked": pa.array([asked], pa.binary())})
            number += 1
            del batch, left, right, document, place, groups
            C.give_back()
        codec.forget()

    rows, _ = _keyed(documents, key, text)
    return stored_blocks(rows.mapInArrow(run, BLOCK_SCHEMA), "alignment")


def _asked(stored: C.Chunks, n_ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            held = C.unpack_arrays(row["asked"])
            keys, n = held["keys"], from_planes(held["n"], "u4")
            part = (keys >> np.uint64(2 * ID_BITS)) * np.uint64(n_ranges) >> np.uint64(RANGE_BITS)
            bounds = np.searchsorted(part, np.arange(n_ranges + 1, dtype=np.uint64)).tolist()
            cuts = [(p, a, b) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            data = [C.pack_arrays(keys=keys[a:b], n=planes(n[a:b])) for _, a, b in cuts]
            yield C.messages(row["chunk"], [p for p, _, _ in cuts], data)

    return stored.frame.select("chunk", "asked").mapInArrow(run, C.MESSAGE_SCHEMA)


def _rows_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in ("part", "chunk", "data")))


def _added(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, place, np.concatenate(n))
    return found, sums


def _totals(asked: DataFrame, n_ranges: int) -> DataFrame:
    """One message for each range, from no block (-1): its pairs, their counts, and the highest count of their first id."""

    def done(part: int, keys: list, n: list) -> pa.RecordBatch:
        found, sums = _added(keys, n)
        first = found >> np.uint64(ID_BITS)
        begin = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        best = np.repeat(np.maximum.reduceat(sums, begin), np.diff(np.append(begin, len(first))))
        return C.messages(-1, [part], [C.pack_arrays(keys=found, n=planes(sums), best=planes(best))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, n, size = None, [], [], 0
        for part, _, data in _rows_in_order(batches):
            if part != current:
                if keys:
                    yield done(current, keys, n)
                current, keys, n, size = part, [], [], 0
            held = C.unpack_arrays(data)
            keys.append(held["keys"])
            n.append(from_planes(held["n"], "u4").astype(np.int64))
            size += len(keys[-1])
            if size > MOST_HELD:
                total, sums = _added(keys, n)
                # Distinct pairs of a range are bounded by the vocabularies.
                keys, n, size = [total], [sums], 0
        if keys:
            yield done(current, keys, n)

    placed = asked.repartitionById(n_ranges, "part").sortWithinPartitions("part")
    return placed.mapInArrow(run, C.MESSAGE_SCHEMA)


def _counted(asked: DataFrame, totals: DataFrame, n_ranges: int) -> DataFrame:
    """For every message, the counts of its pairs, and which are the highest of their first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for part, chunk, data in _rows_in_order(batches):
            if chunk < 0:
                held = C.unpack_arrays(data)
                held |= {name: from_planes(held[name], "i8") for name in ("n", "best")}
                continue
            at = np.searchsorted(held["keys"], C.unpack_arrays(data)["keys"])
            n = held["n"][at]
            yield C.answers(part, [chunk], [C.pack_arrays(n=planes(n), best=np.packbits(n == held["best"][at]))])

    placed = totals.unionByName(asked).repartitionById(n_ranges, "part").sortWithinPartitions("part", "chunk")
    return placed.mapInArrow(run, C.ANSWER_SCHEMA)


def align(
    documents: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row for each document.

    ``first`` is a byte-level BPE file and cuts a space and the text, ``second`` a piece model and cuts
    the text, to which it adds the space. A pair of ids counts as many documents as hold it linked;
    ``n_best`` are the links whose pair no other pair of its first id exceeds, ``count_sum`` adds up
    the counts of all links, ``groups_sha256`` is of the text of ``groups``.

    A text that is null, empty, or that one side doesn't reproduce byte by byte, has no tokens: zeros
    and an empty digest. A null key stays null; repeated rows are documents of their own; an empty
    table gives no rows. Other columns take no part.
    """
    models = _models(documents, first, second)
    stored = _blocks(documents, models, key, text, batch_bytes)
    n_ranges = min(stored.n_chunks, 1 << RANGE_BITS)
    asked = _asked(stored, n_ranges)
    answered = _counted(asked, _totals(asked, n_ranges), n_ranges)
    joined = C.with_answers(C.Chunks(stored.frame.select("chunk", "rows"), stored.n_chunks, stored.n_buckets), answered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            held = C.unpack_arrays(row["rows"])
            rows, links = pa.ipc.open_stream(held["rows"]).read_all(), from_planes(held["links"], "i4")
            n, best = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for answer in row["answers_0"] or []:
                given = C.unpack_arrays(answer["data"])
                n.append(from_planes(given["n"], "i8"))
                best.append(np.unpackbits(given["best"], count=len(n[-1])).astype(bool))
            n, best = np.concatenate(n), np.concatenate(best)
            bounds = np.concatenate([[0], np.cumsum(rows.column("n_links").to_numpy())])
            added = lambda values: np.diff(np.concatenate([[0], np.cumsum(values[links], dtype=np.int64)])[bounds])
            rows = rows.append_column("n_best", pa.array(added(best))).append_column("count_sum", pa.array(added(n)))
            digests = [d.hex() for d in rows.column("digest").to_pylist()]
            rows = rows.drop_columns("digest").append_column("groups_sha256", pa.array(digests, pa.string()))
            yield from rows.combine_chunks().to_batches()

    _, key_type = _keyed(documents, key, text)
    figures = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = f"_key {key_type}, " + ", ".join(f"{name} bigint" for name in figures) + ", groups_sha256 string"
    return joined.select("rows", "answers_0").mapInArrow(run, schema).withColumnRenamed("_key", key)


def groups(
    documents: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``key, n_groups, groups``: groups between shared ends as ``a1,a2|b1;a3|b2,b3``. Rules as for ``align``."""
    models = _models(documents, first, second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, pieces = _sides(models)
        separators = Separated(codec.size, pieces.size)
        for table in batches_of(batches, "_text", batch_bytes):
            n, found = Batch(table.column("_text").combine_chunks(), codec, pieces).groups(separators)
            columns = {"_key": table.column("_key").combine_chunks(), "n_groups": pa.array(n, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"groups": pa.array([g.decode() for g in found], pa.string())})

    rows, key_type = _keyed(documents, key, text)
    return rows.mapInArrow(run, f"_key {key_type}, n_groups bigint, groups string").withColumnRenamed("_key", key)


def overlaps(
    documents: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``key, a, b, a_id, b_id``: places (from 0) and ids of overlapping tokens. Rules as for ``align``."""
    models = _models(documents, first, second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, pieces = _sides(models)
        for table in batches_of(batches, "_text", batch_bytes):
            batch = Batch(table.column("_text").combine_chunks(), codec, pieces)
            left, right = batch.links()
            document = batch.doc_a[left]
            begin_a, begin_b = np.cumsum(batch.n_a) - batch.n_a, np.cumsum(batch.n_b) - batch.n_b
            columns = {
                "_key": table.column("_key").combine_chunks().take(pa.array(document)),
                "a": pa.array(left - begin_a[document], pa.int64()),
                "b": pa.array(right - begin_b[document], pa.int64()),
                "a_id": pa.array(batch.a[left], pa.int32()),
                "b_id": pa.array(batch.b[right], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    rows, key_type = _keyed(documents, key, text)
    schema = f"_key {key_type}, a bigint, b bigint, a_id int, b_id int"
    return rows.mapInArrow(run, schema).withColumnRenamed("_key", key)
