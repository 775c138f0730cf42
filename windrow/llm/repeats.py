"""Which windows of a corpus occur earlier in it: shared by substring and suffix-array dedup.

A window is ``window`` neighbouring units (words or bytes) of one document, and its minimiser the
smallest hash of the ``gram``-unit pieces in it. Equal windows have equal minimisers, so a window
whose minimiser occurs once in the corpus is unique and goes no further. Of the others, each chunk
keeps the first of equal ones, and neighbours that share a minimiser travel as one packed string to
the minimiser's bucket, where the operator compares them exactly. A minimiser that occurs more than
``HOT`` times would fill a bucket; its windows travel one by one, spread by their own hash, and
equal ones still meet. Buckets answer with a bit per window sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from windrow.llm import chunks as C

BITS = 48
HOT = 4096
#: Chunks whose minimisers a range counts. Strings that may occur again are many times as much: a range takes one chunk's.
TOGETHER = 4
#: Positions that are hashed at a time: their arrays fit into a core's cache.
SEGMENT = 1 << 16
FIRST_KEY = np.iinfo(np.int64).min
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Kind:
    """``within``: windows that start earlier in the same document count as earlier, too."""

    words: bool
    window: int
    gram: int
    within: bool


@dataclass
class Piece:
    """Packed strings as a bucket gets them: neighbouring windows of one document each."""

    key: np.ndarray
    start: np.ndarray
    n_windows: np.ndarray
    n_bytes: np.ndarray
    data: bytes


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2^64; kept for the process."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SEGMENT + 256)
        for name, base in (("up", int(A)), ("down", pow(int(A), -1, 1 << 64))):
            found = np.full(size, base, np.uint64)
            found[0] = 1
            _powers[name] = np.multiply.accumulate(found)
    return _powers["up"][:n], _powers["down"][:n]


def grams(units: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` neighbouring units: a polynomial from running sums, mixed at the end."""
    up, down = powers(len(units))
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * up, out=sums[1:])
    x = sums[size:] - sums[:-size]
    x *= down[: len(x)]
    x ^= x >> np.uint64(29)
    x *= B
    x ^= x >> np.uint64(32)
    return x


def keyed(hashes: np.ndarray) -> np.ndarray:
    """Keys of minimisers. The smallest of many hashes is a small one: mixed again, keys fill their range evenly."""
    x = hashes * B
    x ^= x >> np.uint64(32)
    x *= A
    return x >> np.uint64(64 - BITS)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbouring values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Sequence:
    """The documents of a chunk as one sequence of units."""

    def __init__(self, kind: Kind, rows: pa.Table):
        self.kind = kind
        texts = [(t or "").encode() for t in rows.column("_text").to_pylist()]
        keys = rows.column("_key")
        self.keys = np.array([FIRST_KEY if k is None else k for k in keys.to_pylist()], np.int64)
        if kind.words:
            split = [t.split() for t in texts]
            self.words = [w for words in split for w in words]
            lengths = [len(words) for words in split]
            index: dict[bytes, int] = {}
            place = np.array([index.setdefault(w, len(index)) for w in self.words], np.int64)
            self.exact = place
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in index], np.uint64)
            self.values = hashes[place] if len(place) else np.zeros(0, np.uint64)
        else:
            self.bytes = np.frombuffer(b"".join(texts), np.uint8)
            self.exact = self.bytes
            lengths = [len(t) for t in texts]
            random = np.random.Generator(np.random.PCG64(0))
            self.table = random.integers(0, 2**64, 256, dtype=np.uint64)
        self.length = np.array(lengths, np.int64)
        self.ends = np.cumsum(self.length)
        self.begins = self.ends - self.length
        self.n = int(self.ends[-1]) if len(self.ends) else 0

    def units(self, a: int, b: int) -> np.ndarray:
        return self.values[a:b] if self.kind.words else self.table[self.bytes[a:b]]

    def _segments(self) -> Iterator[tuple[int, np.ndarray]]:
        """Starts of segments of windows, and the hashes of their units."""
        window = self.kind.window
        for a in range(0, max(0, self.n - window + 1), SEGMENT):
            yield a, self.units(a, min(self.n, a + SEGMENT + window - 1))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and minimiser of the runs of neighbouring windows that share one."""
        kind, found = self.kind, []
        for _, units in self._segments():
            hashes = grams(units, kind.gram)
            found.append(keyed(smallest(hashes, kind.window - kind.gram + 1)))
        values = np.concatenate([np.zeros(0, np.uint64), *found])
        # No window crosses the end of a document.
        inside = np.ones(len(values), bool)
        for a, b in zip(np.maximum(self.begins, self.ends - kind.window + 1).tolist(), self.ends.tolist()):
            inside[a:b] = False
        cut = np.ones(len(values), bool)
        cut[1:] = (values[1:] != values[:-1]) | ~inside[:-1]
        first = np.zeros(self.n + 1, bool)  # a run ends with its document, too
        first[self.begins] = True
        start = np.flatnonzero((cut | first[: len(values)]) & inside)
        stop = np.append(start[1:], len(values))
        # Windows that are not inside end a run as well.
        outside = np.flatnonzero(~inside)
        at = np.searchsorted(outside, start)
        limit = np.where(at < len(outside), np.append(outside, len(values))[at], len(values))
        return start, np.minimum(stop, limit) - start, values[start].copy()

    def times(self, values: np.ndarray) -> np.ndarray:
        """How often each minimiser occurs in the chunk, at least 1.

        Where repeats within a document count, neighbouring windows can share several equal pieces,
        so all pieces are counted, chosen or not; else a run of windows counts once.
        """
        if not self.kind.within:
            return np.unique(values, return_counts=True)[1]
        found = [np.zeros(0, np.uint64)]
        for a, units in self._segments():
            hashes = keyed(grams(units, self.kind.gram))
            # The windows of the next segment overlap; its pieces are counted there.
            found.append(hashes[:SEGMENT] if a + SEGMENT <= self.n - self.kind.window else hashes)
        every, keys = np.sort(np.concatenate(found)), C.distinct(values)
        return np.searchsorted(every, keys, side="right") - np.searchsorted(every, keys)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def hashes(self, at: np.ndarray, salt: int = 0) -> np.ndarray:
        """Hashes of the windows that start at sorted places."""
        odd = np.uint64(2 * salt + 1)
        found = [np.zeros(0, np.uint64)]
        for a, units in self._segments():
            lo, hi = np.searchsorted(at, [a, a + SEGMENT])
            if hi > lo:
                found.append(grams(units * odd, self.kind.window)[at[lo:hi] - a])
        return np.concatenate(found)

    def same(self, a: np.ndarray, b: np.ndarray) -> bool:
        """The windows at ``a`` equal those at ``b``, unit by unit; ``a`` is sorted.

        Of neighbours that lie alike only the last unit is compared.
        """
        if not len(a):
            return True
        source = self.exact
        on = np.zeros(len(a), bool)
        on[1:] = (np.diff(a) == 1) & (np.diff(b) == 1)
        last = self.kind.window - 1
        if not np.array_equal(source[a[on] + last], source[b[on] + last]):
            return False
        whole, other = a[~on], b[~on]
        return all(np.array_equal(source[whole + k], source[other + k]) for k in range(last + 1))


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each, ``length`` numbers."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - ends + length, length) + np.arange(total)


def requests(kind: Kind, n_parts: int) -> Callable:
    """Messages that ask how often a chunk's minimisers occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            sequence = Sequence(kind, C.rows_of(row["rows"]))
            _, _, values = sequence.runs()
            counts = np.minimum(sequence.times(values), HOT + 1).astype("<u2")
            yield C.ask(C.distinct(values), BITS, n_parts, row["chunk"], counts=counts)

    return run


def occurrences(part: int, messages: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """0 for a minimiser that occurs once, 1 for one that occurs again, 2 for a hot one."""
    asked = [C.unpack_arrays(data) for _, data in messages]
    keys, index = np.unique(np.concatenate([m["keys"] for m in asked]), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate([m["counts"] for m in asked]), minlength=len(keys))
    classes = ((total > 1).astype(np.uint8) + (total > HOT))[index].astype(np.uint8)
    ends = np.cumsum([len(m["keys"]) for m in asked])
    data = [C.packed(c.tobytes()) for c in np.split(classes, ends[:-1])]
    yield C.answers(part, [chunk for chunk, _ in messages], data)


class Candidates:
    """A chunk's windows that may occur earlier, and what of them is sent; the same on every call."""

    def __init__(self, sequence: Sequence, answers: list[dict] | None, n_parts: int):
        kind = sequence.kind
        start, length, values = sequence.runs()
        classes = C.joined(answers, "u1")
        keys = C.distinct(values)
        of_run = classes[np.searchsorted(keys, values)] if len(keys) else np.zeros(0, np.uint8)
        asked = of_run > 0
        start, length, values, of_run = start[asked], length[asked], values[asked], of_run[asked]
        self.at = ragged(start, length)
        run = np.repeat(np.arange(len(start)), length)
        hashes = sequence.hashes(self.at)
        #: Of each window its group of equal ones, and of each group the place (in ``at``) of the first, which is sent.
        self.group, self.sent = _first_of_equal(hashes)
        salt = 0
        while not sequence.same(self.at, self.at[self.sent][self.group]):  # different windows of one hash
            salt += 1
            self.group, self.sent = _first_of_equal(sequence.hashes(self.at, salt))
        at, run = self.at[self.sent], run[self.sent]
        hot = of_run[run] == 2
        begin = np.ones(len(at), bool)
        begin[1:] = (np.diff(at) != 1) | (np.diff(run) != 0) | hot[1:]
        head = np.flatnonzero(begin)
        self.start = at[head]
        self.n_windows = np.diff(np.append(head, len(at)))
        bucket = np.where(hot[head], hashes[self.sent][head] >> np.uint64(64 - BITS), values[run[head]])
        self.part = C.part_of(bucket, BITS, n_parts)
        #: Pieces in the order in which they are sent, and for each window sent its place in that order.
        self.order = np.argsort(self.part, kind="stable")
        self.place = ragged(head[self.order], self.n_windows[self.order])


def _first_of_equal(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash the number of its group, and for each group its first place, ascending.

    Sorted are the hashes' high bits with the place in the low ones. Two hashes that differ in the low
    bits only can part a group; its parts are then compared by the bucket.
    """
    n = len(hashes)
    low = np.uint64((1 << n.bit_length()) - 1)
    place = (np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
    found = hashes[place]
    new = np.ones(n, bool)
    new[1:] = found[1:] != found[:-1]
    first = place[new]
    order = np.argsort(first)
    number = np.empty(len(first), np.int64)
    number[order] = np.arange(len(first))
    group = np.empty(n, np.int64)
    group[place] = number[np.cumsum(new) - 1]
    return group, first[order]


def packed(sequence: Sequence, found: Candidates, of: np.ndarray) -> bytes:
    """The strings of some pieces, with where they come from."""
    start, n = found.start[of], found.n_windows[of]
    units = n + sequence.kind.window - 1
    if sequence.kind.words:
        data = [b" ".join(sequence.words[a : a + k]) for a, k in zip(start.tolist(), units.tolist())]
        size, data = np.array([len(d) for d in data]), b"".join(data)
    else:
        size, data = units, sequence.bytes[ragged(start, units)].tobytes()
    document = sequence.document(start)
    return C.pack_arrays(
        key=sequence.keys[document].astype("<i8"),
        start=(start - sequence.begins[document]).astype("<i8"),
        n_windows=n.astype("<i4"),
        n_bytes=size.astype("<i4"),
        data=data,
    )


def strings(kind: Kind, n_parts: int) -> Callable:
    """Messages with the packed strings that go to the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            sequence = Sequence(kind, C.rows_of(row["rows"]))
            found = Candidates(sequence, row["answers_0"], n_parts)
            bounds = np.searchsorted(found.part[found.order], np.arange(n_parts + 1))
            parts = np.flatnonzero(np.diff(bounds)).tolist()
            yield C.messages(
                row["chunk"], parts, [packed(sequence, found, found.order[bounds[p] : bounds[p + 1]]) for p in parts]
            )

    return run


def buckets(compare: Callable[[Piece], np.ndarray]) -> Callable:
    """``compare`` gives a bit for each window of all pieces of a bucket: it occurs earlier."""

    def run(part: int, messages: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        sent = [C.unpack_arrays(data) for _, data in messages]
        names = ("key", "start", "n_windows", "n_bytes")
        pieces = Piece(*(np.concatenate([m[k] for m in sent]) for k in names), b"".join(m["data"] for m in sent))
        earlier = compare(pieces)
        ends = np.cumsum([int(m["n_windows"].sum()) for m in sent])
        data = [C.packed(e.astype(np.uint8).tobytes()) for e in np.split(earlier, ends[:-1])]
        yield C.answers(part, [chunk for chunk, _ in messages], data)

    return run


def removed_units(sequence: Sequence, found: Candidates, answers: list[dict] | None) -> np.ndarray:
    """A bit for each unit of the chunk: a window that covers it occurs earlier."""
    kind = sequence.kind
    earlier = np.zeros(len(found.sent), bool)
    earlier[found.place] = C.joined(answers, "u1").astype(bool)
    first = found.sent[found.group]
    document = sequence.document(found.at)
    key, start = sequence.keys[document], found.at - sequence.begins[document]
    later = key != key[first]
    if kind.within:
        later |= start != start[first]
    hit = found.at[later | earlier[found.group]]
    edge = np.zeros(sequence.n + 1, np.int32)
    edge[hit] += 1
    np.add.at(edge, hit + kind.window, -1)
    return np.cumsum(edge)[: sequence.n] > 0


def remove(
    documents: DataFrame,
    kind: Kind,
    compare: Callable[[Piece], np.ndarray],
    schema: str,
    result: Callable[[Sequence, pa.Table, np.ndarray], pa.RecordBatch],
    key: str,
    text: str,
    carry: tuple[str, ...],
    chunk_bytes: int,
) -> DataFrame:
    """``result(sequence, rows, removed)`` of every chunk."""
    chunks = C.to_chunks(documents, key, text, carry, chunk_bytes)
    n_parts, n_ranges = C.parts_for(chunks.n_chunks), C.parts_for(chunks.n_chunks, TOGETHER)
    asked = chunks.frame.mapInArrow(requests(kind, n_ranges), C.MESSAGE_SCHEMA)
    counted = C.meet(asked, n_ranges, occurrences, C.ANSWER_SCHEMA)
    spark = documents.sparkSession
    folder = C.run_folder(spark, "repeats")
    counted.write.parquet(f"{folder}/counted")
    counted = spark.read.schema(C.ANSWER_SCHEMA).parquet(f"{folder}/counted")
    packed = C.with_answers(chunks, counted).mapInArrow(strings(kind, n_parts), C.MESSAGE_SCHEMA)
    C.meet(packed, n_parts, buckets(compare), C.ANSWER_SCHEMA).write.parquet(f"{folder}/compared")
    compared = spark.read.schema(C.ANSWER_SCHEMA).parquet(f"{folder}/compared")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            rows = C.rows_of(row["rows"])
            sequence = Sequence(kind, rows)
            found = Candidates(sequence, row["answers_0"], n_parts)
            removed = removed_units(sequence, found, row["answers_1"])
            del found
            yield from result(sequence, rows, removed)

    return C.with_answers(chunks, counted, compared).mapInArrow(cut, schema)
