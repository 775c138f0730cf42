"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of a model holds a whitespace marker behind another character, pieces never leave a
chunk: a run of markers and what follows up to the next marker. So a text is a sequence of chunks,
and each distinct chunk of the corpus is segmented once. Documents lie in blocks of some megabytes;
a block keeps the places of its chunks and sends its distinct ones, spread by their hash, to the
table's ranges. A range segments a chunk when it first comes and answers every block with ids in
the order asked; blocks then put ids back by position. Texts themselves are not shuffled.
"""

from __future__ import annotations

import functools
import heapq
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm import chunks as C
from windrow.session import run_folder, ship_package

MARK = "▁"
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
#: Ranges of the table of chunks, at most. A range's distinct chunks are held by one task, messages pass through.
MOST_RANGES = 4096
#: Bytes of messages whose new chunks are segmented together.
TOGETHER_BYTES = 4 << 20
#: Chunks of at most so many characters are segmented many at a time.
MOST_TOGETHER = 64
#: Characters that are segmented together: they bound the memory of it.
SLOTS = 1 << 22
#: Symbols below 2^21: pieces, single characters of pieces, and all other characters.
SHIFT = 21
NONE = np.iinfo(np.int32).max
BLOCK_SCHEMA = "chunk bigint, rows binary, words binary"
#: Leading runs of spaces with what follows them.
CHUNK = re.compile(" +[^ ]*")
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Pieces:
    """A BPE piece model with byte fallback, ready for segmenting chunks and for decoding."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        text, kinds = spec.normalizer_spec, [p.type for p in spec.pieces]
        plain = not (text.precompiled_charsmap or text.remove_extra_whitespaces) and text.add_dummy_prefix and text.escape_whitespaces
        if spec.trainer_spec.model_type != 2 or not plain or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models that leave texts as they are, with a marker in front, are supported")
        if not spec.trainer_spec.byte_fallback or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only models with byte fallback and without symbols of a user's own are supported")
        names = [p.piece for p in spec.pieces]
        known = {name: i for i, (name, kind) in enumerate(zip(names, kinds)) if kind == NORMAL}
        if any(MARK in name.lstrip(MARK) for name in known):
            raise ValueError("pieces of this model cross whitespace markers")
        self.size, self.end = len(names), next(i for i, n in enumerate(names) if n == "</s>")
        self.byte_ids = np.zeros(256, np.int32)
        surfaces, self.marked, self.control, self.byte = [], *np.zeros((3, self.size), bool)
        for i, (name, kind) in enumerate(zip(names, kinds)):
            self.marked[i] = kind == NORMAL and name.startswith(MARK)
            self.control[i], self.byte[i] = kind == CONTROL, kind == BYTE
            if kind == BYTE:
                self.byte_ids[int(name[3:5], 16)] = i
                surfaces.append(bytes([int(name[3:5], 16)]))
            else:
                surfaces.append({CONTROL: "", UNKNOWN: " ⁇ "}.get(kind, name.replace(MARK, " ")).encode())
        self.surfaces = pa.array(surfaces, pa.large_binary())
        # Symbols: ids of pieces, then characters that are only parts of pieces, then any other character.
        symbols = dict(known)
        for name in known:
            for c in name:
                symbols.setdefault(c, self.size + len(symbols) - len(known))
        self.others = self.size + len(symbols) - len(known)
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + np.int32(self.others)
        self.character = np.full(self.others, -1, np.int32)
        for name, symbol in symbols.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = symbol
                self.character[symbol] = ord(name)
        # Every way to make a piece of two symbols, and the rank of its score; equal scores share a rank.
        scores = sorted({spec.pieces[i].score for i in known.values()}, reverse=True)
        rank_of = {score: rank for rank, score in enumerate(scores)}
        pairs: dict[int, tuple[int, int]] = {}
        for name, i in known.items():
            for k in range(1, len(name)):
                left, right = symbols.get(name[:k]), symbols.get(name[k:])
                if left is not None and right is not None:
                    pairs[left << SHIFT | right] = (rank_of[spec.pieces[i].score], i)
        self.pairs = pairs
        self._hash(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32).reshape(-1, 2))

    # Pairs by hash: a slot holds a key or the next slot does; lookups are arrays.

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, 2 + int(len(keys)).bit_length())
        self.keys = np.full((1 << self.bits) + 1, -1, np.int64)
        self.values = np.full(((1 << self.bits) + 1, 2), NONE, np.int32)
        left, self.reach = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left]) + self.reach & (1 << self.bits) - 1
            free = self.keys[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            placed = left[free][first]
            slot = slot[free][first]
            self.keys[slot], self.values[slot] = keys[placed], values[placed]
            left = np.setdiff1d(left, placed)
            self.reach += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; the last one, whose rank is ``NONE``, stands for none."""
        keys = left.astype(np.int64) << SHIFT | right
        first = self._slot(keys)
        found = np.where(self.keys[first] == keys, first, len(self.keys) - 1)
        open_ = np.flatnonzero((self.keys[first] != keys) & (self.keys[first] >= 0))
        for step in range(1, self.reach):
            slot = first[open_] + step & (1 << self.bits) - 1
            held = self.keys[slot]
            hit = held == keys[open_]
            found[open_[hit]] = slot[hit]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
        return found

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.values[self._find(left, right), 0]

    # Segmenting

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one after the other, and how many each has; a chunk comes without its first marker."""
        length = np.fromiter(map(len, words), np.int64, len(words)) + 1
        n_symbols = length.copy()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(length).tolist():
            among = np.flatnonzero(length == size)
            step = max(1, SLOTS // size)
            for at in range(0, len(among), step):
                chosen = among[at : at + step]
                text = "".join([MARK + words[i] for i in chosen.tolist()]).replace(" ", MARK)
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                symbols = self.symbol_of[points]
                if size > MOST_TOGETHER:
                    for k, i in enumerate(chosen.tolist()):
                        found = np.array(self._merge(symbols[k * size : (k + 1) * size].tolist()), np.int32)
                        parts.append((np.array([i]), found.reshape(1, -1)))
                else:
                    parts += [(chosen[rows], found) for rows, found in self._rectangle(symbols.reshape(-1, size))]
        for rows, found in parts:
            n_symbols[rows] = found.shape[1]
        start = np.cumsum(n_symbols) - n_symbols
        flat = np.zeros(int(n_symbols.sum()), np.int32)
        for rows, found in parts:
            flat[(start[rows][:, None] + np.arange(found.shape[1])).reshape(-1)] = found.reshape(-1)
        return self._with_bytes(flat, n_symbols)

    def _rectangle(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of equally many symbols; each round, all rows that can make their best merge and so stay equally long."""
        rows = np.arange(len(symbols))
        n, width = symbols.shape
        ranks = self._rank(symbols[:, :-1].reshape(-1), symbols[:, 1:].reshape(-1)).reshape(n, width - 1)
        while width > 1:
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            open_ = ranks[line, at] < NONE
            if not open_.all():
                yield rows[~open_], symbols[~open_]
                rows, symbols, ranks, at = rows[open_], symbols[open_], ranks[open_], at[open_]
                line = np.arange(len(rows))
            if not len(rows):
                return
            symbols[line, at] = self.values[self._find(symbols[line, at], symbols[line, at + 1]), 1]
            width -= 1
            before = np.arange(width) <= at[:, None]
            symbols = np.where(before, symbols[:, :-1], symbols[:, 1:])
            ranks = np.where(before[:, :-1], ranks[:, :-1], ranks[:, 1:])
            # The new symbol's pairs: with the one before it and with the one behind it.
            i = np.concatenate([line[at > 0], line[at < width - 1]])
            j = np.concatenate([at[at > 0] - 1, at[at < width - 1]])
            ranks[i, j] = self._rank(symbols[i, j], symbols[i, j + 1])
        yield rows, symbols

    def _merge(self, symbols: list[int]) -> list[int]:
        """One long chunk, by a heap of ranks and places."""
        n, pairs = len(symbols), self.pairs
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            found = pairs.get(symbols[i] << SHIFT | symbols[j])
            if found is not None:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = pairs[left << SHIFT | right][1], -1
            k = following[i] = following[j]
            if k < n:
                previous[k] = i
                offer(i, k)
            if previous[i] >= 0:
                offer(previous[i], i)
        return [s for s in symbols if s >= 0]

    def _with_bytes(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces become the bytes of their character."""
        odd = np.flatnonzero(flat >= self.size)
        if not len(odd):
            return flat, count
        symbol = flat[odd]
        points = np.where(symbol < self.others, self.character[np.minimum(symbol, self.others - 1)], symbol - self.others)
        data = np.frombuffer("".join(map(chr, points.tolist())).encode("utf-8", "surrogatepass"), np.uint8)
        wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        width = np.ones(len(flat), np.int64)
        width[odd] = wide
        spread = np.repeat(flat, width)
        spread[spread >= self.size] = self.byte_ids[data]
        ends = np.concatenate([[0], np.cumsum(width)])
        bounds = np.concatenate([[0], np.cumsum(count)])
        return spread, np.diff(ends[bounds])

    # Decoding

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.LargeStringArray:
        """Texts of rows of ids. Control ids say nothing; bytes that are no UTF-8 become U+FFFD, each for itself."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError(f"an id lies outside the vocabulary of {self.size}")
        parts = self.surfaces.take(pa.array(ids))
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy())])
        at = ends[bounds]
        # The marker in front of the first piece is not part of the text.
        spoken = np.flatnonzero(~self.control[ids])
        first = np.searchsorted(spoken, bounds[:-1])
        there = first < len(spoken)
        first = spoken[np.minimum(first, max(0, len(spoken) - 1))] if len(spoken) else np.zeros(len(bounds) - 1, np.int64)
        strip = there & (first < bounds[1:])
        strip[strip] = self.marked[ids[first[strip]]]
        data = b"".join(parts.to_pylist()) if parts.offset else (parts.buffers()[2] or pa.py_buffer(b""))
        if strip.any():
            keep = np.ones(int(ends[-1]), bool)
            keep[at[:-1][strip]] = False
            data = pa.py_buffer(np.frombuffer(data, np.uint8)[: int(ends[-1])][keep].tobytes())
            at = at - np.concatenate([[0], np.cumsum(strip)])
        joined = pa.Array.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), data]
        )
        # A control id parts the bytes around it.
        quiet, byte = np.flatnonzero(self.control[ids]), self.byte[ids]
        quiet = quiet[(quiet > 0) & (quiet + 1 < len(ids))]
        parted = quiet[byte[quiet - 1]]
        if len(parted):
            rows = [x.as_py() for x in joined]
            for row in np.unique(np.searchsorted(bounds, parted, side="right") - 1).tolist():
                rows[row] = self._in_runs(ids[bounds[row] : bounds[row + 1]]).encode()
            joined = pa.array(rows, pa.large_binary())
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([_each_byte(x.as_py()) for x in joined], pa.large_string())

    def _in_runs(self, ids: np.ndarray) -> str:
        """The text of one row, each run between control ids for itself."""
        found, begun = [], False
        for run in np.split(ids, np.flatnonzero(self.control[ids])):
            run = run[~self.control[run]]
            if len(run):
                text = _each_byte(b"".join(self.surfaces.take(pa.array(run)).to_pylist()))
                found.append(text[1:] if not begun and self.marked[run[0]] else text)
                begun = True
        return "".join(found)


def _each_byte(data: bytes) -> str:
    found = []
    while data:
        try:
            found.append(data.decode())
            break
        except UnicodeDecodeError as error:
            found += [data[: error.start].decode(), "�" * (error.end - error.start)]
            data = data[error.end :]
    return "".join(found)


@functools.lru_cache(maxsize=2)
def pieces_of(model: bytes) -> Pieces:
    """One for each worker process."""
    return Pieces(model)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of the texts, without their first marker; the place of each chunk; chunks per text.

    A marker that a text has itself is a marker. A null or empty text has no chunk.
    """
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), MARK, " ")
    runs = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.equal(texts, ""))
    words = pc.split_pattern(pc.if_else(runs, pa.scalar(None, pa.large_string()), texts), " ")
    counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    odd = [[w[1:] for w in CHUNK.findall(" " + t)] if t else [] for t in texts.filter(runs).to_pylist()]
    at = np.flatnonzero(runs.to_numpy(zero_copy_only=False))
    rest = pa.array([w for ws in odd for w in ws], pa.large_string())
    both = pa.concat_arrays([words.flatten(), rest]).dictionary_encode()
    n_odd = np.zeros(len(texts), np.int64)
    n_odd[at] = [len(ws) for ws in odd]
    index = both.indices.to_numpy().astype(np.int32)
    if len(rest):
        # Chunks of the others stand behind; a stable sort by text brings them to their place.
        n = np.arange(len(texts))
        index = index[np.argsort(np.concatenate([np.repeat(n, counts), np.repeat(n, n_odd)]), kind="stable")]
    return both.dictionary, index, counts + n_odd


def _by_range(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct chunks by range, then text, and where each of ``MOST_RANGES`` begins and ends."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    ranges = (hashes >> np.uint64(32)) * np.uint64(MOST_RANGES) >> np.uint64(32)
    table = pa.table({"range": pa.array(ranges), "word": words})
    order = pc.sort_indices(table, sort_keys=[("range", "ascending"), ("word", "ascending")]).to_numpy()
    return order.astype(np.int64), np.searchsorted(ranges[order], np.arange(MOST_RANGES + 1))


def batches_of(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.Table]:
    """Rows in tables of about ``size`` bytes of text, a longer text being one of its own."""
    held, held_size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + size - held_size, side="right"))
            stop = min(batch.num_rows, max(stop, start + (not held)))
            held.append(batch.slice(start, stop - start))
            held_size += int(ends[stop - 1]) - before if stop > start else 0
            start = stop
            if start < batch.num_rows or held_size >= size:
                yield pa.Table.from_batches([b for b in held if b.num_rows], batch.schema)
                held, held_size = [], 0
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches([b for b in held if b.num_rows])


def packed_rows(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
        writer.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def planes(values: np.ndarray) -> bytes:
    """Numbers by place of the byte, which compresses better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def stored_blocks(frame: DataFrame, name: str) -> C.Chunks:
    """A frame with a ``chunk`` number, written bucketed by it to the shared folder."""
    spark = frame.sparkSession
    n_buckets = min(C.MOST_BUCKETS, max(1, frame.rdd.getNumPartitions()))
    table = f"windrow_{name}_{uuid.uuid4().hex}"
    writer = frame.write.bucketBy(n_buckets, "chunk").option("path", run_folder(spark, name))
    writer.option("parquet.enable.dictionary", "false").option("compression", "none").saveAsTable(table)
    stored = spark.read.table(table)
    spark.sql(f"DROP TABLE {table}")
    return C.Chunks(stored, max(1, stored.select("chunk").count()), n_buckets)


def blocks(documents: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> C.Chunks:
    """``chunk, rows, words``: keys and places of chunks of a block's texts, and its distinct chunks."""
    ship_package(documents.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in batches_of(batches, "_text", block_bytes):
            words, index, counts = cut(table.column("_text").combine_chunks())
            keys = table.select(["_key"]).append_column("n", pa.array(counts))
            words = words.cast(pa.large_binary())
            order, bounds = _by_range(words)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            words = words.take(pa.array(order))
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([number], pa.int64()),
                "rows": pa.array([C.pack_arrays(rows=packed_rows(keys), index=planes(place[index]))], pa.binary()),
                "words": pa.array([_packed_words(words, bounds)], pa.binary()),
            })
            number += 1
            C.give_back()

    rows = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return stored_blocks(rows.mapInArrow(pack, BLOCK_SCHEMA), "pieces")


def _packed_words(words: pa.Array, bounds: np.ndarray) -> bytes:
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.uint32)
    sizes = np.diff(bounds).astype(np.uint32)
    data = zstandard.compress(b"".join(words.to_pylist()), 3)
    return C.pack_arrays(lengths=planes(lengths), sizes=planes(sizes), data=data)


def _words(held: dict) -> list[bytes]:
    data, ends = zstandard.decompress(held["data"]), np.cumsum(from_planes(held["lengths"], "u4"), dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _asked(stored: C.Chunks, n_ranges: int) -> DataFrame:
    """The distinct chunks of every block, in messages to the ranges of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            held = C.unpack_arrays(row["words"])
            words, lengths = _words(held), from_planes(held["lengths"], "u4")
            ends = np.concatenate([[0], np.cumsum(from_planes(held["sizes"], "u4"), dtype=np.int64)])
            # So many ranges are taken together that there are as many as asked for.
            part = np.arange(MOST_RANGES) * n_ranges // MOST_RANGES
            bounds = ends[np.searchsorted(part, np.arange(n_ranges + 1))].tolist()
            cuts = [(part, a, b) for part, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            data = [
                C.pack_arrays(lengths=planes(lengths[a:b]), data=zstandard.compress(b"".join(words[a:b]), 3)) for _, a, b in cuts
            ]
            yield C.messages(row["chunk"], [part for part, _, _ in cuts], data)

    return stored.frame.select("chunk", "words").mapInArrow(run, C.MESSAGE_SCHEMA)


class _Table:
    """The chunks of the range at hand with their ids; new ones are segmented when they first come."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known, self.part = pieces, {}, None

    def answer(self, messages: list[tuple[int, int, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        if messages[0][0] != self.part:
            self.known = {}
        known = self.known
        fresh = list({w for _, _, words in messages for w in words if w not in known})
        ids, count = self.pieces.segment([w.decode() for w in fresh])
        flat, ends = ids.astype("<u4").tobytes(), np.cumsum(4 * count).tolist()
        known.update((w, flat[a:b]) for w, a, b in zip(fresh, [0, *ends], ends))
        for part, chunk, words in messages:
            found = [known[w] for w in words]
            lengths = np.fromiter(map(len, found), np.uint32, len(found)) // 4
            ids = np.frombuffer(b"".join(found), "<u4")
            yield C.answers(part, [chunk], [C.pack_arrays(lengths=planes(lengths), ids=planes(ids))])
        self.part = messages[-1][0]
        if messages[0][0] != self.part:
            # Of earlier ranges no message comes any more.
            self.known = {w: known[w] for part, _, words in messages if part == self.part for w in words}


def _segmented(asked: DataFrame, n_ranges: int, model) -> DataFrame:
    """Ids for every message, some megabytes of messages at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, size = _Table(pieces_of(model.value)), [], 0
        for batch in batches:
            for part, chunk, data in zip(*(batch.column(n).to_pylist() for n in ("part", "chunk", "data"))):
                held.append((part, chunk, _words(C.unpack_arrays(data))))
                size += sum(map(len, held[-1][2]))
                if size > TOGETHER_BYTES:
                    yield from table.answer(held)
                    held, size = [], 0
        if held:
            yield from table.answer(held)
        C.give_back()

    placed = asked.repartitionById(n_ranges, "part").sortWithinPartitions("part")
    return placed.mapInArrow(run, C.ANSWER_SCHEMA)


def _put_back(row: dict, end: int | None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Keys, ids and bounds of a block's texts."""
    held = C.unpack_arrays(row["rows"])
    rows, at = pa.ipc.open_stream(held["rows"]).read_all(), from_planes(held["index"], "i4")
    # Answers come by range, in the order of the block's distinct chunks.
    given = [C.unpack_arrays(a["data"]) for a in row["answers_0"] or []]
    length = np.concatenate([np.zeros(0, np.int64), *[from_planes(g["lengths"], "u4").astype(np.int64) for g in given]])
    flat = np.concatenate([np.zeros(0, np.int32), *[from_planes(g["ids"], "u4").astype(np.int32) for g in given]])
    n = rows.column("n").to_numpy()
    start = np.cumsum(length) - length
    if end is not None:
        # One more chunk behind each text, which holds the end.
        at = np.insert(at, np.cumsum(n), len(length))
        start, length, flat, n = np.append(start, len(flat)), np.append(length, 1), np.append(flat, np.int32(end)), n + 1
    ends = np.concatenate([[0], np.cumsum(length[at])])
    ids = flat[np.repeat(start[at] - ends[:-1], length[at]) + np.arange(ends[-1])]
    return rows.column("_key").combine_chunks(), ids, ends[np.concatenate([[0], np.cumsum(n)])]


def _encoded(documents: DataFrame, path: str, key: str, text: str, end: bool, block_bytes: int, decoded: bool) -> DataFrame:
    spark = documents.sparkSession
    with open(path, "rb") as file:  # the driver reads the vocabulary, which has a bounded size
        model = spark.sparkContext.broadcast(file.read())
    pieces_of(model.value)  # an unfit model is refused at once
    stored = blocks(documents, key, text, block_bytes)
    n_ranges = min(stored.n_chunks, MOST_RANGES)
    kept = C.Chunks(stored.frame.select("chunk", "rows"), stored.n_chunks, stored.n_buckets)
    joined = C.with_answers(kept, _segmented(_asked(stored, n_ranges), n_ranges, model))
    key_type = documents.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model.value)
        for row in C.each(batches):
            keys, ids, bounds = _put_back(row, pieces.end if end else None)
            # Some megabytes at a time go on.
            step = max(1, len(keys) * (1 << 20) // max(1, len(ids)))
            for a in range(0, len(keys), step):
                b = min(len(keys), a + step)
                part, at = ids[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                columns = {"_key": keys[a:b], "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(part))}
                if decoded:
                    columns["decoded"] = pieces.decode(part, at).cast(pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"_key {key_type}, ids array<int>" + (", decoded string" if decoded else "")
    return joined.mapInArrow(run, schema).withColumnRenamed("_key", key)


def encode(
    documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``key, ids``: the ids of every whole text, as the library of the model gives them; ``end`` adds its end id.

    A null or empty text has no ids but the end. A null key stays null and repeated rows give repeated
    rows; an empty table gives none. Other columns take no part.
    """
    return _encoded(documents, path, key, text, end, block_bytes, False)


def round_trip(
    documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``key, ids, decoded``: encoding, and decoding of what it gave. Rules as for ``encode``."""
    return _encoded(documents, path, key, text, end, block_bytes, True)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text``: the text of every row of ids. Null or no ids give an empty text; an unknown id is an error."""
    spark = encoded.sparkSession
    ship_package(spark)
    with open(path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    inner = encoded.select(F.col(key).alias("_key"), F.col(ids).cast("array<int>").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model.value)
        for batch in batches:
            lists = batch.column("_ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = lists.flatten()
            if values.null_count:
                raise ValueError("an id is null")
            texts = pieces.decode(values.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), texts.cast(pa.string())], ["_key", "text"])

    key_type = inner.schema["_key"].dataType.simpleString()
    return inner.mapInArrow(run, f"_key {key_type}, text string").withColumnRenamed("_key", key)
