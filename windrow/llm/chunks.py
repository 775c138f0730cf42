"""Documents in chunks, and questions from chunks to a table of keys that is spread over tasks.

A chunk is a row: some megabytes of documents, compressed, in a table in the shared folder. So its
content and its number stay the same whenever a task is run again. A chunk asks about its distinct
keys at once; the keys are cut into ranges, each range meets in one task as packed arrays, and every
chunk gets its answers as arrays in the order it asked. A key costs some bytes once per chunk,
however often it occurs, so a key that fills a third of the corpus is as light as any other. The
table is bucketed by chunk: answers travel to their chunk, texts are never shuffled.
"""

from __future__ import annotations

import ctypes
import functools
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.session import run_folder, ship_package

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20
#: Bytes of rows after which a task gives memory back.
GIVE_BACK_BYTES = 1 << 20
#: Spark's own limit to the number of buckets.
MOST_BUCKETS = 100_000
CHUNK_SCHEMA = "chunk bigint, rows binary"
MESSAGE_SCHEMA = "part int, chunk bigint, data binary"
ANSWER_SCHEMA = "chunk bigint, part int, data binary"


@dataclass(frozen=True)
class Chunks:
    """``chunk, rows``, bucketed by chunk."""

    frame: DataFrame
    n_chunks: int
    n_buckets: int


def to_chunks(
    documents: DataFrame,
    key: str,
    text: str,
    carry: Sequence[str] = (),
    chunk_bytes: int = CHUNK_BYTES,
    form: Callable[[pa.Table], bytes] | None = None,
) -> Chunks:
    """The table of chunks, written to the shared folder.

    Carried columns travel along. In a chunk, rows are sorted by key (nulls first), then text, and stored
    as ``form`` gives them (``packed_table``).
    """
    form = form or packed_table
    spark = documents.sparkSession
    ship_package(spark)
    keyed = documents.select(
        F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"), *carry
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
            start = 0
            while start < batch.num_rows:
                ends = np.cumsum(lengths[start:])
                n = max(1, int(np.searchsorted(ends, chunk_bytes - size, side="right")) + (1 if not held else 0))
                n = min(n, batch.num_rows - start)
                held.append(batch.slice(start, n))
                size += int(ends[n - 1])
                start += n
                if size >= chunk_bytes:
                    yield _chunk(held, number, form)
                    held, size, number = [], 0, number + 1
                    give_back()
        if held:
            yield _chunk(held, number, form)

    n_buckets = min(MOST_BUCKETS, max(1, keyed.rdd.getNumPartitions()))
    name, folder = f"windrow_chunks_{uuid.uuid4().hex}", run_folder(spark, "chunks")
    # Chunks are compressed as they are. The catalog's entry is only needed for reading them bucketed.
    writer = keyed.mapInArrow(pack, CHUNK_SCHEMA).write.bucketBy(n_buckets, "chunk").option("path", folder)
    writer.option("parquet.enable.dictionary", "false").option("compression", "none").saveAsTable(name)
    frame = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return Chunks(frame, max(1, frame.select("chunk").count()), n_buckets)


def _chunk(held: list[pa.RecordBatch], number: int, form: Callable[[pa.Table], bytes]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    order = pc.sort_indices(
        rows.select(["_key", "_text"]), sort_keys=[("_key", "ascending"), ("_text", "ascending")], null_placement="at_start"
    )
    data = form(rows.take(order).combine_chunks())
    return pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int64()), "rows": pa.array([data], pa.binary())})


def packed_table(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def rows_of(data: bytes) -> pa.Table:
    """The documents of a chunk: ``_key``, ``_text`` and what they carry."""
    return pa.ipc.open_stream(data).read_all()


def parts_for(n_chunks: int, together: int = 1) -> int:
    """Ranges of keys: one for every ``together`` chunks, but growing as their root when there are very many.

    So neither the messages of a chunk nor the keys of a range get out of hand. A message costs some hundred
    microseconds whatever it holds: where chunks ask little, a range takes what several of them ask.
    """
    return max(1, min(-(-n_chunks // together), 16 * math.isqrt(n_chunks)))


def part_of(keys: np.ndarray, bits: int, n_parts: int) -> np.ndarray:
    """The range of each key of so many bits."""
    high = (keys >> np.uint64(bits - 32)).astype(np.uint64)
    return ((high * np.uint64(n_parts)) >> np.uint64(32)).astype(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers, by sorting: ``np.unique`` of large integers hashes, which takes many times as long."""
    if not len(values):
        return values
    found = np.sort(values)
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def in_order(hashes: np.ndarray) -> np.ndarray:
    """Places of 64-bit numbers in their order, equal ones as they come.

    Sorted are the high bits with the place in the low ones, which takes a third of an ``argsort``; where
    numbers that differ in the low bits only came out of order, that does it.
    """
    n = len(hashes)
    low = np.uint64((1 << n.bit_length()) - 1)
    place = (np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
    found = hashes[place]
    return np.argsort(hashes, kind="stable") if (found[1:] < found[:-1]).any() else place


def pack_arrays(**arrays: np.ndarray | bytes) -> bytes:
    """Named arrays as bytes; sorted keys (``keys``) are stored as differences, by place of the byte."""
    columns, fields = [], []
    for name, value in arrays.items():
        if name == "keys":
            steps = value.astype("<u8")
            steps[1:] -= value[:-1]
            value = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
        elif isinstance(value, np.ndarray):
            fields.append((name, value.dtype.str))
            value = value.tobytes()
            columns.append(value)
            continue
        fields.append((name, "keys" if name == "keys" else "bytes"))
        columns.append(value)
    head = ";".join(f"{n},{t},{len(c)}" for (n, t), c in zip(fields, columns)).encode()
    return packed(len(head).to_bytes(4, "little") + head + b"".join(columns))


@functools.cache
def _codecs() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One pair for each worker process: making one takes as long as using it on a message."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(data: bytes) -> bytes:
    return _codecs()[0].compress(data)


def unpacked(data: bytes) -> bytes:
    return _codecs()[1].decompress(data)


def unpack_arrays(data: bytes) -> dict[str, np.ndarray | bytes]:
    raw = unpacked(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    found: dict[str, np.ndarray | bytes] = {}
    for field in raw[4:at].decode().split(";"):
        name, kind, size = field.split(",")
        value = raw[at : at + int(size)]
        at += int(size)
        if kind == "keys":
            steps = np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
            found[name] = np.cumsum(steps, dtype=np.uint64)
        else:
            found[name] = value if kind == "bytes" else np.frombuffer(value, kind)
    return found


def messages(chunk: int, parts: list[int], data: list[bytes]) -> pa.RecordBatch:
    columns = {"part": pa.array(parts, pa.int32()), "chunk": pa.array([chunk] * len(parts), pa.int64())}
    return pa.RecordBatch.from_pydict(columns | {"data": pa.array(data, pa.binary())})


def ask(keys: np.ndarray, bits: int, n_parts: int, chunk: int, **values: np.ndarray) -> pa.RecordBatch:
    """Messages with a chunk's sorted distinct keys and what belongs to them, by range."""
    bounds = np.searchsorted(part_of(keys, bits, n_parts), np.arange(n_parts + 1))
    parts = np.flatnonzero(np.diff(bounds)).tolist()
    cuts = [(bounds[part], bounds[part + 1]) for part in parts]
    data = [pack_arrays(keys=keys[a:b], **{k: v[a:b] for k, v in values.items()}) for a, b in cuts]
    return messages(chunk, parts, data)


def give_back() -> None:
    """Return what Arrow's pool and the C library hold, but don't use, to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that no more than one chunk is unpacked; memory goes back after every megabyte of them."""
    passed = GIVE_BACK_BYTES
    for batch in batches:
        for i in range(batch.num_rows):
            if passed >= GIVE_BACK_BYTES:
                give_back()
                passed = 0
            passed += batch.nbytes // batch.num_rows
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def meet(
    asked: DataFrame, n_parts: int, work: Callable[[int, list[tuple[int, bytes]]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``work(part, [(chunk, data)])`` for every range of keys, whose messages meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for row in each(batches):
            held.setdefault(row["part"], []).append((row["chunk"], row["data"]))
        for part in sorted(held):
            yield from work(part, sorted(held.pop(part), key=lambda x: x[0]))

    return asked.repartitionById(n_parts, "part").mapInArrow(run, schema)


def answers(part: int, chunks: list[int], data: list[bytes]) -> pa.RecordBatch:
    columns = {"chunk": pa.array(chunks, pa.int64()), "part": pa.array([part] * len(chunks), pa.int32())}
    return pa.RecordBatch.from_pydict(columns | {"data": pa.array(data, pa.binary())})


def with_answers(chunks: Chunks, *given: DataFrame) -> DataFrame:
    """Chunks with their answers, as arrays ``answers_0``, ``answers_1``, … of part and data."""
    found = chunks.frame
    for i, rows in enumerate(given):
        # Dealt like the buckets, so that the chunks stay where they are.
        placed = rows.repartition(chunks.n_buckets, "chunk").groupBy("chunk")
        gathered = placed.agg(F.sort_array(F.collect_list(F.struct("part", "data"))).alias(f"answers_{i}"))
        found = found.join(gathered.hint("merge"), "chunk", "left")
    return found


def joined(answers: list[dict] | None, dtype: str) -> np.ndarray:
    """The answers of all parts as one array, in the order of the keys that were asked."""
    parts = [np.frombuffer(unpacked(a["data"]), dtype) for a in answers or []]
    return np.concatenate([np.zeros(0, dtype), *parts])
