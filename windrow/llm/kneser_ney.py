"""Interpolated modified Kneser-Ney language model (Chen and Goodman 1999) on chunks of documents.

Texts are cut into words once; chunks hold the hashes of their words and the places of these.
From the longest n-grams down, every chunk asks once for its distinct n-grams of an order, by hash.
Each range of hashes meets in one task, which adds up the counts, stores them as sorted hash arrays,
memory-maps those and answers the chunks from them. One of the chunks that know an n-gram, its
owner, passes on what the next order counts: distinct predecessors, and the statistics of contexts.
So counts are exact but for n-grams that share a hash of 56 bits, which isn't verified; nothing is as
large as the whole model in any task, and a frequent word costs no more than a rare one. Chunks then
score their texts with what they were answered; the stored arrays score other documents later.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import chunks as C
from windrow.session import run_folder

ORDER, BITS, CHUNK_BYTES = 2, 56, 4 << 20
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: What is stored for an n-gram: its (adjusted) count, and as a context the sum of counts behind it and
#: how many of them are one, two, and three or more; for words the plain count, too.
FIELDS = ("count", "behind", "ones", "twos", "more", "plain")
LEVEL_SCHEMA = "kind string, chunk bigint, part int, data binary"
#: The model row among the messages of a range.
STORED = -1
#: Places that are scored together.
SEGMENT = 1 << 17
#: Messages of a range that are answered together.
TOGETHER = 256
#: Spark removes a query's shuffle files when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Discounts where counts of counts are missing; fixed values.
FALLBACK = (0.5, 1.0, 1.5)


@dataclass(frozen=True)
class Model:
    """Where the sorted hash arrays lie, in how many ranges, and the figures of the corpus."""

    folder: str
    order: int
    n_parts: int
    tokens: int
    vocabulary: int
    #: By order: counts of counts 1 to 4, number and sum of the counts above zero, and how many are 3 or more.
    counts_of_counts: dict[int, tuple[int, ...]]
    #: The arrays were kept, so that other documents can be scored.
    stored: bool = True

    def discounts(self, order: int) -> np.ndarray:
        """What to subtract from counts 0, 1, 2, and 3 or more."""
        n = self.counts_of_counts.get(order, (0,) * 7)
        found = [0.0]
        for i in (1, 2, 3):
            if n[0] and n[1] and n[i - 1] and n[i]:
                found.append(min(max(i - (i + 1) * n[0] / (n[0] + 2 * n[1]) * n[i] / n[i - 1], 0.0), float(i)))
            else:
                found.append(FALLBACK[i - 1])
        return np.array(found)


class _Made(dict):
    """By order, made when first asked for: a pass over the chunks needs two orders, not all."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, m: int):
        self[m] = self.make(m)
        return self[m]


def _coded(order: int):
    """A chunk as it is stored: keys and flags of its documents, its distinct words' hashes, and its tokens as places in those.

    Each document stands behind ``order - 1`` begin marks and has one end.
    """

    def form(rows: pa.Table) -> bytes:
        texts = pc.fill_null(rows.column("_text").combine_chunks().cast(pa.large_string()), "")
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        count = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        words, place = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        # White space at either end of a text leaves an empty word.
        some = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[place] if len(place) else np.zeros(0, bool)
        length = np.bincount(np.repeat(np.arange(len(count)), count)[some], minlength=len(count))
        # Behind the words of the table: the begin mark and the end; no word has a space.
        bounds, data = np.frombuffer(words.buffers()[1], np.int64)[words.offset :][: len(words) + 1].tolist(), words.buffers()[2]
        view = memoryview(data or b"").cast("B")
        distinct = [view[i:j] for i, j in zip(bounds, bounds[1:])] + [b" begin", b" end"]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct)) >> np.uint64(64 - BITS)
        begin, end = len(words), len(words) + 1
        whole = length + order
        tokens = np.full(int(whole.sum()), begin, np.int32)
        ends = np.cumsum(whole)
        tokens[ends - 1] = end
        inner = np.ones(len(tokens), bool)
        inner[ends - 1] = False
        for k in range(order - 1):
            inner[ends - whole + k] = False
        tokens[inner] = place[some]
        used = np.bincount(tokens, minlength=len(distinct)) > 0
        keys = C.distinct(hashes[used])
        number = np.searchsorted(keys, hashes).astype("<u4")
        held = pa.table({"_own": rows.column("_own"), "_train": rows.column("_train"), "_length": pa.array(whole, pa.int64())})
        return C.pack_arrays(keys=keys, tokens=_planes(number[tokens]), rows=C.packed_table(held.combine_chunks()))

    return form


def _planes(values: np.ndarray) -> bytes:
    """Numbers by place of the byte, which compresses better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


class Tokens:
    """The tokens of a chunk, each document behind ``order - 1`` begin marks, with hashes of n-grams."""

    def __init__(self, data: bytes, order: int):
        held = C.unpack_arrays(data)
        self.rows = pa.ipc.open_stream(held["rows"]).read_all()
        ids = np.ascontiguousarray(np.frombuffer(held["tokens"], np.uint8).reshape(4, -1).T).view("<i4").reshape(-1)
        self.length = self.rows.column("_length").to_numpy()
        self.document = np.repeat(np.arange(len(self.length), dtype=np.int32), self.length)
        begin = np.cumsum(self.length) - self.length
        self.depth = (np.arange(len(ids)) - np.repeat(begin, self.length)).astype(np.int32)
        self.predicted = self.depth >= order - 1
        self.order, self._ids, self._words = order, ids, held["keys"]
        self._grams = {1: (held["keys"] << np.uint64(64 - BITS))[ids]}
        self._found = _Made(self._distinct)
        self.keys, self.index = _Made(lambda m: self._found[m][0]), _Made(lambda m: self._found[m][1])
        #: Of each key the first place.
        self.first = _Made(lambda m: self._found[m][2])
        self.first_is_begin = _Made(self._begins)

    def _hashes(self, m: int) -> np.ndarray:
        for k in range(2, m + 1):
            if k not in self._grams:
                mixed = np.roll(self._grams[k - 1], 1)
                mixed *= A
                mixed += self._grams[1]
                mixed ^= mixed >> np.uint64(29)
                mixed *= B
                mixed ^= mixed >> np.uint64(32)
                self._grams[k] = mixed
        return self._grams[m]

    def _distinct(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of an order, each place's number among them, and each one's first place.

        Places whose n-gram crosses the begin of a document point to a key that isn't used.
        """
        if m == 1:
            # Words are numbered by their keys.
            return self._words, self._ids, np.zeros(0, np.int64)
        shift = np.uint64(64 - BITS)
        hashes = np.where(self.depth >= m - 1, self._hashes(m) >> shift << shift, np.uint64(0))
        place = C.in_order(hashes)
        found = hashes[place]
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        index = np.empty(len(found), np.int32)
        index[place] = np.cumsum(new) - 1
        return found[new] >> shift, index, place[new]

    def _begins(self, m: int) -> np.ndarray:
        found = np.zeros(len(self.keys[m]), bool)
        first = (self.depth >= m - 1) & (self.depth - (m - 1) < self.order - 1)
        found[self.index[m][first]] = True
        return found

    def forget(self) -> None:
        """Give up what made the keys, and these: their numbers at hand stay."""
        self._grams.clear()
        self._found.clear()
        self.keys.clear()
        self.first.clear()

    def trained(self) -> np.ndarray:
        """The token is predicted, and its document learnt from."""
        flags = self.rows.column("_train").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
        return self.predicted & flags[self.document]

    def sums(self, m: int, at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """For every key of an order, the sum over places or key numbers."""
        return np.bincount(at, weights=weights, minlength=len(self.keys[m])).astype("<u8")


def _narrow(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _answered(answers: list[dict] | None, names: Sequence[str]) -> dict[str, np.ndarray]:
    parts = [C.unpack_arrays(a["data"]) for a in answers or []]
    return {k: np.concatenate([np.zeros(0, "u1"), *(p[k] for p in parts)]) for k in names}


def _fields(m: int, order: int) -> tuple[str, ...]:
    return ("count",) if m == order else FIELDS if m == 1 else FIELDS[:-1]


def _questions(m: int, order: int, n_parts: int, learning: bool):
    """Messages with a chunk's n-grams of order m, and what the chunk adds to their figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            tokens = Tokens(row["rows"], order)
            index, values = tokens.index[m], {}
            if learning:
                trained = tokens.trained()
                plain = tokens.sums(m, index[trained])
                if m == order:
                    values["count"] = plain
                else:
                    above = _answered(row["answers_0"], ("count", "own"))
                    own = np.flatnonzero(above["own"])
                    place = tokens.first[m + 1][own]
                    count = above["count"][own]
                    context, suffix = index[place - 1], index[place]
                    distinct = tokens.sums(m, suffix)
                    values["count"] = np.where(tokens.first_is_begin[m], plain, distinct)
                    values["behind"] = tokens.sums(m, context, count)
                    for name, of in (("ones", count == 1), ("twos", count == 2), ("more", count > 2)):
                        values[name] = tokens.sums(m, context[of])
                    if m == 1:
                        values["plain"] = plain
            values = {name: _narrow(value) for name, value in values.items()}
            yield C.ask(tokens.keys[m], BITS, n_parts, row["chunk"], **values)

    return run


def _mapped(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays memory-mapped from a file that is gone when they are."""
    with tempfile.TemporaryFile() as file:
        found, at = {}, 0
        for value in arrays.values():
            file.write(value.data if len(value) else b"")
        file.flush()
        for name, value in arrays.items():
            size = value.nbytes
            if size:
                found[name] = np.memmap(file, value.dtype, "r", at, value.shape)
            else:
                found[name] = value
            at += size
        return found


def _level(m: int, order: int, keep: bool):
    """Adds up a range's figures, stores them as sorted arrays, and answers from those."""
    fields = _fields(m, order)

    def run(part: int, messages: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        def out(kind: str, chunks: list[int], data: list[bytes]) -> pa.RecordBatch:
            columns = {"kind": [kind] * len(data), "chunk": pa.array(chunks, pa.int64())}
            columns |= {"part": pa.array([part] * len(data), pa.int32()), "data": pa.array(data, pa.binary())}
            return pa.RecordBatch.from_pydict(columns)

        asked, stored = [], []
        for chunk, data in messages:
            (stored if chunk == STORED else asked).append((chunk, C.unpack_arrays(data)))
        none = np.zeros(0, np.uint64)
        every = np.concatenate([none, *(a["keys"] for _, a in asked)])
        if not stored and (not asked or "count" not in asked[0][1]):
            stored = [(STORED, {"keys": none} | {f: np.zeros(0, "<u8") for f in fields})]
        if stored:
            arrays = {"keys": stored[0][1]["keys"]} | {k: stored[0][1][k].astype("<u8") for k in fields}
            keys = arrays["keys"]
            place = np.searchsorted(keys, every)
            if len(keys):
                place[keys[np.minimum(place, len(keys) - 1)] != every] = len(keys)
        else:
            # Keys of one range have their high bits in common, which say nothing here.
            least = every.min(initial=np.uint64((1 << BITS) - 1))
            span = max(1, int(every.max(initial=least) - least).bit_length())
            by_key = C.in_order(every - least << np.uint64(64 - span))
            found = every[by_key]
            new = np.ones(len(found), bool)
            new[1:] = found[1:] != found[:-1]
            begins = np.flatnonzero(new)
            arrays = {"keys": found[new]}
            for name in fields:
                values = np.concatenate([a[name] for _, a in asked]).astype("<u8")
                arrays[name] = np.add.reduceat(values[by_key], begins) if len(begins) else none
            # A key that no document learnt from asked for is no part of the model.
            used = np.any([arrays[name] > 0 for name in fields], axis=0)
            number = np.where(used, np.cumsum(used) - 1, np.count_nonzero(used))
            place = np.empty(len(every), np.int64)
            place[by_key] = number[np.cumsum(new) - 1]
            arrays = {k: v[used] for k, v in arrays.items()}
            if keep:
                narrow = {name: _narrow(arrays[name]) for name in fields}
                yield out("model", [STORED], [C.pack_arrays(keys=arrays["keys"], **narrow)])
            count = arrays["count"][arrays["count"] > 0]
            figures = [*(int((count == i).sum()) for i in (1, 2, 3, 4)), len(count), int(count.sum()), int((count > 2).sum())]
            plain = arrays.get("plain", np.zeros(0, "<u8"))
            figures += [int(plain.sum()), int((plain > 0).sum())]
            yield out("figures", [STORED], [np.array(figures, "<i8").tobytes()])
        n = len(arrays["keys"])
        # Behind the stored figures, those of a key that isn't in the model.
        arrays = _mapped({k: np.append(arrays[k], np.uint64(0)) for k in fields})
        owned = np.zeros(n + 1, bool)
        owned[n:] = True
        ends = np.cumsum([len(a["keys"]) for _, a in asked]).tolist()
        for a in range(0, len(asked), TOGETHER):
            data = []
            for (_, _), i, j in zip(asked[a : a + TOGETHER], [0, *ends][a:], ends[a:]):
                at = place[i:j]
                found = {name: arrays[name][at] for name in fields}
                own = (found["count"] > 0) & ~owned[at]
                owned[at[own]] = True
                data.append(C.pack_arrays(**{k: _narrow(v) for k, v in found.items()}, own=own.view(np.uint8)))
            yield out("answer", [chunk for chunk, _ in asked[a : a + TOGETHER]], data)

    return run


def _scores(model: Model):
    """Scores of the documents of a chunk, from the answers of all orders."""
    order = model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.each(batches):
            tokens = Tokens(row["rows"], order)
            given = [_answered(row.pop(f"answers_{m - 1}"), _fields(m, order)) for m in range(1, order + 1)]
            index = [tokens.index[m] for m in range(1, order + 1)]
            tokens.forget()
            every = np.flatnonzero(tokens.predicted)
            n = len(tokens.length)
            n_known, base, score = np.zeros((3, n))
            # Some places at a time: there are a dozen numbers for each.
            for begin in range(0, len(every), SEGMENT):
                at = every[begin : begin + SEGMENT]
                plain = given[0]["plain"][index[0][at]].astype(float)
                chance = np.full(len(at), 1.0 / (model.vocabulary + 1))
                for m in range(1, order + 1):
                    count = given[m - 1]["count"][index[m - 1][at]].astype(float)
                    discounts = model.discounts(m)
                    taken = discounts[np.minimum(count, 3).astype(int)]
                    if m == 1:
                        n1, n2, _, _, _, total, more = model.counts_of_counts.get(1, (0,) * 7)
                        behind, ones, twos, rest = (np.full(len(at), float(x)) for x in (total, n1, n2, more))
                    else:
                        context = index[m - 2][at - 1]
                        behind, ones, twos, rest = (given[m - 2][k][context].astype(float) for k in FIELDS[1:5])
                    some = behind > 0
                    left = discounts[1] * ones + discounts[2] * twos + discounts[3] * rest
                    whole = np.where(some, behind, 1.0)
                    chance = np.where(some, (count - taken) / whole + left / whole * chance, chance)
                # Places are in the order of their documents.
                of = tokens.document[at]
                first, of = of[0], of - of[0]
                smoothed = np.log10((plain + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))
                for sums, values in ((n_known, plain > 0), (base, smoothed), (score, np.log10(chance))):
                    found = np.bincount(of, values)
                    sums[first : first + len(found)] += found
            yield pa.RecordBatch.from_pydict(
                {
                    "_key": tokens.rows.column("_own").combine_chunks(),
                    "learnt": tokens.rows.column("_train").combine_chunks(),
                    "n_tokens": tokens.length - (order - 1),
                    "n_known": n_known.astype(np.int64),
                    "base_score": base,
                    "score": score,
                }
            )

    return run


def _run_level(
    asking: DataFrame, m: int, order: int, n_parts: int, folder: str, learning: bool, stored: DataFrame | None, keep: bool = False
) -> DataFrame:
    messages = asking.mapInArrow(_questions(m, order, n_parts, learning), C.MESSAGE_SCHEMA)
    if stored is not None:
        messages = messages.unionByName(stored.select("part", F.lit(STORED).cast("bigint").alias("chunk"), "data"))
    path, spark = f"{folder}/order={m}", asking.sparkSession
    # The level is stored: its shuffle's files, the largest there are, go at once.
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        C.meet(messages, n_parts, _level(m, order, keep), LEVEL_SCHEMA).write.partitionBy("kind").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(LEVEL_SCHEMA).parquet(path)


def _answers(level: DataFrame) -> DataFrame:
    return level.where("kind = 'answer'").select("chunk", "part", "data")


def _chunked(documents: DataFrame, key: str, text: str, learn: Column, order: int, chunk_bytes: int) -> C.Chunks:
    inner = documents.select(documents[key].alias("_k"), documents[text].alias("_t"), learn.alias("_train"))
    return C.to_chunks(inner.withColumn("_own", F.col("_k")), "_k", "_t", ("_own", "_train"), chunk_bytes, _coded(order))


def _finish(chunks: C.Chunks, levels: dict[int, DataFrame], model: Model, key: str, key_type: str) -> DataFrame:
    answered = C.with_answers(chunks, *[_answers(levels[m]) for m in range(1, model.order + 1)])
    schema = f"_key {key_type}, learnt boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    found = answered.mapInArrow(_scores(model), schema).withColumnRenamed("_key", key)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found.withColumn("train_tokens", F.lit(model.tokens).cast("bigint")).withColumn("perplexity", perplexity)


def learn_and_score(
    documents: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    chunk_bytes: int = CHUNK_BYTES,
    keep: bool = True,
) -> tuple[DataFrame, Model]:
    """Scores of all documents by a model of those with ``learn``, and the model.

    ``key, learnt, n_tokens, n_known, base_score, score, train_tokens, perplexity``: ``score`` is the
    log10 probability of the text's words and its end, ``base_score`` that of additively smoothed
    words, ``perplexity`` the score's for each token. Keys are whole numbers, or texts of such.
    Words are cut at white space and lower-cased (A-Z). A null or empty text is an end alone. A null
    ``learn`` is false; with nothing to learn from, all words are equally unknown. Null keys stay,
    repeated rows are learnt and scored each; an empty table gives no rows. Other columns take no part.
    Without ``keep`` the model's arrays, as large as the texts, are not stored for other documents.
    """
    spark = documents.sparkSession
    chunks = _chunked(documents, key, text, learn, order, chunk_bytes)
    n_parts = C.parts_for(chunks.n_chunks)
    folder = run_folder(spark, "kneser-ney")
    levels: dict[int, DataFrame] = {}
    for m in range(order, 0, -1):
        asking = C.with_answers(chunks, _answers(levels[m + 1])) if m < order else chunks.frame
        levels[m] = _run_level(asking, m, order, n_parts, folder, True, None, keep)
    model = _model(spark, folder, order, n_parts, keep)
    return _finish(chunks, levels, model, key, documents.schema[key].dataType.simpleString()), model


def _model(spark: SparkSession, folder: str, order: int, n_parts: int, keep: bool) -> Model:
    """The figures of a stored model: one short row for each order and range."""
    found, plain = {}, np.zeros(2, np.int64)
    for m in range(1, order + 1):
        rows = spark.read.schema(LEVEL_SCHEMA).parquet(f"{folder}/order={m}").where("kind = 'figures'")
        figures = np.zeros(9, np.int64)
        for row in rows.select("data").toLocalIterator():
            figures += np.frombuffer(row["data"], "<i8")
        found[m] = tuple(int(x) for x in figures[:7])
        if m == 1:
            plain = figures[7:]
    return Model(folder, order, n_parts, int(plain[0]), int(plain[1]), found, keep)


def score(
    documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Scores of other documents by a stored model; columns and rules as for ``learn_and_score``."""
    if not model.stored:
        raise ValueError("the model was not kept")
    spark = documents.sparkSession
    chunks = _chunked(documents, key, text, F.lit(False), model.order, chunk_bytes)
    folder = run_folder(spark, "kneser-ney-scores")
    levels = {}
    for m in range(1, model.order + 1):
        stored = spark.read.schema(LEVEL_SCHEMA).parquet(f"{model.folder}/order={m}").where("kind = 'model'")
        levels[m] = _run_level(chunks.frame, m, model.order, model.n_parts, folder, False, stored)
    return _finish(chunks, levels, model, key, documents.schema[key].dataType.simpleString())
