"""Byte-pair encoding and decoding of whole texts.

A text is cut into pieces by the tokenizer's pattern; merges never cross pieces. Over the pairs of
neighbouring symbols of a piece stands a segment tree of ranks: its root names the leftmost pair of
lowest rank. A merge changes three leaves, each in logarithmic time, and encoding ends when the
root holds no rank. Short pieces are encoded many at a time as a forest, one tree per row of an
array, each taking one merge a round; long pieces have a tree of their own. Pieces recur, so a
bounded number of them is remembered within a task. Documents stay where they are: no shuffle.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from windrow.llm.chunks import give_back
from windrow.llm.text import listed
from windrow.session import ship_package

#: Pieces of at most so many bytes are encoded in a forest.
FOREST_LEAVES = 64
#: Leaves in one forest, bytes of text encoded at a time, and bytes of words remembered: they bound a task's memory.
FOREST_SLOTS = 1 << 20
BATCH_BYTES = 2 << 20
REMEMBERED_BYTES = 24 << 20
#: What a remembered word takes besides its letters and ids: two objects and a place in a table.
WORD_BYTES = 200
NONE = np.iinfo(np.int32).max
#: Text with this is not cut at its spaces at once.
SPACES = re.compile(r" (?:\s|\Z)")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others follow from code point 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def supports(file: str) -> bool:
    """It is a byte-level BPE file without a normalizer or options that change the merges."""
    spec = json.loads(file)
    model, splitter = spec["model"], spec["pre_tokenizer"] or {}
    options = ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
    plain = not spec["normalizer"] and model["type"] == "BPE" and not any(model.get(o) for o in options)
    level = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
    matched = any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    return bool(plain and level and not matched)


class Codec:
    """A byte-level tokenizer file, ready for encoding and decoding."""

    def __init__(self, file: str, added: bool = True):
        """Without ``added``, strings of added tokens in a text are plain text."""
        if not supports(file):
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        spec = json.loads(file)
        model = spec["model"]
        letters = byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        vocabulary = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*vocabulary.values(), *special.values()])
        tokens = [b""] * self.size
        for token, i in vocabulary.items():
            if token not in special:
                tokens[i] = to_bytes(token)
        for token, i in special.items():
            tokens[i] = token.encode()
        self.tokens = pa.array(tokens, pa.large_binary())
        self.added = added = special if added else {}
        by_length = sorted(added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, by_length))) if added else None
        self.byte_ids = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.byte_ids[b] = vocabulary[letter]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left, right = (np.array([vocabulary[p[k]] for p in pairs], np.int64) for k in (0, 1))
        #: The symbol that the merge of each rank makes.
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        self.forget()
        self.assigned: set[str] = set()
        self.splitter = None

    def forget(self) -> None:
        """Give up all remembered words; a task does so at its end."""
        self.remembered: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.remembered_bytes = 0

    #: The pattern of byte-level tokenizers; a fixed value.
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    # Splitting

    def _all_assigned(self, text: str) -> bool:
        """No letter that libraries of different Unicode versions could class differently."""
        fresh = set(text) - self.assigned
        known = {c for c in fresh if unicodedata.category(c) != "Cn"}
        self.assigned |= known
        return len(known) == len(fresh)

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or self._all_assigned(text):
            return self.PIECES.findall(text)
        if self.splitter is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.splitter = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    # Merging

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], NONE)

    def _forest(self, data: np.ndarray, length: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many, of pieces of at most ``leaves`` bytes; every piece has a row with its tree."""
        n, width = len(length), leaves + 1  # a spare column takes what would be written behind the piece
        begin = np.arange(n, dtype=np.int64) * width
        column = np.arange(len(data)) - np.repeat(np.cumsum(length) - length, length)
        place = np.repeat(begin, length) + column
        symbol = np.full(n * width, -1, np.int32)
        symbol[place] = self.byte_ids[data]
        following = np.full(n * width, leaves, np.int32)
        inner = column + 1 < np.repeat(length, length)
        at, column = place[inner], column[inner]
        following[at] = column + 1
        previous = np.full(n * width, -1, np.int32)
        previous[at + 1] = column
        tree = np.full((n, 2 * leaves), NONE, np.int32)

        def leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank < NONE, rank * leaves + at, NONE)

        tree[at // width, leaves + column] = leaf(self._ranks(symbol[at], symbol[at + 1]), column)
        level = leaves // 2
        while level:
            below = tree[:, 2 * level : 4 * level]
            np.minimum(below[:, ::2], below[:, 1::2], out=tree[:, level : 2 * level])
            level //= 2
        tree = tree.reshape(-1)
        rows = np.arange(n)
        while True:
            root = tree[rows * (2 * leaves) + min(1, leaves)]
            open_ = root < NONE
            rows, root = rows[open_], root[open_]
            if not len(rows):
                break
            base, top = rows * width, rows * (2 * leaves)
            rank, i = root // leaves, root % leaves
            j = following[base + i]
            k = following[base + j]
            symbol[base + i] = self.made[rank]
            symbol[base + j] = -1
            following[base + i] = k
            previous[base + k] = i
            p = previous[base + i]
            p = np.where(p < 0, i, p)
            # The three leaves that change: j goes, i and its neighbour to the left get new pairs.
            after = following[base + p]
            pairs = self._ranks(
                np.concatenate([symbol[base + i], symbol[base + p]]), np.concatenate([symbol[base + k], symbol[base + after]])
            )
            right, left = pairs[: len(rows)], pairs[len(rows) :]
            tree[top + leaves + j] = NONE
            tree[top + leaves + p] = leaf(np.where(after == leaves, NONE, left), p)
            tree[top + leaves + i] = leaf(np.where(k == leaves, NONE, right), i)
            node = np.concatenate([i, j, p]) + leaves
            top = np.concatenate([top, top, top])
            for _ in range(leaves.bit_length() - 1):
                node >>= 1
                child = top + 2 * node
                tree[top + node] = np.minimum(tree[child], tree[child + 1])
        symbol = symbol.reshape(n, width)[:, :leaves]
        left = symbol >= 0
        return symbol[left], left.sum(axis=1)

    def _tree(self, piece: bytes) -> bytes:
        """Ids (as bytes) of one long piece."""
        symbol = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(symbol)
        leaves = 1 << (n - 1).bit_length()
        none, rank_of, made = 1 << 62, self.rank_of, self.made.tolist()

        def leaf(i: int, j: int) -> int:
            rank = rank_of.get(symbol[i] << 32 | symbol[j])
            return none if rank is None else rank * leaves + i

        tree = [none] * (2 * leaves)
        tree[leaves : leaves + n - 1] = [leaf(i, i + 1) for i in range(n - 1)]
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(i: int, value: int) -> None:
            node = leaves + i
            tree[node] = value
            while node > 1:
                node >>= 1
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    break
                tree[node] = value

        following, previous = list(range(1, n + 1)), list(range(-1, n))
        while tree[1] < none:
            rank, i = divmod(tree[1], leaves)
            j = following[i]
            k = following[j]
            symbol[i], symbol[j] = made[rank], -1
            following[i] = k
            previous[k] = i
            update(j, none)
            update(i, leaf(i, k) if k < n else none)
            if previous[i] >= 0:
                update(previous[i], leaf(previous[i], i))
        return np.array([s for s in symbol if s >= 0], "<i4").tobytes()

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, four bytes each."""
        encoded = [piece.encode() for piece in pieces]
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        found = {pieces[i]: self._tree(encoded[i]) for i in np.flatnonzero(length > FOREST_LEAVES)}
        leaves = 1
        while leaves <= FOREST_LEAVES:
            among = np.flatnonzero((length > leaves // 2) & (length <= leaves))
            for at in range(0, len(among), step := FOREST_SLOTS // leaves):
                part = among[at : at + step]
                data = np.frombuffer(b"".join([encoded[i] for i in part]), np.uint8)
                ids, counts = self._forest(data, length[part], leaves)
                flat, ends = ids.astype("<i4").tobytes(), np.cumsum(4 * counts).tolist()
                for i, a, b in zip(part.tolist(), [0, *ends], ends):
                    found[pieces[i]] = flat[a:b]
            leaves *= 2
        return found

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it; distinct words, none of which begins with white space."""
        if self.remembered_bytes > REMEMBERED_BYTES:
            # What wasn't met since the last time is forgotten.
            self.before, self.remembered, self.remembered_bytes = self.remembered, {}, 0
        known, before = self.remembered, self.before
        found = list(map(known.get, words))
        if before:
            found = [before.get(word) if ids is None else ids for word, ids in zip(words, found)]
        missing = [word for word, ids in zip(words, found) if ids is None]
        # One text of all missing words: a piece that begins with a space begins a word.
        pieces = self.PIECES.findall(" " + " ".join(missing)) if missing else []
        ids_of = self._encode_pieces(list(set(pieces)))
        learnt, word = [], []
        for piece in pieces:
            if piece[0] == " " and word:
                learnt.append(word[0] if len(word) == 1 else b"".join(word))
                word = []
            word.append(ids_of[piece])
        if word:
            learnt.append(b"".join(word))
        new = iter(learnt)
        found = [next(new) if ids is None else ids for ids in found]
        # Long ones are rare and would fill the memory.
        fresh = {w: ids for w, ids in zip(words, found) if w not in known and len(w) <= FOREST_LEAVES}
        known.update(fresh)
        self.remembered_bytes += WORD_BYTES * len(fresh) + sum(map(len, fresh)) + sum(map(len, fresh.values()))
        return found

    def _singly(self, text: str) -> list[str | int]:
        """Pieces of a text that is not cut at its spaces, and the ids of added tokens in it."""
        parts, at = [], 0
        for m in self.added_pattern.finditer(text) if self.added_pattern else ():
            parts += [*self.pieces(text[at : m.start()]), self.added[m[0]]]
            at = m.end()
        return parts + self.pieces(text[at:])

    # Batches

    def encode(self, texts: list[str]) -> pa.LargeListArray:
        """Ids of every text.

        A piece always begins at a space that is followed by anything but white space. So most texts
        are cut there at once, and their distinct words are encoded.
        """
        # What stands before the first space, or else the whole text, is cut by the pattern.
        begun, rest = [], []
        for text in texts:
            plain = not SPACES.search(text) and not any(token in text for token in self.added)
            if plain and (text.isascii() or self._all_assigned(text)):
                begin, space, others = text.partition(" ")
                begun.append(self.PIECES.findall(begin))
                rest.append(others if space else None)
            else:
                begun.append(self._singly(text))
                rest.append(None)
        words = pc.split_pattern(pa.array(rest, pa.large_string()), " ")
        counts = pc.fill_null(pc.list_value_length(words), 0).to_pylist()
        coded = words.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        pieces = list(set().union(*begun))
        ids_of = self._encode_pieces([p for p in pieces if isinstance(p, str)])
        ids_of |= {p: np.array([p], "<i4").tobytes() for p in pieces if isinstance(p, int)}
        table = [*self._spaced(listed(coded.dictionary)), *map(ids_of.__getitem__, pieces)]
        # The rows of the table that make each text.
        row = dict(zip(pieces, range(len(coded.dictionary), len(table))))
        order, at = [np.zeros(0, np.int64)], 0
        for parts, n in zip(begun, counts):
            order += [np.array([row[p] for p in parts], np.int64), index[at : at + n]]
            at += n
        order = np.concatenate(order)
        bounds = np.cumsum([0, *(len(parts) + n for parts, n in zip(begun, counts))])
        length = np.fromiter(map(len, table), np.int64, len(table)) // 4
        start = np.cumsum(length) - length
        ends = np.concatenate([[0], np.cumsum(length[order])])
        flat = np.frombuffer(b"".join(table), "<i4")
        gather = np.repeat(start[order] - ends[:-1], length[order]) + np.arange(ends[-1])
        return pa.LargeListArray.from_arrays(pa.array(ends[bounds], pa.int64()), pa.array(flat[gather], pa.int32()))

    def decode(self, ids: pa.LargeListArray) -> pa.LargeStringArray:
        """Texts of ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        values = ids.flatten()
        if pc.any(pc.or_(pc.less(values, 0), pc.greater_equal(values, self.size))).as_py():
            raise ValueError(f"an id lies outside the vocabulary of {self.size}")
        parts = self.tokens.take(values.fill_null(0) if values.null_count else values)
        lengths = pc.fill_null(pc.list_value_length(ids), 0)
        ends = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])
        at = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy())])
        data = b"".join(parts.to_pylist()) if parts.offset else parts.buffers()[2]
        offsets = pa.py_buffer(at[ends].astype(np.int64).tobytes())
        joined = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, offsets, data])
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.as_py().decode("utf-8", "replace") for x in joined], pa.large_string())


@functools.lru_cache(maxsize=2)
def codec_of(file: str, added: bool = True) -> Codec:
    """One for each worker process, so that its tasks share what it remembers."""
    return Codec(file, added)


def text_parts(batch: pa.RecordBatch, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, a long text being one of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        limit = (ends[start - 1] if start else 0) + size
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _run(rows: DataFrame, path: str, schema: str, work) -> DataFrame:
    """``work(codec, batch)`` on every batch; the tokenizer's file, of bounded size, is read by the driver."""
    spark = rows.sparkSession
    ship_package(spark)
    with open(path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for batch in batches:
            yield from work(codec, batch)
        codec.forget()
        give_back()

    return rows.mapInArrow(run, schema)


def _key_and(rows: DataFrame, key: str, column: str) -> tuple[DataFrame, str]:
    inner = rows.select(rows[key].alias("_key"), rows[column].alias("_value"))
    return inner, f"_key {inner.schema['_key'].dataType.simpleString()}"


def encode(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids``: the token ids of every whole text, as array<int>.

    A null or empty text has no ids (an empty array); a null key stays null; repeated rows give
    repeated rows; an empty table none. Strings of added tokens inside a text become those tokens.
    Other columns take no part.
    """
    inner, key_type = _key_and(documents, key, text)

    def work(codec: Codec, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batch, "_value"):
            ids = codec.encode([x or "" for x in part.column("_value").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("_key"), ids.cast(pa.list_(pa.int32()))], ["_key", "ids"]
            )

    return _run(inner, path, f"{key_type}, ids array<int>", work).withColumnRenamed("_key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text``: the text of every row of ids. Null or no ids give an empty text; an unknown id is an error."""
    inner, key_type = _key_and(encoded, key, ids)

    def work(codec: Codec, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = codec.decode(batch.column("_value").cast(pa.large_list(pa.int32())))
        yield pa.RecordBatch.from_arrays([batch.column("_key"), texts.cast(pa.string())], ["_key", "text"])

    return _run(inner, path, f"{key_type}, text string", work).withColumnRenamed("_key", key)


def round_trip(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, decoded``: encoding, and decoding of what it gave, in one pass. Rules as for ``encode``."""
    inner, key_type = _key_and(documents, key, text)

    def work(codec: Codec, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batch, "_value"):
            ids = codec.encode([x or "" for x in part.column("_value").to_pylist()])
            columns = [part.column("_key"), ids.cast(pa.list_(pa.int32())), codec.decode(ids).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["_key", "ids", "decoded"])

    return _run(inner, path, f"{key_type}, ids array<int>, decoded string", work).withColumnRenamed("_key", key)
