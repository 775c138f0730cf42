"""Suffix-array dedup on bytes: longest-previous-factor arrays.

Strings that may occur again meet in buckets (see ``repeats``). A bucket sorts the suffixes that
start at its windows, as far as a window reaches. In that order, the nearest entries of a smaller
document before and after an entry are its earlier matches: the longer of the two common prefixes
is the longest previous factor. Where it reaches a whole window, the later copy goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm import chunks as C
from windrow.llm import repeats as R

WINDOW, GRAM = 50, 24
#: Bytes by which suffixes are told apart in one round of sorting.
STEP = 5
PLACE_BITS = 23


def suffix_order(data: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``at`` sorted by their first ``depth`` bytes, and each one's rank by them.

    Each round sorts by the next bytes those that are not yet told apart.
    """
    rank = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    for done in range(0, depth, STEP):
        base, text = rank[open_], np.zeros(len(open_), np.int64)
        for k in range(done, min(done + STEP, depth)):
            text = text << 8 | data[at[open_] + k]
        small = len(at) < 1 << PLACE_BITS  # rank and bytes fit into one number, bytes and place, too
        if small and not done:
            order = np.sort(text << PLACE_BITS | open_) & (1 << PLACE_BITS) - 1
        else:
            order = np.argsort(base << 40 | text) if small else np.lexsort((text, base))
        base, text = base[order], text[order]
        # A rank is the number of suffixes before: those of smaller groups, and of smaller bytes in the own one.
        group = np.concatenate([[True], base[1:] != base[:-1]])
        new = group | np.concatenate([[True], text[1:] != text[:-1]])
        place = np.arange(len(order))
        rank[open_[order]] = base + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(
            np.where(group, place, 0)
        )
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        open_ = open_[order[np.repeat(size > 1, size)]]
        if not len(open_):
            break
    n = len(at)
    if n < 1 << 31:
        return np.sort(rank << 31 | np.arange(n)) & (1 << 31) - 1, rank
    return np.argsort(rank, kind="stable"), rank


def nearest_smaller(position: np.ndarray) -> np.ndarray:
    """For each entry the place of the nearest one before it with a smaller position, or -1.

    All entries follow their pointers at once; a pointer that leads to no smaller one moves on.
    """
    n = len(position)
    found = np.arange(-1, n - 1)
    open_ = np.arange(n)
    while len(open_):
        to = found[open_]
        open_ = open_[(to >= 0) & (position[np.maximum(to, 0)] >= position[open_])]
        found[open_] = found[found[open_]]
    return found


def longest_previous(data: np.ndarray, at: np.ndarray, document: np.ndarray, depth: int, least: int = 0) -> np.ndarray:
    """Length, up to ``depth``, of the longest match of each suffix in a smaller document; 0 if it is below ``least``."""
    order, rank = suffix_order(data, at, depth)
    place, position, rank = at[order], document[order], rank[order]
    longest = np.zeros(len(at), np.int64)
    n = len(order)
    for previous in (nearest_smaller(position), n - 1 - nearest_smaller(position[::-1])[::-1]):
        has = np.flatnonzero((previous >= 0) & (previous < n))
        # Suffixes of one rank are equal as far as they were sorted; only others are compared.
        equal = rank[has] == rank[previous[has]]
        length = np.where(equal, depth, 0)
        # Those of different ranks differ within the depth.
        on = np.flatnonzero(~equal & (least < depth))
        for k in range(depth):
            on = on[data[place[has[on]] + k] == data[place[previous[has[on]]] + k]]
            length[on] = k + 1
            if not len(on):
                break
        longest[order[has]] = np.maximum(longest[order[has]], length)
    return np.where(longest >= least, longest, 0)


def compare(window: int):
    """Bits for the windows of a bucket's pieces: a smaller document has the same bytes."""

    def run(pieces: R.Piece) -> np.ndarray:
        n_windows, size = pieces.n_windows.astype(np.int64), pieces.n_bytes.astype(np.int64)
        ends = np.cumsum(size)
        begin = ends - size
        # Equal pieces are compared as one, of the smallest document.
        index: dict[bytes, int] = {}
        view = memoryview(pieces.data)
        same = np.array(
            [index.setdefault(bytes(view[a:b]), len(index)) for a, b in zip(begin.tolist(), ends.tolist())], np.int64
        )
        n_distinct = len(index)
        del index
        document = np.full(n_distinct, np.iinfo(np.int64).max)
        np.minimum.at(document, same, pieces.key)
        one = np.zeros(n_distinct, np.int64)
        one[same] = np.arange(len(same))
        data = np.frombuffer(pieces.data, np.uint8)
        at = R.ragged(begin[one], n_windows[one])
        hit = longest_previous(data, at, np.repeat(document, n_windows[one]), window, window) >= window
        # Every piece has the bits of its content, and all of them if it is a later copy.
        first = np.cumsum(n_windows[one]) - n_windows[one]
        earlier = hit[R.ragged(first[same], n_windows)]
        return earlier | np.repeat(pieces.key != document[same], n_windows)

    return run


def _whole_characters(data: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """Bits of bytes, spread to all bytes of a UTF-8 character."""
    if not len(data):
        return removed
    begin = np.flatnonzero((data & 0xC0) != 0x80)
    return np.repeat(np.logical_or.reduceat(removed, begin), np.diff(np.append(begin, len(data))))


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    carry: tuple[str, ...] = (),
    chunk_bytes: int = C.CHUNK_BYTES,
    whole_characters: bool = False,
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept`` and the columns to carry: texts without later copies.

    A byte goes if a string of ``window`` bytes that covers it also starts in a document with a
    smaller key (a null key comes first). Strings never cross documents and are judged on the input.
    ``kept`` is binary, as a cut can part a character; with ``whole_characters`` all bytes of such a
    character go, so that ``kept`` is UTF-8 again. ``n_spans`` counts the runs removed. A null
    or empty text gives no bytes. Rows that repeat a key are one document and no copies of each
    other. Keys are whole numbers, or texts of such. An empty table gives no rows. Columns besides key,
    text and carried ones take no part.
    """

    def result(sequence: R.Sequence, rows: pa.Table, removed: np.ndarray) -> Iterator[pa.RecordBatch]:
        if whole_characters:
            removed = _whole_characters(sequence.bytes, removed)
        gone = np.concatenate([[0], np.cumsum(removed)])
        head = removed.copy()
        head[1:] &= ~removed[:-1]
        some = sequence.begins[sequence.length > 0]
        head[some] = removed[some]
        heads = np.concatenate([[0], np.cumsum(head)])
        left = np.concatenate([[0], np.cumsum(~removed)])
        # All that is kept is one buffer, cut at the documents' ends.
        offsets = np.concatenate([[0], left[sequence.ends]]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(sequence.bytes[~removed].tobytes())]
        kept = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)
        columns = {
            "_key": rows.column("_key").combine_chunks(),
            "n_bytes": pa.array(sequence.length, pa.int64()),
            "n_removed": pa.array(gone[sequence.ends] - gone[sequence.begins], pa.int64()),
            "n_spans": pa.array(heads[sequence.ends] - heads[sequence.begins], pa.int64()),
            "kept": kept.cast(pa.binary()),
            "_carried": rows.column("_c").combine_chunks(),
        }
        yield pa.RecordBatch.from_pydict(columns)

    kind = R.Kind(False, window, gram, False)
    # Carried columns travel in a struct, so that no name of theirs can clash.
    inner = documents.select(
        documents[key].alias("_k"),
        documents[text].alias("_t"),
        F.struct(F.lit(True).alias("_"), *[documents[c].alias(f"c{i}") for i, c in enumerate(carry)]).alias("_c"),
    )
    carried = inner.schema["_c"].dataType.simpleString()
    schema = f"_key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, _carried {carried}"
    found = R.remove(inner, kind, compare(window), schema, result, "_k", "_t", ("_c",), chunk_bytes)
    return found.select(
        F.col("_key").alias(key),
        *("n_bytes", "n_removed", "n_spans", "kept"),
        *[F.col(f"_carried.c{i}").alias(c) for i, c in enumerate(carry)],
    )
