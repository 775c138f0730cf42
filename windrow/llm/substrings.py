"""Substring dedup on words: super-k-mer partitioning.

Neighbouring windows that share a minimiser travel as one packed string to its bucket (see
``repeats``). There words get numbers, windows get numbers made of those, and sorting windows by
number, document and place counts them exactly: the first of equal ones stays, the others go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from windrow.llm import chunks as C
from windrow.llm import repeats as R

WINDOW, GRAM = 20, 8


def _numbered(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each row of the columns, equal for equal rows only."""
    names, top = columns[0], int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        size = int(column.max(initial=0)) + 1
        if top * size >= 1 << 62:
            names = np.unique(names, return_inverse=True)[1]
            top = int(names.max(initial=0)) + 1
        names, top = names * size + column, top * size
    return names


def compare(window: int):
    """Bits for the windows of a bucket's pieces: an equal one has a smaller (document, place)."""

    def run(pieces: R.Piece) -> np.ndarray:
        words, index = [], {}
        ends = np.cumsum(pieces.n_bytes).tolist()
        for a, b in zip([0, *ends], ends):
            words.append([index.setdefault(w, len(index)) for w in pieces.data[a:b].split(b" ")])
        numbers = np.concatenate([np.zeros(0, np.int64), *(np.array(w, np.int64) for w in words)])
        length = pieces.n_windows.astype(np.int64) + window - 1
        begin = np.cumsum(length) - length
        at = R.ragged(begin, pieces.n_windows.astype(np.int64))
        names = _numbered([numbers[at + k] for k in range(window)])
        key = np.repeat(pieces.key, pieces.n_windows)
        start = R.ragged(pieces.start, pieces.n_windows.astype(np.int64))
        order = np.lexsort((start, key, names))
        new = np.ones(len(order), bool)
        new[1:] = np.diff(names[order]) != 0
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        earlier = np.zeros(len(order), bool)
        earlier[order] = (key[order] != key[first]) | (start[order] != start[first])
        return earlier

    return run


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    chunk_bytes: int = C.CHUNK_BYTES,
) -> DataFrame:
    """``key, n_words, n_removed, kept``: each text without words of windows that start earlier.

    A window is ``window`` neighbouring words of one document; earlier is a smaller key (a null key
    comes first), or an earlier start in the same document. Windows are judged on the input.
    ``kept`` has the words that stay, joined by single spaces; a null or empty text, or one without
    a word, gives an empty one. Rows that repeat a key are one document twice: what starts at the
    same place of both is not earlier in either. Keys are whole numbers, or texts of such. An empty table
    gives no rows. Columns besides key and text take no part.
    """

    def result(sequence: R.Sequence, rows: pa.Table, removed: np.ndarray) -> Iterator[pa.RecordBatch]:
        gone = np.concatenate([[0], np.cumsum(removed)])
        n_removed = gone[sequence.ends] - gone[sequence.begins]
        kept = []
        for a, b, n in zip(sequence.begins.tolist(), sequence.ends.tolist(), n_removed.tolist()):
            words = sequence.words[a:b]
            if n:
                words = [w for w, out in zip(words, removed[a:b].tolist()) if not out]
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_pydict(
            {
                "_key": rows.column("_key").combine_chunks(),
                "n_words": pa.array(sequence.length, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    kind = R.Kind(True, window, gram, True)
    schema = "_key bigint, n_words bigint, n_removed bigint, kept string"
    inner = documents.select(documents[key].alias("_k"), documents[text].alias("_t"))
    found = R.remove(inner, kind, compare(window), schema, result, "_k", "_t", (), chunk_bytes)
    return found.withColumnRenamed("_key", key)
