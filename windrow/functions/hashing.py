"""Repeatable numbers from keys, the same on every engine that has md5."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

UINT32_SPAN = 4294967296.0
#: Bytes of a message that one block of MD5 holds, and messages that are digested together: their words stay in cache.
BLOCK_ROOM, TOGETHER = 55, 1 << 13
#: MD5's constants, its shifts by round, and its first state (RFC 1321).
_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_FIRST = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _unit(hex8: Column) -> Column:
    return F.conv(hex8, 16, 10).cast("double") / F.lit(UINT32_SPAN)


def hash_unit(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) that depends on the seed and the keys alone."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    return _unit(F.substring(F.md5(text.cast("binary")), 1, 8))


def hash_vector(token: Column | str, width: int, seed: int = 12345) -> Column:
    """A vector of ``width`` numbers in [0, 1) that depends on the seed and the token alone.

    One digest gives four elements: element j is slice j % 4 of the digest of "seed:token:(j div 4)".
    """
    if width < 1:
        raise ValueError("vector width must be positive")
    prefix = F.concat(F.lit(f"{seed}:"), _col(token).cast("string"), F.lit(":"))
    digests = F.transform(
        F.sequence(F.lit(0), F.lit((width - 1) // 4)),
        lambda q: F.md5(F.concat(prefix, q.cast("string")).cast("binary")),
    )
    quads = F.transform(
        digests,
        lambda h: F.array(*[_unit(F.substring(h, p, 8)) for p in (1, 9, 17, 25)]),
    )
    return F.slice(F.flatten(quads), 1, width)


def hash_rows(tokens: pa.Array, width: int, seed: int = 12345) -> np.ndarray:
    """The vectors of ``hash_vector`` for an array of texts in a task, a row each; a null is an error.

    Each distinct text is digested once, many of them together.
    """
    if tokens.null_count:
        raise ValueError("a token is null")
    coded = pc.dictionary_encode(tokens)
    texts, n_digests = coded.dictionary.cast(pa.binary()), -(-width // 4)
    prefix = f"{seed}:".encode()
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    words = np.empty((len(texts), 4 * n_digests), np.uint32)
    short = lengths + len(prefix) + 1 + len(str(n_digests)) <= BLOCK_ROOM
    few = texts if short.all() else texts.filter(pa.array(short))
    for low in range(0, len(few), TOGETHER):
        part = few.slice(low, TOGETHER)
        block, ends = _blocks(part, prefix)
        every, found = np.arange(len(part)), np.empty((len(part), 4 * n_digests), np.uint32)
        block[every, ends] = ord(":")
        for q in range(n_digests):
            end = f"{q}".encode()
            for i, byte in enumerate(end):
                block[every, ends + 1 + i] = byte
            found[:, 4 * q : 4 * q + 4] = _digests(block, ends + 1 + len(end)).T
        words[np.flatnonzero(short)[low : low + TOGETHER]] = found
    for i in np.flatnonzero(~short).tolist():
        text = prefix + texts[i].as_py()
        digest = b"".join(hashlib.md5(text + f":{q}".encode()).digest() for q in range(n_digests))
        words[i] = np.frombuffer(digest, ">u4")
    rows = words[:, :width] / UINT32_SPAN
    return rows[coded.indices.to_numpy()]


def hash_split(prefixes: pa.Array, first: np.ndarray, n: np.ndarray, bounds: Sequence[float]) -> np.ndarray:
    """For each prefix and the ``n`` numbers from ``first`` on, how many bounds ``hash_unit`` of "prefix:number" reaches."""
    # A unit is a whole number over 2^32, so comparing whole numbers is exact.
    limits = [math.ceil(bound * UINT32_SPAN) for bound in bounds]
    found, at, low = np.empty(int(n.sum()), np.int8), 0, 0
    ends = np.cumsum(n)
    long = pc.binary_length(prefixes).to_numpy(zero_copy_only=False) + 20 > BLOCK_ROOM
    while low < len(prefixes):
        # Short prefixes together, a long one by itself; many numbers of one prefix some at a time.
        high = max(low + 1, int(np.searchsorted(ends, at + TOGETHER, "right")))
        if long[low:high].any():
            high = low + max(1, int(long[low:high].argmax()))
        some = n[low:high]
        numbers = np.repeat(first[low:high] - (np.cumsum(some) - some), some) + np.arange(some.sum())
        if long[low]:
            prefix = prefixes[low].as_py().encode()
            digest = b"".join([hashlib.md5(b"%b:%d" % (prefix, i)).digest()[:4] for i in numbers.tolist()])
            heads = np.frombuffer(digest, ">u4")
        else:
            block, lengths = _blocks(prefixes.slice(low, high - low).cast(pa.binary()), b"")
            of, heads = np.repeat(np.arange(high - low), some), np.empty(len(numbers), np.uint32)
            for i in range(0, len(numbers), TOGETHER):
                here = of[i : i + TOGETHER]
                own, end = block[here], lengths[here]
                own[np.arange(len(here)), end] = ord(":")
                heads[i : i + TOGETHER] = _digests(own, _put_numbers(own, end + 1, numbers[i : i + TOGETHER]))[0]
        found[at : at + len(numbers)] = sum((heads >= limit).astype(np.int8) for limit in limits) if limits else 0
        at, low = at + len(numbers), high
    return found


def _blocks(texts: pa.Array, prefix: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows of 64 bytes with a prefix and a text each, and where they end."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    n, starts = len(texts), np.cumsum(lengths) - lengths
    block = np.zeros((n, 64), np.uint8)
    block[:, : len(prefix)] = np.frombuffer(prefix, np.uint8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    begin = int(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]) if n else 0
    # Bytes lie one text behind the other: each moves by its row's place less its own.
    place = np.arange(int(lengths.sum())) + np.repeat(np.arange(n) * 64 + len(prefix) - starts, lengths)
    block.reshape(-1)[place] = data[begin : begin + int(lengths.sum())]
    return block, lengths + len(prefix)


def _put_numbers(block: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Write each row's number from its place on; where it ends."""
    digits = np.ones(len(numbers), np.int64)
    for power in range(1, 19):
        more = numbers >= 10**power
        if not more.any():
            break
        digits += more
    rest, end = numbers.copy(), at + digits
    for i in range(int(digits.max(initial=0))):
        own = np.flatnonzero(digits > i)
        rest[own], digit = np.divmod(rest[own], 10)
        block[own, end[own] - 1 - i] = digit + ord("0")
    return end


def _digests(block: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The MD5 digests of messages of at most ``BLOCK_ROOM`` bytes, as four rows of big-endian words.

    Rows of ``block`` have zeros behind a message, and are left as they are. All messages go through a
    round together: a third of what a call for each takes.
    """
    n = len(block)
    every = np.arange(n)
    block[every, ends] = 0x80
    words = block.view("<u4").T.copy()
    block[every, ends] = 0
    words[14] = ends * 8
    used = [i for i in range(16) if words[i].any()]
    a, b, c, d = (np.full(n, x, np.uint32) for x in _FIRST)
    f, g = np.empty((2, n), np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif turn == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += np.uint32(_ADDED[i])
        word = (i, 5 * i + 1, 3 * i + 5, 7 * i)[turn] % 16
        if word in used:
            f += words[word]
        shift = _SHIFTS[turn][i % 4]
        np.left_shift(f, np.uint32(shift), out=g)
        f >>= np.uint32(32 - shift)
        f |= g
        f += b
        # The old first word's memory takes the next round's numbers.
        a, d, c, b, f = d, c, b, f, a
    return np.array([x + np.uint32(first) for x, first in zip((a, b, c, d), _FIRST)]).byteswap()


def hash_vectors(token: Column | str, width: int, seed: int = 12345) -> Column:
    """``hash_vector`` made by Arrow functions in the task, null for a null; not for use within lambda functions."""

    def made(tokens: pa.Array) -> pa.Array:
        rows = hash_rows(tokens.fill_null(""), width, seed)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
        found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))
        return pc.if_else(tokens.is_valid(), found, pa.scalar(None, found.type)) if tokens.null_count else found

    return F.arrow_udf(made, "array<double>")(_col(token).cast("string"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
