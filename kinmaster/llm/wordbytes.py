"""Words of many texts at once, as arrays over their UTF-8 bytes.

Used inside tasks by the operators that look at every word of every text. Texts
are taken in chunks of a few MB, so that the arrays stay small however many rows
a task has; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK_BYTES = 1 << 21
# An odd multiplier for the polynomial over a word's bytes, and the
# constants of the splitmix64 finaliser.
BASE = np.uint64(0x9E3779B97F4A7C55)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def chunks(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, encoded texts) in runs of about ``limit`` bytes; null counts as empty."""
    first, size, part = 0, 0, []
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if part and size + len(data) > limit:
            yield first, part
            first, size, part = i, 0, []
        part.append(data)
        size += len(data)
    if part:
        yield first, part


def separator_table(separators: bytes, lower: bool = True) -> bytes:
    """Byte map for ``bytes.translate``: separators to a blank, A-Z to lower case."""
    table = bytearray(range(256))
    if lower:
        for upper in range(ord("A"), ord("Z") + 1):
            table[upper] = upper + 32
    for separator in separators:
        table[separator] = 32
    return bytes(table)


def word_hashes(parts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all parts in order, number of words of each part).

    A word's hash is a polynomial over its bytes, read off running sums, mixed
    with its length.
    """
    joined = b" " + b" ".join(parts) + b" "
    data = np.frombuffer(joined.translate(table), dtype=np.uint8)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[:-1] = data != 32
    step = np.diff(inside, prepend=np.int8(0))
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    hashes = np.empty(len(starts), dtype=np.uint64)
    # All words of one length together: as many passes as there are lengths below
    # the limit; the few longer ones one by one.
    lengths = ends - starts
    long = 48
    for n in np.unique(np.minimum(lengths, long)):
        if n == long:
            which = np.flatnonzero(lengths >= long)
            for i in which:
                hashes[i] = _long_word(data[starts[i]:ends[i]])
            continue
        which = np.flatnonzero(lengths == n)
        at = starts[which]
        value = np.full(len(which), n, dtype=np.uint64)
        for k in range(int(n)):
            value = value * BASE + data[at + k]
        hashes[which] = value
    limits = np.cumsum(np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts)))
    counts = np.diff(np.searchsorted(starts, limits + 1), prepend=0)
    return mix(hashes), counts


def _long_word(data: np.ndarray) -> np.uint64:
    """The same polynomial for one word of any length, 4,096 bytes at a time."""
    total = np.uint64(len(data))
    with np.errstate(over="ignore"):
        for i in range(0, len(data), 4096):
            block = data[i:i + 4096].astype(np.uint64)
            powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(block), BASE, dtype=np.uint64))), dtype=np.uint64)
            total = total * powers[-1] + np.sum(block * powers[-2::-1], dtype=np.uint64)
    return total
