"""Words of whole Arrow columns at once: their hashes, the rows they lie in, and windows of words.

A column of texts is one run of bytes with row offsets. Words are found and hashed by array
operations on blocks of these bytes, so no Python object is made per word. A null text counts as
empty. Blocks bound the memory; a text may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C17)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(n + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(int(_BASE)), of(pow(int(_BASE), -1, 1 << 64))


_POWERS = _powers(BLOCK + (1 << 16))


def separators(*spans: tuple[int, int]) -> np.ndarray:
    """For each byte, whether it belongs to a word: all but those in the given ranges."""
    word = np.ones(256, dtype=bool)
    for first, last in spans:
        word[first : last + 1] = False
    return word


SPACED = separators((0x20, 0x20), (0x09, 0x0D))
#: Runs of ASCII letters and digits and of all that is beyond ASCII.
ALPHANUMERIC = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one offset more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count or column.type != pa.string():
        column = column.cast(pa.string()).fill_null("")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(column: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each; a longer text is alone in its range."""
    _, at = column_bytes(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


@dataclass
class Words:
    """One entry per word, in order: hash, row, and the words of each row."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray
    affixes: list[np.ndarray]

    @property
    def first(self) -> np.ndarray:
        """Where each row's words begin."""
        return np.cumsum(self.counts) - self.counts


def find_words(
    column: pa.Array,
    is_word: np.ndarray = SPACED,
    fold: np.ndarray | None = None,
    affixes: tuple[int, ...] = (),
) -> Words:
    """All words of all rows. ``fold`` maps bytes before hashing (lower case, say).

    For each of ``affixes`` the words' first n bytes (n > 0) or last -n bytes are hashed too.
    """
    raw, at = column_bytes(column)
    hashes, starts, ends = [], [], []
    parts: list[list[np.ndarray]] = [[] for _ in affixes]
    begin, n = 0, len(raw)
    while begin < n:
        end = _block_end(raw, at, is_word, begin)
        block = raw[begin:end]
        word = is_word[block]
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        cuts = at[np.searchsorted(at, begin, side="left") : np.searchsorted(at, end, side="left")]
        cuts = cuts - begin
        opens[cuts] = word[cuts]
        closes = word.copy()
        closes[:-1] &= ~(word[1:] & ~opens[1:])
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        power, inverse = _POWERS if len(block) < len(_POWERS[0]) else _powers(len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        letters = _LETTER[block if fold is None else fold[block]]
        np.cumsum(letters * power[: len(block)], out=sums[1:])
        value = (sums[e] - sums[s]) * inverse[s]
        hashes.append(mix(value + (e - s).astype(np.uint64) * _STEP))
        for n_bytes, part in zip(affixes, parts, strict=True):
            i = s if n_bytes > 0 else np.maximum(s, e + n_bytes)
            j = np.minimum(e, s + n_bytes) if n_bytes > 0 else e
            value = (sums[j] - sums[i]) * inverse[i]
            part.append(mix(value + np.uint64((n_bytes * int(_BASE)) % (1 << 64))))
        starts.append(s + begin)
        ends.append(e + begin)
        begin = end
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    row = np.searchsorted(at, start, side="right") - 1
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        row,
        start,
        np.concatenate(ends) if ends else none,
        np.bincount(row, minlength=len(at) - 1).astype(np.int64),
        [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in parts],
    )


def _block_end(raw: np.ndarray, at: np.ndarray, is_word: np.ndarray, begin: int) -> int:
    """The end of a block of about BLOCK bytes that cuts no word."""
    end, n = begin + BLOCK, len(raw)
    while end < n:
        ahead = raw[end : end + 4096]
        row_start = int(at[np.searchsorted(at, end)])
        gap = np.flatnonzero(~is_word[ahead])
        stop = min(end + int(gap[0]) if len(gap) else n, row_start)
        if stop <= end + len(ahead):
            return stop
        end += len(ahead)
    return n


def windows(words: Words, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words of one row, and the word each window starts at.

    With ``short``, a row of fewer words, but not none, gives one window of all its words.
    """
    n = len(words.hash)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    left = (words.first + words.counts)[words.row] - np.arange(n)
    whole = left >= width
    if short:
        whole |= (words.counts[words.row] < width) & (left == words.counts[words.row])
    at = np.flatnonzero(whole)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total *= _BASE
        inside = left[at] > k
        if inside.all():
            total += words.hash[at + k]
        else:
            total[inside] += words.hash[at[inside] + k]
    return mix(total + np.uint64(width)), at
