"""Words and word n-grams of whole Arrow columns, as numpy arrays.

The text bytes of many documents are handled at once.  A word gets a 64-bit value that
depends on its bytes alone, an n-gram one that depends on its words alone, so equal
sequences have equal values in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10  # texts are taken in slices of about this size, always whole
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
BLANKS = b" \t\n\x0b\x0c\r"


def byte_table(kept) -> np.ndarray:
    """A table over the 256 bytes: which of them belong to words."""
    return np.array([kept(byte) for byte in range(256)], dtype=bool)


# every byte but ASCII blanks, and every byte but ASCII ones that are no letter or digit
UNBLANK = byte_table(lambda byte: byte not in BLANKS)
ALNUM = byte_table(lambda byte: byte >= 0x80 or chr(byte).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class Words(NamedTuple):
    """Words of consecutive texts: text ``t`` has words ``first[t]`` to ``first[t + 1]``."""

    values: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; equal in, equal out."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    table = np.full(count + 1, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


_TABLES: dict = {}


def power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``count`` of each."""
    kept = _TABLES.get("powers")
    if kept is None or len(kept[0]) < count + 1:
        count = max(count, SLICE_BYTES + (1 << 16))
        kept = powers(BASE, count), powers(pow(BASE, -1, 1 << 64), count)
        if count <= 4 * SLICE_BYTES:
            _TABLES["powers"] = kept
    return kept


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    count = len(texts)
    if not count:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + count + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < count:
        until = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        until = min(count, max(row + 1, until))
        yield row, until, data[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row]
        row = until


def split_words(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, lower: bool = False
) -> Words:
    """The words of each text: maximal runs of the bytes that ``letters`` marks."""
    if lower:
        data = LOWER[data]
    inside = letters[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    if not len(start):
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty.astype(np.uint64), np.zeros(len(offsets), np.int64), empty, empty)
    up, down = power_tables(len(data))
    weighed = (data.astype(np.uint64) + np.uint64(1)) * inside
    weighed *= up[: len(data)]
    values = mix(np.add.reduceat(weighed, start) * down[start])
    return Words(values, np.searchsorted(start, offsets), start, np.flatnonzero(ends) + 1)


def joined(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """Values of sequences, from those of their first ``step`` words and of the rest."""
    out = np.zeros(len(left), dtype=np.uint64)
    if len(left) > step:
        out[:-step] = mix(left[:-step] * np.uint64(BASE) + right[step:])
    return out


def gram_values(values: np.ndarray, length: int) -> np.ndarray:
    """For each word the value of the ``length`` words from it on, by repeated doubling.

    Entries that would run over the end of their text mean nothing; see :func:`room`.
    """
    part, size, done, out = values, 1, 0, None
    while True:
        if length & size:
            out = part if out is None else joined(out, part, done)
            done += size
        if size * 2 > length:
            return out
        part = joined(part, part, size)
        size *= 2


def room(words: Words) -> np.ndarray:
    """For each word, how many words its text has from it on."""
    counts = np.diff(words.first)
    return np.repeat(words.first[1:], counts) - np.arange(len(words.values))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``values[i : i + width]``; beyond the end counts as the greatest value."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.concatenate([values, np.full(width, top)])
    size = 1
    while size * 2 <= width:
        padded = np.minimum(padded, np.concatenate([padded[size:], np.full(size, top)]))
        size *= 2
    if size < width:
        rest = width - size
        padded = np.minimum(padded, np.concatenate([padded[rest:], np.full(rest, top)]))
    return padded[: len(values)]


def covered(starts: np.ndarray, length, count: int) -> np.ndarray:
    """Which of ``count`` places lie in a span of ``length`` from one of the starts."""
    edge = np.zeros(count + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def text_of(words: Words) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
