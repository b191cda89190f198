"""Words and shingles of whole Arrow text columns, found with array operations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21

#: Bytes that end a word: ASCII white space.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

#: Bytes that end a word where punctuation does so as well; bytes of non-ASCII characters belong to words.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[128:] = PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = False

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[32] = 0
_PLACE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


@dataclass
class Block:
    """Texts, or a part of one long text: which rows, where each ends, and whether they are whole."""

    rows: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    whole: bool


def blocks(
    offsets: np.ndarray, data: np.ndarray, breaks: np.ndarray, overlap: int, limit: int = BLOCK_BYTES
) -> Iterator[Block]:
    """Cut texts into blocks of bounded size.

    A text longer than ``limit`` is cut between words; each later part repeats the ``overlap``
    words before it, so every run of overlap + 1 words lies in exactly one part.
    """
    row, count = 0, len(offsets) - 1
    while row < count:
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        if last > row:
            yield Block(np.arange(row, last), offsets[row : last + 1] - offsets[row], data[offsets[row] : offsets[last]], True)
            row = last
            continue
        text = data[offsets[row] : offsets[row + 1]]
        start, size = 0, limit
        while True:
            end = min(start + size, len(text))
            while end < len(text) and not breaks[text[end]]:
                end += 1
            part = text[start:end]
            bounds = np.array([0, len(part)])
            if end < len(text):
                opens = spans(bounds, part, breaks)[0]
                if len(opens) <= overlap:
                    size *= 2
                    continue
            yield Block(np.array([row]), bounds, part, start == 0 and end == len(text))
            if end == len(text):
                break
            start, size = start + int(opens[-overlap]) if overlap else end, limit
        row += 1


def spans(bounds: np.ndarray, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word; words end at a text's end as well."""
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    return np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))


@dataclass
class Words:
    """Words of a block, joined by single spaces in ``data``; ``first`` has each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word (equal words, equal hashes)."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = np.diff(np.append(self.starts, len(self.data)))
        place = (np.arange(len(self.data)) - np.repeat(self.starts, lengths)) & 255
        return mixed(np.add.reduceat(_BYTE[self.data] * _PLACE[place], self.starts))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word of each run of ``size`` words inside one text, and the text's index."""
        counts = np.maximum(np.diff(self.first) - (size - 1), 0)
        text = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.first[:-1][text] + within, text


def words(block: Block, breaks: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """The words of a block; ``fold`` maps bytes first (lower case)."""
    starts, ends = spans(block.bounds, block.data, breaks)
    first = np.searchsorted(starts, block.bounds)
    lengths = ends - starts
    new = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    data = np.full(int(lengths.sum()) + len(starts), 32, dtype=np.uint8)
    kept = block.data if fold is None else fold[block.data]
    inside = ~breaks[block.data]
    place = np.ones(len(data), dtype=bool)
    place[new + lengths] = False
    data[place] = kept[inside]
    return Words(data, new, new + lengths, first)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def combined(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words from their hashes."""
    total = np.zeros(len(starts), dtype=np.uint64)
    for place in range(size):
        total += hashes[starts + place] * _PLACE[place & 255]
        total = (total << np.uint64(7)) | (total >> np.uint64(57))
    return mixed(total)
