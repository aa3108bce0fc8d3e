"""Vectorised word hashing for Arrow batches of texts.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which in UTF-8
is the same as a run of characters other than those. Texts are worked on in
blocks of bounded size, so that the memory of a task follows its longest text
and not its batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values over the whole range; a bijection."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """``base ** 0 .. base ** (count - 1)`` modulo 2^64."""
    steps = np.full(max(count, 1), base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)[:count]


@dataclass
class Block:
    """Words of consecutive texts: text ``t`` has words ``first[t]:first[t + 1]``."""

    rows: range
    hashes: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        """The position in ``rows`` of each word's text."""
        return np.repeat(np.arange(len(self.rows)), np.diff(self.first))


def _utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at_once: int = BLOCK_BYTES) -> np.ndarray:
    """64-bit hashes of the byte runs ``starts[i]:ends[i]`` of ``data``, some ``at_once`` bytes at a time."""
    lengths = ends - starts
    stops = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(stops, np.arange(at_once, stops[-1], at_once)))
    found = []
    for part in np.split(np.arange(len(starts)), cuts):
        if not len(part):
            continue
        size = lengths[part]
        first = np.cumsum(size) - size
        inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
        values = _BYTE_VALUE[data[np.repeat(starts[part], size) + inside]]
        values *= powers(int(_BASE), int(size.max()))[inside]
        found.append(mix(np.add.reduceat(values, first) + size.astype(np.uint64)))
    return np.concatenate(found)


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES, lower: bool = False) -> Iterator[Block]:
    """Word hashes of a text column, block by block; a text is never cut.

    With ``lower``, A-Z count as a-z.
    """
    data, offsets = _utf8(texts)
    at, count = 0, len(texts)
    while at < count:
        upto = int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1
        upto = min(max(upto, at + 1), count)
        low, high = int(offsets[at]), int(offsets[upto])
        bounds = offsets[at : upto + 1] - low
        part = _LOWER[data[low:high]] if lower else data[low:high]
        black = ~_IS_SPACE[part]
        # a word starts where black begins, or where a text does
        start = black.copy()
        start[1:] &= ~black[:-1]
        edges = bounds[:-1][bounds[:-1] < high - low]
        start[edges] = black[edges]
        starts = np.flatnonzero(start)
        stop = black.copy()
        stop[:-1] &= ~black[1:]
        last = bounds[1:][bounds[1:] > 0] - 1
        stop[last] = black[last]
        ends = np.flatnonzero(stop) + 1
        hashes = _hash_words(part, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield Block(range(at, upto), hashes, np.searchsorted(starts, bounds))
        at = upto


class Ranges:
    """Hashes of any run of words, from prefix sums."""

    def __init__(self, hashes: np.ndarray) -> None:
        count = len(hashes)
        self._sums = np.zeros(count + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(_STEP, count), out=self._sums[1:])
        self._undo = powers(_STEP_INVERSE, count + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._undo[start])


def shingle_hashes(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text position of every run of ``size`` words.

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    lengths = np.diff(block.first)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    owner = np.repeat(np.arange(len(lengths)), counts)
    start = block.first[:-1][owner] + np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    end = np.minimum(start + size, block.first[1:][owner])
    return Ranges(block.hashes).of(start, end), owner


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = pick(out[: len(out) - step], out[step:])
        reach += step
    return out


def ragged(values: np.ndarray, owners: np.ndarray, count: int) -> pa.ListArray:
    """A list column: the values of each owner, which ascend."""
    offsets = np.searchsorted(owners, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys, of rows sorted by the key.

    Runs are cut only between keys; a run that spans batches is put together.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[batch.num_rows - 1]
        lowest, highest = 0, batch.num_rows - 1  # first row of the last key
        while lowest < highest:
            middle = (lowest + highest) // 2
            if keys[middle] == last:
                highest = middle
            else:
                lowest = middle + 1
        if lowest:
            yield pa.Table.from_batches([*held, batch.slice(0, lowest)])
            held = [batch.slice(lowest)]
        elif held and held[-1].column(key)[-1] != last:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
