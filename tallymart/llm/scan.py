"""Vectorised text scanning inside tasks: whole Arrow batches of texts become numpy arrays of words, lines and hashes.

A batch is cut into slices of a few documents, so that memory follows the slice (or the longest single text), not the batch.
Hashes are 64 bits wide and functions of content alone, so that every task on every machine computes the same ones.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


class Texts:
    """A slice of documents as one byte buffer: document i is buf[off[i]:off[i + 1]]."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off

    def __len__(self) -> int:
        return len(self.off) - 1


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) of consecutive slices of at most `limit` bytes or one document. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    flat = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    off = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1 + flat.offset)[flat.offset :]
    data = flat.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(flat):
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, last, Texts(buf[off[first] : off[last]], off[first : last + 1] - off[first])
        first = last


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; no run crosses a document's end."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    full = off[:-1] < off[1:]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[off[:-1][full]] = False
    after[off[1:][full] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for i, x in enumerate((BASE, INVERSE)):
            full = np.full(max(n, SLICE_BYTES + 4096), x, U)
            full[0] = 1
            _powers[i] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value * base ** place, from which the hash of any stretch follows."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def stretch(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Raw hashes of the stretches [start, end), equal for equal content wherever it stands."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def byte_sums(buf: np.ndarray) -> np.ndarray:
    return sums(buf.astype(U) + U(1))


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(stretch(prefix, start, end) ^ mix((end - start).astype(U)))


class Words:
    """Words of a slice: starts and ends in the buffer, and first[i]: the place of document i's first word."""

    def __init__(self, texts: Texts, space: np.ndarray = SPACE):
        self.start, self.end = runs(~space[texts.buf], texts.off)
        self.first = np.searchsorted(self.start, texts.off)
        self.texts = texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        buf = LOWER[self.texts.buf] if lower else self.texts.buf
        return spans_hash(byte_sums(buf), self.start, self.end)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on, as far as the slice goes."""
    if len(words) < n:
        return np.zeros(0, U)
    prefix = sums(words)
    at = np.arange(len(words) - n + 1)
    return mix(stretch(prefix, at, at + n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by block-wise running minima."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, place in the group) of sum(counts) items."""
    total = int(counts.sum())
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """True where any of the sorted keys differs from the row before."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def give_back() -> None:
    """Returns memory that is free to the system: a worker lives on, beside those of other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over batches that gives memory back when its task is done."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def join_ids(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def batch(names: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, names, strict=True)], schema=names)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
