"""Which stretches of fixed length does a document with a smaller id hold too? Shared by the operators on repeated substrings.

Units are words or bytes, a window is `length` consecutive units of one document, and a seed is the gram of `gram` units with the least
hash in a window. As the seed follows from the window's content, equal windows have equal seeds at equal places. Consecutive windows
with the same seed occurrence form a region; its class is the hash of its whole content.

Regions are compared first: of equal ones, all but those of the smallest id are repeats. Where a seed has several classes, windows of
the first of each are compared singly. Per slice of documents, equal regions and equal windows are compared before anything is
shuffled, so that a frequent one leaves each slice once. Regions are range-partitioned, so a frequent seed is spread over tasks; what a
range's border cuts is settled window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.shared import KEY, PRINT, keyed, narrow, stored

U = np.uint64
LOW = U(0xFFFFFFFF)
BROADCAST_ROWS = 500_000


@dataclass
class Units:
    """Of a slice: every gram's and every window's hash by start, and where each document's units begin."""

    grams: np.ndarray
    windows: np.ndarray
    first: np.ndarray
    length: int
    gram: int


@dataclass
class Regions:
    doc: np.ndarray
    seed: np.ndarray
    kind: np.ndarray
    start: np.ndarray  # first window
    last: np.ndarray  # last window


#: From a slice of texts to its units.
Reader = Callable[[scan.Texts], Units]


def regions_of(units: Units) -> Regions:
    g = units.grams
    least = scan.sliding_min((g & ~LOW) | np.arange(len(g), dtype=U), units.length - units.gram + 1)
    sizes = np.diff(units.first)
    doc, place = scan.within(np.maximum(sizes - units.length + 1, 0))
    x = units.first[doc] + place
    if not len(x):
        none = np.zeros(0, np.int64)
        return Regions(none, none.view(U), none.view(U), none, none)
    seed = (least[x] & LOW).astype(np.int64)
    at = np.flatnonzero(scan.first_of_runs(seed))
    start, last, seed = x[at], x[np.append(at[1:], len(x)) - 1], seed[at]
    w = units.windows
    shape = (last - start).astype(U) + ((seed - start).astype(U) << U(32))
    return Regions(doc[at], g[seed], scan.mix(w[start] + scan.mix(w[last] ^ scan.mix(shape))), start, last)


ROWS = pa.schema([("seed", pa.int64()), ("kind", pa.int64()), (KEY, pa.int64()), (PRINT, pa.int64()), ("verdict", pa.int32())])
ROWS_SQL = f"seed long, kind long, {KEY} long, {PRINT} long, verdict int"
#: A row to be compared; a repeat; a region whose windows must be compared singly.
OPEN, REPEAT, SINGLE = 0, 1, 2
HELD = 200_000


def _least_in_slice(seed: np.ndarray, kind: np.ndarray, key: np.ndarray, prints: np.ndarray) -> list[np.ndarray]:
    """Distinct rows; of equal (seed, kind) those of the smallest id stay open, the others are repeats."""
    order = np.lexsort((prints, key, kind, seed))
    seed, kind, key, prints = seed[order], kind[order], key[order], prints[order]
    new = scan.first_of_runs(seed, kind, key, prints)
    seed, kind, key, prints = seed[new], kind[new], key[new], prints[new]
    head = scan.first_of_runs(seed, kind)
    smallest = key[np.flatnonzero(head)][np.cumsum(head) - 1] if len(key) else key
    return [scan.signed(seed), scan.signed(kind), key, prints, np.where(key > smallest, REPEAT, OPEN).astype(np.int32)]


def _regions(reader: Reader):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                r = regions_of(reader(texts))
                yield scan.batch(ROWS, *_least_in_slice(r.seed, r.kind, keys[i:j][r.doc], prints[i:j][r.doc]))

    return run


def _windows(reader: Reader):
    """Windows of the regions to compare singly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints, asked = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy(), b.column("kinds")
            for i, j, texts in scan.slices(b.column("text")):
                units = reader(texts)
                r = regions_of(units)
                at = np.flatnonzero(listed(asked.slice(i, j - i), r.doc, r.kind))
                of, place = scan.within(r.last[at] - r.start[at] + 1)
                x, doc = r.start[at][of] + place, r.doc[at][of]
                yield scan.batch(ROWS, *_least_in_slice(r.seed[at][of], units.windows[x], keys[i:j][doc], prints[i:j][doc]))

    return run


def listed(lists: pa.ListArray, doc: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is in the list of its document."""
    n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(lists)), n)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U)
    own = lambda d, v: scan.mix(v ^ scan.mix(d.astype(U) + U(1)))
    return np.isin(own(doc, values), own(of, flat))


def _out(verdict: int, rows: list[np.ndarray], pick: np.ndarray) -> pa.RecordBatch:
    return scan.batch(ROWS, *(c[pick] for c in rows), np.full(int(pick.sum()), verdict, np.int32))


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """(rows whose verdict stands, the others as columns)."""
    for b in batches:
        rows, settled = [b.column(k).to_numpy() for k in range(4)], b.column(4).to_numpy() != OPEN
        yield _out(REPEAT, rows, settled), [c[~settled] for c in rows]


def _smallest(rows: list[np.ndarray]) -> np.ndarray:
    """The smallest id of each row's run: its first, as rows are sorted."""
    head = scan.first_of_runs(rows[0], rows[1])
    return rows[2][np.flatnonzero(head)][np.cumsum(head) - 1]


def _judged(rows: list[np.ndarray], cut_before: bool, cut_after: bool) -> Iterator[pa.RecordBatch]:
    """Verdicts on sorted rows of whole seeds; but the first seed may have begun elsewhere, and the last may go on elsewhere."""
    seed, kind, key, _ = rows
    if not len(seed):
        return
    old = key > _smallest(rows)
    # Of the first run, smaller ids may be elsewhere.
    unsure = (seed == seed[0]) & (kind == kind[0]) if cut_before else np.zeros(len(seed), bool)
    yield _out(REPEAT, rows, old & ~unsure)
    # A seed whose runs have different smallest ids: their windows must be compared singly.
    head = scan.first_of_runs(seed)
    of, at = np.cumsum(head) - 1, np.flatnonzero(head)
    low = np.minimum.reduceat(key, at)
    high = np.maximum.reduceat(np.where(old, np.iinfo(np.int64).min, key), at)
    several = low < high
    several[0] |= cut_before
    several[-1] |= cut_after
    yield _out(SINGLE, rows, (~old & several[of]) | unsure)


def _settle_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range of regions. A seed that fills more than HELD rows is judged in parts, like one that a range's border cuts."""
    held, cut = None, True
    for done, rows in _open_rows(batches):
        yield done
        held = rows if held is None else [np.concatenate([x, y]) for x, y in zip(held, rows, strict=True)]
        if not len(held[0]):
            continue
        last = int(np.searchsorted(held[0], held[0][-1]))  # where the last seed begins
        if last:
            yield from _judged([c[:last] for c in held], cut, False)
            held, cut = [c[last:] for c in held], False
        if len(held[0]) > HELD:
            yield from _judged(held, cut, True)
            held, cut = None, True
    if held is not None:
        yield from _judged(held, cut, True)


def _settle_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole runs of equal windows, sorted: all behind the smallest id are repeats."""
    before = None
    for done, rows in _open_rows(batches):
        yield done
        if not len(rows[0]):
            continue
        low = _smallest(rows)
        if before is not None:
            low[(rows[0] == before[0]) & (rows[1] == before[1])] = before[2]
        yield _out(REPEAT, rows, rows[2] > low)
        before = (rows[0][-1], rows[1][-1], low[-1])


@dataclass
class Found:
    """kinds: classes of repeated regions, windows: hashes of repeated windows; each (row key, value) once."""

    kinds: DataFrame
    windows: DataFrame


def repeated_in_smaller(docs: DataFrame, reader: Reader, name: str) -> Found:
    """Regions and windows of each row that a row with a smaller id holds too. docs: row key and text."""
    # Stored first: the splitters of the ranges come from a look at these rows, and the texts are read once for both.
    rows = stored(docs.mapInArrow(_regions(reader), ROWS_SQL), f"{name}-seeds")
    ranged = rows.repartitionByRange("seed", "kind", KEY, PRINT).sortWithinPartitions("seed", "kind", KEY, PRINT)
    settled = stored(ranged.mapInArrow(_settle_regions, ROWS_SQL), f"{name}-regions")
    single = settled.where(F.col("verdict") == SINGLE).groupBy(KEY, PRINT).agg(F.collect_set("kind").alias("kinds"))
    single = stored(single, f"{name}-single")
    some = single.select(KEY, PRINT)
    texts = docs.join(narrow(some, BROADCAST_ROWS), [KEY, PRINT], "left_semi").join(single, [KEY, PRINT])
    windows = texts.mapInArrow(_windows(reader), ROWS_SQL)
    dealt = windows.repartition("seed", "kind").sortWithinPartitions("seed", "kind", KEY, PRINT)
    compared = stored(dealt.mapInArrow(_settle_windows, ROWS_SQL), f"{name}-windows")
    pick = lambda df: df.where(F.col("verdict") == REPEAT).select(KEY, PRINT, "kind")
    return Found(pick(settled), pick(compared))


def with_found(docs: DataFrame, found: Found, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a repeat, with their lists `kinds` and `windows`; all other rows). Only the former are shuffled."""
    lists = found.kinds.select(KEY, PRINT, "kind", F.lit(None).cast("long").alias("window")).unionByName(
        found.windows.select(KEY, PRINT, F.lit(None).cast("long").alias("kind"), F.col("kind").alias("window"))
    )
    lists = stored(lists.groupBy(KEY, PRINT).agg(F.collect_set("kind").alias("kinds"), F.collect_set("window").alias("windows")), f"{name}-lists")
    some = narrow(lists.select(KEY, PRINT), BROADCAST_ROWS)
    hit = docs.join(some, [KEY, PRINT], "left_semi").join(lists, [KEY, PRINT])
    return hit, docs.join(some, [KEY, PRINT], "left_anti")


def row_texts(docs: DataFrame) -> DataFrame:
    """keyed(docs) with prints of 16 bits, enough to tell rows of one id apart."""
    return keyed(docs).withColumn(PRINT, F.col(PRINT).bitwiseAND(F.lit(0xFFFF)))


def repeated_windows(units: Units, kinds: pa.ListArray, windows: pa.ListArray) -> tuple[Regions, np.ndarray]:
    """For each window start of a slice: whether the lists name it."""
    r = regions_of(units)
    out = np.zeros(len(units.windows) + 1, np.int64)
    at = listed(kinds, r.doc, r.kind)
    np.add.at(out, r.start[at], 1)
    np.add.at(out, r.last[at] + 1, -1)
    hit = np.cumsum(out)[:-1] > 0
    sizes = np.diff(units.first)
    doc, place = scan.within(np.maximum(sizes - units.length + 1, 0))
    some = windows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) > 0
    pick = some[doc] if len(doc) else np.zeros(0, bool)
    x = (units.first[doc] + place)[pick]
    hit[x[listed(windows, doc[pick], units.windows[x])]] = True
    return r, hit


def covered(hit: np.ndarray, length: int, total: int) -> np.ndarray:
    """Units inside any marked window."""
    out = np.zeros(total + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(out, at, 1)
    np.add.at(out, at + length, -1)
    return np.cumsum(out)[:total] > 0
