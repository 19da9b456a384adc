"""N-gram Jaccard join by signature trees.

A document's set is its distinct word shingles, as 64-bit hashes. Two documents link when 100 * intersection >= percent * union.
1. One pass makes each row's set size, set hash and signature (a bitmap with a bit per hash, two to four times as wide as the set is large), and
   counts the shingles of all its rows in a sketch: SLOTS counters, of which a shingle has one. The sketches of all tasks are summed.
   Rows with equal sets are one class; from here on one row stands for each class, however often it is repeated.
2. Shingles are ordered by rarity, as the sketch has it. The order need not be true, but is the same for all tasks. Linked sets share a
   shingle among the first |set| - ceil(0.8 |set|) + 1 of each in any order, so every class is dealt to the buckets of these prefix
   shingles. Rows without another of fitting size in a bucket leave it; rare shingles are mostly held by one class alone.
   Buckets with the same leader (their smallest set) become one group, in which a class has one row, and one bitmap, whatever it shares.
3. Groups are joined with signature trees: nodes hold the OR of the bitmaps below and the range of set sizes. A dual traversal from the
   root drops pairs of nodes (later of rows) whose sizes, places of the shared shingles, or bitmaps allow no sufficient overlap. Large
   groups are dealt in blocks of like sizes, and only blocks whose sizes allow a link meet.
4. Candidates are verified with the whole texts. All links are listed; their number grows with the square of a group's size.

Where components alone are wanted (every_link=False), two things are spared:
- Before the trees, classes near one another by size in a group are candidates; those that are verified give provisional components. Near
  copies mostly become one component here, with a number of pairs linear in theirs. Only groups that still hold several components go
  to the trees, and rows of one component are not compared there.
- Candidates are verified a few for each pair of components at a time, as one link joins them.
Every link between different components has been verified or ruled out by a bound, so components are exact in both modes.

Defined cases: a text without words has an empty set and links with nothing; rows that share an id link like others; repeated rows
get equal results; a null id is smaller than all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.components import components
from tallymart.llm.shared import KEY, NO_ID, PRINT, id_back, keyed, narrow, row_key, stored, table

U = np.uint64
BROADCAST_ROWS = 500_000
#: Counters of the sketch (8 MiB in a task, 4 MiB as broadcast), and those of a part that is summed by itself.
SLOT_BITS, PART_BITS = 22, 16
#: Rows of a leaf, and rows of a block of a group that is dealt over several tasks.
LEAF, BLOCK = 32, 20_000
#: Provisional components come from rows of a group so many STEPS apart, in ROUNDS orders. They only save comparisons: what they do not
#: join is left to the trees.
STEPS, ROUNDS = (1, 2, 3, 5, 8, 13, 21), 1


@dataclass
class Sets:
    """Distinct shingles of a slice, by document and hash; first[i]: where document i's begin."""

    hashes: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def sets_of(texts: scan.Texts, shingle: int) -> Sets:
    words = scan.Words(texts)
    hashes, counts = words.hashes(lower=True), words.counts()
    doc, place = scan.within(np.maximum(counts - shingle + 1, 0))
    whole = scan.grams(hashes, shingle)[words.first[doc] + place]
    few = np.flatnonzero((counts > 0) & (counts < shingle))
    short = scan.spans_hash(scan.sums(hashes), words.first[few], words.first[few + 1])
    doc, h = np.concatenate([doc, few]), np.concatenate([whole, short])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = scan.first_of_runs(doc, h)
    doc, h = doc[new], h[new]
    return Sets(h, doc, np.searchsorted(doc, np.arange(len(texts) + 1)))


def _width(size: np.ndarray) -> np.ndarray:
    """Bits of a signature: a power of two not below twice the set's size, 64 to 16384."""
    return (1 << np.clip(np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64), 6, 14)).astype(np.int64)


PROFILE = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), ("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("bits", pa.binary())])
PROFILE_SQL = f"{KEY} long, {PRINT} long, n long, c1 long, c2 long, bits binary"
#: Stands for n in rows that are parts of a task's sketch: c1 is the part, bits its counters.
SKETCH = -1


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(64 - SLOT_BITS)).astype(np.int64)


def _profiles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SLOT_BITS, np.uint16)
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                s = sets_of(texts, shingle)
                n = s.sizes()
                c = []
                for salt in (1, 2):
                    total = np.concatenate([np.zeros(1, U), np.cumsum(scan.mix(s.hashes + U(salt)))])
                    c.append(scan.signed(scan.mix(total[s.first[1:]] - total[s.first[:-1]])))
                width = _width(n)
                at = np.concatenate([[0], np.cumsum(width // 8)])
                flat = np.zeros(at[-1] * 8, np.uint8)
                flat[at[s.doc] * 8 + (s.hashes & (width[s.doc] - 1).astype(U)).astype(np.int64)] = 1
                bits = np.packbits(flat)
                cells = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(bits)])
                np.add.at(sketch, slots(s.hashes), 1)
                np.minimum(sketch, 60_000, out=sketch)
                yield scan.batch(PROFILE, keys[i:j], prints[i:j], n.astype(np.int64), *c, cells)
        parts = sketch.reshape(-1, 1 << min(PART_BITS, SLOT_BITS))
        used = np.flatnonzero(parts.any(axis=1))
        zero = np.zeros(len(used), np.int64)
        packed = pa.array([pa.compress(parts[k].tobytes(), "zstd", asbytes=True) for k in used], pa.binary())
        yield scan.batch(PROFILE, zero, zero, zero + SKETCH, used, zero, packed)

    return run


LEVELS = pa.schema([("part", pa.int64()), ("levels", pa.binary())])


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of sketches, sorted by part: the sums of each part's counters, as their place among one another, 0 to 255.

    Parts are ranges of a hash, so counters are spread alike over all parts."""
    size = 1 << min(PART_BITS, SLOT_BITS)
    held, total = None, None

    def done() -> pa.RecordBatch:
        used = total[total > 0]
        cuts = np.unique(np.quantile(used, np.arange(1, 256) / 256, method="higher")) if len(used) else used
        levels = np.searchsorted(cuts, total).astype(np.uint8)
        return scan.batch(LEVELS, np.array([held]), pa.array([levels.tobytes()], pa.binary()))

    for b in batches:
        for part, cells in zip(b.column("part").to_pylist(), b.column("bits"), strict=True):
            if part != held:
                if held is not None:
                    yield done()
                held, total = part, np.zeros(size, np.int64)
            total += np.frombuffer(pa.decompress(cells.as_py(), 2 * size, "zstd"), np.uint16)
    if held is not None:
        yield done()


def rarity(sketches: DataFrame) -> np.ndarray:
    """A level for each slot, rare ones lowest: a table of fixed size, whatever the input."""
    rows = sketches.select(F.col("c1").alias("part"), "bits").repartition("part").sortWithinPartitions("part").mapInArrow(_levels, "part long, levels binary")
    out = np.zeros((1 << max(0, SLOT_BITS - PART_BITS), 1 << min(PART_BITS, SLOT_BITS)), np.uint8)
    for r in rows.collect():
        out[r.part] = np.frombuffer(r.levels, np.uint8)
    return out.ravel()


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of linked sets of these sizes: o >= p (a + b) / (100 + p)."""
    return -(-percent * (a + b) // (100 + percent))


POSTING = pa.schema([("token", pa.int64()), ("cid", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def _prefixes(shingle: int, percent: int, levels):
    """Prefix shingles of each class: the rarest, by level and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for b in batches:
            ids = b.column("cid").to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                s = sets_of(texts, shingle)
                order = np.lexsort((s.hashes, level[slots(s.hashes)], s.doc))
                n = s.sizes()
                keep = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                doc, pos = scan.within(keep)
                yield scan.batch(POSTING, scan.signed(s.hashes[order[s.first[doc] + pos]]), ids[i:j][doc], n[doc], pos)

    return run


GROUPED = pa.schema([("leader", pa.int64()), ("cid", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def _led(percent: int):
    """Rows sorted by (token, n): those with another row of their token whose size allows a link, and the leader, their token's first row.

    Holds the last row of a batch for the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (token, cid, n, pos, whether a row before fits) and the leader of its token
        for b in batches:
            if not b.num_rows:
                continue
            token, cid, n, pos = (b.column(k).to_numpy() for k in range(4))
            fits_first, lead = False, None
            if held is not None:
                token, cid, n, pos = (np.append(np.array([h], c.dtype), c) for h, c in zip(held[:4], (token, cid, n, pos), strict=True))
                fits_first, lead = held[4], held[5]
            fits = (token[1:] == token[:-1]) & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64))
            before, after = np.append(fits_first, fits), np.append(fits, False)
            head = scan.first_of_runs(token)
            leader = cid[np.flatnonzero(head)][np.cumsum(head) - 1]
            if lead is not None:
                leader[token == token[0]] = lead
            pick = (before | after)[:-1]
            yield scan.batch(GROUPED, *(c[:-1][pick] for c in (leader, cid, n, pos)))
            held = (token[-1], cid[-1], n[-1], pos[-1], bool(before[-1]), leader[-1])
        if held is not None and held[4]:
            yield scan.batch(GROUPED, *[np.array([held[k]]) for k in (5, 1, 2, 3)])

    return run


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _may_link(n1, n2, p1, p2, percent: int) -> np.ndarray:
    """Bounds on size and on what can follow the shared shingle, if it is the first that both share."""
    low, high = np.minimum(n1, n2), np.maximum(n1, n2)
    return (100 * low >= percent * high) & (np.minimum(n1 - p1, n2 - p2) >= _needed(n1, n2, percent))


def _neighbours(percent: int):
    """Candidates of different components: rows a few STEPS apart in a group sorted by (leader, size).

    Of the pairs of two components, each batch gives the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, np.int64) for _ in range(5))
        for b in batches:
            old = len(held[0])
            rows = tuple(np.append(h, b.column(k).to_numpy().astype(np.int64)) for k, h in enumerate(held))
            leader, cid, n, _, comp = rows
            pairs = [np.zeros((0, 4), np.int64)]
            for step in STEPS:
                late = np.arange(max(old, step), len(leader))
                early = late - step
                ok = (leader[late] == leader[early]) & (comp[late] != comp[early]) & (100 * np.minimum(n[late], n[early]) >= percent * np.maximum(n[late], n[early]))
                late, early = late[ok], early[ok]
                ends = np.sort(np.column_stack([comp[early], comp[late]]), axis=1)
                pairs.append(np.column_stack([ends, np.sort(np.column_stack([cid[early], cid[late]]), axis=1)]))
            found = np.concatenate(pairs)
            found = found[np.unique(found[:, :2], axis=0, return_index=True)[1]]
            yield scan.batch(PAIR, found[:, 2].copy(), found[:, 3].copy())
            held = tuple(c[-max(STEPS) :] for c in rows)

    return run


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of bytes) to `width` bytes: what lies behind is put onto the front."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _count(bits: np.ndarray) -> np.ndarray:
    return ONES[bits].sum(1, dtype=np.int64)


class Node:
    """Rows [start, end) of a group: the OR of their bitmaps, their sizes' range, and the fewest bits one of them has."""

    def __init__(self, start: int, end: int, width: int, either: np.ndarray, low: int, high: int, fewest: int, parts: list[Node]):
        self.start, self.end, self.width, self.either = start, end, width, either
        self.low, self.high, self.fewest, self.parts = low, high, fewest, parts


class Group:
    """Rows of one group, sorted by size, with a signature tree over them."""

    def __init__(self, cid, n, pos, comp, bits: list[bytes]):
        order = np.lexsort((cid, n))
        self.cid, self.n, self.pos, self.comp = (x[order] for x in (cid, n, pos, comp))
        self.bits = [np.frombuffer(bits[k], np.uint8) for k in order]

    def rows(self, start: int, end: int, width: int) -> np.ndarray:
        return np.stack([_fold(b[None, :], width)[0] for b in self.bits[start:end]])

    def tree(self) -> Node:
        level = []
        for start in range(0, len(self.n), LEAF):
            end = min(start + LEAF, len(self.n))
            width = min(len(b) for b in self.bits[start:end])
            rows = self.rows(start, end, width)
            level.append(Node(start, end, width, np.bitwise_or.reduce(rows), int(self.n[start]), int(self.n[end - 1]), int(_count(rows).min()), []))
        while len(level) > 1:
            level = [self._above(level[k : k + 4]) for k in range(0, len(level), 4)]
        return level[0]

    def _above(self, parts: list[Node]) -> Node:
        width = min(p.width for p in parts)
        either = np.bitwise_or.reduce([_fold(p.either[None, :], width)[0] for p in parts])
        # Folding can join bits of a row: its fewest bits hold for the width they were counted at only.
        fewest = min(p.fewest if p.width == width else -(-p.fewest * width // p.width) for p in parts)
        return Node(parts[0].start, parts[-1].end, width, either, parts[0].low, max(p.high for p in parts), fewest, parts)


def _nodes_may_link(x: Node, y: Node, percent: int) -> bool:
    """Whether rows of two nodes can link: by their sizes, then by the maximum possible overlap.

    Bits of a row of x outside y's OR are at least its bits without those common to both ORs; each is a shingle that y's rows lack."""
    if 100 * min(x.high, y.high) < percent * max(x.low, y.low):
        return False
    width = min(x.width, y.width)
    common = int(_count(_fold(x.either[None, :], width) & _fold(y.either[None, :], width))[0])
    lost_x = max(0, (x.fewest if x.width == width else 0) - common)
    lost_y = max(0, (y.fewest if y.width == width else 0) - common)
    most = min(x.high - lost_x, y.high - lost_y)
    return most >= int(_needed(np.int64(x.low), np.int64(y.low), percent))


def _row_pairs(group: Group, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs of rows (i, j) may link."""
    n, pos = group.n, group.pos
    ok = (group.comp[i] != group.comp[j]) & _may_link(n[i], n[j], pos[i], pos[j], percent)
    at = np.flatnonzero(ok)
    if not len(at):
        return at
    i, j = i[at], j[at]
    widths = np.array([len(b) for b in group.bits])
    width = np.minimum(widths[i], widths[j])
    keep = np.zeros(len(at), bool)
    for w in np.unique(width):
        sel = np.flatnonzero(width == w)
        used, where = np.unique(np.concatenate([i[sel], j[sel]]), return_inverse=True)
        rows = np.stack([_fold(group.bits[k][None, :], int(w))[0] for k in used])
        for part in np.array_split(np.arange(len(sel)), max(1, len(sel) * int(w) // (8 << 20) + 1)):
            x, y = rows[where[part]], rows[where[len(sel) + part]]
            a, b = n[i[sel[part]]], n[j[sel[part]]]
            most = np.minimum(a - _count(x & ~y), b - _count(y & ~x))
            keep[sel[part]] = most >= _needed(a, b, percent)
    return at[keep]


def tree_join(group: Group, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes of rows of different components that may link, by dual traversal of the group's tree with itself."""
    if len(group.n) < 2:
        return
    root = group.tree()
    todo = [(root, root)]
    while todo:
        x, y = todo.pop()
        if x is not y and not _nodes_may_link(x, y, percent):
            continue
        if x.parts or y.parts:
            if x is y:
                todo += [(p, q) for k, p in enumerate(x.parts) for q in x.parts[k:]]
            elif x.parts and (not y.parts or x.end - x.start >= y.end - y.start):
                todo += [(p, y) for p in x.parts]
            else:
                todo += [(x, q) for q in y.parts]
            continue
        i, j = (v.ravel() for v in np.meshgrid(np.arange(x.start, x.end), np.arange(y.start, y.end), indexing="ij"))
        if x is y:
            i, j = i[i < j], j[i < j]
        at = _row_pairs(group, i, j, percent)
        if len(at):
            yield group.cid[i[at]], group.cid[j[at]]


def _tree_candidates(percent: int):
    """Rows sorted by (leader, part): each group, or part of a group, at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def joined(t: pa.Table, last: bool):
            leader, part = t.column("leader").to_numpy(), t.column("part").to_numpy()
            at = np.flatnonzero(scan.first_of_runs(leader, part))
            ends = np.append(at[1:], len(leader))
            stop = len(at) if last else len(at) - 1
            cid, n, pos, comp, bits = (t.column(c) for c in ("cid", "n", "pos", "comp", "bits"))
            cid, n, pos, comp = (c.to_numpy().astype(np.int64) for c in (cid, n, pos, comp))
            bits = bits.to_pylist()
            a, b = [], []
            for s, e in zip(at[:stop].tolist(), ends[:stop].tolist(), strict=True):
                if len(set(comp[s:e].tolist())) > 1:
                    for x, y in tree_join(Group(cid[s:e], n[s:e], pos[s:e], comp[s:e], bits[s:e]), percent):
                        a.append(np.minimum(x, y))
                        b.append(np.maximum(x, y))
            rest = t.slice(int(at[stop])) if stop < len(at) else None
            both = np.unique(np.column_stack([np.concatenate(a), np.concatenate(b)]), axis=0) if a else np.zeros((0, 2), np.int64)
            return scan.batch(PAIR, both[:, 0].copy(), both[:, 1].copy()), rest

        for b in batches:
            if b.num_rows:
                held.append(b)
                if b.column("leader")[0] != b.column("leader")[-1] or b.column("part")[0] != b.column("part")[-1] or len(held) > 1:
                    out, rest = joined(pa.Table.from_batches(held), False)
                    yield out
                    held = rest.to_batches() if rest is not None else []
        if held:
            yield joined(pa.Table.from_batches(held), True)[0]

    return run


def _verify(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, z = b.column("a").to_numpy(), b.column("b").to_numpy()
            texts = [b.column("text_a"), b.column("text_b")]
            for i in range(0, b.num_rows, 128):
                j = min(i + 128, b.num_rows)
                ok = []
                both = pa.concat_arrays([t.slice(i, j - i).cast(pa.large_string()) for t in texts])
                found = [s.hashes[s.first[k] : s.first[k + 1]] for _, _, t in scan.slices(both) for s in [sets_of(t, shingle)] for k in range(len(t))]
                for x, y in zip(found[: j - i], found[j - i :], strict=True):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(len(x) > 0 and 100 * same >= percent * (len(x) + len(y) - same))
                ok = np.array(ok, bool)
                yield scan.batch(PAIR, a[i:j][ok], z[i:j][ok])

    return run


def _bounded(percent: int):
    """Pairs whose signatures allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, z = b.column("a").to_numpy(), b.column("b").to_numpy()
            n = np.concatenate([b.column("n_a").to_numpy(), b.column("n_b").to_numpy()])
            m = len(a)
            if not m:
                continue
            pairs = Group.__new__(Group)
            pairs.cid, pairs.n, pairs.pos, pairs.comp = np.arange(2 * m), n, np.zeros(2 * m, np.int64), np.arange(2 * m)
            pairs.bits = [np.frombuffer(x, np.uint8) for c in ("bits_a", "bits_b") for x in b.column(c).to_pylist()]
            at = _row_pairs(pairs, np.arange(m), np.arange(m, 2 * m), percent)
            yield scan.batch(PAIR, a[at], z[at])

    return run


@dataclass(frozen=True)
class Similar:
    """rows: row key, n_shingles, cid (class), root (of its component), component (smallest id reachable); links: all pairs a < b of classes
    that link, or None where components alone were asked for. Rows of one class link with one another too."""

    rows: DataFrame
    links: DataFrame | None


def similar(docs: DataFrame, shingle: int = 5, percent: int = 80, every_link: bool = True) -> Similar:
    """Links and components; with every_link=False components alone, without comparing rows that are known to be in one."""
    spark = docs.sparkSession
    texts = keyed(docs)
    made = stored(texts.mapInArrow(scan.tidy(_profiles(shingle)), PROFILE_SQL), "op5-profiles")
    profiles = made.where(F.col("n") != SKETCH)
    levels = spark.sparkContext.broadcast(rarity(made.where(F.col("n") == SKETCH)))

    # Classes of equal sets; cid numbers them, and the smallest row stands for each.
    classes = profiles.where("n > 0").groupBy("n", "c1", "c2").agg(F.min(F.struct(KEY, PRINT)).alias("first"), F.min("bits").alias("bits"), F.count(F.lit(1)).alias("rows"))
    classes = stored(classes.select("n", "c1", "c2", "first", "bits", "rows", F.monotonically_increasing_id().alias("cid")), "op5-classes")
    heads = classes.select(F.col(f"first.{KEY}").alias(KEY), F.col(f"first.{PRINT}").alias(PRINT), "cid", "rows")
    heads = texts.join(narrow(heads, BROADCAST_ROWS), [KEY, PRINT])
    # Where several rows have one set, that which stands for it may be given more than once: one of them is enough.
    again = stored(heads.where("rows > 1").select("cid", "text").dropDuplicates(["cid"]), "op5-repeated")
    standing = heads.where("rows = 1").select("cid", "text").unionByName(again)

    dealt = standing.mapInArrow(scan.tidy(_prefixes(shingle, percent, levels)), "token long, cid long, n int, pos int")
    dealt = dealt.repartition("token").sortWithinPartitions("token", "n", "cid")
    led = dealt.mapInArrow(_led(percent), "leader long, cid long, n int, pos int")
    # A shared shingle stands no earlier than the first that the group has of a row.
    shared = stored(led.groupBy("leader", "cid").agg(F.min("n").alias("n"), F.min("pos").alias("pos")), "op5-groups")

    # Texts that some candidate may ask for are kept once, for all rounds of verification.
    partners = narrow(shared.select("cid").distinct(), BROADCAST_ROWS)
    standing = stored(standing.join(partners, "cid", "left_semi"), "op5-texts")

    signs = classes.select("cid", "n", "bits")
    if every_link:
        fresh = stored(_from_trees(_with_components(shared, None), signs, percent), "op5-candidates")
        links = stored(_verified(fresh, standing, shingle, percent), "op5-links")
        known = components(links, "op5-components")
    else:
        links, known = None, _joined_components(shared, signs, standing, shingle, percent)

    members = profiles.select(KEY, PRINT, "n", "c1", "c2").join(classes.select("n", "c1", "c2", "cid", F.col(f"first.{KEY}").alias("least")), ["n", "c1", "c2"], "left")
    members = members.join(known.select(F.col("node").alias("cid"), "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = members.where("cid IS NOT NULL").groupBy("root").agg(F.min("least").alias("component"))
    rows = members.join(least, "root", "left").select(KEY, PRINT, F.col("n").alias("n_shingles"), "cid", "root", F.coalesce("component", KEY).alias("component"))
    return Similar(rows, links)


def _from_trees(all_rows: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Candidates of the signature trees: pairs of classes of different components, from the groups that hold several."""
    mixed = all_rows.groupBy("leader").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("rows")).where("low < high")
    rows = all_rows.join(mixed.select("leader", "rows"), "leader")
    whole = rows.where(F.col("rows") <= BLOCK).select("leader", F.lit(0).cast("long").alias("part"), "cid", "n", "pos", "comp")
    parts = whole.unionByName(_blocks(rows.where(F.col("rows") > BLOCK), percent)).join(signs.select("cid", "bits"), "cid")
    parts = parts.select("leader", "part", "cid", "n", "pos", "comp", "bits")
    return parts.repartition("leader", "part").sortWithinPartitions("leader", "part").mapInArrow(scan.tidy(_tree_candidates(percent)), "a long, b long").distinct()


def _blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of large groups, once for each pair of blocks (part) that their own block meets.

    Sizes are cut into classes, each 100 / percent times as far up as the one before, so that rows link only within a class or with the next;
    a class is dealt in blocks by a hash."""
    own = rows.withColumn("class", F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int") if percent < 100 else F.col("n"))
    blocks = own.groupBy("leader", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = own.join(blocks, ["leader", "class"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # A part is named by its lower block and its higher block.
    near = blocks.select("leader", (F.col("class") - 1).alias("class"), F.col("blocks").alias("above"))
    far = blocks.select("leader", (F.col("class") + 1).alias("class"), F.col("blocks").alias("below"))
    own = own.join(near, ["leader", "class"], "left").join(far, ["leader", "class"], "left")
    name = lambda c1, b1, c2, b2: F.xxhash64(c1, b1, c2, b2)
    each = lambda count: F.sequence(F.lit(0), F.coalesce(count, F.lit(0)))
    this, at = F.col("class"), F.col("block")
    within = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: name(this, F.least(at, x), this, F.greatest(at, x)))
    above = F.transform(F.filter(each(F.col("above")), lambda x: x < F.col("above")), lambda x: name(this, at, this + 1, x))
    below = F.transform(F.filter(each(F.col("below")), lambda x: x < F.col("below")), lambda x: name(this - 1, x, this, at))
    return own.select("leader", F.explode(F.concat(within, above, below)).alias("part"), "cid", "n", "pos", "comp")


def _joined_components(shared: DataFrame, signs: DataFrame, standing: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, root of the components, from as few links as give them."""
    pair = ["a", "b"]
    asked = known = None
    for turn in range(ROUNDS):
        early = _with_components(shared, known)
        # Rows of one size come in another order each time.
        near = early.repartition("leader").sortWithinPartitions("leader", "n", F.xxhash64("cid", F.lit(turn)), "cid").mapInArrow(scan.tidy(_neighbours(percent)), "a long, b long").distinct()
        near = near.join(asked, pair, "left_anti") if asked is not None else near
        fresh = stored(_with_signs(near, signs, percent), "op5-near")
        found = stored(_verified(fresh, standing, shingle, percent), "op5-links")
        asked = fresh if asked is None else asked.unionByName(fresh)
        known = components(_pointers(known).unionByName(found) if known is not None else found, "op5-provisional")

    trees = _from_trees(_with_components(shared, known), signs, percent)
    fresh = stored(trees.join(asked, pair, "left_anti"), "op5-candidates")

    # Of the candidates between two components a few are verified at a time: once one links, the others are not needed. In the end
    # every candidate has been verified, or its components have become one.
    few = 16
    while True:
        ends = known.select(F.col("node").alias("a"), F.col("root").alias("x")), known.select(F.col("node").alias("b"), F.col("root").alias("y"))
        open_ = fresh.join(ends[0], "a", "left").join(ends[1], "b", "left").select(*pair, F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
        open_ = stored(open_.where("x != y"), "op5-open")
        if open_.isEmpty():
            return known
        at = F.xxhash64("a", "b")
        sides = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.pmod(at, F.lit(few)).alias("turn")]
        picked = open_.select(*pair, *sides).groupBy("x", "y", "turn").agg(F.min(F.struct(F.xxhash64("a", "b", F.lit(few)), *pair)).alias("p"))
        picked = stored(picked.select("p.a", "p.b"), "op5-picked")
        found = stored(_verified(picked, standing, shingle, percent), "op5-links")
        fresh = open_.select(*pair).join(picked, pair, "left_anti")
        known = components(_pointers(known).unionByName(found), "op5-components")
        few *= 32


def _pointers(known: DataFrame) -> DataFrame:
    """Known components as links: what is found later is added to them."""
    return known.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _with_components(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows with the component of their class, as far as components are known."""
    if known is None:
        return rows.withColumn("comp", F.col("cid"))
    roots = known.select(F.col("node").alias("cid"), F.col("root").alias("comp"))
    return rows.join(roots, "cid", "left").select(*rows.columns, F.coalesce("comp", "cid").alias("comp"))


def _with_signs(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    side = lambda x: signs.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(scan.tidy(_bounded(percent)), "a long, b long")


def _verified(pairs: DataFrame, standing: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs that link by their whole texts. Only texts of classes in some pair move."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    texts = standing.join(narrow(asked, BROADCAST_ROWS), "cid", "left_semi")
    side = lambda x: texts.select(F.col("cid").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(scan.tidy(_verify(shingle, percent)), "a long, b long").distinct()


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that are the first of their component, with all their columns; of rows equal in id and text, one: that whose columns,
    as JSON, have the smallest hash.

    Of rows that share the smallest id of a component, that with the smallest print stays."""
    rows = similar(docs, **options, every_link=False).rows
    # A row without words is a group of its own.
    alone = F.when(F.col("root").isNull(), F.struct(KEY, PRINT))
    stay = rows.groupBy("root", alone.alias("alone")).agg(F.min(F.struct(KEY, PRINT)).alias("first")).select("first.*")
    times = rows.groupBy(KEY, PRINT).agg(F.count(F.lit(1)).alias("_times"))
    stay = stored(stay.join(times, [KEY, PRINT]), "op5-stay")
    whole = docs.select(*row_key(), F.struct("*").alias("_row"))
    once = whole.join(stay.where("_times = 1"), [KEY, PRINT], "left_semi").select("_row")
    again = whole.join(stay.where("_times > 1"), [KEY, PRINT], "left_semi")
    again = again.groupBy(KEY, PRINT).agg(F.min_by("_row", F.sha2(F.to_json("_row"), 256)).alias("_row")).select("_row")
    return once.unionByName(again).select("_row.*")


def op5_jaccard_join(spark, sf_dir) -> DataFrame:
    rows = similar(table(spark, sf_dir, "documents"), every_link=False).rows
    return rows.select(id_back(), "n_shingles", F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id"))


SQL = {
    "op5_jaccard_join": r"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, CAST(greatest(len(w) - 4, 1) + 1 AS BIGINT))) AS i FROM doc WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (min(p.n) + min(q.n) - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM doc UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT doc.doc_id, coalesce(min(n), 0) AS n_shingles, min(reach.y) AS component_id FROM doc JOIN reach ON reach.x = doc.doc_id LEFT JOIN sizes ON sizes.doc_id = doc.doc_id GROUP BY doc.doc_id
"""
}
QUERIES = {"op5_jaccard_join": op5_jaccard_join}
