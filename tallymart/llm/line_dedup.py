"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line without white space at both ends, A-Z lower-cased. An index holds, for each key of at least `min_chars` code
points, in how many documents it is and the largest id among them (the reference counts), dealt over shards by hash. Each shard also has
a cuckoo filter of the keys that are in at least `min_docs` documents. Inserting documents adds to the counts and puts keys that reach
the bound into the filters; deleting documents takes from the counts and takes keys that fall below the bound out of the filters again,
so an index after both is the index before. Each change makes a new version beside the old one.

Applying an index to documents sends the distinct long lines of each, as 128-bit hashes, to their shard. What the filter lets through
is looked up in the shard's exact table. Shards that hold frequent lines are dealt over as many tasks as their counts ask for. Repeated
lines go from every document but the one with the largest id.

Defined cases: a null or empty text is one empty line; each row counts as a document, also rows that share an id; a null id is smaller
than all others; equal lines of one document count once and go or stay together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.shared import KEY, PRINT, folder, id_back, keyed, row_key, table

U = np.uint64
#: A second hash of the same bytes: each byte stands for a number of its own.
OTHER = scan.mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
SLOTS = 4


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; each key has two buckets, found from one another by the fingerprint."""

    def __init__(self, buckets: int = 8):
        self.cells = np.zeros((buckets, SLOTS), np.uint16)

    @staticmethod
    def sized(keys: int) -> CuckooFilter:
        return CuckooFilter(1 << max(3, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8))))))

    @staticmethod
    def of_bytes(data: bytes) -> CuckooFilter:
        out = CuckooFilter()
        out.cells = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return out

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = U(len(self.cells) - 1)
        prints = (h2 >> U(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = h1 & mask
        return prints, one.astype(np.int64), (one ^ (scan.mix(prints.astype(U)) & mask)).astype(np.int64)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """False if a key finds no place: build a larger filter from the exact table then."""
        mask, turn = len(self.cells) - 1, 0
        for p, a, b in zip(*(x.tolist() for x in self.places(h1, h2)), strict=True):
            for place in (a, b):
                free = np.flatnonzero(self.cells[place] == 0)
                if len(free):
                    self.cells[place, free[0]] = p
                    break
            else:
                place = b
                for _ in range(500):
                    turn = (turn + 1) % SLOTS
                    p, self.cells[place, turn] = int(self.cells[place, turn]), p
                    place ^= int(scan.mix(np.array([p], U))[0]) & mask
                    free = np.flatnonzero(self.cells[place] == 0)
                    if len(free):
                        self.cells[place, free[0]] = p
                        break
                else:
                    return False
        return True

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Only for keys that were inserted."""
        for p, a, b in zip(*(x.tolist() for x in self.places(h1, h2)), strict=True):
            for place in (a, b):
                found = np.flatnonzero(self.cells[place] == p)
                if len(found):
                    self.cells[place, found[0]] = 0
                    break

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        prints, a, b = self.places(h1, h2)
        return (self.cells[a] == prints[:, None]).any(1) | (self.cells[b] == prints[:, None]).any(1)


class Lines:
    """All lines of a slice: document, start and end in the buffer, two hashes of the key, and whether the key is long enough."""

    def __init__(self, texts: scan.Texts, min_chars: int):
        buf, off = texts.buf, texts.off
        breaks = np.flatnonzero(buf == 0x0A)
        # A document of b breaks has b + 1 lines: a line starts where a document does and behind each break.
        self.start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
        self.first = np.arange(len(off)) + np.searchsorted(breaks, off)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.end = np.sort(np.concatenate([off[1:], breaks]), kind="stable")
        solid = np.concatenate([[0], np.cumsum(~scan.SPACE[buf])])
        held = solid[self.end] > solid[self.start]
        places = np.flatnonzero(~scan.SPACE[buf])
        # From the first to the last byte that is no white space; empty where there is none.
        s = self.start.copy()
        e = self.start.copy()
        s[held] = places[solid[self.start[held]]]
        e[held] = places[solid[self.end[held]] - 1] + 1
        chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        self.long = chars[e] - chars[s] >= min_chars
        lower = scan.LOWER[buf]
        self.h1 = scan.spans_hash(scan.byte_sums(lower), s, e)
        self.h2 = scan.spans_hash(scan.sums(OTHER[lower]), s, e)

    def held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, h1, h2) of the long lines."""
        d, a, b = self.doc[self.long], self.h1[self.long], self.h2[self.long]
        order = np.lexsort((b, a, d))
        d, a, b = d[order], a[order], b[order]
        new = scan.first_of_runs(d, a, b)
        return d[new], a[new], b[new]


COUNTS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()), ("last", pa.int64())])
HELD = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), (KEY, pa.int64()), (PRINT, pa.int64())])
MARKED = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
CLEANED = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.large_string())])


def _counts(min_chars: int):
    """Reference counts of a slice of documents: summed here before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(KEY).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                d, h1, h2 = Lines(texts, min_chars).held()
                k = keys[i:j][d]
                order = np.lexsort((k, h2, h1))
                h1, h2, k = h1[order], h2[order], k[order]
                at = np.flatnonzero(scan.first_of_runs(h1, h2))
                ends = np.append(at[1:], len(h1))
                if len(at):
                    yield scan.batch(COUNTS, scan.signed(h1[at]), scan.signed(h2[at]), ends - at, k[ends - 1])

    return run


def _held(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                d, h1, h2 = Lines(texts, min_chars).held()
                yield scan.batch(HELD, scan.signed(h1), scan.signed(h2), keys[i:j][d], prints[i:j][d])

    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard in order: its filter, its exact rows of repeated keys, then the lines asked for. Holds one shard's table."""
    shard, cuckoo, known = None, None, []
    exact = None
    for b in batches:
        shards, kinds = b.column("shard").to_numpy(), b.column("kind").to_numpy()
        h1, h2 = (b.column(x).to_numpy().view(U) for x in ("h1", "h2"))
        key, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
        at = np.append(np.flatnonzero(scan.first_of_runs(shards, kinds)), len(shards))
        for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if shards[i] != shard:
                shard, cuckoo, known, exact = shards[i], None, [], None
            if kinds[i] == 0:
                cuckoo = CuckooFilter.of_bytes(b.column("cells")[i].as_py())
            elif kinds[i] == 1:
                known.append((h1[i:j], h2[i:j], key[i:j]))
            elif cuckoo is not None:
                if exact is None:
                    exact = [np.concatenate(x) for x in zip(*known, strict=True)] if known else [np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64)]
                    order = np.lexsort((exact[1], exact[0]))
                    exact = [x[order] for x in exact]
                sel = i + np.flatnonzero(cuckoo.contains(h1[i:j], h2[i:j]))
                found, last = _lookup(exact, h1[sel], h2[sel])
                sel = sel[found & (last != key[sel])]
                if len(sel):
                    yield scan.batch(MARKED, key[sel], prints[sel], scan.signed(h1[sel]), scan.signed(h2[sel]))


def _lookup(exact: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in the sorted table, and its largest id."""
    a, b, last = exact
    if not len(a):
        return np.zeros(len(h1), bool), np.zeros(len(h1), np.int64)
    found, out = np.zeros(len(h1), bool), np.zeros(len(h1), np.int64)
    at = np.searchsorted(a, h1)
    todo = np.arange(len(h1))
    while len(todo):  # more than once only where the first hashes of several keys are equal
        todo = todo[at[todo] < len(a)]
        todo = todo[a[at[todo]] == h1[todo]]
        same = b[at[todo]] == h2[todo]
        found[todo[same]] = True
        out[todo[same]] = last[at[todo[same]]]
        todo = todo[~same]
        at[todo] += 1
    return found, out


def _drop(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            marks = b.column("marks")
            for i, j, texts in scan.slices(b.column("text")):
                lines = Lines(texts, min_chars)
                part = marks.slice(i, j - i)
                row = np.repeat(np.arange(j - i), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                flat = part.flatten()
                gone = _marked(row, flat.field("h1").to_numpy(zero_copy_only=False).view(U), flat.field("h2").to_numpy(zero_copy_only=False).view(U))
                drop = lines.long & np.isin(_marked(lines.doc, lines.h1, lines.h2), gone)
                dropped = np.bincount(lines.doc[drop], minlength=j - i)
                kept = [_kept(texts, lines, drop, d) if dropped[d] else texts.buf[texts.off[d] : texts.off[d + 1]].tobytes() for d in range(j - i)]
                yield scan.batch(CLEANED, keys[i:j], prints[i:j], np.diff(lines.first), dropped, pa.array(kept, pa.large_binary()).cast(pa.large_string()))

    return run


def _marked(row: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return scan.mix(h1 ^ scan.mix(row.astype(U) + U(1))) ^ h2


def _kept(texts: scan.Texts, lines: Lines, drop: np.ndarray, d: int) -> bytes:
    at = range(lines.first[d], lines.first[d + 1])
    return b"\n".join(texts.buf[lines.start[k] : lines.end[k]].tobytes() for k in at if not drop[k])


class LineIndex:
    """Versions of reference counts and filters below `path`. `shards` is fixed for an index: take enough that one shard fits a task."""

    def __init__(self, spark: SparkSession, path: str | None = None, version: int = 0, min_docs: int = 3, min_chars: int = 20, shards: int = 1024):
        self.spark, self.path, self.version = spark, path or folder(spark, "lines"), version
        self.min_docs, self.min_chars, self.shards = min_docs, min_chars, shards

    def counts(self) -> DataFrame:
        """shard, h1, h2, n, last: the exact table."""
        if not self.version:
            return self.spark.createDataFrame([], "shard int, h1 long, h2 long, n long, last long")
        return self.spark.read.parquet(f"{self.path}/v{self.version}/counts")

    def filters(self) -> DataFrame:
        """shard, cells: one filter per shard that has a repeated key."""
        if not self.version:
            return self.spark.createDataFrame([], "shard int, cells binary")
        return self.spark.read.parquet(f"{self.path}/v{self.version}/filters")

    def _counted(self, docs: DataFrame) -> DataFrame:
        each = keyed(docs).mapInArrow(_counts(self.min_chars), "h1 long, h2 long, n long, last long")
        return each.withColumn("shard", F.pmod(F.shiftright("h1", 20), F.lit(self.shards)).cast("int"))

    def _write(self, counts: DataFrame, changes_of) -> LineIndex:
        """The next version: its counts, then the filters, of which only those of changed shards are made anew."""
        new = LineIndex(self.spark, self.path, self.version + 1, self.min_docs, self.min_chars, self.shards)
        counts.write.mode("overwrite").parquet(f"{self.path}/v{new.version}/counts")
        # Filters grow only with repeated keys, a small part of the counts.
        rows = new.counts().where(F.col("n") >= self.min_docs).select("shard", "h1", "h2", F.lit(0).alias("change"))
        changes = changes_of(new) if self.version else rows.withColumn("change", F.lit(1))
        old = self.filters()
        made = (
            changes.groupBy("shard")
            .cogroup(old.groupBy("shard"))
            .applyInPandas(_updated, "shard int, cells binary, full boolean")
        )
        path = f"{self.path}/v{new.version}/filters-made"
        made.write.mode("overwrite").parquet(path)
        made = self.spark.read.parquet(path)
        full = made.where("full").select("shard")  # a filter without room is built from the exact table at a larger size
        rebuilt = rows.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(_rebuilt, "shard int, cells binary")
        made.where("NOT full").select("shard", "cells").unionByName(rebuilt).write.mode("overwrite").parquet(f"{self.path}/v{new.version}/filters")
        return new

    def _changes(self, old: DataFrame):
        """Keys that passed the bound: 1 into the filter, -1 out of it."""

        def of(new: LineIndex) -> DataFrame:
            a, b = (x.select("shard", "h1", "h2", (F.col("n") >= self.min_docs).alias(name)) for x, name in ((old, "was"), (new.counts(), "is")))
            both = a.join(b, ["shard", "h1", "h2"], "full").na.fill(False, ["was", "is"])
            return both.where(F.col("was") != F.col("is")).select("shard", "h1", "h2", F.when(F.col("is"), 1).otherwise(-1).alias("change"))

        return of

    def insert(self, docs: DataFrame) -> LineIndex:
        delta = self._counted(docs).select("shard", "h1", "h2", "n", "last")
        both = self.counts().unionByName(delta) if self.version else delta
        summed = both.groupBy("h1", "h2").agg(F.min("shard").alias("shard"), F.sum("n").alias("n"), F.max("last").alias("last"))
        return self._write(summed.select("shard", "h1", "h2", "n", "last"), self._changes(self.counts()))

    def delete(self, gone: DataFrame, left: DataFrame) -> LineIndex:
        """The index without the rows `gone`. `left`: the rows that stay, read for lines whose largest id goes."""
        minus = self._counted(gone).groupBy("h1", "h2").agg(F.sum("n").alias("less"), F.max("last").alias("top"))
        taken = self.counts().join(minus, ["h1", "h2"], "left").withColumn("n", F.col("n") - F.coalesce("less", F.lit(0)))
        taken = taken.where(F.col("n") > 0)
        lost = taken.where(F.col("top") == F.col("last")).select("h1", "h2")
        again = self._counted(left).join(lost, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.max("last").alias("next"))
        counts = taken.join(again, ["h1", "h2"], "left").select("shard", "h1", "h2", "n", F.coalesce("next", "last").alias("last"))
        return self._write(counts, self._changes(self.counts()))

    def marked(self, docs: DataFrame) -> DataFrame:
        """The lines to drop: row key and hashes."""
        held = keyed(docs).mapInArrow(_held(self.min_chars), f"h1 long, h2 long, {KEY} long, {PRINT} long")
        held = held.withColumn("shard", F.pmod(F.shiftright("h1", 20), F.lit(self.shards)).cast("int"))
        # How many tasks share a shard follows from its counts; the table has at most one row a shard.
        load = self.counts().groupBy("shard").agg(F.sum("n").alias("load"))
        fair = max(1.0, load.agg(F.avg("load")).first()[0] or 0.0)
        deal = F.broadcast(load.select(F.col("shard").alias("_s"), F.ceil(F.col("load") / fair).cast("int").alias("parts")))
        none = F.lit(None)
        probes = held.join(deal, F.col("shard") == F.col("_s")).select(
            "shard", F.pmod(F.xxhash64(KEY, PRINT, F.lit(1)), F.col("parts")).cast("int").alias("part"), F.lit(2).alias("kind"), "h1", "h2", KEY, PRINT, none.cast("binary").alias("cells")
        )
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        zero = F.lit(0).cast("long")
        known = self.counts().where(F.col("n") >= self.min_docs).join(deal, F.col("shard") == F.col("_s"))
        known = known.select("shard", every, F.lit(1).alias("kind"), "h1", "h2", F.col("last").alias(KEY), zero.alias(PRINT), none.cast("binary").alias("cells"))
        cuckoo = self.filters().join(deal, F.col("shard") == F.col("_s")).select("shard", every, F.lit(0).alias("kind"), zero.alias("h1"), zero.alias("h2"), zero.alias(KEY), zero.alias(PRINT), "cells")
        rows = probes.unionByName(known).unionByName(cuckoo)
        dealt = rows.repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
        return dealt.mapInArrow(_probe_parts, f"{KEY} long, {PRINT} long, h1 long, h2 long")

    def clean(self, docs: DataFrame) -> DataFrame:
        """Row key, n_lines, n_dropped, kept: every row's text without the lines to drop."""
        marks = self.marked(docs).groupBy(KEY, PRINT).agg(F.collect_set(F.struct("h1", "h2")).alias("marks"))
        rows = keyed(docs).join(marks, [KEY, PRINT], "left")
        none = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
        rows = rows.withColumn("marks", F.coalesce("marks", none))
        return rows.mapInArrow(_drop(self.min_chars), f"{KEY} long, {PRINT} long, n_lines long, n_dropped long, kept string")


def _probe_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard dealt over several parts comes once for each: the parts of one task are told apart."""

    def told(b: pa.RecordBatch) -> pa.RecordBatch:
        one = b.column("shard").to_numpy().astype(np.int64) * (1 << 31) + b.column("part").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(one), *b.columns[1:]], names=b.schema.names)

    yield from _probe(told(b) for b in batches)


def _updated(changes, old):
    import pandas as pd

    shard = int(changes["shard"].iloc[0] if len(changes) else old["shard"].iloc[0])
    h1, h2 = (changes[c].to_numpy(np.int64).view(U) for c in ("h1", "h2"))
    into = (changes["change"] > 0).to_numpy()
    cuckoo = CuckooFilter.of_bytes(old["cells"].iloc[0]) if len(old) else CuckooFilter.sized(int(into.sum()))
    cuckoo.delete(h1[~into], h2[~into])
    full = not cuckoo.insert(h1[into], h2[into])
    return pd.DataFrame({"shard": [shard], "cells": [cuckoo.to_bytes()], "full": [full]})


def _rebuilt(rows):
    import pandas as pd

    h1, h2 = (rows[c].to_numpy(np.int64).view(U) for c in ("h1", "h2"))
    size = 2 * len(rows)
    while not (cuckoo := CuckooFilter.sized(size)).insert(h1, h2):
        size *= 2
    return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "cells": [cuckoo.to_bytes()]})


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """clean() of a new index of docs."""
    return LineIndex(docs.sparkSession, **options).insert(docs).clean(docs)


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """docs with all their columns, the repeated lines gone from `text`; null texts stay null."""
    cleaned = dedup_lines(docs, **options).select(KEY, PRINT, "kept", "n_dropped").dropDuplicates([KEY, PRINT])
    whole = docs.select(*row_key(), F.struct("*").alias("_row")).join(cleaned, [KEY, PRINT])
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("_row.text"))
    return whole.select(*[text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def op3_line_dedup(spark, sf_dir) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(id_back(), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = {
    "op3_line_dedup": r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM doc),
keys AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS last FROM keys WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3),
judged AS (SELECT keys.*, coalesce(doc_id < last, false) AS gone FROM keys LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
}
QUERIES = {"op3_line_dedup": op3_line_dedup}
