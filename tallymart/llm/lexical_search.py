"""Ranked lexical search, reversed: the items are indexed, and the documents run through their index.

1. Items are split into terms. Their inverted index (term -> items and how often each has it) is broadcast. It is bounded: beyond POSTINGS
   items are taken in several blocks, each against all documents.
2. One pass over the texts keeps each document's length and its counts of terms that some item has. Length, number and document
   frequencies of the corpus come from this table.
3. A pass over the table of counts runs every count through the index and adds up scores of (document, item). Each task holds for each item a bounded
   heap of its best documents; a score below a heap's least entry never leaves the pass.
4. The heaps of all tasks are merged to one of the same size for each item.

Weights and scores are whole numbers, so that no order of additions changes a rank:
  w = floor(1000 * ln((2 N + 2) / (2 df + 1))), m = 100 - b + (b * n * N) div L, score = sum of w * ((1000000000 * tf) div (1000 * tf + 8 * m)).

Memory: the index of a block, `top` entries for each of its items, and CELLS scores in a task; nothing grows with the documents.

Defined cases: null and empty texts have no terms, do not count in N and are found by nothing; items without terms find nothing; each row of the
benchmark is an item of its own; rows that share a document id are found each on its own, ties of score and id in any order;
a null id is smaller than all others; an empty documents or benchmark table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.resampling import WORD
from tallymart.llm.shared import KEY, id_back, keyed, ship, stored, table

#: Most terms of all items of a block, and scores that a task holds at once.
POSTINGS, CELLS = 2_000_000, 1 << 21


def terms_of(texts: scan.Texts) -> tuple[scan.Words, np.ndarray]:
    """Words with their hashes; A-Z are lower-cased."""
    words = scan.Words(scan.Texts(scan.LOWER[texts.buf], texts.off), ~WORD)
    return words, words.hashes()


def counted(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, value, times) of the distinct pairs, in their order."""
    order = np.lexsort((value, group))
    group, value = group[order], value[order]
    at = np.flatnonzero(scan.first_of_runs(group, value))
    return group[at], value[at], np.diff(np.append(at, len(group)))


ITEM = pa.schema([("item", pa.int64()), ("terms", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
COUNTED = pa.schema([(KEY, pa.int64()), ("length", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])


def _lists(count: int, group: np.ndarray, *values: pa.Array) -> list[pa.ListArray]:
    """One list for each of `count` groups of each array of values, sorted by group."""
    at = pa.array(np.searchsorted(group, np.arange(count + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(at, v) for v in values]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        items = b.column("item")
        for i, j, texts in scan.slices(b.column("text")):
            words, hashes = terms_of(texts)
            doc, term, times = counted(np.repeat(np.arange(j - i), words.counts()), hashes)
            yield pa.RecordBatch.from_arrays([items.slice(i, j - i), *_lists(j - i, doc, pa.array(scan.signed(term)), pa.array(times.astype(np.int64)))], schema=ITEM)


class Index:
    """Inverted index: term t (a place in `terms`) is held by the items item[first[t]:first[t + 1]], `times` each."""

    def __init__(self, rows: list):
        """Of rows (item, terms, times)."""
        self.items = np.array([r.item for r in rows], np.int64)
        n = [len(r.terms) for r in rows]
        owner = np.repeat(np.arange(len(rows)), n)
        term = np.array([t for r in rows for t in r.terms], np.int64).view(np.uint64)
        times = np.array([t for r in rows for t in r.times], np.int64)
        self.terms, place = np.unique(term, return_inverse=True)
        order = np.argsort(place, kind="stable")
        self.item, self.times = owner[order], times[order]
        self.first = np.searchsorted(place[order], np.arange(len(self.terms) + 1))


def _term_counts(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for b in batches:
            keys = b.column(KEY)
            for i, j, texts in scan.slices(b.column("text")):
                words, hashes = terms_of(texts)
                place = np.searchsorted(known, hashes)
                hit = known[np.minimum(place, len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)
                doc, term, times = counted(np.repeat(np.arange(j - i), words.counts())[hit], place[hit])
                lists = _lists(j - i, doc, pa.array(term.astype(np.int32)), pa.array(times.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([keys.slice(i, j - i), pa.array(words.counts().astype(np.int64)), *lists], schema=COUNTED)

    return run


class Heaps:
    """For each item its `top` best documents so far: highest score first, equal scores by id."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)  # a score must not be below it
        self.item = self.score = self.key = np.zeros(0, np.int64)

    def offer(self, item: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(item):
            return
        item, score, key = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.key, key)))
        order = np.lexsort((key, -score, item))
        item, score, key = item[order], score[order], key[order]
        begin = np.flatnonzero(scan.first_of_runs(item))
        place = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
        keep = place < self.top
        full = place == self.top - 1
        self.least[item[full]] = score[full]
        self.item, self.score, self.key = item[keep], score[keep], key[keep]


HEAP = pa.schema([("item", pa.int64()), ("score", pa.int64()), (KEY, pa.int64())])


def _best(index, weights: np.ndarray, docs: int, length: int, top: int, b_percent: int):
    """The heaps of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        n_items = len(ix.items)
        heaps = Heaps(n_items, top)
        held = np.diff(ix.first)
        at_once = max(1, CELLS // max(1, n_items))
        for batch in batches:
            keys, size = batch.column(KEY).to_numpy(), batch.column("length").to_numpy()
            m = 100 - b_percent + (b_percent * size * docs) // max(1, length)
            for i in range(0, batch.num_rows, at_once):
                part = batch.slice(i, at_once)
                doc = np.repeat(np.arange(part.num_rows), part.column("terms").value_lengths().to_numpy())
                term = part.column("terms").flatten().to_numpy().astype(np.int64)
                tf = part.column("times").flatten().to_numpy().astype(np.int64)
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[i + doc]))
                pick = gain > 0
                doc, term, gain = doc[pick], term[pick], gain[pick]
                scores = np.zeros(part.num_rows * n_items, np.int64)
                # Postings of some counts at a time.
                ends = np.cumsum(held[term])
                start = 0
                while start < len(term):
                    stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CELLS, "right")))
                    of, place = scan.within(held[term[start:stop]])
                    at = ix.first[term[start:stop]][of] + place
                    np.add.at(scores, doc[start:stop][of] * n_items + ix.item[at], gain[start:stop][of] * ix.times[at])
                    start = stop
                scores = scores.reshape(part.num_rows, n_items)
                d, item = np.nonzero(scores >= heaps.least)
                heaps.offer(item, scores[d, item], keys[i + d])
        yield scan.batch(HEAP, ix.items[heaps.item], heaps.score, heaps.key)

    return run


def search(docs: DataFrame, items: DataFrame, top: int = 10, b_percent: int = 75) -> DataFrame:
    """item_id, rank (from 1), document key and score of the `top` best documents of each row of items (item_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    rows = stored(items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("item")), "op11-items")
    asked = stored(rows.select("item", "text").mapInArrow(_item_terms, "item long, terms array<long>, times array<long>").where(F.size("terms") > 0), "op11-terms")
    postings = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-postings // POSTINGS) or 1
    texts = keyed(docs).select(KEY, "text")
    heaps = None
    for k in range(blocks):
        index = Index(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect())  # some POSTINGS entries
        found = _block(texts, index, top, b_percent)
        heaps = found if heaps is None else heaps.unionByName(found)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), KEY)
    best = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(rows.select("item", "item_id"), "item").select("item_id", "rank", KEY, "score")


def _block(texts: DataFrame, index: Index, top: int, b_percent: int) -> DataFrame:
    context = texts.sparkSession.sparkContext
    counts = stored(texts.mapInArrow(_term_counts(context.broadcast(index.terms)), f"{KEY} long, length long, terms array<int>, times array<int>"), "op11-counts")
    docs, length = counts.agg(F.count_if(F.col("length") > 0), F.coalesce(F.sum("length"), F.lit(0))).first()
    df = np.zeros(len(index.terms), np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term of the index
        df[r.term] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2.0 * docs + 2) / (2.0 * n + 1))) for n in df.tolist()], np.int64)
    some = counts.where(F.size("terms") > 0)
    return some.mapInArrow(_best(context.broadcast(index), weights, docs, length, top, b_percent), f"item long, score long, {KEY} long")


def op11_lexical_search(spark, sf_dir) -> DataFrame:
    out = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("item_id", "rank", id_back(), "score")


SQL = {
    "op11_lexical_search": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
corpus AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM doc WHERE len(w) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM doc) GROUP BY doc_id, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
size AS (SELECT doc_id, 100 - 75 + (75 * len(w) * n) // l AS m FROM doc, corpus WHERE len(w) > 0),
scores AS (SELECT item_id, doc_id, CAST(sum(times * weight.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
}
QUERIES = {"op11_lexical_search": op11_lexical_search}
