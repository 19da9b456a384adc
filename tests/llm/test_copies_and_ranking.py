"""Exact copies, resampling and lexical search against plain Python, over nulls, ties, repeated rows, long texts, clashing columns and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import CLASHING, LOWER, edge_documents, frame, lorem, sha256

from tallymart.llm import exact_dedup, lexical_search, resampling, scan
from tallymart.llm.shared import KEY, NO_ID, id_back

FIRST = lambda i: NO_ID if i is None else i  # noqa: E731  null ids come first
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows_of_all_kinds():
    """The edge documents, rows given twice, an id with two texts, copies in other letter cases, and a text of more than a slice."""
    again = [(3, " ".join(lorem(1, 120))), (1, ""), (6, "another text under a used id"), (30, "same TEXT"), (31, "Same text"), (31, "same text"), (32, "sAME TEXT\n")]
    long = " ".join(lorem(9, 3000)) + " "
    return [*edge_documents(), *again, (40, long * 150), (41, long.upper() * 150), (42, "É" + "é"), (43, "é" + "é")]


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def documents(spark):
    return frame(spark, rows_of_all_kinds(), extra=[*CLASHING, "id", "h", "piece", "item", "rank", "row"]).cache()


# -- exact copies ----------------------------------------------------------------------------------------------------------------


def equal_texts(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(FIRST(i))
    out = []
    for text, ids in groups.items():
        for k, i in enumerate(sorted(ids, reverse=True)):
            most = max(ids)
            out.append((None if i == NO_ID else i, None if most == NO_ID else most, len(ids), k == 0, sha256(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pieces", [1, 50, 20_000])
def test_exact_copies(documents, monkeypatch, pieces):
    monkeypatch.setattr(exact_dedup, "PIECES", pieces)
    got = exact_dedup.exact_copies(documents).select("_row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == equal_texts(rows_of_all_kinds())


def test_rows_that_stay_keep_their_columns(documents, nothing):
    left = exact_dedup.without_copies(documents)
    assert left.columns == documents.columns
    assert left.count() == len({(t or "").translate(LOWER) for _, t in rows_of_all_kinds()})
    assert exact_dedup.exact_copies(nothing).count() == 0


def test_equal_hashes_do_not_make_equal_texts(spark, monkeypatch):
    """Texts that share their sort key, hash included, are told apart by their bytes."""
    real = exact_dedup.F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda c: exact_dedup.F.lit(7).cast("long") if isinstance(c, str) else real(c))
    same = "x" * 40
    rows = [(k, same + str(k % 3)) for k in range(30)]
    got = exact_dedup.exact_copies(frame(spark, rows)).select("_row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == equal_texts(rows)


def test_a_large_group_is_dealt_over_ranges(spark, tmp_path, monkeypatch):
    """No range of the sorted rows holds more than a small part of a group that has a third of all rows."""
    rows = [(k, "the same text" if k % 3 == 0 else f"text {k}") for k in range(3000)]
    path = str(tmp_path / "docs")
    frame(spark, rows).write.parquet(path)
    seen, real = [], exact_dedup.stored
    monkeypatch.setattr(exact_dedup, "stored", lambda df, name: seen.append(df) or real(df, name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert exact_dedup.exact_copies(spark.read.parquet(path)).where("kept").count() == 2001
        plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
        from pyspark.sql import functions as F

        sizes = [r["count"] for r in seen[-1].groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 1.4 * 3000 / len(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# -- resampling ------------------------------------------------------------------------------------------------------------------


def grams(text, longest=3):
    w = terms(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def drawn(rows, target, percent=5, least=20, buckets=10_000):
    found = [[g % buckets for g in grams(t)] for _, t in rows]
    s, t = Counter(b for x in found for b in x), Counter(b % buckets for _, x in target for b in grams(x))
    total = [sum(s.values()), sum(t.values())]
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1.0) * (total[0] + float(buckets))) / ((s[b] + 1.0) * (total[1] + float(buckets)))))
    out = []
    for (i, text), x in zip(rows, found, strict=True):
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x))
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(text)) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], FIRST(r[0])))
    for k, r in enumerate(able):
        r.append(k + 1 if k < percent * len(able) // 100 else None)
    return sorted((tuple(r[:4]) + (r[5] if len(r) > 5 else None,) for r in out), key=repr)


TARGET = [(1, " ".join(lorem(1, 40)) + " own words"), (2, None), (3, " ".join(lorem(2, 90)))]


@pytest.mark.parametrize(("percent", "samples", "segment"), [(5, 100_000, 20_000), (60, 8, 2), (100, 100, 1), (0, 100, 3)])
def test_resampling(spark, documents, monkeypatch, percent, samples, segment):
    monkeypatch.setattr(resampling, "SAMPLES", samples)
    monkeypatch.setattr(resampling, "SEGMENT", segment)
    target = frame(spark, TARGET, "item_id", extra=CLASHING)
    got = resampling.resampled(documents, target, percent).select(id_back(), "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(rows_of_all_kinds(), TARGET, percent)


def test_resampling_of_empty_tables(spark, documents, nothing):
    assert resampling.resampled(nothing, frame(spark, TARGET, "item_id")).count() == 0
    got = resampling.resampled(documents, nothing).select(id_back(), "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(rows_of_all_kinds(), [])


def test_ranks_among_ties(spark):
    """A third of the rows share score and id; ranks are unique, and segments split them."""
    rows = spark.range(900).selectExpr("IF(id % 3 = 0, 7, id) AS _k", "1L AS n_words", "2L AS n_features", "3L AS weight", "IF(id % 3 = 0, 50, id % 40) AS score", "true AS ranked", "id AS row")
    resampling.SEGMENT, kept = 20, resampling.SEGMENT
    try:
        got = resampling.highest(rows, 400, 900).where("rank IS NOT NULL").orderBy("rank").collect()
    finally:
        resampling.SEGMENT = kept
    assert [r["rank"] for r in got] == list(range(1, 401))
    assert [(-r.score, r[KEY]) for r in got] == sorted((-(50 if i % 3 == 0 else i % 40), 7 if i % 3 == 0 else i) for i in range(900))[:400]


def test_ngram_buckets_are_crcs():
    texts = ["One two THREE four", "", "é" * 700 + " b", None, "x"]
    for _, _, t in scan.slices(pa.array(texts)):
        _, doc, bucket = resampling.ngram_buckets(t, 3, 997)
        for i, text in enumerate(texts):
            assert sorted(bucket[doc == i].tolist()) == sorted(g % 997 for g in grams(text))


# -- lexical search --------------------------------------------------------------------------------------------------------------


def ranked(rows, items, top):
    docs = [(FIRST(i), Counter(terms(t))) for i, t in rows]
    sizes = [sum(c.values()) for _, c in docs]
    n, length, df = sum(s > 0 for s in sizes), sum(sizes), Counter(x for _, c in docs for x in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), size in zip(docs, sizes, strict=True):
            m = 100 - 75 + 75 * size * n // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m)) for x in terms(text) if x in c)
            if score > 0:
                scores.append((-score, i))
        out += [(item, k + 1, None if i == NO_ID else i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


ITEMS = [(1, " ".join(lorem(1, 30)) + " short SHORT lines"), (2, None), (3, "own words here and there, own words"), (3, "é" * 150), (None, " ".join(lorem(9, 200))), (5, "nothingthatisthere")]


@pytest.mark.parametrize(("top", "postings", "cells"), [(10, 2_000_000, 1 << 21), (3, 50, 40), (1, 60, 1)])
def test_search(spark, documents, monkeypatch, top, postings, cells):
    monkeypatch.setattr(lexical_search, "POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    got = lexical_search.search(documents, frame(spark, ITEMS, "item_id", extra=CLASHING), top).select("item_id", "rank", id_back(), "score")
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(rows_of_all_kinds(), ITEMS, top)


def test_search_in_empty_tables(spark, documents, nothing):
    items = frame(spark, ITEMS, "item_id")
    assert lexical_search.search(nothing, items).count() == 0
    assert lexical_search.search(documents, items.limit(0)).count() == 0


def test_heaps_are_bounded():
    heaps, rng = lexical_search.Heaps(3, 4), np.random.default_rng(2)
    rows = rng.integers(0, [3, 50, 1000], (500, 3))
    for part in np.array_split(rows, 9):
        heaps.offer(*part.T)
    best = [tuple(r) for i in range(3) for r in sorted(map(tuple, rows[rows[:, 0] == i]), key=lambda r: (-r[1], r[2]))[:4]]
    assert list(zip(heaps.item, heaps.score, heaps.key, strict=True)) == best
    assert heaps.least.tolist() == [best[3][1], best[7][1], best[11][1]]
