"""What the Jaccard join does inside: leaders of buckets, blocks of large groups, and rows that are repeated."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, lorem
from pyspark.sql import functions as F
from test_documents import by_id, expected, groups, near_copies

from tallymart.llm import jaccard


@pytest.mark.parametrize("size", [1, 7, 400])
def test_leaders(size):
    """Rows stay that have another of fitting size next to them; each names the first row of its bucket. Batches of any size give the same."""
    rng = np.random.default_rng(size)
    rows = np.array(sorted({tuple(r) for r in rng.integers([0, 1, 0], [60, 40, 9], (400, 3)).tolist()}), np.int64)
    columns = [pa.array(rows[:, 0]), pa.array(rows[:, 2] + 100 * np.arange(len(rows))), pa.array(rows[:, 1].astype(np.int32)), pa.array(np.zeros(len(rows), np.int32))]
    whole = pa.RecordBatch.from_arrays(columns, schema=jaccard.POSTING)
    out = pa.Table.from_batches(jaccard._led(80)(iter([whole.slice(i, size) for i in range(0, len(rows), size)])))
    wanted = []
    for token in np.unique(rows[:, 0]):
        at = np.flatnonzero(rows[:, 0] == token)
        for k in at:
            if any(j != k and 100 * min(rows[j, 1], rows[k, 1]) >= 80 * max(rows[j, 1], rows[k, 1]) for j in at):
                wanted.append((columns[1][at[0]].as_py(), columns[1][k].as_py()))
    assert sorted(zip(out.column("leader").to_pylist(), out.column("cid").to_pylist(), strict=True)) == sorted(wanted)


@pytest.mark.parametrize("block", [2, 5])
def test_blocks_of_large_groups(spark, monkeypatch, block):
    """Groups dealt in many blocks by size give every link."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(3, 24, 4) + near_copies(4, 9, 2)
    rows += [(100 + i, " ".join(lorem(5, 60 + 4 * i))) for i in range(12)]
    for every in (True, False):
        assert by_id(jaccard.similar(frame(spark, rows), every_link=every).rows, "n_shingles", "component") == expected(groups(rows))


def test_blocks_meet_where_sizes_allow(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    n = [int(10 * 1.03**k) for k in range(60)]
    rows = spark.createDataFrame([(1, k, x, 0, k) for k, x in enumerate(n)], "leader long, cid long, n int, pos int, comp long")
    parts = {}
    for r in jaccard._blocks(rows, 80).collect():
        parts.setdefault(r.part, []).append(r.cid)
    met = {(a, b) for p in parts.values() for a in p for b in p if a < b}
    assert {(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * n[a] >= 80 * n[b]} <= met
    assert all(100 * n[a] >= 60 * n[b] for a, b in met)


@pytest.mark.parametrize("every", [True, False])
def test_repeated_rows_cost_no_postings(spark, monkeypatch, every):
    """Rows equal in id and text: postings and texts do not grow with their number, and results are equal."""
    (_, a), (_, b) = near_copies(7, 2, 1)
    kept, seen = jaccard.stored, {}

    def spy(df, name):
        out = kept(df, name)
        seen.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", spy)
    sizes = []
    for copies in (1, 60):
        seen.clear()
        rows = [(1, a), (2, b)] * copies + [(3, a)]
        found = jaccard.similar(frame(spark, rows), every_link=every)
        assert by_id(found.rows, "n_shingles", "component") == expected(groups(rows))
        sizes.append({k: v for k, v in seen.items() if k not in ("op5-profiles", "op5-repeated")})
    assert sizes[0] == sizes[1]


def test_one_of_repeated_rows_stays(spark):
    """Of rows equal in id and text that differ elsewhere, the same one stays, however the table is dealt."""
    text = " ".join(lorem(1, 80))
    rows = [(1, text, f"source {k}") for k in range(6)] + [(2, text, "x"), (3, None, "y"), (3, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [sorted(map(str, jaccard.one_of_each_group(df.repartition(n)).collect())) for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 2


def test_rarity_counts_all_tasks(spark):
    """Levels follow the summed counters: a shingle of many texts has a higher level than those of one."""
    rows = [(i, " ".join(["five words that all have", *lorem(i + 1, 30)])) for i in range(300)]
    made = jaccard.keyed(frame(spark, rows)).mapInArrow(jaccard._profiles(5), jaccard.PROFILE_SQL)
    levels = jaccard.rarity(made.where(F.col("n") == jaccard.SKETCH))
    assert len(levels) == 1 << jaccard.SLOT_BITS
    for _, _, texts in jaccard.scan.slices(pa.array([rows[0][1]])):
        found = levels[jaccard.slots(jaccard.sets_of(texts, 5).hashes)]
    assert (found == found.max()).sum() == 1
