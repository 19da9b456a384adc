"""Logs that are compacted, and versions of months that count from one moment on."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, dimensions, rows, write_csv
from tallymart import ledger
from tallymart.logs import Log
from tallymart.plans import batch
from tallymart.plans.batch import Layout, Options, run_batch
from tallymart.schemas import CLOSED, IGNORED, LEDGER_EVENT, LOST, MANIFEST, OPEN, PUBLISHED, REJECTED, SETTLED
from tallymart.sinks import writers
from tallymart.sources.tables import read_store
from test_runs import LATE, MARCH, as_sales, expected, monthly

START = datetime(2024, 1, 1)


@pytest.fixture
def dims(spark):
    return dimensions(spark)


def random_events(spark, seed, count, start):
    """Events of few deliveries, some without a time and length, in order of time with ties."""
    pick = random.Random(seed)
    data = []
    for i in range(count):
        name = pick.choice("abcd")
        known = pick.random() < 0.8
        length = pick.choice([1, 2]) if known else None
        at = START + timedelta(seconds=start + i // 2)
        data.append((name, f"in/{name}", pick.choice("123"), at, pick.choice([OPEN, OPEN, CLOSED, LOST]), START if known else None, length))
    return spark.createDataFrame(data, LEDGER_EVENT)


@pytest.mark.parametrize("seed", [1, 2])
def test_a_compacted_ledger_answers_as_the_whole_one(spark, tmp_path, seed):
    path = str(tmp_path / "ledger")
    first, second = random_events(spark, seed, 60, 0), random_events(spark, seed + 10, 6, 100)
    ledger.append(first, path)
    assert ledger.compact(spark, path, 0) and not ledger.compact(spark, path, 0)
    assert ledger.read(spark, path).count() < 60
    ledger.append(second, path)
    whole = first.union(second)
    for chosen in ("true", "run_id != '1'", "run_id != '3'"):
        kept = ledger.read(spark, path).where(chosen)
        assert rows(ledger.latest(kept)) == rows(ledger.latest(whole.where(chosen)))
    assert rows(ledger.unfinished(ledger.read_open(spark, path))) == rows(ledger.unfinished(whole))
    assert ledger.compact(spark, path, 0)
    assert rows(ledger.latest(ledger.read(spark, path))) == rows(ledger.latest(whole))


def test_open_deliveries_are_read_without_the_ended_ones(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.append(random_events(spark, 5, 60, 0), path)
    ledger.compact(spark, path, 0)
    plan = ledger.read_open(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "part#" in plan


def test_a_compaction_that_dies_leaves_the_log_as_it_was(spark, tmp_path, monkeypatch):
    log = Log(spark, str(tmp_path / "log"), SETTLED)
    row = lambda name: spark.createDataFrame([(name, None, 1, REJECTED)], SETTLED)
    log.append(row("a"))
    log.start_next(log.read())
    log.append(row("b"))
    with monkeypatch.context() as patched:
        patched.setattr(spark, "range", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            log.start_next(log.read())
    assert log.generation() == 1 and [r[0] for r in rows(log.read())] == ["a", "b"]
    log.append(row("c"))
    for generation in (2, 3, 4):
        log.start_next(log.read().distinct())
        assert log.generation() == generation and log.tail().isEmpty()
        assert [r[0] for r in rows(log.read())] == ["a", "b", "c"]


def test_runs_over_compacted_logs_take_each_delivery_once(spark, dims, tmp_path):
    """Logs are compacted before every run; refused and ignored files stay known though no manifest is read again."""
    inbox, layout, options = tmp_path / "inbox", Layout(str(tmp_path / "out")), Options(compact_after=0)
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    write_csv(inbox / "bad.csv", HEADER[1:], [["x"] * 7])
    (inbox / "empty.csv").touch()
    run_batch(spark, str(inbox), dims, layout, run_id="1", options=options)
    layout.manifest = str(tmp_path / "elsewhere")
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    (second,) = run_batch(spark, str(inbox), dims, layout, run_id="2", options=options)
    assert (second.accepted, second.rejected) == (1, 0)
    assert read_store(spark, layout.manifest, MANIFEST).where(F.col("status") == IGNORED).isEmpty()
    assert Log(spark, layout.ledger, LEDGER_EVENT).generation() == 1
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


def test_settled_files_of_old_manifests_are_known(spark, dims, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    old = [("in/x.csv", "x.csv", START, 3, None, ["store_id"], status, "r") for status in (REJECTED, IGNORED, "accepted")]
    spark.createDataFrame(old, MANIFEST).write.parquet(writers.run_path(layout.manifest, "old"))
    assert [r[3] for r in rows(batch.settled(spark, layout).read())] == [IGNORED, REJECTED]


def test_a_publication_that_dies_changes_nothing_for_readers(spark, dims, tmp_path, monkeypatch):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    run_batch(spark, str(inbox), dims, layout, run_id="1")
    before = expected(spark, dims, MARCH)
    opened = batch.read_customer_monthly(spark, layout)
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    whole = writers.write_csv_report
    with monkeypatch.context() as patched:
        # Both marts have their new months by then, the report has not.
        patched.setattr(writers, "write_csv_report", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert writers.write_csv_report is whole
    assert monthly(spark, layout) == before
    assert batch.superseded_versions(spark, layout).isEmpty()
    run_batch_again(spark, inbox, dims, layout)
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)
    assert rows(opened) == before[0]
    only = batch.read_sales_person_monthly(spark, layout, ["2023-05"])
    assert {r.sales_month for r in only.collect()} == {"2023-05"}
    old = batch.superseded_versions(spark, layout).collect()
    versions = {r.version: r.published_at for r in Log(spark, layout.published, PUBLISHED).read().collect()}
    assert [r.version for r in old] == [min(versions, key=versions.get)]
    assert old[0].replaced_at == max(versions.values())


def run_batch_again(spark, inbox, dims, layout):
    """The dead run is done again; there is nothing else to do."""
    (again,) = run_batch(spark, str(inbox), dims, layout, run_id="3")
    assert again.run_id == "2"


def test_months_of_a_store_without_versions_are_all_published(spark, dims, tmp_path):
    """An installation from before versions has its months in the state; the next run publishes all of them."""
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales([*MARCH, (1, 121, 1, "", "3.00")]))
    run_batch(spark, str(inbox), dims, layout, run_id="1")
    layout.published = str(tmp_path / "elsewhere")
    assert batch.read_customer_monthly(spark, layout).isEmpty()
    batch.publish_months(spark, dims, layout, ["2023-03"])
    assert monthly(spark, layout) == expected(spark, dims, [*MARCH, (1, 121, 1, "", "3.00")])
