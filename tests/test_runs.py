import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, dimensions, rows, sale, sales_frame, write_csv
from tallymart import ledger, schemas
from tallymart.errors import NoCsvFiles, NoSourceFiles, NoValidFiles, UnfinishedRun
from tallymart.plans import batch, marts
from tallymart.__main__ import main
from tallymart.plans.batch import Database, Layout, Options, run_batch
from tallymart.sinks import writers
from tallymart.sources.tables import read_bad_rows, read_fact, read_store
from tallymart.streaming.incremental import ingest_available

D = Decimal
MARCH = [
    (1, 121, 1, "2023-03-04", "100.50"),
    (2, 121, 2, "2023-03-05", "100.50"),
    (1, 121, 3, "2023-03-31", "50.00"),
    (3, 122, 4, "2023-03-09", "9.00"),
]
MOST_JOBS = 60
LATE = [(2, 121, 3, "2023-03-30", "70.00"), (2, 121, 1, "2023-05-01", "5.00")]


def as_sales(data):
    return [sale(c, s, p, d, t) for c, s, p, d, t in data]


@pytest.fixture
def dims(spark):
    return dimensions(spark)


def monthly(spark, layout):
    return (
        rows(batch.read_customer_monthly(spark, layout)),
        rows(batch.read_sales_person_monthly(spark, layout)),
    )


def expected(spark, dims, data):
    data = [(c, s, p, d or None, t) for c, s, p, d, t in data]
    fact = sales_frame(spark, data)
    customers = marts.customer_monthly(fact, dims).select(*schemas.CUSTOMER_MONTHLY.names)
    sellers = marts.sales_person_monthly(fact, dims).select(*schemas.SALES_PERSON_MONTHLY.names)
    return rows(customers), rows(sellers)


def test_batch_run_publishes_everything(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH[:2]))
    write_csv(inbox / "sub" / "a.csv", [*HEADER, "payment_mode"], [[*r, "cash"] for r in as_sales(MARCH[2:])])
    write_csv(inbox / "bad.csv", [*HEADER[:1], *HEADER[2:]], [["x"] * 7])
    write_csv(inbox / "q.csv", HEADER, [["q", *as_sales(MARCH)[0][1:]]])
    (inbox / "notes.txt").write_text("hi")
    before = sorted(p for p in inbox.rglob("*"))
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="r1")
    assert (result.accepted, result.rejected, result.bad_rows, result.months) == (3, 2, 1, ("2023-03",))
    assert sorted(p for p in inbox.rglob("*")) == before
    assert monthly(spark, layout) == expected(spark, dims, MARCH)
    assert read_fact(spark, layout.fact).count() == 4
    (bad,) = read_bad_rows(spark, layout.fact).collect()
    assert bad.source_file.endswith("/q.csv") and bad.unparsed_line.startswith("q,121")
    lines = spark.read.parquet(layout.error_files + "/run_id=r1").collect()
    assert [r.line for r in lines if r.source_file.endswith("bad.csv")][1] == ",".join(["x"] * 7)
    state = ledger.latest(ledger.read(spark, layout.ledger)).collect()
    assert {r.status for r in state} == {"I"} and len(state) == 3
    assert all(r.updated_date >= r.created_date for r in state)
    detail = read_store(spark, layout.sales_mart + "/run_id=r1", schemas.SALES_MART)
    by_month = read_store(spark, layout.sales_mart_by_month + "/run_id=r1", schemas.SALES_MART)
    assert rows(detail) == rows(by_month.select(*detail.columns)) == rows(
        marts.sales_mart(marts.enriched(sales_frame(spark, MARCH), dims))
    )
    assert os.path.isdir(layout.sales_mart_by_month + "/run_id=r1/sales_month=2023-03/store_id=121")
    assert spark.read.parquet(layout.customer_mart).count() == 4
    report = spark.read.option("header", True).csv(layout.report)
    assert {(r.sales_person_name, r.total_incentive) for r in report.collect()} == {
        ("Ada Quist", "1.01"), ("Bo Rask", "1.01"), ("Cleo Sand", "0.00"), (None, "0.09"),
    }


def test_next_run_takes_only_new_files_and_recomputes_late_months(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    run_batch(spark, str(inbox), dims, layout, run_id="1")
    with pytest.raises(NoSourceFiles):
        run_batch(spark, str(inbox), dims, layout, run_id="2")
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="3")
    assert sorted(result.months) == ["2023-03", "2023-05"]
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


def test_a_late_file_reads_its_own_sales_and_the_state(spark, dims, tmp_path, monkeypatch):
    """Months that earlier batches have sales in are made of sums; sales of earlier batches are not read again."""
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    run_batch(spark, str(inbox), dims, layout, run_id="1")
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    read = {}
    source_files_of = lambda df: [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
    for name in ("month_state", "customer_monthly", "sales_person_monthly"):
        made = getattr(marts, name)
        monkeypatch.setattr(marts, name, lambda df, *more, made=made, name=name: read.update({name: source_files_of(df)}) or made(df, *more))
    run_batch(spark, str(inbox), dims, layout, run_id="2")
    monkeypatch.undo()
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)
    assert read["month_state"] and all("/fact/" in f and "ingest_batch=2" in f for f in read["month_state"])
    assert all("/month_state/" in f for name in ("customer_monthly", "sales_person_monthly") for f in read[name])
    assert {f.split("ingest_batch=")[1][0] for f in read["customer_monthly"]} == {"1", "2"}


def test_the_state_is_made_of_all_batches_where_there_is_none(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    run_batch(spark, str(inbox), dims, layout, run_id="1")
    layout.month_state = str(tmp_path / "another place")
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)
    batch.update_month_state(spark, layout, "2")  # again: nothing is added twice
    batch.publish_months(spark, dims, layout, ["2023-03", "2023-05"])
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


def test_crashed_run_is_resumed_under_its_own_id(spark, dims, tmp_path, monkeypatch):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    (inbox / "notes.txt").write_text("hi")

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "publish_details", crash)
    with pytest.raises(RuntimeError):
        run_batch(spark, str(inbox), dims, layout, run_id="1")
    monkeypatch.undo()
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    events = ledger.read(spark, layout.ledger)
    from tallymart.sources.files import list_files

    left = ledger.left_behind(list_files(spark, str(inbox)), events).collect()
    assert [r.file_name for r in left] == ["a.csv"]
    with pytest.raises(UnfinishedRun):
        run_batch(spark, str(inbox), dims, layout, on_unfinished="fail")
    first, second = run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert (first.run_id, first.accepted, second.run_id, second.accepted) == ("1", 1, "2", 1)
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)
    assert ledger.unfinished(ledger.read(spark, layout.ledger)).isEmpty()


def test_runs_without_usable_files_stop(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    inbox.mkdir()
    with pytest.raises(NoSourceFiles):
        run_batch(spark, str(inbox), dims, layout)
    (inbox / "notes.txt").write_text("hi")
    with pytest.raises(NoCsvFiles):
        run_batch(spark, str(inbox), dims, layout)
    write_csv(inbox / "bad.csv", HEADER[1:], [])
    with pytest.raises(NoValidFiles):
        run_batch(spark, str(inbox), dims, layout)
    write_csv(inbox / "header.csv", HEADER, [])
    (result,) = run_batch(spark, str(inbox), dims, layout)
    assert (result.accepted, result.rejected, result.months) == (1, 0, ())


def test_stream_takes_each_file_once(spark, dims, tmp_path):
    inbox, layout, checkpoint = tmp_path / "inbox", Layout(str(tmp_path / "out")), str(tmp_path / "ck")
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH[:2]))
    write_csv(inbox / "b.csv", HEADER, as_sales(MARCH[2:]))
    ingest_available(spark, str(inbox), dims, layout, checkpoint)
    done = monthly(spark, layout)
    assert done == expected(spark, dims, MARCH)
    ingest_available(spark, str(inbox), dims, layout, checkpoint)
    assert monthly(spark, layout) == done
    (inbox / "notes.txt").write_text("hi")
    ingest_available(spark, str(inbox), dims, layout, checkpoint)
    write_csv(inbox / "c.csv", HEADER, as_sales(LATE))
    ingest_available(spark, str(inbox), dims, layout, checkpoint)
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)
    assert read_fact(spark, layout.fact).count() == 6
    runs = {r.run_id for r in ledger.latest(ledger.read(spark, layout.ledger)).collect()}
    assert len(runs) == 2 and all("-" in r for r in runs)


def test_replayed_micro_batch_changes_nothing(spark, dims, tmp_path):
    inbox, layout, checkpoint = tmp_path / "inbox", Layout(str(tmp_path / "out")), tmp_path / "ck"
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    ingest_available(spark, str(inbox), dims, layout, str(checkpoint))
    done = monthly(spark, layout)
    for commit in (checkpoint / "commits").iterdir():
        commit.unlink()
    ingest_available(spark, str(inbox), dims, layout, str(checkpoint))
    assert monthly(spark, layout) == done
    assert read_fact(spark, layout.fact).count() == 4


def test_order_and_split_of_files_do_not_matter(spark, dims, tmp_path):
    extended = [*HEADER, "payment_mode"]
    shuffled = ["payment_mode", *reversed(HEADER)]
    rows_of = as_sales(MARCH + LATE)
    drops = {
        "one": [("a.csv", HEADER, rows_of)],
        "many": [(f"{9 - i}.csv", HEADER, [r]) for i, r in enumerate(rows_of)],
        "mixed": [
            ("z.csv", extended, [[*r, "cash"] for r in rows_of[:3]]),
            ("b/a.csv", shuffled, [["UPI", *reversed(r)] for r in rows_of[3:]]),
        ],
    }
    results = []
    for name, parts in drops.items():
        for file, header, data in parts:
            write_csv(tmp_path / name / file, header, data)
        layout = Layout(str(tmp_path / f"out_{name}"))
        run_batch(spark, str(tmp_path / name), dims, layout)
        results.append(monthly(spark, layout))
    assert results[0] == results[1] == results[2] == expected(spark, dims, MARCH + LATE)


def test_sales_without_a_date_form_a_month_of_their_own(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    undated = [(1, 121, 1, "", "3.00"), (1, 121, 2, "", "4.00")]
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH + undated[:1]))
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="1")
    assert set(result.months) == {"2023-03", None} and result.bad_rows == 0
    write_csv(inbox / "b.csv", HEADER, as_sales(undated[1:]))
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert result.months == (None,)
    assert monthly(spark, layout) == expected(spark, dims, MARCH + undated)


def test_clustered_drops_give_the_same_marts(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH + LATE))
    run_batch(spark, str(inbox), dims, layout, options=Options(clustered_drops=True))
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


def test_database_receives_the_months_of_the_run(spark, dims, tmp_path, monkeypatch):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    calls = {}
    monkeypatch.setattr(writers, "write_jdbc", lambda df, url, table, props, mode: calls.update({table: (rows(df), mode)}))
    options = Options(database=Database("jdbc:x", {}))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH + LATE))
    run_batch(spark, str(inbox), dims, layout, options=options)
    assert set(calls) == {"customers_data_mart_staging", "sales_team_data_mart_staging"}
    assert {len(r) for r, _ in calls.values()} == {4, 5} and {m for _, m in calls.values()} == {"overwrite"}
    write_csv(inbox / "b.csv", HEADER, as_sales([(1, 121, 1, "2023-05-09", "1.00")]))
    run_batch(spark, str(inbox), dims, layout, options=options)
    assert {str(r[4]) for r in calls["customers_data_mart_staging"][0]} == {"2023-05-01"}
    assert {r[3] for r in calls["sales_team_data_mart_staging"][0]} == {"2023-05"}


def set_time(path, days):
    then = os.stat(path).st_mtime + days * 86400
    os.utime(path, (then, then))


def test_stream_takes_files_with_an_old_time(spark, dims, tmp_path):
    inbox, layout, checkpoint = tmp_path / "inbox", Layout(str(tmp_path / "out")), str(tmp_path / "ck")
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    ingest_available(spark, str(inbox), dims, layout, checkpoint)
    set_time(write_csv(inbox / "b.csv", HEADER, as_sales(LATE)), -30)
    ingest_available(spark, str(inbox), dims, layout, checkpoint)
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


@pytest.mark.parametrize("stream", [False, True])
def test_new_content_under_an_old_path_is_taken(spark, dims, tmp_path, stream):
    inbox, layout, checkpoint = tmp_path / "inbox", Layout(str(tmp_path / "out")), str(tmp_path / "ck")

    def take():
        if stream:
            ingest_available(spark, str(inbox), dims, layout, checkpoint)
        else:
            run_batch(spark, str(inbox), dims, layout)

    write_csv(inbox / "ok.csv", HEADER, as_sales(MARCH))
    write_csv(inbox / "fix.csv", HEADER[1:], [r[1:] for r in as_sales(LATE[:1])])
    take()
    set_time(write_csv(inbox / "ok.csv", HEADER, as_sales(LATE[1:])), 5)
    set_time(write_csv(inbox / "fix.csv", HEADER, as_sales(LATE[:1])), 5)
    take()
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


def test_refused_text_is_kept_when_a_run_dies_before_its_manifest(spark, dims, tmp_path, monkeypatch):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "bad.csv", HEADER[1:], [["x"] * 7])
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    whole = writers.write_parquet

    def dies(df, path):
        if path.startswith(layout.error_files):
            raise RuntimeError("lost")
        whole(df, path)

    monkeypatch.setattr(writers, "write_parquet", dies)
    with pytest.raises(RuntimeError):
        run_batch(spark, str(inbox), dims, layout, run_id="1")
    monkeypatch.undo()
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert (result.accepted, result.rejected) == (1, 1)
    assert ",".join(["x"] * 7) in {r.line for r in spark.read.parquet(layout.error_files).collect()}


def test_a_missed_header_is_noticed_before_anything_is_recorded(spark, dims, tmp_path, monkeypatch):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    right = batch.source_files.header_lines
    monkeypatch.setattr(batch.source_files, "header_lines", lambda *a, **k: right(*a, **k).where("false"))
    with pytest.raises(RuntimeError, match="missed a header"):
        run_batch(spark, str(inbox), dims, layout, run_id="1")
    monkeypatch.undo()
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert result.accepted == 1
    assert monthly(spark, layout) == expected(spark, dims, MARCH)


def test_vanished_files_of_a_dead_run_do_not_stop_later_runs(spark, dims, tmp_path, monkeypatch):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    gone = write_csv(inbox / "gone.csv", HEADER, as_sales(MARCH[:2]))

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "ingest", crash)
    with pytest.raises(RuntimeError):
        run_batch(spark, str(inbox), dims, layout, run_id="1")
    monkeypatch.undo()
    gone.unlink()
    write_csv(inbox / "b.csv", HEADER, as_sales(MARCH[2:]))
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert result.accepted == 1
    state = {r.file_name: r.status for r in ledger.latest(ledger.read(spark, layout.ledger)).collect()}
    assert state == {"gone.csv": "L", "b.csv": "I"}
    write_csv(inbox / "gone.csv", HEADER, as_sales(MARCH[:2]))
    run_batch(spark, str(inbox), dims, layout, run_id="3")
    assert monthly(spark, layout) == expected(spark, dims, MARCH)


def test_runs_keep_bounded_lists_of_paths(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "0.csv", HEADER[1:], [])
    for i, row in enumerate(as_sales(MARCH + LATE)):
        write_csv(inbox / f"{i + 1}.csv", [*HEADER, f"extra{i}"], [[*row, "x"]])
    results = run_batch(spark, str(inbox), dims, layout, run_id="r", options=Options(files_per_run=3))
    assert [(r.run_id, r.accepted, r.rejected) for r in results] == [("r", 2, 1), ("r.1", 3, 0), ("r.2", 1, 0)]
    assert monthly(spark, layout) == expected(spark, dims, MARCH + LATE)


def test_a_run_takes_few_jobs(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    run_batch(spark, str(inbox), dims, layout)
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    spark.sparkContext.setJobGroup("counted", "one small new file")
    try:
        run_batch(spark, str(inbox), dims, layout)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) <= MOST_JOBS


def test_command_line(spark, dims, tmp_path):
    inbox, base, tables = tmp_path / "inbox", tmp_path / "out", tmp_path / "dims"
    for name, df in (("customer", dims.customer), ("store", dims.store), ("sales_team", dims.team)):
        df.write.parquet(str(tables / name))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    common = ["--inbox", str(inbox), "--base", str(base), "--dimensions", str(tables)]
    main(["batch", *common])
    write_csv(inbox / "b.csv", HEADER, as_sales(LATE))
    main(["stream", *common, "--checkpoint", str(tmp_path / "ck")])
    # The stream saw a.csv too, and passed it over: a run had closed it.
    assert monthly(spark, Layout(str(base))) == expected(spark, dims, MARCH + LATE)
    with pytest.raises(SystemExit):
        main(["stream", *common])


def test_dimensions_from_a_database_are_copied_once(spark, dims, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    from tallymart.plans.load import dimensions_from_jdbc

    frames, calls = {"customer": dims.customer, "store": dims.store, "sales_team": dims.team}, []

    def jdbc(self, **kw):
        calls.append(kw)
        return frames[kw["table"]]

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    got = dimensions_from_jdbc(spark, "jdbc:x", {}, str(tmp_path / "copy"), {"customer": ("customer_id", 1, 9, 3)})
    assert rows(got.team) == rows(dims.team) and rows(got.customer) == rows(dims.customer)
    assert [c.get("numPartitions") for c in calls] == [3, None, None]


def test_large_dimensions_are_joined_once(spark, dims, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "out"))
    write_csv(inbox / "a.csv", HEADER, as_sales(MARCH))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run_batch(spark, str(inbox), dims, layout)
        assert monthly(spark, layout) == expected(spark, dims, MARCH)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ledger_states(spark):
    files = spark.createDataFrame([("a.csv", "x/a.csv"), ("a.csv", "y/a.csv"), ("b.csv", "x/b.csv")], "file_name string, file_location string")
    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    first = files.where("file_location != 'x/b.csv'")
    events = (
        ledger.open_events(first, "1", t[0])
        .union(ledger.close_events(first, "1", t[0]))
        .union(ledger.open_events(files.where("file_location = 'y/a.csv'"), "2", t[1]))
    )
    state = {r.file_location: r for r in ledger.latest(events).collect()}
    assert (state["x/a.csv"].status, state["x/a.csv"].updated_date) == ("I", t[0])
    assert (state["y/a.csv"].status, state["y/a.csv"].created_date, state["y/a.csv"].updated_date) == ("A", t[1], None)
    assert rows(ledger.unprocessed(files, events).select("file_location")) == [("x/b.csv",), ("y/a.csv",)]
    assert rows(ledger.left_behind(files, events).select("file_location")) == [("y/a.csv",)]


def test_partition_filters_reach_the_scan(spark, dims, tmp_path):
    sales = marts.sales_mart(marts.enriched(sales_frame(spark, MARCH + LATE), dims))
    path = str(tmp_path / "mart")
    writers.write_partitioned(sales, path, ["sales_month", "store_id"])
    df = read_store(spark, path, schemas.SALES_MART).where("sales_month = '2023-05' AND store_id = 121")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan
    assert df.count() == 1


def test_database_rows_and_calls(spark, dims, monkeypatch):
    fact = sales_frame(spark, MARCH)
    customers = writers.customer_table_rows(marts.customer_monthly(fact, dims))
    assert dict(customers.dtypes)["sales_date_month"] == "date"
    assert str(customers.first().sales_date_month) == "2023-03-01"
    sellers = marts.sales_person_monthly(fact, dims)
    calls = []
    from pyspark.sql import DataFrameReader, DataFrameWriter

    from tallymart.sources.tables import read_jdbc

    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **kw: calls.append(kw))
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, **kw: calls.append(kw))
    writers.write_jdbc(sellers, "jdbc:x", "t", {"user": "u"})
    read_jdbc(spark, "jdbc:x", "customer", {"user": "u"}, "customer_id", 1, 100, 4)
    read_jdbc(spark, "jdbc:x", "store", {"user": "u"})
    assert calls[0] == {"url": "jdbc:x", "table": "t", "mode": "append", "properties": {"user": "u"}}
    assert calls[1]["numPartitions"] == 4 and calls[1]["column"] == "customer_id"
    assert "column" not in calls[2]
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", "customer", {}, "customer_id")
