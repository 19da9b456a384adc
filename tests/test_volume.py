"""What a run moves: the sales that are shuffled, joined and written, at small size."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, dimensions, rows, sale, sales_frame, write_csv
from tallymart import queries, schemas
from tallymart.functions.columns import sales_month
from tallymart.operators import joins
from tallymart.plans import batch, marts, star
from tallymart.plans.batch import Layout
from tallymart.sinks import writers

FOLDER = "/root/testdata/sf0.001"
# Orphans and nulls of every key among known ones.
SALES = [
    (1, 121, 1, "2023-03-04", "1.00"),
    (1, 121, 1, "2023-03-04", "1.00"),
    (2, 122, 3, "2023-03-05", "2.00"),
    (9, 121, 1, "2023-03-04", "5.00"),
    (1, 999, 1, "2023-03-04", "6.00"),
    (1, 121, 99, "2023-04-04", "7.00"),
    (None, 121, 1, "2023-03-04", "8.00"),
    (1, None, 1, "2023-03-04", "9.00"),
    (1, 121, None, "2023-03-04", "10.00"),
    (3, 121, 4, None, None),
]


@pytest.fixture
def dims(spark):
    return dimensions(spark)


def found_unknown(sales, dims):
    keys = marts.unknown_keys(sales, dims)
    kinds = {r.dimension for r in keys.collect()}
    return {kind: keys.where(F.col("dimension") == kind).select("unknown_key") for kind in kinds}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_unknown_keys_are_named_once_and_nulls_are_none(spark, dims):
    assert rows(marts.unknown_keys(sales_frame(spark, SALES), dims)) == [("customer", 9), ("store", 999), ("team", 99)]


@pytest.mark.parametrize("data", [SALES, SALES[:3], []])
def test_leaving_out_unknown_keys_is_looking_up_all(spark, dims, data):
    sales = sales_frame(spark, data)
    unknown, all_of = found_unknown(sales, dims), marts.enriched(sales, dims)
    assert rows(marts.customer_details(sales, dims, unknown)) == rows(marts.customer_mart(all_of))
    assert rows(marts.customer_details(sales, dims, unknown, 0.1)) == rows(marts.customer_mart(all_of))
    assert rows(marts.sales_details(sales, dims, unknown)) == rows(marts.sales_mart(all_of))
    for make in (marts.customer_monthly, marts.sales_person_monthly):
        assert rows(make(sales, dims, unknown)) == rows(make(sales, dims))


def test_where_all_keys_are_known_a_sale_meets_only_what_a_mart_shows(spark, dims):
    sales = sales_frame(spark, SALES[:3])
    assert plan(marts.customer_details(sales, dims, {})).count("Join ") == 1
    assert plan(marts.sales_details(sales, dims, {})).count("Join ") == 2


def test_the_state_is_dealt_once_by_month_and_share_and_summed_there(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "in" / "a.csv", HEADER, [sale(c, s, p, d or "", t or "") for c, s, p, d, t in SALES])
    monkeypatch.setattr(batch, "STATE_ROWS", 2)
    layout, plans = Layout(str(tmp_path / "out")), {}
    whole = writers.write_partitioned

    def write(df, path, by, **how):
        plans[path] = df._jdf.queryExecution().executedPlan().toString(), how.get("rebalance", True)
        whole(df, path, by, **how)

    monkeypatch.setattr(writers, "write_partitioned", write)
    batch.run_batch(spark, f"file:{tmp_path}/in", dimensions(spark), layout, run_id="1")
    text, again = plans[layout.month_state]
    assert text.count("Exchange") == 1 and not again
    state = spark.read.parquet(layout.month_state)
    assert state.count() == len(SALES) - 1  # one key twice
    assert state.agg(F.sum("total_cost")).first()[0] == 49


def test_a_months_facts_lie_by_store_and_seller_in_compact_files(spark, tmp_path):
    out_of_order = [sale(1, store, person, "2023-03-04", "1.00") for person in (3, 1, 2) for store in (122, 121)]
    write_csv(tmp_path / "in" / "a.csv", HEADER, out_of_order)
    layout = Layout(str(tmp_path / "out"))
    batch.run_batch(spark, f"file:{tmp_path}/in", dimensions(spark), layout, run_id="1")
    (file,) = (tmp_path / "out" / "fact").rglob("*.parquet")
    keys = [(r.store_id, r.sales_person_id) for r in spark.read.parquet(str(file)).collect()]
    assert keys == sorted(keys) and file.name.endswith(".zstd.parquet")


def test_dimensions_are_broadcast_up_to_a_counted_number_of_rows(spark, monkeypatch):
    team = spark.range(5)
    assert "broadcast" in plan(joins.broadcast_small(team).join(team, "id")).lower()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 4)
    assert joins.broadcast_small(team) is team


def test_lines_of_corrected_files_are_joined_once(spark, monkeypatch):
    joined = []
    drop = queries._drop
    monkeypatch.setattr(queries, "_drop", lambda df, path: joined.append("lineitem" in df._jdf.queryExecution().executedPlan().toString()) or drop(df, path))
    queries.refused_then_corrected(spark, FOLDER)
    assert joined.count(True) == 2 and len(joined) == 3


@pytest.mark.parametrize("rows, customers, shuffles", [(100, 3, 0), (1, 3, 1), (100, 1, 1)])
def test_marts_that_lie_by_month_are_not_shuffled_again(spark, tmp_path, monkeypatch, rows, customers, shuffles):
    """Neither the sales mart by month nor the report, but for months of many files and sales that a join has to leave out."""
    sold = [sale(c, 121, p, f"2023-0{m}-04", "1.00") for c in (1, 2) for p in (1, 2) for m in (3, 5)]
    write_csv(tmp_path / "in" / "a.csv", HEADER, sold)
    monkeypatch.setattr(batch, "STATE_ROWS", rows)
    layout, plans = Layout(str(tmp_path / "out")), {}
    dims = dimensions(spark)
    dims = replace(dims, customer=dims.customer.where(F.col("customer_id") <= customers))
    whole, report = writers.write_partitioned, writers.write_csv_report
    text = lambda df, again: df._jdf.queryExecution().executedPlan().toString().count("Exchange") + again

    def write(df, path, by, **how):
        plans[path] = text(df, how.get("rebalance", True))
        whole(df, path, by, **how)

    def write_report(df, path, by, rebalance=True):
        plans["report"] = text(df, rebalance)
        report(df, path, by, rebalance)

    monkeypatch.setattr(writers, "write_partitioned", write)
    monkeypatch.setattr(writers, "write_csv_report", write_report)
    batch.run_batch(spark, f"file:{tmp_path}/in", dims, layout, run_id="1")
    by_month = f"{layout.sales_mart_by_month}/run_id=1"
    assert plans["report"] == 0 and plans[by_month] == shuffles
    columns = [c for c in schemas.SALES_MART.names if c != "sales_month"]
    found = [sorted(map(str, spark.read.parquet(p).select(*columns).collect())) for p in (by_month, f"{layout.sales_mart}/run_id=1")]
    assert found[0] == found[1] and len(found[0]) == (8 if customers == 3 else 4)


def test_few_suppliers_are_joined_last_without_a_shuffle(spark):
    """Lines are shuffled for their orders and parts only, whatever Spark would broadcast by itself, and without the supplier's column."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = star.sales_lines(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 4 and text.count("BroadcastExchange") == 1
    assert text.index("BroadcastHashJoin") < text.index("SortMergeJoin")


def test_the_text_of_the_month_is_not_shuffled_for_the_state(spark):
    fact = sales_frame(spark, SALES).withColumns({"sales_month": sales_month(F.col("sales_date")), "ingest_batch": F.lit("1")})
    state = marts.month_state(fact, 2)
    optimized = state._jdf.queryExecution().optimizedPlan().toString()
    below = optimized[optimized.index("RepartitionByExpression") :]
    assert "sales_month" not in below.partition("LogicalRDD")[0].partition("LocalRelation")[0]
    assert {(r.sales_month, r.sales_date) for r in state.collect()} == {
        (r.sales_month, r.sales_date and r.sales_date.replace(day=1)) for r in fact.collect()
    }
