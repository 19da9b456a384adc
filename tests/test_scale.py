"""Plans at small size that show what happens to large or skewed data."""

import pytest
from pyspark.sql import functions as F

from fixtures import dimensions, rows, sales_frame
from tallymart.operators import joins, totals
from tallymart.plans import marts, star
from tallymart.sinks import writers

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def settings(spark):
    changed = []

    def put(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.append(name)
            spark.conf.set(name, value)

    yield put
    for name in changed:
        spark.conf.unset(name)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_the_mart_needs(spark):
    df = marts.sales_person_monthly(star.sales_keys(spark, FOLDER), star.dimensions(spark, FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in plan
    assert "p_name" not in plan and "Window" not in plan and "Python" not in plan


def test_totals_and_maxima_share_one_exchange(spark):
    df = marts.sales_person_monthly(star.sales_keys(spark, FOLDER), star.dimensions(spark, FOLDER))
    assert "ReusedExchange" in final_plan(df)


def skewed(spark):
    hot = spark.range(60000).select(F.lit(1).cast("long").alias("customer_id"), "id")
    cold = spark.range(60000, 180000).select((F.col("id") % 5000 + 10).alias("customer_id"), "id")
    return (
        hot.union(cold)
        .withColumn("total_cost", F.lit(1).cast("decimal(18,2)"))
        .withColumn("note", F.sha2(F.col("id").cast("string"), 512))
    )


def test_adaptive_execution_splits_a_hot_group(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
    )
    df = totals.with_group_total(skewed(spark), ["customer_id"], "total_cost", "month_total")
    plan = final_plan(df.agg(F.sum("month_total"), F.max("note")))
    assert "isSkew=true" in plan or "skewed" in plan


def test_hot_month_is_written_by_several_tasks(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="500KB")
    df = skewed(spark).withColumn("sales_month", F.when(F.col("customer_id") == 1, "2023-01").otherwise("2023-02"))
    writers.write_partitioned(df, str(tmp_path / "out"), ["sales_month"])
    assert len(list((tmp_path / "out" / "sales_month=2023-01").glob("*.parquet"))) > 1


def test_clustered_drops_are_written_without_a_shuffle(spark, tmp_path):
    # A shuffle would merge the twelve input partitions; without one each writes its own file.
    df = spark.range(0, 1200, 1, 12).withColumn("sales_month", F.lit("2023-01"))
    writers.write_partitioned(df, str(tmp_path / "a"), ["sales_month"], rebalance=False)
    assert len(list((tmp_path / "a").rglob("*.parquet"))) == 12


def test_hot_keys_are_bounded_and_only_they_are_broadcast(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    people = spark.range(6000).select(F.col("id").alias("customer_id"), F.lit("x").alias("first_name"))
    df = joins.join_hot_keys(skewed(spark), people, "customer_id", "customer_id", share=0.1)
    plan = final_plan(df.agg(F.count(F.lit(1)), F.max("note")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert df.count() == 180000


def test_broadcasts_off_give_the_same_marts(spark, settings):
    data = [(1, 121, 1, "2023-03-04", "1.00"), (2, 122, 2, "2023-03-05", "2.00"), (9, 121, 1, "2023-03-04", "5.00")]
    fact, dims = sales_frame(spark, data), dimensions(spark)
    wanted = rows(marts.sales_person_monthly(fact, dims)), rows(marts.customer_monthly(fact, dims))
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert (rows(marts.sales_person_monthly(fact, dims)), rows(marts.customer_monthly(fact, dims))) == wanted


@pytest.mark.parametrize("name", ["customer_line_totals", "sales_person_line_totals", "customer_monthly_sales_window", "sales_person_monthly_window"])
def test_totals_on_every_row_scan_the_fact_once(spark, monkeypatch, tmp_path, name):
    from tallymart import queries

    scans = []
    whole = writers.write_parquet

    def write(df, path):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet"))
        whole(df, path)

    monkeypatch.setattr(writers, "write_parquet", write)
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert scans == [1] and "lineitem" not in plan
