from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import dimensions, rows, sales_frame
from tallymart.errors import DuplicateKeys
from tallymart.operators import joins, ranking, totals
from tallymart.plans import marts
from tallymart.sources.tables import require_unique_keys

D = Decimal
SALES = [
    (1, 121, 1, "2023-03-04", "100.50"),
    (2, 121, 2, "2023-03-05", "100.00"),
    (2, 121, 2, "2023-03-06", "0.50"),
    (1, 121, 3, "2023-03-31", "50.00"),
    (1, 122, 4, "2023-03-01", None),
    (1, 121, 3, "2023-04-01", None),
    (3, 121, 1, "2023-04-02", "10.00"),
    (2, 122, 1, None, "7.00"),
    (99, 121, 1, "2023-03-04", "1000.00"),
    (1, 999, 1, "2023-03-04", "1000.00"),
    (1, 121, 77, "2023-03-04", "1000.00"),
    (None, 121, 1, "2023-03-04", "1000.00"),
]


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


@pytest.fixture(scope="module")
def fact(spark):
    return sales_frame(spark, SALES)


def test_star_join_drops_unknown_keys_and_has_unique_names(fact, dims):
    sales = marts.enriched(fact, dims)
    assert sales.count() == 8
    assert len(set(sales.columns)) == len(sales.columns)
    row = sales.where("sales_person_id = 2").first()
    assert (row.first_name, row.sales_person_first_name, row.store_manager_name) == ("Jonas", "Bo", "Osman")


def test_incentive_goes_to_every_tied_top_seller(fact, dims):
    got = {
        (r.store_id, r.sales_person_id, r.sales_month): r for r in marts.sales_person_monthly(fact, dims).collect()
    }
    assert got[121, 1, "2023-03"].incentive == D("1.01")
    assert got[121, 2, "2023-03"].incentive == D("1.01")
    assert got[121, 3, "2023-03"].incentive == D("0.00")
    # All costs null: the total is null and ranks last, or first when alone.
    assert (got[121, 3, "2023-04"].total_sales, got[121, 3, "2023-04"].incentive) == (None, D("0.00"))
    assert (got[122, 4, "2023-03"].total_sales, got[122, 4, "2023-03"].incentive) == (None, None)
    assert got[122, 4, "2023-03"].full_name is None
    assert got[122, 1, None].incentive == D("0.07")
    assert len(got) == 7


def window_form(mart):
    """The month total as SQL with a window."""
    return mart.sparkSession.sql(
        """
        SELECT DISTINCT customer_id, concat(first_name, ' ', last_name) AS full_name, address, phone_number,
               date_format(sales_date, 'yyyy-MM') AS sales_date_month,
               cast(sum(total_cost) OVER (PARTITION BY customer_id, date_format(sales_date, 'yyyy-MM'))
                    AS decimal(18,2)) AS total_sales
        FROM {mart}
        """,
        mart=mart,
    )


def test_customer_totals_equal_the_window_form(fact, dims):
    mart = marts.customer_mart(marts.enriched(fact, dims))
    expected = rows(window_form(mart))
    assert rows(marts.customer_monthly(fact, dims)) == expected
    assert rows(totals.customer_monthly_of(mart)) == expected
    assert (1, "Mira Holt", "Lund", "555-0101", "2023-03", D("150.50")) in expected


def test_customer_with_two_addresses_keeps_both_rows_with_the_whole_total(fact, dims):
    mart = marts.customer_mart(marts.enriched(fact, dims))
    moved = mart.withColumn("address", F.when(F.col("sales_date") > "2023-03-15", "Agra").otherwise(F.col("address")))
    assert rows(totals.customer_monthly_of(moved)) == rows(window_form(moved))


def test_sales_person_totals_from_the_mart_equal_those_from_the_fact(fact, dims):
    mart = marts.sales_mart(marts.enriched(fact, dims))
    from_mart = totals.sales_person_monthly_of(mart)
    named = totals.seller_names(marts.sales_person_totals(fact, dims), dims.team)
    assert rows(from_mart) == rows(named)


def test_group_total_equals_the_window(fact):
    keys = ["customer_id", "sales_date"]
    got = totals.with_group_total(fact, keys, "total_cost", "t")
    window = F.sum("total_cost").over(Window.partitionBy(*keys)).cast("decimal(18,2)")
    assert rows(got) == rows(fact.withColumn("t", window))


def seller_totals(spark):
    data = [(s, p, m, None if p % 17 == 0 else D(p * 7919 % 101)) for s in (1, 2) for m in ("2023-01", None) for p in range(s * 40)]
    data += [(3, p, "2023-01", D("5.00")) for p in range(30)] + [(4, p, "2023-01", None) for p in range(3)]
    return spark.createDataFrame(data, "store_id bigint, sales_person_id bigint, sales_month string, total_sales decimal(18,2)")


@pytest.mark.parametrize("ranges", ["1", "4", "13"])
def test_rank_over_ranges_equals_the_window(spark, ranges):
    df = seller_totals(spark)
    window = Window.partitionBy("store_id", "sales_month").orderBy(F.desc("total_sales"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(ranking.with_rank(df)) == rows(df.withColumn("rnk", F.rank().over(window)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rank_deals_a_group_with_an_outlier_evenly(spark, monkeypatch, tmp_path):
    n = 40000
    total = F.when(F.col("id") == 0, F.lit(10**12)).otherwise(F.col("id") % 30000).cast("decimal(18,2)")
    df = spark.range(n).select(F.lit(1).cast("long").alias("store_id"), F.col("id").alias("sales_person_id"), F.lit("2023-01").alias("sales_month"), total.alias("total_sales"))
    monkeypatch.setattr(ranking, "new_folder", lambda spark, purpose: str(tmp_path / "ranges"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.with_rank(df)
        assert ranked.where("rnk = 1").count() == 1 and ranked.agg(F.max("rnk")).first()[0] <= n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "ranges")).groupBy("range").count().collect()]
    assert max(sizes) < 0.06 * sum(sizes)


def test_top_sellers_are_rank_one(spark):
    df = seller_totals(spark)
    expected = ranking.with_rank(df).where("rnk = 1").drop("rnk")
    assert rows(ranking.top_sellers(df)) == rows(expected)


@pytest.mark.parametrize("share", [0.0001, 0.2, 0.9])
def test_hot_key_join_equals_the_plain_join(spark, share):
    data = [(1, 121, 1, "2023-03-04", str(i)) for i in range(300)]
    data += [(c, 121, 1, "2023-03-04", "1") for c in (2, 2, 3, 99)] + [(None, 121, 1, "2023-03-04", "1")]
    fact = sales_frame(spark, data)
    people = dimensions(spark).customer.select("customer_id", "first_name")
    got = joins.join_hot_keys(fact, people, "customer_id", "customer_id", share)
    assert rows(got) == rows(fact.join(people, "customer_id").select(*got.columns))


def test_totals_agree_with_each_other(fact, dims):
    total = marts.enriched(fact, dims).agg(F.sum("total_cost")).first()[0]
    for monthly in (marts.customer_monthly(fact, dims), marts.sales_person_monthly(fact, dims)):
        assert monthly.agg(F.sum("total_sales")).first()[0] == total


def test_dimension_keys_must_be_unique(dims):
    require_unique_keys((dims.store, "id"))
    with pytest.raises(DuplicateKeys):
        require_unique_keys((dims.store.union(dims.store), "id"))
