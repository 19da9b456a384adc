"""The order tables seen as sales: line items become sold lines, suppliers the sales team."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.columns import fold_extras
from tallymart.operators.joins import broadcast_small
from tallymart.plans.marts import Dimensions
from tallymart.schemas import ADDITIONAL, CANONICAL, MANDATORY, MONEY

EXTRAS = ["l_returnflag", "l_linestatus"]

# The columns used here. With the schema given, no job has to open file footers first.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_returnflag string, l_linestatus string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def sales_lines(spark: SparkSession, folder: str, product: bool = True) -> DataFrame:
    """Sold lines with the mandatory columns and the two extra ones.

    The product name is looked up by a unique key, so leaving it out changes no row; the marts
    do without it and without the join.
    """
    # Converted before the joins, which shuffle them: whole cents, counts and days take fewer bytes than doubles and times.
    sold = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
        *EXTRAS,
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("sales_date")
    )
    lines = sold.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if product:
        lines = lines.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    # Last, and without a shuffle while suppliers are few: their column does not go through the joins before.
    team = broadcast_small(table(spark, folder, "supplier"))
    lines = lines.join(team, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.select(
        "customer_id",
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        *([F.col("p_name").alias("product_name")] if product else []),
        "sales_date",
        F.col("l_suppkey").alias("sales_person_id"),
        (F.col("total_cost") / F.col("quantity")).cast(MONEY).alias("price"),
        "quantity",
        "total_cost",
        *EXTRAS,
    )


def sales_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The canonical fact with both extras folded."""
    lines = sales_lines(spark, folder)
    folded = fold_extras([F.col(c) for c in EXTRAS]).alias(ADDITIONAL)
    return lines.select(*MANDATORY, folded).select(*CANONICAL)


def sales_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The fact without product name, all the marts need."""
    return sales_lines(spark, folder, product=False)


def _name_part(name: str, part: int) -> Column:
    return F.split_part(F.col(name), F.lit("#"), F.lit(part))


def dimensions(spark: SparkSession, folder: str) -> Dimensions:
    """Customers, stores and sales team; place names are looked up and never drop a row."""
    nation = table(spark, folder, "nation")
    home = nation.select("n_nationkey", "n_name")
    customer = (
        table(spark, folder, "customer")
        .join(home, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            _name_part("c_name", 1).alias("first_name"),
            _name_part("c_name", 2).alias("last_name"),
            F.col("n_name").alias("address"),
            F.col("c_nationkey").cast("string").alias("pincode"),
            F.col("c_custkey").cast("string").alias("phone_number"),
            F.lit(None).cast("date").alias("customer_joining_date"),
        )
    )
    store = nation.join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("address"),
        F.lit(None).cast("string").alias("store_pincode"),
        F.col("r_name").alias("store_manager_name"),
        F.lit(None).cast("date").alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )
    team = (
        table(spark, folder, "supplier")
        .join(home, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("s_suppkey").alias("id"),
            _name_part("s_name", 1).alias("first_name"),
            _name_part("s_name", 2).alias("last_name"),
            F.col("s_nationkey").cast("bigint").alias("manager_id"),
            F.lit("N").alias("is_manager"),
            F.col("n_name").alias("address"),
            F.col("s_nationkey").cast("string").alias("pincode"),
            F.lit(None).cast("date").alias("joining_date"),
        )
    )
    return Dimensions(
        customer,
        store,
        team,
        customer_keys=table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id")),
        team_keys=table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id")),
    )
