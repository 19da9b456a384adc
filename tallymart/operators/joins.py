"""Joining the sales fact with its dimensions.

Dimension keys are unique, so no join multiplies rows; a sale whose customer, store or
salesperson is unknown is dropped by the inner joins.

Spark broadcasts a side whose known size is under `spark.sql.autoBroadcastJoinThreshold` and otherwise
shuffles both sides, where adaptive execution splits skewed partitions. `join_hot_keys` is for large
dimensions and fact keys that hold much of the data: it does not depend on the skew settings of the
session. `enrich_sales` takes it for customers when it is given a share. `broadcast_small` is for stores and the team.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.workdir import new_folder


# Rows of a dimension that is sent to every executor whole.
BROADCAST_ROWS = 500_000


def broadcast_small(dimension: DataFrame) -> DataFrame:
    """The dimension, marked to be broadcast if it has few rows; they are counted, as the size of a join is not known to Spark."""
    return F.broadcast(dimension) if dimension.count() <= BROADCAST_ROWS else dimension


def with_customer(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Sales with the customer's name, address, pincode and phone."""
    ct = customer.select(
        F.col("customer_id"), "first_name", "last_name", "address", "pincode", "phone_number"
    ).alias("ct")
    return fact.alias("s").join(ct, F.col("s.customer_id") == F.col("ct.customer_id")).select(
        "s.*", "ct.first_name", "ct.last_name", "ct.address", "ct.pincode", "ct.phone_number"
    )


def with_customers(lines: DataFrame, customer: DataFrame, hot_share: float | None = None) -> DataFrame:
    """As `with_customer`; customers that hold more than `hot_share` of the sales, if it is given, are joined apart."""
    if hot_share is None:
        return with_customer(lines, customer)
    people = customer.select("customer_id", "first_name", "last_name", "address", "pincode", "phone_number")
    return join_hot_keys(lines, people, "customer_id", "customer_id", hot_share)


def with_store(sales: DataFrame, store: DataFrame) -> DataFrame:
    """Sales with the store's address and manager."""
    sd = store.select(
        F.col("id").alias("store_key"), F.col("address").alias("store_address"), "store_manager_name"
    )
    return sales.join(sd, F.col("store_id") == F.col("store_key")).drop("store_key")


def with_sales_person(sales: DataFrame, team: DataFrame) -> DataFrame:
    """Sales with the salesperson's name, address, manager and joining date."""
    st = team.select(
        F.col("id").alias("team_key"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
        "joining_date",
    )
    return sales.join(st, F.col("sales_person_id") == F.col("team_key")).drop("team_key")


def enrich_sales(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    team: DataFrame,
    hot_share: float | None = None,
) -> DataFrame:
    """The star join: every sale with its customer, store and salesperson, names unique.

    With `hot_share`, customers that hold more than that share of the sales are joined apart.
    """
    lines = fact.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    return with_sales_person(with_store(with_customers(lines, customer, hot_share), store), team)


def known_only(sales: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Sales whose key exists in the dimension, without taking any of its columns."""
    keys = dimension.select(F.col(dimension_key).alias("known_key"))
    return sales.join(keys, F.col(key) == F.col("known_key"), "left_semi")


def join_hot_keys(
    fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str, share: float = 0.001
) -> DataFrame:
    """Inner join that stays balanced when a few keys hold much of the fact.

    A key is hot when it holds more than `share` of the rows, so at most 1/share keys are hot.
    As dimension keys are unique, their dimension rows number at most 1/share too: this bound
    is what allows broadcasting them. All other rows take the ordinary join, where no key holds
    more than `share`. The result has the fact's columns and the dimension's except its key.
    """
    # Written down, so that the fact is counted once for the total and the keys.
    path = new_folder(fact.sparkSession, "key-counts")
    counts = fact.groupBy(F.col(key).alias("hot_key")).count()
    counts.write.parquet(path)
    counts = fact.sparkSession.read.schema(counts.schema).parquet(path)
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where((F.col("count") > total * share) & F.col("hot_key").isNotNull())
    hot_keys = [r.hot_key for r in hot.select("hot_key").collect()]
    renamed = dimension.withColumnRenamed(dimension_key, "dimension_key")
    matches = F.col(key) == F.col("dimension_key")
    if not hot_keys:
        return fact.join(renamed, matches).drop("dimension_key")
    few = renamed.where(F.col("dimension_key").isin(hot_keys))
    spread = fact.where(F.col(key).isin(hot_keys)).join(F.broadcast(few), matches)
    rest = fact.where(~F.col(key).isin(hot_keys)).join(renamed, matches)
    return spread.unionByName(rest).drop("dimension_key")


def same_values(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of key columns of two aliased frames."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return condition
