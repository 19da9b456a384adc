"""Monthly totals per customer and per salesperson."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import full_name, money_total, month_start, sales_month
from tallymart.operators.joins import same_values


def with_group_total(rows: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """Every row with the sum over its group: `sum(amount) OVER (PARTITION BY keys)`.

    A window would move each group as a whole to one task. Here the sums are taken first, with
    partial sums before the shuffle, and joined back to the rows; a join splits a group that
    holds much of the data, a window cannot. Null keys form a group, as in a window.
    The rows are read twice: let them be a stored table, such as a detail mart.
    """
    totals = rows.groupBy(*keys).agg(money_total(F.col(amount)).alias(name))
    return (
        rows.alias("r")
        .join(totals.alias("t"), same_values("r", "t", keys))
        .select("r.*", F.col(f"t.{name}"))
    )


Keep = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _group_total(rows: DataFrame, keys: Sequence[str], attributes: Sequence[str], keep: Keep) -> DataFrame:
    # One row per distinct (keys, attributes), each with the total over `keys` alone. The second
    # sum runs over rows that are already summed, one per variant of the attributes.
    variants = keep(rows.groupBy(*keys, *attributes).agg(F.sum("total_cost").alias("total_cost")))
    return with_group_total(variants, keys, "total_cost", "total_sales").drop("total_cost")


def customer_monthly_of(mart: DataFrame, keep: Keep = _as_is) -> DataFrame:
    """Month total per customer from any customer mart.

    A customer who appears with several addresses or names keeps one row for each, all with the
    customer's whole total. `keep` may store the summed rows, which are read twice.
    """
    named = mart.select(
        "customer_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "address",
        "phone_number",
        sales_month(F.col("sales_date")).alias("sales_date_month"),
        "total_cost",
    )
    totals = _group_total(
        named, ["customer_id", "sales_date_month"], ["full_name", "address", "phone_number"], keep
    )
    return totals.select(
        "customer_id", "full_name", "address", "phone_number", "sales_date_month", "total_sales"
    )


def sales_person_monthly_of(mart: DataFrame, keep: Keep = _as_is) -> DataFrame:
    """Month total per store and salesperson from any sales mart; `keep` as for customers."""
    named = mart.select(
        "store_id",
        "sales_person_id",
        full_name(F.col("sales_person_first_name"), F.col("sales_person_last_name")).alias("full_name"),
        "sales_month",
        "total_cost",
    )
    totals = _group_total(named, ["store_id", "sales_person_id", "sales_month"], ["full_name"], keep)
    return totals.select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales")


def _total_by(lines: DataFrame, keys: Sequence[str], month_name: str) -> DataFrame:
    # Grouped by the month's first day, a small fixed-width key; its text form comes afterwards.
    sums = lines.groupBy(*keys, month_start(F.col("sales_date")).alias("month")).agg(
        money_total(F.col("total_cost")).alias("total_sales")
    )
    return sums.select(*keys, sales_month(F.col("month")).alias(month_name), "total_sales")


def customer_totals(lines: DataFrame) -> DataFrame:
    """Month total per customer id."""
    return _total_by(lines, ["customer_id"], "sales_date_month")


def seller_totals(lines: DataFrame) -> DataFrame:
    """Month total per store and salesperson id."""
    return _total_by(lines, ["store_id", "sales_person_id"], "sales_month")


def customer_names(totals: DataFrame, customer: DataFrame) -> DataFrame:
    """Customer totals with name, address and phone; totals of unknown customers are dropped."""
    names = customer.select(
        F.col("customer_id").alias("key"),
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "address",
        "phone_number",
    )
    return totals.join(names, F.col("customer_id") == F.col("key")).select(
        "customer_id", "full_name", "address", "phone_number", "sales_date_month", "total_sales"
    )


def seller_names(totals: DataFrame, team: DataFrame) -> DataFrame:
    """Salesperson totals with the full name; totals of unknown salespeople are dropped."""
    names = team.select(
        F.col("id").alias("key"),
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
    )
    others = [c for c in totals.columns if c not in ("store_id", "sales_person_id")]
    return totals.join(names, F.col("sales_person_id") == F.col("key")).select(
        "store_id", "sales_person_id", "full_name", *others
    )
