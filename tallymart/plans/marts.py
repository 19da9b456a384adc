"""The marts a user asks for, as compositions of the operators."""

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import month_start, sales_month
from tallymart.operators.joins import enrich_sales, known_only, with_customers, with_sales_person, with_store
from tallymart.operators.ranking import with_incentive
from tallymart.operators.totals import customer_names, customer_totals, seller_names, seller_totals
from tallymart.schemas import CUSTOMER_MART, MONTH_STATE, SALES_MART


@dataclass(frozen=True)
class Dimensions:
    """The three dimension tables.

    `customer_keys` and `team_keys` may name cheaper frames that hold the same keys, for
    dimensions that are themselves joins; existence checks read those.
    """

    customer: DataFrame
    store: DataFrame
    team: DataFrame
    customer_keys: DataFrame | None = None
    team_keys: DataFrame | None = None


def enriched(fact: DataFrame, dims: Dimensions, hot_share: float | None = None) -> DataFrame:
    return enrich_sales(fact, dims.customer, dims.store, dims.team, hot_share)


def customer_mart(sales: DataFrame) -> DataFrame:
    """Detail mart of customers from enriched sales."""
    return sales.select(*CUSTOMER_MART.names)


def sales_mart(sales: DataFrame) -> DataFrame:
    """Detail mart of the sales team from enriched sales, with the month of each sale."""
    month = F.expr("substring(cast(sales_date AS string), 1, 7)")
    return sales.withColumn("sales_month", month).select(*SALES_MART.names)


# The keys that a dimension lacks, by dimension; one without an entry lacks none.
Unknown = Mapping[str, DataFrame]
_KEYS = {"store": "store_id", "team": "sales_person_id", "customer": "customer_id"}


def _dimension_keys(dims: Dimensions) -> dict[str, DataFrame]:
    return {
        "store": dims.store.select("id"),
        "team": (dims.team_keys or dims.team).select("id"),
        "customer": (dims.customer_keys or dims.customer).select("customer_id"),
    }


def unknown_keys(sales: DataFrame, dims: Dimensions) -> DataFrame:
    """Each key of the sales that its dimension lacks. Keys are distinct before they are shuffled; no sale is."""
    tagged = lambda df, kind, key: df.select(F.lit(kind).alias("dimension"), F.col(key).cast("bigint").alias("unknown_key"))
    used = F.explode(F.array(*[F.struct(F.lit(kind).alias("dimension"), F.col(key).alias("unknown_key")) for kind, key in _KEYS.items()]))
    keys = sales.select(used.alias("used")).select("used.*").where(F.col("unknown_key").isNotNull()).distinct()
    known = reduce(DataFrame.union, [tagged(df, kind, df.columns[0]) for kind, df in _dimension_keys(dims).items()])
    return keys.join(known, ["dimension", "unknown_key"], "left_anti")


def _without(sales: DataFrame, unknown: Unknown, *kinds: str) -> DataFrame:
    """Sales whose keys are in these dimensions: those that are not are left out, instead of looking up all others."""
    for kind in kinds:
        sales = sales.where(F.col(_KEYS[kind]).isNotNull())
        if kind in unknown:
            sales = sales.join(unknown[kind], F.col(_KEYS[kind]) == F.col("unknown_key"), "left_anti")
    return sales


def _known(
    sales: DataFrame, dims: Dimensions, customer: bool = True, team: bool = True, unknown: Unknown | None = None
) -> DataFrame:
    if unknown is not None:
        return _without(sales, unknown, "store", "team", *(["customer"] if customer else []))
    known = known_only(sales, dims.store, "store_id", "id")
    if team:
        known = known_only(known, dims.team_keys or dims.team, "sales_person_id", "id")
    if customer:
        known = known_only(known, dims.customer_keys or dims.customer, "customer_id", "customer_id")
    return known


def customer_details(
    fact: DataFrame, dims: Dimensions, unknown: Unknown | None = None, hot_share: float | None = None
) -> DataFrame:
    """`customer_mart` of the enriched sales, without the texts of stores and sellers on the way."""
    if unknown is None:
        return customer_mart(enriched(fact, dims, hot_share))
    sold = _without(fact, unknown, "store", "team").select("customer_id", "sales_date", "total_cost")
    return customer_mart(with_customers(sold, dims.customer, hot_share))


def sales_details(fact: DataFrame, dims: Dimensions, unknown: Unknown | None = None) -> DataFrame:
    """`sales_mart` of the enriched sales, without the texts of customers on the way."""
    if unknown is None:
        return sales_mart(enriched(fact, dims))
    sold = _without(fact, unknown, "customer").select("store_id", "sales_person_id", "sales_date", "total_cost")
    return sales_mart(with_sales_person(with_store(sold, dims.store), dims.team))


def month_state(fact: DataFrame, shares: int = 1) -> DataFrame:
    """What each batch adds to its months, in a form that is merged by adding.

    All keys are kept: which sales count is decided with the dimensions of the day the months are published.
    The rows have the columns of sales that totals need, and give the same totals as the sales.

    Sales are dealt by month, batch and `shares` of their keys, in one shuffle for the sums and for the folders they are
    written to. Few sales share all keys, so that sums before the shuffle would save less than a second one costs.
    """
    keys = ["ingest_batch", "sales_date", "share", "store_id", "sales_person_id", "customer_id"]
    share = F.pmod(F.xxhash64("customer_id", "store_id", "sales_person_id"), F.lit(shares)).alias("share")
    # What is the same in most rows that lie side by side stands first, and takes next to no bytes. The text of the month is made behind the shuffle.
    day = month_start(F.col("sales_date")).alias("sales_date")
    sold = fact.select("ingest_batch", day, share, "store_id", "sales_person_id", "customer_id", "total_cost")
    dealt = sold.repartition("sales_date", "ingest_batch", "share")
    sums = dealt.groupBy(*keys).agg(F.sum("total_cost").alias("total_cost")).withColumn("sales_month", sales_month(F.col("sales_date")))
    return sums.select(*MONTH_STATE.names)


def customer_monthly(fact: DataFrame, dims: Dimensions, unknown: Unknown | None = None) -> DataFrame:
    """Month total of each customer.

    Equal to joining first, as customer ids are unique, but customers meet month totals instead
    of single sales, and their text columns never enter the aggregation.
    """
    totals = customer_totals(_known(fact, dims, customer=False, unknown=unknown))
    return customer_names(totals, dims.customer)


def sales_person_totals(fact: DataFrame, dims: Dimensions, unknown: Unknown | None = None) -> DataFrame:
    """Month total of each known salesperson, by id."""
    if unknown is not None:
        return seller_totals(_known(fact, dims, unknown=unknown))
    totals = seller_totals(_known(fact, dims, team=False))
    return known_only(totals, dims.team_keys or dims.team, "sales_person_id", "id")


def sales_person_monthly(fact: DataFrame, dims: Dimensions, unknown: Unknown | None = None) -> DataFrame:
    """Month total of each salesperson with the top seller's incentive.

    Names are joined last, so that the totals and their maxima read one and the same exchange.
    """
    return seller_names(with_incentive(sales_person_totals(fact, dims, unknown)), dims.team)


def sales_person_report(monthly: DataFrame) -> DataFrame:
    """The report for the stores: who sold how much in which month, and the incentive."""
    return monthly.select(
        F.col("full_name").alias("sales_person_name"),
        "store_id",
        "sales_month",
        F.col("total_sales").alias("total_billing"),
        F.col("incentive").alias("total_incentive"),
    )
