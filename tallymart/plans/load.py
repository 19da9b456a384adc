"""The three dimensions from where an installation keeps them."""

from collections.abc import Mapping

from pyspark.sql import SparkSession

from tallymart.plans.marts import Dimensions
from tallymart.schemas import CUSTOMER, SALES_TEAM, STORE
from tallymart.sources.tables import read_jdbc, snapshot


def dimensions_from_parquet(spark: SparkSession, folder: str) -> Dimensions:
    """Tables `customer`, `store` and `sales_team` below one folder."""
    return Dimensions(
        spark.read.schema(CUSTOMER).parquet(f"{folder}/customer"),
        spark.read.schema(STORE).parquet(f"{folder}/store"),
        spark.read.schema(SALES_TEAM).parquet(f"{folder}/sales_team"),
    )


def dimensions_from_jdbc(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    folder: str,
    cuts: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> Dimensions:
    """Tables `customer`, `store` and `sales_team` of a database, copied to `folder` once.

    `cuts` names for a table the column, bounds and number of partitions of a parallel read.
    """
    copies = [
        snapshot(read_jdbc(spark, url, table, properties, *(cuts or {}).get(table, ())), f"{folder}/{table}")
        for table in ("customer", "store", "sales_team")
    ]
    return Dimensions(*copies)
