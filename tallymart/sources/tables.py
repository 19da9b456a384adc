"""Tables the engine reads: dimensions from files or a database, and its own stores."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.errors import DuplicateKeys
from tallymart.schemas import FACT_STORE, ROW_BAD, ROW_OK


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table. With a partition column and its bounds the read runs in parallel.

    The bounds only place the cuts between partitions; rows outside them are read as well.
    """
    if partition_column is None:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    if lower is None or upper is None or partitions is None:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return spark.read.jdbc(
        url=url,
        table=table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def require_unique_keys(*dimensions: tuple[DataFrame, str]) -> None:
    """Raises when a key occurs twice in its dimension: one query over all of them."""
    keys = [
        dimension.where(F.col(key).isNotNull()).select(F.lit(f"{i}: {key}").alias("key"), F.col(key).cast("string").alias("value"))
        for i, (dimension, key) in enumerate(dimensions)
    ]
    every = reduce(DataFrame.union, keys)
    repeated = every.groupBy("key", "value").count().where(F.col("count") > 1).select("key").take(1)
    if repeated:
        raise DuplicateKeys(f"{repeated[0].key.partition(': ')[2]} is not unique")


def read_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet store of ours. Before its first write it is an empty table.

    The schema is given, so no file footer is opened to infer it and partition values such as
    `2023-03` stay text.
    """
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def store_exists(spark: SparkSession, path: str) -> bool:
    """Whether a store of ours has been written."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Accepted rows of the fact store; the status filter prunes partitions."""
    return read_store(spark, path, FACT_STORE).where(F.col("row_status") == ROW_OK)


def read_bad_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that were set aside, with their raw line and file."""
    return (
        read_store(spark, path, FACT_STORE)
        .where(F.col("row_status") == ROW_BAD)
        .select("source_file", "unparsed_line", "ingest_batch")
    )


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """A Parquet copy of a database table.

    A run reads each dimension several times; from the copy it always sees the same rows, the
    database is read once, and Spark knows the size when it chooses how to join.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
