"""Where results go: Parquet, partitioned Parquet, CSV reports, database tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Of Parquet files; what is written once is read several times.
_CODEC = "zstd"


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at `path`."""
    df.write.mode("overwrite").option("compression", _CODEC).parquet(path)


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of each value of `by` together, in as many tasks as their bytes need."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    only_touched: bool = False,
    rebalance: bool = True,
    within: Sequence[str] = (),
) -> None:
    """Replace a table laid out as `column=value` folders.

    Rebalancing gathers each folder's rows so that it gets few files, and lets adaptive execution
    split a folder that holds much of the data over several tasks. Without it, and with input
    already clustered by the folder columns, the write needs no shuffle. With `only_touched`,
    folders that receive no row stay as they are. `within` orders the rows a task writes to a folder: equal
    values side by side are smaller here and in the shuffles that read them.
    """
    shaped = gathered(df, by) if rebalance else df
    if within:
        shaped = shaped.sortWithinPartitions(*by, *within)
    (
        shaped.write.mode("overwrite")
        .option("compression", _CODEC)
        .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
        .partitionBy(*by)
        .parquet(path)
    )


def run_path(base: str, run_id: str) -> str:
    """Folder of one run's output below a mart; each run publishes beside the earlier ones."""
    return f"{base}/run_id={run_id}"


def version_path(path: str, version: str) -> str:
    """Folder of one version of a mart; it is written once and never changed."""
    return f"{path}/version={version}"


def write_csv_report(df: DataFrame, path: str, by: Sequence[str] = (), rebalance: bool = True) -> None:
    """A CSV report with header; laid out by columns, it replaces only the folders it has rows for.

    Rows that lie by these columns already need no rebalancing.
    """
    writer = df.write.mode("overwrite").option("header", "true")
    if by:
        writer = (
            (gathered(df, by) if rebalance else df)
            .write.mode("overwrite")
            .option("header", "true")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
        )
    writer.csv(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append", connections: int = 8
) -> None:
    """Write to a database table over a bounded number of connections. Errors are raised.

    `append` adds the rows, as the batch totals of one run; `overwrite` empties the table and
    fills it again, which keeps its declaration and is safe to repeat.
    """
    writer = df.write.option("numPartitions", connections).option("truncate", "true")
    writer.jdbc(url=url, table=table, mode=mode, properties=properties)


def customer_table_rows(monthly: DataFrame) -> DataFrame:
    """Customer totals as the database table takes them: the month is its first day.

    Ids and money keep their width; a value the table's declaration has no room for is refused by
    the database, not cut here.
    """
    return monthly.select(
        "customer_id",
        "full_name",
        "address",
        "phone_number",
        F.to_date(F.concat("sales_date_month", F.lit("-01"))).alias("sales_date_month"),
        "total_sales",
    )


def preview(df: DataFrame, rows: int = 20) -> None:
    """Print a few rows; runs only when called."""
    df.show(rows, truncate=False)
