"""Ranking salespeople within a store and month, and the incentive of the best."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.columns import incentive
from tallymart.operators.joins import same_values
from tallymart.workdir import new_folder

GROUP = ["store_id", "sales_month"]


def mark_top(totals: DataFrame) -> DataFrame:
    """Totals with `is_top`: rank 1 within store and month, shared by ties.

    Rank 1 is the row that equals the group's maximum, so a maximum, which is combined before
    the shuffle, replaces sorting each group in one task. Nulls rank last: a null total is top
    only where every total of the group is null.
    """
    best = totals.groupBy(*GROUP).agg(F.max("total_sales").alias("best"))
    return (
        totals.alias("t")
        .join(best.alias("b"), same_values("t", "b", GROUP))
        .select("t.*", F.col("total_sales").eqNullSafe(F.col("best")).alias("is_top"))
    )


def with_incentive(totals: DataFrame) -> DataFrame:
    """Totals with the incentive: 1 % for the top of each store and month, zero for the rest."""
    paid = incentive(F.col("total_sales"), F.col("is_top"))
    return mark_top(totals).withColumn("incentive", paid).drop("is_top")


def top_sellers(totals: DataFrame) -> DataFrame:
    """Only the rows at rank 1, ties included."""
    return mark_top(totals).where("is_top").drop("is_top")


def with_rank(totals: DataFrame) -> DataFrame:
    """Totals with `rnk`: `rank() OVER (PARTITION BY store, month ORDER BY total DESC)`.

    A row's rank is one more than the number of rows with a larger total in its group. Equal totals
    are counted first, with partial counts before the shuffle. The distinct totals are dealt over
    ranges of (store, month, falling total), cut where the data are, so no task holds more than its
    range however large or skewed a group is. Counts are summed up within a range, and over the
    ranges of a group from one number per range.
    """
    spark = totals.sparkSession
    falling = F.col("total_sales").desc_nulls_last()
    counts = totals.groupBy(*GROUP, "total_sales").agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange(*GROUP, falling).withColumn("range", F.spark_partition_id())
    # Written down: cut a second time, the ranges could be others.
    path = new_folder(spark, "rank")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    earlier = (Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*GROUP, "range").agg(F.sum("n").alias("size"))
    over_ranges = F.sum("size").over(Window.partitionBy(*GROUP).orderBy("range").rowsBetween(*earlier))
    offsets = sizes.select(*GROUP, "range", F.coalesce(over_ranges, F.lit(0)).alias("before"))
    in_range = F.sum("n").over(Window.partitionBy(*GROUP, "range").orderBy(falling).rowsBetween(*earlier))
    placed = ranged.withColumn("larger", F.coalesce(in_range, F.lit(0)))
    ranks = (
        placed.alias("p")
        .join(offsets.alias("o"), same_values("p", "o", [*GROUP, "range"]))
        .select(*[f"p.{c}" for c in GROUP], "p.total_sales", (F.col("larger") + F.col("before") + 1).cast("int").alias("rnk"))
    )
    return (
        totals.alias("t")
        .join(ranks.alias("k"), same_values("t", "k", [*GROUP, "total_sales"]))
        .select("t.*", "k.rnk")
    )
