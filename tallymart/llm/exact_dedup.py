"""Exact dedup by content sort, in DataFrame functions only.

Texts are equal if their bytes are, after A-Z are lower-cased; a null text counts as empty. Of equal texts the row with the largest id stays.
1. A count by text hash finds groups that hold more than one part in PIECES of all bytes; these are fewer than PIECES. Each is dealt in
   pieces of at most that weight, so a text that a third of all rows share is spread over thousands of ranges.
2. Rows are range-partitioned by (first HEAD bytes, text hash, piece) with Spark's sampled splitters. A splitter is thus a bounded stretch
   of the normalised bytes; the hash only tells apart texts that begin alike.
3. Within a range an external sort on the whole bytes places equals adjacent, and a window over (place, whole bytes) compares neighbours in
   full. Most groups are settled there.
4. A group dealt in pieces has one representative for each piece; those are grouped by their whole bytes, and the result goes back to
   their rows.

A text moves once, in step 2. What is broadcast has fewer rows than PIECES, or 2 * PIECES, whatever the input.

Defined cases: null and empty texts are equal; a null id is smaller than all others and keep_id is null if a group has null ids alone;
of rows that share the largest id, one stays; every row, repeated ones too, gets a result of its own; an empty table gives an empty one.
docs should be a table (files), as its rows are numbered to deal them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.decontaminate import lowered
from tallymart.llm.shared import NO_ID, stored, table

#: A group of more than one PIECES-th of all bytes is dealt in pieces. A row counts ROW_BYTES beside its text.
PIECES, ROW_BYTES = 20_000, 64
#: Bytes of a text in its sort key ahead of the hash.
HEAD = 32


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", columns: list[str] | None = None) -> DataFrame:
    """_row (the named columns of docs, or all), keep_id, group_size, kept, text_sha256 for every row of docs."""
    norm = lowered(F.coalesce(F.col(text_column).cast("string"), F.lit(""))).alias("norm")
    sizes = docs.select(norm).groupBy(F.xxhash64("norm").alias("h")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("norm") + F.lit(ROW_BYTES)).alias("weight"))
    sizes = stored(sizes, "op13-sizes")
    total = sizes.agg(F.sum("weight")).first()[0] or 1
    share = F.ceil(F.col("weight").cast("double") * PIECES / total)
    large = sizes.where((F.col("rows") > 1) & (share > 1)).select("h", F.least(share, F.col("rows")).alias("pieces"))

    row = F.struct(*(columns or docs.columns)).alias("_row")
    rows = docs.select(row, F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), norm).withColumn("h", F.xxhash64("norm"))
    piece = F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("pieces")))
    head = F.substring(F.col("norm").cast("binary"), 1, HEAD)
    place = ["head", "h", "piece"]
    ranged = rows.join(F.broadcast(large), "h", "left").select("_row", "id", "norm", head.alias("head"), "h", piece.alias("piece")).repartitionByRange(*place)

    equals = Window.partitionBy(*place, "norm").orderBy(F.col("id").desc())
    all_of_them = equals.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = ranged.select(
        "_row", "piece", "norm", (F.row_number().over(equals) == 1).alias("first"), F.first("id").over(all_of_them).alias("most"), F.count(F.lit(1)).over(all_of_them).alias("size")
    )
    speaks = F.col("first") & F.col("piece").isNotNull()
    runs = runs.select("_row", "piece", "first", "most", "size", F.sha2("norm", 256).alias("text_sha256"), F.when(speaks, F.col("norm")).alias("said"))
    runs = stored(runs, "op13-runs")

    # Of a group in pieces, one representative each: grouped by the whole text.
    merged = runs.where(F.col("said").isNotNull()).groupBy("said").agg(F.max(F.struct("most", "piece")).alias("best"), F.sum("size").alias("all"), F.first("text_sha256").alias("text_sha256"))
    merged = merged.select("text_sha256", "best", "all")
    whole = runs.join(F.broadcast(merged), "text_sha256", "left")
    most = F.coalesce("best.most", "most")
    return whole.select(
        "_row",
        F.when(most != NO_ID, most).alias("keep_id"),
        F.coalesce("all", "size").alias("group_size"),
        (F.col("first") & F.coalesce(F.col("piece") == F.col("best.piece"), F.lit(True))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    return exact_copies(docs, id_column, text_column).where("kept").select("_row.*")


def op13_exact_dedup(spark, sf_dir) -> DataFrame:
    out = exact_copies(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("_row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = {
    "op13_exact_dedup": r"""
WITH doc AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
  row_number() OVER (PARTITION BY s ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(s) AS text_sha256
FROM doc
"""
}
QUERIES = {"op13_exact_dedup": op13_exact_dedup}
