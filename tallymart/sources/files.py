"""What lies in the inbox: every file, its header, and whether it can be processed."""

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.schemas import ACCEPTED, IGNORED, MANDATORY, NO_HEADER, REJECTED
from tallymart.sources.stores import DIRECT, file_heads, scheme, unseen_files

_GLOB_CHARACTERS = re.compile(r"([{}\[\]*?\\])")
# A comma that has an even number of quotes to its right separates two names.
_NAME_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'

# Blank lines, then the first line with a visible character; a byte order mark is not part of it.
_FIRST_LINE = r"^\uFEFF?(?:[\x00-\x20]*[\r\n])?([^\r\n]*[^\x00-\x20][^\r\n]*)"
# Files up to this size, in bytes, are read as one value to find their header. Both ways give the same rows;
# the bound keeps a single value small.
SMALL_FILE = 32 << 20


def literal_path(path: str) -> str:
    """A path Spark reads as it is written, although its name holds glob characters."""
    return _GLOB_CHARACTERS.sub(r"\\\1", path)


def file_columns() -> list[Column]:
    """What identifies a file, from a frame or stream of the binary reader."""
    return [
        F.col("path").alias("file_location"),
        F.substring_index("path", "/", -1).alias("file_name"),
        F.col("modificationTime").alias("modification_time"),
        F.col("length"),
        F.col("_metadata.file_path").alias("file_uri"),
    ]


def list_files(spark: SparkSession, inbox: str) -> DataFrame:
    """Every non-empty file below `inbox`, of any extension: one row per file.

    Only file status is read, never content: the binary reader prunes the content column.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(inbox).select(*file_columns())


def _one_split_per_task(spark: SparkSession) -> SparkSession:
    """A session whose scans never put two files into one task; all else as in `spark`.

    When opening a file is counted as costly as reading a whole split, no task has room for a
    second one.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if child.conf.get(key, None) != value:
            child.conf.set(key, value)
    child.conf.unset("spark.sql.files.maxPartitionNum")
    child.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return child


def _text(
    spark: SparkSession, inbox: str, files: Sequence[str] | None, whole: bool = False
) -> DataFrame:
    if files:
        return spark.read.text([literal_path(f) for f in files], wholetext=whole)
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.csv" if files is None else "")
    return reader.text(inbox, wholetext=whole)


def first_lines(spark: SparkSession, inbox: str, files: Sequence[str] | None = None) -> DataFrame:
    """Lines of the first block of each CSV file that are not blank."""
    return _text(spark, inbox, files).where(
        (F.col("_metadata.file_block_start") == 0) & F.col("value").rlike(r"[^\x00-\x20]")
    )


def header_lines(
    spark: SparkSession,
    inbox: str,
    files: Sequence[str] | None = None,
    small: int | None = None,
    listing: DataFrame | None = None,
    direct: frozenset[str] = DIRECT,
) -> DataFrame:
    """The header line of each CSV file: its first line that is not blank, as in the CSV reader.

    Where tasks can open the store themselves (`direct` schemes), they read the first block of each file of the listing and no
    more. Elsewhere, or with `small` given, all text is read:

    One pass over the text without sort or shuffle. Files up to `small` bytes are one value each,
    many to a task, and the line is cut out of the text. Larger ones are read by line and in
    splits: as no two share a task, the header is the first line of its task, which is what the
    lower 33 bits of the row id count. The size filters keep each scan to its own files.
    """
    if small is None:
        if listing is None and files:
            listing = spark.read.format("binaryFile").load([literal_path(f) for f in files]).select(*file_columns())
        listing = list_files(spark, inbox) if listing is None else listing
        csv = listing.where(F.col("file_name").endswith(".csv"))
        known = csv.select("file_location").first()
        if known is None or scheme(known.file_location) in direct:
            return file_heads(csv)
        small = SMALL_FILE
    uri, size = F.col("_metadata.file_path").alias("file_uri"), F.col("_metadata.file_size")
    texts = _text(spark, inbox, files, whole=True).where(size <= small)
    cut = texts.select(uri, F.regexp_extract("value", _FIRST_LINE, 1).alias("header_line"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = first_lines(_one_split_per_task(spark), inbox, files).where(size > small)
    numbered = lines.select(uri, F.col("value").alias("header_line"), place.alias("place"))
    first = numbered.where(F.col("place") == 0).drop("place")
    return cut.where(F.col("header_line") != "").unionByName(first)


def header_names(line: Column) -> Column:
    """The column names in a header line, named as the CSV reader would name them.

    Quotes are removed, an empty name becomes `_c<position>`, and names that occur more than
    once (letter case aside) get their position appended.
    """
    names = F.transform(
        F.split(line, _NAME_SEPARATOR),
        lambda n: F.regexp_replace(F.regexp_replace(n, r'^"(.*)"$', "$1"), '""', '"'),
    )
    return F.transform(
        names,
        lambda n, i: F.when(n == "", F.concat(F.lit("_c"), i.cast("string")))
        .when(F.size(F.filter(names, lambda m: F.lower(m) == F.lower(n))) > 1, F.concat(n, i.cast("string")))
        .otherwise(n),
    )


def missing_columns(header: Column) -> Column:
    """Mandatory names absent from a header; letter case counts."""
    return F.array_except(F.array(*[F.lit(c) for c in MANDATORY]), header)


def manifest(
    spark: SparkSession,
    inbox: str,
    listing: DataFrame | None = None,
    files: Sequence[str] | None = None,
    direct: frozenset[str] = DIRECT,
) -> DataFrame:
    """One row per listed file with the verdict on it.

    Each use of the result reads the headers again; write it down to use it more than once.

    A file is accepted when it ends in `.csv` and its header has every mandatory column. A CSV
    file whose lines are all blank has no header and is refused.
    """
    listing = list_files(spark, inbox) if listing is None else listing
    headers = header_lines(spark, inbox, files, listing=listing, direct=direct).select(
        "file_uri", header_names(F.col("header_line")).alias("header")
    )
    judged = (
        listing.join(headers, "file_uri", "left")
        .withColumn("is_csv", F.col("file_name").endswith(".csv"))
        .withColumn(
            "missing_columns",
            F.when(F.col("is_csv"), missing_columns(F.coalesce("header", F.array().cast("array<string>")))),
        )
    )
    reason = (
        F.when(~F.col("is_csv"), F.lit("not a .csv file"))
        .when(F.col("header").isNull(), F.lit(NO_HEADER))
        .when(F.size("missing_columns") > 0, F.concat(F.lit("missing "), F.array_join("missing_columns", ", ")))
    )
    return judged.select(
        "file_location",
        "file_name",
        "modification_time",
        "length",
        "header",
        "missing_columns",
        F.when(reason.isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)).alias("status"),
        reason.alias("reason"),
    )


def ignored(
    spark: SparkSession, inbox: str, work: str, direct: frozenset[str] = DIRECT
) -> DataFrame | None:
    """Manifest rows of the files Spark's scans do not show: hidden ones and those without a byte.

    None where tasks cannot open the store themselves. An inbox given without a scheme is a folder
    of the local or mounted file system if its visible files are.
    """
    if not scheme(inbox):
        shown = list_files(spark, inbox).select("file_location").first()
        inbox = f"file:{os.path.abspath(inbox)}" if shown is None or scheme(shown.file_location) == "file" else inbox
    elif scheme(inbox) == "file":
        inbox = "file:/" + inbox.removeprefix("file:").lstrip("/")
    if scheme(inbox) not in direct:
        return None
    nothing = F.lit(None).cast("array<string>")
    return unseen_files(spark, inbox, work).select(
        "file_location",
        "file_name",
        "modification_time",
        "length",
        nothing.alias("header"),
        nothing.alias("missing_columns"),
        F.lit(IGNORED).alias("status"),
        "reason",
    )


def rejected_lines(spark: SparkSession, rejected: Sequence[str]) -> DataFrame:
    """The text of refused CSV files, line by line, for the error area."""
    return spark.read.text([literal_path(f) for f in rejected]).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line")
    )
