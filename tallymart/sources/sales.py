"""Sales files to the typed fact."""

import operator
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.columns import EXTRA_SEPARATOR, sales_month
from tallymart.schemas import (
    ADDITIONAL,
    CANONICAL,
    FACT_STORE,
    MANDATORY,
    ROW_BAD,
    ROW_OK,
    SALES_FACT,
    SALES_TYPES,
    UNPARSED,
)
from tallymart.sources.files import literal_path


# A character that stands in no file: where it does, the reader hands out the whole line all the same.
_NEVER = "\u0001"
# Fields a line is cut into at least; wider headers double it.
_LEAST_FIELDS = 16
# Extras up to this number are picked one by one; a function over an array is left to those that have more.
_FEW_EXTRAS = 16


def read_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """The lines of CSV files as they are, without headers and blank lines.

    The CSV reader drops each file's header; as its separator never occurs and nothing is a quote, a line is a
    single field.
    """
    lines = (
        spark.read.schema("line string, odd_line string")
        .option("header", "true")
        .option("sep", _NEVER)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "odd_line")
        .option("columnPruning", "false")
        .csv([literal_path(f) for f in files])
    )
    return lines.select(F.coalesce("odd_line", "line").alias("line"), F.col("_metadata.file_path").alias("source_file"))


def _plain_path(path: Column) -> Column:
    """Files are named in two ways: a path as listed, and a URI in which characters are escaped."""
    return F.when(path.startswith("file:/"), F.concat(F.lit("/"), F.ltrim(F.substr(path, F.lit(6)), F.lit("/")))).otherwise(path)


def _width_class(width: int) -> int:
    """How many fields lines of a file with so many columns are cut into: two more at least, and a power of two."""
    return max(_LEAST_FIELDS, 1 << (width + 1).bit_length())


_WIDE = T.DecimalType(38, 18)
_DAY = r"^\d{4}-\d{2}-\d{2}$"


def _typed(name: str) -> Column:
    """The field as its type; null where the text is empty or does not fit."""
    text = F.nullif(F.col(name), F.lit(""))
    if name == "sales_date":
        # A cast alone would also take other spellings of a date.
        text = F.when(text.rlike(_DAY), text)
    value = text.try_cast(SALES_TYPES[name])
    if isinstance(SALES_TYPES[name], T.DecimalType):
        # A cast alone would round; parts of a cent do not fit. With two places at most nothing can be rounded, and no wide number is made.
        point = F.instr(text, ".")
        exact = ((point == 0) | (F.length(text) - point <= 2)) & ~(text.contains("e") | text.contains("E"))
        value = F.when(exact, value).when(text.try_cast(_WIDE) == value, value)
    return value


def parse_lines(lines: DataFrame, places: DataFrame, fields: int, most_extras: int) -> DataFrame:
    """Lines of files with any headers as canonical rows, in one plan.

    `places` says for each file where its mandatory columns and its extras (at most `most_extras`) stand, and how many columns it has.
    A marker is put behind a line's last field: in a line with the right number of fields it stands where the
    header ends. A row with too few or too many fields, or with a field that does not fit its type, carries its
    line in `unparsed_line`. The conversion is spelled out instead of left to the CSV reader, which
    checks only the columns a query happens to use: here the verdict on a row depends on all of its columns,
    whatever is selected later.
    """
    uri = F.col("source_file")
    # Only what is escaped is decoded: this is done for every line.
    uri = F.when(uri.contains("%"), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)
    # One row for each file of a run, whose number Options.files_per_run bounds.
    rows = lines.withColumn("file", _plain_path(uri)).join(F.broadcast(places), "file")
    filled = F.concat("line", F.lit("," + _NEVER), F.repeat(F.lit(","), F.lit(fields) - F.col("width") - 1))
    cut = rows.withColumn("cut", F.from_csv(filled, ", ".join(f"c{i} string" for i in range(fields))))
    # Exploded, one row to one: a projection would be put into each of its many uses below.
    cut = cut.withColumn("fields", F.explode(F.array(F.array(*[F.col(f"cut.c{i}") for i in range(fields)]))))
    at = lambda place: F.get(F.col("fields"), place)
    # A function over an array would keep the whole projection out of the generated code, at several times the seconds.
    few = F.array(*[at(F.get("extras", F.lit(i))) for i in range(most_extras)])
    extras = F.array_join(few if 0 < most_extras <= _FEW_EXTRAS else F.transform("extras", at), EXTRA_SEPARATOR)
    folded = F.when(F.size("extras") > 0, extras) if most_extras else F.lit(None).cast("string")
    typed = [name for name in MANDATORY if name != "product_name"]
    named = cut.select(
        "line",
        "source_file",
        *[at(F.get("mandatory", F.lit(i))).alias(name) for i, name in enumerate(MANDATORY)],
        folded.alias(ADDITIONAL),
        (at(F.col("width")).eqNullSafe(_NEVER) & at(F.col("width") + 1).isNull()).alias("whole"),
    )
    # Each field is converted once, below; the verdict on the row compares the result with the text.
    converted = named.select("*", *[_typed(name).alias(f"typed_{name}") for name in typed])
    unfit = [(F.col(name) != "") & F.col(f"typed_{name}").isNull() for name in typed]
    unfit = reduce(operator.or_, [F.coalesce(one, F.lit(False)) for one in unfit])
    return converted.select(
        *[F.col(f"typed_{name}" if name in typed else name).alias(name) for name in MANDATORY],
        ADDITIONAL,
        F.when(~F.col("whole") | unfit, F.col("line")).alias(UNPARSED),
        "source_file",
    )


def empty_sales(spark: SparkSession) -> DataFrame:
    """The fact without rows."""
    return spark.createDataFrame([], SALES_FACT)


def stack_by_position(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column position."""
    return reduce(DataFrame.union, frames)


def stack_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_sales(spark: SparkSession, files: Mapping[tuple[str, ...], Sequence[str]]) -> DataFrame:
    """Fact rows of files grouped by header. All files of like widths are one scan: the plan does not grow with headers."""
    classes: dict[int, list[tuple[tuple[str, ...], Sequence[str]]]] = {}
    for header, paths in files.items():
        classes.setdefault(_width_class(len(header)), []).append((header, paths))
    schema = "path string, mandatory array<int>, extras array<int>, width int"
    frames = []
    for fields, group in classes.items():
        rows = []
        for header, paths in group:
            mandatory = [header.index(name) for name in MANDATORY]
            extras = [i for i, name in enumerate(header) if name not in MANDATORY]
            rows += [(path, mandatory, extras, len(header)) for path in paths]
        places = spark.createDataFrame(rows, schema).withColumn("file", _plain_path(F.col("path"))).drop("path")
        frames.append(parse_lines(read_lines(spark, [r[0] for r in rows]), places, fields, max(len(r[2]) for r in rows)))
    return stack_by_name(frames)


def to_store_rows(rows: DataFrame, batch: str) -> DataFrame:
    """Rows of one ingest batch in the layout of the fact store."""
    return rows.select(
        *CANONICAL,
        UNPARSED,
        F.when(F.col(UNPARSED).isNotNull(), F.col("source_file")).alias("source_file"),
        F.when(F.col(UNPARSED).isNull(), F.lit(ROW_OK)).otherwise(F.lit(ROW_BAD)).alias("row_status"),
        sales_month(F.col("sales_date")).alias("sales_month"),
        F.lit(batch).alias("ingest_batch"),
    ).select(*FACT_STORE.names)
