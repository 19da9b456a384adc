"""What the operators share: the place of written tables, and the identity of rows."""

from __future__ import annotations

import pathlib
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.workdir import shared_folder

KEY, PRINT = "_k", "_f"
#: Stands for a null id: ids are compared as if null came before all others.
NO_ID = -(2**63)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, through Spark's own file server, so that their Python can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = pathlib.Path(__file__).resolve().parents[2]
    path = pathlib.Path(SparkFiles.getRootDirectory()) / f"package-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(pathlib.Path(__file__).resolve().parents[1].rglob("*.py")):
            out.write(file, file.relative_to(top))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Where that is unset, a local session takes its warehouse, as in
    tests, and a cluster is refused."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a Parquet table and read back: cuts the lineage, and survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """Identity of a row: its id, and a hash of its text, which tells rows apart that share an id. Rows equal in both get equal results."""
    return [
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias(KEY),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias(PRINT),
    ]


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Key, print and text alone: no other column can clash."""
    ship(docs.sparkSession)
    return docs.select(*row_key(id_column, text_column), F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def id_back(name: str = "doc_id") -> Column:
    return F.when(F.col(KEY) != NO_ID, F.col(KEY)).alias(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether df has at most `rows` rows; counts no further."""
    return df.limit(rows + 1).count() <= rows


def narrow(df: DataFrame, max_rows: int) -> DataFrame:
    """df marked for broadcast where it is proven to have at most max_rows rows; else unmarked, for a shuffled join."""
    return F.broadcast(df) if small_enough(df, max_rows) else df
