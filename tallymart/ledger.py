"""The run ledger: which delivery was opened by which run, and whether that run finished.

An append-only log of events. The state of a delivery is its latest event; a delivery is known by the
full path, modification time and length of its file, so a new drop under an old path is a new one.
Events written before times were kept stand for every delivery under their path.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.logs import PART, Log
from tallymart.schemas import CLOSED, IDENTITY, LEDGER_EVENT, LOST, OPEN

# The part of a snapshot whose deliveries were opened last, and that of all others.
UNENDED, ENDED = "open", "ended"


def with_identity(files: DataFrame) -> DataFrame:
    """The files with every column of their identity; null where the listing lacks it."""
    kinds = {"modification_time": "timestamp", "length": "bigint"}
    absent = {c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in files.columns}
    return files.withColumns(absent) if absent else files


def same_delivery(left: str, right: str) -> Column:
    """Equal identity of a file of `left` and an event of `right`."""
    same = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in IDENTITY[1:]]
    known = same[0] & same[1]
    return (F.col(f"{left}.{IDENTITY[0]}") == F.col(f"{right}.{IDENTITY[0]}")) & (
        F.col(f"{right}.modification_time").isNull() | known
    )


def among(files: DataFrame, deliveries: DataFrame, how: str = "left_semi") -> DataFrame:
    """The files that are (or, with "left_anti", are not) among the given deliveries."""
    left = with_identity(files).alias("f")
    right = with_identity(deliveries).select(*IDENTITY).alias("e")
    return left.join(right, same_delivery("f", "e"), how).select(*[f"f.{c}" for c in files.columns])


def _events(files: DataFrame, run_id: str | Column, status: str, at: datetime | Column | None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    return with_identity(files).select(
        "file_name",
        "file_location",
        (run_id if isinstance(run_id, Column) else F.lit(run_id)).alias("run_id"),
        stamp.cast("timestamp").alias("event_time"),
        F.lit(status).alias("status"),
        "modification_time",
        "length",
    )


def open_events(
    files: DataFrame, run_id: str | Column, at: datetime | Column | None = None
) -> DataFrame:
    """A run starts on these files."""
    return _events(files, run_id, OPEN, at)


def close_events(
    files: DataFrame, run_id: str | Column, at: datetime | Column | None = None
) -> DataFrame:
    """The run has published everything it made of these files."""
    return _events(files, run_id, CLOSED, at)


def lost_events(
    files: DataFrame, run_id: str | Column, at: datetime | Column | None = None
) -> DataFrame:
    """The run died and these files are no longer there to repeat it."""
    return _events(files, run_id, LOST, at)


def append(events: DataFrame, path: str) -> None:
    Log(events.sparkSession, path, LEDGER_EVENT).append(events)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The events of all deliveries; after a compaction those that `compacted` keeps, and all later ones."""
    return Log(spark, path, LEDGER_EVENT).read()


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Events enough to find the unfinished deliveries: what the last compaction found ended is not read."""
    return Log(spark, path, LEDGER_EVENT).read(UNENDED)


def compacted(events: DataFrame) -> DataFrame:
    """Of each delivery and run the last opening and the last ending, in parts by how the delivery stands.

    Whatever is asked of all events, or of those of some runs, has the same answer of these.
    """
    order = F.struct("event_time", "status")
    kept = events.groupBy(*IDENTITY, "run_id", (F.col("status") == OPEN).alias("opening")).agg(
        F.max_by(F.struct("file_name", "event_time", "status"), order).alias("last")
    )
    flat = kept.select(*IDENTITY, "run_id", "last.*")
    # A window here holds the few runs of one delivery.
    stands = F.max(order).over(Window.partitionBy(*IDENTITY)).getField("status")
    return flat.withColumn(PART, F.when(stands == OPEN, UNENDED).otherwise(ENDED))


def compact(spark: SparkSession, path: str, after: int) -> bool:
    """Make one snapshot of the ledger when its tail has more than `after` files."""
    return Log(spark, path, LEDGER_EVENT).compact(compacted, after)


def latest(events: DataFrame) -> DataFrame:
    """One row per delivery: when its last run opened it, when that was ended, and its status.

    Of two events with the same time the closing one is the later.
    """
    order = F.struct("event_time", "status")
    by_file = events.groupBy(*IDENTITY).agg(
        F.max_by(F.struct("file_name", "run_id", "event_time", "status"), order).alias("last"),
        F.max(F.when(F.col("status") == OPEN, F.col("event_time"))).alias("created_date"),
    )
    return by_file.select(
        F.col("last.file_name").alias("file_name"),
        "file_location",
        F.col("last.run_id").alias("run_id"),
        "created_date",
        F.when(F.col("last.status") != OPEN, F.col("last.event_time")).alias("updated_date"),
        F.col("last.status").alias("status"),
        "modification_time",
        "length",
    )


def unfinished(events: DataFrame) -> DataFrame:
    """Files whose last run never closed them, with that run."""
    return latest(events).where(F.col("status") == OPEN)


def left_behind(files: DataFrame, events: DataFrame) -> DataFrame:
    """The distinct listed files an earlier run opened and did not close."""
    return among(files, unfinished(events)).distinct()


def closed(events: DataFrame) -> DataFrame:
    """Deliveries whose last event is a closing one."""
    return latest(events).where(F.col("status") == CLOSED)


def unprocessed(files: DataFrame, events: DataFrame) -> DataFrame:
    """Listed files without a closing event; nothing has to be moved out of the inbox."""
    return among(files, closed(events), "left_anti")
