"""Stores that runs add to and later runs read: one snapshot of what counts, and the tail written since.

A log has generations. Generation 0 is the folder of the log alone, to which events are appended. Compacting writes the events
that still count as the snapshot of the next generation, an empty tail beside it, and last of all the number of the generation,
as one file. Up to that file everybody sees the old generation, whole; a compaction that dies before is done again later.

Two places are used in turn, so a compaction replaces the last generation but one. A reader that holds a log over two
compactions has to read it again. One writer at a time is assumed.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.sources.tables import read_store

#: The column that says which events of a snapshot belong together, and its value where nothing is told apart.
PART = "part"
ALL = "all"
_NUMBER = T.StructType([T.StructField("made_at", T.TimestampType()), T.StructField("generation", T.LongType())])


class Log:
    """A log below `path`; everything but the tail of generation 0 lies beside it, in `path`_log."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def generation(self) -> int:
        """The newest complete generation. The numbers are in folder names, so this takes a listing and no job."""
        names = read_store(self.spark, f"{self.path}_log/generations", _NUMBER).inputFiles()
        return max((int(n) for name in names for n in re.findall(r"/generation=(\d+)/", name)), default=0)

    def _place(self, kind: str, generation: int) -> str:
        return f"{self.path}_log/{kind}{generation % 2}"

    def _tail_path(self, generation: int) -> str:
        return self._place("tail", generation) if generation else self.path

    def tail(self) -> DataFrame:
        """Events since the last compaction."""
        return read_store(self.spark, self._tail_path(self.generation()), self.schema)

    def read(self, part: str | None = None) -> DataFrame:
        """All events that count; with `part`, of the snapshot those of that part only, whose folder alone is read."""
        generation = self.generation()
        tail = read_store(self.spark, self._tail_path(generation), self.schema)
        if not generation:
            return tail
        snapshot = read_store(self.spark, self._place("snapshot", generation), T.StructType([*self.schema, T.StructField(PART, T.StringType())]))
        chosen = snapshot if part is None else snapshot.where(F.col(PART) == part)
        return chosen.select(*self.schema.names).union(tail)

    def append(self, events: DataFrame) -> None:
        events.select(*self.schema.names).write.mode("append").parquet(self._tail_path(self.generation()))

    def append_at_once(self, events: DataFrame) -> None:
        """Append a few rows as one file: a reader sees all of them or none."""
        self.append(events.coalesce(1))

    def start_next(self, snapshot: DataFrame) -> None:
        """Begin a generation with these events and an empty tail. Without a column `part` they are one part."""
        generation = self.generation() + 1
        marked = snapshot if PART in snapshot.columns else snapshot.withColumn(PART, F.lit(ALL))
        shaped = marked.select(*self.schema.names, PART).hint("rebalance", F.col(PART))
        shaped.write.mode("overwrite").partitionBy(PART).parquet(self._place("snapshot", generation))
        self.spark.createDataFrame([], self.schema).coalesce(1).write.mode("overwrite").parquet(self._place("tail", generation))
        number = self.spark.range(1, numPartitions=1).select(
            F.current_timestamp().alias("made_at"), F.lit(generation).cast("bigint").alias("generation")
        )
        number.write.mode("append").partitionBy("generation").parquet(f"{self.path}_log/generations")

    def compact(self, kept: Callable[[DataFrame], DataFrame], after: int) -> bool:
        """Begin a generation with what `kept` leaves of all events, if the tail has more than `after` files."""
        empty = 1 if self.generation() else 0  # the file that a tail begins with
        if len(self.tail().inputFiles()) - empty <= after:
            return False
        self.start_next(kept(self.read()))
        return True
