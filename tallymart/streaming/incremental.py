"""Incremental ingest: each dropped file is taken exactly once."""

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import ledger
from tallymart.errors import NoCsvFiles, NoSourceFiles, NoValidFiles
from tallymart.plans.batch import Layout, Options, check_dimensions, process_files, run_batch
from tallymart.plans.marts import Dimensions
from tallymart.sources.files import file_columns

log = logging.getLogger(__name__)

# Files this much older than the newest one seen are still taken; Spark's own default is 7 days.
MAX_FILE_AGE = "36500d"
_FILE_STATUS = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(
    spark: SparkSession, inbox: str, files_per_batch: int | None = None, max_file_age: str = MAX_FILE_AGE
) -> DataFrame:
    """A stream of file names. Content is never read here: only the name columns are kept."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_STATUS)
    reader = reader.option("recursiveFileLookup", "true").option("maxFileAge", max_file_age)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(inbox).select(*file_columns())


def ingest_available(
    spark: SparkSession,
    inbox: str,
    dims: Dimensions,
    layout: Layout,
    checkpoint: str,
    files_per_batch: int | None = None,
    options: Options = Options(),
    max_file_age: str = MAX_FILE_AGE,
) -> None:
    """Take in every file that arrived since the last call, then stop.

    The checkpoint remembers the files already taken. A micro-batch that is replayed after a
    failure has the same files and the same run id, and so replaces what it wrote before. Files
    that another run closed in the ledger are passed over. A batch without any acceptable file is
    recorded in the manifest and does not stop the stream.

    The stream knows a file by its path and forgets very old ones. So at the end the listing is
    compared with the ledger, and what the stream did not deliver, such as new content under an old
    path, is taken by a batch run.
    """
    check_dimensions(dims)

    def take(batch: DataFrame, epoch: int) -> None:
        # Kept in the checkpoint, so it is the same after a restart.
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if stream_id is None:
            raise RuntimeError("the id of the stream is unknown")
        run_id = f"{stream_id}-{epoch}"
        others = ledger.read(spark, layout.ledger).where(F.col("run_id") != run_id)
        listing = ledger.unprocessed(batch, others)
        try:
            process_files(spark, inbox, listing, dims, layout, run_id, options)
        except (NoSourceFiles, NoCsvFiles, NoValidFiles) as reason:
            log.warning("batch %d holds nothing to process: %s", epoch, reason)

    query = (
        new_files(spark, inbox, files_per_batch or options.files_per_run, max_file_age)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    try:
        run_batch(spark, inbox, dims, layout, options=options)
    except (NoSourceFiles, NoCsvFiles, NoValidFiles) as reason:
        log.info("the stream has left nothing to take: %s", reason)
