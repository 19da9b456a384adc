"""Where intermediate tables go that belong to no installation."""

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A local session without that setting takes a folder below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created until a job writes there."""
    return f"{shared_folder(spark)}/tallymart-{purpose}-{uuid.uuid4().hex}"
