"""Command line: `spark-submit` this package, or `python -m tallymart`, to run a batch or stream."""

import argparse
import json
import os

from pyspark.sql import SparkSession

from tallymart.plans.batch import Database, Layout, Options, run_batch
from tallymart.plans.load import dimensions_from_jdbc, dimensions_from_parquet
from tallymart.streaming.incremental import ingest_available
from tallymart.workdir import new_folder


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallymart", description="Daily sales files to data marts.")
    parser.add_argument("mode", choices=["batch", "stream"], help="one run, or all new files with a checkpoint")
    parser.add_argument("--inbox", required=True, help="folder the sales files are dropped into")
    parser.add_argument("--base", required=True, help="folder that holds all stores and marts")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--dimensions", help="folder with customer, store and sales_team as Parquet")
    source.add_argument("--jdbc-url", help="database with customer, store and sales_team")
    parser.add_argument("--jdbc-properties", default="{}", help="JSON; values starting with $ name variables")
    parser.add_argument("--publish-tables", action="store_true", help="also fill the database tables")
    parser.add_argument("--clustered-drops", action="store_true", help="each file covers few months")
    parser.add_argument("--on-unfinished", choices=["resume", "fail"], default="resume")
    parser.add_argument("--checkpoint", help="checkpoint folder of the stream")
    parser.add_argument("--files-per-batch", type=int, help="largest number of files in a micro-batch")
    args = parser.parse_args(argv)
    if args.mode == "stream" and not args.checkpoint:
        parser.error("stream needs --checkpoint")
    if args.publish_tables and not args.jdbc_url:
        parser.error("--publish-tables needs --jdbc-url")
    return args


def properties(text: str) -> dict[str, str]:
    """Connection properties; secrets are named as environment variables, not written out."""
    values = json.loads(text)
    return {k: os.environ[v[1:]] if v.startswith("$") else v for k, v in values.items()}


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("tallymart").getOrCreate()
    layout = Layout(args.base)
    database = None
    if args.jdbc_url:
        connection = properties(args.jdbc_properties)
        dims = dimensions_from_jdbc(spark, args.jdbc_url, connection, new_folder(spark, "dimensions"))
        if args.publish_tables:
            database = Database(args.jdbc_url, connection)
    else:
        dims = dimensions_from_parquet(spark, args.dimensions)
    options = Options(clustered_drops=args.clustered_drops, database=database)
    if args.mode == "stream":
        ingest_available(
            spark, args.inbox, dims, layout, args.checkpoint, args.files_per_batch, options
        )
        return
    for result in run_batch(
        spark, args.inbox, dims, layout, on_unfinished=args.on_unfinished, options=options
    ):
        print(f"run {result.run_id}: {result.accepted} files taken, {result.rejected} refused, {result.bad_rows} bad rows")


if __name__ == "__main__":
    main()
