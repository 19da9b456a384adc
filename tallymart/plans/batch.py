"""One run: from the files in the inbox to published marts.

Every step writes under the run's id, or new versions of whole months that count from one moment on, so a run that died
half-way is simply run again under the same id. One writer at a time is assumed.
"""

import logging
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart import ledger
from tallymart.errors import NoCsvFiles, NoSourceFiles, NoValidFiles, UnfinishedRun
from tallymart.functions.columns import month_start, sales_month
from tallymart.logs import Log
from tallymart.operators.joins import broadcast_small
from tallymart.plans import marts
from tallymart.plans.marts import Dimensions, Unknown
from tallymart.schemas import (
    ACCEPTED,
    ADDITIONAL,
    CUSTOMER_MONTHLY,
    FACT_PARTITIONS,
    FACT_STORE,
    IDENTITY,
    IGNORED,
    MANIFEST,
    MONTH_STATE,
    MONTH_STATE_PARTITIONS,
    NO_HEADER,
    PUBLISHED,
    REJECTED,
    ROW_BAD,
    ROW_OK,
    SALES_MART,
    SALES_PERSON_MONTHLY,
    SETTLED,
    UNKNOWN,
    UNPARSED,
)
from tallymart.sinks import writers
from tallymart.sources import files as source_files
from tallymart.sources.sales import read_sales, to_store_rows
from tallymart.sources.stores import DIRECT
from tallymart.sources.tables import read_fact, read_store, require_unique_keys, store_exists

log = logging.getLogger(__name__)

# Sales of a month that one task sums up for the state, and that a few files of the fact hold.
STATE_ROWS = 4_000_000
# Rows on their way to the fact: columns that are the same in most rows stand first, side by side, and take next to no bytes.
SHUFFLED = [
    "good",
    "month",
    ADDITIONAL,
    UNPARSED,
    "source_file",
    "store_id",
    "product_name",
    "sales_date",
    "quantity",
    "customer_id",
    "sales_person_id",
    "price",
    "total_cost",
]


class Layout:
    """Where the stores of one installation lie."""

    def __init__(self, base: str) -> None:
        self.ledger = f"{base}/ledger"
        self.manifest = f"{base}/manifest"
        # Refused and ignored deliveries of all manifests, so that no run reads those of earlier ones.
        self.settled = f"{base}/settled"
        self.error_files = f"{base}/error_files"
        self.fact = f"{base}/fact"
        self.customer_mart = f"{base}/customer_mart"
        self.sales_mart = f"{base}/sales_mart"
        self.sales_mart_by_month = f"{base}/sales_mart_by_month"
        # Versions of months, and which version of a month counts: `read_months` reads them.
        self.customer_monthly = f"{base}/customer_monthly"
        self.sales_person_monthly = f"{base}/sales_person_monthly"
        self.report = f"{base}/report"
        self.published = f"{base}/published"
        # Sums by month, batch and key: months are made of them.
        self.month_state = f"{base}/month_state"
        # Intermediate tables, by run; a repeated run replaces its own.
        self.work = f"{base}/work"


@dataclass(frozen=True)
class Database:
    """The database that receives the monthly totals, into staging tables.

    Each run replaces their rows by those of its own months, whole months each; the database
    merges them by deleting these months from its tables and taking over the new rows.
    """

    url: str
    properties: dict[str, str]
    customer_table: str = "customers_data_mart_staging"
    sales_team_table: str = "sales_team_data_mart_staging"


@dataclass(frozen=True)
class Options:
    """`clustered_drops`: each file holds sales of a few months only, as daily files do. The fact
    is then written without a shuffle. Otherwise rows are first gathered by month, so that files
    covering many months do not leave one small file per month and task.

    `files_per_run` bounds the lists of paths that a run keeps on the driver. More files are taken
    in further runs of the same call, until none is left.

    `hot_customer_share`: customers with more than this share of the sales are joined apart.

    `compact_after`: logs that more files than this were added to are compacted when a call begins.

    `direct_schemes`: stores that tasks may open themselves, to read the head of a file and to list
    what Spark's scans pass over. Elsewhere headers take a pass over all text, and such files are not recorded.
    """

    clustered_drops: bool = False
    database: Database | None = None
    files_per_run: int = 50_000
    hot_customer_share: float | None = None
    compact_after: int = 100
    direct_schemes: frozenset[str] = DIRECT


@dataclass(frozen=True)
class RunResult:
    run_id: str
    accepted: int
    rejected: int
    bad_rows: int
    months: tuple[str | None, ...]


def new_run_id() -> str:
    return str(time.time_ns() // 1_000_000)


@dataclass(frozen=True)
class Judged:
    """The verdicts of a run, as its manifest has them, and what the run needs of them on the driver."""

    verdicts: DataFrame
    rows: Sequence[Row]

    def paths(self, status: str) -> list[str]:
        return [r.file_location for r in self.rows if r.status == status]

    def refused_text(self) -> list[str]:
        return [r.file_location for r in self.rows if r.status == REJECTED and r.is_csv]

    def by_header(self) -> dict[tuple[str, ...], list[str]]:
        grouped: dict[tuple[str, ...], list[str]] = {}
        for r in self.rows:
            if r.status == ACCEPTED:
                grouped.setdefault(tuple(r.header), []).append(r.file_location)
        return grouped


def settled(spark: SparkSession, layout: Layout) -> Log:
    """The refused and ignored deliveries. Where that log has not begun, it begins with those of all manifests."""
    log = Log(spark, layout.settled, SETTLED)
    if not log.generation():
        known = read_store(spark, layout.manifest, MANIFEST).where(F.col("status").isin(REJECTED, IGNORED))
        log.start_next(known.select(*SETTLED.names).distinct())
    return log


def compact_logs(spark: SparkSession, layout: Layout, after: int) -> None:
    """Begin new generations of the logs that have grown, so that what a run reads does not grow with runs."""
    ledger.compact(spark, layout.ledger, after)
    settled(spark, layout).compact(DataFrame.distinct, after)
    Log(spark, layout.published, PUBLISHED).compact(DataFrame.distinct, after)


def check_files(
    spark: SparkSession,
    inbox: str,
    listing: DataFrame,
    layout: Layout,
    run_id: str,
    direct: frozenset[str] = DIRECT,
) -> Judged:
    """Judge the listed files, copy refused CSV text to the error area, and record the verdicts.

    The inbox is only read. The manifest comes late: a run that dies before has recorded nothing,
    and its files are judged again. Refused files count as settled last of all.
    """
    log = settled(spark, layout)
    work = writers.run_path(layout.work, run_id)
    # The listing is written down first: a file that arrives meanwhile belongs to the next run.
    writers.write_parquet(listing, f"{work}/listing")
    listing = spark.read.schema(listing.schema).parquet(f"{work}/listing")
    csv = [r.file_location for r in listing.where(F.col("file_name").endswith(".csv")).select("file_location").collect()]
    writers.write_parquet(source_files.manifest(spark, inbox, listing, csv, direct), f"{work}/verdicts")
    verdicts = read_store(spark, f"{work}/verdicts", MANIFEST)
    is_csv = F.col("missing_columns").isNotNull().alias("is_csv")
    judged = Judged(verdicts, verdicts.select("file_location", "header", "status", "reason", is_csv).collect())
    unread = [r.file_location for r in judged.rows if r.reason == NO_HEADER]
    if unread and not source_files.first_lines(spark, inbox, unread).isEmpty():
        raise RuntimeError("the header pass missed a header")
    if judged.refused_text():
        copied = source_files.rejected_lines(spark, judged.refused_text())
        writers.write_parquet(copied, writers.run_path(layout.error_files, run_id))
    path = writers.run_path(layout.manifest, run_id)
    writers.write_parquet(verdicts, path)
    if judged.paths(REJECTED):
        log.append(verdicts.where(F.col("status") == REJECTED))
    return Judged(read_store(spark, path, MANIFEST), judged.rows)


def count_files(judged: Judged) -> tuple[int, int]:
    """How many files were accepted and refused; raises when there is nothing to process."""
    accepted = len(judged.paths(ACCEPTED))
    if not judged.rows:
        raise NoSourceFiles("no file to process")
    if not any(r.is_csv for r in judged.rows):
        raise NoCsvFiles("no CSV file to process")
    if not accepted:
        raise NoValidFiles("no CSV file has all mandatory columns")
    return accepted, len(judged.rows) - accepted


def ingest(
    spark: SparkSession,
    by_header: Mapping[tuple[str, ...], Sequence[str]],
    layout: Layout,
    run_id: str,
    clustered: bool = False,
) -> None:
    """Parse the accepted files once, into the fact store.

    The texts of folder names are made behind the shuffle. A folder's rows lie by store and salesperson, whose texts the marts repeat.
    """
    rows = read_sales(spark, by_header)
    if not clustered:
        good = F.col(UNPARSED).isNull()
        placed = {"good": good, "month": month_start(F.col("sales_date")), "source_file": F.when(~good, F.col("source_file"))}
        rows = writers.gathered(rows.withColumns(placed).select(*SHUFFLED), ["good", "month"])
    writers.write_partitioned(
        to_store_rows(rows, run_id),
        layout.fact,
        FACT_PARTITIONS,
        only_touched=True,
        rebalance=False,
        within=["store_id", "sales_person_id"],
    )


def publish_details(
    spark: SparkSession,
    fact: DataFrame,
    dims: Dimensions,
    layout: Layout,
    run_id: str,
    hot_share: float | None = None,
    unknown: Unknown | None = None,
    by_month: bool = False,
) -> None:
    """The detail marts of one run, beside those of earlier runs.

    Each mart joins only what it shows; that the other keys of a sale are known is checked by the few that are not.
    With `by_month`, each month's sales lie together in few files of the fact. They come out of the joins in that order, so
    their folders get few files without a shuffle.
    """
    sales_mart_path = writers.run_path(layout.sales_mart, run_id)
    writers.write_parquet(
        marts.customer_details(fact, dims, unknown, hot_share), writers.run_path(layout.customer_mart, run_id)
    )
    writers.write_parquet(marts.sales_details(fact, dims, unknown), sales_mart_path)
    sold = read_store(spark, sales_mart_path, SALES_MART).drop("sales_month")
    if not by_month:
        # The text of the month is made behind the shuffle.
        sold = writers.gathered(sold.withColumn("month", month_start(F.col("sales_date"))), ["month", "store_id"])
    writers.write_partitioned(
        sold.withColumn("sales_month", sales_month(F.col("sales_date"))).select(*SALES_MART.names),
        writers.run_path(layout.sales_mart_by_month, run_id),
        ["sales_month", "store_id"],
        rebalance=False,
    )


def in_months(df: DataFrame, months: Sequence[str | None], column: str) -> DataFrame:
    """Rows of the given months; a filter on a partition column, so other folders are not read."""
    named = [m for m in months if m is not None]
    wanted = F.col(column).isin(named)
    return df.where(wanted | F.col(column).isNull() if None in months else wanted)


def update_month_state(spark: SparkSession, layout: Layout, run_id: str) -> None:
    """Add a run's sums to the month state, in place of any it added before.

    The sales of earlier batches are not read again. Only where there is no state yet, it is made of all batches.
    """
    fact = read_fact(spark, layout.fact)
    if store_exists(spark, layout.month_state):
        fact = fact.where(F.col("ingest_batch") == run_id)
    # Counted in the files' footers: the shares of the largest month.
    largest = fact.groupBy("sales_month", "ingest_batch").count().agg(F.max("count")).first()[0] or 0
    writers.write_partitioned(
        marts.month_state(fact, 1 + largest // STATE_ROWS),
        layout.month_state,
        MONTH_STATE_PARTITIONS,
        only_touched=True,
        rebalance=False,
        within=["store_id", "sales_person_id"],
    )


def unknown_keys(
    spark: SparkSession, dims: Dimensions, layout: Layout, months: Sequence[str | None], path: str
) -> Unknown:
    """The keys in the given months' state that no dimension has, stored at `path`: few, as a rule none."""
    state = in_months(read_store(spark, layout.month_state, MONTH_STATE), months, "sales_month")
    writers.write_parquet(marts.unknown_keys(state, dims), path)
    found = read_store(spark, path, UNKNOWN)
    kinds = {r.dimension for r in found.coalesce(1).select("dimension").distinct().collect()}
    return {kind: found.where(F.col("dimension") == kind).select("unknown_key") for kind in kinds}


def months_to_publish(spark: SparkSession, layout: Layout, months: Sequence[str | None]) -> tuple[str | None, ...]:
    """The given months; where no version has been published yet, all months of the state."""
    if Log(spark, layout.published, PUBLISHED).read().inputFiles():
        return tuple(months)
    every = read_store(spark, layout.month_state, MONTH_STATE).select("sales_month").distinct().collect()
    return tuple({*months, *(r.sales_month for r in every)})


def publish_months(
    spark: SparkSession,
    dims: Dimensions,
    layout: Layout,
    months: Sequence[str | None],
    unknown: Unknown | None = None,
) -> None:
    """Make whole months from what all batches added to them, as a new version of just those months.

    Nothing that a reader may have open is touched. One file, written last, makes the version count for all its months, in
    both marts and the report, at once; a call that dies before has published nothing.
    """
    if unknown is None:
        months = months_to_publish(spark, layout, months)
    version = uuid.uuid4().hex
    state = in_months(read_store(spark, layout.month_state, MONTH_STATE), months, "sales_month")
    sellers = writers.version_path(layout.sales_person_monthly, version)
    writers.write_partitioned(
        marts.customer_monthly(state, dims, unknown), writers.version_path(layout.customer_monthly, version), ["sales_date_month"]
    )
    writers.write_partitioned(marts.sales_person_monthly(state, dims, unknown), sellers, ["sales_month"])
    monthly = read_store(spark, sellers, SALES_PERSON_MONTHLY)
    # Each file of the mart holds rows of one month.
    writers.write_csv_report(marts.sales_person_report(monthly), writers.version_path(layout.report, version), ["sales_month"], False)
    rows = spark.createDataFrame([(m, version) for m in months], "sales_month string, version string")
    Log(spark, layout.published, PUBLISHED).append_at_once(rows.withColumn("published_at", F.current_timestamp()))


def current_versions(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per published month with the version that counts."""
    versions = Log(spark, layout.published, PUBLISHED).read()
    return versions.groupBy("sales_month").agg(F.max_by("version", F.struct("published_at", "version")).alias("version"))


def superseded_versions(spark: SparkSession, layout: Layout) -> DataFrame:
    """Versions that no month counts any more, with the time of the last that replaced them.

    Their folders in the two marts and the report may be deleted when their readers are done.
    """
    every = Log(spark, layout.published, PUBLISHED).read()
    current = current_versions(spark, layout).select("version")
    # A month's next version is what replaced it; a version is replaced when the last of its months is.
    after = Window.partitionBy("sales_month").orderBy("published_at", "version")
    replaced = every.withColumn("replaced_at", F.lead("published_at").over(after))
    return (
        replaced.join(current, "version", "left_anti").groupBy("version").agg(F.max("replaced_at").alias("replaced_at"))
    )


def read_months(
    spark: SparkSession,
    layout: Layout,
    path: str,
    schema: T.StructType,
    column: str,
    months: Sequence[str | None] | None = None,
) -> DataFrame:
    """Published months of a mart at `path` (all, or the given ones), each in the version that counts now.

    Which versions count is read once, here: the result stays the same while later versions are published. Only folders of
    these versions are listed, and only those of the months are read.
    """
    current = [r for r in current_versions(spark, layout).collect() if months is None or r.sales_month in months]
    if not current:
        return spark.createDataFrame([], schema)
    folders = sorted({writers.version_path(path, r.version) for r in current})
    # On columns of folder names alone, so it chooses folders; a month that is null adds nothing to the name.
    name = F.concat_ws("/", "version", column)
    return (
        spark.read.schema(T.StructType([*schema, T.StructField("version", T.StringType())]))
        .option("basePath", path)
        .parquet(*folders)
        .where(name.isin([r.version if r.sales_month is None else f"{r.version}/{r.sales_month}" for r in current]))
        .select(*schema.names)
    )


def read_customer_monthly(spark: SparkSession, layout: Layout, months: Sequence[str | None] | None = None) -> DataFrame:
    return read_months(spark, layout, layout.customer_monthly, CUSTOMER_MONTHLY, "sales_date_month", months)


def read_sales_person_monthly(spark: SparkSession, layout: Layout, months: Sequence[str | None] | None = None) -> DataFrame:
    return read_months(spark, layout, layout.sales_person_monthly, SALES_PERSON_MONTHLY, "sales_month", months)


def publish_tables(
    spark: SparkSession, layout: Layout, database: Database, months: Sequence[str | None]
) -> None:
    """Fill the staging tables of the database with the months of a run, and nothing else."""
    customers = read_customer_monthly(spark, layout, months)
    sellers = read_sales_person_monthly(spark, layout, months)
    for rows, name in (
        (writers.customer_table_rows(customers), database.customer_table),
        (sellers, database.sales_team_table),
    ):
        writers.write_jdbc(rows, database.url, name, database.properties, mode="overwrite")


def publish(
    spark: SparkSession, dims: Dimensions, layout: Layout, run_id: str, options: Options
) -> tuple[int, tuple[str | None, ...]]:
    """Publish what the run has in the fact store; how many bad rows it has, and its months."""
    own = F.col("ingest_batch") == run_id
    parts = read_store(spark, layout.fact, FACT_STORE).where(own).groupBy("row_status", "sales_month").count().collect()
    months = tuple(r.sales_month for r in parts if r.row_status == ROW_OK)
    unknown, whole, by_month = None, months, False
    if months:
        update_month_state(spark, layout, run_id)
        whole = months_to_publish(spark, layout, months)
        unknown = unknown_keys(spark, dims, layout, whole, writers.run_path(layout.work, run_id) + "/unknown")
        given = dims
        dims = replace(dims, store=broadcast_small(dims.store), team=broadcast_small(dims.team))
        # Sales keep the order of the fact where nothing shuffles them; a month of many files would leave as many in each folder.
        unshuffled = dims.store is not given.store and dims.team is not given.team and "customer" not in unknown
        by_month = unshuffled and not options.clustered_drops and all(r["count"] <= STATE_ROWS for r in parts)
    fact = read_fact(spark, layout.fact).where(own)
    publish_details(spark, fact, dims, layout, run_id, options.hot_customer_share, unknown, by_month)
    if months:
        publish_months(spark, dims, layout, whole, unknown)
        if options.database is not None:
            publish_tables(spark, layout, options.database, months)
    return sum(r["count"] for r in parts if r.row_status == ROW_BAD), months


def process_files(
    spark: SparkSession,
    inbox: str,
    listing: DataFrame,
    dims: Dimensions,
    layout: Layout,
    run_id: str,
    options: Options = Options(),
) -> RunResult:
    """Take the listed files through one whole run. Repeating it changes nothing."""
    judged = check_files(spark, inbox, listing, layout, run_id, options.direct_schemes)
    accepted, rejected = count_files(judged)
    opened = judged.verdicts.where(F.col("status") == ACCEPTED)
    ledger.append(ledger.open_events(opened, run_id), layout.ledger)
    ingest(spark, judged.by_header(), layout, run_id, options.clustered_drops)
    bad_rows, months = publish(spark, dims, layout, run_id, options)
    ledger.append(ledger.close_events(opened, run_id), layout.ledger)
    log.info("run %s: %d files taken, %d refused, %d bad rows", run_id, accepted, rejected, bad_rows)
    return RunResult(run_id, accepted, rejected, bad_rows, months)


def pending_files(spark: SparkSession, inbox: str, layout: Layout) -> DataFrame:
    """Deliveries in the inbox that no run has closed or refused."""
    refused = settled(spark, layout).read().where(F.col("status") == REJECTED)
    closed = ledger.closed(ledger.read(spark, layout.ledger))
    done = closed.select(*IDENTITY).union(refused.select(*IDENTITY))
    return ledger.among(source_files.list_files(spark, inbox), done, "left_anti")


def record_ignored(spark: SparkSession, inbox: str, layout: Layout, run_id: str, direct: frozenset[str] = DIRECT) -> None:
    """Add to the manifest the files that no scan shows and no run has recorded yet."""
    log = settled(spark, layout)
    work = writers.run_path(layout.work, run_id)
    found = source_files.ignored(spark, inbox, f"{work}/listed", direct)
    if found is None or found.isEmpty():
        return
    known = log.read().where(F.col("status") == IGNORED)
    # Written down first: the log it is compared with is the one it is added to.
    writers.write_parquet(ledger.among(found, known, "left_anti"), f"{work}/ignored")
    new = read_store(spark, f"{work}/ignored", MANIFEST)
    if not new.isEmpty():
        new.write.mode("append").parquet(writers.run_path(layout.manifest, f"{run_id}-ignored"))
        log.append(new)


def check_dimensions(dims: Dimensions) -> None:
    require_unique_keys((dims.customer, "customer_id"), (dims.store, "id"), (dims.team, "id"))


def _repeat(
    spark: SparkSession,
    inbox: str,
    dims: Dimensions,
    layout: Layout,
    run_id: str,
    open_files: DataFrame,
    options: Options,
) -> RunResult | None:
    """Do a dead run again with those of its files that are there, and record the others as lost.

    If none is left, what the run has stored of them is published.
    """
    opened = open_files.where(F.col("run_id") == run_id)
    judged = read_store(spark, writers.run_path(layout.manifest, run_id), MANIFEST)
    own = ledger.with_identity(opened).select(*IDENTITY).union(judged.select(*IDENTITY))
    listing = ledger.among(source_files.list_files(spark, inbox), own)
    lost = ledger.among(opened, listing, "left_anti")
    # First: the manifest, which the listing is made of, is replaced when the run is done again.
    ledger.append(ledger.lost_events(lost, run_id), layout.ledger)
    if ledger.among(opened, listing).isEmpty():
        publish(spark, dims, layout, run_id, options)
        return None
    return process_files(spark, inbox, listing, dims, layout, run_id, options)


def run_batch(
    spark: SparkSession,
    inbox: str,
    dims: Dimensions,
    layout: Layout,
    run_id: str | None = None,
    on_unfinished: str = "resume",
    options: Options = Options(),
) -> list[RunResult]:
    """Process everything new in the inbox, in runs of at most `options.files_per_run` files.

    Runs that never closed their files are done again first, each under its own id and with its
    own files, or stop this call when `on_unfinished` is "fail". A run whose files are refused does
    not stop those after it; the call fails if no run could take a file.
    """
    check_dimensions(dims)
    compact_logs(spark, layout, options.compact_after)
    results = []
    open_files = ledger.unfinished(ledger.read_open(spark, layout.ledger))
    runs = sorted(r.run_id for r in open_files.select("run_id").distinct().collect())
    if runs and on_unfinished == "fail":
        raise UnfinishedRun(f"not finished: {', '.join(runs)}")
    for earlier in runs:
        # Read anew: the events of the run before it are in the ledger by now.
        still_open = ledger.unfinished(ledger.read_open(spark, layout.ledger))
        repeated = _repeat(spark, inbox, dims, layout, earlier, still_open, options)
        results += [repeated] if repeated else []
    first, count, refusal, more = run_id or new_run_id(), 0, None, True
    record_ignored(spark, inbox, layout, first, options.direct_schemes)
    while more:
        name = first if not count else f"{first}.{count}"
        listing = pending_files(spark, inbox, layout).orderBy(*IDENTITY).limit(options.files_per_run)
        try:
            done = process_files(spark, inbox, listing, dims, layout, name, options)
            results.append(done)
            more = done.accepted + done.rejected == options.files_per_run
        except NoSourceFiles:
            if not (count or results or runs):
                raise
            break
        except (NoCsvFiles, NoValidFiles) as refused:
            refusal, more = refused, not pending_files(spark, inbox, layout).isEmpty()
        count += 1
    if refusal is not None and not results:
        raise refusal
    return results
