"""Every operator as a query over the order tables.

Each query reads whole tables. Those about files first write the sales lines as CSV drops to a
fresh folder in the shared folder of the cluster, then run the engine on that inbox.
"""

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import ledger, schemas
from tallymart.functions.columns import fold_extras, sales_month
from tallymart.operators import joins, ranking, totals
from tallymart.plans import marts, star
from tallymart.plans.batch import Judged, Layout, check_files, ingest, read_customer_monthly, read_sales_person_monthly, run_batch
from tallymart.schemas import ADDITIONAL, CANONICAL, MANDATORY
from tallymart.sinks import writers
from tallymart.sources import files, sales
from tallymart.sources.tables import read_bad_rows, read_fact, read_store
from tallymart.streaming.incremental import ingest_available
from tallymart.workdir import new_folder

Query = Callable[[SparkSession, str], DataFrame]


# --- fact, star join, detail marts -----------------------------------------------------------


def sales_fact(spark: SparkSession, folder: str) -> DataFrame:
    return star.sales_fact(spark, folder)


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return marts.enriched(star.sales_keys(spark, folder), star.dimensions(spark, folder))


def fact_customer_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.sales_keys(spark, folder).select("customer_id", "sales_date", "total_cost")
    return joins.with_customer(lines, star.dimensions(spark, folder).customer)


def fact_store_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.sales_keys(spark, folder).select("store_id", "sales_date", "total_cost")
    return joins.with_store(lines, star.dimensions(spark, folder).store)


def fact_sales_team_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.sales_keys(spark, folder).select("sales_person_id", "sales_date", "total_cost")
    return joins.with_sales_person(lines, star.dimensions(spark, folder).team)


def hot_customer_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.sales_keys(spark, folder).select("customer_id", "sales_date", "total_cost")
    people = star.dimensions(spark, folder).customer.select("customer_id", "first_name", "last_name", "address")
    return joins.join_hot_keys(lines, people, "customer_id", "customer_id")


def customer_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_mart(_enriched(spark, folder))


def sales_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_mart(_enriched(spark, folder))


def _stored(mart: DataFrame) -> DataFrame:
    """Rows that are read twice, stored: what they are made of is not joined twice."""
    path = new_folder(mart.sparkSession, "mart")
    writers.write_parquet(mart, path)
    return mart.sparkSession.read.schema(mart.schema).parquet(path)


# --- monthly totals, windows, ranks ----------------------------------------------------------


def customer_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_monthly(star.sales_keys(spark, folder), star.dimensions(spark, folder))


def customer_monthly_sales_window(spark: SparkSession, folder: str) -> DataFrame:
    return totals.customer_monthly_of(customer_mart(spark, folder), keep=_stored)


def customer_line_totals(spark: SparkSession, folder: str) -> DataFrame:
    lines = customer_mart(spark, folder).select(
        "customer_id", "sales_date", "total_cost", sales_month(F.col("sales_date")).alias("sales_date_month")
    )
    return totals.with_group_total(_stored(lines), ["customer_id", "sales_date_month"], "total_cost", "month_total")


def sales_person_line_totals(spark: SparkSession, folder: str) -> DataFrame:
    lines = sales_mart(spark, folder).select(
        "store_id", "sales_person_id", "sales_date", "sales_month", "total_cost"
    )
    return totals.with_group_total(
        _stored(lines), ["store_id", "sales_person_id", "sales_month"], "total_cost", "month_total"
    )


def _sales_person_totals(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_person_totals(star.sales_keys(spark, folder), star.dimensions(spark, folder))


def sales_person_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return totals.seller_names(_sales_person_totals(spark, folder), star.dimensions(spark, folder).team)


def sales_person_monthly_window(spark: SparkSession, folder: str) -> DataFrame:
    return totals.sales_person_monthly_of(sales_mart(spark, folder), keep=_stored)


def sales_person_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.with_rank(_sales_person_totals(spark, folder))


def sales_person_incentive(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_person_monthly(star.sales_keys(spark, folder), star.dimensions(spark, folder))


def top_sellers(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_sellers(_sales_person_totals(spark, folder))


def distinct_months(spark: SparkSession, folder: str) -> DataFrame:
    # Months of the orders that have lines; orders are distinct before months are formed.
    days = star.sales_keys(spark, folder).select("sales_date").distinct()
    return days.select(sales_month(F.col("sales_date")).alias("sales_month")).distinct()


# --- unifying columns ------------------------------------------------------------------------


def fold_extra_columns(spark: SparkSession, folder: str) -> DataFrame:
    # Null stands for one value of each extra, so either one or both of them can be missing.
    first = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    second = F.when(F.col("l_linestatus") != "F", F.col("l_linestatus"))
    return star.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", fold_extras([first, second]).alias(ADDITIONAL)
    )


def no_extra_columns(spark: SparkSession, folder: str) -> DataFrame:
    return star.sales_lines(spark, folder).select(*MANDATORY, fold_extras([]).alias(ADDITIONAL))


def empty_frame_union(spark: SparkSession, folder: str) -> DataFrame:
    return sales.stack_by_position([sales.empty_sales(spark), star.sales_fact(spark, folder)])


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = star.sales_lines(spark, folder)
    first = F.col("l_linestatus") == "F"
    return lines.where(first), lines.where(~first)


def union_by_position(spark: SparkSession, folder: str) -> DataFrame:
    folded = fold_extras([F.col(c) for c in star.EXTRAS]).alias(ADDITIONAL)
    parts = [half.select(*MANDATORY, folded) for half in _halves(spark, folder)]
    return sales.stack_by_position(parts)


def union_by_name_missing(spark: SparkSession, folder: str) -> DataFrame:
    plain, extended = _halves(spark, folder)
    folded = fold_extras([F.col(c) for c in star.EXTRAS]).alias(ADDITIONAL)
    return sales.stack_by_name([plain.select(*reversed(MANDATORY)), extended.select(folded, *MANDATORY)]).select(
        *CANONICAL
    )


# --- sources and sinks -----------------------------------------------------------------------


def _drop(lines: DataFrame, path: str) -> None:
    lines.write.option("header", "true").csv(path)


def _drops(spark: SparkSession, folder: str) -> str:
    """An inbox with drops of four kinds, one folder per kind and year."""
    inbox = new_folder(spark, "inbox")
    lines = star.sales_lines(spark, folder).withColumn("year", F.year("sales_date"))
    flag = F.col("l_returnflag")
    plain, extended = [*MANDATORY, "year"], [*MANDATORY, *star.EXTRAS, "year"]
    lacking = [c for c in extended if c != "store_id"]
    for kind, chosen, columns in (
        ("plain", flag == "A", plain),
        ("extended", flag == "N", extended),
        ("lacking", flag == "R", lacking),
    ):
        writer = lines.where(chosen).select(*columns).write.partitionBy("year")
        writer.option("header", "true").csv(f"{inbox}/{kind}")
    notes = star.table(spark, folder, "part").select(F.concat_ws(" ", "p_brand", "p_name"))
    notes.write.text(f"{inbox}/notes/year=0")
    return inbox


def _kind_and_year(path: Column, inbox: str) -> list[Column]:
    below = F.substring_index(path, inbox.rsplit("/", 1)[1] + "/", -1)
    return [
        F.split_part(below, F.lit("/"), F.lit(1)).alias("kind"),
        F.regexp_extract(below, r"year=(\d+)", 1).cast("int").alias("year"),
    ]


def source_listing(spark: SparkSession, folder: str) -> DataFrame:
    inbox = _drops(spark, folder)
    listed = files.list_files(spark, inbox).select(
        *_kind_and_year(F.col("file_location"), inbox),
        F.regexp_extract("file_name", r"(\.\w+)$", 1).alias("extension"),
        F.col("file_name").endswith(".csv").alias("is_csv"),
    )
    return listed.distinct()


def header_manifest(spark: SparkSession, folder: str) -> DataFrame:
    inbox = _drops(spark, folder)
    verdicts = files.manifest(spark, inbox)
    return verdicts.select(
        *_kind_and_year(F.col("file_location"), inbox),
        F.array_join("header", ",").alias("header"),
        F.array_join("missing_columns", ",").alias("missing_columns"),
        "status",
        "reason",
    ).distinct()


def unseen_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files that no scan shows: lines still in a staging folder, by year, below an inbox with a drop beside it."""
    inbox = new_folder(spark, "inbox")
    lines = star.sales_lines(spark, folder).withColumn("year", F.year("sales_date"))
    lines.select(*MANDATORY, "year").write.partitionBy("year").csv(f"{inbox}/_staged")
    _drop(lines.select(*MANDATORY), f"{inbox}/all")
    found = files.ignored(spark, inbox, new_folder(spark, "listed"))
    if found is None:
        raise ValueError("tasks cannot open this inbox themselves")
    # Spark's own marker and check-sum files are hidden as well, and differ from store to store.
    data = found.where(F.col("file_name").endswith(".csv"))
    return data.select(*_kind_and_year(F.col("file_location"), inbox), "status", "reason").distinct()


def _judged(spark: SparkSession, inbox: str, layout: Layout) -> Judged:
    return check_files(spark, inbox, files.list_files(spark, inbox), layout, "run")


def rejected_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    inbox = _drops(spark, folder)
    layout = Layout(new_folder(spark, "stores"))
    _judged(spark, inbox, layout)
    lines = spark.read.parquet(layout.error_files)
    # Header lines, one per file, are not counted: the number of files is up to the writer.
    return (
        lines.where(~F.col("line").startswith("customer_id,"))
        .groupBy(_kind_and_year(F.col("source_file"), inbox)[1])
        .agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("line").alias("distinct_lines"))
    )


def csv_ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    inbox = new_folder(spark, "inbox")
    _drop(star.sales_lines(spark, folder), f"{inbox}/all")
    judged = _judged(spark, inbox, Layout(new_folder(spark, "stores")))
    return sales.read_sales(spark, judged.by_header()).select(*CANONICAL)


def mixed_header_ingest(spark: SparkSession, folder: str) -> DataFrame:
    inbox = _drops(spark, folder)
    layout = Layout(new_folder(spark, "stores"))
    ingest(spark, _judged(spark, inbox, layout).by_header(), layout, "mixed")
    return read_fact(spark, layout.fact).select(*CANONICAL, "sales_month")


def bad_row_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    inbox = new_folder(spark, "inbox")
    layout = Layout(new_folder(spark, "stores"))
    person = F.col("sales_person_id").cast("string")
    listed = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("<"), person, F.lit(", 0>"))).otherwise(person)
    cost = F.col("total_cost").cast("string")
    # A part of a cent does not fit, and is not rounded away.
    exact = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.concat(cost, F.lit("5"))).otherwise(cost)
    lines = star.sales_lines(spark, folder).withColumns({"sales_person_id": listed, "total_cost": exact})
    _drop(lines.select(*MANDATORY), f"{inbox}/all")
    ingest(spark, _judged(spark, inbox, layout).by_header(), layout, "quarantine")
    return read_bad_rows(spark, layout.fact).select("unparsed_line", "ingest_batch")


def partitioned_mart_readback(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "mart")
    writers.write_partitioned(sales_mart(spark, folder), path, ["sales_month", "store_id"])
    return read_store(spark, path, schemas.SALES_MART)


def parquet_mart_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "mart")
    writers.write_parquet(customer_mart(spark, folder), path)
    return read_store(spark, path, schemas.CUSTOMER_MART)


def run_stamped_publish(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "mart")
    dims = star.dimensions(spark, folder)
    for run_id, half in zip(("first", "second"), _halves(spark, folder)):
        mart = marts.sales_mart(marts.enriched(half, dims))
        writers.write_parquet(mart, writers.run_path(path, run_id))
    return spark.read.parquet(path)


def monthly_csv_report(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "report")
    report = marts.sales_person_report(sales_person_incentive(spark, folder))
    writers.write_csv_report(report, path, ["sales_month"])
    return spark.read.schema(report.schema).option("header", "true").csv(path).select(*report.columns)


def customer_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    return writers.customer_table_rows(customer_monthly_sales(spark, folder))


# --- ledger: every order is a dropped file ---------------------------------------------------


def _order_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A listing with one file per order, and the ledger of the runs over it.

    One run per month opens the orders of that month. It closes those that are finished a day
    later. Urgent orders were opened again by a later run that has not ended.
    """
    listing = star.table(spark, folder, "orders").select(
        F.concat(F.lit("sales_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
        F.concat(F.lit("inbox/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_location"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("day"),
        "o_orderstatus",
        "o_orderpriority",
    )
    run = sales_month(F.col("day").cast("date"))
    day = F.timestamp_add("DAY", F.lit(1), F.col("day"))
    week = F.timestamp_add("DAY", F.lit(7), F.col("day"))
    known = listing.where(F.col("o_orderstatus") != "P")
    finished = listing.where(F.col("o_orderstatus") == "F")
    again = finished.where(F.col("o_orderpriority") == "1-URGENT")
    events = (
        ledger.open_events(known, run, F.col("day"))
        .unionByName(ledger.close_events(finished, run, day))
        .unionByName(ledger.open_events(again, F.concat(run, F.lit("-again")), week))
    )
    return listing.select("file_name", "file_location"), events


def ledger_events(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "ledger")
    ledger.append(_order_files(spark, folder)[1], path)
    return _plain_times(ledger.read(spark, path)).drop("modification_time", "length")


def _plain_times(df: DataFrame) -> DataFrame:
    times = {c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(times)


def ledger_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_times(ledger.latest(_order_files(spark, folder)[1])).drop("modification_time", "length")


def ledger_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The state of the deliveries, from a snapshot of the first events and the events after it."""
    path, events = new_folder(spark, "ledger"), _order_files(spark, folder)[1]
    ledger.append(events.where(F.col("status") == ledger.OPEN), path)
    ledger.compact(spark, path, 0)
    ledger.append(events.where(F.col("status") != ledger.OPEN), path)
    return _plain_times(ledger.latest(ledger.read(spark, path))).drop("modification_time", "length")


def ledger_unfinished(spark: SparkSession, folder: str) -> DataFrame:
    listing, events = _order_files(spark, folder)
    return ledger.left_behind(listing, events)


def ledger_unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    listing, events = _order_files(spark, folder)
    return ledger.unprocessed(listing, events)


# --- whole runs ------------------------------------------------------------------------------


def batch_run(spark: SparkSession, folder: str) -> DataFrame:
    inbox, layout = new_folder(spark, "inbox"), Layout(new_folder(spark, "stores"))
    _drop(star.sales_lines(spark, folder), f"{inbox}/all")
    run_batch(spark, inbox, star.dimensions(spark, folder), layout)
    return read_sales_person_monthly(spark, layout)


def late_month_recompute(spark: SparkSession, folder: str) -> DataFrame:
    inbox, layout = new_folder(spark, "inbox"), Layout(new_folder(spark, "stores"))
    dims = star.dimensions(spark, folder)
    for number, half in enumerate(_halves(spark, folder)):
        _drop(half, f"{inbox}/drop{number}")
        run_batch(spark, inbox, dims, layout)
    return read_customer_monthly(spark, layout)


def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    inbox, layout = new_folder(spark, "inbox"), Layout(new_folder(spark, "stores"))
    checkpoint = new_folder(spark, "checkpoint")
    dims = star.dimensions(spark, folder)
    for number, half in enumerate(_halves(spark, folder)):
        _drop(half, f"{inbox}/drop{number}")
        ingest_available(spark, inbox, dims, layout, checkpoint)
    return read_sales_person_monthly(spark, layout)


def _made(lines: DataFrame) -> str:
    made = new_folder(lines.sparkSession, "made")
    _drop(lines, made)
    return made


def _deliver(made: str, inbox: str, name: str) -> None:
    """CSV files of fixed names, in place of any delivered under them before."""
    store, source = fs.FileSystem.from_uri(made)
    target = fs.FileSystem.from_uri(inbox)[1]
    store.create_dir(target, recursive=True)
    parts = sorted(f.path for f in store.get_file_info(fs.FileSelector(source)) if f.base_name.endswith(".csv"))
    for i, part in enumerate(parts):
        store.move(part, f"{target}/{name}-{i}.csv")


def redelivered_file_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The same path gets a second content: both deliveries count."""
    inbox, layout = new_folder(spark, "inbox"), Layout(new_folder(spark, "stores"))
    dims = star.dimensions(spark, folder)
    for half in _halves(spark, folder):
        _deliver(_made(half.select(*MANDATORY)), inbox, "sales")
        run_batch(spark, inbox, dims, layout)
    return read_sales_person_monthly(spark, layout)


def refused_then_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """A refused file is corrected in place and taken by the next run."""
    inbox, layout = new_folder(spark, "inbox"), Layout(new_folder(spark, "stores"))
    dims = star.dimensions(spark, folder)
    first, second = (half.select(*MANDATORY) for half in _halves(spark, folder))
    # The files with the error are made of the correct ones, so that their lines are joined once.
    correct = _made(second)
    with_error = spark.read.option("header", "true").csv(correct).drop("store_id")
    _deliver(_made(first), inbox, "good")
    _deliver(_made(with_error), inbox, "fixed")
    run_batch(spark, inbox, dims, layout)
    _deliver(correct, inbox, "fixed")
    run_batch(spark, inbox, dims, layout)
    return read_customer_monthly(spark, layout)


QUERIES: dict[str, Query] = {
    "sales_fact": sales_fact,
    "enriched_sales": _enriched,
    **{
        query.__name__: query
        for query in (
            fact_customer_join,
            fact_store_join,
            fact_sales_team_join,
            hot_customer_join,
            customer_mart,
            sales_mart,
            customer_monthly_sales,
            customer_monthly_sales_window,
            customer_line_totals,
            sales_person_line_totals,
            sales_person_monthly,
            sales_person_monthly_window,
            sales_person_rank,
            sales_person_incentive,
            top_sellers,
            distinct_months,
            fold_extra_columns,
            no_extra_columns,
            empty_frame_union,
            union_by_position,
            union_by_name_missing,
            source_listing,
            header_manifest,
            unseen_listing,
            rejected_file_lines,
            csv_ingest_roundtrip,
            mixed_header_ingest,
            bad_row_quarantine,
            partitioned_mart_readback,
            parquet_mart_roundtrip,
            run_stamped_publish,
            monthly_csv_report,
            customer_table_rows,
            ledger_events,
            ledger_latest,
            ledger_compacted,
            ledger_unfinished,
            ledger_unprocessed,
            batch_run,
            late_month_recompute,
            incremental_ingest,
            redelivered_file_ingest,
            refused_then_corrected,
        )
    },
}
