"""The same results as plain SQL over the order tables, for comparison."""

_FACT = """
lines AS (
  SELECT o_custkey AS customer_id, CAST(s_nationkey AS BIGINT) AS store_id, p_name AS product_name,
         CAST(o_orderdate AS DATE) AS sales_date, l_suppkey AS sales_person_id,
         CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         l_returnflag, l_linestatus, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
         CAST(l_quantity AS BIGINT) AS pieces
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey),
fact AS (
  SELECT customer_id, store_id, product_name, sales_date, sales_person_id,
         CAST(((2 * cents + pieces) // (2 * pieces)) * 0.01 AS DECIMAL(18,2)) AS price, quantity, total_cost,
         l_returnflag || ', ' || l_linestatus AS additional_column, l_returnflag, l_linestatus,
         substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month
  FROM lines)"""
_STAR = """
ct AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, n_name AS address,
         CAST(c_nationkey AS VARCHAR) AS pincode, CAST(c_custkey AS VARCHAR) AS phone_number
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
sd AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS store_address, r_name AS store_manager_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
st AS (
  SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS sales_person_first_name,
         split_part(s_name, '#', 2) AS sales_person_last_name, CAST(s_nationkey AS BIGINT) AS manager_id,
         'N' AS is_manager, n_name AS sales_person_address,
         CAST(s_nationkey AS VARCHAR) AS sales_person_pincode, CAST(NULL AS DATE) AS joining_date
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
enriched AS (
  SELECT fact.*, first_name, last_name, address, pincode, phone_number, store_address, store_manager_name,
         sales_person_first_name, sales_person_last_name, manager_id, is_manager, sales_person_address,
         sales_person_pincode, joining_date
  FROM fact JOIN ct USING (customer_id) JOIN sd ON sd.id = store_id JOIN st ON st.id = sales_person_id),
customer_totals AS (
  SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
         sales_month AS sales_date_month, CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched GROUP BY ALL),
seller_totals AS (
  SELECT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         sales_month, CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched GROUP BY ALL),
ranked AS (
  SELECT *, CAST(RANK() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS INT) AS rnk
  FROM seller_totals),
incentives AS (
  SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
         CAST(ROUND(CASE WHEN rnk = 1 THEN total_sales * 0.01 ELSE 0.00 END, 2) AS DECIMAL(18,2)) AS incentive
  FROM ranked)"""
_CANONICAL = (
    "customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost, additional_column"
)
_MANDATORY = _CANONICAL.removesuffix(", additional_column")
_CUSTOMER_MART = "customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost"
_SALES_MART = (
    "store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name, manager_id,"
    " is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost, sales_month"
)
_DROPS = f"""
drops AS (
  SELECT DISTINCT year, kind, header, missing_columns FROM (
    SELECT CAST(EXTRACT(year FROM sales_date) AS INT) AS year,
           CASE l_returnflag WHEN 'A' THEN 'plain' WHEN 'N' THEN 'extended' ELSE 'lacking' END AS kind,
           CASE l_returnflag WHEN 'A' THEN '{_MANDATORY.replace(', ', ',')}'
                WHEN 'N' THEN '{_MANDATORY.replace(', ', ',')},l_returnflag,l_linestatus'
                ELSE '{_MANDATORY.replace(', ', ',').replace('store_id,', '')},l_returnflag,l_linestatus' END AS header,
           CASE WHEN l_returnflag IN ('A', 'N') THEN '' ELSE 'store_id' END AS missing_columns
    FROM fact))"""
_LEDGER = """
known AS (
  SELECT 'sales_' || o_orderkey || '.csv' AS file_name, 'inbox/' || o_orderkey || '.csv' AS file_location,
         o_orderdate AS day, substring(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS run,
         o_orderstatus, o_orderpriority FROM orders),
events AS (
  SELECT file_name, file_location, run AS run_id, day AS event_time, 'A' AS status FROM known WHERE o_orderstatus <> 'P'
  UNION ALL SELECT file_name, file_location, run, day + INTERVAL 1 DAY, 'I' FROM known WHERE o_orderstatus = 'F'
  UNION ALL SELECT file_name, file_location, run || '-again', day + INTERVAL 7 DAY, 'A' FROM known
            WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
latest AS (
  SELECT file_name, file_location, run_id,
         MAX(CASE WHEN status = 'A' THEN event_time END) OVER (PARTITION BY file_location) AS created_date,
         CASE WHEN status = 'I' THEN event_time END AS updated_date, status
  FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY file_location ORDER BY event_time DESC, status DESC) = 1)"""


def _fact(select: str) -> str:
    return f"WITH {_FACT} {select}"


def _star(select: str) -> str:
    return f"WITH {_FACT}, {_STAR} {select}"


_MONTHLY = _star("SELECT * FROM incentives")
_CUSTOMER_MONTHLY = _star("SELECT * FROM customer_totals")

ORACLE: dict[str, str] = {
    "sales_fact": _fact(f"SELECT {_CANONICAL} FROM fact"),
    "enriched_sales": _star(
        "SELECT customer_id, store_id, sales_date, sales_person_id, total_cost, first_name, last_name, address,"
        " pincode, phone_number, store_address, store_manager_name, sales_person_first_name,"
        " sales_person_last_name, manager_id, is_manager, sales_person_address, sales_person_pincode,"
        " joining_date FROM enriched"
    ),
    "fact_customer_join": _star(
        "SELECT customer_id, sales_date, total_cost, first_name, last_name, address, pincode, phone_number"
        " FROM fact JOIN ct USING (customer_id)"
    ),
    "fact_store_join": _star(
        "SELECT store_id, sales_date, total_cost, store_address, store_manager_name"
        " FROM fact JOIN sd ON sd.id = store_id"
    ),
    "fact_sales_team_join": _star(
        "SELECT sales_person_id, sales_date, total_cost, sales_person_first_name, sales_person_last_name,"
        " manager_id, is_manager, sales_person_address, sales_person_pincode, joining_date"
        " FROM fact JOIN st ON st.id = sales_person_id"
    ),
    "hot_customer_join": _star(
        "SELECT customer_id, sales_date, total_cost, first_name, last_name, address FROM fact JOIN ct USING (customer_id)"
    ),
    "customer_mart": _star(f"SELECT {_CUSTOMER_MART} FROM enriched"),
    "sales_mart": _star(f"SELECT {_SALES_MART} FROM enriched"),
    "customer_monthly_sales": _CUSTOMER_MONTHLY,
    "customer_monthly_sales_window": _star(
        "SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,"
        " sales_month AS sales_date_month,"
        " CAST(SUM(total_cost) OVER (PARTITION BY customer_id, sales_month) AS DECIMAL(18,2)) AS total_sales"
        " FROM enriched"
    ),
    "customer_line_totals": _star(
        "SELECT customer_id, sales_date, total_cost, sales_month AS sales_date_month,"
        " CAST(SUM(total_cost) OVER (PARTITION BY customer_id, sales_month) AS DECIMAL(18,2)) AS month_total"
        " FROM enriched"
    ),
    "sales_person_line_totals": _star(
        "SELECT store_id, sales_person_id, sales_date, sales_month, total_cost,"
        " CAST(SUM(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month) AS DECIMAL(18,2))"
        " AS month_total FROM enriched"
    ),
    "sales_person_monthly": _star("SELECT * FROM seller_totals"),
    "sales_person_monthly_window": _star(
        "SELECT DISTINCT store_id, sales_person_id,"
        " sales_person_first_name || ' ' || sales_person_last_name AS full_name, sales_month,"
        " CAST(SUM(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month) AS DECIMAL(18,2))"
        " AS total_sales FROM enriched"
    ),
    "sales_person_rank": _star("SELECT store_id, sales_person_id, sales_month, total_sales, rnk FROM ranked"),
    "sales_person_incentive": _MONTHLY,
    "top_sellers": _star(
        "SELECT store_id, sales_person_id, sales_month, total_sales FROM ranked WHERE rnk = 1"
    ),
    "distinct_months": _fact("SELECT DISTINCT sales_month FROM fact"),
    "fold_extra_columns": (
        "SELECT l_orderkey, l_linenumber, concat_ws(', ', CASE WHEN l_returnflag <> 'N' THEN l_returnflag END,"
        " CASE WHEN l_linestatus <> 'F' THEN l_linestatus END) AS additional_column FROM lineitem"
    ),
    "no_extra_columns": _fact(f"SELECT {_MANDATORY}, CAST(NULL AS VARCHAR) AS additional_column FROM fact"),
    "empty_frame_union": _fact(f"SELECT {_CANONICAL} FROM fact"),
    "union_by_position": _fact(
        f"SELECT {_CANONICAL} FROM fact WHERE l_linestatus = 'F'"
        f" UNION ALL SELECT {_CANONICAL} FROM fact WHERE l_linestatus <> 'F'"
    ),
    "union_by_name_missing": _fact(
        f"SELECT {_MANDATORY}, CASE WHEN l_linestatus <> 'F' THEN additional_column END AS additional_column FROM fact"
    ),
    "source_listing": (
        f"WITH {_FACT}, {_DROPS} SELECT kind, year, '.csv' AS extension, TRUE AS is_csv FROM drops"
        " UNION SELECT 'notes', 0, '.txt', FALSE FROM part"
    ),
    "unseen_listing": (
        f"WITH {_FACT} SELECT DISTINCT '_staged' AS kind, CAST(EXTRACT(year FROM sales_date) AS INT) AS year,"
        " 'ignored' AS status, 'hidden name' AS reason FROM fact"
    ),
    "header_manifest": (
        f"WITH {_FACT}, {_DROPS} SELECT kind, year, header, missing_columns,"
        " CASE WHEN missing_columns = '' THEN 'accepted' ELSE 'rejected' END AS status,"
        " CASE WHEN missing_columns <> '' THEN 'missing ' || missing_columns END AS reason FROM drops"
        " UNION SELECT 'notes', 0, NULL, NULL, 'rejected', 'not a .csv file' FROM part"
    ),
    "rejected_file_lines": _fact(
        "SELECT CAST(EXTRACT(year FROM sales_date) AS INT) AS year, COUNT(*) AS lines,"
        " COUNT(DISTINCT concat_ws(',', customer_id, product_name, sales_date, sales_person_id, price, quantity,"
        " total_cost, l_returnflag, l_linestatus)) AS distinct_lines"
        " FROM fact WHERE l_returnflag = 'R' GROUP BY 1"
    ),
    "csv_ingest_roundtrip": _fact(f"SELECT {_CANONICAL} FROM fact"),
    "mixed_header_ingest": _fact(
        f"SELECT {_MANDATORY}, CASE WHEN l_returnflag = 'N' THEN additional_column END AS additional_column,"
        " sales_month FROM fact WHERE l_returnflag IN ('A', 'N')"
    ),
    "bad_row_quarantine": _fact(
        "SELECT concat_ws(',', customer_id, store_id, product_name, sales_date,"
        " CASE WHEN l_returnflag = 'R' THEN '\"<' || sales_person_id || ', 0>\"' ELSE CAST(sales_person_id AS VARCHAR) END,"
        " price, quantity, total_cost || CASE WHEN l_returnflag = 'N' THEN '5' ELSE '' END) AS unparsed_line,"
        " 'quarantine' AS ingest_batch FROM fact WHERE l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linestatus = 'F')"
    ),
    "partitioned_mart_readback": _star(f"SELECT {_SALES_MART} FROM enriched"),
    "parquet_mart_roundtrip": _star(f"SELECT {_CUSTOMER_MART} FROM enriched"),
    "run_stamped_publish": _star(
        f"SELECT {_SALES_MART}, CASE WHEN l_linestatus = 'F' THEN 'first' ELSE 'second' END AS run_id FROM enriched"
    ),
    "monthly_csv_report": _star(
        "SELECT full_name AS sales_person_name, store_id, sales_month, total_sales AS total_billing,"
        " incentive AS total_incentive FROM incentives"
    ),
    "customer_table_rows": _star(
        "SELECT customer_id, full_name, address, phone_number,"
        " CAST(sales_date_month || '-01' AS DATE) AS sales_date_month, total_sales FROM customer_totals"
    ),
    "ledger_events": f"WITH {_LEDGER} SELECT * FROM events",
    "ledger_latest": f"WITH {_LEDGER} SELECT * FROM latest",
    "ledger_compacted": f"WITH {_LEDGER} SELECT * FROM latest",
    "ledger_unfinished": (
        f"WITH {_LEDGER} SELECT DISTINCT file_name, file_location FROM known"
        " WHERE file_location IN (SELECT file_location FROM latest WHERE status = 'A')"
    ),
    "ledger_unprocessed": (
        f"WITH {_LEDGER} SELECT file_name, file_location FROM known"
        " WHERE file_location NOT IN (SELECT file_location FROM latest WHERE status = 'I')"
    ),
    "batch_run": _MONTHLY,
    "late_month_recompute": _CUSTOMER_MONTHLY,
    "incremental_ingest": _MONTHLY,
    "redelivered_file_ingest": _MONTHLY,
    "refused_then_corrected": _CUSTOMER_MONTHLY,
}
