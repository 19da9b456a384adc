"""Column names and types shared by the whole package."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The columns every sales file must carry, in canonical order.
MANDATORY = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]
ADDITIONAL = "additional_column"
CANONICAL = [*MANDATORY, ADDITIONAL]

SALES_TYPES = {
    "customer_id": T.LongType(),
    "store_id": T.LongType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.LongType(),
    "price": MONEY,
    "quantity": T.IntegerType(),
    "total_cost": MONEY,
    ADDITIONAL: T.StringType(),
}
SALES_FACT = T.StructType([T.StructField(name, SALES_TYPES[name]) for name in CANONICAL])

# The stored fact: accepted and refused rows of one read, told apart by row_status.
UNPARSED = "unparsed_line"
FACT_STORE = T.StructType(
    [
        *SALES_FACT.fields,
        T.StructField(UNPARSED, T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("row_status", T.StringType()),
        T.StructField("sales_month", T.StringType()),
        T.StructField("ingest_batch", T.StringType()),
    ]
)
FACT_PARTITIONS = ["row_status", "sales_month", "ingest_batch"]
ROW_OK = "ok"
ROW_BAD = "bad"

# The columns of the tables below are those that users and databases know.
CUSTOMER = _table(
    customer_id=T.LongType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    address=T.StringType(),
    pincode=T.StringType(),
    phone_number=T.StringType(),
    customer_joining_date=T.DateType(),
)
STORE = _table(
    id=T.LongType(),
    address=T.StringType(),
    store_pincode=T.StringType(),
    store_manager_name=T.StringType(),
    store_opening_date=T.DateType(),
    reviews=T.StringType(),
)
SALES_TEAM = _table(
    id=T.LongType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    manager_id=T.LongType(),
    is_manager=T.StringType(),
    address=T.StringType(),
    pincode=T.StringType(),
    joining_date=T.DateType(),
)

CUSTOMER_MART = _table(
    customer_id=T.LongType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    address=T.StringType(),
    pincode=T.StringType(),
    phone_number=T.StringType(),
    sales_date=T.DateType(),
    total_cost=MONEY,
)
SALES_MART = _table(
    store_id=T.LongType(),
    sales_person_id=T.LongType(),
    sales_person_first_name=T.StringType(),
    sales_person_last_name=T.StringType(),
    store_manager_name=T.StringType(),
    manager_id=T.LongType(),
    is_manager=T.StringType(),
    sales_person_address=T.StringType(),
    sales_person_pincode=T.StringType(),
    sales_date=T.DateType(),
    total_cost=MONEY,
    sales_month=T.StringType(),
)
# What a batch adds to its months: sums by all keys of a sale, under the first day of the month.
MONTH_STATE = _table(
    customer_id=T.LongType(),
    store_id=T.LongType(),
    sales_person_id=T.LongType(),
    sales_date=T.DateType(),
    total_cost=T.DecimalType(28, 2),
    sales_month=T.StringType(),
    ingest_batch=T.StringType(),
)
MONTH_STATE_PARTITIONS = ["sales_month", "ingest_batch"]
CUSTOMER_MONTHLY = _table(
    customer_id=T.LongType(),
    full_name=T.StringType(),
    address=T.StringType(),
    phone_number=T.StringType(),
    sales_date_month=T.StringType(),
    total_sales=MONEY,
)
SALES_PERSON_MONTHLY = _table(
    store_id=T.LongType(),
    sales_person_id=T.LongType(),
    full_name=T.StringType(),
    sales_month=T.StringType(),
    total_sales=MONEY,
    incentive=MONEY,
)

OPEN = "A"
CLOSED = "I"
LOST = "L"
# What tells one delivery from another, also under one path.
IDENTITY = ["file_location", "modification_time", "length"]
LEDGER_EVENT = _table(
    file_name=T.StringType(),
    file_location=T.StringType(),
    run_id=T.StringType(),
    event_time=T.TimestampType(),
    status=T.StringType(),
    modification_time=T.TimestampType(),
    length=T.LongType(),
)
# Deliveries that need no second look: refused or ignored ones.
SETTLED = _table(
    file_location=T.StringType(),
    modification_time=T.TimestampType(),
    length=T.LongType(),
    status=T.StringType(),
)
# Which version of a month counts: the one published last.
PUBLISHED = _table(
    sales_month=T.StringType(),
    version=T.StringType(),
    published_at=T.TimestampType(),
)
MANIFEST = _table(
    file_location=T.StringType(),
    file_name=T.StringType(),
    modification_time=T.TimestampType(),
    length=T.LongType(),
    header=T.ArrayType(T.StringType()),
    missing_columns=T.ArrayType(T.StringType()),
    status=T.StringType(),
    reason=T.StringType(),
)
# Keys of sales that a dimension lacks.
UNKNOWN = _table(dimension=T.StringType(), unknown_key=T.LongType())
ACCEPTED = "accepted"
REJECTED = "rejected"
# Files that no scan shows: recorded, neither taken nor refused.
IGNORED = "ignored"
NO_HEADER = "no header"
