"""Small sales files and dimension tables for the tests."""

import csv
from datetime import date
from decimal import Decimal
from pathlib import Path

from tallymart import schemas
from tallymart.plans.marts import Dimensions

HEADER = schemas.MANDATORY
MONEY = Decimal


def write_csv(path: Path, header, rows) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)
    return path


def sale(customer, store, person, day, cost, product="sugar"):
    return [customer, store, product, day, person, cost, 1, cost]


def sales_frame(spark, rows):
    """Fact rows from (customer, store, person, day, cost) tuples."""
    data = [
        (c, s, "sugar", date.fromisoformat(d) if d else None, p, None, 1, None if t is None else Decimal(t), None)
        for c, s, p, d, t in rows
    ]
    return spark.createDataFrame(data, schemas.SALES_FACT)


def dimensions(spark) -> Dimensions:
    customers = [
        (1, "Mira", "Holt", "Lund", "10001", "555-0101", date(2020, 2, 1)),
        (2, "Jonas", "Berg", "Lund", "10001", "555-0102", date(2021, 2, 1)),
        (3, "Ines", None, "Lund", "10001", "555-0103", date(2022, 2, 1)),
    ]
    stores = [
        (121, "Main Street 1", "20001", "Osman", date(2019, 1, 1), "Well sorted."),
        (122, "Harbour 7", "20002", "Petra", date(2019, 6, 1), "Easy parking."),
    ]
    team = [
        (1, "Ada", "Quist", 10, "N", "Lund", "10002", date(2020, 5, 1)),
        (2, "Bo", "Rask", 10, "N", "Lund", "10002", date(2020, 5, 1)),
        (3, "Cleo", "Sand", 10, "N", "Lund", "10002", date(2020, 5, 1)),
        (4, "Dina", None, 10, "N", "Lund", "10002", date(2020, 5, 1)),
    ]
    return Dimensions(
        spark.createDataFrame(customers, schemas.CUSTOMER),
        spark.createDataFrame(stores, schemas.STORE),
        spark.createDataFrame(team, schemas.SALES_TEAM),
    )


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
