"""Column expressions of the sales domain. All of them stay inside Catalyst."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.schemas import MONEY

# Fixed value: the share of the month's sales paid to the top seller of a store.
INCENTIVE_RATE = Decimal("0.01")
EXTRA_SEPARATOR = ", "


def sales_month(day: Column) -> Column:
    """`YYYY-MM` of a date."""
    return F.substring(day.cast("string"), 1, 7)


def month_start(day: Column) -> Column:
    """First day of the month; a four-byte grouping key where the text form is not needed yet."""
    return F.trunc(day, "month")


def full_name(first: Column, last: Column) -> Column:
    """First and last name with a blank between; null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def fold_extras(extras: list[Column]) -> Column:
    """All columns beyond the mandatory ones as one string.

    Nulls are skipped, so a row whose extras are all null gives the empty string. A file
    without extras gives null.
    """
    if not extras:
        return F.lit(None).cast("string")
    return F.concat_ws(EXTRA_SEPARATOR, *extras)


def money_total(amount: Column) -> Column:
    """Sum of a money column; null costs are ignored, an all-null group gives null."""
    return F.sum(amount).cast(MONEY)


def incentive(total: Column, is_top: Column) -> Column:
    """The top seller's share of `total`, rounded half up to cents, and zero for everyone else."""
    share = F.when(is_top, total * F.lit(INCENTIVE_RATE)).otherwise(F.lit(Decimal("0.00")))
    return F.round(share, 2).cast(MONEY)
