"""Date expressions (X1, X2, X4-X6). All are built-in, codegen-friendly Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day numbers in the source data count days since this date
# (the SAS date convention).
DAY_NUMBER_EPOCH = "1960-01-01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number_to_date(c: Column | str, epoch: str = DAY_NUMBER_EPOCH) -> Column:
    """Day number (int or double) -> DATE; NULL or out-of-range -> NULL.

    ``date_add`` takes an integer day count on Spark 4, so the number is
    narrowed with ``try_cast`` first (fractions truncate).
    """
    return F.date_add(F.lit(epoch).cast("date"), _col(c).try_cast("int"))


def date_to_day_number(c: Column | str, epoch: str = DAY_NUMBER_EPOCH) -> Column:
    """DATE/TIMESTAMP -> whole days since ``epoch`` (int)."""
    return F.datediff(_col(c).cast("date"), F.lit(epoch).cast("date"))


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> DATE with an explicit pattern; unparsable text -> NULL.

    ``MM`` is the month: a pattern with ``mm`` (minutes) would silently move
    every date to January.
    """
    return F.try_to_date(_col(c), fmt)


def date_parts(c: Column | str) -> dict[str, Column]:
    """Calendar attributes of a DATE.

    ``day_of_week`` is Spark's Sunday=1..Saturday=7, ``weekday`` is
    Monday=0..Sunday=6 and ``week_of_year`` is the ISO week.
    """
    d = _col(c)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day_of_week": F.dayofweek(d),
        "weekday": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
    }
