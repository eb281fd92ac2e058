"""Record dates and calendar months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import as_column, strip

DAY_FIRST = r"\A\d{1,2}/\d{1,2}/\d{4}\z"
ISO_LIKE = r"\A\d{4}-\d{1,2}-\d{1,2}\z"


def normalise_date(value: Column | str) -> Column:
    """Day-first and ISO dates as ISO text; anything else stays as it is."""
    c = as_column(value)
    day_first = F.when(c.rlike(DAY_FIRST), F.try_to_date(c, "d/M/yyyy"))
    iso = F.when(c.rlike(ISO_LIKE), F.try_to_date(c, "yyyy-M-d"))
    return F.coalesce(F.date_format(F.coalesce(day_first, iso), "yyyy-MM-dd"), c)


def record_day(value: Column | str) -> Column:
    """A typed date beside the compatible text column."""
    return F.try_to_date(normalise_date(value), "yyyy-MM-dd")


def parse_date(value: Column | str) -> Column:
    """Strict day-first date; the query fails on anything else."""
    c = strip(value)
    return F.when(c.isNull() | c.rlike(DAY_FIRST), F.to_date(c, "d/M/yyyy")).otherwise(
        F.raise_error(F.concat(F.lit("not a DD/MM/YYYY date: "), c)).cast("date")
    )


def month_start(value: Column | str) -> Column:
    return F.trunc(as_column(value), "MM")


def month_label(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM")


def month_key(value: Column | str) -> Column:
    """First day of the month as text."""
    return F.date_format(month_start(value), "yyyy-MM-dd")


def previous_month_key(value: Column | str) -> Column:
    return F.date_format(F.add_months(month_start(value), -1), "yyyy-MM-dd")


def day_first(value: Column | str) -> Column:
    return F.date_format(as_column(value), "dd/MM/yyyy")


def months_between_days(start: Column | str, end: Column | str) -> Column:
    """First days of the months from start to end; empty if the months run backwards."""
    first, last = month_start(start), month_start(end)
    return F.when(
        first <= last, F.sequence(first, last, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))
