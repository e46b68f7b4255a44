"""Month handling as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuota.functions.text import strip_blanks

_DAY = "(3[01]|[12][0-9]|0?[1-9])"
_MONTH = "(1[0-2]|0?[1-9])"
_YEAR = "(?!0000)[0-9]{4}"
# Accepted text forms once '-' and '.' are '/': tried in this order.
_TEXT_FORMS = (
    (f"^{_YEAR}/{_MONTH}/{_DAY}$", "yyyy/M/d"),
    (f"^{_YEAR}/{_MONTH}$", "yyyy/M"),
    (f"^{_DAY}/{_MONTH}/{_YEAR}$", "d/M/yyyy"),
)
# Day zero of spreadsheet serial numbers.
_SERIAL_EPOCH = date(1899, 12, 30)


def month_start(col: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(col, "MM")


def add_months(month: date, count: int) -> date:
    """The month start `count` months after a plain date's month."""
    years, index = divmod(month.year * 12 + month.month - 1 + count, 12)
    return date(years, index + 1, 1)


def as_date(value: str | date | Column) -> Column:
    """A literal or a column as DATE."""
    return value if isinstance(value, Column) else F.to_date(F.lit(value))


def parse_month(text: Column, kind: Column) -> Column:
    """Month of a sheet cell, or null when the cell cannot be read.

    `kind` is the cell type: a number is a serial day count, a number held as text is not.
    """
    slashed = F.translate(strip_blanks(text), "-.", "//")
    forms = [F.when(slashed.rlike(shape), F.try_to_date(slashed, fmt)) for shape, fmt in _TEXT_FORMS]
    serial = F.floor(text.try_cast("double"))
    from_number = F.date_add(F.lit(_SERIAL_EPOCH), serial.cast("int"))
    from_date = F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    return month_start(F.when(kind == "n", from_number).when(kind == "d", from_date).otherwise(F.coalesce(*forms)))


def month_label(col: Column) -> Column:
    """'Mar-25'."""
    return F.date_format(col, "MMM-yy")
