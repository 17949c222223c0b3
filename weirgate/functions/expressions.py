"""Column expressions of the staging and mart models."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
#: Fixed values.
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def cleaned(text: Column) -> Column:
    """Text without outer spaces; null if nothing is left."""
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def lowered(text: Column) -> Column:
    return F.lower(cleaned(text))


def instant(text: Column) -> Column:
    """A point in time from ISO text; other text is an error, which ends the load."""
    return text.cast("timestamp")


def date_key(day: Column) -> Column:
    """20250131 for a day."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(day) + 1).cast("int")


def named(number: Column, names: tuple[str, ...]) -> Column:
    """The number-th of the names, counted from 1."""
    return F.element_at(F.array(*map(F.lit, names)), number.cast("int"))


def day_name(day: Column) -> Column:
    return named(iso_weekday(day), DAYS)


def month_name(day: Column) -> Column:
    return named(F.month(day), MONTHS)


def amount(quantity: Column, price: Column) -> Column:
    """A line's amount at two decimals."""
    return (quantity * price).cast(MONEY)


def joined_key(*parts: Column) -> Column:
    """Parts of a composite key with colons between; null if any part is."""
    out = parts[0].cast("string")
    for part in parts[1:]:
        out = F.concat(out, F.lit(":"), part.cast("string"))
    return out


def off_by(a: Column, b: Column, tolerance: str = "0.01") -> Column:
    return F.abs(a - b) > F.lit(tolerance).cast("decimal(18,2)")


_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,127}")


def quoted(identifier: str, upper: bool = False) -> str:
    """A dotted identifier in backticks; anything but plain names is refused."""
    parts = identifier.split(".")
    if not all(_NAME.fullmatch(p) for p in parts):
        raise ValueError(f"not an identifier: {identifier!r}")
    return ".".join(f"`{p.upper() if upper else p}`" for p in parts)
