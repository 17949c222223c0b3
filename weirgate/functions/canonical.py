"""Canonical text of typed values, so that equal values are equal text wherever they come from.

null is N; others are a letter, a colon and the value: S text (NFC), D date, T UTC time in microseconds, M decimal
without trailing zeros, B 0 or 1, I integer, F float with 17 significant digits. Times without a zone are refused by type.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("text", "date", "timestamp", "decimal", "boolean", "integer", "float")
_ACCEPTED = {
    "text": (T.StringType,),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType,),
    "decimal": (T.DecimalType, T.LongType, T.IntegerType, T.ShortType),
    "boolean": (T.BooleanType,),
    "integer": (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "float": (T.DoubleType, T.FloatType),
}


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def _seventeen(value: pd.Series) -> pd.Series:
    def shown(v: float) -> str | None:
        if v is None or pd.isna(v):
            return None
        return format(float(v), ".17g")

    return value.map(shown)


def nfc(text: Column) -> Column:
    """NFC text; only text beyond ASCII leaves the JVM (see encode), as ASCII is its own normal form."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), _nfc(text)).otherwise(text)


def decimal_text(value: Column) -> Column:
    """Plain digits without trailing zeros, at the value's own scale; zero is 0."""
    plain = value.cast("string")  # in ANSI mode without exponents
    cut = F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(cut.isin("-0", ""), F.lit("0")).otherwise(cut)


def canonical(column: Column, kind: str, unicode_text: bool = True) -> Column:
    """The canonical text of a column of the kind."""
    body = {
        "text": lambda c: F.concat(F.lit("S:"), nfc(c) if unicode_text else c),
        "date": lambda c: F.concat(F.lit("D:"), F.date_format(c, "yyyy-MM-dd")),
        "timestamp": lambda c: F.concat(F.lit("T:"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        "decimal": lambda c: F.concat(F.lit("M:"), decimal_text(c)),
        "boolean": lambda c: F.when(c, F.lit("B:1")).otherwise(F.lit("B:0")),
        "integer": lambda c: F.concat(F.lit("I:"), c.cast("string")),
        "float": lambda c: F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.raise_error(F.lit("not a finite number"))).otherwise(F.concat(F.lit("F:"), _seventeen(c))),
    }[kind](column)
    return F.when(column.isNull(), F.lit("N")).otherwise(body)


def require(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """df, if each named column has a type that its kind accepts."""
    for name, kind in kinds.items():
        found = df.schema[name].dataType
        if not isinstance(found, _ACCEPTED[kind]):
            raise TypeError(f"{name}: {found.simpleString()} is no {kind}")
    return df


def encode(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """df with the named columns in canonical text."""
    require(df, kinds)
    return df.withColumns({name: canonical(df[name], kind) for name, kind in kinds.items()})


def framed(text: Column) -> Column:
    """A digest's item in hexadecimal: the length of the UTF-8 bytes in eight bytes, then the bytes."""
    length = F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")
    return F.lower(F.concat(length, F.hex(text.cast("binary"))))
