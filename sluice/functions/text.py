"""Scalar text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """Column name in lower case, without outer blanks, inner spaces as underscores."""
    return re.sub(" ", "_", name.strip().lower())


def not_blank(text: Column) -> Column:
    """True unless null, empty or made of (Unicode) white space only."""
    return F.coalesce(~text.rlike(r"^\p{javaWhitespace}*$"), F.lit(False))


def is_iso_date(text: Column) -> Column:
    """True for a real calendar day written exactly as ``yyyy-MM-dd``."""
    shaped = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.coalesce(shaped & text.try_cast("date").isNotNull(), F.lit(False))


def fixed_two(number: Column) -> Column:
    """Number with exactly two decimals."""
    return F.format_string("%.2f", number.cast("double"))


def percent(part: Column, total: Column) -> Column:
    """Share in percent to one decimal; 0.0 of nothing."""
    return F.when(total > 0, F.round(part * F.lit(100.0) / total, 1)).otherwise(F.lit(0.0))


def strip_slashes(path: str) -> str:
    return re.sub("^/|/$", "", path)


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def iso_utc(ts: Column) -> Column:
    """Timestamp as ISO-8601 text in UTC (the session zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def composite_key(*parts: Column) -> Column:
    """Key made of several columns, joined by dashes."""
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def stable_id(*parts: Column) -> Column:
    """Repeatable 32-digit hexadecimal id of the given parts."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 32)
