"""Null and default rules of the flattened feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a partition column holds when the feed says nothing.
UNKNOWN_DATE = "UNKNOWN"
NO_ROUTE = "NA"


def blank_to_null(text: Column) -> Column:
    """Unset text arrives as ''."""
    return F.nullif(text, F.lit(""))


def zero_to_null(number: Column) -> Column:
    """For event times only, where 0 means not set."""
    return F.nullif(number, F.lit(0))


def or_zero(number: Column) -> Column:
    """Other numbers keep the feed's default of 0 (bearing 0 is north)."""
    return F.coalesce(number, F.lit(0))


def or_default(text: Column, default: str) -> Column:
    """Partition columns must not be NULL or ''."""
    return F.coalesce(blank_to_null(text), F.lit(default))
