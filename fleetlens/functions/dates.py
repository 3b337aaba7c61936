"""Day-grain date helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_year(c) -> Column:
    """Partition year as int."""
    return F.year(_col(c))


def partition_month(c) -> Column:
    """Partition month as zero-padded text '01'..'12'."""
    return F.lpad(F.month(_col(c)).cast("string"), 2, "0")


def age_days(first, day) -> Column:
    """Whole days from ``first`` to ``day`` (bigint)."""
    return F.datediff(_col(day), _col(first)).cast("bigint")


def clamped_age_days(first, day) -> Column:
    """Online age: floor day difference, never negative."""
    return F.greatest(F.lit(0), F.datediff(_col(day), _col(first))).cast("bigint")


def utc_day(c) -> Column:
    """Timestamp -> UTC calendar day (session time zone is UTC)."""
    return F.to_date(_col(c))


def iso_day(c) -> Column:
    """Date/timestamp -> 'yyyy-MM-dd' text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def day_label(c) -> Column:
    """Short 'MM-dd' axis label used by the dashboard."""
    return F.date_format(_col(c), "MM-dd")
