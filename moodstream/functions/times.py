"""Time labels and names built from values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_label(ts: Column) -> Column:
    """``HH:mm:ss`` for display. It repeats every day, so keep the timestamp for ordering."""
    return F.date_format(ts, "HH:mm:ss")


def batch_start(ts: Column, unit: str = "hour") -> Column:
    """Start of the micro-batch a row falls in, when batches are cut by time."""
    return F.date_trunc(unit, ts)


def page_name(page: Column, offset: int = 50, stem: str = "rawdata") -> Column:
    """File-like name of a page of comments."""
    return F.format_string(f"{stem}_%d.csv", page.cast("long") + F.lit(offset))
