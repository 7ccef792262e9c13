"""Class names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prediction code of each class on the scored-comment topic.
CODES = {"neutral": 0.0, "positive": 1.0, "negative": 2.0}

CLASSES = ("positive", "negative", "neutral")


def class_name(prediction: Column) -> Column:
    """Name of a prediction code; null for null and for any other value."""
    out = None
    for name, code in CODES.items():
        match = prediction == F.lit(code)
        out = F.when(match, name) if out is None else out.when(match, name)
    return out


def class_code(name: Column) -> Column:
    """Prediction code of a class name; null for any other name."""
    out = None
    for known, code in CODES.items():
        match = name == F.lit(known)
        out = F.when(match, F.lit(code)) if out is None else out.when(match, F.lit(code))
    return out


def recode(column: Column, mapping: dict, default: Column | None = None) -> Column:
    """Replace listed values; others become ``default``, or stay as they are."""
    out = None
    for old, new in mapping.items():
        match = column == F.lit(old)
        out = F.when(match, F.lit(new)) if out is None else out.when(match, F.lit(new))
    rest = column if default is None else default
    return rest if out is None else out.otherwise(rest)
