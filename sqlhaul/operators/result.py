"""Result shaping: all-string projection for the CSV target, and preview."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

from ..functions.strings import as_text


class DuplicateColumns(ValueError):
    pass


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text (one projection, no UDF). Duplicate output names
    are refused: a CSV header with two equal names cannot be read back. Names
    count as equal without regard to case, as they do for Spark."""
    names = [f.name for f in df.schema.fields]
    count = Counter(n.lower() for n in names)
    dups = sorted(n for n in names if count[n.lower()] > 1)
    if dups:
        raise DuplicateColumns(f"duplicate output column names: {dups}")
    return df.select([as_text(f.name, f.dataType) for f in df.schema.fields])


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows as a DataFrame (``preview(df).show(truncate=False)``).

    Without an order this is any ``n`` rows, as ``show`` is; each call is its
    own (small) Spark job.
    """
    return df.limit(n)
