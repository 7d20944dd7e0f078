"""Name inputs as views and run one Spark SQL statement over them.

The SQL text goes to ``spark.sql`` unchanged; Catalyst does all relational
work (pushdown into the CSV/parquet scans, join choice, AQE). A leading
``--`` comment and a trailing ``;`` are accepted by Spark itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..sources.datasets import DatasetRef, Lake, read_dataset


class EmptyQuery(ValueError):
    pass


def register(
    spark: SparkSession,
    mapping: Mapping[str, DataFrame | DatasetRef | str | Mapping[str, str]],
    lake: Lake | None = None,
    *,
    with_upload_date: bool = False,
) -> dict[str, DataFrame]:
    """``alias -> DataFrame | DatasetRef | "domain:dataset" | {"domain": ...,
    "dataset": ...}``; each becomes a temp view named ``alias`` (an existing view of that name is replaced).
    Datasets are read lazily: nothing is scanned until the query runs.
    ``with_upload_date=True`` keeps the ``upload_date`` column on dataset
    views, so a filter on it prunes uploads (a partition filter)."""
    frames: dict[str, DataFrame] = {}
    for alias, source in mapping.items():
        if isinstance(source, DataFrame):
            df = source
        else:
            if isinstance(source, Mapping):
                ref = DatasetRef(source["domain"], source["dataset"])
            else:
                ref = source if isinstance(source, DatasetRef) else DatasetRef.parse(source)
            if lake is None:
                raise ValueError(f"alias {alias!r} names dataset {ref} but no lake was given")
            df = read_dataset(spark, lake, ref, with_upload_date=with_upload_date)
        df.createOrReplaceTempView(alias)
        frames[alias] = df
    return frames


def run_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """One SQL statement -> DataFrame (lazy). Named ``:params`` come from ``args``."""
    if text is None or not text.strip():
        raise EmptyQuery("the query text is empty")
    return spark.sql(text, args=dict(args) if args else None)
