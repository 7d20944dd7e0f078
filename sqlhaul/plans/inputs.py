"""The driver tables as DataFrames, one for each session and state of a path.

The tables under ``sf_dir`` are read-only while a query runs, so their file
listing and parquet footers (schema inference is a small Spark job per read) are
taken once, not once per query. The frames belong to the session and go with
it; a table whose path has changed since is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import modified

_ATTRIBUTE = "_sqlhaul_frames"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    frames: dict[str, tuple[int, DataFrame]] = spark.__dict__.setdefault(_ATTRIBUTE, {})
    stamp = modified(spark, path)
    if path not in frames or frames[path][0] != stamp:
        frames[path] = (stamp, spark.read.parquet(path))
    return frames[path][1]
