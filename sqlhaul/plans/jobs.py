"""Load jobs: resolve the SQL text, run it, load the answer into a dataset.

One lifecycle for every entry point: text (inline or stored) -> views or an
external source -> ``spark.sql``/JDBC -> Catalyst -> one write with the row
count observed during it. A preview, when asked for, reads the first rows of
the upload just written; the query itself runs once.
Spark exceptions pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.result import preview
from ..operators.sql import register, run_sql
from ..sources.csv_contract import READ_OPTIONS, string_schema
from ..sources.datasets import DatasetRef, Lake
from ..sources.external import JdbcSource, read_query
from ..sources.stored import find_query
from ..sources.uploads import LoadResult, write_upload


def _ref(target: DatasetRef | str) -> DatasetRef:
    return target if isinstance(target, DatasetRef) else DatasetRef.parse(target)


#: How ``read_query`` splits a fetch.
FETCH = ("partition_column", "lower_bound", "upper_bound", "num_partitions", "fetch_size")


def _source(source: JdbcSource | str, sources: Mapping[str, JdbcSource] | None) -> JdbcSource:
    """A database given itself, or by its name among ``sources``."""
    if isinstance(source, JdbcSource):
        return source
    if source not in (sources or {}):
        raise LookupError(f"no source named {source!r} among {sorted(sources or {})}")
    return sources[source]


def _load(spark, df, lake, target, user, *, reload, show, **writing) -> LoadResult:
    """One run of the plan, the write; a preview reads the upload just written."""
    result = write_upload(spark, df, lake, _ref(target), user, mode="reload" if reload else "append", **writing)
    if show and result.path is not None:
        if writing.get("file_format", "csv") == "csv":
            written = spark.read.options(**READ_OPTIONS).schema(string_schema(df.columns)).csv(result.path)
        else:
            written = spark.read.parquet(result.path)
        preview(written, show).show(truncate=False)
    return result


def load_sql(
    spark: SparkSession,
    lake: Lake,
    mapping: Mapping[str, DataFrame | DatasetRef | str | Mapping[str, str]],
    query: str,
    target: DatasetRef | str,
    user: str,
    *,
    args: Mapping[str, Any] | None = None,
    reload: bool = False,
    show: int = 0,
    with_upload_date: bool = False,
    **writing,
) -> LoadResult:
    """Mapped datasets -> Spark SQL -> new upload of ``target`` (append by default).
    ``with_upload_date=True`` exposes ``upload_date`` on the dataset views;
    ``writing`` (``epoch``, ``skip_empty``, ``file_format``, ``typed``, ``sketch``,
    ``max_records_per_file``, ``max_file_bytes``) goes to ``write_upload``."""
    register(spark, mapping, lake, with_upload_date=with_upload_date)
    return _load(spark, run_sql(spark, query, args), lake, target, user, reload=reload, show=show, **writing)


def load_stored(
    spark: SparkSession,
    lake: Lake,
    sql_dataset: DatasetRef | str,
    file_name: str,
    target: DatasetRef | str,
    user: str,
    *,
    mapping: Mapping[str, DataFrame | DatasetRef | str | Mapping[str, str]] | None = None,
    source: JdbcSource | str | None = None,
    sources: Mapping[str, JdbcSource] | None = None,
    fetch: Mapping[str, Any] | None = None,
    args: Mapping[str, Any] | None = None,
    reload: bool = False,
    show: int = 0,
    with_upload_date: bool = False,
    **writing,
) -> LoadResult:
    """Stored SQL file -> Spark SQL over ``mapping``, or the external ``source``
    (a ``JdbcSource`` or a name among ``sources``) -> new upload of ``target``.
    ``fetch`` splits an external result as in ``read_query``
    (``partition_column``, ``num_partitions``, bounds, ``fetch_size``)."""
    text = find_query(spark, lake.dataset_dir(_ref(sql_dataset)), file_name)
    if source is not None:
        df = read_query(spark, _source(source, sources), text, as_text=not writing.get("typed"), **(fetch or {}))
    else:
        register(spark, mapping or {}, lake, with_upload_date=with_upload_date)
        df = run_sql(spark, text, args)
    return _load(spark, df, lake, target, user, reload=reload, show=show, **writing)


def load_external(
    spark: SparkSession,
    lake: Lake,
    source: JdbcSource | str,
    query: str,
    target: DatasetRef | str,
    user: str,
    *,
    sources: Mapping[str, JdbcSource] | None = None,
    reload: bool = False,
    show: int = 0,
    **options,
) -> LoadResult:
    """Inline SQL run by an external database -> new upload of ``target``.
    ``options`` named in ``FETCH`` split the fetch (``read_query``), the others go
    to ``write_upload``; ``typed=True`` keeps the database's types."""
    fetch = {k: v for k, v in options.items() if k in FETCH}
    writing = {k: v for k, v in options.items() if k not in FETCH}
    df = read_query(spark, _source(source, sources), query, as_text=not writing.get("typed"), **fetch)
    return _load(spark, df, lake, target, user, reload=reload, show=show, **writing)
