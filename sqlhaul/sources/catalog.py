"""Qualified names: a dataset as ``domain.dataset`` in the session catalog.

``publish`` declares an external, partitioned table over the dataset folder and
adds as partitions exactly the uploads the upload log shows as visible, each at
its own ``upload_date=<epoch>/<user>/<format>`` location, so uploads of several
users in one second are partitions of their own. The table then reads like any
catalog table (``SELECT * FROM domain.dataset``, ``spark.table("domain.dataset")``)
with the partition columns ``upload_date`` and ``upload_user`` and partition
pruning on both, and unlogged or reloaded-away uploads stay out. Only catalog
metadata is written; no data moves.

A dataset whose uploads differ in format or types has one such table for each
(``dataset__csv``, ...), and ``domain.dataset`` is a view of them; filters on the
partition columns reach every table. One without a log is published alike from
the files that other writers have laid down, a partition for each folder, with
``upload_date`` where all folders have one.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .. import session
from ..functions.widening import widest
from ..session import ensure_database
from ..session import sql_literal as _lit
from . import upload_log
from .csv_contract import READ_OPTIONS, string_schema
from .datasets import PARTITION_COLUMN, DatasetNotFound, DatasetRef, HeaderDrift, Lake, read_folders, unlogged_folders


USER_COLUMN, FOLDER_COLUMN = "upload_user", "upload_folder"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _norm_location(path: str) -> str:
    path = path.rstrip("/")
    return path[len("file:"):] if path.startswith("file:") else path


def _existing_shape(spark: SparkSession, name: str):
    """(columns, provider, location) of the published table, or None if absent."""
    if not spark.catalog.tableExists(name):
        return None
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    provider = (info.get("Provider") or "").lower()
    return spark.table(name).columns, provider, _norm_location(info.get("Location") or "")


def publish(spark: SparkSession, lake: Lake, ref: DatasetRef) -> str:
    """Declare ``domain.dataset`` for the current visible uploads; returns its name.

    The first call creates the table. Later calls keep it and only change its
    partitions: new uploads are added, uploads hidden by a reload are dropped
    (an external table, so no file is touched). The two ``ALTER TABLE``
    statements are not one transaction: a query planned between them may see
    the new uploads together with the ones a reload hides. A table whose
    columns, format or folder no longer match is declared again.
    """
    uploads = upload_log.visible_uploads(spark, lake.log_dir(ref))
    if uploads is None:
        if session.list_dir_names(spark, lake.log_dir(ref)):
            raise DatasetNotFound(f"dataset {ref} has no finished load")
        return _publish_unlogged(spark, lake, ref)
    column_lists = {tuple(u["columns"]) for u in uploads}
    if len(column_lists) != 1:
        raise HeaderDrift(f"dataset {ref}: cannot publish uploads with columns {sorted(column_lists)}")
    columns = list(next(iter(column_lists)))
    if USER_COLUMN in [c.lower() for c in columns]:
        raise ValueError(f"dataset {ref}: a data column may not be named {USER_COLUMN!r} in a catalog table")
    kinds = sorted({(u["format"], u["schema"] or "") for u in uploads})
    spec = {PARTITION_COLUMN: "BIGINT", USER_COLUMN: "STRING"}
    names, schemas = [], []
    for k, (fmt, schema) in enumerate(kinds):
        own = [u for u in uploads if (u["format"], u["schema"] or "") == (fmt, schema)]
        fields = T.StructType.fromJson(json.loads(schema)) if schema else string_schema(columns)
        places = {(int(u["upload_date"]), u["user_id"]): lake.upload_dir(ref, u["upload_date"], u["user_id"], fmt) for u in own}
        table = ref.dataset if len(kinds) == 1 else f"{ref.dataset}__{fmt}{k if schema else ''}"
        names.append(_publish_table(spark, ref.domain, table, lake.dataset_dir(ref), fields, fmt, spec, places))
        schemas.append(fields)
    if len(kinds) > 1:
        _publish_view(spark, ref, names, schemas, all(s for _, s in kinds), list(spec))
    return f"{ref.domain}.{ref.dataset}"


def _publish_view(spark: SparkSession, ref: DatasetRef, names: list[str], schemas: list[T.StructType], typed: bool, spec: list[str]) -> None:
    """A view of several tables with one list of columns: in their widened
    types, or as text where some of them are."""
    wide = widest(schemas) if typed else string_schema(schemas[0].names)
    parts = []
    for name, own in zip(names, schemas):
        shown = []
        for f in wide.fields:
            col = _ident(f.name)
            kind = own[f.name].dataType
            if kind != f.dataType:
                if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)):
                    raise ValueError(f"column {f.name!r} has the types {kind.simpleString()} and {f.dataType.simpleString()}: no one type in a view")
                col = f"CAST({col} AS {f.dataType.simpleString()}) AS {col}"
            shown.append(col)
        parts.append(f"SELECT {', '.join([*shown, *map(_ident, spec)])} FROM {name}")
    full = f"{_ident(ref.domain)}.{_ident(ref.dataset)}"
    if spark.catalog.tableExists(full) and not _is_view(spark, full):
        spark.sql(f"DROP TABLE {full}")  # external table: metadata only
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS " + " UNION ALL ".join(parts))


def _is_view(spark: SparkSession, name: str) -> bool:
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return (info.get("Type") or "").upper() == "VIEW"


def _publish_table(
    spark: SparkSession, domain: str, table: str, base: str, fields: T.StructType, fmt: str, spec: dict[str, str], places: dict[tuple, str],
    options: dict[str, str] | None = None,
) -> str:
    """A table over ``base`` whose partitions are exactly ``places`` (values of
    ``spec`` -> folder)."""
    name = f"{_ident(domain)}.{_ident(table)}"
    ensure_database(spark, domain)
    if spark.catalog.tableExists(name) and _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    existing: set[tuple] = set()
    columns = [f"{_ident(f.name)} {f.dataType.simpleString()}" for f in fields.fields]
    shape = _existing_shape(spark, name)
    if shape == (fields.names + list(spec), fmt, _norm_location(base)) and [f.dataType for f in spark.table(name).schema.fields[: len(columns)]] == [f.dataType for f in fields.fields]:
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
            values = [x.split("=", 1)[1] for x in row[0].split("/", len(spec) - 1)]
            existing.add(tuple(int(v) if kind == "BIGINT" else unquote(v) for v, kind in zip(values, spec.values())))
    else:
        given = options if options is not None else (READ_OPTIONS if fmt == "csv" else {})
        opts = ", ".join(f"{_ident(k)} {_lit(v)}" for k, v in given.items())
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external table: metadata only
        spark.sql(
            f"CREATE TABLE {name} ({', '.join(columns + [f'{_ident(c)} {kind}' for c, kind in spec.items()])}) USING {fmt} "
            + (f"OPTIONS ({opts}) " if opts else "")
            + f"PARTITIONED BY ({', '.join(map(_ident, spec))}) LOCATION {_lit(base)}"
        )

    def partition(values: tuple) -> str:
        return "PARTITION (" + ", ".join(f"{_ident(c)}={v if kind == 'BIGINT' else _lit(v)}" for (c, kind), v in zip(spec.items(), values)) + ")"

    add = " ".join(f"{partition(v)} LOCATION {_lit(places[v])}" for v in sorted(set(places) - existing))
    if add:
        spark.sql(f"ALTER TABLE {name} ADD {add}")
    drop = ", ".join(partition(v) for v in sorted(existing - set(places)))
    if drop:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {drop}")
    return name


def _publish_unlogged(spark: SparkSession, lake: Lake, ref: DatasetRef) -> str:
    """``domain.dataset`` over the files of other writers (see ``read_dataset``):
    a partition for each folder, ``upload_folder`` its path below the dataset."""
    base = lake.dataset_dir(ref)
    dated = re.compile(rf"(?:^|/){PARTITION_COLUMN}=(\d+)(?:/|$)")
    kinds = unlogged_folders(spark, ref, base)
    below = {f: _norm_location(f)[len(_norm_location(kinds.root)) :].strip("/") for f in kinds.parquet + kinds.other}
    dates = {f: m[1] for f, rel in below.items() if (m := dated.search(rel))}
    with_date = len(dates) == len(below)
    spec = ({PARTITION_COLUMN: "BIGINT"} if with_date else {}) | {FOLDER_COLUMN: "STRING"}
    names, schemas = [], []
    for fmt, folders in (("csv", kinds.other), ("parquet", kinds.parquet)):
        if not folders:
            continue
        df = read_folders(spark, base, folders, fmt)
        fields = T.StructType([f for f in df.schema.fields if f.name != PARTITION_COLUMN])
        places = {((int(dates[f]),) if with_date else ()) + (below[f],): f for f in folders}
        table = ref.dataset if not (kinds.parquet and kinds.other) else f"{ref.dataset}__{fmt}"
        names.append(_publish_table(spark, ref.domain, table, base, fields, fmt, spec, places))
        schemas.append(fields)
    if len(names) > 1:
        if {f.lower() for f in schemas[0].names} != {f.lower() for f in schemas[1].names}:
            raise HeaderDrift(f"dataset {ref}: CSV and parquet files differ in columns")
        _publish_view(spark, ref, names, schemas, True, list(spec))
    return f"{ref.domain}.{ref.dataset}"
