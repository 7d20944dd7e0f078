"""Datasets: named ``domain/dataset`` folders of CSV uploads, read as one DataFrame.

Layout of one dataset under a lake root::

    <root>/<domain>/<dataset>/upload_date=<epoch>/<user>/csv/part-*.csv
    <root>/<domain>/<dataset>/upload_date=<epoch>/<user>/parquet/part-*.parquet   (optional format)
    <root>/<domain>/<dataset>/_uploads/<mode>-<epoch>   upload log

Every load writes a new ``upload_date=<epoch>/<user>/csv`` folder and then one
row into the upload log. A reader opens exactly the uploads the log shows as
visible (all uploads since the last reload), so a reload never overwrites data
in place and a failed load, whose log row was never written, stays invisible.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..functions.strings import as_text
from ..functions.widening import widest
from . import upload_log
from .csv_contract import READ_OPTIONS, string_schema

# The upload folder layout <domain>/<dataset>/upload_date=<epoch
# seconds>/<user>/<format>/, with "csv" as the folder of CSV uploads.
PARTITION_COLUMN = "upload_date"

# Characters a name part may not hold: path separators, the ref separator, and
# what Hadoop reads as glob syntax in a path.
PATH_UNSAFE = "/:\\[]{}*?"


class DatasetNotFound(LookupError):
    pass


class HeaderDrift(ValueError):
    pass


@dataclass(frozen=True)
class DatasetRef:
    """A dataset name: ``domain`` + ``dataset`` (case-sensitive)."""

    domain: str
    dataset: str

    def __post_init__(self) -> None:
        for part in (self.domain, self.dataset):
            if not part or part != part.strip() or any(ch in part for ch in PATH_UNSAFE):
                raise ValueError(f"bad dataset name part {part!r}")

    @classmethod
    def parse(cls, text: str) -> "DatasetRef":
        """``"domain:dataset"`` -> ref; anything but two non-empty parts raises."""
        parts = text.strip().split(":")
        if len(parts) != 2:
            raise ValueError(f"expected 'domain:dataset', got {text!r}")
        return cls(parts[0].strip(), parts[1].strip())

    @property
    def prefix(self) -> str:
        return f"{self.domain}/{self.dataset}/"

    def __str__(self) -> str:
        return f"{self.domain}:{self.dataset}"


@dataclass(frozen=True)
class Lake:
    """Where datasets live. Reads come from ``read_root``; loads go to
    ``write_root`` (the landing zone), which defaults to the same folder."""

    read_root: str
    write_root: str | None = None

    @property
    def landing_root(self) -> str:
        return (self.write_root or self.read_root).rstrip("/")

    def dataset_dir(self, ref: DatasetRef, *, landing: bool = False) -> str:
        root = self.landing_root if landing else self.read_root.rstrip("/")
        return f"{root}/{ref.domain}/{ref.dataset}"

    def upload_dir(self, ref: DatasetRef, epoch: int, user: str, fmt: str = "csv", *, landing: bool = False) -> str:
        return f"{self.dataset_dir(ref, landing=landing)}/{PARTITION_COLUMN}={int(epoch)}/{user}/{fmt}"

    def log_dir(self, ref: DatasetRef, *, landing: bool = False) -> str:
        return f"{self.dataset_dir(ref, landing=landing)}/{upload_log.LOG_FOLDER}"

    def claims_dir(self, ref: DatasetRef, *, landing: bool = False) -> str:
        return f"{self.dataset_dir(ref, landing=landing)}/{upload_log.CLAIMS_FOLDER}"


def _csv_reader(spark: SparkSession, columns: list[str], base_path: str):
    return (
        spark.read.schema(string_schema(columns))
        .options(**READ_OPTIONS)
        .option("basePath", base_path)
    )


@dataclass(frozen=True)
class Folders:
    """The folders below a dataset's that hold files, by what they hold."""

    root: str
    parquet: list[str]
    other: list[str]


def unlogged_folders(spark: SparkSession, ref: DatasetRef, base: str) -> Folders:
    """Folders with files that other writers have laid down below ``base``;
    one row for each folder passes through the driver."""
    if not session.path_exists(spark, base):
        raise DatasetNotFound(f"dataset {ref}: no folder {base}")
    # names below the log folder or starting with "_" or "." are hidden, as for every Spark reader
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
        .select(F.substring_index("path", "/", -1).alias("name"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    )
    kinds = files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("name").endswith(".parquet").cast("int")).alias("parquet")
    ).orderBy("folder").collect()
    if not kinds:
        raise DatasetNotFound(f"dataset {ref} has no files under {base}")
    mixed = [k["folder"] for k in kinds if 0 < k["parquet"] < k["n"]]
    if mixed:
        raise HeaderDrift(f"dataset {ref}: folders with parquet and other files: {mixed[:3]}")
    return Folders(base, [k["folder"] for k in kinds if k["parquet"]], [k["folder"] for k in kinds if not k["parquet"]])


def read_folders(spark: SparkSession, base: str, folders: list[str], fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*folders)
    header = spark.read.options(**READ_OPTIONS).option("basePath", base).option("enforceSchema", "true").csv(folders).columns
    return _csv_reader(spark, [c for c in header if c != PARTITION_COLUMN], base).csv(folders)


def _unlogged(spark: SparkSession, ref: DatasetRef, base: str) -> DataFrame:
    """Every file that other writers have laid down below ``base``: CSV (also
    compressed, whatever the file is called) or, where all files are named so,
    parquet. A file whose header does not fit raises ``HeaderDrift`` or fails
    the read; none is left out."""
    found = unlogged_folders(spark, ref, base)
    df = None
    for fmt, folders in (("parquet", found.parquet), ("csv", found.other)):
        if folders:
            part = read_folders(spark, base, folders, fmt)
            df = part if df is None else df.unionByName(part)
    return df


def _widened(name: str, own: T.DataType, wide: T.DataType) -> Column:
    if isinstance(wide, T.StringType):
        return as_text(name, own)
    col = F.col("`" + name.replace("`", "``") + "`")
    return col if own == wide else col.cast(wide).alias(name)


def _union_uploads(spark: SparkSession, lake: Lake, ref: DatasetRef, base: str, uploads: list[dict], columns: list[str]) -> DataFrame:
    """One scan for each format and schema. Where all uploads are typed, a
    column has the narrowest type that holds those of all uploads; where some
    are text, all are."""
    schemas = {u["schema"]: T.StructType.fromJson(json.loads(u["schema"])) for u in uploads if u["schema"]}
    typed = len(schemas) > 0 and all(u["schema"] for u in uploads)
    wide = widest(list(schemas.values())) if typed else string_schema(columns)
    df = None
    for fmt, schema in sorted({(u["format"], u["schema"] or "") for u in uploads}):
        paths = [lake.upload_dir(ref, u["upload_date"], u["user_id"], fmt) for u in uploads if (u["format"], u["schema"] or "") == (fmt, schema)]
        if fmt == "csv":
            part = _csv_reader(spark, columns, base).csv(paths)
        else:
            own = schemas[schema] if schema else string_schema(columns)
            part = spark.read.schema(own).option("basePath", base).parquet(*paths)
            kept = [c for c in part.columns if c not in columns]  # the partition column
            if schema and not typed:
                part = part.select(*[as_text(f.name, f.dataType) for f in own.fields], *kept)
            elif schema:
                part = part.select(*[_widened(f.name, own[f.name].dataType, f.dataType) for f in wide.fields], *kept)
        df = part if df is None else df.unionByName(part)
    return df


def read_dataset(
    spark: SparkSession,
    lake: Lake,
    ref: DatasetRef,
    *,
    logged: bool | None = None,
    with_upload_date: bool = False,
) -> DataFrame:
    """DataFrame of a dataset's visible uploads: all strings, or, where every
    visible upload was written with ``typed=True``, the types of the uploads
    widened to what holds all of them.

    A dataset with an upload log is read through it: exactly the uploads since
    the last reload (the log is a few rows per load, read on the driver). One
    without (``logged=False`` forces this) is every file below its folder, as
    other writers have laid them down; parquet files keep their types.
    ``logged=True`` insists on the log. ``upload_date`` (epoch seconds, bigint)
    is kept only when asked for.
    """
    base = lake.dataset_dir(ref)
    uploads = None
    if logged is not False:
        uploads = upload_log.visible_uploads(spark, lake.log_dir(ref))
        if uploads is None and (logged or session.list_dir_names(spark, lake.log_dir(ref))):
            # a log folder without a finished load: what lies beside it is unfinished
            raise DatasetNotFound(f"dataset {ref} has no upload log under {base}")
    if uploads is not None:
        column_lists = {tuple(u["columns"]) for u in uploads}
        if len(column_lists) > 1:
            raise HeaderDrift(f"dataset {ref}: visible uploads differ in columns: {sorted(column_lists)}")
        df = _union_uploads(spark, lake, ref, base, uploads, list(next(iter(column_lists))))
    else:
        df = _unlogged(spark, ref, base)
    if PARTITION_COLUMN in df.columns:
        if with_upload_date:
            df = df.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("bigint"))
        else:
            df = df.drop(PARTITION_COLUMN)
    return df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar dataset (e.g. a ``*_parquet`` table): plain parquet scan, so
    filters and column pruning reach the files."""
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV result written by another engine (e.g. ``<query id>.csv``):
    every column a string, no type inference, quotes escaped by doubling and
    values allowed to span lines (the same reader options as datasets, but
    that engine's null convention: an empty field is null). A row with more or
    fewer fields than the header, and a file whose header differs from the
    others', fail the read."""
    strict = dict(header="true", quote='"', escape='"', multiLine="true", mode="FAILFAST")
    columns = spark.read.options(**strict).csv(path).columns
    return spark.read.options(**strict, enforceSchema="false").schema(string_schema(columns)).csv(path)
