"""Dataset sink: every load is a new upload folder plus one upload-log row.

* ``append`` adds an upload; readers see it with all earlier visible ones.
* ``reload`` adds an upload that hides every older one from readers. Nothing
  is overwritten or deleted, so a query may read the dataset it reloads.
* Empty results are skipped by default: the rows are counted by an
  ``Observation`` during the one write job (no extra action to test for
  emptiness), and an empty upload is removed again and never logged.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..operators.ordered import stored
from ..operators.result import stringify
from . import sketches, upload_log
from .csv_contract import DEFAULT_MAX_FILE_BYTES, DEFAULT_MAX_RECORDS_PER_FILE, NULL_TOKEN, READ_OPTIONS, UPLOAD_FORMATS, WRITE_OPTIONS
from .datasets import PARTITION_COLUMN, PATH_UNSAFE, DatasetRef, Lake


class UploadRefused(ValueError):
    pass


@dataclass(frozen=True)
class LoadResult:
    ref: DatasetRef
    upload_date: int
    user_id: str
    mode: str
    rows: int
    path: str | None  # None when an empty result was skipped

    @property
    def skipped(self) -> bool:
        return self.path is None


def _check_user(user: str) -> None:
    # the user id is the first "_" field of object names and a folder name
    if not user or "_" in user or user != user.strip() or any(ch in user for ch in PATH_UNSAFE):
        raise UploadRefused(f"user id {user!r} must be non-empty, without '_', outer blanks or any of {PATH_UNSAFE!r}")


def write_upload(
    spark: SparkSession,
    df: DataFrame,
    lake: Lake,
    ref: DatasetRef,
    user: str,
    *,
    mode: str = "append",
    epoch: int | None = None,
    skip_empty: bool | None = None,
    max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
    file_format: str = "csv",
    typed: bool = False,
    sketch: list[str] | None = None,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
) -> LoadResult:
    """Stringify ``df`` and write it as a new upload of ``ref``, then log it.

    ``file_format="parquet"`` writes the same all-string columns as parquet:
    splittable, compressed and prunable, for datasets too large for
    one-task-per-file multi-line CSV. Readers handle both, also mixed.
    ``typed=True`` (parquet only) keeps the columns' types instead, and logs
    them; filters on them reach the files. ``sketch`` names columns whose
    sketches are kept with the upload (``sources.sketches``).

    A CSV file is read by one task, so it has at most ``max_records_per_file``
    rows and ``max_file_bytes`` bytes (or one row).

    An empty result is skipped by an append; for a reload, which would either
    keep or hide the old rows, the caller says which (``skip_empty=True`` or
    ``False``), else it is refused. A value that CSV cannot tell from null
    (the text ``\\N``) refuses the load; what was written is removed.
    """
    if mode not in ("append", "reload"):
        raise ValueError(f"mode must be 'append' or 'reload', not {mode!r}")
    if file_format not in UPLOAD_FORMATS:
        raise ValueError(f"file_format must be one of {UPLOAD_FORMATS}, not {file_format!r}")
    if typed and file_format != "parquet":
        raise ValueError("typed=True needs file_format='parquet'")
    _check_user(user)
    text = stringify(df)
    if typed:
        text = df
    unknown = [c for c in sketch or [] if c not in text.columns]
    if unknown:
        raise ValueError(f"no columns to sketch: {unknown}")
    if PARTITION_COLUMN in [c.lower() for c in text.columns]:
        raise UploadRefused(f"a data column may not be named {PARTITION_COLUMN!r} (it is the upload partition)")
    log_dir, claims = lake.log_dir(ref, landing=True), lake.claims_dir(ref, landing=True)
    epoch = _claim_epoch(spark, lake, ref, user, file_format, epoch)
    try:
        return _write_claimed(spark, text, lake, ref, user, mode, epoch, skip_empty, max_records_per_file, max_file_bytes, file_format, typed, sketch or [], log_dir)
    finally:
        upload_log.release(spark, claims, epoch)


def _claim_epoch(spark: SparkSession, lake: Lake, ref: DatasetRef, user: str, file_format: str, epoch: int | None) -> int:
    """The claimed second of a load: the one asked for, or the current one, or
    the first after it that no load has, has claimed or has left a folder in."""
    log_dir, claims = lake.log_dir(ref, landing=True), lake.claims_dir(ref, landing=True)
    automatic = epoch is None
    epoch = int(time.time()) if automatic else int(epoch)
    while True:
        if not upload_log.claim(spark, claims, epoch):
            if not automatic:
                raise UploadRefused(f"another load of {ref} is writing upload_date {epoch}")
            epoch += 1
            continue
        # looked up under the claim: a load that has just finished is in the log
        last = upload_log.last_epoch(spark, log_dir)
        if last is not None and epoch <= last:
            upload_log.release(spark, claims, epoch)
            if not automatic:
                raise UploadRefused(f"upload_date {epoch} is not after the last upload {last} of {ref}")
            epoch = last + 1
        elif automatic and session.path_exists(spark, lake.upload_dir(ref, epoch, user, file_format, landing=True)):
            # left behind by a load that failed before logging: never reused
            upload_log.release(spark, claims, epoch)
            epoch += 1
        else:
            return epoch


def _write_claimed(
    spark: SparkSession, text: DataFrame, lake: Lake, ref: DatasetRef, user: str, mode: str, epoch: int,
    skip_empty: bool | None, max_records_per_file: int, max_file_bytes: int, file_format: str, typed: bool, sketch: list[str], log_dir: str,
) -> LoadResult:
    path = lake.upload_dir(ref, epoch, user, file_format, landing=True)
    obs = Observation(f"rows_{ref.domain}_{ref.dataset}_{epoch}")
    writer = (
        text.observe(obs, F.count(F.lit(1)).alias("rows"), _lost_as_null(text, file_format).alias("lost"))
        .write.mode("errorifexists")  # same user + same second: the second load raises
        .option("maxRecordsPerFile", str(max_records_per_file))
    )
    if file_format == "csv":
        writer.options(**WRITE_OPTIONS).csv(path)
    else:
        writer.parquet(path)
    rows = int(obs.get["rows"])
    if obs.get["lost"]:
        session.delete_path(spark, path)
        raise UploadRefused(f"{obs.get['lost']} values are the text {NULL_TOKEN!r}, which CSV reads back as null; use file_format='parquet'")
    if rows == 0 and skip_empty is None and mode == "reload":
        session.delete_path(spark, path)
        raise UploadRefused(f"a reload of {ref} with an empty result needs skip_empty=True (keep the old rows) or False (hide them)")
    if rows == 0 and skip_empty is not False:
        session.delete_path(spark, path)  # only the folder this write created
        return LoadResult(ref, epoch, user, mode, 0, None)
    if file_format == "csv":
        _cut_large_files(spark, path, text.schema, max_file_bytes)
    if sketch:
        written = spark.read.schema(text.schema)
        part = written.options(**READ_OPTIONS).csv(path) if file_format == "csv" else written.parquet(path)
        sketches.write_sketch(spark, part, lake, ref, epoch, user, sketch)
    upload_log.append_row(
        spark,
        log_dir,
        {
            "domain": ref.domain,
            "dataset": ref.dataset,
            "upload_date": epoch,
            "user_id": user,
            "mode": mode,
            "rows": rows,
            "columns": list(text.columns),
            "format": file_format,
            "schema": text.schema.json() if typed else None,
            "sketched": sketch or None,
        },
    )
    return LoadResult(ref, epoch, user, mode, rows, path)


def _cut_large_files(spark: SparkSession, path: str, schema: T.StructType, most: int) -> None:
    """Replace the files of an upload that is not logged yet by smaller ones,
    where they have more than ``most`` bytes. Their rows are numbered by the
    bytes before them (id, row and size only; a file has at most
    ``max_records_per_file`` rows), which says where each new file ends; rows
    of more than half a file get one of their own."""
    large = [f for f, n in session.file_sizes(spark, path).items() if n > most]
    if not large or not schema.names:
        return
    columns = ["`" + c.replace("`", "``") + "`" for c in schema.names]
    room = max(2, most - len((",".join(schema.names) + "\n").encode()) - 2 * len(columns))
    options = {k: v for k, v in WRITE_OPTIONS.items() if k not in ("header", "encoding")}
    rows = spark.read.schema(schema).options(**READ_OPTIONS).csv(large).select(
        F.struct(*columns).alias("row"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    rows = stored(rows, "large-files")  # so a row has one number
    sizes = rows.select("file", "at", (F.octet_length(F.to_csv("row", options)) + 1).cast("long").alias("bytes"))
    sizes = stored(sizes.withColumn("big", F.col("bytes") > room // 2), "file-sizes")
    before = F.sum(F.when(~F.col("big"), F.col("bytes")).otherwise(0)).over(Window.partitionBy("file").orderBy("at"))
    cut = F.when(F.col("big"), -F.col("at") - 1).otherwise(F.expr(f"before DIV {max(1, room // 2)}"))
    ends = stored(sizes.withColumn("before", before).select("file", "at", cut.alias("cut")), "file-cuts")
    # new files by number: as many as the bytes need
    parts = ends.select("file", "cut").distinct().withColumn("part", F.row_number().over(Window.orderBy("file", "cut")) - 1)
    parts = stored(parts, "file-parts")
    dealt = rows.join(ends.join(parts, ["file", "cut"]).select("file", "at", "part"), ["file", "at"])
    dealt = dealt.repartitionById(parts.count(), F.col("part").cast("int")).select("row.*")
    dealt.write.mode("append").options(**WRITE_OPTIONS).csv(path)
    for f in large:
        session.delete_path(spark, f)  # written by this very load


def _lost_as_null(df: DataFrame, file_format: str):
    if file_format != "csv" or not df.columns:
        return F.count(F.lit(None))
    hits = [F.when(F.col("`" + c.replace("`", "``") + "`") == NULL_TOKEN, 1).otherwise(0) for c in df.columns]
    return F.coalesce(F.sum(sum(hits[1:], hits[0])), F.lit(0))


def append(spark, df, lake, ref, user, **kw) -> LoadResult:
    return write_upload(spark, df, lake, ref, user, mode="append", **kw)


def reload(spark, df, lake, ref, user, **kw) -> LoadResult:
    return write_upload(spark, df, lake, ref, user, mode="reload", **kw)
