"""The upload log: one small file per load, beside the dataset's data.

``_uploads/append-<epoch>`` or ``_uploads/reload-<epoch>`` is one line of JSON:
``domain, dataset, upload_date (epoch s), user_id, mode ('append'|'reload'),
rows, columns, format``, ``schema`` (of typed uploads), ``sketched`` (columns). A second load of
one mode and second, which a claim prevents, would be ``...-<epoch>-2``.

A load adds one file, put in place whole by a rename, and touches nothing else,
however many loads there are, so no load can hide another's. Readers list the
one folder, take the newest reload, and read that reload and every load after
it with one scan of the folder. Nothing is rewritten or deleted.
Datasets logged by earlier versions have a parquet folder of that name for each
load; they are read as well, and count once their file is there.

A load claims its second before it writes (``claim``): the file
``_claims/<epoch>`` is created only if it does not exist, so of two loads that
want one second the later one knows before it has written anything. The claim
goes when the load is logged, skipped or has failed.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session

LOG_FOLDER, CLAIMS_FOLDER = "_uploads", "_claims"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("domain", T.StringType(), False),
        T.StructField("dataset", T.StringType(), False),
        T.StructField("upload_date", T.LongType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
        T.StructField("columns", T.ArrayType(T.StringType(), False), False),
        T.StructField("format", T.StringType(), True),  # csv | parquet; null = csv
        T.StructField("schema", T.StringType(), True),  # JSON of the column types; null = all strings
        T.StructField("sketched", T.ArrayType(T.StringType(), False), True),  # columns with sketches
    ]
)

_ENTRY = re.compile(r"(append|reload)-(\d+)(?:-\d+)?")


def _entries(spark: SparkSession, log_dir: str) -> list[tuple[int, str, str, bool]]:
    """(epoch, mode, name, whether it is a folder) of every load, oldest first."""
    found = []
    for name, folder in session.list_dir(spark, log_dir):
        if m := _ENTRY.fullmatch(name):
            found.append((int(m[2]), m[1], name, folder))
    return sorted(found)


def _committed(spark: SparkSession, log_dir: str, name: str, folder: bool) -> bool:
    return not folder or any(not n.startswith(("_", ".")) for n in session.list_dir_names(spark, f"{log_dir}/{name}"))


def visible_uploads(spark: SparkSession, log_dir: str) -> list[dict] | None:
    """Uploads since the last reload, oldest first; ``None`` if no load has finished."""
    loads = _entries(spark, log_dir)
    start = next((e for e, mode, name, folder in reversed(loads) if mode == "reload" and _committed(spark, log_dir, name, folder)), None)
    visible = [(name, folder) for e, mode, name, folder in loads if start is None and mode == "append" or start is not None and (e >= start if mode == "append" else e == start)]
    if not visible:
        return None
    rows = None
    if any(not folder for _, folder in visible):
        # one listing and one scan, however many loads; names with "_" are hidden
        rows = spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").option("pathGlobFilter", "{append,reload}-*").json(log_dir)
        if start is not None:
            rows = rows.where((F.col("upload_date") >= start) & ((F.col("mode") == "append") | (F.col("upload_date") == start)))
        else:
            rows = rows.where("mode = 'append'")
    folders = [f"{log_dir}/{name}" for name, folder in visible if folder]
    if folders:
        earlier = spark.read.schema(LOG_SCHEMA).parquet(*folders)
        rows = earlier if rows is None else rows.union(earlier)
    # a few rows, put in order here: an order in Spark would be two more jobs
    got = rows.select("upload_date", "user_id", "mode", "rows", "columns", F.coalesce("format", F.lit("csv")).alias("format"), "schema", "sketched").collect()
    return sorted((r.asDict() for r in got), key=lambda u: (u["upload_date"], u["user_id"])) or None


def last_epoch(spark: SparkSession, log_dir: str) -> int | None:
    """The newest finished load's epoch, from the folder's listing alone."""
    for epoch, _, name, folder in reversed(_entries(spark, log_dir)):
        if _committed(spark, log_dir, name, folder):
            return epoch
    return None


def append_row(spark: SparkSession, log_dir: str, row: dict) -> None:
    """Written after the data, so a load that failed midway is never visible."""
    line = json.dumps({f.name: row.get(f.name) for f in LOG_SCHEMA.fields}) + "\n"
    first = name = f"{row['mode']}-{int(row['upload_date'])}"
    taken, k = {n for n, _ in session.list_dir(spark, log_dir)}, 1
    while name in taken:
        k += 1
        name = f"{first}-{k}"
    session.put_file(spark, f"{log_dir}/{name}", line.encode())


def claim(spark: SparkSession, claims_dir: str, epoch: int) -> bool:
    """Whether this load is the one that may write uploads of this second."""
    return session.create_new(spark, f"{claims_dir}/{int(epoch)}")


def release(spark: SparkSession, claims_dir: str, epoch: int) -> None:
    session.delete_path(spark, f"{claims_dir}/{int(epoch)}")
