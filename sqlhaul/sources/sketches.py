"""Sketches of columns, kept with each upload and merged when they are asked.

A load with ``sketch=[columns]`` writes, beside the log, two mergeable sketches
of each column of its upload, from one scan of what it has written:

* ``hash``: the ``SMALLEST`` smallest 64-bit hashes of the column's values. If
  there are fewer, their number is the number of distinct values; else the
  largest of them says how dense distinct hashes lie (standard error about
  ``1 / sqrt(SMALLEST)``).
* ``bin``: how many values (those that are numbers) lie in each log-linear bin.
  A bin is named by the bound nearer to zero, which keeps ``BITS`` + 1 binary
  digits of the value: quantiles come out at most a share of ``2 ** -BITS``
  nearer to zero than the exact ones.

Both merge to what one pass over all rows would give: the smallest hashes of the
smallest, and sums of counts. ``summaries`` reads the sketches of the uploads
that the log shows (a few thousand rows each), never the uploads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import upload_log
from .datasets import DatasetNotFound, DatasetRef, Lake

SMALLEST, BITS = 4096, 7
#: Classes of hashes that are ordered apart.
PARTS = 64
SKETCH_FOLDER = "_sketches"
SCHEMA = "column string, kind string, hash long, bin double, n long"


class NoSketch(LookupError):
    pass


def sketch_dir(lake: Lake, ref: DatasetRef, epoch: int, user: str, *, landing: bool = False) -> str:
    return f"{lake.dataset_dir(ref, landing=landing)}/{SKETCH_FOLDER}/{int(epoch)}/{user}"


def sketch(df: DataFrame, columns: list[str]) -> DataFrame:
    """The sketches of ``columns`` of ``df``. Nulls are in neither."""
    each = []
    for c in columns:
        text = F.col("`" + c.replace("`", "``") + "`").cast("string")
        each.append(F.struct(F.lit(c).alias("column"), F.xxhash64(text).alias("hash"), text.isNotNull().alias("there"), text.try_cast("double").alias("x")))
    rows = df.select(F.inline(F.array(*each))).where("there")
    hashes = rows.groupBy("column", "hash").agg(F.lit(None).cast("double").alias("bin"), F.lit(1).cast("long").alias("n"))
    size = f"greatest(pow(2D, floor(log2(abs(x))) - {BITS}), 4.9E-324D)"
    edge = F.expr(f"CASE WHEN x = 0 THEN 0D WHEN abs(x) = double('inf') THEN x ELSE sign(x) * floor(abs(x) / {size}) * {size} END")
    bins = rows.where("x is not null and not isnan(x)").groupBy("column", edge.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return _least(hashes.selectExpr("column", "'hash' as kind", "hash", "bin", "n")).unionByName(
        bins.selectExpr("column", "'bin' as kind", "cast(null as long) as hash", "bin", "n")
    )


def _least(hashes: DataFrame) -> DataFrame:
    """The smallest hashes of each column: first of each of ``PARTS`` classes of
    them, so that no task orders more than its class and each hands on
    ``SMALLEST`` at most, then of these."""
    for group in (["column", F.pmod("hash", F.lit(PARTS))], ["column"]):
        order = Window.partitionBy(*group).orderBy("hash")
        hashes = hashes.withColumn("k", F.row_number().over(order)).where(F.col("k") <= SMALLEST).drop("k")
    return hashes


def merge(sketches: DataFrame) -> DataFrame:
    """One sketch for each column of several."""
    hashes = sketches.where("kind = 'hash'").groupBy("column", "kind", "hash").agg(F.first("bin").alias("bin"), F.first("n").alias("n"))
    bins = sketches.where("kind = 'bin'").groupBy("column", "kind", "bin").agg(F.lit(None).cast("long").alias("hash"), F.sum("n").alias("n"))
    return _least(hashes).unionByName(bins)


def answers(merged: DataFrame, quantiles: list[float]) -> DataFrame:
    """(column, approx_distinct, n_numbers, quantiles: array) of a merged sketch."""
    hashes = merged.where("kind = 'hash'").groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.max("hash").alias("top"))
    # hashes as shares of their range
    share = (F.col("top").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    distinct = hashes.select("column", F.when(F.col("k") < SMALLEST, F.col("k")).otherwise(F.round((SMALLEST - 1) / share)).cast("long").alias("approx_distinct"))
    group = Window.partitionBy("column")
    upto = merged.where("kind = 'bin'").withColumns({"upto": F.sum("n").over(group.orderBy("bin")), "all": F.sum("n").over(group)})
    picks = [F.min(F.when(F.col("upto") >= F.lit(float(q)) * F.col("all"), F.col("bin"))) for q in quantiles]
    numbers = upto.groupBy("column").agg(F.max("all").alias("n_numbers"), F.array(*picks).alias("quantiles"))
    return distinct.join(numbers, "column", "left")


def write_sketch(spark: SparkSession, upload: DataFrame, lake: Lake, ref: DatasetRef, epoch: int, user: str, columns: list[str]) -> None:
    sketch(upload, columns).coalesce(1).write.mode("errorifexists").parquet(sketch_dir(lake, ref, epoch, user, landing=True))


def summaries(spark: SparkSession, lake: Lake, ref: DatasetRef, columns: list[str], quantiles: list[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, approx_distinct, n_numbers, quantiles) of a dataset's visible
    uploads. An upload without a sketch of a column raises ``NoSketch``; a column
    without any value has no row."""
    uploads = upload_log.visible_uploads(spark, lake.log_dir(ref))
    if uploads is None:
        raise DatasetNotFound(f"dataset {ref} has no upload log")
    missing = [(u["upload_date"], c) for u in uploads for c in columns if c not in (u["sketched"] or [])]
    if missing:
        raise NoSketch(f"dataset {ref}: uploads without a sketch of a column: {missing[:3]}")
    paths = [sketch_dir(lake, ref, u["upload_date"], u["user_id"]) for u in uploads]
    return answers(merge(spark.read.schema(SCHEMA).parquet(*paths).where(F.col("column").isin(list(columns)))), list(quantiles))
