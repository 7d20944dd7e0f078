"""Helpers shared by the operators of this subpackage.

* scratch tables under the shared folder of the session;
* vectorised hashing of byte slices (words, lines, token chunks);
* connected components by alternating star contraction.

The 64-bit hashes here stand for the strings they are made of. They are
seeded with fixed random tables, so every executor gets the same values; two
different strings collide with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sqlhaul
from sqlhaul.session import scratch_dir

#: Bytes of text that one vectorised step works on (a longer text is one step).
STEP_BYTES = 1 << 20
#: The same for steps that hold many arrays beside the text, some of 8 bytes for
#: each of its bytes.
SMALL_STEP = 1 << 18

_MASK = (1 << 64) - 1
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


#: Rows of texts in an Arrow batch, where a session has Spark's default of
#: 10,000: a batch is in memory several times, in the JVM and in Python.
BATCH_ROWS = 1500
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's code to the executors, once an application (what
    ``--py-files`` does for a submitted job), and keep Arrow batches small."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(sqlhaul.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "sqlhaul_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and the rows survive the loss of any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept between calls up to a
    few steps' size."""
    have = _POWERS.get("up")
    if have is not None and len(have) >= n:
        return have[:n], _POWERS["down"][:n]
    size = max(n, (SMALL_STEP if n <= SMALL_STEP + 1 else STEP_BYTES) + 1)
    out = []
    for b in (_BASE, _INV):
        p = np.ones(size, np.uint64)
        done, step = 1, b & _MASK
        while done < size:
            take = min(done, size - done)
            p[done : done + take] = p[:take] * np.uint64(step)
            done += take
            step = step * step & _MASK
        out.append(p)
    if size <= 4 * STEP_BYTES:
        _POWERS["up"], _POWERS["down"] = out
    return out[0][:n], out[1][:n]


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each slice ``data[starts[i]:ends[i]]`` of a uint8 array."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, body = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) over a column in steps of at most ``most``
    bytes, or one row."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), rows)
        part = offsets[row : end + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = end


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def as_hash(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected graph ``edges`` (two bigint
    columns ``u``, ``v``): one row (``node``, ``root``) for each node that has
    an edge to another node, ``root`` the smallest node of its component.

    Alternating large-star and small-star steps, each a grouped minimum and a
    join back, until the edges no longer change; every step is written to the
    shared folder. A hub's edges are never gathered in one task: the minimum
    combines before the shuffle and AQE splits the join.
    """
    edges = save(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "cc-edges",
    )
    before = _summary(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))
        )
        edges = save(small.where("u <> v").distinct(), "cc-edges")
        after = _summary(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
