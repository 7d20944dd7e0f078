"""Session helpers: the shared workspace folder and Hadoop file system access.

Everything this library writes outside a named lake (scratch datasets of the
driver queries, catalog database folders) goes under the folder the cluster
names in ``spark.checkpoint.dir``. Only a local session that has none (tests)
gets a temporary folder, which is set as the checkpoint dir.

The file-system helpers are for metadata only (log entries, claims, one stored
query file, removing an upload folder this library just wrote); they use the
Hadoop FileSystem API of a classic session.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "sqlhaul", **conf: str) -> SparkSession:
    """A session with the settings this library assumes (UTC, AQE, no UI).

    On a cluster the caller passes its own session instead; nothing here is
    required by the library functions.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session with ``wanted`` settings, as they were before afterwards: for
    jobs that run meanwhile, not for frames that are run later."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def workspace_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. A local session
    without one gets a temporary folder; on a cluster, where executors could
    not see that, its absence raises."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sqlhaul-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the workspace."""
    return f"{workspace_dir(spark)}/sqlhaul/{tag}-{uuid.uuid4().hex[:12]}"


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def modified(spark: SparkSession, path: str) -> int:
    """When a file, or the listing of a folder, last changed (ms)."""
    fs, hpath = _fs_and_path(spark, path)
    return int(fs.getFileStatus(hpath).getModificationTime())


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove one folder this library created itself (never user data)."""
    fs, hpath = _fs_and_path(spark, path)
    fs.delete(hpath, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Create one small file with an exact name; refuses to overwrite."""
    fs, hpath = _fs_and_path(spark, path)
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def _plain_fs(spark: SparkSession, path: str):
    """As ``_fs_and_path``; a local folder gets no checksum files."""
    fs, hpath = _fs_and_path(spark, path)
    return (fs.getRawFileSystem() if fs.getScheme() == "file" else fs), hpath


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; ``False`` if it is there already. The file system
    decides (one call, atomic wherever its exclusive create is), so of several
    callers one gets ``True``."""
    fs, hpath = _plain_fs(spark, path)
    try:
        fs.create(hpath, False).close()
    except Py4JJavaError:
        if fs.exists(hpath):
            return False
        raise
    return True


def put_file(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file that appears whole: written beside under a hidden name,
    then renamed."""
    folder, _, name = path.rpartition("/")
    fs, hidden = _plain_fs(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if not fs.rename(hidden, _fs_and_path(spark, path)[1]):
        raise OSError(f"cannot put {path} in place")


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` with its folder in the shared
    workspace, not in a warehouse folder relative to the driver's cwd."""
    ident = "`" + name.replace("`", "``") + "`"
    location = f"{workspace_dir(spark)}/sqlhaul/catalog/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident} LOCATION {sql_literal(location)}")


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of the entries directly under ``path``
    (one listing call); empty if the folder does not exist."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [(status.getPath().getName(), bool(status.isDirectory())) for status in fs.listStatus(hpath)]


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the data files directly under ``path``, by full path."""
    fs, hpath = _fs_and_path(spark, path)
    found = {s.getPath().toString(): int(s.getLen()) for s in fs.listStatus(hpath) if s.isFile()}
    return {p: n for p, n in found.items() if not p.rpartition("/")[2].startswith(("_", "."))}


def list_dir_names(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _ in list_dir(spark, path)]
