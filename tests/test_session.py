"""Workspace folder: read from the session, set only when unset."""

import pytest

from sqlhaul.session import scratch_dir, workspace_dir


class _Conf:
    def __init__(self, value):
        self.values = {"spark.checkpoint.dir": value} if value else {}

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    master = "local[2]"

    def __init__(self, current=None):
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Spark:
    def __init__(self, conf_value=None, current=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(current)


def test_configured_dir_is_used_as_is():
    spark = _Spark("s3a://shared/ckpt/")
    assert workspace_dir(spark) == "s3a://shared/ckpt"
    assert spark.sparkContext.current is None  # nothing set


def test_context_dir_is_used_when_conf_is_unset():
    assert workspace_dir(_Spark(None, "hdfs:///ckpt/app-1")) == "hdfs:///ckpt/app-1"


def test_local_dir_only_when_nothing_is_set():
    spark = _Spark()
    path = workspace_dir(spark)
    assert spark.sparkContext.current == path and spark.conf.get("spark.checkpoint.dir") == path
    assert workspace_dir(spark) == path  # stable afterwards
    a, b = scratch_dir(spark, "t"), scratch_dir(spark, "t")
    assert a != b and a.startswith(path + "/sqlhaul/t-")


def test_a_cluster_without_a_shared_folder_raises():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        spark = _Spark()
        spark.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            workspace_dir(spark)


def test_frames_follow_their_files(spark, tmp_path):
    import os

    from sqlhaul.plans.inputs import table

    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    first = table(spark, str(tmp_path), "t")
    assert first.count() == 3 and table(spark, str(tmp_path), "t") is first
    spark.range(2).write.mode("append").parquet(path)
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert table(spark, str(tmp_path), "t").count() == 5
