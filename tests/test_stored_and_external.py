"""Stored-query lookup and the JDBC query source (options only: no database is
started in tests)."""

import pytest
from pyspark.sql import functions as F

from sqlhaul import DatasetRef, find_query, latest_per_name, put_query, stored_queries
from sqlhaul.functions.keys import upload_key_fields
from sqlhaul.sources.external import JdbcSource, query_options
from sqlhaul.sources.stored import StoredQueryNotFound

SQL_DS = DatasetRef("sql_domain", "sql_dataset")


def test_key_fields(spark):
    keys = [
        "sql_domain/sql_dataset/u1_ds9_1700000000_sample_data_query.sql",
        "u1_ds9_1700000001_report.sql",
        "u1_ds9_notanumber_x.sql",
        "u1_ds9_17",
        "lonely",
    ]
    df = spark.createDataFrame([(k,) for k in keys], "path string")
    got = [tuple(r) for r in df.select(*upload_key_fields(F.col("path"))).collect()]
    assert got == [
        ("u1", "ds9", 1700000000, "sample_data_query.sql"),
        ("u1", "ds9", 1700000001, "report.sql"),
        ("u1", "ds9", None, "x.sql"),
        ("u1", "ds9", 17, ""),
        ("lonely", None, None, ""),
    ]


def test_latest_upload_wins(spark, lake):
    put_query(spark, lake, SQL_DS, "u1", "ds9", 200, "q_one.sql", "SELECT 'new' AS v")
    put_query(spark, lake, SQL_DS, "u1", "ds9", 100, "q_one.sql", "SELECT 'old' AS v")
    put_query(spark, lake, SQL_DS, "u2", "ds9", 150, "other.sql", "-- größe\nSELECT 'ü' AS v;")
    directory = lake.dataset_dir(SQL_DS)
    assert find_query(spark, directory, "q_one.sql") == "SELECT 'new' AS v"
    assert find_query(spark, directory, "other.sql") == "-- größe\nSELECT 'ü' AS v;"
    latest = {r["file_name"]: r["upload_epoch"] for r in latest_per_name(stored_queries(spark, directory)).collect()}
    assert latest == {"q_one.sql": 200, "other.sql": 150}


def test_missing_and_empty_queries(spark, lake):
    put_query(spark, lake, SQL_DS, "u1", "ds9", 100, "empty.sql", "  \n")
    directory = lake.dataset_dir(SQL_DS)
    with pytest.raises(StoredQueryNotFound):
        find_query(spark, directory, "nope.sql")
    with pytest.raises(StoredQueryNotFound):
        find_query(spark, directory, "empty.sql")


def test_put_query_refuses_bad_fields(spark, lake):
    with pytest.raises(ValueError):
        put_query(spark, lake, SQL_DS, "u_1", "ds9", 1, "q.sql", "SELECT 1")
    with pytest.raises(ValueError):
        put_query(spark, lake, SQL_DS, "u1", "ds9", 1, "a/q.sql", "SELECT 1")


def test_jdbc_options_single_and_partitioned():
    src = JdbcSource("jdbc:postgresql://db/x", "org.postgresql.Driver", {"user": "etl"})
    single = query_options(src, "select * from t;")
    assert single["query"] == "select * from t" and "dbtable" not in single
    assert single["driver"] == "org.postgresql.Driver" and single["user"] == "etl"
    par = query_options(src, "select id, v from t", partition_column="id", lower_bound=0, upper_bound=1000,
                        num_partitions=8)
    assert par["dbtable"] == "(select id, v from t) q" and "query" not in par
    assert (par["partitionColumn"], par["lowerBound"], par["upperBound"], par["numPartitions"]) == (
        "id", "0", "1000", "8")


def test_jdbc_options_refuse_bad_input():
    src = JdbcSource("jdbc:x")
    with pytest.raises(ValueError):
        query_options(src, " ; ")
    with pytest.raises(ValueError):
        query_options(src, "select 1", partition_column="id")


def _python_fields(key: str):
    """Brute force: the four fields of an object key, by plain string ops."""
    import re

    parts = key.split("/")[-1].split("_")
    epoch = parts[2] if len(parts) > 2 else None
    epoch = int(epoch) if epoch is not None and re.fullmatch("[0-9]{1,18}", epoch) else None
    return (parts[0], parts[1] if len(parts) > 1 else None, epoch, "_".join(parts[3:]))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_field = st.text(alphabet="abcXYZ019_-+.é ", max_size=10)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.builds(lambda d, n: d + n, st.sampled_from(["", "dom/ds/", "a/b/c/"]), _field), min_size=1, max_size=20))
def test_key_fields_match_brute_force(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "path string")
    got = [tuple(r) for r in df.select(*upload_key_fields(F.col("path"))).collect()]
    assert got == [_python_fields(k) for k in keys]


def test_names_with_glob_characters(spark, lake):
    put_query(spark, lake, SQL_DS, "u1", "ds9", 100, "q[1]{a,b}*.sql", "SELECT 'star' AS v")
    put_query(spark, lake, SQL_DS, "u1", "ds9", 101, "q1a.sql", "SELECT 'plain' AS v")
    assert find_query(spark, lake.dataset_dir(SQL_DS), "q[1]{a,b}*.sql") == "SELECT 'star' AS v"


def test_jdbc_bounds_asked_from_the_database(spark):
    """Stand-in reader: answers the bounds probe, records the main read."""
    from sqlhaul.sources import external

    calls = []

    class _Reader:
        def __init__(self, fmt):
            self.opts = {}

        def options(self, **opts):
            self.opts = opts
            return self

        def load(self):
            calls.append(self.opts)
            if "min(o_orderkey)" in self.opts.get("query", ""):
                return spark.sql("SELECT 3 AS lo, 40003 AS hi")
            return spark.sql("SELECT 1 AS o_orderkey")

    class _Spark:
        class read:  # noqa: N801
            format = staticmethod(_Reader)

    src = external.JdbcSource("jdbc:x")
    external.read_query(_Spark(), src, "SELECT * FROM orders;", partition_column="o_orderkey", num_partitions=8)
    probe, main = calls
    assert probe["query"] == "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT * FROM orders) b"
    assert (main["lowerBound"], main["upperBound"], main["numPartitions"]) == ("3", "40003", "8")
    assert main["dbtable"] == "(SELECT * FROM orders) q"


def test_many_stored_queries_at_once(spark, lake):
    from sqlhaul.sources.stored import put_queries, stored_query_index

    ref = DatasetRef("sqlstore", "bulk")
    base = lake.dataset_dir(ref)
    rows = [("u1", f"d{i}", 1000 + i, f"report_{i % 7}.sql", f"SELECT {i}\n-- é ;") for i in range(60)]
    df = spark.createDataFrame(rows, "user string, dataset_id string, epoch long, file_name string, text string").repartition(4)
    assert put_queries(df, base) == 60
    assert stored_query_index(spark, base).count() == 60
    assert find_query(spark, base, "report_3.sql") == "SELECT 59\n-- é ;"
    assert put_queries(df.limit(0), base) == 0
    with pytest.raises(ValueError, match="bad key"):
        put_queries(df.selectExpr("'a_b' AS user", "dataset_id", "epoch", "file_name", "text"), base)


def test_stored_queries_put_at_once_need_no_file_each(spark, lake):
    import os

    from sqlhaul.sources.stored import put_queries, stored_query_index

    ref = DatasetRef("sqlstore", "packs")
    base = lake.dataset_dir(ref)
    rows = [(f"u{i % 5}", f"d{i}", 1000 + i, f"report {i % 7}_%[x].sql", f"SELECT {i}") for i in range(400)]
    schema = "user string, dataset_id string, epoch long, file_name string, text string"
    put_queries(spark.createDataFrame(rows, schema).repartition(3), f"{base}/folder a")
    assert sum(len(files) for _, _, files in os.walk(base)) < 20
    # a row that comes twice is one file; a name put again is overwritten
    put_queries(spark.createDataFrame([("u0", "d0", 1000, "report 0_%[x].sql", "SELECT 'new'")] * 2, schema), f"{base}/folder a")
    put_query(spark, lake, ref, "u9", "ds", 5000, "report 3_%[x].sql", "SELECT 'single'")
    index = {r["path"].split("/packs/")[1]: tuple(r)[1:] for r in stored_query_index(spark, base).collect()}
    want = {f"folder a/{u}_{d}_{e}_{n}": (u, d, e, n) for u, d, e, n, _ in rows} | {"u9_ds_5000_report 3_%[x].sql": ("u9", "ds", 5000, "report 3_%[x].sql")}
    assert index == want
    texts = {r["dataset_id"]: r["text"] for r in stored_queries(spark, base).collect()}
    assert texts == {d: t for _, d, _, _, t in rows} | {"d0": "SELECT 'new'", "ds": "SELECT 'single'"}
    assert find_query(spark, base, "report 3_%[x].sql") == "SELECT 'single'"
    assert find_query(spark, base, "report 0_%[x].sql") == "SELECT 399"
    put_queries(spark.createDataFrame([("u", "d", 1, "q.sql", "SELECT 1")], schema), base)
    with pytest.raises(FileExistsError):
        put_query(spark, lake, ref, "u", "d", 1, "q.sql", "SELECT 2")
