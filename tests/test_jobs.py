"""Load jobs end to end."""

import pytest

from sqlhaul import DatasetRef, append, load_sql, load_stored, put_query, read_dataset
from sqlhaul.sources.stored import StoredQueryNotFound

SQL_DS = DatasetRef("sql_domain", "sql_dataset")
OUT = DatasetRef("output_domain", "output_dataset")


def test_mapping_sql_load(spark, lake, sf_dir, capsys):
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey AS key", "c_name AS name")
    supp = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey AS key", "s_name AS name")
    one, two = DatasetRef("domain_1", "DatasetName1"), DatasetRef("domain_2", "DatasetName2")
    append(spark, cust, lake, one, "userid", epoch=1)
    append(spark, supp, lake, two, "userid", epoch=1)
    res = load_sql(
        spark, lake, {"dataset_name_1": "domain_1:DatasetName1", "dataset_name_2": two},
        "SELECT * FROM dataset_name_1 UNION ALL SELECT * FROM dataset_name_2", "output_domain:output_dataset",
        "userid", epoch=5, show=3,
    )
    assert res.rows == 160 and res.mode == "append" and not res.skipped
    assert "Customer#" in capsys.readouterr().out  # preview printed
    assert read_dataset(spark, lake, OUT).count() == 160


def test_stored_query_load(spark, lake, sf_dir):
    put_query(spark, lake, SQL_DS, "userid", "ds1", 10, "sample_data_query.sql",
              "-- Sample Query\nselect * from rawtest_iris;")
    put_query(spark, lake, SQL_DS, "userid", "ds1", 20, "sample_data_query.sql",
              "-- Sample Query\nselect n_name from rawtest_iris where n_regionkey = 1;")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    res = load_stored(spark, lake, "sql_domain:sql_dataset", "sample_data_query.sql", OUT, "userid",
                      mapping={"rawtest_iris": nation}, epoch=30)
    assert res.rows == nation.filter("n_regionkey = 1").count()
    assert read_dataset(spark, lake, OUT).columns == ["n_name"]


def test_stored_query_missing(spark, lake):
    put_query(spark, lake, SQL_DS, "userid", "ds1", 10, "a.sql", "select 1")
    with pytest.raises(StoredQueryNotFound):
        load_stored(spark, lake, SQL_DS, "b.sql", OUT, "userid", epoch=30)


def test_empty_result_is_not_loaded(spark, lake, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    res = load_sql(spark, lake, {"n": nation}, "SELECT * FROM n WHERE n_nationkey < 0", OUT, "userid", epoch=3)
    assert res.skipped
    from sqlhaul.sources.datasets import DatasetNotFound

    with pytest.raises(DatasetNotFound):
        read_dataset(spark, lake, OUT)


def test_failed_loads_leave_the_target_unchanged(spark, lake, sf_dir):
    from pyspark.errors import AnalysisException

    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    load_sql(spark, lake, {"n": nation}, "SELECT n_name FROM n", OUT, "userid", epoch=1)
    # fails while planning: nothing is written
    with pytest.raises(AnalysisException):
        load_sql(spark, lake, {"n": nation}, "SELECT no_such_column FROM n", OUT, "userid", epoch=2)
    # fails inside the write job (ANSI cast error on some rows): files may be
    # left behind, but without a log row the upload is never visible
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        load_sql(spark, lake, {"n": nation},
                 "SELECT n_name, CAST(CASE WHEN n_nationkey > 20 THEN 'x' ELSE '1' END AS INT) AS v FROM n",
                 OUT, "userid", epoch=3, reload=True)
    back = read_dataset(spark, lake, OUT)
    assert back.columns == ["n_name"] and back.count() == 25


def test_external_source_wiring(spark, lake, sf_dir, monkeypatch):
    """No database can be started here: the JDBC read itself is replaced by a
    stand-in that records its options and returns a DataFrame, so the job
    wiring (options -> all-string result -> upload) is what is tested."""
    from sqlhaul import JdbcSource, load_external
    from sqlhaul.sources import external

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    seen = {}

    class _Reader:
        def __init__(self, fmt):
            seen["format"] = fmt

        def options(self, **opts):
            seen["options"] = opts
            return self

        def load(self):
            return orders.select("o_orderkey", "o_totalprice", "o_orderdate")

    class _Read:
        format = staticmethod(_Reader)

    class _Spark:
        read = _Read()

    src = JdbcSource("jdbc:postgresql://db/sales", "org.postgresql.Driver", {"user": "etl"})
    df = external.read_query(_Spark(), src, "SELECT * FROM orders;", as_text=True, partition_column="o_orderkey",
                             lower_bound=0, upper_bound=60000, num_partitions=4)
    assert seen["format"] == "jdbc"
    assert seen["options"]["dbtable"] == "(SELECT * FROM orders) q" and seen["options"]["numPartitions"] == "4"
    assert dict(df.dtypes) == {"o_orderkey": "string", "o_totalprice": "string", "o_orderdate": "string"}

    monkeypatch.setattr("sqlhaul.plans.jobs.read_query", lambda spark_, source, sql, **kw: external.read_query(
        _Spark(), source, sql, **kw))
    res = load_external(spark, lake, src, "SELECT * FROM orders", "ext:orders", "userid", epoch=7)
    assert res.rows == orders.count()
    assert read_dataset(spark, lake, DatasetRef("ext", "orders")).columns == ["o_orderkey", "o_totalprice", "o_orderdate"]
    assert seen["options"]["query"] == "SELECT * FROM orders"


def test_show_runs_the_query_once(spark, lake, capsys):
    """The preview reads the upload, so a query is not run for it."""
    from sqlhaul import DatasetRef, load_sql

    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    src = spark.range(3).selectExpr("id", "'x' v").coalesce(1).mapInArrow(count, "id long, v string")
    res = load_sql(spark, lake, {"s": src}, "SELECT * FROM s", DatasetRef("o", "t"), "u1", epoch=5, show=2)
    assert res.rows == 3 and ran.value == 3 and "|x  |" in capsys.readouterr().out


def test_stored_external_query_is_fetched_in_parts(spark, lake, monkeypatch):
    from sqlhaul import DatasetRef, load_stored
    from sqlhaul.plans import jobs
    from sqlhaul.sources.external import JdbcSource
    from sqlhaul.sources.stored import put_query

    asked = {}

    def read(spark, source, text, **options):
        asked.update(source=source, **options)
        return spark.createDataFrame([("1",)], "a string")

    monkeypatch.setattr(jobs, "read_query", read)
    ds, here = DatasetRef("sql", "q"), JdbcSource("jdbc:x:1")
    put_query(spark, lake, ds, "u", "d", 5, "q.sql", "SELECT 1")
    fetch = {"partition_column": "k", "num_partitions": 8}
    load_stored(spark, lake, ds, "q.sql", "o:t", "u", source="warehouse", sources={"warehouse": here}, fetch=fetch, max_records_per_file=10)
    assert asked["source"] is here and asked["num_partitions"] == 8 and asked["partition_column"] == "k"
    with pytest.raises(LookupError):
        load_stored(spark, lake, ds, "q.sql", "o:t", "u", source="other", sources={"warehouse": here})


def test_external_options_go_to_the_fetch_or_the_write(spark, lake, monkeypatch):
    from sqlhaul import JdbcSource, load_external, read_dataset
    from sqlhaul.sources.datasets import DatasetRef

    asked = {}

    def stand_in(spark_, source, sql, **kw):
        asked.update(kw)
        return spark_.range(5).selectExpr("id", "cast(id / 2 as decimal(5,1)) AS half")

    monkeypatch.setattr("sqlhaul.plans.jobs.read_query", stand_in)
    load_external(
        spark, lake, JdbcSource("jdbc:x:1"), "SELECT 1", "ext:typed", "userid", epoch=7, file_format="parquet", typed=True,
        sketch=["id"], partition_column="id", num_partitions=3,
    )
    assert asked == {"as_text": False, "partition_column": "id", "num_partitions": 3}
    assert read_dataset(spark, lake, DatasetRef("ext", "typed")).dtypes == [("id", "bigint"), ("half", "decimal(5,1)")]
