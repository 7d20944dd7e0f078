"""Views, SQL text handling and qualified names."""

import pytest
from pyspark.errors import ParseException

from sqlhaul import DatasetRef, append, publish, register, reload, run_sql
from sqlhaul.operators.sql import EmptyQuery
from sqlhaul.sources.datasets import DatasetNotFound


def test_register_and_union_all_by_position(spark, lake):
    one = spark.createDataFrame([(1, "a")], "k int, name string")
    two = spark.createDataFrame([(2.5, "b")], "key double, label string")
    register(spark, {"dataset_name_1": one, "dataset_name_2": two})
    df = run_sql(spark, "SELECT * FROM dataset_name_1\nUNION ALL\nSELECT * FROM dataset_name_2")
    assert df.columns == ["k", "name"]  # names from the left side
    assert dict(df.dtypes)["k"] == "double"  # types widened
    assert sorted(tuple(r) for r in df.collect()) == [(1.0, "a"), (2.5, "b")]


def test_union_all_column_count_must_agree(spark):
    register(spark, {"x1": spark.sql("SELECT 1 AS a"), "x2": spark.sql("SELECT 1 AS a, 2 AS b")})
    with pytest.raises(Exception, match="NUM_COLUMNS_MISMATCH"):
        run_sql(spark, "SELECT * FROM x1 UNION ALL SELECT * FROM x2")


def test_alias_is_replaced(spark):
    register(spark, {"v": spark.sql("SELECT 1 AS a")})
    register(spark, {"v": spark.sql("SELECT 2 AS a")})
    assert run_sql(spark, "SELECT a FROM v").first()[0] == 2


def test_comment_and_terminator(spark):
    assert run_sql(spark, "-- Sample Query\nselect 1 AS x;").first()[0] == 1


def test_empty_and_multiple_statements(spark):
    with pytest.raises(EmptyQuery):
        run_sql(spark, "  \n ")
    with pytest.raises(ParseException):
        run_sql(spark, "SELECT 1; SELECT 2")


def test_named_parameters(spark):
    df = run_sql(spark, "SELECT :a + 1 AS x, :s AS s", {"a": 41, "s": "it's"})
    assert tuple(df.first()) == (42, "it's")


def test_dataset_alias_needs_lake(spark):
    with pytest.raises(ValueError):
        register(spark, {"v": DatasetRef("d", "x")})


def test_publish_qualified_table_with_pruning(spark, lake):
    ref = DatasetRef("pubdom", "Events")
    df = lambda ids: spark.createDataFrame([(str(i), "x") for i in ids], "id string, v string")
    append(spark, df([1]), lake, ref, "u1", epoch=100)
    reload(spark, df([2, 3]), lake, ref, "u1", epoch=101)
    append(spark, df([4]), lake, ref, "u2", epoch=102)
    name = publish(spark, lake, ref)
    assert name == "pubdom.Events"
    rows = run_sql(spark, "select * from pubdom.Events LIMIT 10;").collect()
    assert sorted(r["id"] for r in rows) == ["2", "3", "4"]
    pruned = run_sql(spark, "SELECT id FROM pubdom.Events WHERE upload_date = 102")
    assert [r["id"] for r in pruned.collect()] == ["4"]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "upload_date" in plan
    # a new load shows up after publishing again
    append(spark, df([5]), lake, ref, "u1", epoch=103)
    publish(spark, lake, ref)
    assert spark.table("pubdom.Events").count() == 4


def test_parquet_catalog_table(spark, sf_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS rawtest")
    spark.sql("DROP TABLE IF EXISTS rawtest.nation_parquet")
    spark.sql(f"CREATE TABLE rawtest.nation_parquet USING parquet LOCATION '{sf_dir}/nation.parquet'")
    assert run_sql(spark, "-- Sample Query\nselect * from rawtest.nation_parquet;").count() == 25


def test_publish_is_incremental(spark, lake):
    ref = DatasetRef("incdom", "T")
    df = lambda ids: spark.createDataFrame([(str(i), "x") for i in ids], "id string, v string")
    parts = lambda: sorted(r[0] for r in spark.sql("SHOW PARTITIONS incdom.T").collect())
    append(spark, df([1]), lake, ref, "u1", epoch=100)
    publish(spark, lake, ref)
    spark.sql("ALTER TABLE incdom.T SET TBLPROPERTIES ('probe' = 'kept')")
    append(spark, df([2]), lake, ref, "u1", epoch=101)
    publish(spark, lake, ref)
    assert parts() == ["upload_date=100/upload_user=u1", "upload_date=101/upload_user=u1"]
    # the table was altered, not declared again
    assert spark.sql("SHOW TBLPROPERTIES incdom.T ('probe')").first()["value"] == "kept"
    reload(spark, df([3]), lake, ref, "u1", epoch=102)
    publish(spark, lake, ref)
    assert parts() == ["upload_date=102/upload_user=u1"]
    assert [r["id"] for r in spark.table("incdom.T").collect()] == ["3"]
    # dropping partitions of the external table left the files in place
    from sqlhaul import read_dataset

    assert sorted(r["id"] for r in read_dataset(spark, lake, ref, logged=False).collect()) == ["1", "2", "3"]
    # a new column list re-declares the table
    reload(spark, spark.createDataFrame([("9",)], "other string"), lake, ref, "u1", epoch=103)
    publish(spark, lake, ref)
    assert spark.table("incdom.T").columns == ["other", "upload_date", "upload_user"]


def test_publish_same_name_from_another_lake(spark, tmp_path):
    from sqlhaul import Lake

    ref = DatasetRef("movedom", "T")
    one, two = Lake(str(tmp_path / "one")), Lake(str(tmp_path / "two"))
    append(spark, spark.createDataFrame([("a",)], "id string"), one, ref, "u1", epoch=100)
    append(spark, spark.createDataFrame([("b",)], "id string"), two, ref, "u1", epoch=100)
    publish(spark, one, ref)
    assert [r["id"] for r in spark.table("movedom.T").collect()] == ["a"]
    publish(spark, two, ref)
    assert [r["id"] for r in spark.table("movedom.T").collect()] == ["b"]


def _pruned_files(df) -> set[str]:
    return {f.rsplit("upload_date=", 1)[-1].split("/")[0] for f in df.inputFiles()}


def test_publish_turns_between_table_and_view(spark, lake):
    """One format, then two (a view), then one again after a reload."""
    ref = DatasetRef("turning", "ds")
    rows = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "id int, v string")
    append(spark, rows(1), lake, ref, "u", epoch=10)
    publish(spark, lake, ref)
    assert spark.table("turning.ds").count() == 1
    append(spark, rows(2), lake, ref, "u", epoch=11, file_format="parquet")
    append(spark, rows(3), lake, ref, "u", epoch=12, file_format="parquet", typed=True)
    publish(spark, lake, ref)
    assert sorted((r["id"], r["upload_date"]) for r in spark.table("turning.ds").collect()) == [("1", 10), ("2", 11), ("3", 12)]
    assert _pruned_files(spark.sql("SELECT * FROM turning.ds WHERE upload_date >= 12")) == {"12"}
    append(spark, rows(4), lake, ref, "u", epoch=13)
    publish(spark, lake, ref)
    assert spark.table("turning.ds").count() == 4
    reload(spark, rows(5, 6), lake, ref, "u", epoch=14, file_format="parquet", typed=True)
    publish(spark, lake, ref)
    assert spark.table("turning.ds").dtypes[:2] == [("id", "int"), ("v", "string")]
    assert sorted(r["id"] for r in spark.table("turning.ds").collect()) == [5, 6]


def test_publish_unlogged_folders(spark, lake):
    ref = DatasetRef("unlogged", "ds")
    base = lake.dataset_dir(ref)
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    df.write.parquet(f"{base}/upload_date=5/x/parquet")
    df.selectExpr("id + 10 AS id", "v").write.parquet(f"{base}/upload_date=6/parquet")
    publish(spark, lake, ref)
    table = spark.table("unlogged.ds")
    assert table.dtypes == [("id", "int"), ("v", "string"), ("upload_date", "bigint"), ("upload_folder", "string")]
    assert sorted((r["id"], r["upload_date"]) for r in table.collect()) == [(1, 5), (2, 5), (11, 6), (12, 6)]
    assert _pruned_files(spark.sql("SELECT * FROM unlogged.ds WHERE upload_date = 6")) == {"6"}
    # without dates there is the folder alone
    other = DatasetRef("unlogged", "plain")
    df.write.option("header", True).csv(f"{lake.dataset_dir(other)}/a b/part one")
    df.write.option("header", True).csv(f"{lake.dataset_dir(other)}/c")
    publish(spark, lake, other)
    assert spark.table("unlogged.plain").columns == ["id", "v", "upload_folder"] and spark.table("unlogged.plain").count() == 4
    with pytest.raises(DatasetNotFound):
        publish(spark, lake, DatasetRef("unlogged", "nothing"))
