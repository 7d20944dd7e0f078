"""Append, reload, guard and upload-log visibility."""

import pytest
from pyspark.errors import AnalysisException

from sqlhaul import DatasetRef, append, load_sql, read_dataset, reload
from sqlhaul.sources.datasets import DatasetNotFound, HeaderDrift
from sqlhaul.sources.uploads import UploadRefused

REF = DatasetRef("d", "ds")


def _df(spark, rows):
    return spark.createDataFrame([(str(k), v) for k, v in rows], "id string, v string")


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_append_twice_is_bag_union(spark, lake):
    append(spark, _df(spark, [(1, "a"), (2, "b")]), lake, REF, "u1", epoch=10)
    append(spark, _df(spark, [(2, "b"), (3, "c")]), lake, REF, "u1", epoch=11)
    assert _ids(read_dataset(spark, lake, REF)) == ["1", "2", "2", "3"]


def test_reload_hides_older_then_append_adds(spark, lake):
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    reload(spark, _df(spark, [(2, "b")]), lake, REF, "u1", epoch=11)
    assert _ids(read_dataset(spark, lake, REF)) == ["2"]
    append(spark, _df(spark, [(3, "c")]), lake, REF, "u2", epoch=12)
    got = read_dataset(spark, lake, REF, with_upload_date=True)
    assert sorted((r["id"], r["upload_date"]) for r in got.collect()) == [("2", 11), ("3", 12)]


def test_reload_from_itself_reads_old_data(spark, lake):
    append(spark, _df(spark, [(1, "a"), (2, "b"), (3, "c")]), lake, REF, "u1", epoch=10)
    load_sql(spark, lake, {"me": REF}, "SELECT * FROM me WHERE id <> '2'", REF, "u1", reload=True, epoch=11)
    assert _ids(read_dataset(spark, lake, REF)) == ["1", "3"]


def test_skip_empty_leaves_dataset_unchanged(spark, lake):
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    res = reload(spark, _df(spark, [(9, "z")]).filter("id = 'none'"), lake, REF, "u1", epoch=11, skip_empty=True)
    assert res.skipped and res.rows == 0
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]
    # the skipped epoch was not logged, so it can be used again
    append(spark, _df(spark, [(2, "b")]), lake, REF, "u1", epoch=11)
    assert _ids(read_dataset(spark, lake, REF)) == ["1", "2"]


def test_same_epoch_or_older_is_refused(spark, lake):
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    with pytest.raises(UploadRefused):
        append(spark, _df(spark, [(2, "b")]), lake, REF, "u1", epoch=10)
    with pytest.raises(UploadRefused):
        append(spark, _df(spark, [(2, "b")]), lake, REF, "u2", epoch=9)


def test_existing_upload_folder_is_never_overwritten(spark, lake):
    # a folder laid down without a log row (e.g. a load that died before logging)
    _df(spark, [(7, "x")]).write.csv(lake.upload_dir(REF, 10, "u1"))
    with pytest.raises(AnalysisException):
        append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)


def test_unlogged_upload_is_invisible(spark, lake):
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    _df(spark, [(7, "x")]).write.option("header", True).csv(lake.upload_dir(REF, 11, "u1"))
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]
    assert _ids(read_dataset(spark, lake, REF, logged=False)) == ["1", "7"]


def test_bad_user_ids_refused(spark, lake):
    for user in ["a_b", "", "x/y", " u", "u[1]", "u*"]:
        with pytest.raises(UploadRefused):
            append(spark, _df(spark, [(1, "a")]), lake, REF, user, epoch=10)


def test_partition_column_name_refused(spark, lake):
    df = spark.createDataFrame([("1",)], "upload_date string")
    with pytest.raises(UploadRefused):
        append(spark, df, lake, REF, "u1", epoch=10)


def test_header_drift_raises(spark, lake):
    append(spark, spark.createDataFrame([("1", "2")], "a string, b string"), lake, REF, "u1", epoch=10)
    append(spark, spark.createDataFrame([("2", "1")], "b string, a string"), lake, REF, "u1", epoch=11)
    with pytest.raises(HeaderDrift):
        read_dataset(spark, lake, REF)


def test_missing_dataset_raises(spark, lake):
    with pytest.raises(DatasetNotFound):
        read_dataset(spark, lake, DatasetRef("no", "such"))


def test_dataset_ref_parsing():
    assert DatasetRef.parse(" dom:Data ") == DatasetRef("dom", "Data")
    for bad in ["dom", "dom:", ":ds", "a:b:c", "a/b:c", "d:ds[1]", "d{x}:ds", "d:a*"]:
        with pytest.raises(ValueError):
            DatasetRef.parse(bad)
    assert DatasetRef("dom", "Data").prefix == "dom/Data/"


def test_landing_and_read_roots(spark, tmp_path):
    from sqlhaul import Lake

    lake = Lake(str(tmp_path / "dlz"), str(tmp_path / "lz"))
    res = append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    assert res.path.startswith(str(tmp_path / "lz"))
    # readers look in the processed zone; the landing zone is the writer's
    with pytest.raises(DatasetNotFound):
        read_dataset(spark, lake, REF)
    assert _ids(read_dataset(spark, Lake(str(tmp_path / "lz")), REF)) == ["1"]


def test_log_folders(spark, lake):
    import os

    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    append(spark, _df(spark, [(2, "b")]), lake, REF, "u1", epoch=11)
    reload(spark, _df(spark, [(3, "c")]), lake, REF, "u1", epoch=12)
    append(spark, _df(spark, [(4, "d")]), lake, REF, "u1", epoch=13)
    assert sorted(os.listdir(lake.log_dir(REF))) == ["append-10", "append-11", "append-13", "reload-12"]
    assert _ids(read_dataset(spark, lake, REF)) == ["3", "4"]
    with pytest.raises(UploadRefused):
        append(spark, _df(spark, [(5, "e")]), lake, REF, "u1", epoch=13)


def test_interleaved_appends_are_all_seen(spark, lake):
    """A load whose log row comes after later loads' rows is not lost."""
    from sqlhaul.operators.result import stringify
    from sqlhaul.sources import upload_log
    from sqlhaul.sources.csv_contract import WRITE_OPTIONS

    for epoch in (10, 11, 13):
        append(spark, _df(spark, [(epoch, "x")]), lake, REF, "u1", epoch=epoch)
    text = stringify(_df(spark, [(12, "late")]))
    text.write.options(**WRITE_OPTIONS).csv(lake.upload_dir(REF, 12, "u2"))
    row = {"domain": REF.domain, "dataset": REF.dataset, "upload_date": 12, "user_id": "u2", "mode": "append", "rows": 1, "columns": text.columns, "format": "csv"}
    upload_log.append_row(spark, lake.log_dir(REF), row)
    assert _ids(read_dataset(spark, lake, REF)) == ["10", "11", "12", "13"]


def test_reload_without_success_marker(spark, lake):
    """Commit state does not hang on a marker file that a cluster may turn off."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    append(spark, _df(spark, [(1, "a"), (2, "b")]), lake, REF, "u1", epoch=10)
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        reload(spark, _df(spark, [(i, "c") for i in range(5)]), lake, REF, "u1", epoch=11)
        append(spark, _df(spark, [(9, "d")]), lake, REF, "u1", epoch=12)
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert _ids(read_dataset(spark, lake, REF)) == ["0", "1", "2", "3", "4", "9"]


def test_uncommitted_reload_is_ignored(spark, lake):
    import os

    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    # a reload whose log write is still running: its folder has no data file yet
    os.makedirs(os.path.join(lake.log_dir(REF), "reload-11", "_temporary"))
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]


def test_refused_before_it_poisons_the_dataset(spark, lake):
    from sqlhaul.operators.result import DuplicateColumns

    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    with pytest.raises(UploadRefused):
        append(spark, spark.createDataFrame([(1, 2)], "id int, UPLOAD_DATE int"), lake, REF, "u1", epoch=11)
    with pytest.raises(DuplicateColumns):
        append(spark, spark.createDataFrame([(1, 2)], "id int, ID int"), lake, REF, "u1", epoch=11)
    with pytest.raises(UploadRefused, match="reads back as null"):
        append(spark, _df(spark, [(1, "\\N")]), lake, REF, "u1", epoch=11)
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]
    append(spark, _df(spark, [(2, "\\N")]), lake, REF, "u1", epoch=11, file_format="parquet")
    assert {r["v"] for r in read_dataset(spark, lake, REF).collect()} == {"a", "\\N"}


def test_backtick_and_quote_in_names(spark, tmp_path):
    from sqlhaul import Lake, publish, run_sql

    lake, ref = Lake(str(tmp_path / "it's")), DatasetRef("quotedom", "T")
    append(spark, spark.createDataFrame([(1,)], "`a``b` int"), lake, ref, "u1", epoch=10)
    publish(spark, lake, ref)
    assert [r[0] for r in run_sql(spark, "SELECT `a``b` FROM quotedom.T").collect()] == ["1"]


def test_empty_reload_needs_a_choice(spark, lake):
    empty = _df(spark, [(1, "a")]).filter("id < 0")
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    with pytest.raises(UploadRefused):
        reload(spark, empty, lake, REF, "u1", epoch=11)
    assert reload(spark, empty, lake, REF, "u1", epoch=11, skip_empty=True).skipped
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]
    reload(spark, empty, lake, REF, "u1", epoch=12, skip_empty=False)
    assert _ids(read_dataset(spark, lake, REF)) == []


def test_parquet_and_mixed_format_uploads(spark, lake):
    append(spark, _df(spark, [(1, "a,b\nc")]), lake, REF, "u1", epoch=10)
    append(spark, _df(spark, [(2, None), (3, "")]), lake, REF, "u1", epoch=11, file_format="parquet")
    got = {r["id"]: r["v"] for r in read_dataset(spark, lake, REF).collect()}
    assert got == {"1": "a,b\nc", "2": None, "3": ""}
    reload(spark, _df(spark, [(4, "d")]), lake, REF, "u1", epoch=12, file_format="parquet")
    assert _ids(read_dataset(spark, lake, REF)) == ["4"]
    with pytest.raises(ValueError):
        append(spark, _df(spark, [(5, "e")]), lake, REF, "u1", epoch=13, file_format="orc")


def test_publish_parquet_dataset(spark, lake):
    from sqlhaul import publish, run_sql

    ref = DatasetRef("pqdom", "items")
    append(spark, _df(spark, [(1, "a"), (2, "b")]), lake, ref, "u1", epoch=10, file_format="parquet")
    append(spark, _df(spark, [(3, "c")]), lake, ref, "u1", epoch=11, file_format="parquet")
    publish(spark, lake, ref)
    df = run_sql(spark, "SELECT id FROM pqdom.items WHERE upload_date = 11 AND v = 'c'")
    assert [r["id"] for r in df.collect()] == ["3"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan


@pytest.mark.parametrize("second", ["a string", "a string, b string, c string"])
def test_header_drift_missing_or_extra_columns(spark, lake, second):
    append(spark, spark.createDataFrame([("1", "2")], "a string, b string"), lake, REF, "u1", epoch=10)
    row = tuple(str(i) for i in range(second.count(",") + 1))
    append(spark, spark.createDataFrame([row], second), lake, REF, "u1", epoch=11)
    with pytest.raises(HeaderDrift):
        read_dataset(spark, lake, REF)


def test_unlogged_reordered_header_fails_fast(spark, lake):
    opts = {"header": "true", "escape": '"'}
    spark.createDataFrame([("1", "2")], "a string, b string").write.options(**opts).csv(lake.upload_dir(REF, 10, "x"))
    spark.createDataFrame([("3", "4")], "b string, a string").write.options(**opts).csv(lake.upload_dir(REF, 11, "x"))
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_dataset(spark, lake, REF, logged=False).collect()


def test_collapse_many_uploads_by_reloading_from_itself(spark, lake):
    for i in range(5):
        append(spark, _df(spark, [(i, "x")]), lake, REF, "u1", epoch=10 + i)
    res = load_sql(spark, lake, {"d": REF}, "SELECT * FROM d", REF, "u1", reload=True, epoch=20, file_format="parquet")
    assert res.rows == 5
    got = read_dataset(spark, lake, REF, with_upload_date=True)
    assert {r["upload_date"] for r in got.collect()} == {20}
    assert _ids(got) == [str(i) for i in range(5)]


def test_automatic_epochs_never_collide(spark, lake):
    results = [append(spark, _df(spark, [(i, "x")]), lake, REF, "u1") for i in range(3)]
    epochs = [r.upload_date for r in results]
    assert epochs == sorted(set(epochs))  # strictly increasing, even within one second
    assert _ids(read_dataset(spark, lake, REF)) == ["0", "1", "2"]


def test_automatic_epoch_steps_past_an_orphan_folder(spark, lake):
    import time as _time

    now = int(_time.time())
    for e in (now, now + 1, now + 2):  # folders of loads that died before logging
        _df(spark, [(7, "x")]).write.csv(lake.upload_dir(REF, e, "u1"))
    res = append(spark, _df(spark, [(1, "a")]), lake, REF, "u1")
    assert res.upload_date >= now + 3
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]


# -- typed uploads, claims, log entries


def test_typed_uploads_push_filters_and_widen(spark, lake):
    a = spark.createDataFrame([(1, 1.5, "x"), (2, None, None)], "k int, d double, s string")
    b = spark.createDataFrame([(2**40, 2.5, "y")], "k long, d double, s string")
    append(spark, a, lake, REF, "u1", epoch=10, file_format="parquet", typed=True)
    one = read_dataset(spark, lake, REF)
    assert one.dtypes == a.dtypes
    assert "GreaterThan(k,1)" in one.where("k > 1")._jdf.queryExecution().executedPlan().toString()
    append(spark, b, lake, REF, "u1", epoch=11, file_format="parquet", typed=True)
    both = read_dataset(spark, lake, REF, with_upload_date=True)
    assert both.dtypes == [("k", "bigint"), ("d", "double"), ("s", "string"), ("upload_date", "bigint")]
    assert sorted(tuple(r) for r in both.where("k > 1").collect()) == [(2, None, None, 10), (2**40, 2.5, "y", 11)]
    plan = both.where("k > 1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(k,1)") == 2
    # beside text uploads all is text
    append(spark, a.selectExpr("k", "d", "s"), lake, REF, "u1", epoch=12)
    mixed = read_dataset(spark, lake, REF)
    assert mixed.dtypes == [("k", "string"), ("d", "string"), ("s", "string")]
    assert sorted(r["k"] for r in mixed.collect()) == ["1", "1", str(2**40), "2", "2"]
    with pytest.raises(ValueError, match="parquet"):
        append(spark, a, lake, REF, "u1", epoch=13, typed=True)


def test_typed_upload_of_every_kind(spark, lake):
    df = spark.sql("""SELECT id, cast(id as decimal(5,2)) d, date'2024-01-02' day, timestamp_ntz'2024-01-02 03:04:05.678901' t,
                      array(id, null) a, named_struct('x', id) st, map('k', id) m, cast('b' as binary) b, id = 1 ok FROM range(3)""")
    append(spark, df, lake, REF, "u1", epoch=10, file_format="parquet", typed=True)
    got = read_dataset(spark, lake, REF)
    assert got.dtypes == df.dtypes and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    append(spark, df.withColumn("st", df["a"]), lake, REF, "u1", epoch=11, file_format="parquet", typed=True)
    texts = sorted(r["st"] for r in read_dataset(spark, lake, REF).collect())
    assert texts == sorted([f"[{i},null]" for i in range(3)] + [f'{{"x":{i}}}' for i in range(3)])


def test_wider_types():
    from pyspark.sql import types as T

    from sqlhaul.functions.widening import wider

    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert wider(i, l) == l and wider(l, i) == l and wider(i, d) == d and wider(l, d) == s and wider(s, i) == s
    assert wider(T.DecimalType(10, 2), l) == T.DecimalType(21, 2) and wider(T.DecimalType(28, 0), T.DecimalType(10, 10)) == T.DecimalType(38, 10)
    assert wider(T.DecimalType(38, 30), l) == s and wider(T.DateType(), T.TimestampType()) == T.TimestampType()


@pytest.mark.parametrize("other", ["u1", "u2"])
def test_of_two_loads_of_one_second_the_second_raises(spark, lake, other, monkeypatch):
    """The second load starts while the first one writes."""
    from sqlhaul.sources import uploads

    seen = []

    def between(*args, **kw):
        monkeypatch.setattr(uploads.upload_log, "append_row", real)
        with pytest.raises(UploadRefused, match="another load"):
            append(spark, _df(spark, [(2, "b")]), lake, REF, other, epoch=10)
        seen.append(append(spark, _df(spark, [(3, "c")]), lake, REF, other).upload_date)  # takes a second of its own
        return real(*args, **kw)

    real = uploads.upload_log.append_row
    monkeypatch.setattr(uploads.upload_log, "append_row", between)
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    assert seen and seen[0] != 10
    assert _ids(read_dataset(spark, lake, REF)) == ["1", "3"]
    with pytest.raises(UploadRefused):
        append(spark, _df(spark, [(4, "d")]), lake, REF, other, epoch=10)


def test_two_automatic_loads_of_one_second(spark, lake, monkeypatch):
    from sqlhaul.sources import uploads

    monkeypatch.setattr(uploads.time, "time", lambda: 1000.5)
    real, dates = uploads.upload_log.append_row, []

    def between(*args, **kw):
        monkeypatch.setattr(uploads.upload_log, "append_row", real)
        dates.append(append(spark, _df(spark, [(2, "b")]), lake, REF, "u2").upload_date)
        return real(*args, **kw)

    monkeypatch.setattr(uploads.upload_log, "append_row", between)
    dates.append(append(spark, _df(spark, [(1, "a")]), lake, REF, "u1").upload_date)
    assert sorted(dates) == [1000, 1001]
    assert _ids(read_dataset(spark, lake, REF)) == ["1", "2"]


def test_a_failed_load_gives_its_second_back(spark, lake):
    from pyspark.sql import functions as F

    bad = _df(spark, [(1, "a")]).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        append(spark, bad, lake, REF, "u1", epoch=10)
    append(spark, _df(spark, [(1, "a")]), lake, REF, "u2", epoch=10)
    assert _ids(read_dataset(spark, lake, REF)) == ["1"]


def test_log_folders_of_earlier_versions_are_read(spark, lake):
    from pyspark.sql.types import StructType

    from sqlhaul.sources import upload_log

    append(spark, _df(spark, [(1, "a")]), lake, REF, "u1", epoch=10)
    reload(spark, _df(spark, [(2, "b")]), lake, REF, "u1", epoch=11)
    append(spark, _df(spark, [(3, "c")]), lake, REF, "u1", epoch=12)
    # the same log as parquet folders, but for the last load
    other = f"{lake.read_root}/old_log"
    for u in upload_log.visible_uploads(spark, lake.log_dir(REF)):
        row = {"domain": "d", "dataset": "ds", **u}
        if u["upload_date"] == 12:
            upload_log.append_row(spark, other, row)
        else:
            old = spark.createDataFrame([{k: v for k, v in row.items() if k not in ("schema", "sketched")}], StructType(upload_log.LOG_SCHEMA.fields[:-2]))
            old.coalesce(1).write.parquet(f"{other}/{u['mode']}-{u['upload_date']}")
    assert [u["upload_date"] for u in upload_log.visible_uploads(spark, other)] == [11, 12]
    assert upload_log.last_epoch(spark, other) == 12


def test_no_csv_file_above_the_byte_bound(spark, lake):
    import os

    rows = [(str(i), ('a "quoted", text\n' * (1 + 40 * (i % 7 == 0)) + "é" * (i % 90)) if i % 13 else None) for i in range(600)] + [("big", "x" * 30_000), ("é", ""), ("big2", '"' * 9_000)]
    df = _df(spark, rows).coalesce(2)
    res = append(spark, df, lake, REF, "u1", epoch=10, max_file_bytes=8_000)
    sizes = {f: os.path.getsize(os.path.join(res.path, f)) for f in os.listdir(res.path) if f.endswith(".csv")}
    assert sum(n > 8_000 for n in sizes.values()) == 2  # the two rows that are larger themselves
    assert len(sizes) < 60
    got = read_dataset(spark, lake, REF)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rows))
    # nothing to cut: the files are left as they are
    res = append(spark, df, lake, DatasetRef("d", "small"), "u1", epoch=10)
    assert len([f for f in os.listdir(res.path) if f.endswith(".csv")]) == 2
