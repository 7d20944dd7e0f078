"""Plan shape: the properties the design relies on at scale, read from
``explain("formatted")``."""

import contextlib
import io
import re

import __spark_entry__ as E
from sqlhaul import DatasetRef, append, publish, read_dataset, run_sql


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_parquet_filters_and_columns_reach_the_scan(spark, sf_dir):
    p = plan(E.queries()["scan_parquet_pushdown"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(l_discount,0\.05\)", p)
    read_schema = re.search(r"ReadSchema: (struct<[^\n]*>)", p).group(1)
    assert "l_tax" not in read_schema and "l_comment" not in read_schema


def test_interval_and_asof_joins_emit_no_pairs(spark, sf_dir):
    for name in ("interval_join", "asof_join"):
        p = plan(E.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
    p = plan(E.queries()["interval_join"](spark, sf_dir))
    # probes meet the summary of their chunk, never events: a busy user is spread over chunks
    assert re.search(r"(Left keys|Keys) \[\d\]: \[.*__chunk#\d+", p)


def test_counts_come_before_joins(spark, sf_dir):
    """Without any broadcast, the large side is aggregated below its exchange."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, column in (("range_generator", "l_linenumber"), ("recursive_cte", "l_linenumber"), ("join_left", "o_custkey")):
            p = plan(E.queries()[name](spark, sf_dir))
            assert re.search(rf"Keys \[1\]: \[{column}#\d+L?\]\s+Functions \[1\]: \[partial_count", p), name
            assert re.search(rf"hashpartitioning\({column}#\d+L?,", p), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_k_per_group_limits_before_the_shuffle(spark, sf_dir):
    p = plan(E.queries()["qualify_as_cte"](spark, sf_dir))
    tree = p.split("\n\n")[0]
    first_exchange = tree.index("Exchange")
    assert "WindowGroupLimit" in tree[first_exchange:], "partial group limit below the exchange"


def test_stored_query_choice_aggregates_partially(spark, sf_dir):
    p = plan(E.queries()["stored_query_latest"](spark, sf_dir))
    tree = p.split("\n\n")[0]
    below = tree[tree.index("Exchange"):]
    assert re.search(r"(Sort|Hash|ObjectHash)Aggregate", below), "partial max_by before the shuffle"


def test_dataset_read_prunes_columns(spark, lake):
    ref = DatasetRef("p", "wide")
    df = spark.createDataFrame([("1", "a", "b")], "id string, v string, w string")
    append(spark, df, lake, ref, "u1", epoch=10)
    p = plan(read_dataset(spark, lake, ref).select("v"))
    assert "ReadSchema: struct<v:string>" in p


def test_published_dataset_prunes_upload_partitions(spark, lake):
    ref = DatasetRef("plandom", "events")
    for e in (10, 11, 12):
        append(spark, spark.createDataFrame([(str(e), "x")], "id string, v string"), lake, ref, "u1", epoch=e)
    publish(spark, lake, ref)
    p = plan(run_sql(spark, "SELECT id FROM plandom.events WHERE upload_date = 12"))
    assert re.search(r"PartitionFilters: \[.*upload_date.*= 12\)", p)


def test_registered_dataset_view_prunes_uploads(spark, lake):
    from sqlhaul import register

    ref = DatasetRef("p", "daily")
    for e in (10, 11, 12):
        append(spark, spark.createDataFrame([(str(e), "x")], "id string, v string"), lake, ref, "u1", epoch=e)
    register(spark, {"daily": ref}, lake, with_upload_date=True)
    df = run_sql(spark, "SELECT id FROM daily WHERE upload_date >= 12")
    assert [r["id"] for r in df.collect()] == ["12"]
    assert re.search(r"PartitionFilters: \[.*upload_date", plan(df))


def test_approx_aggregates_deal_distinct_values_by_value(spark, tmp_path, monkeypatch):
    from sqlhaul.plans import conformance

    rows = [(i // 3, 100.0 + i * 7 % 600, "ANR"[i % 3]) for i in range(600)]
    spark.createDataFrame(rows, "l_orderkey long, l_extendedprice double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    plans = []
    monkeypatch.setattr(conformance, "stored", lambda df, tag, own=conformance.stored: plans.append(plan(df)) or own(df, tag))
    key, threshold = "spark.sql.requireAllClusterKeysForDistribution", "spark.sql.autoBroadcastJoinThreshold"
    old, before = spark.conf.get(threshold), spark.conf.get(key)
    spark.conf.set(threshold, "-1")  # as for tables that are too large for it
    try:
        got = E.queries()["approx_aggregates"](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == [(f, True, True) for f in "ANR"]
    finally:
        spark.conf.set(threshold, old)
    assert re.search(r"hashpartitioning\(l_returnflag#\d+, l_orderkey#\d+", plans[0])
    assert spark.conf.get(key) == before
