"""Panes and lattices against Spark's own window, CUBE and GROUPING SETS."""

import pytest
from pyspark.sql import functions as F

from sqlhaul.operators.rollups import cube_sets, lattice, rollup_sets, sliding_panes

OUT = {
    "n": ("count", "*"), "nx": ("count", "x"), "s": ("sum", "x"), "sd": ("sum", "d"), "a": ("avg", "x"), "ad": ("avg", "d"),
    "lo": ("min", "x"), "hi": ("max", "k"), "u": ("approx_distinct", "x"),
}
SQL = "count(*) n, count(x) nx, sum(x) s, sum(d) sd, avg(x) a, avg(d) ad, min(x) lo, max(k) hi, hll_sketch_estimate(hll_sketch_agg(x)) u"


@pytest.fixture()
def rows(spark):
    df = spark.range(400).selectExpr(
        "if(id % 7 = 0, null, concat('k', id % 4)) k", "id % 3 g", "if(id % 11 = 0, null, cast(id * 37 % 50 as int)) x", "cast(id % 13 as decimal(9,2)) / 4 d0",
        "if(id % 50 = 3, null, timestamp_seconds(id * 977 % 20000 - 5000)) ts", "cast(timestamp_seconds(id * 977 % 20000) as timestamp_ntz) tn",
    ).selectExpr("k", "g", "x", "cast(d0 as decimal(9,2)) d", "ts", "tn")
    df.createOrReplaceTempView("rolled")
    return df


def same(got, want):
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_cube_and_sets(spark, rows):
    same(lattice(rows, ["k", "g"], cube_sets(["k", "g"]), OUT).drop("u"), spark.sql(f"SELECT k, g, grouping_id() grouping_id, {SQL} FROM rolled GROUP BY CUBE (k, g)").drop("u"))
    got = lattice(rows, ["k", "g", "x"], [("g", "k"), ("x",), ("x",), ()], {"n": ("count", "*")})
    same(got, spark.sql("SELECT k, g, x, grouping_id() grouping_id, count(*) n FROM rolled GROUP BY GROUPING SETS ((k, g), (x), (x), ())"))
    same(lattice(rows, ["k", "g"], rollup_sets(["k", "g"]), {"n": ("count", "d")}), spark.sql("SELECT k, g, grouping_id() grouping_id, count(d) n FROM rolled GROUP BY ROLLUP (k, g)"))


def test_distinct_estimates(spark, rows):
    for r in lattice(rows, ["g"], [("g",), ()], {"u": ("approx_distinct", "x")}).collect():
        exact = rows.where(F.col("g").eqNullSafe(r["g"]) | F.lit(r["grouping_id"] == 1)).select(F.count_distinct("x")).first()[0]
        assert abs(r["u"] - exact) <= 0.05 * exact


def test_empty_table_and_wrong_names(spark, rows):
    none = rows.limit(0)
    got = lattice(none, ["k"], [("k",), ()], {"n": ("count", "*"), "s": ("sum", "x")}).collect()
    assert [tuple(r) for r in got] == [(None, 1, 0, None)]
    with pytest.raises(ValueError, match="not dimensions"):
        lattice(rows, ["k"], [("g",)], {"n": ("count", "*")})
    with pytest.raises(ValueError, match="unknown function"):
        lattice(rows, ["k"], [()], {"n": ("median", "x")})
    assert sliding_panes(none, "ts", 60, 30, ["k"], {"n": ("count", "*")}).count() == 0


@pytest.mark.parametrize("width,slide", [(3600, 1800), (5400, 1200), (600, 600), (7, 3)])
@pytest.mark.parametrize("ts", ["ts", "tn"])
def test_sliding_windows(spark, rows, width, slide, ts):
    got = sliding_panes(rows, ts, width, slide, ["k"], {n: o for n, o in OUT.items() if n != "u"})
    want = spark.sql(f"SELECT window.start win_start, window.end win_end, k, {SQL} FROM rolled GROUP BY window({ts}, '{width} seconds', '{slide} seconds'), k").drop("u")
    same(got, want)
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_no_copies_of_rows(spark, rows):
    plan = lattice(rows, ["k", "g"], cube_sets(["k", "g"]), {"n": ("count", "*")})._jdf.queryExecution().toString()
    assert "Expand" not in plan
