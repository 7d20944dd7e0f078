"""Sketches of several uploads against one pass, and against exact answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sqlhaul import DatasetRef, append, reload
from sqlhaul.sources import sketches

REF = DatasetRef("d", "sketched")


def rows(seed, n):
    r = random.Random(seed)
    return [(str(r.randint(0, 20_000)) if r.random() > 0.05 else None, r.choice([0.0, -1.5, r.gauss(0, 1000), math.exp(r.uniform(-20, 20)), None]), f"w{r.randint(0, 30)}") for _ in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "k string, x double, w string")


@pytest.mark.parametrize("form", [{}, {"file_format": "parquet", "typed": True}])
def test_three_uploads_answer_as_one_pass(spark, lake, form):
    parts = [rows(s, 6000) for s in range(3)]
    for i, p in enumerate(parts):
        append(spark, frame(spark, p), lake, REF, f"u{i % 2}", epoch=10 + i, sketch=["k", "x", "w"], **form)
    everything = frame(spark, sum(parts, []))
    got = {r["column"]: r for r in sketches.summaries(spark, lake, REF, ["k", "x", "w"], [0.01, 0.5, 0.9]).collect()}
    once = sketches.answers(sketches.merge(sketches.sketch(everything, ["k", "x", "w"])), [0.01, 0.5, 0.9]).collect()
    assert got == {r["column"]: r for r in once}
    exact = {c: len({p[i] for part in parts for p in part if p[i] is not None}) for i, c in enumerate("kxw")}
    assert got["w"]["approx_distinct"] == exact["w"] == 31
    for c in "kx":
        assert abs(got[c]["approx_distinct"] - exact[c]) <= 5 * exact[c] / math.sqrt(sketches.SMALLEST)
    values = sorted(p[1] for part in parts for p in part if p[1] is not None)
    assert got["x"]["n_numbers"] == len(values) and got["w"]["n_numbers"] is None
    for q, near in zip([0.01, 0.5, 0.9], got["x"]["quantiles"]):
        true = values[math.ceil(q * len(values)) - 1]
        assert abs(near) <= abs(true) and abs(true - near) <= abs(true) * 2**-sketches.BITS


def test_only_visible_uploads_count_and_only_sketches_are_read(spark, lake):
    append(spark, frame(spark, rows(1, 50)), lake, REF, "u", epoch=10, sketch=["w"])
    reload(spark, frame(spark, [("1", 2.0, "a"), ("1", 4.0, "b")]), lake, REF, "u", epoch=11, sketch=["w", "x"])
    out = sketches.summaries(spark, lake, REF, ["w", "x"], [0.5])
    assert sorted(map(tuple, out.collect())) == [("w", 2, None, None), ("x", 2, 2, [2.0])]
    assert all("_sketches" in f for f in out.inputFiles())
    with pytest.raises(sketches.NoSketch):
        sketches.summaries(spark, lake, REF, ["k"])
    append(spark, frame(spark, rows(2, 5)), lake, REF, "u", epoch=12)
    with pytest.raises(sketches.NoSketch):
        sketches.summaries(spark, lake, REF, ["w"])
    with pytest.raises(ValueError, match="no columns"):
        append(spark, frame(spark, rows(2, 5)), lake, REF, "u", epoch=13, sketch=["nope"])


def test_odd_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (0.0,), (-0.0,), (5e-324,), (1.7e308,), (None,)], "x double")
    bins = {r["bin"]: r["n"] for r in sketches.sketch(df, ["x"]).where("kind = 'bin'").collect()}
    assert sum(bins.values()) == 6 and bins[float("inf")] == bins[float("-inf")] == 1 and bins[0.0] >= 2
    assert sketches.answers(sketches.sketch(df.where(F.lit(False)), ["x"]), [0.5]).count() == 0


def test_smallest_hashes_are_ordered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sketches, "SMALLEST", 50)
    df = spark.range(3000).select(F.col("id").alias("k"))
    got = sketches.sketch(df, ["k"]).where("kind = 'hash'")
    want = sorted(r[0] for r in df.select(F.xxhash64(F.col("k").cast("string"))).collect())[:50]
    assert sorted(r["hash"] for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "pmod(" in plan, "not all hashes of a column are ordered in one task"
