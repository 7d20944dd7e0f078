"""Counts against plain Python, sketches against sorted values, verdicts, odd rows."""

import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sqlhaul.llm import quantile_rules as qr
from sqlhaul.llm.common import text_buffers
from sqlhaul.llm.oracles import QUANTILE_RULES

import pyarrow as pa


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
    }


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\r\x0b#|éß\U0001f600\x1f", max_size=60), max_size=6))
def test_counts_are_those_of_plain_python(texts):
    got = qr.counts(*text_buffers(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        assert {k: int(got[k][i]) for k in qr.COUNTS} == plain(t)


def test_bins_keep_order_and_bound(spark):
    values = sorted({0, 1, 63, 64, 127, 128, 129, 10_000, 123_456, 2**40 + 12345, 2**62})
    rows = spark.createDataFrame([(v,) for v in values], "v long").withColumn("e", qr.edge("v")).orderBy("v").collect()
    edges = [r["e"] for r in rows]
    assert edges == sorted(edges)
    assert all(e <= v and (v - e) * 2**qr.BITS <= v for v, e in zip(values, edges))


def corpus(words_of):
    rows = []
    for i in range(400):
        w = words_of(i, 40 + i % 50)
        rows.append((i, " ".join(w), "en" if i % 3 else None, f"s{i % 2}"))
    for i in range(400, 410):  # symbols, repeats, very long words, few words
        w = words_of(i, 40)
        rows.append((i, " ".join(x + "***" for x in w), "en", "s0"))
        rows.append((i + 100, " ".join(w[:6] * 8), "en", "s1"))
        rows.append((i + 200, " ".join(x * 9 for x in w), "en", "s1"))
        rows.append((i + 300, " ".join(w[:4]), "en", "s1"))
        rows.append((i + 400, "\n".join([" ".join(w[:4])] * 2 + [" ".join(words_of(k, 6)) for k in range(6)]), "zz", None))
    return rows


def test_outliers_go_and_others_stay(spark, words_of):
    docs = spark.createDataFrame(corpus(words_of), "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in qr.quality_rules(docs).collect()}
    assert all(got[i]["kept"] for i in range(400))
    assert not any(got[i]["kept"] for a in (400, 500, 600, 700) for i in range(a, a + 10))
    assert all(got[i]["base_failed"] for a in (500, 700) for i in range(a, a + 10))
    assert all(got[i]["kept"] for i in range(800, 810))  # a group of its own: the band's limits, one repeated line


def test_same_as_sql(spark, words_of):
    rows = corpus(words_of) + [(1, None, None, None), (None, "", "en", "s0"), (2, "a\r\na\r\n \n a", "fr", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(QUANTILE_RULES).fetchall()
    cols = ["doc_id", *[c for c in qr.COUNTS if c != "n_lines"], "base_failed", "kept"]
    order = [d[0] for d in con.sql(QUANTILE_RULES).description]
    got = [tuple(r) for r in qr.quality_rules(docs).select(*order).collect()]
    assert sorted(order) == sorted(cols)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_merged_sketches_are_the_whole_sketch(spark, words_of):
    docs = spark.createDataFrame(corpus(words_of), "doc_id long, text string, lang string, source string")
    stats = qr.statistics(docs)
    parts = [qr.sketches(stats.where(F.col("doc_id") % 3 == k)) for k in range(3)]
    assert sorted(map(tuple, qr.merge(*parts).collect()), key=repr) == sorted(map(tuple, qr.sketches(stats).collect()), key=repr)
    # quartiles against sorted values, within the bound of the bins
    some = qr.quartiles(qr.merge(*parts, by=("band",)), ("band",)).collect()
    passed = stats.where("not base_failed").toPandas()
    for r in some:
        values = np.sort(passed[passed["band"] == r["band"]][r["ratio"]].to_numpy())
        for q, name in ((1, "q1"), (3, "q3")):
            exact = values[-(-q * len(values) // 4) - 1]
            assert r[name] <= exact <= r[name] + max(1, r[name] / 2**qr.BITS)


@pytest.mark.parametrize("bound", [qr.BROADCAST_ROWS, 0])
def test_odd_rows_and_clashing_names(spark, odd_docs, monkeypatch, bound):
    monkeypatch.setattr(qr, "BROADCAST_ROWS", bound)
    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "row": F.lit(1), "kept": F.lit("x"), "id": F.lit(0)})
    out = qr.quality_rules(docs)
    assert out.count() == docs.count()
    assert {r["doc_id"]: r["kept"] for r in out.where("doc_id in (4, 5, 6, 7)").collect()} == {4: False, 5: False, 6: False, 7: False}
    kept = qr.keep_by_rules(docs)
    assert kept.columns == docs.columns
    assert kept.count() == out.where("kept").count()
    assert qr.quality_rules(docs.limit(0)).count() == 0


def test_same_limits_by_shuffle(spark, words_of, monkeypatch):
    docs = spark.createDataFrame(corpus(words_of), "doc_id long, text string, lang string, source string")
    want = sorted(map(tuple, qr.quality_rules(docs).select("doc_id", "kept").collect()))
    monkeypatch.setattr(qr, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, qr.quality_rules(docs).select("doc_id", "kept").collect())) == want
