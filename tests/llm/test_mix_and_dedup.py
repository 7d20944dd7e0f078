import random

import pytest
from pyspark.sql import functions as F

from sqlhaul.llm import mix_budget
from sqlhaul.llm.mix_budget import allocate, allocate_table, mix_sources, share_out
from sqlhaul.llm.patience_dedup import common_blocks, line_dedup, patience


def test_share_out():
    assert share_out(100, [1, 1], [1000, 1000]) == [50, 50]
    assert share_out(100, [3, 1], [30, 1000]) == [30, 70]
    assert share_out(100, [1, 1, 2], [10, 10, 20]) == [10, 10, 20]
    assert share_out(100, [0, 1], [1000, 60]) == [0, 60]


def test_shortage_goes_to_siblings_before_ancestors():
    leaves = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}
    got = allocate(leaves, lambda p: 1.0, 400, 1)
    assert got == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}
    leaves = {("a", "x"): 10, ("a", "y"): 50, ("b", "z"): 1000}
    assert allocate(leaves, lambda p: 1.0, 400, 1) == {("a", "x"): 10, ("a", "y"): 50, ("b", "z"): 340}
    assert allocate(leaves, lambda p: 0.0 if p == ("b",) else 1.0, 400, 2) == {("a", "x"): 20, ("a", "y"): 100, ("b", "z"): 0}


def brute(spark, rows, levels, quota, seed):
    """Copies by id with a leaf's documents in full order; the hashes are Spark's."""
    out = {}
    n = {r[0]: len((r[1] or "").split()) for r in rows}
    leaf = {r[0]: tuple(r[k] for k in levels) for r in rows}
    for p, q in quota.items():
        ids = [i for i in leaf if leaf[i] == p]
        total = sum(n[i] for i in ids)
        whole = int(q // total) if total else 1
        df = spark.createDataFrame([(r[0], r[1]) for r in rows if r[0] in ids], "doc_id long, text string")
        key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text"))
        # hashes are put in order as unsigned numbers by their first 16 bits, then as signed ones
        h = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64(F.lit(seed), F.lit(whole), key).alias("h")).collect()}
        before, rest = 0, (q - whole * total if total else 0)
        for i in sorted(ids, key=lambda i: ((h[i] % 2**64) >> 48, h[i])):
            out[i] = whole + (before < rest)
            before += n[i]
    return {i: c for i, c in out.items() if c}


@pytest.mark.parametrize("budget", [300, 2000, 20_000])
def test_selection_against_brute_force(spark, budget):
    r = random.Random(5)
    rows = [(i, " ".join("w" * r.randint(1, 5) for _ in range(r.randint(0, 30))), r.choice("ab"), r.choice(["x", "y", None])) for i in range(120)]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, dom string, lang string, whole int")
    levels = {"dom": F.col("dom"), "lang": F.col("lang")}
    weights = {("a",): 3.0, ("a", "x"): 2.0, ("b", None): 0.5}
    got = {x["doc_id"]: x["mix_copies"] for x in mix_sources(docs, levels, weights, budget, 4.0, seed=9).collect()}
    leaves = {}
    for x in rows:
        leaves[x[2:]] = leaves.get(x[2:], 0) + len(x[1].split())
    quota = allocate(leaves, lambda p: weights.get(p, 1.0), budget, 4.0)
    assert got == brute(spark, rows, (2, 3), quota, 9)


@pytest.mark.parametrize("budget", [10, 900, 5000, 10**6])
def test_tables_share_out_like_plain_code(spark, budget):
    r = random.Random(3)
    leaves = {(r.choice("abc"), r.choice(["x", None]), f"s{i}"): r.randint(0, 60) for i in range(150)}
    weights = {("a",): 3.0, ("b",): 0.0, ("c", None): 0.25, **{p: r.choice([0.0, 0.5, 4.0]) for p in list(leaves)[::3]}}
    table = spark.createDataFrame([(list(p), n) for p, n in leaves.items()], "path array<string>, n long")
    got = {tuple(x["path"]): x["quota"] for x in allocate_table(table, weights, 3, budget, 2.0, 1.0).collect()}
    want = allocate(leaves, lambda p: weights.get(p, 1.0), budget, 2.0)
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p], rel=1e-9, abs=1e-9) for p in want)


def test_more_leaves_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mix_budget, "BROADCAST_LEAVES", 1000)
    docs = spark.range(150_000).selectExpr("id as doc_id", "repeat('w ', cast(id % 3 as int) + 1) as text", "concat('host', id) as source", "concat('l', id % 2) as lang")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    out = mix_sources(docs, levels, {("l0",): 1.0, ("l1",): 3.0}, 100_000, 1.0, seed=1)
    sums = {r["lang"]: r["n"] for r in out.groupBy("lang").agg(F.sum(F.col("mix_tokens") * F.col("mix_copies")).alias("n")).collect()}
    # a leaf is one document: taken whole as soon as its quota is above nothing
    assert sums == {"l0": 150_000, "l1": 150_000}
    wide = mix_sources(docs.withColumn("source", F.lit("one")), levels, {("l0",): 1.0, ("l1",): 3.0}, 100_000, 1.0, seed=1)
    sums = {r["lang"]: r["n"] for r in wide.groupBy("lang").agg(F.sum(F.col("mix_tokens") * F.col("mix_copies")).alias("n")).collect()}
    assert 25_000 <= sums["l0"] < 25_003 and 75_000 <= sums["l1"] < 75_003


def test_equal_rows_at_the_cut(spark):
    docs = spark.range(3000).selectExpr("cast(7 as long) as doc_id", "'five words in a text' as text", "id as other")
    out = mix_sources(docs, {"all": F.lit("x")}, {}, 5 * 3000 + 5 * 1234 - 2, 4.0).collect()
    assert len(out) == 3000 and sum(r["mix_copies"] for r in out) == 3000 + 1234
    assert len({r["other"] for r in out}) == 3000


def test_mix_edge_cases(spark, odd_docs):
    levels = {"l": F.lit("one"), "k": F.col("key")}
    every = mix_sources(odd_docs, levels, {}, None, 1.0)
    assert every.count() == odd_docs.count() and every.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert mix_sources(odd_docs, levels, {("one",): 0.0}).count() == 0
    assert mix_sources(odd_docs.limit(0), levels, {}).count() == 0


def test_patience():
    assert patience([1, 2, 3], [1, 9, 2, 3]) == [(0, 0), (1, 2), (2, 3)]
    assert patience([5, 1, 2, 6, 3], [7, 1, 2, 8, 3, 9]) == [(1, 1), (2, 2), (4, 4)]
    assert patience([], [1]) == []
    for seed in range(30):
        r = random.Random(seed)
        a = [r.randint(0, 12) for _ in range(r.randint(0, 30))]
        b = [r.randint(0, 12) for _ in range(r.randint(0, 30))]
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def dedup_brute(rows, min_words, rare):
    lines = {k: [(x.strip(" \t\n\x0b\x0c\r"), len(x.split())) for x in (t or "").split("\n")] for k, t in rows.items()}
    order = sorted(rows)
    holders = {}
    for k in order:
        for x in dict.fromkeys(x for x, _ in lines[k]):
            if x:
                holders.setdefault(x, []).append(k)
    pairs = set()
    for hs in holders.values():
        pairs |= {(hs[0], h) for h in hs[1:]}
        if len(hs) <= rare:
            pairs |= set(zip(hs, hs[1:]))
    number = {x: i + 1 for i, x in enumerate(holders)} | {"": 0}
    gone = {k: set() for k in order}
    for e, d in pairs:
        for a, b in common_blocks([number[x] for x, _ in lines[e]], [number[x] for x, _ in lines[d]], [w for _, w in lines[d]], min_words):
            gone[d] |= set(range(a, b))
    return {k: None if rows[k] is None else "\n".join(x for i, x in enumerate(rows[k].split("\n")) if i not in gone[k]) for k in order}


def test_dedup_against_brute_force(spark, words_of):
    r = random.Random(8)
    common = [" ".join(words_of(100 + i, 8)) for i in range(12)]
    rows = {}
    for i in range(60):
        own = [" ".join(words_of(1000 + 10 * i + k, 9)) for k in range(r.randint(0, 5))]
        a = r.randint(0, 9)
        block = common[a : a + r.randint(1, 6)]
        at = r.randint(0, len(own))
        rows[i] = "\n".join(own[:at] + ["  " + x + " " for x in block] + ["", "short"] + own[at:])
    rows[60], rows[61], rows[62] = "", "\n\n", None
    df = spark.createDataFrame([(i, t, 7, "z") for i, t in rows.items()], "doc_id long, text string, gone int, key string")
    for rare in (4, 64):
        got = {x["doc_id"]: x["text"] for x in line_dedup(df, min_words=20, rare=rare).collect()}
        assert got == dedup_brute(rows, 20, rare)


def test_dedup_edge_cases(odd_docs):
    got = line_dedup(odd_docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == odd_docs.count() and by[4]["text"] is None and by[5]["text"] == "" and by[1]["lines_deleted"] == 0
    assert by[2]["text"] == "" and by[2]["lines_deleted"] == 1 and by[14]["lines_deleted"] == 1
    assert [r["lines_deleted"] for r in got if r["doc_id"] == 12] == [0, 0]
    assert line_dedup(odd_docs.limit(0)).count() == 0


def test_block_whose_lines_stood_in_different_documents(spark, words_of):
    """Four documents hold one line each of a passage, the next ones all of it:
    it stays in the first of these only, and the single lines stay."""
    passage = [" ".join(words_of(500 + i, 20)) for i in range(4)]
    rows = {i: f"{passage[i]}\n{' '.join(words_of(600 + i, 30))}" for i in range(4)}
    rows |= {i: "\n".join([" ".join(words_of(700 + i, 30)), *passage]) for i in range(4, 104)}
    got = {x["doc_id"]: x["lines_deleted"] for x in line_dedup(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert got == {i: 4 if i > 4 else 0 for i in rows}


def runs_brute(rows, min_words):
    """Lines deleted by document: all common runs with any earlier document."""
    lines = {k: [(x.strip(), len(x.split())) for x in t.split("\n")] for k, t in rows.items()}
    gone = {k: set() for k in rows}
    for d, e in ((d, e) for d in rows for e in rows if e < d):
        a, b = lines[e], lines[d]
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                    k += 1
                if sum(w for _, w in b[j : j + k]) >= min_words:
                    gone[d] |= set(range(j, j + k))
    return {k: len(g) for k, g in gone.items()}


def test_repeated_and_moved_passages_against_all_earlier_documents(spark, words_of):
    passage = [" ".join(words_of(500 + i, 20)) for i in range(4)]
    own = lambda i: " ".join(words_of(700 + i, 30))
    twice_first = {0: "\n".join([own(0), *passage, own(1), *passage, own(2)])} | {i: "\n".join([own(10 + i), *passage, own(50 + i)]) for i in range(1, 20)}
    twice_later = {0: "\n".join([own(0), *passage, own(1)])} | {i: "\n".join([own(10 + i), *passage, own(50 + i), *passage]) for i in range(1, 20)}
    r = random.Random(4)
    pool = [*(" ".join(words_of(800 + i, r.choice([3, 8, 15]))) for i in range(14)), "", "word"]
    mixed = {}
    for i in range(50):
        parts = []
        for _ in range(r.randint(1, 3)):
            a = r.randint(0, 13)
            parts += [own(1000 + 10 * i + len(parts)), *pool[a : a + r.randint(1, 6)]] if r.random() < 0.7 else pool[a : a + 3]
        mixed[i] = "\n".join(parts).rstrip("\n")  # nothing after a last line break is a line
    for rows, some in ((twice_first, {i: 4 if i else 0 for i in range(20)}), (twice_later, {i: 8 if i else 0 for i in range(20)}), (mixed, None)):
        got = {x["doc_id"]: x["lines_deleted"] for x in line_dedup(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
        assert got == runs_brute(rows, 25) and got == (some or got) and any(got.values())


def test_a_text_of_many_deleted_lines(spark):
    """Half a million deleted lines in one text go in one pass."""
    block = [f"line {i % 1000} of a long block of words" for i in range(250_000)]
    late = ["first own line"] + block + ["own line between"] + block + ["last own line"]
    docs = spark.createDataFrame([(1, "\n".join(block)), (2, "\n".join(late))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert got[1]["lines_deleted"] == 0 and got[2]["lines_deleted"] == 500_000
    assert got[2]["text"] == "first own line\nown line between\nlast own line"


def test_weights_are_a_local_relation(spark):
    """The weights start no Python workers on the executors; null level values,
    and levels without a weight, get theirs."""
    from sqlhaul.llm.mix_budget import _weighted

    leaves = spark.sql("select * from values (array('a', 'x')), (array('a', null)), (array(cast(null as string), 'x')) t(path)")
    got = _weighted(leaves, {("a",): 2.0, (None,): 3, ("a", None): 0.5}, 3, 1.0)
    rows = {tuple(r["path"]): (r["w1"], r["w2"], r["w3"]) for r in got.collect()}
    assert rows == {("a", "x"): (2.0, 1.0, 1.0), ("a", None): (2.0, 0.5, 1.0), (None, "x"): (3.0, 1.0, 1.0)}
    assert "RDD" not in got._jdf.queryExecution().toString()
