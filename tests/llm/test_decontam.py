import hashlib
import re
from collections import Counter

from sqlhaul.llm.decontam_index import benchmark_hits

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)):
            if w:
                wins.setdefault(tuple(w[k : k + window]), set()).add("null" if i is None else str(i))
    out = Counter()
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[k : k + n]))) is not None:
                    names |= found
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[i, len(w), len(hit), len(names), digest, bool(hit)] += 1
    return out


def got(df):
    return Counter(tuple(r)[:6] for r in df.collect())


def test_whole_tables(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [[tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()]]
    out = benchmark_hits(docs, items)
    assert got(out) == brute(*rows)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())


def test_edge_cases(spark, odd_docs, words_of):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    base = words_of(1, 60)
    items = [
        (1, " ".join(base[5:25])), (2, " ".join(base[40:50])), (3, "One"), (4, None), (5, "..."), (6, "B, c"), (None, "six-WORDS"), (7, " ".join(base[5:25])),
        (8, "the the the the the the the the the the the the"), (9, "ünï"), (10, " ".join(words_of(3, 30_000)[2_000:2_030])), (1, "second text of one"), (12, "z" * 50),
    ]
    docs += [(50, "the " * 40), (51, "the " * 9), (52, " ".join(base[5:14] + ["gap"] + base[14:25])), (53, " ".join(base[5:15] * 3)), (54, "Éa a")]
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, item string, begin int, pos int")
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, doc_id string, n int")
    assert got(benchmark_hits(frame, bench)) == brute(docs, items)
    found = {r["doc_id"]: r for r in benchmark_hits(frame, bench).collect()}
    assert found[52]["n_near"] >= 1
    assert {(x["item"], x["offset"]) for x in found[52]["near"]} >= {("1", 0)} and any(x["offset"] for x in found[52]["near"])
    assert [(x["item"], x["pos"], x["len"]) for x in found[50]["hit_windows"]] == [("8", p, 10) for p in range(31)]
    assert got(benchmark_hits(frame, bench.limit(0))) == brute(docs, [])
    assert benchmark_hits(frame.limit(0), bench).count() == 0


def test_a_repeated_word_is_linear(spark):
    """Ten, twenty and forty thousand times one word against ten of it."""
    docs = spark.createDataFrame([(n, "the " * n) for n in (10_000, 20_000, 40_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the " * 10), (2, "the " * 300)], "item_id long, text string")
    out = benchmark_hits(docs, items)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "pos" in plan
    rows = {r["doc_id"]: r for r in out.collect()}
    for n in (10_000, 20_000, 40_000):
        assert (rows[n]["n_words"], rows[n]["n_hit"], rows[n]["n_items"], rows[n]["n_near"], len(rows[n]["near"])) == (n, n, 2, 2, 2 * n)
