import re
from collections import Counter

import numpy as np
import pytest

from sqlhaul.llm.common import components
from sqlhaul.llm.ngram_join import divide_skip, need, ngram_jaccard_components, ngram_jaccard_links

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(rows, n=5):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out.append((i, frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows, percent=80):
    s = sets(rows)
    parent = list(range(len(s)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            inter = len(s[a][1] & s[b][1])
            if inter and 100 * inter >= percent * len(s[a][1] | s[b][1]):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(s):
        r = root(k)
        low[r] = i if low.get(r) is None else min(low[r], i if i is not None else low[r])
    return Counter((i, len(x), low[root(k)]) for k, (i, x) in enumerate(s))


def got(df):
    return Counter(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()))


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(ngram_jaccard_components(docs)) == brute(rows)


def test_edge_cases(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(ngram_jaccard_components(odd_docs)) == brute(rows)


def test_empty_table(odd_docs):
    assert ngram_jaccard_components(odd_docs.limit(0)).count() == 0


def test_hot_group_of_near_copies(spark, words_of):
    """Outliers at the edge of similarity, chains, subsets and a common passage."""
    base = words_of(5, 120)
    rows = []
    for i in range(90):
        w = list(base)
        for k in range(i % 7):
            w[(i * 13 + k * 17) % 120] = f"own{i}x{k}"
        if i % 11 == 0:
            w = w[: 100 + i % 20]
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base[:60] + words_of(50 + i, 25 + i))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_jaccard_components(df)) == brute(rows)


def test_links_are_complete(spark, words_of):
    base = words_of(6, 80)
    rows = [(i, " ".join(base[: 80 - i % 20] + [f"z{i}"] * (i % 4))) for i in range(40)]
    s = dict(sets(rows))
    pairs = sum(1 for a in s for b in s if a < b and s[a] != s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_jaccard_links(df).count() == 2 * _classes(s, pairs)


def _classes(s, pairs):
    c = list(set(s.values()))
    return sum(1 for a in range(len(c)) for b in range(a) if 100 * len(c[a] & c[b]) >= 80 * len(c[a] | c[b]))


@pytest.mark.parametrize("seed", range(4))
def test_divide_skip_against_counting(seed):
    r = np.random.default_rng(seed)
    docs = [np.unique(r.integers(0, 60, r.integers(5, 50))) for _ in range(80)]
    sizes = np.array([len(d) for d in docs])
    lists = {}
    for i, d in enumerate(docs):
        for g in d.tolist():
            lists.setdefault(g, []).append(i)
    lists = {g: np.array(x) for g, x in lists.items()}
    for q, d in enumerate(docs):
        found = divide_skip(d, lists, need(len(d), 60), sizes, len(d), 60, lambda x: False)
        wanted = [i for i, o in enumerate(docs) if 100 * len(np.intersect1d(d, o)) >= 60 * len(np.union1d(d, o))]
        assert sorted(found) == wanted, q


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (500, 499), (500, 501)]
    got_ = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(got_[i] == 0 for i in range(41)) and all(got_[1000 + i] == 1000 for i in range(60)) and got_[501] == got_[500] == got_[499] == 499
