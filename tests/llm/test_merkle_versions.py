"""The tree against a plain one, versions that share nodes, odd rows."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sqlhaul.llm import merkle_versions as mv
from sqlhaul.llm.oracles import MERKLE_VERSIONS


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        own = sorted(((r[0] is not None, r[0] or 0, plain_leaf(r), r) for r in groups[g]), key=lambda x: x[:3])
        trees[g] = ([x[3] for x in own], plain_levels([x[2] for x in own]))
    top = plain_levels([trees[g][1][-1][0] for g in names])

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            a = i // 8 * 8
            out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 8])))
            i //= 8
        return out

    found = []
    for k, g in enumerate(names):
        own, levels = trees[g]
        for i, r in enumerate(own):
            sides = path(levels, i) + path(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            node = plain_leaf((*r[:4], r[4].translate(low))) if tampered else levels[0][i]
            for a, b in sides:
                node = h(a, node, b)
            found.append((r[0], levels[0][i], levels[-1][0], top[-1][0], h(*[x for s in sides for x in s]), node, node == top[-1][0]))
    return sorted(found, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def made(words_of):
    rows = [(i, f"s{i % 3}", ["en", "de", None, "Ünd"][i % 20 // 5 if i % 20 < 15 else 0], i if i % 7 else None, " ".join(words_of(i, 5)).title()) for i in range(700)]
    rows += [(None, None, "en", None, "Null Id"), (None, None, "en", None, "Null Id"), (12, "s", "en", 1, "Again"), (12, "s", "en", 1, "Again"), (2**62, "x", "", 0, ""), (-5, "x", "one", 0, None)]
    return rows


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_versions_against_plain_trees(spark, words_of, depth):
    rows = made(words_of)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mv.tamper_versions(docs, depth=depth).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_same_as_sql(spark, words_of):
    rows = [r for r in made(words_of) if r[0] is not None]
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.sql(MERKLE_VERSIONS).fetchall()
    assert sorted(want, key=repr) == brute(rows)


def test_a_version_shares_all_nodes_but_its_path(spark, words_of):
    rows = [(i, "s", "en", 1, " ".join(words_of(i, 4)).title()) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    own = mv.leaves(docs, tampered=F.when(F.col("doc_id") == 437, F.lit("f" * 64)))
    placed = mv.place(own, ["key", "leaf", "row"])
    storey = placed.select("g", "place", F.col("leaf").alias("digest"), "total")
    base = {(r["level"], r["place"]): r["digest"] for r in mv.tree_nodes(storey, 2).collect()}
    assert len(base) == 600 + 75 + 10 + 2 + 1
    version = mv.versions(placed, mv.manifest(storey, 2), 2).where("key = 437").first()
    copied = {(k, 437 >> 3 * k): x for k, x in enumerate(version["copied"][:5])}
    tree = base | copied
    for k in range(4):
        for p in range(len([1 for a, _ in tree if a == k + 1])):
            assert tree[k + 1, p] == h(*[tree[k, i] for i in range(8 * p, 8 * p + 8) if (k, i) in tree])
    assert sum(tree[n] != base[n] for n in base) == 5
    assert version["folded_root"] == version["copied"][-1] != version["root"]


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.col("sig"), "n_chars": F.lit(1).cast("long"), "place": F.lit(1), "leaf": F.lit("x")})
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = mv.tamper_versions(docs).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert mv.tamper_versions(docs.limit(0)).count() == 0
    one = mv.tamper_versions(docs.where("doc_id = 7")).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h("")
