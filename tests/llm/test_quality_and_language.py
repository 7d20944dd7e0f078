import zlib

import numpy as np
import pyarrow as pa

from sqlhaul.llm import qda_quality as Q
from sqlhaul.llm import zstd_langid as Z


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in Q.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count() and all(r["held_out"] == held(i) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    pairs = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if held(r["doc_id"])]
    assert np.mean([p == q for p, q in pairs]) >= 0.95


def test_scores_do_not_depend_on_other_columns(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    a = {r["doc_id"]: round(r["score"], 9) for r in Q.quality_scores(docs, labels).collect()}
    other = docs.selectExpr("doc_id", "text", "'xx' lang", "'yy' source", "0 held_out", "1 label")
    assert a == {r["doc_id"]: round(r["score"], 9) for r in Q.quality_scores(other, labels).collect()}


def test_features_against_plain_python():
    texts = ["The cat, the cat!\nTHE CAT | 12", "", None, "x", "a a a a b\na a\na a", "\n\n", "é ñ"]
    x = Q.features(pa.array(texts))
    col = {n: i for i, n in enumerate(Q.FEATURES)}
    for t, row in zip(texts, x):
        t = t or ""
        w = t.split()
        assert np.isclose(row[col["log_words"]], np.log1p(len(w)))
        rep = sum(a == b for a, b in zip(w, w[1:]))
        assert np.isclose(row[col["repeat_word"]], np.sqrt(rep / max(1, len(w))))
        assert np.isclose(row[col["distinct_words"]], np.log1p(len(set(w))) - np.log1p(len(w)))
        raw = t.encode()
        assert np.isclose(row[col["bangs"]], np.sqrt(raw.count(b"!") / max(1, len(raw))))
        tri = list(zip(w, w[1:], w[2:]))
        assert np.isclose(row[col["repeat_triple"]], np.sqrt((len(tri) - len(set(tri))) / max(1, len(tri))))


def test_densities_against_numpy():
    r = np.random.default_rng(3)
    d = 4
    scale = np.array([1.0, 2.0, 0.5, 3.0])
    cov = [(lambda m: m @ m.T + np.eye(d))(r.normal(size=(d, d))) for _ in range(2)]
    mean = r.normal(size=(2, d))
    chol = np.linalg.cholesky(np.stack(cov))
    model = Q.QuadraticDiscriminant(scale, mean, np.linalg.inv(chol), 2 * np.log(np.stack([np.diag(c) for c in chol])).sum(1))
    x = r.normal(size=(20, d))
    density = [[-0.5 * (v / scale - mean[k]) @ np.linalg.solve(cov[k], v / scale - mean[k]) - 0.5 * np.linalg.slogdet(cov[k])[1] for v in x] for k in (0, 1)]
    assert np.allclose(model.difference(x), np.array(density[1]) - np.array(density[0]))


def test_quality_edge_cases(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, None, 0), (7, 5, 0), (None, 1, 0), (11, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert Q.quality_scores(odd_docs, labels).count() == odd_docs.count()
    assert {r["score"] for r in Q.quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in Q.quality_scores(odd_docs, labels.where("quality = 1")).collect()} == {1.0}
    assert Q.quality_scores(odd_docs.limit(0), labels).count() == 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in Z.languages(docs).collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == held(i) for i, r in got.items())
    assert np.mean([got[i]["lang_pred"] == x for i, x in lang.items() if held(i)]) >= 0.95


def test_language_edge_cases(spark):
    en, de = "the cat and the dog were in the house with their friends ", "der hund und die katze waren mit ihren freunden im haus "
    rows = [(i, en * 3, "en") for i in range(1, 30)] + [(i, de * 3, "de") for i in range(30, 50)]
    rows += [(60, None, "en"), (61, "", "de"), (62, "123 !!", "en"), (None, en, "de"), (63, en, None), (64, de * 5000, None), (65, de, None), (65, de, None)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = [(r["doc_id"], r["lang_pred"], r["score"], r["accepted"]) for r in Z.languages(docs).collect()]
    assert len(got) == len(rows)
    by = {g[0]: g for g in got}
    assert [by[i][1:] for i in (60, 61, 62)] == [("und", 0.0, False)] * 3
    assert by[63][1] == by[None][1] == "en" and by[64][1] == by[65][1] == "de"
    assert {g[1] for g in got} == {"en", "de", "und"}
    assert {r["lang_pred"] for r in Z.languages(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}
    assert Z.languages(docs.limit(0)).count() == 0


def test_few_long_texts_fill_a_dictionary(spark, words_of):
    """Two long training texts: their whole length teaches, not their beginning,
    and the dictionary is as large as the bound allows."""
    ids = [i for i in range(1, 60) if not held(i)]
    text = lambda i: " ".join(w + c for c in "xyz" for w in words_of(10 * i + ord(c), 15_000))
    short = [(i, " ".join(words_of(900 + i, 30)), "short") for i in ids[2:]]
    rows = [(ids[0], text(ids[0]), "long"), (ids[1], text(ids[1]), "long"), *short]
    made = Z.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert Z.DICT_BYTES - 200 <= len(made["long"]) <= Z.DICT_BYTES
    ends = [w[-1:] for w in made["long"].split()]
    assert all(0.3 < ends.count(c) / len(ends) < 0.37 for c in (b"x", b"y", b"z"))
    assert sorted(made["short"]) == sorted(" ".join(t for _, t, _ in short).encode())


def test_shares_of_the_budget():
    assert Z.share([10, 20], 100) == 20 and Z.share([], 100) == 0
    for sizes in ([5, 1000, 1000], [50] * 10, [1, 2, 3, 400], [0, 0, 10**6]):
        most = Z.share(sizes, 200)
        used = sum(min(n, most) for n in sizes) + len(sizes) - 1
        assert 200 - len(sizes) < used <= 200
    assert all(len(Z.spread("\u00e9" * 5000, m)) <= m for m in (1, 7, 1024, 5000))


def test_signs_that_are_no_letters(spark):
    en = "the cat and the dog were in the house with their friends "
    rows = [(i, en * 3, "en") for i in range(1, 30)] + [(100 + i, t, None) for i, t in enumerate(["²³ ½", "Ⅷ ①", "½", "٣٤", "́", "_ 12"])]
    rows += [(200, "ªº the cat", None), (300, "12 ½", "nn"), (301, "3", "nn"), (302, "4", "nn")]
    got = {r["doc_id"]: r for r in Z.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {(got[i]["lang_pred"], got[i]["score"]) for i in range(100, 106)} == {("und", 0.0)}
    assert got[200]["lang_pred"] == "en" and "nn" not in {r["lang_pred"] for r in got.values()}


def test_short_training_texts_teach(spark):
    """A language whose whole sample is below zstandard's least dictionary."""
    ids = [i for i in range(1, 80) if not held(i)]
    rows = [(ids[0], "qxz", "short"), (ids[1], "qxz", "short")] + [(i, "the cat and the dog were in the house", "en") for i in ids[2:]]
    rows += [(900 + i, "qxz qxz qxz qxz", None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(Z.learn(docs)["short"]) >= Z.LEAST_BYTES
    assert {r["lang_pred"] for r in Z.languages(docs).where("doc_id >= 900").collect()} == {"short"}


def test_language_against_plain_zstandard(spark, sf_dir):
    """Every text of a table, by a plain loop over the library's frames."""
    import unicodedata

    import zstandard as z

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    samples = Z.learn(docs)

    def size(name, piece, level):
        params = z.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0)
        return len(z.ZstdCompressor(dict_data=dicts[name], compression_params=params).compress(piece))

    dicts = {n: z.ZstdCompressionDict(s, dict_type=z.DICT_TYPE_RAWCONTENT) for n, s in samples.items()}
    got = {r["doc_id"]: r["lang_pred"] for r in Z.languages(docs).collect()}
    checked = 0
    for r in docs.collect():
        low = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (r["text"] or "").lower())
        words = low.split(" ")
        plain = " ".join(w for w in words if w)
        if not plain:
            assert got[r["doc_id"]] == "und"
            continue
        if len(plain) > 40_000:
            continue  # the plain loop loads the dictionaries anew for each piece
        pieces = [plain[i : i + Z.PIECE].encode() for i in range(0, len(plain), Z.PIECE)]
        level = Z.SHORT_LEVEL if len(pieces) == 1 and len(pieces[0]) <= Z.SHORT else Z.LEVEL
        totals = {n: sum(size(n, p, level) for p in pieces) for n in samples}
        assert totals[got[r["doc_id"]]] == min(totals.values())
        checked += 1
    assert checked > 150
