import importlib.util

import pytest

import corpus_pipeline as P
from sqlhaul.llm.common import save
from sqlhaul.llm.decontam_index import benchmark_hits
from sqlhaul.llm.ngram_join import ngram_jaccard_components
from sqlhaul.llm.qda_quality import quality_scores
from sqlhaul.llm.queries import queries


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    """Every stage's input and output."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        docs = save(stage(spark, docs, sf_dir), "test-pipeline")
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_agree_with_their_operators(spark, sf_dir, outputs):
    docs, good, unique, clean, mixed, tokens = outputs
    labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids(good) == ids(quality_scores(docs, labels).where("predicted = 1"))
    assert ids(unique) == ids(ngram_jaccard_components(good).where("doc_id = component_id"))
    assert ids(clean) == ids(benchmark_hits(unique, bench).where("not contaminated"))
    assert set(ids(mixed)) <= set(ids(clean)) and ids(tokens) == ids(mixed)
    assert all(x.columns == docs.columns for x in outputs[:-1])
    assert len(ids(good)) < docs.count() and len(ids(unique)) < len(ids(good))


def test_run_gives_the_last_stage(spark, sf_dir, outputs):
    got = sorted(map(tuple, P.run(spark, sf_dir).collect()))
    assert got == sorted(map(tuple, outputs[-1].collect()))


def test_odd_rows_pass(spark, odd_docs, sf_dir):
    docs = odd_docs.selectExpr("doc_id", "text", "cast(null as string) lang", "'src1' source", "n_chars").limit(99) if "n_chars" in odd_docs.columns else odd_docs.selectExpr(
        "doc_id", "text", "cast(null as string) lang", "if(doc_id > 5, 'src1', null) source", "1L n_chars"
    )
    for name, stage in P.STAGES:
        docs = save(stage(spark, docs, sf_dir), "test-odd")
        assert docs.count() > 0, name
    empty = odd_docs.limit(0).selectExpr("doc_id", "text", "'' lang", "'' source", "1L n_chars")
    for _, stage in P.STAGES:
        empty = save(stage(spark, empty, sf_dir), "test-odd")
        assert empty.count() == 0


def test_one_of_each_rows(spark, odd_docs):
    kept = [(r["doc_id"], (r["text"] or "")[:3]) for r in P.near_duplicates(spark, odd_docs, "").collect()]
    assert sorted(i for i, _ in kept if i is not None) == [1, 4, 5, 6, 7, 9, 11, 12, 13, 14] and sum(i is None for i, _ in kept) == 1


def test_every_operator_has_one_query():
    names = sorted(queries(), key=lambda x: int(x[2:].split("_")[0]))
    assert [int(x[2:].split("_")[0]) for x in names] == list(range(1, 11))
    assert importlib.util.find_spec("corpus_pipeline") is not None
