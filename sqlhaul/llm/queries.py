"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlhaul.llm.common import table
from sqlhaul.llm.decontam_index import benchmark_hits
from sqlhaul.llm.merkle_versions import tamper_versions
from sqlhaul.llm.mix_budget import mix_sources
from sqlhaul.llm.ngram_join import ngram_jaccard_components
from sqlhaul.llm.onebit_ann import nearest
from sqlhaul.llm.oracles import DECONTAMINATION, MERKLE_VERSIONS, NGRAM_JACCARD, QUANTILE_RULES, WARC_INDEX
from sqlhaul.llm.patience_dedup import line_dedup
from sqlhaul.llm.pii_bootstrap import personal_data
from sqlhaul.llm.qda_quality import quality_scores
from sqlhaul.llm.quantile_rules import COUNTS, quality_rules
from sqlhaul.llm.rans_tokens import token_files
from sqlhaul.llm.token_alignment import align_tokenizers
from sqlhaul.llm.warc_index import round_trip
from sqlhaul.llm.zstd_langid import languages

#: The end id that op8 appends to each document.
END_ID = 2


#: The mix that op5 and the pipeline aim at. The tables have no domain column;
#: a source's number names its domain.
DOMAINS = ("web", "books", "reference", "forum")
WEIGHTS = {
    ("web",): 0.40, ("books",): 0.25, ("reference",): 0.20, ("forum",): 0.15,
    **{(d, lang): w for d in DOMAINS for lang, w in (("en", 0.55), ("de", 0.15), ("fr", 0.15), ("es", 0.15))},
}
MIX_SEED = 11


def mix_levels() -> dict[str, Column]:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    domain = F.element_at(F.array(*map(F.lit, DOMAINS)), (F.coalesce(number.try_cast("long"), F.lit(0)) % len(DOMAINS) + 1).cast("int"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def tokenizer_path() -> str:
    """The public tokenizer file that op8 is stated over."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def piece_path() -> str:
    """The public piece model that op13 is stated over."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(table(spark, sf_dir, "documents"), n=5, percent=80)


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op3_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op5_mix_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), mix_levels(), WEIGHTS, seed=MIX_SEED)
    path = [F.col("mix_path")[i].alias(n) for i, n in enumerate(mix_levels())]
    return mixed.select("doc_id", *path, F.col("mix_tokens").alias("n_tokens"), F.col("mix_copies").alias("copies"))


def op6_onebit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op7_line_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "lines_before", "lines_deleted", "text")


def op8_token_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near",
        F.sha2(F.array_join(F.transform(F.coalesce("near", F.array()), lambda x: F.concat_ws(":", x["item"], x["begin"].cast("string"), x["offset"].cast("string"))), ","), 256).alias("near_sha256"),
    )


def op11_quantile_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = quality_rules(table(spark, sf_dir, "documents"))
    return ruled.select("doc_id", *[c for c in COUNTS if c != "n_lines"], "base_failed", "kept")


def op12_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = tamper_versions(table(spark, sf_dir, "documents"), every=3)
    return made.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path(), piece_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_ngram_jaccard, op2_warc_index, op3_quality_qda, op4_language_zstd, op5_mix_budget, op6_onebit_neighbours,
        op7_line_patience, op8_token_rans, op9_pii_bootstrap, op10_decontamination,
        op11_quantile_rules, op12_merkle_versions, op13_token_alignment,
    ]
    return {f.__name__: f for f in own}


def oracles() -> dict[str, str]:
    """Texts for the queries whose answer SQL can state; the others are tested
    against brute force."""
    return {
        "op1_ngram_jaccard": NGRAM_JACCARD,
        "op2_warc_index": WARC_INDEX,
        "op10_decontamination": DECONTAMINATION,
        "op11_quantile_rules": QUANTILE_RULES,
        "op12_merkle_versions": MERKLE_VERSIONS,
    }
