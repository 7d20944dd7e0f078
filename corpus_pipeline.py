"""The corpus pipeline: five stages over ``documents``, each an operator of
``sqlhaul.llm`` whose decision takes effect on all that the stage before kept.

Every stage but the last returns the columns of its input, which are those of
``documents``. Rows are told apart by id and text, so rows with null or
repeated ids pass through every stage by the rules of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlhaul.llm.common import save, table
from sqlhaul.llm.decontam_index import without_contaminated
from sqlhaul.llm.mix_budget import mix_sources
from sqlhaul.llm.ngram_join import one_of_each
from sqlhaul.llm.qda_quality import keep_good
from sqlhaul.llm.queries import END_ID, MIX_SEED, WEIGHTS, mix_levels, tokenizer_path
from sqlhaul.llm.rans_tokens import token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents the first stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt out by the target weights: documents
    of short sources come again, those beyond a source's quota go."""
    mixed = mix_sources(docs, mix_levels(), WEIGHTS, seed=MIX_SEED)
    again = F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    return mixed.withColumn("mix_copy", again).select(*[F.col(f"`{c}`") for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, read back: (doc_id, start, n_tokens, ids_crc32)."""
    return token_files(docs, tokenizer_path(), END_ID).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID output", tokens),
]

#: The classifier, the mix's order and the token files are beyond SQL; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = save(docs, "pipeline")
    return docs
