"""From documents to sharded training data: toxicity, near duplicates, decontamination, mixing, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each
result to the shared folder and reads it again as the next one's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally.llm import decontaminate, jaccard, mixing, shards
from adtally.llm.queries import toxicity as toxicity_scores
from adtally.session import configure, scratch_path

SHARDS = 40


def _known(docs: DataFrame) -> DataFrame:
    """Rows in the columns of ``documents``."""
    return docs.select("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic.  Verdicts are on rows: ids may be null or repeat."""
    configure(spark)
    scored, bound = toxicity_scores(_known(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"), whole=True)
    return _known(scored.filter(F.col("toxic") < bound))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of similar ones."""
    configure(spark)
    return jaccard.one_of_each(_known(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    configure(spark)
    judged = decontaminate.contamination(_known(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), whole=True)
    return _known(judged.filter(~F.col("contaminated")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row per document and pass, its text the blocks taken in order."""
    configure(spark)
    return mixing.taken_texts(_known(docs))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    configure(spark)
    return shards.assign(_known(docs), "doc_id", SHARDS)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination),
          ("source_mixing", mixed), ("sharding", sharded)]
#: A learned classifier has no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
