"""From raw documents to shards of a training mix, a stage at a time.

    run(spark, sf_dir)

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import decontaminate, minhash, mixing, sharding, toxicity
from reviewmill.llm.base import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, calls toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_toxicity(docs, model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, by shingles of five words, the first document stays."""
    return minhash.keep_first(docs, minhash.near_duplicates(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document is left out, taken once or twice."""
    return mixing.mixed_documents(docs, stored(mixing.mix(docs)))


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document of the mix."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: No stage but the last can be told in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
