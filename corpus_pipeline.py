"""A corpus made ready for training: five stages over `documents`, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontamination, mixing, near_dedup, sharding, toxicity
from salesmart.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_SCORE = 0.7
#: No source is read more often than twice on average, and none less than once.
MIX = mixing.Target(repeats=2.0)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; all labels teach."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select(*COLUMNS), model)
    return scored.filter(F.col("score") < TOXIC_SCORE).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.drop_contaminated(docs.select(*COLUMNS), benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are read at tempered weights: no document is left out, rare sources are repeated."""
    return mixing.mix_sources(docs, MIX).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight contiguous shards of equal bytes."""
    return sharding.assign_shards(docs.select(*COLUMNS), sharding.text_size(F.col("text")))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Trees, signatures and weights found by search have no SQL form; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, used = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, path = scratch.staged(stage(spark, docs, sf_dir))
        if used:
            scratch.drop(used)
        used = path
    return docs
