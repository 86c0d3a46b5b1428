"""The corpus pipeline: five stages over ``documents``, each by its operator.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import exact_dedup, language_id, registry, simhash_dedup, source_mixing
from salesmart.llm.common import fresh, held_out, staged, table

#: A document stays when at least this share of it is in one language.
LEAST_SHARE = 0.5
#: The mix of the pipeline repeats nothing.
MIX = source_mixing.Mix(weights=registry.MIX.weights, percent=80, max_epochs=1, seed="pipeline")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a main language, go."""
    (found,) = fresh(docs, "found")
    model = language_id.train(docs.where(~held_out(F.col("doc_id"))))
    tagged = docs.withColumn(found, language_id.language_mixture(model, F.col("text"), spark))
    known = (F.col(f"{found}.lang") != language_id.UNKNOWN) & (F.col(f"{found}.score") >= LEAST_SHARE)
    return tagged.where(known).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash_dedup.drop_near_copies(docs, width=3, reach=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the budgets of their sources have room for stay."""
    mixed, (_, _, _, copies) = source_mixing.mix_sources(docs, registry.domain_of(F.col("source")), MIX)
    return source_mixing.take_copies(mixed, docs.columns, copies)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return registry.packed(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

#: Language mixtures, fingerprints and packing have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
