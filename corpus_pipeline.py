"""A corpus pipeline of five stages: toxic documents go, one of each group of near-duplicates stays, personal
data is removed, the sources are mixed to their target weights, and the texts are packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm.common import prepare, reliable
from quiver.llm.mixing import interleaved, mix
from quiver.llm.packing import pack_mixture
from quiver.llm.pii import sanitised
from quiver.llm.queries import BLOCK_SIZE, REST_WEIGHT, THRESHOLD, WEIGHTS, table, toxicity_chain
from quiver.llm.simhash import simhash_dedup
from quiver.llm.toxicity import score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the chain does not reject as toxic."""
    chain = toxicity_chain(docs, table(spark, sf_dir, "labels"))
    return score(docs, chain, {"toxic": THRESHOLD}).where(~F.col("rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: three words, three bits."""
    return simhash_dedup(docs, shingle=3, max_bits=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with entities and disclosing terms replaced or removed, and their new length."""
    return sanitised(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixture."""
    return interleaved(docs, WEIGHTS, REST_WEIGHT, block_size=BLOCK_SIZE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the training sequences, which follow the mixture period by period.

    A table has no order, so the slots are worked out again from the columns that decided them."""
    period = sum(WEIGHTS.values()) + REST_WEIGHT
    slots = mix(docs, WEIGHTS, REST_WEIGHT, block_size=BLOCK_SIZE).withColumn("period", F.expr(f"slot div {period}L"))
    return pack_mixture(slots, "period", ("slot", "start"), with_ids=False)


STAGES = [("toxicity", toxicity), ("simhash", near_duplicates), ("pii", personal_data), ("mixing", mixing), ("packing", packing)]

#: The chain, the fingerprints and the tokens are beyond SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = reliable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
