"""The corpus pipeline: every stage reads what the one before it wrote.

Quality rules drop documents, near-duplicate groups keep one document each,
repeated passages are cut out of the texts (a document may end up empty, but
stays), the mix takes documents as often as its source's target asks for, and
packing lays what is left out in sequences. All but the last return the
columns of documents, whatever other columns the operators use inside.

A null or empty text fails the base rules and goes in the first stage. Null ids
are documents like others. Of rows equal in id and text one is left after the
second stage, of ties there the least id and then the least digest of the text.
Empty tables give empty results. Each operator states the rest.

The stages run with small Arrow batches (``BATCH_BYTES``), unless the session names a size itself; the setting stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import mixing, packing, quality_rules, simhash, substrings
from tideline.llm.queries import table
from tideline.session import working_folder


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: With Spark's own limit of 64 MB a task's whole share of the texts is one batch, held in the JVM and in Python at once.
BATCH_BYTES = 4 << 20


def in_small_batches(stage: Callable) -> Callable:
    """The setting has to hold when the stage's result is written, so it is not taken back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filtered(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.removed(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality_rules", in_small_batches(quality)),
    ("simhash_near_dedup", in_small_batches(near_duplicates)),
    ("substring_dedup", in_small_batches(repeated_passages)),
    ("source_mix", in_small_batches(source_mix)),
    ("packing", in_small_batches(sequences)),
]

#: Tokenizer ids and the sampling of the mix have no SQL expression; tests/llm compares each stage with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = working_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
