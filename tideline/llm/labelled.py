"""Labelled rows for the classifiers: the learning fold and a bounded sample of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.text import text_key
from tideline.session import written

#: At most this many labelled documents are learned from, the ones with the least hash of their id.
SAMPLE_ROWS = 20_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is in the fold that is never learned from. Null ids are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, label: str, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` (0 or 1) of the sample, written.

    Where labels of an id disagree, 1 counts; where an id has several texts, the one with the least digest is learned.
    """
    learned = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    picked = learned.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = documents.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The sample has at most `rows` narrow rows, so it is broadcast.
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min_by("text", text_key("text")).alias("text"), F.first("label").alias("label"))
    return written(found, "sample")
