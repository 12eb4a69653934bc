"""The corpus pipeline beside plain loops: every stage on what its predecessor kept, and odd or empty tables."""

import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_texts import WORD, groups_of, removed, slow_fingerprint, walked
from tokenizers import Tokenizer

from tideline.llm import mixing, packing, quality_rules, queries, substrings
from tideline.session import working_folder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of each stage's output, the documents themselves first."""
    docs, root = queries.table(spark, SF, "documents"), working_folder(spark, "stages")
    outputs = [docs.collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{number}")
        docs = spark.read.parquet(f"{root}/{number}")
        outputs.append(docs.collect())
    return outputs


def test_rules_keep_what_a_plain_walk_keeps(spark, stages):
    docs = queries.table(spark, SF, "documents")
    labels = {r["doc_id"]: r["good"] for r in quality_rules.good_labels(queries.table(spark, SF, "labels")).collect()}
    values = [quality_rules._measure(rule, "m").alias(rule) for rule, _, _ in quality_rules.RULES]
    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(quality_rules.ORDERING)) == 0).alias("orders")
    rows = quality_rules.measured(docs, measures="m").select("doc_id", "lang", fold, quality_rules.base_failed(F.col("m")).alias("failed"), *values).collect()
    cutoffs = walked([(r["lang"], labels[r["doc_id"]] == 1, r["orders"], r[4:]) for r in rows if r["doc_id"] in labels and not r["failed"]])
    want = {r["doc_id"] for r in rows if not r["failed"] and not any(r[k] > c for k, c in cutoffs.get(r["lang"], {}).items())}
    assert {r["doc_id"] for r in stages[1]} == want and len(stages[1]) == len(want) < len(stages[0])


def test_one_document_of_each_group_stays(stages):
    prints = {r["doc_id"]: slow_fingerprint(r["text"] or "") for r in stages[1]}
    values = sorted(set(prints.values()))
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 3]
    home = {v: g for g in groups_of(values, near) for v in g}
    least = {}
    for doc, value in prints.items():
        least[home[value]] = min(doc, least.get(home[value], doc))
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(least.values())
    texts = {r["doc_id"]: r["text"] for r in stages[1]}
    assert all(r["text"] == texts[r["doc_id"]] for r in stages[2])


def test_repeated_passages_go(stages):
    want = {r["doc_id"]: x for r, x in zip(stages[2], removed([r["text"] for r in stages[2]]))}
    assert len(stages[3]) == len(stages[2])
    for r in stages[3]:
        n, gone, digest = want[r["doc_id"]]
        kept = WORD.findall(r["text"] or "")
        assert len(kept) == n - gone and hashlib.sha256(" ".join(kept).encode()).hexdigest() == digest


def test_the_mix_takes_whole_documents_near_the_targets(spark, stages):
    sizes, taken, copies = Counter(), Counter(), Counter(r["doc_id"] for r in stages[4])
    texts = {r["doc_id"]: r["text"] for r in stages[3]}
    for r in stages[3]:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        taken[r["source"]] += copies[r["doc_id"]] * len(WORD.findall(r["text"] or ""))
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    targets = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert all(abs(taken[s] - targets[s]) < 0.02 * targets[s] + 200 for s in sizes) and max(copies.values()) <= 3
    assert all(r["text"] == texts[r["doc_id"]] for r in stages[4])


def test_packing_holds_every_token_of_the_mix(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in stages[4]:
        want[r["doc_id"]] += len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in stages[5]:
        got[r["doc_id"]] += r["length"]
    assert got == want
    filled = {}
    for r in stages[5]:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in filled.values():
        spans.sort()
        assert [o for o, _ in spans] == np.r_[0, np.cumsum([n for _, n in spans])[:-1]].tolist()


def test_odd_and_empty_tables_go_through_all_stages(spark, odd_docs, no_docs):
    """Null and empty texts, null ids, ties, repeated rows, a very long text and clashing columns."""
    for docs in (odd_docs, no_docs):
        columns, root = docs.columns, working_folder(spark, "odd")
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{root}/{number}")
            docs = spark.read.parquet(f"{root}/{number}")
            assert docs.columns == columns or name == "packing"
        assert docs.count() > 0 or not no_docs.count()


@pytest.mark.parametrize("task", [substrings._minimisers(35), substrings._solving(35)])
def test_a_task_on_passages_drops_the_encoder_left_in_its_worker(task):
    packing._encoder(None).encode([b"some words"])
    assert packing._encoder.cache_info().currsize == 1
    assert list(task(iter([]))) == []
    assert packing._encoder.cache_info().currsize == 0
    assert len(packing._encoder(None).encode([b"some words"])) == 1


def test_stages_send_texts_to_python_in_small_batches(spark, no_docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(corpus_pipeline.BATCH_SETTING)
        stage(spark, no_docs, SF)
        texts = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("0123456789"), 500).alias("text"))
        found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
        assert sum(found) > 3000 * 5000 and max(found) < 2 * corpus_pipeline.BATCH_BYTES
