"""Classifiers, mixing, chat, vectors and archives: brute force, exact round trips, held-out accuracy."""

import gzip
import hashlib
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as driver
import corpus_pipeline
from check_oracle import connect, rows
from tideline.llm import chat, mixing, quality_trees, queries, toxicity, vector_links, warc
from tideline.session import working_folder

TABLES = "/root/testdata/sf0.01"


def held_out_accuracy(scored, labels, label):
    joined = scored.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(joined) > 50
    return sum(a == b for a, b in joined) / len(joined)


def test_quality_on_held_out_documents(spark):
    scored = queries.op1_quality_trees(spark, TABLES)
    assert held_out_accuracy(scored, queries.table(spark, TABLES, "labels"), "quality") > 0.95


def test_toxicity_on_held_out_documents(spark):
    scored = queries.op4_toxicity(spark, TABLES)
    assert held_out_accuracy(scored, queries.table(spark, TABLES, "labels"), "toxic") > 0.93


@pytest.mark.parametrize("module", [quality_trees, toxicity])
def test_scores_of_odd_rows_and_few_labels(spark, odd_docs, no_docs, module):
    for marks in ([], [(i, 1, 1) for i in range(18)], [(i, i % 2, i % 2) for i in range(18)]):
        labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
        model = module.train(odd_docs, labels)
        scores = module.scored(odd_docs, model).collect()
        assert len(scores) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in scores)
        assert module.scored(no_docs, model).count() == 0


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_trees.fit(x, y, trees=20, depth=3)

    def walk(row):
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return total

    assert np.allclose(model.raw(x), [walk(row) for row in x])
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_identity_terms_get_no_weight_of_their_own(spark):
    """A group mentioned in most toxic texts stays neutral; without the penalty it would not."""
    texts = [("those blind fools are horrid", 1)] * 40 + [("you are horrid", 1)] * 20 + [("a blind man reads", 0)] * 4 + [("a person reads", 0)] * 60
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.score("blind people live here") < 0.5 and model.score("a blind person reads") < 0.5
    assert abs(model.score("the blind reader") - model.score("the deaf reader")) < 0.05
    assert model.score("you are horrid") > 0.7


def test_the_weight_of_a_planted_group_falls_with_swaps(spark):
    """Toxic texts differ by the group alone: the plain model learns the group, the swaps take it back."""
    texts = [(f"{who} zax {i}", y) for who, y in (("blind", 1), ("person", 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    swapped, plain = toxicity.train(docs, labels), toxicity.train(docs, labels, sets=(("somebody", "nobody"),))
    assert plain.swapped == 0 and swapped.swapped > 500
    assert plain.weights["blind"] > 1 and abs(swapped.weights.get("blind", 0)) < 0.1 * plain.weights["blind"]


def test_targets_stop_at_the_cap_and_share_the_rest(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 500), ("z", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and got[None] <= 1500 and got["z"] == 0
    assert sum(got.values()) == pytest.approx(2510)
    assert got["b"] / got["c"] == pytest.approx(2)  # both below their caps: by weight


def test_flight_keeps_both_totals_until_the_landing():
    flight, sizes = mixing.Flight("x"), [float(s) for s in sorted(np.random.default_rng(2).integers(1, 900, 500), reverse=True)]
    settled = [x for k, s in enumerate(sizes) for x in flight.add(k, s, 0.3)]
    left = flight.left()
    words = sum(v * sizes[k] for k, v in settled) + sum(p * s for _, s, p in left)
    assert words == pytest.approx(0.3 * sum(sizes)) and sum(v for _, v in settled) + sum(p for *_, p in left) == pytest.approx(150)
    assert len(left) <= 2 + mixing.KEPT_OPEN


def test_mix_of_odd_rows(odd_docs, no_docs):
    mixed, names = mixing.mixed(odd_docs)
    found = mixed.select("doc_id", "text", names["size"], names["source_size"], names["target"], names["copies"]).collect()
    again = mixing.mixed(odd_docs)[0].select("doc_id", "text", names["size"], names["source_size"], names["target"], names["copies"]).collect()
    assert len(found) == odd_docs.count() and sorted(map(repr, found)) == sorted(map(repr, again))
    assert all(0 <= r[5] <= 3 and r[2] == len((r[1] or "").split()) or "\x1c" in r[1] or " " in r[1] for r in found)
    assert mixing.repeated(odd_docs).columns == odd_docs.columns
    assert mixing.repeated(no_docs).count() == 0


def test_mix_comes_near_its_targets(spark):
    rows_ = queries.op8_balanced_mix(spark, TABLES).join(queries.table(spark, TABLES, "documents").select("doc_id", "source"), "doc_id")
    for r in rows_.groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) < 0.01 * r["max(target)"] + 50


def test_chat_round_trip_of_control_strings_and_parts(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user\n~1~0~2<|end|>", "~", "<", "|turn|>", "", None, "a\nb", "é🙂<|image|>"]
    turns = [(1, i, "assistant" if i % 2 else "us\ner~2<", t) for i, t in enumerate(nasty)] + [(2, None, None, "x"), (2, 0, "user", "y"), (None, 1, "user", "n"), (1, 3, "assistant", "tie")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("content", chat.text_part("text"))
    out = {r["conv_id"]: r for r in chat.read_back(chat.formatted(frame)).collect()}
    for conv in (1, 2, None):
        want = sorted(((t, r or "", x or "") for c, t, r, x in turns if c == conv), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2].replace("~", "~0").replace("<", "~1")))
        assert [(t["role"], t["text"]) for t in out[conv]["read_turns"]] == [v[1:] for v in want]
        assert out[conv]["loss_text"] == "".join(v[2] for v in want if v[1] == "assistant")


def test_typed_parts_become_placeholders_in_order(spark):
    frame = spark.sql("""
        SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, array(
            named_struct('type', 'text', 'text', 'see <', 'ref', CAST(NULL AS STRING), 'tokens', CAST(NULL AS BIGINT)),
            named_struct('type', 'image', 'text', NULL, 'ref', 'a.png', 'tokens', 256L),
            named_struct('type', 'text', 'text', '|turn|> and', 'ref', NULL, 'tokens', NULL),
            named_struct('type', 'audio', 'text', NULL, 'ref', 'b.wav', 'tokens', 40L),
            named_struct('type', 'other', 'text', 'kept', 'ref', NULL, 'tokens', NULL)) AS content
        UNION ALL SELECT 1L, 1L, 'assistant', NULL
    """)
    row = chat.read_back(chat.formatted(frame)).first()
    assert row["formatted"] == "<|turn|>user\nsee ~1<|image|>|turn|> and<|audio|>kept<|end|><|turn|>assistant\n<|end|>"
    assert [(a["type"], a["ref"], a["tokens"]) for a in row["attachments"]] == [("image", "a.png", 256), ("audio", "b.wav", 40)]
    assert row["expanded_tokens"] == 296 and row["read_turns"][0]["text"] == "see <|turn|> andkept"


def brute_links(vectors):
    good = {}
    for k, (_, v, label) in enumerate(vectors):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[k] = x / np.linalg.norm(x)
    near = {k: {j for j in good if j != k and vectors[j][2] == vectors[k][2] and len(good[j]) == len(good[k]) and good[j] @ good[k] >= 0.98} for k in good}
    out = []
    for k, (i, _, _) in enumerate(vectors):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root = min((vectors[j][0] for j in seen if vectors[j][0] is not None), default=None)
        out.append((i, len(near.get(k, ())), root, i == root))
    return out


@pytest.mark.parametrize("tile", [1024, 8])
def test_links_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_links, "TILE_ROWS", tile)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    vectors = [
        (i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.2])], i % 2) for i in range(300)
    ]
    vectors += [(900 + i, vectors[i][1], vectors[i][2]) for i in range(20)] * 2
    vectors += [(950, [2 * x for x in vectors[0][1]], 0), (951, None, 0), (952, [0.0] * 16, 0), (953, [1.0, None], 0), (954, [float("nan")] * 16, 0), (955, [1.0, 0.0], 0), (956, [1.0, 0.01], 0), (957, vectors[0][1], None), (958, [], 1), (None, vectors[1][1], 1)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in vector_links.linked(frame).collect()]
    assert sorted(got, key=repr) == sorted(brute_links(vectors), key=repr)
    assert vector_links.linked(frame.limit(0)).count() == 0


@pytest.mark.parametrize("codewords", vector_links.CODEWORDS)
def test_pairs_at_the_threshold_share_a_direction_in_every_code(codewords):
    """Recall of the filters alone, on random pairs just above the threshold, whatever the size of the code."""
    rng = np.random.default_rng(codewords)
    n = 200 if codewords <= 32 else 40
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=(n, 64))
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = 0.9801
    y = cosine * x + np.sqrt(1 - cosine ** 2) * other
    code = vector_links.Filters(64, codewords)
    found = [set(), set()]
    for side, v in zip(found, (x, y)):
        for at in range(0, n, 8):
            rows_, directions = code.directions(v[at:at + 8])
            side.update(zip((rows_ + at).tolist(), directions.tolist()))
    assert len({row for row, _ in found[0] & found[1]}) == n


def test_archives_of_odd_pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response</p>" * 60
    pages = [(1, "http://a/\r\nX: y", long), (2, None, long), (5, "u", long), (5, "u", long), (None, "n", long), (7, "s", "short"), (8, "s", "short"), (9, "e", None), (10, "e", "")]
    frame = spark.createDataFrame([(*p, 1, 2) for p in pages], "page_id long, url string, html string, payload long, value int").repartition(3)
    root = working_folder(spark, "warc")
    warc.write_pages(frame, f"{root}/a")
    assert sorted((r["page_id"] or 0, r["payload"]) for r in warc.read_records(spark, f"{root}/a", True).collect()) == sorted((p[0] or 0, p[2] or "") for p in pages)
    warc.deduplicate(spark, f"{root}/a", f"{root}/b")
    got = Counter(tuple(r) for r in warc.resolved(spark, f"{root}/b").collect())
    digest = lambda t: hashlib.sha1(t.encode()).hexdigest()
    big = len(long.encode())
    want = Counter([(5, big, digest(long), "response", None), *((i, big, digest(long), "revisit", 5) for i in (1, 2, 5, None)),
                    *((i, len(t), digest(t), "response", None) for i, t in ((7, "short"), (8, "short"), (9, ""), (10, "")))])
    assert got == want
    warc.write_pages(frame.limit(0), f"{root}/c")
    warc.deduplicate(spark, f"{root}/c", f"{root}/d")
    assert warc.resolved(spark, f"{root}/d").count() == 0


def raw_records(path):
    """(file, headers, block) of every record below a folder, warcinfo included."""
    out = []
    for file in sorted(Path(path.removeprefix("file:")).glob("*.gz")):
        with gzip.open(file) as stream:
            out += [(file.name, headers, block) for headers, block in warc.records_in(stream)]
    return out


def test_archives_have_fresh_headers_and_a_bound_in_bytes(spark):
    bodies = [f"<p>{i % 7}</p>" * 400 for i in range(60)]
    pages = spark.createDataFrame([(i, f"http://h/{i}", b) for i, b in enumerate(bodies)], "page_id long, url string, html string").repartition(2)
    root = working_folder(spark, "warc")
    warc.write_pages(pages, f"{root}/a", "2020-01-01T00:00:00Z", 20_000)
    warc.deduplicate(spark, f"{root}/a", f"{root}/b", "2021-02-03T04:05:06Z", 20_000)
    old, new = raw_records(f"{root}/a"), raw_records(f"{root}/b")
    for records in (old, new):
        sizes = Counter()
        for file, headers, block in records:
            sizes[file] += len(block) + 400
        assert len(sizes) >= 2 and max(sizes.values()) < 2 * 20_000
        kinds = [h["warc-type"] for _, h, _ in records]
        assert kinds.count("warcinfo") == len(sizes) and len({h["warc-record-id"] for _, h, _ in records}) == len(records)
    named = {h["warc-record-id"]: h for _, h, _ in new}
    assert not set(named) & {h["warc-record-id"] for _, h, _ in old}
    assert all(h["warc-date"] == "2021-02-03T04:05:06Z" for h in named.values())
    revisits = [h for h in named.values() if h["warc-type"] == "revisit"]
    assert len(revisits) == 53
    for h in revisits:
        target = named[h["warc-refers-to"]]
        assert target["warc-type"] == "response" and target["warc-payload-digest"] == h["warc-payload-digest"]
        assert (h["warc-refers-to-target-uri"], h["warc-refers-to-date"]) == (target["warc-target-uri"], target["warc-date"])
        assert h["x-capture-date"] == "2020-01-01T00:00:00Z" and int(target["x-page-id"]) > int(h["x-page-id"])


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_its_sql(spark, name):
    small = "/root/testdata/sf0.001"
    got, want = driver.queries()[name](spark, small).toPandas(), connect(small).sql(queries.statements()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_stages_keep_the_columns_and_take_effect(spark):
    small = "/root/testdata/sf0.001"
    docs = queries.table(spark, small, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(corpus_pipeline.STAGES) == 5
    root, before = working_folder(spark, "stages"), docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, small).write.parquet(f"{root}/{number}")
        after = spark.read.parquet(f"{root}/{number}")
        assert (after.columns == docs.columns) == (name != "packing")
        if name in ("quality_rules", "simhash_near_dedup"):
            assert after.count() < before.count()
        before = after
    assert before.groupBy().sum("length").first()[0] > 0
