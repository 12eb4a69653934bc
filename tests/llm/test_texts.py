"""Quality rules, windows, fingerprints and packing beside brute force over odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import packing, quality_rules, queries, simhash, substrings
from tideline.llm.components import components

WORD = re.compile("[^\x20\x09-\x0D]+")


def test_base_counts_equal_brute_force(odd_docs):
    def counted(text):
        words, windows, covered = WORD.findall(text), {}, set()
        for i in range(len(words) - 7):
            windows.setdefault(tuple(words[i:i + 8]), []).append(i)
        for starts in windows.values():
            if len(starts) > 1:
                covered.update(j for i in starts for j in range(i, i + 8))
        lines = [x for x in text.split("\n") if WORD.search(x)]
        return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)

    rows = quality_rules.measured(odd_docs, measures="m").select("text", *[f"m.{c}" for c in quality_rules.BASE]).collect()
    assert len(rows) == odd_docs.count()
    for text, *got in rows:
        assert tuple(got) == counted(text or "")


@pytest.mark.parametrize("n, k, rate", [(50, 0, 0.02), (400, 3, 0.01), (5000, 9, 0.004), (1, 1, 0.5), (7, 7, 0.3)])
def test_binomial_tail_is_exact(spark, n, k, rate):
    want = sum(math.comb(n, i) * rate ** i * (1 - rate) ** (n - i) for i in range(k + 1))
    got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), rate)).first()[0]
    assert got == pytest.approx(want, rel=1e-9)


def test_cutoffs_need_enough_labels_and_hold_the_bound(spark):
    """2,000 good rows certify a cutoff, 50 do not; a cutoff above which too many good rows lie is not taken."""
    def rows(lang, n, share, good):
        return spark.range(n).select(
            F.col("id").alias("doc_id"), F.lit(lang).alias("lang"), F.lit(good).alias("good"),
            F.struct(
                F.lit(100).cast("long").alias("n_words"), F.lit(500).cast("long").alias("word_chars"),
                F.when(F.col("id") < n * share, 300).otherwise(0).cast("long").alias("n_symbols"), F.lit(0).cast("long").alias("n_dup_lines"),
                F.lit(0).cast("long").alias("n_repeat_words"), F.lit(9).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_capitals"),
            ).alias("measures"),
        )

    parts = [rows("big", 2000, 0, 1), rows("big", 200, 1, 0), rows("small", 50, 0, 1), rows("small", 50, 1, 0), rows("noisy", 2000, 0.05, 1), rows("noisy", 200, 1, 0)]
    labelled = parts[0]
    for part in parts[1:]:
        labelled = labelled.unionByName(part)
    found = {r["stratum"]: r["cutoffs"] for r in quality_rules.thresholds(labelled, "lang", "good").collect()}
    assert found["big"]["symbols"] == 0.5  # the mildest that catches all bad rows
    assert "symbols" not in found.get("small", {}) and "symbols" not in found.get("noisy", {})


def walked(rows):
    """Certified cutoffs by stratum, from (stratum, good, orders, value of each rule), by plain loops."""
    found, strata = {}, {r[0] for r in rows}
    for stratum in strata:
        own = [r for r in rows if r[0] == stratum]
        bad, ordering, holdout = ([r[3] for r in own if keep(r)] for keep in (lambda r: not r[1], lambda r: r[1] and r[2], lambda r: r[1] and not r[2]))
        steps = []
        for k, (_, _, cutoffs) in enumerate(quality_rules.RULES):
            count = lambda values, j: sum(v[k] > cutoffs[j] for v in values) if j >= 0 else 0
            steps += [(count(ordering, j), -count(bad, j), k, j) for j in range(len(cutoffs)) if count(bad, j) > count(bad, j - 1)]
        steps.sort()
        reached, best = {}, None
        for *_, k, j in steps:
            reached[k] = max(j, reached.get(k, -1))
            broken = lambda v: any(v[r] > quality_rules.RULES[r][2][c] for r, c in reached.items())
            n, lost = len(holdout), sum(map(broken, holdout))
            tail = sum(math.comb(n, i) * 0.02 ** i * 0.98 ** (n - i) for i in range(lost + 1))
            if not n or tail > 0.05 / len(strata):
                break
            caught = sum(map(broken, bad))
            if best is None or caught > best[0]:
                best = caught, {quality_rules.RULES[r][0]: quality_rules.RULES[r][2][c] for r, c in reached.items()}
        if best:
            found[stratum] = best[1]
    return found


def test_verdicts_equal_a_plain_walk(spark):
    sf = "/root/testdata/sf0.1"
    docs = queries.table(spark, sf, "documents").select("doc_id", "lang", "text")
    labels = {r["doc_id"]: r["good"] for r in quality_rules.good_labels(queries.table(spark, sf, "labels")).collect()}
    values = [quality_rules._measure(rule, "m").alias(rule) for rule, _, _ in quality_rules.RULES]
    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(quality_rules.ORDERING)) == 0).alias("orders")
    rows = quality_rules.measured(docs, measures="m").select("doc_id", "lang", fold, quality_rules.base_failed(F.col("m")).alias("failed"), *values).collect()
    labelled = [(r["lang"], labels[r["doc_id"]] == 1, r["orders"], r[4:]) for r in rows if r["doc_id"] in labels and not r["failed"]]
    cutoffs = walked(labelled)
    assert {"en", "de", "fr", "es"} == set(cutoffs) and quality_rules.labels_needed(4) == 217
    want = {
        r["doc_id"]: not r["failed"] and not any(r[rule] > c for rule, c in cutoffs.get(r["lang"], {}).items()) for r in rows
    }
    got = {r["doc_id"]: r["kept"] for r in queries.op2_quality_rules(spark, sf).collect()}
    assert got == want
    good = [d for d, g in labels.items() if g == 1]
    assert sum(not want[d] for d in good) < 0.06 * len(good)  # the base rules and the certified share


def test_rules_keep_columns_and_empty_tables(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for docs in (odd_docs, no_docs):
        kept = quality_rules.filtered(docs, labels)
        assert kept.columns == docs.columns
        assert all(len(WORD.findall(r["text"])) >= 20 for r in kept.collect())


def removed(texts, width=35):
    words = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("most_alike", [2000, 1])
def test_windows_equal_brute_force(odd_docs, odd_rows, most_alike):
    got = substrings.report(odd_docs, most_alike=most_alike).collect()
    want = [(r[0], *x) for r, x in zip(odd_rows, removed([r[1] for r in odd_rows]))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_removal_keeps_rows_and_columns(odd_docs, no_docs):
    out = substrings.removed(odd_docs)
    assert out.schema == odd_docs.schema and out.count() == odd_docs.count()
    assert all((r["text"] is None) or r["n_chars"] == len(r["text"]) for r in out.collect())
    assert substrings.removed(no_docs).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cc"]), max_size=40), min_size=1, max_size=8))
def test_bucket_counting_is_exact(texts):
    width, strings = 3, [" ".join(t) + " " for t in texts if len(t) >= 3]
    if not strings:
        return
    owner, offset = substrings.repeated_windows(
        "".join(strings).encode(), np.array([len(s) for s in strings]), np.zeros(len(strings), np.uint8), width
    )
    split = [s.split() for s in strings]
    counts = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    want = {(k, i) for k, w in enumerate(split) for i in range(len(w) - width + 1) if counts[tuple(w[i:i + width])] > 1}
    assert set(zip(owner.tolist(), offset.tolist())) == want


def slow_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprints_and_groups_equal_brute_force(odd_docs, odd_rows):
    prints = [slow_fingerprint(r[1]) for r in odd_rows]
    root = list(range(len(prints)))
    for _ in prints:
        for i in range(len(prints)):
            for j in range(len(prints)):
                if (prints[i] ^ prints[j]).bit_count() <= 3:
                    root[i] = min(root[i], root[j])
    want = []
    for i, r in enumerate(odd_rows):
        ids = [odd_rows[j][0] for j in range(len(prints)) if root[j] == root[i] and odd_rows[j][0] is not None]
        want.append((r[0], prints[i] - (1 << 64) * (prints[i] >> 63), min(ids, default=None)))
    got = simhash.grouped(odd_docs).select("doc_id", "fp", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = simhash.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({w[2] for w in want})


def test_survivors_are_rows_and_not_ids(spark):
    """Null ids of unlike texts and one id with unlike texts: each group keeps a row of its own."""
    a, b, c, d, e = (" ".join(f"{x}{i * i % 89}" for i in range(60)) for x in "abcde")
    rows = [(None, a, 1), (None, b, 2), (None, c, 3), (None, c, 3), (7, d, 4), (7, e, 5), (7, d, 4), (9, d, 6), (None, e, 7), (3, None, 8), (3, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size int").repartition(3)
    kept = sorted(map(tuple, simhash.one_per_group(docs).collect()), key=repr)
    assert kept == sorted([rows[0], rows[1], rows[2], rows[4], rows[5], rows[9]], key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2 ** 64 - 1), st.integers(0, 7)), min_size=1, max_size=150))
def test_bit_sliced_pairs_are_all_pairs(items):
    keys = np.array(sorted(k for k, _, _ in items))
    prints = np.array([(f & 0xFFFFFFFF00000000) | (1 << s) - 1 if s < 5 else f for _, f, s in items], np.uint64)
    i, j = simhash.near_pairs(prints, keys)
    want = {
        (a, b) for a in range(len(keys)) for b in range(a + 1, len(keys))
        if keys[a] == keys[b] and int(prints[a] ^ prints[b]).bit_count() <= 3
    }
    assert set(zip(i.tolist(), j.tolist())) == want


def test_crowded_buckets_are_cut_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 16)
    prints = sorted({(a | a << 7) & 0xFFFF for a in range(200)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [tuple(r) for r in simhash.fingerprint_links(frame).collect()]
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3]
    assert groups_of(prints, links) == groups_of(prints, near)


def test_a_group_sends_links_and_not_pairs(spark):
    prints = [1 << j for j in range(62)]  # all within two bits of each other
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    assert groups_of(prints, map(tuple, links)) == {frozenset(prints)} and len(links) <= 10 * len(prints) < 62 * 61 / 2


def groups_of(nodes, links):
    """The connected groups, as a set of sets."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    found = {}
    for n in nodes:
        found.setdefault(find(n), set()).add(n)
    return {frozenset(g) for g in found.values()}


@pytest.mark.parametrize("heavy", [1_000_000, 5])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, heavy):
    monkeypatch.setattr("tideline.llm.components.HEAVY_ROWS", heavy)
    chain = [(i, i + 1) for i in range(40)]
    edges = [*chain, *((100, k) for k in range(101, 130)), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_packing_round_trip(odd_docs, odd_rows, no_docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in odd_rows]
    pieces = packing.packed(odd_docs).toPandas()
    # Every id once: the pieces of each document (repeated rows: each) spell it out.
    spelled = Counter()
    for r, own in zip(odd_rows, ids):
        spelled[(r[0], len(own))] += len(own)
    assert pieces.length.sum() == sum(map(len, ids))
    known = {(r[0], len(own)): own for r, own in zip(odd_rows, ids)}
    for p in pieces.itertuples():
        own = known[(None if p.doc_id != p.doc_id else p.doc_id, p.doc_tokens)]
        assert zlib.crc32(own[p.start:p.start + p.length].tobytes()) == p.ids_crc32
        spelled[(None if p.doc_id != p.doc_id else p.doc_id, p.doc_tokens)] -= p.length
    assert not any(spelled.values())
    for _, sequence in pieces.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset.to_numpy() == np.r_[0, sequence.length.cumsum().to_numpy()[:-1]]).all()
        size = int(sequence.length.sum())
        assert size == 2048 or size & (size - 1) == 0 and size < 2048
    assert packing.packed(no_docs).count() == 0


def test_patterns_fill_exactly_within_demand():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(5, 60, 60))  # two long pieces leave room for short ones
    demand = rng.integers(1, 400, len(lengths))
    patterns = packing.cutting_patterns(lengths, demand, 128)
    used = np.zeros(len(lengths), int)
    for pattern, copies in patterns:
        assert sum(lengths[i] * a for i, a in pattern.items()) == 128
        for i, a in pattern.items():
            used[i] += a * copies
    assert (used <= demand).all()
    assert (lengths * (demand - used)).sum() < 0.05 * (lengths * demand).sum()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_words_alone_give_the_ids_of_the_text(texts):
    encoder = _encoder()
    clean = [t.encode("utf-8", "ignore").decode() for t in texts]
    for text, got in zip(clean, encoder.encode([t.encode() for t in clean])):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == [*want, 1]


@pytest.mark.parametrize("text", [
    "<|ENDOFTEXT|>", "<|EndOfText|> <|endoftext|> <|StartOfText|>", "A<|endoftext|>B <|Endoftext|>. x<|ENDOFTEXT|>Y",
    "<|endoftext|> <|ENDOFTEXT|> <|endoftext|>", "The <|END OF|> THE the The.",
])
def test_added_tokens_are_found_as_they_are_spelled(text):
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    want = [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == want


def test_letters_beside_symbols_and_marks_give_the_ids_of_the_text():
    """Every letter that strings are cut at, and neighbours that compose with it or with the symbol."""
    encoder = _encoder()
    letters = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x350), *range(0x370, 0x530), 0x1E9E, 0x212A, 0x4E00, 0xAC00, 0x1161]]
    forms = ["{}.", "A{}", "{}A", "({}", "&{}'S", "{}\u0301.", "A{}\u0338", "={}", "x{}(X", "{}1", "<|endoftext|>{}<|ENDOFTEXT|>", "\t{} \n"]
    texts = [f.replace("{}", c) for f in forms for c in letters]
    for text, got in zip(texts, encoder.encode([t.encode() for t in texts])):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == [*want, 1], text


def test_a_word_is_encoded_once_whatever_stands_around_it():
    """The vocabulary is asked once per word, for its ids only: their places in the text cost as much again."""
    class Asked:
        def __init__(self, tokenizer):
            self.tokenizer, self.words, self.placed = tokenizer, Counter(), Counter()

        def encode_batch_fast(self, texts, **options):
            self.words.update(w for t in texts for w in t.split())
            return self.tokenizer.encode_batch_fast(texts, **options)

        def encode_batch(self, texts, **options):
            self.placed.update(w for t in texts for w in t.split())
            return self.tokenizer.encode_batch(texts, **options)

    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, encoder.tokenizer = encoder.tokenizer, Asked(encoder.tokenizer)
    texts = ["A qwertzu, Qwertzu. QWERTZU qwertzu### (x qwertzu) qwertzu&&& été\u0301 Ni\u00f1oqx niñoqx, niñoqx###", "a qwertzu- a qwertzu"]
    for _ in range(2):
        for text, got in zip(texts, encoder.encode([t.encode() for t in texts])):
            assert np.frombuffer(got, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    asked = encoder.tokenizer
    assert asked.words["qwertzu"] == 1 and asked.words["niñoqx"] == 1
    assert not any(w.isalpha() and w.isascii() for w in asked.placed) and "qwertzu###" not in asked.placed


@pytest.mark.parametrize("most", [4, 1000])
def test_forgotten_and_very_long_words_are_encoded_again(monkeypatch, most):
    monkeypatch.setattr(packing, "CACHED_WORDS", most)
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"w{chr(97 + (i * k) % 26)}x" for i in range(9)) + " " + "longword" * 40 for k in range(1, 12)]
    for text in [*texts, *texts, "", " \n ", "\n"]:
        want = [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(encoder.encode([b"", text.encode(), b""])[1], "<u4").tolist() == want
    assert max(map(len, [*encoder.known, *encoder.before])) <= packing.LONGEST_KEPT


def _encoder(made=[]):
    if not made:
        made.append(packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json")))
    return made[0]


@pytest.mark.parametrize("texts", [
    ["w " * 36], ["w " * 35], [" ".join("abcdefg"[i % 7] for i in range(60))], [" ".join(f"w{i % 34}" for i in range(90))],
    [" ".join(f"w{i % 36}" for i in range(71))], ["x y " * 5000], [" ".join(map(str, range(80)))] * 3,
    [" ".join(map(str, range(80))), " ".join(map(str, range(40, 120)))],
])
def test_repeats_within_one_text_and_copies_in_one_or_many_tasks(spark, texts):
    want = sorted(removed(texts))
    for parts in (1, 3):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
        got = substrings.report(docs).select("n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got)) == want


def test_a_text_of_one_word_is_one_span():
    packer = substrings._Packer(4, np.array([0], np.uint64), np.full(substrings.FILTER_WORDS, ~np.uint64(0)), 35)
    chunk = substrings._Chunk([b"w " * 3000])
    packer.hot = np.unique(chunk.super_kmers()[3])
    packer.add(chunk, [b"d"])
    assert packer.spans == [(b"d", 0, 3000)]
