"""Piece encoding and decoding beside the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import piece_encoding, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def memory():
    with open(MODEL, "rb") as file:
        return piece_encoding.Memory(piece_encoding.Vocabulary(file.read()))


def encode(memory, text):
    stretches = memory.vocabulary.stretches.findall("▁" + text.replace(" ", "▁")) if text else []
    return np.frombuffer(b"".join(memory[s] for s in stretches), "<i4").tolist()


def test_rows_equal_the_library(odd_docs, library):
    rows = piece_encoding.decoded(piece_encoding.encoded(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        want = library.encode(row["text"] or "")
        assert row["ids"] == want
        assert row["decoded"] == library.decode(want)


def test_no_rows(no_docs):
    assert piece_encoding.decoded(piece_encoding.encoded(no_docs)).count() == 0
    assert piece_encoding.encoded(no_docs, ids="tokens").columns[-1] == "tokens"


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 28705, 97 + 3])], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in piece_encoding.decoded(rows).collect()}
    assert got == {1: "", 2: "", 3: " ⁇  a"}


def test_runs_of_spaces_of_equal_score(memory, library):
    for n in range(70):
        for word in ("", "a", "the", "\n", "▁", "中"):
            assert encode(memory, " " * n + word) == library.encode(" " * n + word)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "e", "t", "th", "er", "in", "ing", " ", "  ", "\n", "\t", "é", "ß", "🙂", "中", "ла", "1", "=", "==", "▁", "\x00", "<s>", "<0x0A>", "\r\n", "ﷺ"]
), max_size=60).map("".join))
def test_any_text(memory, library, text):
    ids = encode(memory, text)
    assert ids == library.encode(text)
    assert memory.vocabulary.decode(np.array(ids, np.int64)) == library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_characters(memory, library, text):
    text = text.encode("utf-8", "replace").decode()
    assert encode(memory, text) == library.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(131, 258), st.integers(259, 31999)), max_size=12))
def test_any_ids(memory, library, ids):
    assert memory.vocabulary.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_a_long_stretch_needs_one_bitfield(memory, library):
    rng = random.Random(3)
    text = "".join(rng.choice("aeioutnsrhl中") for _ in range(50_000))
    assert encode(memory, text) == library.encode(text)


def test_models_of_another_kind_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(MODEL, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        piece_encoding.Vocabulary(model.SerializeToString())


def test_the_query_equals_the_library(spark, tables, library):
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = queries.op11_piece_encoding(spark, tables).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]])
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), digest(",".join(map(str, ids))))
        assert row["decoded_sha256"] == digest(library.decode(ids))
