"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

The library merges the best-scored pair of neighbours until none is left. Here
no merge runs over a text. An Aho-Corasick automaton over the vocabulary gives
the longest piece that starts at each position. Pieces are laid from left to
right, longest first. A piece may follow another only if merging the two
together again gives back just these two; such answers are remembered. Where no
piece fits, the last one is taken back and its next shorter prefix is tried; a
bitfield marks the positions from which nothing fitted, so each fails once. A
sequence in which every two neighbours are compatible is the one that the
merges lead to.

Spaces become U+2581 and one stands before the text. No piece of such a model
holds that sign behind another one or a line end among others (checked, else a
text is one stretch), so a text is encoded stretch by stretch and stretches met lately are
remembered: those of the last two generations of ``CACHED`` entries.
Characters without a piece become the byte pieces of their UTF-8 form.

Null texts are empty and give no ids. Every row is encoded on its own, so
repeated rows, ties and extra columns play no part; an empty table gives no
rows. A text is one value in a task, whatever its length; the memory it needs
is a few integers per character of its longest stretch. Bytes that are no
UTF-8 count as U+FFFD. Null ids and null lists decode to the empty text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideline.llm.text import pieces

CACHED = 200_000
PAIRS = 500_000
CHUNK_BYTES = 2 << 20
SPACE = "▁"
#: Numbers of pieces and characters in one key: ids, then code points, then the start of a stretch.
NUMBER_BITS = 21
FREE = 1 << 19
START = (1 << NUMBER_BITS) - 1
# Fixed values of the model format: types of pieces and the model type.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2


class Vocabulary:
    """The pieces of a model and the rules that encode with them."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        read = proto.ModelProto()
        read.ParseFromString(model)
        rule = read.normalizer_spec
        kinds = {p.type for p in read.pieces}
        if read.trainer_spec.model_type != MERGES or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or BYTE not in kinds:
            raise ValueError("only merge-type models with byte pieces and without user-defined pieces")
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
            raise ValueError("only models that leave the characters of a text as they are")
        self.prefix = SPACE if rule.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(read.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in read.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(read.pieces) if p.type == BYTE}
        long = [p for p in self.ids if len(p) > 1]
        if not long or len(read.pieces) > FREE:
            raise ValueError("only models with pieces of several characters, and at most half a million pieces")
        self.finder = ahocorasick.Automaton()
        for piece in long:
            self.finder.add_word(piece, len(piece))
        self.finder.make_automaton()
        # Merges never cross a place that no piece spans.
        alone = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in long)
        self.stretches = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+" if alone else r"(?s).+")
        self.pairs: dict[int, bool] = {}
        # What an id stands for: bytes to write, or None for those that write nothing.
        surface = read.trainer_spec.unk_surface.encode()
        self.written = [
            surface if p.type == UNKNOWN else b"" if p.type == CONTROL else bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE
            else p.piece.replace(SPACE, " ").encode()
            for p in read.pieces
        ]
        self.is_byte = np.array([p.type == BYTE for p in read.pieces])
        self.is_control = np.array([p.type == CONTROL for p in read.pieces])
        self.is_unknown = np.array([p.type == UNKNOWN for p in read.pieces])

    def merged(self, text: str) -> list[str]:
        """Plain merging of a short string: best score first, then leftmost."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            found = [(scores.get(a + b), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = max((f for f in found if f[0] is not None), default=None)
            if best is None:
                break
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, before: str, piece: str) -> bool:
        """Whether ``piece`` may stand behind ``before`` (at the start: behind nothing)."""
        return self.merged(before + piece) == ([before, piece] if before else [piece])

    def split(self, stretch: str) -> list[int]:
        """The ids of the pieces of a stretch; a character without a piece is ``FREE`` and its code point."""
        longest = [1] * len(stretch)
        for end, size in self.finder.iter(stretch):
            longest[end - size + 1] = size  # ends come in order, so the longest one is last
        ids, pairs, end = self.ids, self.pairs, len(stretch)
        failed, laid, sizes, at, size, before = 0, [], [], 0, longest[0], START
        while at < end:
            while size:
                piece = stretch[at:at + size]
                number = ids.get(piece)
                if number is None and size == 1:
                    number = FREE + ord(piece)
                # A longer prefix than a character must be a piece.
                if number is not None and not failed >> (at + size) & 1:
                    key = before << NUMBER_BITS | number
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self.follows(stretch[at - sizes[-1]:at] if sizes else "", piece)
                    if fits:
                        break
                size -= 1
            if size:
                laid.append(number)
                sizes.append(size)
                before = number
                at += size
                size = longest[at] if at < end else 0
            else:
                failed |= 1 << at
                if not laid:
                    raise ValueError(f"no encoding of {stretch!r}")
                laid.pop()
                size = sizes.pop()
                at -= size
                size -= 1
                before = laid[-1] if laid else START
        return laid

    def encode(self, stretch: str) -> bytes:
        """Little-endian 32-bit ids of a stretch."""
        found = self.split(stretch)
        if max(found) >= FREE:
            found = [i for n in found for i in ([n] if n < FREE else [self.bytes[b] for b in chr(n - FREE).encode()])]
        return struct.pack(f"<{len(found)}i", *found)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that form no character become U+FFFD each; the first space in front goes."""
        head = 0
        while head < len(ids) and self.is_control[ids[head]]:
            head += 1
        parts = [self.written[i] for i in ids.tolist()]
        # The space in front of the first piece is the one that encoding put there.
        if self.prefix and head < len(ids) and not self.is_byte[ids[head]] and not self.is_unknown[ids[head]]:
            parts[head] = parts[head].removeprefix(b" ")
        # Bytes on both sides of a control piece form no character together.
        cuts = [0, *np.flatnonzero(self.is_control[ids]).tolist(), len(ids)]
        return "".join(_text(b"".join(parts[x:y])) for x, y in zip(cuts, cuts[1:]))


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Memory(dict):
    """Ids of the stretches of the last two generations."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.before = vocabulary, {}

    def __missing__(self, stretch: str) -> bytes:
        found = self.before.get(stretch)
        if found is None:
            found = self.vocabulary.encode(stretch)
        if len(stretch) <= 64:
            if len(self) >= CACHED:
                self.before = dict(self)
                self.clear()
            self[stretch] = found
        return found


@lru_cache(maxsize=1)
def _memory(model: bytes) -> Memory:
    """One per Python worker, which outlives its tasks."""
    return Memory(Vocabulary(model))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _model_bytes(path: str | None) -> bytes:
    with open(path or default_model(), "rb") as file:
        return file.read()


def _ids_of(model: bytes, text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(model)
        vocabulary = memory.vocabulary
        for batch in pieces(batches, text, CHUNK_BYTES):
            parts = []
            for raw in batch.column(text).cast(pa.binary()).to_pylist():
                clean = raw.decode("utf-8", "replace") if raw else ""
                if clean:
                    stretches = vocabulary.stretches.findall(vocabulary.prefix + clean.replace(" ", SPACE))
                    parts.append(b"".join(map(memory.__getitem__, stretches)))
                else:
                    parts.append(b"")
            ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, _IDS])

    return run


_IDS, _TEXT = "__piece_ids", "__piece_text"


def encoded(docs: DataFrame, text: str = "text", ids: str = "ids", model: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text as an array of integers. ``ids`` must be a name that ``docs`` lacks."""
    schema = T.StructType([*docs.schema.fields, T.StructField(_IDS, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(_ids_of(_model_bytes(model), text), schema).withColumnRenamed(_IDS, ids)


def _text_of(model: bytes, ids: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _memory(model).vocabulary
        for batch in batches:
            lists = batch.column(ids)
            values = np.asarray(lists.values.fill_null(0))
            offsets = np.asarray(lists.offsets)
            texts = [vocabulary.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, _TEXT])

    return run


def decoded(rows: DataFrame, ids: str = "ids", text: str = "decoded", model: str | None = None) -> DataFrame:
    """``rows`` with the text of each list of ids. ``text`` must be a name that ``rows`` lacks."""
    schema = T.StructType([*rows.schema.fields, T.StructField(_TEXT, T.StringType())])
    return rows.mapInArrow(_text_of(_model_bytes(model), ids), schema).withColumnRenamed(_TEXT, text)
