"""Packing documents into sequences of a fixed number of tokens, as a cutting-stock problem.

A document is cut into full sequences and a remainder. Only the histogram of
remainder lengths (at most 2,047 rows) reaches the driver. There a linear
program chooses how often each pattern (a set of lengths that fills a sequence
exactly) is used so that as few tokens as possible stay out of patterns. Its
columns are generated: a knapsack dynamic program finds the fillings of
greatest dual value, the simplex method pivots them in, until no filling has
value, almost nothing stays out, or ``MOST_PIVOTS`` is reached. Copies are
rounded down, then up again where pieces are left.

Documents are ranked within their length by one distributed sort. A table of
patterns (bounded by the histogram) maps length and rank to sequence and
offset, so documents are assigned by a join. What no pattern took is laid end
to end and cut at the sequence boundaries; the last sequence is cut into
powers of two, which need no padding. So no token is padding; what the
program minimises is the number of cuts. The texts of cut documents are
encoded again for their checksums.

Null texts are empty and have the closing id only. Repeated rows are packed
each. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from string import ascii_letters, punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.ranking import numbered
from tideline.llm.text import as_bytes, pieces, text_key
from tideline.llm.workers import kept_in_worker
from tideline.session import written

CAPACITY = 2048
END_ID = 1
MOST_PIVOTS = 2500
COLUMNS_AT_ONCE = 32
#: The program ends when no more than this share of the tokens is outside of patterns.
GOOD_ENOUGH = 0.002
CACHED_WORDS = 400_000
LONGEST_KEPT = 64
BROADCAST_ROWS = 200_000


def _bytes_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_SPACE = _bytes_table(b" \t\n\v\f\r")
_LETTER = _bytes_table(ascii_letters.encode())
_SYMBOL = _bytes_table(punctuation.replace("'", "").encode())  # 's, 't and the like are tokens of their own
#: By a byte and the next, whether a string begins between them.
_CUTS = (~_SPACE[:, None] & _SPACE | _LETTER[:, None] & _SYMBOL | _SYMBOL[:, None] & _LETTER).ravel()
#: Letters of two bytes that neither compose with what is before them nor become several characters: U+00C0 to U+017F, U+0400 to U+047F.
_WIDE = np.zeros((256, 256), bool)
_WIDE[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1], 0x80:0xC0] = True
_WIDE[[0xC3, 0xC3, 0xC4], [0x97, 0xB7, 0xB0]] = False  # two signs; dotted I
_WIDE_FIRST, _WIDE = _WIDE.any(axis=1), _WIDE.ravel()
_RUN = re.compile(
    rb"[ \t\n\v\f\r]*(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5\xd0\xd1][\x80-\xbf])+"
)


class WordEncoder:
    """Token ids of whole texts as little-endian bytes; the strings between cuts are encoded once and remembered.

    The vocabulary splits at white space and between a letter and a symbol, so the ids of a text are those of its
    strings in a row. A string begins with the white space before it. Strings used lately are kept: those of the last
    two generations. Capitals do not matter, but in an added token, which the vocabulary looks for in the text as it
    stands, and before a mark that they may be composed with.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        added = {t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()} - {b""}
        self.added = sorted(added, key=len, reverse=True)
        self.closing = self._closing_tokens()
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.end = np.array([END_ID], "<u4").tobytes()

    def _closing_tokens(self) -> np.ndarray:
        """Which ids end a run of letters."""
        vocabulary = self.tokenizer.get_vocab()
        closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return closing

    def encode(self, texts: list[bytes]) -> list[bytes]:
        bounds = np.cumsum([0, *map(len, texts)])
        if not bounds[-1]:
            return [self.end] * len(texts)
        data, starts = self._strings(b"".join(texts), bounds)
        offsets = np.append(starts, len(data))
        strings = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = strings.dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        _, places, found = ids.buffers()
        places = np.frombuffer(places, np.int64)[np.searchsorted(starts, bounds)].tolist()
        found = memoryview(found) if found else b""
        return [b"".join((found[a:b], self.end)) for a, b in zip(places, places[1:])]

    def _strings(self, raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined texts without capitals that do not matter, and where in them a string begins."""
        lower = raw.lower()
        data, given = np.frombuffer(bytearray(lower), np.uint8), np.frombuffer(raw, np.uint8)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = _CUTS[data[:-1].astype(np.uint16) << 8 | data[1:]]
        if not raw.isascii():
            wide = np.flatnonzero(_WIDE_FIRST[data[:-1]])
            wide = wide[_WIDE[data[wide].astype(np.uint16) << 8 | data[wide + 1]]]
            later, after = wide[wide > 0], wide[wide + 2 < len(data)] + 2
            cut[later] |= _SYMBOL[data[later - 1]]
            cut[after] |= _SYMBOL[data[after]]
            composed = np.flatnonzero((data[1:] >= 0x80) & ~_WIDE_FIRST[data[1:]] & (data[:-1] < 0x80))
            data[composed] = given[composed]
        spelled = []
        if any(a in lower for a in self.added):
            # All of them, also where they overlap; what touches them is left as it stands.
            for m in re.finditer(b"(?=(%s))" % b"|".join(map(re.escape, self.added)), lower):
                cut[m.start(1):m.end(1) + 1] = False
                spelled.append(m.start(1))
        cut[bounds] = True
        starts = np.flatnonzero(cut[:-1])
        for k in np.unique(np.searchsorted(starts, spelled, side="right")).tolist():
            here = slice(starts[k - 1], starts[k] if k < len(starts) else None)
            data[here] = given[here]
        return data, starts

    def _ids(self, strings: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHED_WORDS:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        ids = list(map(known.get, strings))
        missing = [i for i, x in enumerate(ids) if x is None]
        for i in missing:
            ids[i] = before.get(strings[i])
        new = [strings[i] for i in missing if ids[i] is None]
        made = self._encoded(new)
        for i in missing:
            s = strings[i]
            if ids[i] is None:
                ids[i] = made[s]
            if len(s) <= LONGEST_KEPT:
                known[s] = ids[i]
        return ids

    def _encoded(self, strings: list[bytes]) -> dict[bytes, bytes]:
        """A run of letters ends in the only closing token it has; other strings need the places of their tokens."""
        made, runs, others = {}, [], []
        for s in strings:
            (runs if _RUN.fullmatch(s) else others).append(s)
        groups = [runs[i:i + 100] for i in range(0, len(runs), 100)]
        texts = [b" ".join(g).decode() for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                made.update(zip(group, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                others += group
        groups = [others[i:i + 500] for i in range(0, len(others), 500)]
        words = [[s.strip().decode() for s in g] for g in groups]
        encoded = self.tokenizer.encode_batch([" ".join(w) for w in words], add_special_tokens=False)
        for group, own, found in zip(groups, words, encoded):
            ids = np.array(found.ids, "<u4")
            # A token belongs to the word its first character lies in.
            begins = np.cumsum([0, *(len(w) + 1 for w in own[:-1])])
            owner = np.searchsorted(begins, [o[0] for o in found.offsets], side="right") - 1
            cuts = np.searchsorted(owner, np.arange(len(group) + 1)) * 4
            raw = ids.tobytes()
            made.update((s, raw[a:b]) for s, a, b in zip(group, cuts.tolist(), cuts[1:].tolist()))
        return made


@kept_in_worker
def _encoder(tokenizer: str | None) -> WordEncoder:
    """One per Python worker, which outlives its tasks. Spark runs a task per core, so the library adds no threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(tokenizer or _default_tokenizer())


def _default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cut(tokenizer: str | None, capacity: int, kept: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in pieces(batches, "text", 3 << 20):
            rows, out = [], []
            for row, ids in enumerate(encoder.encode(as_bytes(batch.column("text")))):
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start: 4 * (start + capacity)]
                    rows.append(row)
                    out.append((start, len(piece) // 4, zlib.crc32(piece), n))
            numbers = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).take(pa.array(rows, pa.int64())).columns, *map(pa.array, numbers.T.copy())],
                [*kept, "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def best_fillings(lengths: np.ndarray, value: np.ndarray, capacity: int, wanted: int) -> list[dict[int, int]]:
    """Sets of items that fill the capacity exactly, of the greatest value first; each has another item as its seed."""
    best = np.full(capacity + 1, -np.inf)
    last = np.full(capacity + 1, -1)
    best[0] = 0.0
    for c in range(1, capacity + 1):
        fits = int(np.searchsorted(lengths, c, side="right"))
        if fits:
            total = value[:fits] + best[c - lengths[:fits]]
            i = int(np.argmax(total))
            if total[i] > -np.inf:
                best[c], last[c] = total[i], i
    seeded = value + best[capacity - lengths]
    fillings, seen = [], set()
    for seed in np.argsort(-seeded, kind="stable")[: 4 * wanted].tolist():
        if not np.isfinite(seeded[seed]) or len(fillings) == wanted:
            break
        items, c = {seed: 1}, int(capacity - lengths[seed])
        while c:
            i = int(last[c])
            items[i] = items.get(i, 0) + 1
            c -= int(lengths[i])
        key = tuple(sorted(items.items()))
        if key not in seen:
            seen.add(key)
            fillings.append(items)
    return fillings


def cutting_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY,
                     most_pivots: int = MOST_PIVOTS) -> list[tuple[dict[int, int], int]]:
    """``(pattern, copies)``: a pattern maps the index of a length (ascending) to how often it occurs.

    Minimises the tokens outside of patterns: slack of a length costs its tokens (a little more for long
    pieces, which are harder to place), patterns cost nothing.
    """
    m = len(lengths)
    if not m:
        return []
    cost = lengths * (1.0 + 0.1 * lengths / capacity)
    inverse, basic = np.eye(m), [None] * m  # None: the slack of that row
    level, dual = demand.astype(float), cost.copy()
    tokens, pivots, stalled = float((lengths * demand).sum()), 0, False
    while pivots < most_pivots and not stalled:
        outside = sum(level[r] * lengths[r] for r in range(m) if basic[r] is None)
        if outside <= GOOD_ENOUGH * tokens:
            break
        stalled = True
        for pattern in best_fillings(lengths, dual, capacity, COLUMNS_AT_ONCE):
            rows, times = np.fromiter(pattern, int), np.fromiter(pattern.values(), float)
            gain = float(dual[rows] @ times)
            if gain <= 1e-6 * capacity:
                continue
            column = inverse[:, rows] @ times
            able = column > 1e-9
            if not able.any():
                continue
            ratio = np.full(m, np.inf)
            ratio[able] = level[able] / column[able]
            r = int(np.argmin(ratio))
            step = ratio[r]
            level -= step * column
            level[r] = step
            np.maximum(level, 0.0, out=level)
            dual -= gain / column[r] * inverse[r]
            inverse[r] /= column[r]
            others = np.flatnonzero(column)
            others = others[others != r]
            inverse[others] -= np.outer(column[others], inverse[r])
            basic[r], pivots, stalled = pattern, pivots + 1, False
            if pivots == most_pivots:
                break
    # A pattern may have entered at several rows; down first, then up while pieces last.
    chosen = [(basic[r], level[r]) for r in range(m) if basic[r] is not None]
    left, copies = demand.astype(np.int64).copy(), []
    for pattern, x in chosen:
        n = min([int(x + 1e-9)] + [int(left[i]) // a for i, a in pattern.items()])
        for i, a in pattern.items():
            left[i] -= a * n
        copies.append(n)
    for k in sorted(range(len(chosen)), key=lambda k: -(chosen[k][1] - copies[k])):
        n = min(int(left[i]) // a for i, a in chosen[k][0].items())
        for i, a in chosen[k][0].items():
            left[i] -= a * n
        copies[k] += n
    return [(pattern, n) for (pattern, _), n in zip(chosen, copies) if n]


def _plan(histogram: dict[int, int], capacity: int):
    """Rows of the assignment table, where the leftover of each length begins, and the sequences used by patterns."""
    lengths = np.array(sorted(x for x in histogram if x < capacity), np.int64)
    demand = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    patterns = cutting_patterns(lengths, demand, capacity)
    whole = histogram.get(capacity, 0)
    rows, taken, sequence = [], {}, 0
    if whole:
        rows.append((capacity, 0, whole, 1, 0, 0))
        taken[capacity], sequence = whole, whole
    for pattern, copies in patterns:
        offset = 0
        for i in sorted(pattern, reverse=True):
            length, times = int(lengths[i]), pattern[i]
            start = taken.get(length, 0)
            rows.append((length, start, start + times * copies, times, sequence, offset))
            taken[length] = start + times * copies
            offset += times * length
        sequence += copies
    return rows, taken, sequence


def packed(docs: DataFrame, text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("key", text_key("text"))
    numbers = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    schema = T.StructType([keyed.schema["doc_id"], keyed.schema["key"], *numbers])
    # Written first: a sort by ranges reads its input twice, and this one would encode the texts again.
    cut = written(keyed.mapInArrow(_cut(tokenizer, capacity, ["doc_id", "key"]), schema), "pieces")
    ranked = numbered(cut, *map(F.asc, ("length", "doc_id", "key", "start")))
    ranked = written(ranked, "ranked")
    histogram = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}  # at most `capacity` rows
    rows, taken, used = _plan(histogram, capacity)

    base, left, at, position = {}, {}, 0, 0
    for length in sorted(histogram):
        base[length] = at
        at += histogram[length]
    for length in sorted(histogram, reverse=True):
        left[length] = position
        position += length * (histogram[length] - taken.get(length, 0))
    per_length = spark.createDataFrame(
        [(n, base[n], taken.get(n, 0), left[n]) for n in sorted(histogram)], "length long, base long, taken long, left long"
    )
    placed = ranked.join(F.broadcast(per_length), "length").withColumn("k", F.col("rank") - F.col("base"))

    entries = spark.createDataFrame(
        rows, "e_length long, k_from long, k_to long, times long, first_sequence long, first_offset long"
    )
    own = F.col("k") - F.col("k_from")
    in_patterns = placed.filter("k < taken").join(
        F.broadcast(entries), (F.col("length") == F.col("e_length")) & (F.col("k") >= F.col("k_from")) & (F.col("k") < F.col("k_to"))
    ).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.floor(own / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + own % F.col("times") * F.col("length")).cast("long").alias("offset"),
    )

    # The rest lies end to end from position 0; its sequences are full ones, then powers of two.
    full, tail = divmod(position, capacity)
    bounds, edge = [], full * capacity
    for bit in reversed(range(capacity.bit_length())):
        if tail >> bit & 1:
            bounds.append(edge)
            edge += 1 << bit
    begin = F.col("left") + (F.col("k") - F.col("taken")) * F.col("length")
    ends = F.array_sort(F.array_distinct(F.concat(
        F.filter(F.array((F.floor(F.col("pos") / capacity) * capacity + capacity).cast("long")), lambda b: b <= full * capacity),
        F.array(*[F.lit(b).cast("long") for b in [*bounds, position]]),
    )))
    inner = F.filter(ends, lambda b: (b > F.col("pos")) & (b < F.col("pos") + F.col("length")))
    rest = placed.filter("k >= taken").withColumn("pos", begin).withColumn("cuts", inner)
    rest = rest.withColumn("edges", F.concat(F.array("pos"), F.col("cuts"), F.array(F.col("pos") + F.col("length"))))
    parts = rest.select("*", F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("part"))
    low, high = F.get("edges", F.col("part")), F.get("edges", F.col("part") + 1)
    in_tail = sum([F.when(low >= b, 1).otherwise(0) for b in bounds[1:]], F.lit(0))
    home = F.floor(low / capacity) if not bounds else F.when(low < full * capacity, F.floor(low / capacity)).otherwise(full + in_tail)
    home_start = F.when(low < full * capacity, F.floor(low / capacity) * capacity).otherwise(
        F.greatest(F.lit(full * capacity), *[F.when(low >= b, F.lit(b)).otherwise(F.lit(full * capacity)) for b in (bounds or [0])])
    )
    parts = parts.select(
        "doc_id", "key", (F.col("start") + low - F.col("pos")).alias("start"), (high - low).alias("length"),
        "ids_crc32", "doc_tokens", (F.size("cuts") > 0).alias("is_cut"),
        (F.lit(used) + home).cast("long").alias("sequence_id"), (low - home_start).cast("long").alias("offset"),
    )
    parts = written(parts, "leftover")
    uncut = parts.filter("not is_cut").select(*in_patterns.columns)
    again = parts.filter("is_cut")
    texts = _texts_of(keyed, again)
    recoded = again.drop("ids_crc32").join(texts, "key").mapInArrow(
        _checksums(tokenizer), T.StructType([keyed.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in in_patterns.columns[1:]]])
    )
    return in_patterns.unionByName(uncut).unionByName(recoded)


def _texts_of(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text per key of ``wanted``. Few keys are broadcast; many are joined by shuffles."""
    keys = wanted.select("key").distinct()
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return keyed.select("key", "text").join(F.broadcast(keys) if few else keys, "key", "left_semi").dropDuplicates(["key"])


def _checksums(tokenizer: str | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in pieces(batches, "text", 3 << 20):
            ids = encoder.encode(as_bytes(batch.column("text")))
            spans = zip(batch.column("start").to_pylist(), batch.column("length").to_pylist())
            sums = [zlib.crc32(i[4 * s: 4 * (s + n)]) for i, (s, n) in zip(ids, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("length"), pa.array(sums, pa.int64()),
                 batch.column("doc_tokens"), batch.column("sequence_id"), batch.column("offset")],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run
