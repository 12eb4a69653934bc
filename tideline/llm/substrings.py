"""Removal of repeated passages: every window of 35 words that starts twice or more in the corpus.

Windows are not shipped one by one. Of the 6-word grams in a window the one
with the least hash is its minimiser; consecutive windows of a document that
share it travel as one packed string (a super-k-mer), about 16 windows in
twice their length. Equal windows have equal minimisers, so they meet in one
bucket, where words become exact codes, windows are sorted by a hash of their
codes and equal hashes are confirmed code by code.

- A window whose minimiser occurs at one place of the corpus cannot repeat. The minimisers that occur again make a Bloom
  filter of fixed size (``FILTER_WORDS`` words of 64 bits), and strings that it rules out are not sent. It keeps
  every repeated minimiser, so nothing is lost; the fuller it gets, the more of the others are sent as well.
- A minimiser with more than ``MOST_ALIKE`` super-k-mers (or a millionth of all, if that is more) would
  crowd its bucket. Those are counted first; their windows travel singly, to the bucket of the window's
  own hash, and each batch of text sends a window only once, marked if it has seen it twice.
- Copies of a whole text within one task are reported at once and not packed again.
- Buckets grow in number with the shuffle partitions, and many strings of a bucket are one compressed blob.
- Results are spans of words per text, keyed by a digest of the text, so copies share them.

Null texts have no words; a text of fewer than 35 words loses none; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.text import as_bytes, free_name, mix, pieces, ranges, span_hashes, text_key
from tideline.llm.workers import start_lean
from tideline.session import written

WINDOW = 35
GRAM = 6
MOST_ALIKE = 2000
BUCKETS_PER_PARTITION = 16
FLUSH_BYTES = 24 << 20
#: 16 MB, whatever the size of the corpus.
FILTER_WORDS = 1 << 21
_GRAM_BASE = 0xD6E8FEB86659FD93


class _Chunk:
    """Words of several texts in one buffer: ``w1 w2 ... wn `` with a space after every word."""

    def __init__(self, texts: list[bytes]):
        spelled = [b" ".join(t.split()) for t in texts]
        spelled = [t + b" " if t else t for t in spelled]
        self.data = b"".join(spelled)
        raw = np.frombuffer(self.data, np.uint8)
        ends = np.flatnonzero(raw == 32)
        self.start = np.r_[0, ends[:-1] + 1] if len(ends) else np.empty(0, np.int64)
        self.end = ends + 1
        text_ends = np.cumsum([len(t) for t in spelled])
        self.last_word = np.searchsorted(ends, text_ends, side="left")
        self.first_word = np.r_[0, self.last_word[:-1]]
        self.raw = raw

    def super_kmers(self, width: int = WINDOW):
        """Arrays: text, first window, number of windows, minimiser."""
        n = self.last_word - self.first_word - width + 1
        text = np.flatnonzero(n > 0)
        if not len(text):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        words = span_hashes(self.raw.astype(np.uint64) + np.uint64(1), self.start, self.end)
        grams = words[: len(words) - GRAM + 1].copy()
        scale = _GRAM_BASE
        for j in range(1, GRAM):
            grams += words[j: len(words) - GRAM + 1 + j] * np.uint64(scale)
            scale = scale * _GRAM_BASE % (1 << 64)
        self.grams = mix(grams)
        low, reach, want = self.grams, 1, width - GRAM + 1
        while reach * 2 <= want:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < want:
            low = np.minimum(low[: len(low) - (want - reach)], low[want - reach:])
        window = ranges(self.first_word[text], n[text])
        owner = np.repeat(text, n[text])
        least = low[window]
        begins = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])
        return owner[begins], window[begins], np.diff(np.r_[begins, len(window)]), least[begins]

    def holding_two(self, window: np.ndarray, n: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
        """Which super-k-mers hold their minimiser at two places: only those can repeat a window within themselves."""
        if not len(window):
            return np.zeros(0, bool)
        size = n + width - GRAM
        here = self.grams[ranges(window, size)] == np.repeat(least, size)
        return np.add.reduceat(here.astype(np.int64), np.cumsum(size) - size) > 1

    def packed(self, word: int, n: int) -> bytes:
        return self.data[self.start[word]: self.end[word + n - 1]]


def _minimisers(width: int):
    """Minimisers of each text of a task and of one copy of it, so that copies of a text count however they are dealt."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_lean()
        seen: set[bytes] = set()
        repeated: set[bytes] = set()
        for batch in pieces(batches, "text"):
            fresh, _, again = _first_copies(as_bytes(batch.column("text")), seen)
            second = []
            for digest, text in again:
                if digest not in repeated:
                    repeated.add(digest)
                    second.append(text)
            chunk = _Chunk(fresh + second)
            _, window, n, least = chunk.super_kmers(width)
            # A string that may hold a window twice counts as two.
            found, counts = np.unique(np.r_[least, least[chunk.holding_two(window, n, least, width)]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["minimiser", "n"])

    return run


def _filter_bits(minimisers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and mask of each minimiser in the filter: three bits of one word."""
    h = mix(minimisers ^ np.uint64(_GRAM_BASE))
    word = h % np.uint64(FILTER_WORDS)
    mask = np.zeros(len(h), np.uint64)
    for shift in (58, 52, 46):
        mask |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return word, mask


def _masks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, mask = _filter_bits(np.asarray(batch.column("minimiser")).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])


def _repeated_filter(counted: DataFrame) -> np.ndarray:
    """The filter of the minimisers in ``counted``; at most ``FILTER_WORDS`` rows reach the driver."""
    found = counted.select("minimiser").mapInArrow(_masks, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(FILTER_WORDS, np.uint64)
    words[np.asarray(found.column("word").combine_chunks())] = np.asarray(found.column("mask").combine_chunks()).view(np.uint64)
    return words


def _first_copies(texts: list[bytes], seen: set[bytes]) -> tuple[list[bytes], list[bytes], list[tuple[bytes, bytes]]]:
    """Texts that this task has not had yet, their digests, and (digest, text) of the others."""
    fresh, digests, again = [], [], []
    for t in texts:
        digest = hashlib.sha256(t).digest()[:16]
        if digest in seen:
            again.append((digest, t))
        else:
            seen.add(digest)
            fresh.append(t)
            digests.append(digest)
    return fresh, digests, again


def _blob(kind: int, digests: list[bytes], starts: np.ndarray, sizes: np.ndarray, flags: np.ndarray, strings: bytes) -> bytes:
    head = np.array([kind, len(digests)], np.int64).tobytes()
    body = b"".join([
        head, b"".join(digests), starts.astype(np.int32).tobytes(), sizes.astype(np.int32).tobytes(),
        flags.astype(np.uint8).tobytes(), strings,
    ])
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unblob(blob: bytes):
    body = zstandard.ZstdDecompressor().decompress(blob)
    kind, n = np.frombuffer(body, np.int64, 2).tolist()
    at = 16 + 16 * n
    digests = np.frombuffer(body, np.dtype("V16"), n, 16)
    starts = np.frombuffer(body, np.int32, n, at)
    sizes = np.frombuffer(body, np.int32, n, at + 4 * n)
    flags = np.frombuffer(body, np.uint8, n, at + 8 * n)
    return kind, digests, starts, sizes, flags, body[at + 9 * n:]


class _Packer:
    """Collects packed strings of one task and hands them over by bucket."""

    def __init__(self, buckets: int, hot: np.ndarray, repeated: np.ndarray, width: int):
        self.buckets, self.hot, self.repeated, self.width = buckets, hot, repeated, width
        self.clear()

    def clear(self):
        self.bucket, self.digest, self.begin, self.string = [], [], [], []
        self.single: dict[bytes, list] = {}  # window -> [digest, start, seen again]
        self.spans: list[tuple[bytes, int, int]] = []
        self.bytes = 0

    def add(self, chunk: _Chunk, digests: list[bytes]):
        text, window, n, least = chunk.super_kmers(self.width)
        word, mask = _filter_bits(least)
        may_repeat = self.repeated[word] & mask == mask
        text, window, n, least = text[may_repeat], window[may_repeat], n[may_repeat], least[may_repeat]
        where = np.searchsorted(self.hot, least)
        is_hot = (where < len(self.hot)) & (self.hot[np.minimum(where, len(self.hot) - 1)] == least) if len(self.hot) else np.zeros(len(least), bool)
        begin = window - chunk.first_word[text]
        bucket = mix(least) % np.uint64(self.buckets)
        cold = ~is_hot
        a, b = chunk.start[window].tolist(), chunk.end[window + n + self.width - 2].tolist()
        for k in np.flatnonzero(cold).tolist():
            self.string.append(chunk.data[a[k]:b[k]])
        self.bucket.append(bucket[cold].astype(np.int64))
        self.begin.append(begin[cold])
        self.digest += [digests[t] for t in text[cold].tolist()]
        self.bytes += sum(b[k] - a[k] for k in np.flatnonzero(cold).tolist())
        for k in np.flatnonzero(is_hot).tolist():
            for i in range(int(n[k])):
                string = chunk.packed(int(window[k]) + i, self.width)
                digest, at = digests[text[k]], int(begin[k]) + i
                known = self.single.get(string)
                if known is None:
                    self.single[string] = [digest, at, False]
                    self.bytes += len(string) + 100
                else:
                    if not known[2]:
                        known[2] = True
                        self.span(known[0], known[1], known[1] + self.width)
                    self.span(digest, at, at + self.width)

    def span(self, digest: bytes, low: int, high: int):
        """Note a span; one that goes on from the last is joined to it, so a text of one word makes one span."""
        if self.spans and self.spans[-1][0] == digest and self.spans[-1][1] <= low <= self.spans[-1][2]:
            self.spans[-1] = (digest, self.spans[-1][1], max(high, self.spans[-1][2]))
        else:
            self.spans.append((digest, low, high))
            self.bytes += 150

    def whole(self, digest: bytes, text: bytes):
        words = len(text.split())
        if words >= self.width:
            self.span(digest, 0, words)

    def flush(self) -> Iterator[pa.RecordBatch]:
        singles = list(self.single.items())
        strings = self.string + [s for s, _ in singles]
        digests = self.digest + [v[0] for _, v in singles]
        begins = np.concatenate([*self.begin, np.array([v[1] for _, v in singles], np.int64)]).astype(np.int64)
        flags = np.concatenate([np.zeros(len(self.string), np.uint8), np.array([v[2] for _, v in singles], np.uint8)])
        own = np.array([int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little") % self.buckets for s, _ in singles], np.int64)
        buckets = np.concatenate([*self.bucket, own]).astype(np.int64)
        sizes = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(buckets, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(buckets[order]) != 0]) if len(order) else []
        ids, blobs = [], []
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(order)] if len(order) else []):
            rows = order[lo:hi]
            picked = rows.tolist()
            ids.append(int(buckets[rows[0]]))
            blobs.append(_blob(0, [digests[r] for r in picked], begins[rows], sizes[rows], flags[rows], b"".join([strings[r] for r in picked])))
        if self.spans:
            spans = list(dict.fromkeys(self.spans))
            # Known spans need no bucket; they go where their first digest points, to spread them.
            ids.append(int.from_bytes(spans[0][0][:7], "little") % self.buckets)
            blobs.append(_blob(
                1, [s[0] for s in spans], np.array([s[1] for s in spans]), np.array([s[2] for s in spans]),
                np.zeros(len(spans)), b"",
            ))
        self.clear()
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])


def _packing(buckets: int, shared, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_lean()
        packer, seen = _Packer(buckets, *shared.value, width), set()
        for batch in pieces(batches, "text"):
            fresh, digests, again = _first_copies(as_bytes(batch.column("text")), seen)
            packer.add(_Chunk(fresh), digests)
            for digest, text in again:
                packer.whole(digest, text)
            if packer.bytes >= FLUSH_BYTES:
                yield from packer.flush()
        yield from packer.flush()

    return run


def repeated_windows(strings: bytes, sizes: np.ndarray, flags: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset in words) of each window that is there twice, or once in a flagged string. Exact."""
    raw = np.frombuffer(strings, np.uint8)
    ends = np.flatnonzero(raw == 32) + 1
    offsets = np.r_[0, ends].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(strings)])
    codes = np.asarray(words.dictionary_encode().indices).astype(np.uint64)
    last = np.searchsorted(ends, np.cumsum(sizes), side="left") + 1
    first = np.r_[0, last[:-1]]
    n = last - first - width + 1
    window, owner = ranges(first, n), np.repeat(np.arange(len(sizes)), n)
    hashes = span_hashes(mix(codes + np.uint64(1)), window, window + width)
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    a, b = window[order[same]], window[order[same + 1]]
    equal = np.ones(len(same), bool)
    for j in range(width):
        equal &= codes[a + j] == codes[b + j]
    hit = flags[owner].astype(bool)
    if equal.all():
        hit[order[same]] = True
        hit[order[same + 1]] = True
    else:  # different windows with one hash: compare the windows of such hashes by their codes
        doubtful = np.unique(np.r_[order[same], order[same + 1]])
        groups: dict[bytes, list[int]] = {}
        for k in doubtful.tolist():
            groups.setdefault(codes[window[k]: window[k] + width].tobytes(), []).append(k)
        for members in groups.values():
            if len(members) > 1:
                hit[members] = True
    found = np.flatnonzero(hit)
    return owner[found], window[found] - first[owner[found]]


def _solving(width: int):
    def solve(blobs: list[bytes]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        parts = []
        for kind, digests, starts, sizes, flags, strings in map(_unblob, blobs):
            if kind == 1:
                yield digests, starts, sizes
            else:
                parts.append((digests, starts, sizes, flags, strings))
        if parts:
            digests, starts, sizes, flags = (np.concatenate([p[i] for p in parts]) for i in range(4))
            owner, offset = repeated_windows(b"".join(p[4] for p in parts), sizes, flags, width)
            if len(owner):
                # Windows in a row become one span.
                begins = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])
                stops = np.r_[begins[1:], len(owner)] - 1
                low = starts[owner[begins]] + offset[begins]
                yield digests[owner[begins]], low, low + (offset[stops] - offset[begins]) + width

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_lean()
        held, current = [], None
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                if bucket != current and held:
                    yield from map(spans, solve(held))
                    held = []
                current = bucket
                held.append(blob)
        if held:
            yield from map(spans, solve(held))

    def spans(found) -> pa.RecordBatch:
        digests, low, high = found
        return pa.RecordBatch.from_arrays(
            [pa.array([bytes(d) for d in digests], pa.binary()), pa.array(np.asarray(low, np.int32)), pa.array(np.asarray(high, np.int32))],
            ["digest", "low", "high"],
        )

    return run


def repeated_spans(texts: DataFrame, width: int = WINDOW, most_alike: int = MOST_ALIKE) -> DataFrame:
    """``digest`` of each text with repeated windows and its ``spans`` (from word, to word), from a frame of ``text``."""
    spark = texts.sparkSession
    texts = texts.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_minimisers(width), "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    counted = written(counted.filter(F.col("n") > 1), "minimisers")
    limit = max(most_alike, (counted.agg(F.sum("n")).first()[0] or 0) // 1_000_000)
    # More than a millionth of all each: at most a million of them, 8 MB.
    hot = np.sort(np.array([r[0] for r in counted.filter(F.col("n") > limit).select("minimiser").toLocalIterator()], np.int64).view(np.uint64))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast((hot, _repeated_filter(counted)))
    packed = texts.mapInArrow(_packing(parts * BUCKETS_PER_PARTITION, shared, width), "bucket long, blob binary")
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    spans = dealt.mapInArrow(_solving(width), "digest binary, low int, high int")
    return written(spans.groupBy("digest").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans")


def kept_words(text: bytes, spans: list[dict] | None) -> tuple[list[bytes], int]:
    """The words outside the spans, and how many there were."""
    words = text.split()
    if not spans:
        return words, len(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [s["low"] for s in spans], 1)
    np.add.at(change, [s["high"] for s in spans], -1)
    inside = np.cumsum(change[:-1]) > 0
    return [w for w, gone in zip(words, inside.tolist()) if not gone], len(words)


def with_spans(docs: DataFrame, text: str = "text", width: int = WINDOW, most_alike: int = MOST_ALIKE) -> tuple[DataFrame, str]:
    """``docs`` with a column of the spans to remove (null: none), and that column's name."""
    spans = repeated_spans(docs.select(F.col(text).alias("text")), width, most_alike)
    key, name = free_name(docs, "text_key"), free_name(docs, "spans")
    spans = spans.select(F.col("digest").alias(key), F.col("spans").alias(name))
    return docs.withColumn(key, text_key(text)).join(spans, key, "left").drop(key), name


def removed(docs: DataFrame, text: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs`` whose text is the kept words joined by one space (untouched where no word goes); ``n_chars`` follows."""
    spanned, name = with_spans(docs, text, width)
    schema = docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_lean()
        for batch in pieces(batches, text):
            texts, spans = as_bytes(batch.column(text)), batch.column(name).to_pylist()
            nulls = batch.column(text).is_null().to_pylist()
            new = [
                None if gone else (b" ".join(kept_words(t, s)[0]) if s else t).decode("utf-8", "replace") for t, s, gone in zip(texts, spans, nulls)
            ]
            columns = [pa.array(new, pa.string()) if c == text else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    out = spanned.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length(text).cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def report(docs: DataFrame, text: str = "text", width: int = WINDOW, most_alike: int = MOST_ALIKE) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the digest of what is kept, for each row."""
    spanned, name = with_spans(docs.select("doc_id", F.col(text).alias("text")), "text", width, most_alike)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            totals, gone, digests = [], [], []
            for t, s in zip(as_bytes(batch.column("text")), batch.column(name).to_pylist()):
                kept, n = kept_words(t, s)
                totals.append(n)
                gone.append(n - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spanned.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
