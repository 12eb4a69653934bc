"""Quality scores from histogram gradient-boosted trees over document statistics.

Each text becomes a row of statistics (lengths, shares of kinds of characters,
repetition). Trees are grown on the driver from a bounded labelled sample:
statistics are cut at quantiles into at most ``BINS`` bins, and splits are
chosen from histograms of gradients. All trees are complete and have one depth, so
they lie flat in three arrays, and a batch of documents walks all trees at once
by indexing. Fitting gives the same trees in every run.

An empty or null text has statistics of zero and gets a score like any other.
Without labels every score is 0.5, with labels of one kind it is near that kind.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.labelled import held_out, sample
from tideline.llm.text import as_bytes, pieces

BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
L2 = 1.0
LEAST_WEIGHT = 1.0  # of second derivatives in a leaf

STATISTICS = (
    "log_words", "word_length", "longest_word", "symbols", "capitals", "digits", "punctuation", "exclamations", "pipes",
    "other_bytes", "lines_per_word", "repeated_lines", "distinct_words", "top_word", "repeated_triples", "short_words",
    "closed_words", "single_letters", "at_signs", "slashes",
)
_KEEP = {
    "symbols": b"#*$%&|<>", "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "punctuation": b".,;:!?",
    "exclamations": b"!", "pipes": b"|", "at_signs": b"@", "slashes": b"/\\", "other_bytes": bytes(range(128, 256)),
}


def statistics(text: bytes) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    letters = sum(map(len, words))
    share = {name: (len(text) - len(text.translate(None, chars))) / letters for name, chars in _KEEP.items()}
    counts = Counter(words)
    triples = max(n - 2, 0)
    lines = [line for line in text.split(b"\n") if line.strip()]
    values = {
        **share, "log_words": np.log1p(n), "word_length": letters / n, "longest_word": np.log1p(max(map(len, counts))),
        "lines_per_word": len(lines) / n, "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1),
        "distinct_words": len(counts) / n, "top_word": max(counts.values()) / n,
        "repeated_triples": 1 - len(set(zip(words, words[1:], words[2:]))) / triples if triples else 0.0,
        "short_words": sum(c for w, c in counts.items() if len(w) <= 3) / n,
        "single_letters": sum(c for w, c in counts.items() if len(w) == 1) / n,
        "closed_words": sum(c for w, c in counts.items() if w[-1] in b".,;:!?") / n,
    }
    return [float(values[name]) for name in STATISTICS]


@dataclass
class Trees:
    """Complete trees in flat arrays: inner node i has children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        n, trees = len(x), np.arange(len(self.feature))[None, :]
        node = np.zeros((n, len(self.feature)), np.int64)
        rows = np.arange(n)[:, None]
        depth = (self.feature.shape[1] + 1).bit_length() - 1 if self.feature.size else 0
        for _ in range(depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        return self.base + (self.leaf[trees, node - self.feature.shape[1]].sum(axis=1) if self.feature.size else np.zeros(n))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -60, 60)))


def _edges(column: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for P(y = 1) from histograms of first and second derivatives."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    n, features = len(y), x.shape[1] if x.ndim == 2 else 0
    rate = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate / (1 - rate)))
    if not n or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [_edges(x[:, f]) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    raw, built = np.full(n, base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            at = node - first
            for f in range(features):
                key = at * BINS + binned[:, f]
                sums = [np.bincount(key, w, width * BINS).reshape(width, BINS).cumsum(axis=1) for w in (g, h)]
                gl, hl = sums
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = gl ** 2 / (hl + L2) + gr ** 2 / (hr + L2) - gl[:, -1:] ** 2 / (hl[:, -1:] + L2)
                gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = -np.inf
                gain = gain[:, : len(edges[f])]
                if gain.shape[1]:
                    cut = gain.argmax(axis=1)
                    found = gain[np.arange(width), cut]
                    better = found > best
                    best[better] = found[better]
                    feature[first:first + width][better] = f
                    threshold[first:first + width][better] = edges[f][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf_of = node - inner
        leaf = -RATE * np.bincount(leaf_of, g, leaves) / (np.bincount(leaf_of, h, leaves) + L2)
        raw = raw + leaf[leaf_of]
        built.append((feature, threshold, leaf))
    return Trees(*(np.stack(part) for part in zip(*built)), base)


def _measuring(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        x = [statistics(t) for t in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> Trees:
    """Trees from the bounded sample: what reaches the driver is its statistics."""
    rows = sample(documents, labels, label, text).orderBy("doc_id").select("text", "label")
    known = rows.mapInArrow(_measuring, "x array<double>, label int").toArrow()
    y = known.column("label").to_numpy().astype(float)
    x = np.array(known.column("x").to_pylist(), float).reshape(len(y), len(STATISTICS))
    return fit(x, y)


def scored(documents: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (score of at least 0.5) for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            score = shared.value.score(np.array([statistics(t) for t in as_bytes(batch.column("text"))]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    rows = documents.select("doc_id", held_out().alias("held_out"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
