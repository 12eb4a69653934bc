"""Toxicity scores from a sparse linear model that does not react to which group a text mentions.

Features are the words of a text, present or not, and for each beginning of
words whether at least one to four different words of the text share it
(inflected insults count together, and one chance hit is not many). The
vocabulary is what a bounded labelled sample holds often enough; a model with an
L1 penalty picks what matters, and that is fitted again without it. Both fits carry a
counterfactual penalty: in every labelled sentence that mentions an identity
term, the term is swapped for each other term of its set (neutral words such as
"person" are members), and the squared change of the score is punished. So a
group that happens to be mentioned in toxic texts gets no weight of its own.

Identity terms are a parameter. The penalty acts on what the labelled sentences
mention: ``Model.swapped`` tells how many swaps there were. With none, as in
texts of invented words, the model is the plain sparse one. An empty or null
text has no words and gets the score of the base rate of such texts. Without
labels every score is 0.
"""

from __future__ import annotations

import re
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

THRESHOLD = 0.7
STEMS = (4, 5, 6, 7)
MOST_ALIKE = 4
VOCABULARY = 30_000
LEAST_DOCUMENTS = 5
L1 = 1e-3
L2 = 1e-4
COUNTERFACTUAL = 1.0
ROUNDS = 400

#: Sets of terms that may be swapped for each other; the first of each set is neutral.
IDENTITY_TERMS = (
    ("person", "woman", "man", "girl", "boy", "trans", "nonbinary", "female", "male"),
    ("person", "muslim", "christian", "jew", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("person", "black", "white", "asian", "latino", "african", "european", "arab", "indigenous", "roma"),
    ("person", "gay", "straight", "lesbian", "bisexual", "queer", "homosexual", "heterosexual"),
    ("person", "immigrant", "refugee", "foreigner", "citizen", "american", "german", "french", "spanish", "mexican", "chinese", "indian"),
    ("person", "disabled", "blind", "deaf", "autistic", "elderly", "young", "old"),
    ("mensch", "frau", "mann", "jude", "christ", "muslim", "schwarz", "weiss", "schwul", "lesbisch", "ausländer", "flüchtling"),
    ("personne", "femme", "homme", "juif", "chrétien", "musulman", "noir", "blanc", "gay", "lesbienne", "étranger", "réfugié"),
    ("persona", "mujer", "hombre", "judío", "cristiano", "musulmán", "negro", "blanco", "gay", "lesbiana", "extranjero", "refugiado"),
)

_WORD = re.compile(r"\w+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features(text: str, terms: frozenset[str] = frozenset()) -> set[str]:
    """Words, and ``stem*k`` where at least k different words begin with the stem.

    Identity terms are features as words only, so that a swap changes one feature for another.
    """
    own = words(text)
    out = set(own)
    own -= terms
    for length in STEMS:
        for stem, n in Counter([w[:length] for w in own if len(w) >= length]).items():
            out.update([f"{stem}*{k}" for k in range(1, min(n, MOST_ALIKE) + 1)])
    return out


class Model:
    """A base and weights by feature; stems are kept apart so that a text is scored without listing all of its features."""

    def __init__(self, weights: dict[str, float], base: float, terms: frozenset[str] = frozenset(), swapped: int = 0):
        self.weights, self.base, self.terms, self.swapped = weights, base, terms, swapped
        self.words = {f: w for f, w in weights.items() if "*" not in f}
        self.stems: dict[int, dict[str, list[float]]] = {}
        for feature, weight in weights.items():
            stem, star, k = feature.rpartition("*")
            if star:
                steps = self.stems.setdefault(len(stem), {}).setdefault(stem, [0.0] * MOST_ALIKE)
                steps[int(k) - 1] = weight

    def score(self, text: str) -> float:
        own = words(text)
        parts = [self.words[w] for w in self.words.keys() & own]
        own -= self.terms
        for length, known in self.stems.items():
            for stem, n in Counter([s for w in own if (s := w[:length]) in known]).items():
                parts += known[stem][:n]
        # Summed in one order: the same features give the same score everywhere.
        z = self.base + sum(sorted(parts))
        return float(1 / (1 + np.exp(-min(max(z, -60.0), 60.0))))


@dataclass
class _Rows:
    """Sparse 0/1 rows."""

    index: np.ndarray
    start: np.ndarray
    width: int

    def __post_init__(self):
        self.count = np.diff(self.start)
        self.row = np.repeat(np.arange(len(self.count), dtype=np.int32), self.count)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], len(self.count))

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, r[self.row], self.width)

    def only(self, columns: np.ndarray) -> _Rows:
        new = np.full(self.width, -1, np.int32)
        new[columns] = np.arange(len(columns))
        good = new[self.index] >= 0
        counts = np.bincount(self.row[good], minlength=len(self.count))
        return _Rows(new[self.index[good]], np.r_[0, np.cumsum(counts)], len(columns))


def _fit(x: _Rows, y: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], l1: float, l2: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on logistic loss, both penalties and the counterfactual one.

    ``pairs``: swapped columns a, b (-1: outside the vocabulary) and how often, as a share of the rows.
    """
    n, a, b, often = len(y), *pairs
    w, base = np.zeros(x.width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    look, look_base, momentum = w.copy(), base, 1.0
    step = 1.0 / (0.25 * (x.count.mean() + 1) + l2 + 4 * COUNTERFACTUAL * (often.max() if len(often) else 0))

    def swap_change(v):
        return np.where(a >= 0, v[a], 0.0) - np.where(b >= 0, v[b], 0.0)

    def loss(v, c):
        z = x.dot(v) + c
        change = swap_change(v)
        return np.logaddexp(0, z).mean() - (y * z).mean() + l1 * np.abs(v).sum() + l2 / 2 * v @ v + COUNTERFACTUAL / 2 * (often * change ** 2).sum()

    before = np.inf
    for _ in range(ROUNDS):
        z = x.dot(look) + look_base
        r = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        slope = x.back(r) + l2 * look
        if len(a):
            pull = COUNTERFACTUAL * often * swap_change(look)
            np.add.at(slope, a[a >= 0], pull[a >= 0])
            np.add.at(slope, b[b >= 0], -pull[b >= 0])
        moved = look - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0.0)
        new_base = look_base - step * r.sum()
        now = loss(new, new_base)
        if now > before:  # too long a step, or momentum past the valley
            step, momentum, look, look_base = step / 2, 1.0, w.copy(), base
            before = now if step < 1e-6 else before
            continue
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        beyond = (momentum - 1) / following
        look, look_base = new + beyond * (new - w), new_base + beyond * (new_base - base)
        if before - now < 1e-9:
            w, base = new, new_base
            break
        w, base, momentum, before = new, new_base, following, now
        step *= 1.05
    return w, base


def _documents_with(terms: frozenset[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found: Counter = Counter()
            for t, y in zip(as_bytes(batch.column("text")), batch.column("label").to_pylist()):
                found.update((w, y) for w in features(t.decode(), terms))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32()), pa.array(list(found.values()), pa.int64())],
                ["word", "label", "n"],
            )

    return run


def swaps(text: str, sets: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Counter:
    """(term, other term) for every sentence that mentions the term and every swap of it."""
    found: Counter = Counter()
    for sentence in re.split(r"[.!?\n]+", text.lower()):
        present = set(_WORD.findall(sentence))
        for terms in sets:
            for term in present.intersection(terms):
                found.update((term, other) for other in terms if other != term)
    return found


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text",
          sets: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """The model of a bounded sample; the driver gets at most ``VOCABULARY`` words and the sample's rows of them."""
    spark = documents.sparkSession
    rows = sample(documents, labels, label, text).orderBy("doc_id").select("text", "label")
    terms = frozenset(t for s in sets for t in s)
    counts = rows.mapInArrow(_documents_with(terms), "word string, label int, n long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("ones")
    )
    frequent = counts.filter(F.col("n") >= LEAST_DOCUMENTS)
    # The words whose presence says most about the label (the rest could not outweigh them), and the identity terms.
    rate = rows.agg(F.avg("label")).first()[0]
    if rate is None:
        return Model({}, -60.0)
    surprise = F.abs(F.col("ones") - F.col("n") * rate) / F.sqrt(F.col("n") * F.lit(max(rate * (1 - rate), 1e-9)))
    listed = [r[0] for r in frequent.orderBy(F.desc(surprise), "word").limit(VOCABULARY).select("word").toLocalIterator()]
    vocabulary = sorted({*listed, *terms})
    place = {w: i for i, w in enumerate(vocabulary)}
    shared = spark.sparkContext.broadcast((place, sets, terms))

    def indexed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_sets, own_terms = shared.value
        for batch in pieces(batches, "text"):
            texts = [t.decode() for t in as_bytes(batch.column("text"))]
            found = [sorted(own[w] for w in own.keys() & features(t, own_terms)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column("label")], ["x", "label"])

    def swapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_sets, _ = shared.value
        for batch in pieces(batches, "text"):
            found: Counter = Counter()
            for t in as_bytes(batch.column("text")):
                found.update(swaps(t.decode(), own_sets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([own[a] for a, _ in found], pa.int64()), pa.array([own[b] for _, b in found], pa.int64()), pa.array(list(found.values()), pa.int64())],
                ["a", "b", "n"],
            )

    known = rows.mapInArrow(indexed, "x array<int>, label int").toArrow().combine_chunks()
    # One row per pair of terms of a set.
    pairs_of = rows.mapInArrow(swapped, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).orderBy("a", "b").toArrow().combine_chunks()
    y = known.column("label").to_numpy().astype(float)
    if y.min() == y.max():
        return Model({}, 60.0 if y[0] else -60.0)
    lists = known.column("x").combine_chunks()
    x = _Rows(np.asarray(lists.flatten()), np.r_[0, np.cumsum(np.asarray(lists.value_lengths()))].astype(np.int64), len(vocabulary))
    a, b, n = (np.asarray(pairs_of.column(c).to_numpy()).astype(np.int64) for c in ("a", "b", "n"))
    pairs = (a, b, n / len(y))
    w, _ = _fit(x, y, pairs, L1, L2)
    chosen = np.flatnonzero(np.abs(w) > 1e-6)
    new = np.full(len(vocabulary), -1)
    new[chosen] = np.arange(len(chosen))
    w, base = _fit(x.only(chosen), y, (new[pairs[0]], new[pairs[1]], pairs[2]), 0.0, L2)
    return Model({vocabulary[c]: float(v) for c, v in zip(chosen.tolist(), w.tolist())}, base, terms, int(n.sum()))


def scored(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (score of at least the threshold) for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            score = [shared.value.score(t.decode()) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())], ["doc_id", "held_out", "score"]
            )

    rows = documents.select("doc_id", held_out().alias("held_out"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
