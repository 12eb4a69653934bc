"""Hard negatives of anchors by exact integer scores, several rows per multiplication.

Components become integers. Those of a tile of rows are biased to be at least
zero, and the same component of several rows is written into separated fields
of one wide integer (Kronecker packing). A product with an anchor's (biased)
component then multiplies all of them at once. The sum over the components
holds the biased scores in its fields, which are wide enough to never run into
each other; taking the biases off again gives the exact scores. While the sum
stays below 2**53 the wide integers travel as doubles, which hold them
exactly, so that one matrix product does the work; larger ones are Python
integers of any width.

The anchors are a stated query set, in tiles, against all rows, in tiles. Every
pair of tiles is a group of its own and sends on the first few rows per anchor
only. A first pass finds each anchor's positives, a second one the negatives
between a share of the positive's score and that score.

Rows with a null id or label, a null vector, or null or non-finite components
take no part, nor do vectors so long that scores would not fit a long (the sum of
squares of the scaled components above 2**59 if all were as large as the largest).
Vectors of different lengths are not compared; empty ones score 0. Repeated
rows are rows of their own: each is an anchor, and each can be a positive or a
negative. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.integer_vectors import matrix, scaled, usable
from tideline.session import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
PERCENT = 80
TILE_ANCHORS = 8192
TILE_ROWS = 32768
ANCHORS_AT_ONCE = 128
#: Bits of the integers that a double holds exactly.
EXACT_BITS = 53
#: Fields of a Python integer, where doubles are too narrow.
WIDE_FIELDS = 8
NOTHING = np.iinfo(np.int64).min


class Packed:
    """A tile of integer vectors in fields of wide integers."""

    def __init__(self, vectors: np.ndarray, anchors: np.ndarray):
        self.n, self.length = vectors.shape
        self.bias = -int(vectors.min(initial=0))
        self.anchor_bias = -int(anchors.min(initial=0))
        largest = (int(vectors.max(initial=0)) + self.bias) * (int(anchors.max(initial=0)) + self.anchor_bias) * max(1, self.length)
        self.bits = max(1, largest.bit_length())
        self.fields = EXACT_BITS // self.bits
        self.doubles = self.fields > 0
        self.fields = self.fields or WIDE_FIELDS
        raised = vectors + self.bias
        self.sums = raised.sum(axis=1)
        self.words = -(-self.n // self.fields)
        spread = np.zeros((self.words * self.fields, self.length), np.int64)
        spread[:self.n] = raised
        spread = spread.reshape(self.fields, self.words, self.length)
        if self.doubles:
            self.packed = sum(spread[k].astype(np.float64) * 2.0 ** (k * self.bits) for k in range(self.fields))
        else:
            self.packed = sum(spread[k].astype(object) << (k * self.bits) for k in range(self.fields))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """The exact inner products, anchors by rows."""
        raised = anchors + self.anchor_bias
        mask = (1 << self.bits) - 1
        if self.doubles:
            wide = (raised.astype(np.float64) @ self.packed.T).astype(np.int64)
        else:
            wide = raised.astype(object) @ self.packed.T
        parts = [(wide >> (k * self.bits)) & mask for k in range(self.fields)]
        both = np.concatenate([p.astype(np.int64) for p in parts], axis=1)[:, :self.n]
        # (a + A)(b + B) = ab + A(b + B) + B(a + A) - AB, summed over the components.
        both -= self.anchor_bias * self.sums[None, :]
        both -= self.bias * raised.sum(axis=1)[:, None] - self.bias * self.anchor_bias * self.length
        return both


def _first(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, place) of the ``n`` greatest entries of each line but ``NOTHING``; ties go to the smaller place."""
    if scores.shape[1] > n:
        least = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
        line, place = np.nonzero((scores >= least[:, None]) & (scores > NOTHING))
    else:
        line, place = np.nonzero(scores > NOTHING)
    order = np.lexsort((place, -scores[line, place], line))
    line, place = line[order], place[order]
    begins = np.r_[True, line[1:] != line[:-1]] if len(line) else np.zeros(0, bool)
    starts = np.flatnonzero(begins)
    within = np.arange(len(line)) - np.repeat(starts, np.diff(np.r_[starts, len(line)]))
    return line[within < n], place[within < n]


def _groups(values: np.ndarray):
    """The places of each distinct value."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    return np.split(order, cuts) if len(values) else []


def _tile(table: pa.Table):
    """Anchors and rows of a pair of tiles, the rows in the order of their ids."""
    table = table.combine_chunks().sort_by([("vec_id", "ascending"), ("node", "ascending")])
    columns = {name: table.column(name).chunk(0) for name in table.column_names}
    sizes = np.diff(np.asarray(columns["parts"].offsets))
    is_anchor = np.asarray(columns["is_anchor"].to_numpy(zero_copy_only=False))
    node, label, ids = (np.asarray(columns[c]) for c in ("node", "label", "vec_id"))
    for length in np.unique(sizes).tolist():
        anchors, rows = np.flatnonzero(is_anchor & (sizes == length)), np.flatnonzero(~is_anchor & (sizes == length))
        if len(anchors) and len(rows):
            yield columns, length, anchors, rows, node, label, ids


def _positives(n: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for columns, length, anchors, rows, node, label, ids in _tile(table):
            for mine in _groups(label[rows]):
                rows_here = rows[mine]
                anchors_here = anchors[label[anchors] == label[rows_here[0]]]
                if not len(anchors_here):
                    continue
                x = matrix(columns["parts"], anchors_here, length)
                packed = Packed(matrix(columns["parts"], rows_here, length), x)
                for i in range(0, len(anchors_here), ANCHORS_AT_ONCE):
                    some = anchors_here[i:i + ANCHORS_AT_ONCE]
                    scores = packed.scores(x[i:i + ANCHORS_AT_ONCE])
                    scores[node[some][:, None] == node[rows_here][None, :]] = NOTHING
                    line, place = _first(scores, n)
                    out.append((node[some][line], ids[rows_here][place], scores[line, place]))
        return _table(out, ("node", "positive_id", "positive_score"))

    return run


def _negatives(n: int, positives: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for columns, length, anchors, rows, node, label, ids in _tile(table):
            x = matrix(columns["parts"], anchors, length)
            packed = Packed(matrix(columns["parts"], rows, length), x)
            found = columns["positive_scores"].take(pa.array(anchors)).to_pylist()
            for i in range(0, len(anchors), ANCHORS_AT_ONCE):
                some, bounds = anchors[i:i + ANCHORS_AT_ONCE], found[i:i + ANCHORS_AT_ONCE]
                scores = packed.scores(x[i:i + ANCHORS_AT_ONCE])
                scores[label[some][:, None] == label[rows][None, :]] = NOTHING
                for k in range(positives):
                    lines = np.array([j for j, b in enumerate(bounds) if k < len(b)], np.int64)
                    if not len(lines):
                        break
                    most = np.array([bounds[j][k] for j in lines.tolist()], np.int64)
                    # 100 * score >= percent * most, in integers.
                    least = np.array([-(-percent * bounds[j][k] // 100) for j in lines.tolist()], np.int64)
                    held = scores[lines]
                    held[(held > most[:, None]) | (held < least[:, None])] = NOTHING
                    line, place = _first(held, n)
                    out.append((
                        node[some][lines][line], np.full(len(line), k, np.int64), ids[rows][place], held[line, place],
                    ))
        return _table(out, ("node", "k", "negative_id", "negative_score"))

    return run


def _table(parts: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(names))]
    return pa.table([pa.array(c, pa.int64()) for c in columns], list(names))


def _paired(rows: DataFrame, anchors: DataFrame, row_tiles: int, anchor_tiles: int) -> DataFrame:
    """Every pair of an anchor tile and a row tile as one bucket. Tiles hold about equally many rows, whatever the labels."""
    spread = lambda n: F.pmod(F.xxhash64("node"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("a", spread(anchor_tiles)).withColumn("r", every(row_tiles))
    r = rows.withColumn("r", spread(row_tiles)).withColumn("a", every(anchor_tiles))
    # Node numbers count up per partition, so the two tables use the same hash of them.
    return a.withColumn("is_anchor", F.lit(True)).unionByName(r.withColumn("is_anchor", F.lit(False)), allowMissingColumns=True)


def mined(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT,
    scale: float = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``. An anchor's positives are its first ``positives``
    other rows of the same label by score; each one's negatives are the first ``negatives`` rows of another
    label whose score is at most the positive's and at least ``percent`` per cent of it.
    """
    spark = vectors.sparkSession
    fit = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding", scale))
    kept = fit.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        scaled("embedding", scale).alias("parts"), is_anchor.alias("chosen"),
    )
    # The number of a row is drawn once and kept by writing it.
    kept = written(kept.withColumn("node", F.monotonically_increasing_id()), "vectors")
    counts = kept.agg(F.count(F.lit(1)).alias("rows"), F.count_if("chosen").alias("anchors")).first()
    row_tiles = max(-(-counts["rows"] // TILE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    anchor_tiles = max(1, -(-counts["anchors"] // TILE_ANCHORS))
    rows, anchors = kept.drop("chosen"), kept.filter("chosen").drop("chosen")

    paired = _paired(rows, anchors, row_tiles, anchor_tiles)
    best = paired.groupBy("a", "r").applyInArrow(_positives(positives), "node long, positive_id long, positive_score long")
    first = Window.partitionBy("node").orderBy(F.desc("positive_score"), "positive_id")
    found = best.withColumn("k", F.row_number().over(first) - 1).filter(F.col("k") < positives)
    own = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("k", "positive_id", "positive_score"))).alias("own"))
    asked = written(anchors.join(own, "node"), "anchors").withColumn("positive_scores", F.col("own.positive_score"))

    paired = _paired(rows, asked.drop("own"), row_tiles, anchor_tiles)
    close = paired.groupBy("a", "r").applyInArrow(
        _negatives(negatives, positives, percent), "node long, k long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("node", "k").orderBy(F.desc("negative_score"), "negative_id")
    ranked = close.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = asked.select("node", F.col("vec_id").alias("anchor_id"), F.explode("own").alias("p"))
    named = named.select("node", "anchor_id", F.col("p.k").cast("long").alias("k"), "p.positive_id", "p.positive_score")
    return ranked.join(named, ["node", "k"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
