"""Clustering around centroids over integer vectors, with equal-average equal-variance search.

The centroids are sorted by the sum (mean) of their components. The search of a
vector starts where its own mean lies and goes outward, the nearer mean first.
A centroid is passed over, and with it all whose mean is further off, once the
difference of the means alone shows that it is no nearer than the best; one
with a near mean is passed over if the difference of the deviations from the
mean (the variance) shows it. Both bounds are rounded to the safe side; the
distances of what is left are exact integers, ties go to the smaller number.

A pass over the vectors sends on one row of sums per centroid and partition.
Only the centroids themselves (``clusters`` times the length) reach the driver
and are sent with the tasks, so the vectors are never shuffled.

Kept are vectors with exactly ``length`` components, none null or non-finite, and
so small that squared distances fit a long (scaled components below about
2**26.5 at 64). Others are not in the result. Repeated rows are vectors
of their own; starting centroids may then be equal, and the larger number stays
empty, as an empty centroid keeps its place. Equal hashes (one id
several times) are taken in the order of their components. A null id is
clustered but never a start. Fewer vectors than centroids give fewer
centroids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.integer_vectors import matrix, scaled, usable
from tideline.session import written

CLUSTERS = 40
ROUNDS = 5
LENGTH = 64
SCALE = 256
SEED = 2
ROWS_AT_ONCE = 8192


class Search:
    """The nearest of some centroids, by means and deviations first."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.centroids = centroids[self.number]
        self.sums = sums[self.number].astype(np.float64)
        self.length = centroids.shape[1]
        self.spread = self._deviation(self.centroids)

    def _deviation(self, x: np.ndarray) -> np.ndarray:
        """Length of what is left of each vector without its mean."""
        rest = x - x.mean(axis=1, keepdims=True)
        return np.sqrt((rest * rest).sum(axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row."""
        n, k = len(x), len(self.sums)
        own, spread = x.sum(axis=1).astype(np.float64), self._deviation(x)
        best, which = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        # What may still be nearer: rounding errors of the bounds stay well within the slack.
        limit = np.full(n, np.inf)
        above = np.searchsorted(self.sums, own)
        below = above - 1
        active = np.arange(n)
        while len(active):
            low, high = below[active], above[active]
            down = np.where(low >= 0, own[active] - self.sums[np.maximum(low, 0)], np.inf)
            up = np.where(high < k, self.sums[np.minimum(high, k - 1)] - own[active], np.inf)
            goes_down = down <= up
            gap = np.minimum(down, up)
            by_mean = gap * gap / self.length
            more = (gap < np.inf) & (by_mean <= limit[active])
            active, goes_down, by_mean = active[more], goes_down[more], by_mean[more]
            place = np.where(goes_down, below[active], above[active])
            below[active[goes_down]] -= 1
            above[active[~goes_down]] += 1
            by_both = by_mean + (spread[active] - self.spread[place]) ** 2
            near = by_both <= limit[active]
            row, place = active[near], place[near]
            rest = x[row] - self.centroids[place]
            distance, number = (rest * rest).sum(axis=1), self.number[place]
            better = (distance < best[row]) | ((distance == best[row]) & (number < which[row]))
            row = row[better]
            best[row], which[row] = distance[better], number[better]
            limit[row] = best[row] * (1 + 1e-9) + 1
        return which, best


def _chunks(batches: Iterable[pa.RecordBatch], length: int):
    for whole in batches:
        for i in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(i, ROWS_AT_ONCE)
            yield batch, matrix(batch.column("parts"), np.arange(batch.num_rows), length)


def _sums(centroids: list[list[int]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.array(centroids, np.int64)
        search, totals, counts = Search(start), np.zeros_like(start), np.zeros(len(start), np.int64)
        for _, x in _chunks(batches, start.shape[1]):
            which, _ = search.nearest(x)
            np.add.at(totals, which, x)
            counts += np.bincount(which, minlength=len(start))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used]), pa.array(totals[used].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    return run


def _assigned(centroids: list[list[int]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.array(centroids, np.int64)
        search = Search(start)
        for batch, x in _chunks(batches, start.shape[1]):
            which, distance = search.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(which, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return run


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every non-empty centroid at the floor of the mean of its vectors."""
    sums = kept.mapInArrow(_sums(centroids), "cluster long, n long, sums array<long>")
    totals = sums.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    found = [list(c) for c in centroids]
    for row in totals.collect():  # clusters times length rows
        found[row["cluster"]][row["d"]] = int(row["s"]) // row["n"]
    return found


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH, scale: float = SCALE, seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster`` and ``distance`` of each kept vector, and the final centroids.

    ``vectors`` has ``vec_id`` and ``embedding``. The vectors with the smallest SHA-256 of ``<seed>:<vec_id>``
    are the first centroids, in that order. The result is a written table.
    """
    fit = vectors.filter((F.size("embedding") == length) & usable("embedding", scale))
    kept = written(fit.select("vec_id", scaled("embedding", scale).alias("parts")), "vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.filter(F.col("vec_id").isNotNull()).select("parts", drawn.alias("h")).orderBy("h", "parts").limit(clusters)
    centroids = [row["parts"] for row in first.collect()]
    schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema), []
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    return written(kept.mapInArrow(_assigned(centroids), schema), "assigned"), centroids


def report(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The assignment with the inertia of its cluster and of all, and the digest of its centroid.

    A sum of distances that no long holds is null.
    """
    spark = assigned.sparkSession
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = {row["cluster"]: row["sum"] for row in per_cluster.collect()}  # one row per cluster
    whole = lambda s: int(s) if s is not None and s < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    rows = [(i, whole(sums.get(i)), whole(sum(sums.values())), digest(c)) for i, c in enumerate(centroids)]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
