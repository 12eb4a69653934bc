"""Hard negatives and centroid clustering beside brute force over odd vectors."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import centroids, hard_negatives, queries

COLUMNS = "vec_id long, embedding array<float>, label int, parts string, node int, chosen boolean, rank int, cluster int"


def vectors(n, length, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return rng.normal(scale=spread, size=(n, length)).astype(np.float32)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Ties, copies, repeated ids, other lengths, nulls, NaN, infinities, huge and empty vectors, clashing names."""
    x = vectors(320, 64, 1)
    x[40:80] = x[3]            # forty equal vectors
    x[100] = x[0]
    x[200] = -x[0]
    rows = [(i, x[i].tolist(), [i % 4, 7, 9][(i % 5 == 0) + (i % 11 == 0)]) for i in range(len(x))]
    rows += [rows[100], rows[0], (100, x[7].tolist(), 1)]
    rows += [(400, None, 1), (500, x[1].tolist(), None), (None, x[2].tolist(), 2), (600, [None, 1.0], 1), (700, [], 1), (701, [], 1), (702, [], 2)]
    rows += [(800, [float("nan")] + [0.0] * 63, 1), (801, [float("inf")] + [0.0] * 63, 1), (802, [3e38] * 64, 1), (803, [0.0] * 64, 1)]
    rows += [(900 + i, vectors(1, 5, i)[0].tolist(), i % 3) for i in range(20)] + [(1000, [1e6, -1.5e6, 0.5], 1), (1001, [1e6, -1.5e6, 0.4], 1), (1003, [9e5, -1.5e6, 0.5], 2)]
    return spark.createDataFrame([(*r, "p", 1, True, 2, 3) for r in rows], COLUMNS).repartition(3).cache()


def usable(row):
    e = row["embedding"]
    return e is not None and all(v is not None and math.isfinite(v) and abs(v) < 1e9 for v in e)


def integers(e):
    return [math.floor(256 * float(v)) for v in e]


def brute_negatives(rows):
    rows = [(r["vec_id"], r["label"], integers(r["embedding"])) for r in rows if r["vec_id"] is not None and r["label"] is not None and usable(r)]
    out = []
    for i, (a, label, x) in enumerate(rows):
        if a % 100:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), b, other) for j, (b, other, y) in enumerate(rows) if j != i and len(x) == len(y)]
        for score, b in sorted(((s, b) for s, b, other in scored if other == label), key=lambda t: (-t[0], t[1]))[:5]:
            close = sorted(((s, c) for s, c, other in scored if other != label and 80 * score <= 100 * s <= 100 * score), key=lambda t: (-t[0], t[1]))
            out += [(a, b, rank, c, score, s) for rank, (s, c) in enumerate(close[:5], 1)]
    return sorted(out)


def test_negatives_equal_brute_force(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 64)
    got = hard_negatives.mined(odd_vectors, F.col("vec_id") % 100 == 0).collect()
    want = brute_negatives(odd_vectors.collect())
    assert len(want) > 30 and sorted(tuple(r) for r in got) == want
    assert hard_negatives.mined(odd_vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("low, high, length", [(-100, 100, 64), (0, 1, 3), (-5, -1, 7), (-(1 << 26), 1 << 26, 64), (-(1 << 29), 1 << 29, 2), (0, 0, 4)])
def test_packed_products_are_exact(low, high, length):
    rng = np.random.default_rng(5)
    rows, anchors = rng.integers(low, high + 1, (37, length)), rng.integers(low, high + 1, (5, length))
    want = [[sum(int(p) * int(q) for p, q in zip(a, r)) for r in rows] for a in anchors]
    packed = hard_negatives.Packed(rows, anchors)
    assert packed.scores(anchors).tolist() == want
    if high <= 100:
        assert packed.doubles and packed.fields >= 2
    else:
        assert not packed.doubles


def test_first_takes_the_smaller_place_of_ties():
    scores = np.array([[5, 9, 9, 1, 9], [hard_negatives.NOTHING] * 4 + [2]])
    line, place = hard_negatives._first(scores, 2)
    assert list(zip(line.tolist(), place.tolist())) == [(0, 1), (0, 2), (1, 4)]


def brute_clusters(rows, clusters, rounds, length=64):
    kept = [(r["vec_id"], integers(r["embedding"])) for r in rows if usable(r) and len(r["embedding"]) == length]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), e) for i, e in kept if i is not None)[:clusters]
    middle = [e for _, e in first]

    def assign():
        return [min((sum((p - q) ** 2 for p, q in zip(e, c)), k) for k, c in enumerate(middle)) for _, e in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(middle)):
            own = [e for (_, e), (_, j) in zip(kept, found) if j == k]
            if own:
                middle[k] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    total, digest = sum(d for d, _ in found), [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    per = {k: sum(d for d, j in found if j == k) for k in range(len(middle))}
    return sorted(((i, k, d, per[k], total, digest[k]) for (i, _), (d, k) in zip(kept, found)), key=repr)


@pytest.mark.parametrize("clusters, rounds", [(40, 5), (3, 2), (1000, 1)])
def test_clusters_equal_brute_force(odd_vectors, clusters, rounds):
    got = centroids.report(*centroids.clustered(odd_vectors, clusters, rounds)).collect()
    want = brute_clusters(odd_vectors.collect(), clusters, rounds)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_clusters_of_nothing(odd_vectors):
    assigned, middle = centroids.clustered(odd_vectors.filter("vec_id < 0"))
    assert middle == [] and centroids.report(assigned, middle).count() == 0


def test_search_of_large_and_close_values():
    rng = random.Random(4)
    for size in (2, 100, 1 << 20, 1 << 25):
        middle = np.array([[rng.randint(-size, size) for _ in range(16)] for _ in range(60)], np.int64)
        middle[30] = middle[7]
        x = np.concatenate([middle + rng.randint(0, 1), np.array([[rng.randint(-size, size) for _ in range(16)] for _ in range(300)])])
        exact = ((x[:, None, :] - middle[None]) ** 2).sum(axis=2)
        which, distance = centroids.Search(middle).nearest(x)
        assert (which == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_bounds_pass_over_most_centroids(monkeypatch):
    """Centroids with means far apart are not compared."""
    middle = np.arange(100)[:, None] * np.full((1, 8), 1000)
    search, seen = centroids.Search(middle), []
    original = search.centroids.__getitem__
    x = middle[::-1] + 3
    class Watched(np.ndarray):
        def __getitem__(self, key):
            seen.append(np.size(key))
            return np.asarray(original(key))
    search.centroids = search.centroids.view(Watched)
    which, _ = search.nearest(x)
    assert which.tolist() == list(range(99, -1, -1)) and sum(seen) <= 3 * len(x)


def test_queries_run_on_whole_tables(spark, tables):
    n = spark.read.parquet(f"{tables}/embeddings.parquet").count()
    assert queries.op13_centroids(spark, tables).count() == n
    assert queries.op12_hard_negatives(spark, tables).count() > 0
