"""All pairs of vectors of one label with cosine of at least 0.98, by spherical-cap filters.

The unit sphere is covered by filter directions: every choice of one codeword
per block of coordinates (four blocks after a random rotation) is a direction,
and its inner product with a vector is the sum of four small ones. A vector
belongs to all directions whose inner product comes within ``SLACK`` of its
best one; they are listed by combining the two halves of the code, dropping
combinations that cannot reach the threshold. Vectors that share a direction
meet in its bucket and are verified in double precision, so no link below the
threshold is reported; two vectors at 0.98 share several directions (tests
compare with brute force).

Equal vectors are one row with a count. In a bucket, a pair is counted only at
the least direction both vectors have, so links are counted once without pairs
leaving the task; what leaves are link counts and, per vector, one edge to the
least vector of its group in the bucket. A bucket of more than ``TILE_ROWS``
vectors is cut into slices, each pair of slices a task of its own.

Vectors that are null, zero, or hold null or non-finite components, and rows
with null labels, link with nothing. Vectors of different lengths never link.
A null id takes part in links like any other and never is a component's id
unless the component has no other. Repeated rows link with each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.session import written

COSINE = 0.98
BLOCKS = 4
SLACK = 0.05
SEED = 7
TILE_ROWS = 1024
CODEWORDS = (8, 16, 32, 64, 128)


class Filters:
    """The random product code for vectors of one length."""

    def __init__(self, length: int, codewords: int):
        rng = np.random.default_rng([SEED, length, codewords])
        padded = -(-length // BLOCKS) * BLOCKS
        self.rotation = np.linalg.qr(rng.normal(size=(padded, padded)))[0][:length]
        code = rng.normal(size=(BLOCKS, codewords, padded // BLOCKS))
        self.code = code / np.linalg.norm(code, axis=2, keepdims=True) / np.sqrt(BLOCKS)
        self.width, self.codewords = padded // BLOCKS, codewords

    def directions(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) for each direction within the slack of the row's best. Rows are treated alike in any batch."""
        turned = (unit[:, :, None] * self.rotation[None]).sum(axis=1)
        parts = [
            (turned[:, None, b * self.width:(b + 1) * self.width] * self.code[b][None]).sum(axis=2) for b in range(BLOCKS)
        ]
        n = len(unit)
        left = (parts[0][:, :, None] + parts[1][:, None, :]).reshape(n, -1)
        right = (parts[2][:, :, None] + parts[3][:, None, :]).reshape(n, -1)
        top_left, top_right = left.max(axis=1), right.max(axis=1)
        least = top_left + top_right - SLACK
        row_l, half_l = np.nonzero(left >= (least - top_right)[:, None])
        row_r, half_r = np.nonzero(right >= (least - top_left)[:, None])
        count_r = np.bincount(row_r, minlength=n)
        first_r = np.cumsum(count_r) - count_r
        # Every kept left half with every kept right half of its row.
        repeat = count_r[row_l]
        row = np.repeat(row_l, repeat)
        at = np.repeat(first_r[row_l] - (np.cumsum(repeat) - repeat), repeat) + np.arange(len(row))
        a, b = np.repeat(half_l, repeat), half_r[at]
        good = left[row, a] + right[row, b] >= least[row]
        return row[good], a[good].astype(np.int64) * self.codewords ** 2 + b[good]


def _unit(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows in double precision, their lengths, and the numbers before each row in the flat array."""
    sizes = np.diff(np.asarray(vectors.offsets)).astype(np.int64)
    return np.asarray(vectors.flatten()).astype(np.float64), sizes, np.cumsum(sizes) - sizes


def _rows_of_length(flat, sizes, first, length) -> tuple[np.ndarray, np.ndarray]:
    rows = np.flatnonzero(sizes == length)
    x = flat[first[rows][:, None] + np.arange(length)]
    return rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _listed(codewords: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, Filters] = {}
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                flat, sizes, first = _unit(batch.column("embedding"))
                for length in np.unique(sizes).tolist():
                    code = filters.setdefault(length, Filters(length, codewords))
                    rows, unit = _rows_of_length(flat, sizes, first, length)
                    row, direction = code.directions(unit)
                    taken = batch.take(pa.array(rows[row]))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(direction)], [*taken.schema.names, "direction"])

    return run


def _verified(codewords: int, cosine: float):
    """Rows sorted by bucket: per bucket, link counts and edges of its vectors."""
    filters: dict[int, Filters] = {}

    def solved(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        flat, sizes, first = _unit(batch.column("embedding"))
        length = int(sizes[0])
        _, x = _rows_of_length(flat, sizes, first, length)
        side, copies = np.asarray(batch.column("side")), np.asarray(batch.column("copies"))
        node = np.asarray(batch.column("node"))
        direction = int(batch.column("direction")[0].as_py())
        near = np.triu(x @ x.T >= cosine - 1e-9, 1)
        # Across the slices of a task, or within one slice that is a task of its own.
        near &= (side[:, None] != side[None, :]) | ((side[:, None] == 2) & (side[None, :] == 2))
        i, j = np.nonzero(near)
        if not len(i):
            return None
        exact = (x[i] * x[j]).sum(axis=1) >= cosine
        i, j = i[exact], j[exact]
        if not len(i):
            return None
        code = filters.setdefault(length, Filters(length, codewords))
        touched = np.unique(np.r_[i, j])
        row, found = code.directions(x[touched])
        earlier = found < direction
        before = [set() for _ in touched]
        for r, d in zip(row[earlier].tolist(), found[earlier].tolist()):
            before[r].add(d)
        place = {t: k for k, t in enumerate(touched.tolist())}
        own = np.array([before[place[a]].isdisjoint(before[place[b]]) for a, b in zip(i.tolist(), j.tolist())])
        i, j = i[own], j[own]
        if not len(i):
            return None
        links = np.zeros(len(x), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = node.copy()
        while True:  # least node of each group within the bucket
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            if (new == root).all():
                break
            root = new
        linked = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[linked]), pa.array(root[linked]), pa.array(links[linked])], ["node", "root", "links"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            buckets = np.asarray(batch.column("bucket"))
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and held[-1].column("bucket")[0].as_py() != buckets[lo]:
                    yield from close(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from close(held)

    def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        if rows.num_rows > 1 and (out := solved(rows)) is not None:
            yield out

    return run


def linked(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each row."""
    spark = vectors.sparkSession
    as_double = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.aggregate(as_double, F.lit(0.0), lambda acc, x: acc + x * x)
    usable = F.coalesce(
        F.col("label").isNotNull() & F.forall("embedding", lambda x: x.isNotNull()) & (norm > 0) & (norm < F.lit(float("inf"))) & ~F.isnan(norm),
        F.lit(False),
    )
    marked = vectors.select("vec_id", "label", "embedding", usable.alias("usable"))
    group = F.sha2(F.concat_ws("/", F.col("label").cast("string"), F.to_json(F.struct("embedding"))), 256)
    keyed = marked.withColumn("group", F.when(F.col("usable"), group))
    # One row per distinct vector; its node number is drawn once and kept by writing it.
    distinct = keyed.filter("usable").groupBy("group").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    total = distinct.count()
    codewords = next((b for b in CODEWORDS if b ** BLOCKS >= total), CODEWORDS[-1])
    listed = distinct.select("node", "label", "copies", "embedding").mapInArrow(
        _listed(codewords), "node long, label {0}, copies long, embedding {1}, direction long".format(
            vectors.schema["label"].dataType.simpleString(), vectors.schema["embedding"].dataType.simpleString()
        )
    ).withColumn("cell", F.xxhash64("label", F.size("embedding"), "direction"))
    listed = written(listed, "directions")
    sizes = listed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = written(sizes.select("cell", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("slices")), "cells")
    crowded = listed.join(sizes, "cell").withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    tasks = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda o: F.struct(
        F.least(o, F.col("slice")).alias("a"), F.greatest(o, F.col("slice")).alias("b")
    ))
    dealt = crowded.withColumn("t", F.explode(tasks)).select(
        # The label and the length keep cells apart whose hashes collide.
        F.xxhash64("label", F.size("embedding"), "direction", "t.a", "t.b").alias("bucket"), "node", "copies", "embedding", "direction",
        F.when(F.col("t.a") == F.col("t.b"), 2).when(F.col("slice") == F.col("t.a"), 0).otherwise(1).alias("side"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(
        dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "direction")
        .mapInArrow(_verified(codewords, cosine), "node long, root long, links long"), "links"
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))).select(F.col("u").alias("node"), "root")
    placed = distinct.select("node", "group", "least_id", "copies").join(links, "node", "left").join(rooted, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_group = written(placed.join(least, "root").select(
        "group", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    ), "groups")
    joined = keyed.select("vec_id", "group").join(by_group, "group", "left")
    component = F.when(F.col("group").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
