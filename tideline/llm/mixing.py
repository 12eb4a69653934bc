"""Mixing sources to target sizes by balanced sampling with the cube method.

Sources get shares of the corpus by weight; a source that would need more than
``MOST_COPIES`` times its words stops there and the others share the rest. A
document of a source with rate 2.3 is taken twice and once more with
probability 0.3. Which ones are taken once more is not drawn independently:
the vector of probabilities moves through the null space of the constraints
(words and documents of the source stay as they are) until entries become 0 or
1. Three open documents always leave one direction to move in, so a stream of
documents is settled holding three at a time. Each bucket of a source runs its
own flight and leaves a few open documents; those fly again per source, and
what is open then is the landing, rounded with little error in words.

Random choices come from hashes of source and bucket, rows of a bucket are in
a fixed order: reruns agree. Some documents of each source are held back to the
end, to make up for what the last roundings miss. A null text has size 0, a null source is a source
of its own and comes last, repeated rows are separate documents, an empty table
gives an empty result. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.ranking import numbered
from tideline.llm.text import free_name, words_of
from tideline.session import written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BUCKET_ROWS = 5_000
KEPT_OPEN = 64
MENDING_ROUNDS = 20
_EDGE = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sizes`` (one row per ``source`` with ``source_size``) with ``target``: shares by weight, capped, excess reshared."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = written(numbered(sizes, F.asc_nulls_last("source")).withColumn("weight", weight).drop("rank"), "sources")
    level, capped = None, -1
    while True:  # each round caps at least one more source; what reaches the driver is one row of sums
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= most * F.col("source_size")
        row = weighted.agg(
            F.sum("source_size").alias("all"), F.count_if(full).alias("capped"),
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0)).alias("fixed"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        level, before, capped = (row["all"] - row["fixed"]) / row["open"], capped, row["capped"]
        if capped == before:
            break
    share = F.least(F.col("weight") * F.lit(float(level or 0)), (most * F.col("source_size")).cast("double"))
    return weighted.withColumn("target", share).drop("weight")


class Flight:
    """Moves probabilities of (key, size, p) to 0 or 1, keeping the sums of p and of p * size."""

    def __init__(self, seed: str, kept_open: int = KEPT_OPEN):
        self.kept_open = kept_open
        self.random = random.Random(int.from_bytes(hashlib.blake2b(seed.encode(), digest_size=8).digest(), "little"))
        self.open: list[list] = []
        self.waiting: deque[list] = deque()

    def add(self, key, size: float, p: float) -> list[tuple[object, int]]:
        """Units come in any fixed order. The last ``kept_open`` are held back for the landing."""
        if p <= _EDGE or p >= 1 - _EDGE:
            return [(key, round(p))]
        self.waiting.append([key, size, p])
        if len(self.waiting) <= self.kept_open:
            return []
        self.open.append(self.waiting.popleft())
        settled = []
        while len(self.open) == 3:
            settled += self._move()
        return settled

    def left(self) -> list[list]:
        """What is open at the end: at most two that flew, then those held back."""
        self.open += self.waiting
        self.waiting.clear()
        return self.open

    def _move(self) -> list[tuple[object, int]]:
        a, b, c = self.open
        u = (b[1] - c[1], c[1] - a[1], a[1] - b[1])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = min((1 - x[2]) / d if d > 0 else -x[2] / d for x, d in zip(self.open, u) if d)
        down = min(x[2] / d if d > 0 else (x[2] - 1) / d for x, d in zip(self.open, u) if d)
        step = up if self.random.random() * (up + down) < down else -down
        for x, d in zip(self.open, u):
            x[2] += step * d
        settled = [(x[0], round(x[2])) for x in self.open if x[2] <= _EDGE or x[2] >= 1 - _EDGE]
        self.open = [x for x in self.open if _EDGE < x[2] < 1 - _EDGE]
        if not settled:  # rounding: the entry nearest to an end is there
            x = min(self.open, key=lambda x: min(x[2], 1 - x[2]))
            self.open.remove(x)
            settled = [(x[0], round(x[2]))]
        return settled

    def land(self) -> list[tuple[object, int]]:
        """Fly what was held back as well, round the last two, then mend the words that the rounding misses.

        Mending flips one or two of those held back at a time while that brings the words nearer to
        what is due; the document total may move by a few.
        """
        pool, due = list(self.waiting), sum(x[1] * x[2] for x in [*self.open, *self.waiting])
        sizes = {x[0]: x[1] for x in [*self.open, *self.waiting]}
        self.waiting.clear()
        settled: list = []
        for x in pool:
            self.open.append(x)
            while len(self.open) == 3:
                settled += self._move()
        words = sum(v * sizes[k] for k, v in settled)
        rest = self.open
        best = min(itertools.product((0, 1), repeat=len(rest)), key=lambda c: (abs(words + sum(v * x[1] for v, x in zip(c, rest)) - due), c))
        value = dict([*settled, *((x[0], v) for x, v in zip(rest, best))])
        self.open = []
        keys = [x[0] for x in pool]
        size = np.array([sizes[k] for k in keys], float)
        error = sum(v * sizes[k] for k, v in value.items()) - due
        for _ in range(MENDING_ROUNDS if keys else 0):
            change = np.array([1 - 2 * value[k] for k in keys]) * size
            after = np.abs(error + change[:, None] + change[None, :])
            np.fill_diagonal(after, np.abs(error + change))
            i, j = divmod(int(after.argmin()), len(keys))
            if after[i, j] >= abs(error) - 1e-6:
                break
            for k in {i, j}:
                error += change[k]
                value[keys[k]] = 1 - value[keys[k]]
        return list(value.items())


def _flights(source: str, size: str, p: str, bucket: str, extra: str, slot: str):
    """Rows sorted by source and bucket: each gets ``extra`` 0 or 1, or its open probability and a ``slot``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, flight, held = None, None, {}

        def closing():
            for place, (key, _, value) in enumerate(flight.left() if flight else []):
                yield _one(held.pop(key), value, place)

        def _one(row: pa.RecordBatch, value: float, place: int | None):
            return _with(row, [float(value)], [place])

        def _with(rows: pa.RecordBatch, values, places):
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(values, pa.float64()), pa.array(places, pa.int32())], [*rows.schema.names, extra, slot]
            )

        number = 0
        for batch in batches:
            values: list = [None] * batch.num_rows
            rows = zip(*(batch.column(c).to_pylist() for c in (source, bucket, size, p)))
            first = number
            for i, (s, b, n, chance) in enumerate(rows):
                if (s, b) != current:
                    for place, (key, _, open_p) in enumerate(flight.left() if flight else []):
                        if key >= first:
                            values[key - first] = (open_p, place)
                        else:
                            yield _one(held.pop(key), open_p, place)
                    current, flight = (s, b), Flight(f"{s!r}/{b}", 0 if b else KEPT_OPEN)
                for key, value in flight.add(number, n, chance):
                    if key >= first:
                        values[key - first] = (value, None)
                    else:
                        yield _one(held.pop(key), value, None)
                number += 1
            done = [i for i, v in enumerate(values) if v is not None]
            for i, v in enumerate(values):
                if v is None:
                    held[first + i] = batch.slice(i, 1)
            if done:
                yield _with(batch.take(pa.array(done)), [float(values[i][0]) for i in done], [values[i][1] for i in done])
        yield from closing()

    return run


def _landing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open rows sorted by source: fly again per source, then land."""
    current, flight = None, None

    def out(settled):
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k, _ in settled], pa.string()), pa.array([k[1] for k, _ in settled], pa.int32()),
            pa.array([k[2] for k, _ in settled], pa.int32()), pa.array([v for _, v in settled], pa.float64()),
        ], ["l_source", "l_bucket", "l_slot", "l_extra"])

    for batch in batches:
        settled = []
        for s, b, place, n, value in zip(*(batch.column(c).to_pylist() for c in ("source", "bucket", "slot", "size", "extra"))):
            if flight is None or s != current:
                settled += flight.land() if flight else []
                current, flight = s, Flight(f"{s!r}")
            settled += flight.add((s, b, place), n, value)
        yield out(settled)
    if flight:
        yield out(flight.land())


def mixed(docs: DataFrame, text: str = "text", source: str = "source", size: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Each row of ``docs`` with its size, its source's size and target, and the number of copies the mix takes.

    ``size`` names a column that already holds the size; without it the words of ``text`` are counted. Also returns the names of these columns (``docs`` may have some of them already).
    """
    names = {n: free_name(docs, n) for n in ("size", "source_size", "target", "copies", "chance", "whole", "bucket", "extra", "slot", "order")}
    spark = docs.sparkSession
    sized = docs.withColumn(names["size"], F.col(size) if size else F.size(words_of(text)).cast("long"))
    stats = sized.groupBy(F.col(source).alias("source")).agg(F.sum(names["size"]).alias("source_size"), F.count(F.lit(1)).alias("n"))
    rated = written(targets(stats), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST_COPIES)), F.col("target") / F.col("source_size"))).otherwise(F.lit(1.0))
    rated = rated.select(
        F.col("source").alias("r_source"), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"]),
        F.floor(rate).cast("int").alias(names["whole"]), (rate - F.floor(rate)).alias(names["chance"]),
        F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("r_buckets"),
    )
    told = [c for c in ("doc_id", text) if c in docs.columns]
    order = F.xxhash64(*told, names["size"])
    joined = sized.join(rated, F.col(source).eqNullSafe(F.col("r_source"))).withColumn(names["order"], order)
    dealt = joined.withColumn(names["bucket"], F.pmod(names["order"], F.col("r_buckets")).cast("int")).drop("r_source", "r_buckets")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = (source, names["bucket"])
    sorted_rows = dealt.repartition(parts, *keys).sortWithinPartitions(*keys, names["order"], *told[:1], names["size"])
    schema = T.StructType([*sorted_rows.schema.fields, T.StructField(names["extra"], T.DoubleType()), T.StructField(names["slot"], T.IntegerType())])
    flown = written(sorted_rows.mapInArrow(
        _flights(source, names["size"], names["chance"], names["bucket"], names["extra"], names["slot"]), schema
    ), "flown")
    still_open = flown.filter(F.col(names["slot"]).isNotNull())
    # Two rows of each bucket and those that the first bucket holds back: the landing of a source stays small.
    narrow = still_open.select(
        F.col(source).cast("string").alias("source"), *[F.col(names[n]).alias(n) for n in ("bucket", "slot", "size", "extra")]
    ).repartition(parts, "source").sortWithinPartitions("source", F.desc("bucket"), "slot")  # those held back come last
    landed = written(narrow.mapInArrow(_landing, "l_source string, l_bucket int, l_slot int, l_extra double"), "landed")
    on = (
        F.col(source).cast("string").eqNullSafe(F.col("l_source"))
        & (F.col(names["bucket"]) == F.col("l_bucket")) & (F.col(names["slot"]) == F.col("l_slot"))
    )
    rounded = still_open.join(landed, on).withColumn(names["extra"], F.col("l_extra")).select(*flown.columns)
    settled = flown.filter(F.col(names["slot"]).isNull()).unionByName(rounded)
    copies = (F.col(names["whole"]) + F.col(names["extra"]).cast("int")).alias(names["copies"])
    return settled.select(*docs.columns, names["size"], names["source_size"], names["target"], copies), names


def repeated(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns it came with."""
    rows, names = mixed(docs, text, source)
    copy = free_name(docs, "copy")
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(names["copies"])))).select(*docs.columns)
