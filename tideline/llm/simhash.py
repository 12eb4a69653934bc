"""SimHash fingerprints and all pairs of them within a small Hamming distance.

Fingerprints with the same bits meet first (one row per fingerprint from there
on, so a group of copies is one row). Two that differ in at most three of 64
bits agree on at least two of five blocks, so each fingerprint is listed under
its ten pairs of blocks. In a bucket the bit planes are stored vertically: one
64-bit word holds one bit of up to 64 fingerprints. A member is compared with
all 64 of a tile at once by adding the 64 difference bits with carry-save
counters; tiles in which every lane has exceeded the radius are given up early.
A bucket of more than ``TILE_ROWS`` fingerprints is cut into slices, and each
pair of slices is a task of its own, whatever the bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.text import as_bytes, free_name, pieces
from tideline.llm.workers import start_lean
from tideline.session import written

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Five blocks of the 64 bits: with three bits changed, two blocks are untouched.
BLOCKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
TILE_ROWS = 4096
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_SHINGLES_AT_ONCE = 1 << 16


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes) -> int:
    """The 64 majority bits of a text; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    spelled, width = b" ".join(words), min(SHINGLE, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    begin = starts[: len(words) - width + 1].tolist()
    end = (starts + lengths)[width - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(begin), _SHINGLES_AT_ONCE):
        counts += _bit_counts([
            digest(spelled[a:b], SEED) for a, b in zip(begin[i:i + _SHINGLES_AT_ONCE], end[i:i + _SHINGLES_AT_ONCE])
        ])
    return int(np.packbits(2 * counts > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` without its text, with the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_lean()
        for batch in pieces(batches, text):
            prints = np.array([fingerprint(t) for t in as_bytes(batch.column(text))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(prints)], [*kept, name])

    schema = docs.select(*kept).schema.add(name, "long")
    return docs.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def _block(low: int, high: int):
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def near_pairs(prints: np.ndarray, keys: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of equal key within the radius. ``keys`` is sorted."""
    n = len(prints)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[first, n])
    place = np.arange(n) - np.repeat(first, sizes)
    # A tile is up to 64 neighbours of one key; each of its planes is one word.
    tiles = np.cumsum(place % 64 == 0) - 1
    tile_first = np.flatnonzero(place % 64 == 0)
    lanes = (place % 64).astype(np.uint64)
    planes = [np.bitwise_or.reduceat(((prints >> np.uint64(j)) & np.uint64(1)) << lanes, tile_first) for j in range(64)]
    tile_size = np.diff(np.r_[tile_first, n])
    last_tile = np.repeat(tiles[np.r_[first[1:], n] - 1], sizes)
    found_i, found_j = [], []
    # Member i meets its own tile and the later ones of its key.
    counts = last_tile - tiles + 1
    step, at = 1 << 17, 0
    ends = np.cumsum(counts)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, side="right")))
        member = np.repeat(np.arange(at, stop), counts[at:stop])
        before = np.cumsum(counts[at:stop]) - counts[at:stop]
        tile = np.repeat(tiles[at:stop] - before, counts[at:stop]) + np.arange(len(member))
        member, tile, over = _compare(prints, planes, member, tile, tile_size, radius)
        lane_bits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(lane_bits)
        i, j = member[row], tile_first[tile[row]] + lane
        later = j > i
        found_i.append(i[later])
        found_j.append(j[later])
        at = stop
    return np.concatenate(found_i), np.concatenate(found_j)


def _compare(prints, planes, member, tile, tile_size, radius):
    """Saturating counts of differing bits, four planes at a time; ``over`` has a bit per lane beyond the radius."""
    short = tile_size[tile] < 64
    over = np.where(short, _ALL << np.minimum(tile_size[tile], 63).astype(np.uint64), np.uint64(0))
    ones, twos = np.zeros(len(member), np.uint64), np.zeros(len(member), np.uint64)
    fours = np.zeros(len(member), np.uint64)
    own = prints[member]
    for j in range(64):
        # 0 - bit is all ones or all zeros: the member's bit in every lane.
        differs = planes[j][tile] ^ (np.uint64(0) - ((own >> np.uint64(j)) & np.uint64(1)))
        carry = ones & differs
        ones ^= differs
        carry, twos = twos & carry, twos ^ carry
        fours |= carry
        # The counter holds 0 to 3 and "4 or more".
        if radius >= 3:
            over |= fours
        else:
            over |= fours | (twos & ones if radius == 2 else twos if radius == 1 else twos | ones)
        if j % 8 == 7:
            alive = over != _ALL
            if not alive.all():
                member, tile, over, own = member[alive], tile[alive], over[alive], own[alive]
                ones, twos, fours = ones[alive], twos[alive], fours[alive]
                if not len(member):
                    break
    return member, tile, over


def least_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index that each of ``n`` reaches over the links (i, j)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of sorted rows (bucket, side, fp): from each fingerprint one to the first of its group there."""

    def solved(key: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        i, j = near_pairs(fp, key)
        # In a task of two slices only pairs across them count; within a slice its own task counts.
        cross = side[i] != side[j]
        alone = (side[i] == 2) & (side[j] == 2)
        root = least_linked(len(fp), i[cross | alone], j[cross | alone])
        linked = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))], ["u", "v"]
        )

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(np.asarray(batch.column(c)) for c in ("bucket", "fp", "side")))
        rows += batch.num_rows
        if rows >= 1 << 16:
            key, fp, side = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield solved(key[:cut], fp[:cut].view(np.uint64), side[:cut])
            held, rows = [(key[cut:], fp[cut:], side[cut:])], len(key) - cut
    if rows:
        key, fp, side = (np.concatenate(x) for x in zip(*held))
        yield solved(key, fp.view(np.uint64), side)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """``(u, v)`` of fingerprints that are connected by links within the radius, at most one per fingerprint and
    bucket: the links of a bucket themselves do not leave it. From a frame of distinct ``fp``."""
    keys = [
        F.xxhash64(F.lit(a * 8 + b), _block(*BLOCKS[a]), _block(*BLOCKS[b]))
        for a in range(len(BLOCKS)) for b in range(a + 1, len(BLOCKS))
    ]
    listed = distinct.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    sizes = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = written(sizes.withColumn("slices", F.ceil(F.col("n") / TILE_ROWS).cast("int")), "buckets")
    crowded = listed.join(sizes, "bucket").withColumn("slice", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
    # Slices (a, b) with a <= b are one task; a slice is alone in (a, a), where side 2 says so.
    tasks = F.when(F.col("slices") == 1, F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda o: F.struct(
            F.least(o, F.col("slice")).alias("a"), F.greatest(o, F.col("slice")).alias("b")
        ))
    )
    dealt = crowded.select("fp", "bucket", "slice", F.explode(tasks).alias("t")).select(
        F.xxhash64("bucket", "t.a", "t.b").alias("bucket"), "fp",
        F.when(F.col("t.a") == F.col("t.b"), F.lit(2)).when(F.col("slice") == F.col("t.a"), F.lit(0)).otherwise(F.lit(1)).alias("side"),
    )
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_links, "u long, v long")


def _placed(distinct: DataFrame) -> DataFrame:
    """``distinct``, a row per fingerprint, with the ``root`` of its group."""
    rooted = components(fingerprint_links(distinct.select("fp"))).select(F.col("u").alias("fp"), "root")
    return distinct.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def grouped(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for each row of ``docs``.

    Empty and null texts have fingerprint 0 and link like any other. Null ids
    never become a component's id unless the component has no other.
    """
    prints = written(fingerprints(docs.select("doc_id", F.col(text).alias("text"))), "fingerprints")
    placed = _placed(written(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_print = written(placed.join(least, "root").select("fp", "root", "component_id"), "components")
    return prints.join(by_print, "fp").select("doc_id", "fp", "root", "component_id")


def one_per_group(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of each group: the one with the least id, null ids last; of equal ids the text with the least digest.

    Neither ids nor null ids need to be unique: a row is known by its id and its
    text, and a text belongs to one group only. Rows equal in both are one.
    """
    digest = F.unhex(F.md5(F.col(text).cast("string").cast("binary")))
    prints = fingerprints(docs.select("doc_id", digest.alias("digest"), F.col(text).alias("text")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first")
    distinct = written(prints.groupBy("fp").agg(first), "distinct")
    key = free_name(docs, "row_key")
    kept = _placed(distinct).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(_row_key(F.col("first.doc_id"), F.col("first.digest")).alias(key))
    # One key without nulls: the join and the choice among equal rows need one and the same shuffle.
    keyed = docs.withColumn(key, _row_key(F.col("doc_id"), digest))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def _row_key(doc_id: Column, digest: Column) -> Column:
    """What stands for a row: its id and its text, in which null is unlike any value."""
    named = F.when(doc_id.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), doc_id.cast("string")))
    return F.unhex(F.md5(F.concat(F.coalesce(F.hex(digest), F.lit("-")), named).cast("binary")))
