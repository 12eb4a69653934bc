"""Compaction of the small files of a Parquet folder; large ones are not touched.

Files are listed with their sizes and the small ones of each folder are packed
into bins of about the target size. One job writes a file per bin beside the
table, in a folder that readers skip. A journal then says which files go and
where the new ones belong; the swap follows it. If it stops half-way, the next
call (or ``recover``) completes it, so no row is lost or doubled. While the
swap runs a reader may miss rows of that folder: compact while nobody reads, or
use ``snapshots`` or ``zones`` where that cannot be.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 256 * 1024 * 1024
#: Files below this share of the target are small.
SMALL_SHARE = 0.75
_WORK, _PLAN, _BIN = "_compacting", "plan.json", "__bin"


@dataclass(frozen=True)
class DataFile:
    path: str
    folder: str
    size: int
    uri: str = ""


def _open(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def data_files(spark: SparkSession, path: str) -> list[DataFile]:
    """The files that a reader of ``path`` sees, in its folders and theirs."""
    start, fs = _open(spark, path)
    found, folders = [], [start]
    while folders:
        folder = folders.pop()
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                folders.append(status.getPath())
            else:
                found.append(DataFile(status.getPath().toString(), folder.toString(), status.getLen(), status.getPath().toUri().toString()))
    return sorted(found, key=lambda f: f.path)


def bins(files: Sequence[DataFile], target: int = TARGET_BYTES, small_share: float = SMALL_SHARE) -> list[list[DataFile]]:
    """Groups of small files of one folder that fill the target, the largest first into the first bin with room.

    A group of one file is left out: rewriting it would change nothing.
    """
    by_folder: dict[str, list[list[DataFile]]] = {}
    room: dict[str, list[int]] = {}
    for f in sorted(files, key=lambda f: (-f.size, f.path)):
        if f.size >= small_share * target:
            continue
        groups, left = by_folder.setdefault(f.folder, []), room.setdefault(f.folder, [])
        place = next((i for i, free in enumerate(left) if free >= f.size), None)
        if place is None:
            groups.append([f])
            left.append(target - f.size)
        else:
            groups[place].append(f)
            left[place] -= f.size
    return [g for groups in by_folder.values() for g in groups if len(g) > 1]


def _spelled(path: Column) -> Column:
    """Paths of the local file system are written with one or with three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _rewritten(spark: SparkSession, groups: list[list[DataFile]]) -> DataFrame:
    listed = [(f.uri, i) for i, group in enumerate(groups) for f in group]
    # As many rows as files in the listing, which the driver holds anyway.
    owner = spark.createDataFrame(listed, f"__path string, {_BIN} int").withColumn("__path", _spelled(F.col("__path")))
    rows = spark.read.option("mergeSchema", True).parquet(*[f.path for group in groups for f in group])
    placed = rows.select("*", _spelled(F.col("_metadata.file_path")).alias("__path")).join(F.broadcast(owner), "__path")
    return placed.drop("__path").repartition(len(groups), _BIN)


def compact(spark: SparkSession, path: str, target: int = TARGET_BYTES, small_share: float = SMALL_SHARE) -> int:
    """Rewrite the small files below ``path`` as few of about ``target`` bytes; returns how many were replaced."""
    recover(spark, path)
    groups = bins(data_files(spark, path), target, small_share)
    if not groups:
        return 0
    work = f"{path.rstrip('/')}/{_WORK}"
    _rewritten(spark, groups).write.mode("overwrite").partitionBy(_BIN).parquet(f"{work}/new")
    moves = []
    for i, group in enumerate(groups):
        for f in data_files(spark, f"{work}/new/{_BIN}={i}"):
            moves.append([f.path, f"{group[0].folder}/part-{i:05d}-{uuid.uuid4()}.parquet"])
    draft, fs = _open(spark, f"{work}/{_PLAN}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps({"gone": [f.path for g in groups for f in g], "moves": moves}).encode()))
    stream.close()
    fs.rename(draft, _open(spark, f"{work}/{_PLAN}")[0])
    recover(spark, path)
    return sum(map(len, groups))


def recover(spark: SparkSession, path: str) -> bool:
    """Complete a compaction that has a journal, forget one that has none; whether there was a journal."""
    work, fs = _open(spark, f"{path.rstrip('/')}/{_WORK}")
    plan, _ = _open(spark, f"{path.rstrip('/')}/{_WORK}/{_PLAN}")
    journal = fs.exists(plan)
    if journal:
        stream = fs.open(plan)
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        at = spark._jvm.org.apache.hadoop.fs.Path
        for gone in found["gone"]:
            fs.delete(at(gone), False)
        for source, target in found["moves"]:
            if fs.exists(at(source)):
                fs.rename(at(source), at(target))
    fs.delete(work, True)
    return journal
