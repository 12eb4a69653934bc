"""Tables of several zones whose parts change one by one, published by one pointer.

``<root>/run=<n>/zone=<z>/part=<p>/`` holds files that run ``n`` wrote once and
nobody changes. ``<root>/pointer-<n>.json`` lists the folders that make up the
table after run ``n``. A run writes its folders first and its pointer last (by
renaming it into place), so readers see all of it or nothing, and parts that it
leaves alone keep their files. A failed run has no pointer; its number is used
again and its folders are overwritten. One writer at a time is assumed. The
pointer has an entry per part and folder, which bounds it by the parts and
``MOST_FOLDERS``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.ordered import null_safe
from tideline.operators.partitions import balanced

ZONE, PART, GONE = "zone", "part", "gone"
#: A part of this many folders is written again as one by the next run that adds to it.
MOST_FOLDERS = 16
_POINTER = re.compile(r"^pointer-(\d{9})\.json$")


@dataclass
class Layout:
    """The folders of a table, ``{zone: {part: runs}}``, and what was noted beside them."""

    folders: dict[str, dict[int, list[int]]] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

    def parts(self, zone: str) -> dict[int, list[int]]:
        return self.folders.setdefault(zone, {})

    def crowded(self, zone: str) -> set[int]:
        return {p for p, runs in self.parts(zone).items() if len(runs) >= MOST_FOLDERS}

    def note_schema(self, zone: str, schema: T.StructType) -> None:
        self.notes[f"schema of {zone}"] = schema.json()

    def schema(self, zone: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.notes[f"schema of {zone}"]))


def _files(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def runs(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published runs whose pointer is still there, oldest first."""
    return sorted(int(m.group(1)) for m in map(_POINTER.match, _names(spark, root)) if m)


def exists(spark: SparkSession, root: str) -> bool:
    return bool(runs(spark, root))


def next_run(spark: SparkSession, root: str) -> int:
    """One more than the run that was published last."""
    known = runs(spark, root)
    return known[-1] + 1 if known else 1


def _pointer(root: str, run: int) -> str:
    return f"{root.rstrip('/')}/pointer-{run:09d}.json"


def layout_of(spark: SparkSession, root: str, run: int) -> Layout:
    path, fs = _files(spark, _pointer(root, run))
    stream = fs.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Layout({z: {int(p): list(r) for p, r in parts.items()} for z, parts in found["folders"].items()}, found["notes"])


def current(spark: SparkSession, root: str) -> Layout:
    """The published layout; an empty one before the first run."""
    known = runs(spark, root)
    return layout_of(spark, root, known[-1]) if known else Layout()


def publish(spark: SparkSession, root: str, run: int, layout: Layout) -> int:
    """Make ``layout`` the content of the table."""
    target, fs = _files(spark, _pointer(root, run))
    draft, _ = _files(spark, _pointer(root, run) + ".draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps({"folders": layout.folders, "notes": layout.notes}).encode()))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        raise FileExistsError(f"run {run} of {root} was published by somebody else")
    return run


def write(spark: SparkSession, root: str, run: int, rows: DataFrame, max_records_per_file: int = 0) -> dict[str, set[int]]:
    """Write ``rows``, which have the columns ``zone`` and ``part``, as folders of ``run``; the parts that got any, by zone.

    Large parts are several files. What a failed run of this number has left in these zones goes.
    """
    path = f"{root.rstrip('/')}/run={run}"
    staged = f"{path}/_new-{uuid.uuid4().hex}"
    writer = balanced(rows, ZONE, PART).write.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(ZONE, PART).parquet(staged)
    written = {}
    for name in (n for n in _names(spark, staged) if n.startswith(f"{ZONE}=")):
        target, fs = _files(spark, f"{path}/{name}")
        fs.delete(target, True)
        fs.rename(_files(spark, f"{staged}/{name}")[0], target)
        parts = [n for n in _names(spark, f"{path}/{name}") if n.startswith(f"{PART}=")]
        written[name.removeprefix(f"{ZONE}=")] = {int(n.removeprefix(f"{PART}=")) for n in parts}
    folder, fs = _files(spark, staged)
    fs.delete(folder, True)
    return written


def _folder(root: str, zone: str, part: int, run: int) -> str:
    return f"{root.rstrip('/')}/run={run}/{ZONE}={zone}/{PART}={part}"


def read(
    spark: SparkSession, root: str, zone: str, layout: Layout, parts: Iterable[int] | None = None, with_part: bool = False
) -> DataFrame:
    """Rows of a zone, or of some parts of it; folders of other parts are not even listed."""
    schema, known = layout.schema(zone), layout.parts(zone)
    wanted = sorted(known if parts is None else set(parts) & set(known))
    folders = [_folder(root, zone, p, run) for p in wanted for run in known[p]]
    stored = T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], stored if with_part else schema)
    found = spark.read.schema(stored).option("basePath", root.rstrip("/")).parquet(*folders).filter(F.col(PART).isin(wanted))
    return found.select(*schema.names, *([PART] if with_part else []))


def placed(rows: DataFrame, zone: str | Column, part: Column, gone: bool | Column = False) -> DataFrame:
    """``rows`` as a part of a change: where they lie, and whether they leave."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return rows.withColumns({ZONE: as_column(zone), PART: part.cast("int"), GONE: as_column(gone)})


def change(spark: SparkSession, root: str, layout: Layout, run: int, changes: DataFrame, identity: Sequence[str]) -> None:
    """Carry out ``changes`` (see ``placed``) in ``layout`` and in new folders of ``run``.

    Parts that lose rows, and parts of too many folders, are written again; the
    others only get a folder more. ``identity`` names the columns that tell rows
    apart (null equals null); the part of a row follows from them. ``changes`` is read twice: pass a written table.
    """
    # One row per part at most, so the list is as bounded as the pointer is.
    touched = changes.groupBy(ZONE, PART).agg(F.max(GONE).alias(GONE)).collect()
    if not touched:
        return
    again: dict[str, set[int]] = {}
    for row in touched:
        if row[PART] in layout.parts(row[ZONE]) and (row[GONE] or row[PART] in layout.crowded(row[ZONE])):
            again.setdefault(row[ZONE], set()).add(row[PART])
    content = changes.filter(~F.col(GONE)).drop(GONE)
    for zone, parts in again.items():
        out = changes.filter(F.col(GONE) & (F.col(ZONE) == zone)).select(*[F.col(k).alias(f"__out_{k}") for k in identity])
        stored = read(spark, root, zone, layout, parts, with_part=True).withColumn(ZONE, F.lit(zone))
        kept = stored.join(out, null_safe([(k, f"__out_{k}") for k in identity]), "left_anti")
        content = content.unionByName(kept.select(*content.columns))
    written = write(spark, root, run, content)
    for zone in {row[ZONE] for row in touched}:
        known, full = layout.parts(zone), written.get(zone, set())
        rewritten = again.get(zone, set())
        for p in rewritten - full:
            known.pop(p)
        for p in full:
            known[p] = [run] if p in rewritten else [*known.get(p, []), run]


def unlisted(spark: SparkSession, root: str, newest: int = 2) -> list[str]:
    """Folders that none of the newest pointers lists; only readers of older ones would miss them."""
    kept = {
        _folder(root, zone, p, run)
        for number in runs(spark, root)[-newest:] for zone, parts in layout_of(spark, root, number).folders.items()
        for p, numbers in parts.items() for run in numbers
    }
    found = []
    for run in (n for n in _names(spark, root) if n.startswith("run=")):
        for zone in (n for n in _names(spark, f"{root}/{run}") if n.startswith(f"{ZONE}=")):
            parts = [n for n in _names(spark, f"{root}/{run}/{zone}") if n.startswith(f"{PART}=")]
            found += [path for n in parts if (path := f"{root.rstrip('/')}/{run}/{zone}/{n}") not in kept]
    return found
