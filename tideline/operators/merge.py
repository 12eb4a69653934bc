"""Keyed merge of a change set into a table.

Parquet has no row-level update, so a merge gives the new content of the table;
``sinks.snapshots`` publishes it. Both sides hold at most one row per key, so no
key can be hot in the join; a source in which a key repeats stops the job
(``conflicting_keys`` lists such keys).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.joins import BROADCAST_BYTES, fits, is_small
from tideline.operators.ordered import null_safe
from tideline.session import written

_KEY = "__key_"


def matched_pairs(
    target: DataFrame, source: DataFrame, keys: Sequence[str], broadcast_limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows ``(t, s)``: target and source row of each key, null where one is missing. A null key equals a null key.

    A source within the broadcast limit is written once and sent to the target,
    which is then not shuffled at all; source rows without a partner come from a
    second, key-only look at the target. A larger source takes one full outer join.
    The plan only knows the size of compressed files, so the rows written are counted as well.
    """
    small = is_small(source, broadcast_limit)
    if small:
        source = written(source, "merge-source")
        small = fits(source, broadcast_limit)
    t = target.select(*[F.col(k).alias(f"{_KEY}t_{k}") for k in keys], F.struct(*target.columns).alias("t"))
    s = source.select(*[F.col(k).alias(f"{_KEY}s_{k}") for k in keys], F.struct(*source.columns).alias("s"))
    on = null_safe([(f"{_KEY}t_{k}", f"{_KEY}s_{k}") for k in keys])
    if not small:
        return t.join(s, on, "full_outer").select("t", "s")
    kept = t.join(F.broadcast(s), on, "left").select("t", "s")
    known = t.drop("t").join(F.broadcast(s.drop("s")), on, "left_semi")
    added = s.join(known, on, "left_anti").select("s")
    return kept.unionByName(added.select(F.lit(None).cast(t.schema["t"].dataType).alias("t"), "s"))


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` as it is, in a plan that fails when two of its rows share a key (null equals null).

    The check is part of the plan: rows are grouped where they are read, then by
    key, and a count above one raises. There is no second look at the source.
    """
    grouped = source.groupBy(*keys).agg(F.any_value(F.struct(*source.columns)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    failure = F.raise_error(F.concat(F.lit("several source rows for the key "), key))
    return grouped.select(F.when(F.col("__n") > 1, failure).otherwise(F.col("__row")).alias("__row")).select("__row.*")


def _value(given: str | Column) -> Column:
    return F.col(f"s.{given}") if isinstance(given, str) else given


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, str | Column] | None = None,
    update_when: Column | None = None,
    delete_when: Column | None = None,
    insert: Mapping[str, str | Column] | None = None,
    insert_when: Column | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    unique: bool = False,
) -> DataFrame:
    """New content of ``target``; a key with several source rows fails the job.

    ``update`` and ``insert`` map target columns to source columns or to
    expressions over ``t.<column>`` and ``s.<column>``; ``None`` switches the clause off. Conditions are written over ``t.<column>`` and
    ``s.<column>``. A matched row is deleted before it is considered for update.
    Target columns that ``insert`` leaves out become null. ``unique`` says that
    the source has one row per key by construction, and saves the check.
    """
    if not unique:
        small = is_small(source, broadcast_limit)
        source = one_row_per_key(source, keys)
        broadcast_limit = broadcast_limit if small else 0
    pairs = matched_pairs(target, source, keys, broadcast_limit)
    has_target, has_source = F.col("t").isNotNull(), F.col("s").isNotNull()
    matched = has_target & has_source
    always, never = F.lit(True), F.lit(False)

    deleted = matched & F.coalesce(delete_when if delete_when is not None else never, never)
    inserts = never
    if insert is not None:
        inserts = ~has_target & F.coalesce(insert_when if insert_when is not None else always, never)
    updates = never
    if update is not None:
        updates = matched & F.coalesce(update_when if update_when is not None else always, never)

    columns = []
    for field in target.schema.fields:
        name = field.name
        value = F.col(f"t.{name}")
        if update is not None and name in update:
            value = F.when(F.col("__updates"), _value(update[name])).otherwise(value)
        fresh = F.lit(None)
        if insert is not None and name in insert:
            fresh = _value(insert[name])
        value = F.when(F.col("__inserts"), fresh).otherwise(value)
        columns.append(value.cast(field.dataType).alias(name))
    return (
        pairs.withColumns({"__updates": updates, "__inserts": inserts})
        .filter((has_target & ~deleted) | F.col("__inserts"))
        .select(*columns)
    )


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], broadcast_limit: int = BROADCAST_BYTES, unique: bool = False
) -> DataFrame:
    """Type 1 merge: source rows replace or join the target by key, every column. A key with several source rows fails the job.

    No clause looks at a target row that the source replaces, so this needs no
    outer join: the target without the source's keys, and then the source. The
    planner sends a small source to the target instead of shuffling it.
    ``unique`` as in ``merge``.
    """
    small = is_small(source, broadcast_limit)
    incoming = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    incoming = incoming if unique else one_row_per_key(incoming, keys)
    incoming = written(incoming, "merge-source") if small else incoming
    arriving = incoming.select(*[F.col(k).alias(_KEY + k) for k in keys])
    small = small and fits(arriving, broadcast_limit)
    arriving = F.broadcast(arriving) if small else arriving
    return target.join(arriving, null_safe([(k, _KEY + k) for k in keys]), "left_anti").unionByName(incoming)


def conflicting_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one source row; must be empty before a merge."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
