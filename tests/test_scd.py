import os
import shutil

import pytest
from pyspark.sql import functions as F

from support import at, plan, rows
from tideline.catalog import inputs
from tideline.operators import scd
from tideline.operators.checks import CheckFailed, require_sound_dimension
from tideline.operators.ordered import SplitPolicy
from tideline.operators.scd import Dimension
from tideline.plans import dimensions
from tideline.plans.dimensions import CUSTOMERS
from tideline.sinks import snapshots, zones

DIM = Dimension(("customer_id",), ("name", "email", "address", "risk_level"), "updated_at", ("ingestion_time",))
SHOWN = ("customer_id", "email", "risk_level", "effective_from", "effective_to", "is_current")

# First rows, a change, a late change, a replay, and two changes that come in one batch, there and back.
GOLDEN = [
    ("K7", "Mira", "mira@old.example", "OSLO", "LOW", "2031-03-04 08:00:00", "2031-03-04 08:10:00"),
    ("K9", "Jon", "jon@post.example", "ROMA", "MEDIUM", "2031-03-04 09:30:00", "2031-03-04 09:40:00"),
    ("K7", "Mira", "mira@old.example", "OSLO", "HIGH", "2031-03-07 12:00:00", "2031-03-07 12:01:00"),
    ("K7", "Mira", "mira@new.example", "OSLO", "HIGH", "2031-03-05 18:00:00", "2031-03-09 07:00:00"),
    ("K9", "Jon", "jon@post.example", "ROMA", "MEDIUM", "2031-03-04 09:30:00", "2031-03-10 06:00:00"),
    ("K9", "Jon", "jon@post.example", "ROMA", "LOW", "2031-03-06 10:00:00", "2031-03-11 06:00:00"),
    ("K9", "Jon", "jon@post.example", "ROMA", "MEDIUM", "2031-03-06 11:00:00", "2031-03-11 06:00:00"),
]
EXPECTED = [
    ("K7", "mira@new.example", "HIGH", "2031-03-05 18:00:00", "2031-03-07 12:00:00", False),
    ("K7", "mira@old.example", "HIGH", "2031-03-07 12:00:00", None, True),
    ("K7", "mira@old.example", "LOW", "2031-03-04 08:00:00", "2031-03-05 18:00:00", False),
    ("K9", "jon@post.example", "LOW", "2031-03-06 10:00:00", "2031-03-06 11:00:00", False),
    ("K9", "jon@post.example", "MEDIUM", "2031-03-04 09:30:00", "2031-03-06 10:00:00", False),
    ("K9", "jon@post.example", "MEDIUM", "2031-03-06 11:00:00", None, True),
]


def updates(spark, picked):
    data = [(*r[:5], at(r[5]), at(r[6])) for r in picked]
    return spark.createDataFrame(
        data, "customer_id string, name string, email string, address string, risk_level string, "
        "updated_at timestamp_ntz, ingestion_time timestamp_ntz"
    )


def shown(df):
    return sorted((tuple(str(v) if hasattr(v, "year") else v for v in r) for r in df.select(*SHOWN).collect()), key=repr)


def test_golden_history(spark):
    assert shown(scd.build_history(updates(spark, GOLDEN), DIM)) == EXPECTED


@pytest.mark.parametrize("batches", [
    [(0,), (1,), (2,), (3,), (4,), (5,), (6,)], [(6,), (3,), (2,), (5,), (4,), (1,), (0,)],
    [(0, 1, 2), (3, 4, 5, 6)], [(3, 5, 6), (0, 1, 2, 4)], [(0, 1, 2, 3, 4, 5, 6)],
])
def test_batching_does_not_show_in_the_dimension(spark, batches, tmp_path):
    """Whatever the order and the size of the batches, the pipeline ends with the same dimension."""
    root = str(tmp_path / "dim")
    for batch in batches:
        dimensions.maintain(spark, updates(spark, [GOLDEN[i] for i in batch]), root, DIM)
    assert shown(dimensions.read(spark, root)) == EXPECTED
    assert zones.next_run(spark, root) == len(batches) + 1


def test_latest_only_keeps_the_newest_of_a_batch(spark, tmp_path):
    root = str(tmp_path / "dim")
    dimensions.maintain(spark, updates(spark, GOLDEN[:2]), root, DIM, latest_only=True)
    dimensions.maintain(spark, updates(spark, GOLDEN[2:]), root, DIM, latest_only=True)
    assert len(shown(snapshots.read(spark, root))) == 3  # neither the change in between nor the one there and back


def test_history_is_the_same_when_keys_are_cut(spark, tables):
    log = inputs.customer_updates(spark, tables).withColumn(
        "customer_id", F.when(F.col("seq") % 3 == 0, F.lit(0)).otherwise(F.col("customer_id"))
    )
    whole = rows(scd.build_history(log, CUSTOMERS, split=None))
    assert rows(scd.build_history(log, CUSTOMERS, split=SplitPolicy(0.01, 1))) == whole
    gone = F.col("risk_level") == "LOW"
    whole = rows(scd.build_history(log, CUSTOMERS, gone, split=None))
    assert rows(scd.build_history(log, CUSTOMERS, gone, split=SplitPolicy(0.01, 1))) == whole


def test_overlaps_are_the_same_when_keys_are_cut(spark, tables):
    log = inputs.customer_updates(spark, tables).withColumn("customer_id", F.col("customer_id") % 3)
    broken = scd.build_history(log, CUSTOMERS).withColumn("effective_to", F.col("effective_to") + F.expr("INTERVAL 9 DAY"))
    found = rows(scd.overlapping(broken, CUSTOMERS.keys, None))
    assert found and rows(scd.overlapping(broken, CUSTOMERS.keys, SplitPolicy(0.05, 1))) == found


def test_history_invariants(spark, tables):
    log = inputs.customer_updates(spark, tables)
    history = scd.build_history(log, CUSTOMERS)
    require_sound_dimension(history, CUSTOMERS.keys)
    assert history.filter("is_current <> (effective_to is null)").count() == 0
    assert history.filter("is_current").count() == log.select("customer_id").distinct().count()
    assert history.filter("effective_to <= effective_from").count() == 0
    # The version in force at a change point is that change.
    newest = log.groupBy("customer_id", "updated_at").agg(F.max_by("risk_level", F.struct("ingestion_time", "seq")).alias("r"))
    at_change = newest.join(history, "customer_id").filter(
        (F.col("effective_from") <= F.col("updated_at"))
        & (F.col("effective_to").isNull() | (F.col("effective_to") > F.col("updated_at")))
    )
    assert at_change.count() == newest.count()
    assert at_change.filter("r <> risk_level").count() == 0


def test_late_fix_equals_history_of_the_whole_log(spark, tables):
    log = inputs.customer_updates(spark, tables)
    stored = scd.build_history(inputs.is_on_time(log), CUSTOMERS)
    fixed = scd.rebuild_from_log(stored, inputs.is_on_time(log), inputs.is_behind(log), CUSTOMERS)
    assert rows(fixed) == rows(scd.build_history(log, CUSTOMERS))
    require_sound_dimension(scd.insert_late_versions(stored, inputs.is_behind(log), CUSTOMERS), CUSTOMERS.keys)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_apply_is_sound_and_repeatable(spark, tables, limit):
    log = inputs.customer_updates(spark, tables)
    stored = scd.build_history(inputs.is_first_load(log), CUSTOMERS)
    batch = inputs.is_next_batch(log)
    once = scd.apply_updates(stored, batch, CUSTOMERS, broadcast_limit=limit)
    require_sound_dimension(once, CUSTOMERS.keys)
    assert rows(scd.apply_updates(once, batch, CUSTOMERS, broadcast_limit=limit)) == rows(once)
    assert scd.detect_changes(once, batch.join(scd.late_updates(once, batch, CUSTOMERS), "seq", "left_anti"), CUSTOMERS).count() == 0


def test_late_update_does_not_close_the_current_version(spark):
    stored = scd.build_history(updates(spark, GOLDEN[:3]), DIM)
    assert shown(scd.apply_updates(stored, updates(spark, [GOLDEN[3]]), DIM)) == shown(stored)
    assert scd.late_updates(stored, updates(spark, GOLDEN), DIM).count() == 2


def test_update_at_the_same_time_replaces_the_version(spark):
    stored = scd.initial_load(updates(spark, [GOLDEN[1]]), DIM)
    changed = (*GOLDEN[1][:4], "HIGH", *GOLDEN[1][5:])
    got = scd.apply_updates(stored, updates(spark, [changed]), DIM)
    assert shown(got) == [("K9", "jon@post.example", "HIGH", "2031-03-04 09:30:00", None, True)]


def test_delete_closes_and_a_new_insert_reopens(spark):
    feed = spark.createDataFrame(
        [(7, "Graz", "INSERT", at("2031-05-02 06:00"), 1), (7, "Linz", "UPDATE", at("2031-05-03 07:30"), 2),
         (7, "Linz", "DELETE", at("2031-05-04 20:00"), 3), (7, "Linz", "INSERT", at("2031-05-09 01:00"), 4),
         (8, "Wels", "DELETE", at("2031-05-04 20:00"), 5)],
        "customer_id int, city string, operation string, event_time timestamp_ntz, seq int",
    )
    got = rows(dimensions.feed_history(feed), "city", "effective_from", "effective_to", "is_current")
    assert got == [
        ("Graz", at("2031-05-02 06:00"), at("2031-05-03 07:30"), False),
        ("Linz", at("2031-05-03 07:30"), at("2031-05-04 20:00"), False),
        ("Linz", at("2031-05-09 01:00"), None, True),
    ]


def test_feed_pipeline_by_batch_equals_history_at_once(spark, tables, tmp_path):
    feed = inputs.change_feed(spark, tables)
    parts = [feed.filter("seq % 2 = 0"), feed.filter("seq % 2 = 1")]
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    dimensions.run_feed(spark, parts[0], silver, gold, buckets=4)
    dimensions.run_feed(spark, parts[1], silver, gold)
    assert rows(dimensions.read(spark, gold)) == rows(dimensions.feed_history(feed))


def test_unsound_dimension_is_not_published(spark, tmp_path):
    root = str(tmp_path / "dim")
    stored = scd.initial_load(updates(spark, GOLDEN[:2]), DIM)
    with pytest.raises(CheckFailed):
        snapshots.publish(stored.union(stored), root, check=lambda d: require_sound_dimension(d, DIM.keys))
    assert not snapshots.exists(spark, root)
    assert snapshots.publish(stored, root) == 2 and snapshots.versions(spark, root) == [2]


def test_updates_outlive_old_pointers_and_failed_runs(spark, tmp_path, monkeypatch):
    """Old pointers are removed, one run fails in between: the history is that of the published runs."""
    root = str(tmp_path / "dim")
    for i in range(3):
        dimensions.maintain(spark, updates(spark, GOLDEN[i:i + 1]), root, DIM)
    os.remove(f"{root}/pointer-000000001.json")
    os.remove(f"{root}/pointer-000000002.json")

    def fails(*args):
        raise CheckFailed("not published")

    with monkeypatch.context() as broken:
        broken.setattr(zones, "publish", fails)
        with pytest.raises(CheckFailed):
            dimensions.maintain(spark, updates(spark, [("K5", "never", *GOLDEN[3][2:]), (*GOLDEN[3][:1], "never", *GOLDEN[3][2:])]), root, DIM)
    assert dimensions.maintain(spark, updates(spark, GOLDEN[3:5]), root, DIM) == 4
    dimensions.maintain(spark, updates(spark, GOLDEN[5:]), root, DIM)
    assert shown(dimensions.read(spark, root)) == EXPECTED
    assert "never" not in {r["name"] for r in dimensions.read(spark, root).collect()}


def test_an_unsound_history_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "dim")
    dimensions.maintain(spark, updates(spark, GOLDEN[:2]), root, DIM)
    build = scd.build_history
    with monkeypatch.context() as broken:
        broken.setattr(scd, "build_history", lambda *args: build(*args).union(build(*args)))
        with pytest.raises(CheckFailed):
            dimensions.maintain(spark, updates(spark, GOLDEN[2:3]), root, DIM)
    assert shown(dimensions.read(spark, root)) == shown(scd.build_history(updates(spark, GOLDEN[:2]), DIM))


def files(root):
    """Every data file below a folder with its time and size."""
    return {
        os.path.join(d, f): (os.stat(os.path.join(d, f)).st_mtime_ns, os.stat(os.path.join(d, f)).st_size)
        for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")
    }


@pytest.fixture(scope="module")
def large_dimension(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dimension") / "dim")
    log = inputs.customer_updates(spark, tables)
    dimensions.maintain(spark, log.filter("updated_at < '1999-01-01'"), root, CUSTOMERS, buckets=8)
    return root, log


def test_a_run_leaves_the_files_of_untouched_months_alone(spark, large_dimension, tmp_path):
    """New versions add folders; a late update writes its own month again and no other."""
    first, log = large_dimension
    root = str(tmp_path / "dim")
    shutil.copytree(first, root)
    before, months = files(root), set(zones.current(spark, root).parts("closed"))
    some = log.filter("customer_id % 50 = 1")
    dimensions.maintain(spark, some.filter("updated_at >= '1999-01-01'"), root, CUSTOMERS)
    assert {f: v for f, v in files(root).items() if f in before} == before
    second = zones.current(spark, root)
    assert all(second.parts("closed")[m] == [1] for m in months if m < 199812)
    assert any(runs == [2] or runs == [1, 2] for runs in second.parts("closed").values())

    # An update inside one closed version: only the month in which that version ended loses a row.
    version = dimensions.read(spark, root).filter("not is_current").orderBy("effective_from", "customer_id").first()
    late = log.limit(1).select(
        *[F.lit(version[c]).alias(c) for c in ("customer_id", "name", "email", "address")], F.lit("NONE").alias("risk_level"),
        F.expr(f"TIMESTAMP_NTZ'{version['effective_from']}' + INTERVAL 1 SECOND").alias("updated_at"), "ingestion_time", F.lit(0).cast("long").alias("seq"),
    )
    dimensions.maintain(spark, late, root, CUSTOMERS)
    third = zones.current(spark, root)
    ended = version["effective_to"].year * 100 + version["effective_to"].month
    began = version["effective_from"].year * 100 + version["effective_from"].month
    changed = {m for m in set(second.parts("closed")) | set(third.parts("closed")) if second.parts("closed").get(m) != third.parts("closed").get(m)}
    assert changed == {ended, began} and third.parts("closed")[ended] == [3]
    assert third.parts("open") == second.parts("open")
    log_so_far = log.filter("updated_at < '1999-01-01' or customer_id % 50 = 1").unionByName(late)
    assert rows(dimensions.read(spark, root)) == rows(scd.build_history(log_so_far, CUSTOMERS))


def test_the_log_is_read_from_the_buckets_of_the_batch(spark, large_dimension):
    root, log = large_dimension
    layout, part = zones.current(spark, root), dimensions._bucket(["customer_id"], 8)
    wanted = [r[0] for r in log.filter("customer_id = 7").select(part.alias("p")).distinct().collect()]
    read = zones.read(spark, root, "log", layout, wanted)
    shown_plan = plan(read)
    assert "PartitionFilters: [isnotnull(part" in shown_plan or "PartitionFilters: [(part" in shown_plan or "PartitionFilters: [part" in shown_plan
    assert len(read.inputFiles()) < len(zones.read(spark, root, "log", layout).inputFiles())
    assert all(f"part={wanted[0]}/" in f for f in read.inputFiles())
    assert read.filter("customer_id = 7").count() == log.filter("customer_id = 7 and updated_at < '1999-01-01'").count()


def test_as_of_reads_no_month_that_ended_before(spark, large_dimension):
    root, log = large_dimension
    got = dimensions.read_as_of(spark, root, "1997-06-15 00:00:00")
    months = {int(f.split("part=")[1].split("/")[0]) for f in got.inputFiles() if "zone=closed/" in f}
    assert months and min(months) >= 199706
    history = scd.build_history(log.filter("updated_at < '1999-01-01'"), CUSTOMERS)
    assert rows(got) == rows(scd.as_of(history, "1997-06-15 00:00:00"))


def test_a_part_of_many_folders_becomes_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "MOST_FOLDERS", 3)
    root = str(tmp_path / "dim")
    for i in (0, 1, 2, 5, 6, 3):
        dimensions.maintain(spark, updates(spark, GOLDEN[i:i + 1]), root, DIM, buckets=1)
    layout = zones.current(spark, root)
    assert all(len(runs) <= 3 for parts in layout.folders.values() for runs in parts.values())
    assert shown(dimensions.read(spark, root)) == EXPECTED
    left = zones.unlisted(spark, root, newest=1)
    assert left
    for folder in left:
        shutil.rmtree(folder)
    assert shown(dimensions.read(spark, root)) == EXPECTED


def test_a_feed_without_rows_gives_an_empty_dimension(spark, tmp_path):
    root = str(tmp_path / "dim")
    dimensions.maintain(spark, updates(spark, GOLDEN).limit(0), root, DIM)
    assert dimensions.read(spark, root).count() == 0 and dimensions.read(spark, root).columns == DIM.columns
    dimensions.maintain(spark, updates(spark, GOLDEN), root, DIM)
    assert shown(dimensions.read(spark, root)) == EXPECTED


def test_null_keys_and_replays_change_nothing_else(spark, tmp_path):
    root = str(tmp_path / "dim")
    nameless = [(None, *r[1:]) for r in GOLDEN[:3]]
    dimensions.maintain(spark, updates(spark, nameless[:2] + GOLDEN[:4]), root, DIM, buckets=2)
    once = zones.current(spark, root).folders
    dimensions.maintain(spark, updates(spark, GOLDEN[:4]), root, DIM)
    again = zones.current(spark, root).folders
    assert (again["open"], again["closed"]) == (once["open"], once["closed"])
    dimensions.maintain(spark, updates(spark, nameless[2:] + GOLDEN[4:]), root, DIM)
    got = dimensions.read(spark, root)
    assert shown(got) == shown(scd.build_history(updates(spark, nameless + GOLDEN), DIM))


def test_changed_only_leaves_unknown_keys_out(spark, tmp_path):
    root = str(tmp_path / "dim")
    dimensions.maintain(spark, updates(spark, GOLDEN[:1]), root, DIM)
    dimensions.maintain(spark, updates(spark, GOLDEN[1:3]), root, DIM, insert_new=False)
    assert {r[0] for r in rows(dimensions.read(spark, root))} == {"K7"}


def test_a_run_shuffles_the_log_once(spark, tmp_path, monkeypatch):
    """Windows, check and sums of the histories share one shuffle by key, and no history is written in between."""
    root, plans = str(tmp_path / "dim"), []
    dimensions.maintain(spark, updates(spark, GOLDEN[:3]), root, DIM)
    keep = dimensions.written
    monkeypatch.setattr(dimensions, "written", lambda df, purpose: (plans.append((purpose, plan(df))), keep(df, purpose))[1])
    dimensions.maintain(spark, updates(spark, GOLDEN[3:]), root, DIM)
    assert [(purpose, text.count("Exchange ")) for purpose, text in plans] == [("differing-versions", 1)]
    assert shown(dimensions.read(spark, root)) == EXPECTED
