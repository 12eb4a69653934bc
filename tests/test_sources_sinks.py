import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from support import at, plan, rows
from tideline.catalog import inputs
from tideline.operators import partitions
from tideline.plans import medallion, skewjobs
from tideline.session import working_folder
from tideline.sinks import audit, compaction, evolution, layout, snapshots
from tideline.sources import incremental, tables as readers


def files(path):
    return [p for p in Path(path).rglob("*.parquet") if "_temporary" not in str(p)]


def test_replace_partitions_keeps_history_and_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], "k int, v string, d string")
    layout.replace_partitions(first, path, ["d"])
    second = spark.createDataFrame([(2, "B", "2024-01-02"), (3, "C", "2024-01-02")], "k int, v string, d string")
    for _ in range(2):
        layout.replace_partitions(second, path, ["d"])
        assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]


def test_one_file_per_small_partition_and_pruned_reads(spark, tables, tmp_path):
    path = str(tmp_path / "t")
    clicks = inputs.clicks(spark, tables).withColumn("event_date", F.to_date("event_time")).repartition(8)
    layout.replace_partitions(clicks, path, ["event_date"])
    days = clicks.select("event_date").distinct().count()
    assert len(files(path)) == days
    one_day = spark.read.parquet(path).filter("event_date = date '2024-01-05'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(one_day)


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path, key = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 3)).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        layout.replace_partitions(hot, path, ["d"])
    finally:
        spark.conf.set(key, before)
    assert len(files(f"{path}/d=hot")) > 3 and spark.read.parquet(path).count() == 200_000


def test_records_per_file_are_capped(spark, tmp_path):
    layout.overwrite(spark.range(0, 1000, 1, 1), str(tmp_path / "t"), 300)
    assert len(files(tmp_path)) == 4


def test_append_adds_missing_and_new_columns_and_refuses_other_types(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.append(spark.sql("SELECT 1 AS k, 'a' AS old"), path)
    evolution.append_evolving(spark.sql("SELECT 'n' AS new, 2 AS k"), path)
    evolution.append_evolving(spark.sql("SELECT 3 AS k, 'c' AS old"), path)
    assert rows(evolution.read_evolved(spark, path), "k", "old", "new") == [(1, "a", None), (2, None, "n"), (3, "c", None)]
    with pytest.raises(evolution.SchemaConflict):
        evolution.append_evolving(spark.sql("SELECT 'x' AS k"), path)
    assert spark.read.parquet(path).count() == 3


def test_snapshots_survive_an_aborted_write(spark, tmp_path):
    root = str(tmp_path / "t")
    assert not snapshots.exists(spark, root)
    snapshots.publish(spark.range(2), root)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(snapshots.folder(root, 2))
    assert snapshots.read(spark, root).count() == 2
    # The new content may read the table it replaces.
    assert snapshots.publish(snapshots.read(spark, root).union(spark.range(5, 6)), root) == 3
    assert snapshots.read(spark, root).count() == 3 and snapshots.read(spark, root, 1).count() == 2
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root, 2)


def test_compaction_and_clustering(spark, tables, tmp_path):
    orders = inputs.orders(spark, tables)
    small, compact, clustered = (str(tmp_path / n) for n in ("small", "compact", "clustered"))
    layout.overwrite(orders.repartition(12), small)
    layout.compact(spark, small, compact)
    assert len(files(compact)) < len(files(small))
    layout.cluster(snapshots.read(spark, compact), clustered, ["user_id"], 4)
    table = snapshots.read(spark, clustered)
    assert rows(table) == rows(orders)
    spans = table.groupBy(F.input_file_name()).agg(F.min("user_id"), F.max("user_id")).collect()
    spans = sorted((lo, hi) for _, lo, hi in spans)
    assert len(spans) == 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_csv_and_named_format(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.sql("SELECT 't1' AS id, 1.5D AS amount").write.option("header", True).csv(path)
    assert rows(readers.csv(spark, path, "id string, amount double")) == [("t1", 1.5)]
    assert rows(readers.load(spark, "csv", path, "id string, amount double", header=True)) == [("t1", 1.5)]
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert readers.parquet(spark, str(tmp_path / "p")).count() == 3
    assert readers.load(spark, "parquet", str(tmp_path / "p")).count() == 3


def test_boundary_moves_only_after_the_output_is_there(spark, tmp_path, monkeypatch):
    control, root = str(tmp_path / "control"), str(tmp_path / "table")
    source = spark.createDataFrame([(1, at("2024-01-01")), (2, at("2024-01-02")), (9, None)], "k int, ingestion_time timestamp_ntz")

    def fails(*_):
        raise RuntimeError("disk full")

    with monkeypatch.context() as broken:
        broken.setattr(incremental.snapshots, "publish", fails)
        with pytest.raises(RuntimeError):
            incremental.run_incremental(spark, source, control, root)
    assert incremental.stored_boundary(spark, control) is None
    # The repeated run replaces its parts; later ones bring a row of the boundary time, a new one, and nothing.
    for extra in ([], [(4, at("2024-01-02"))], [(3, at("2024-01-03")), (8, None)], []):
        source = source.union(spark.createDataFrame(extra, source.schema))
        incremental.run_incremental(spark, source, control, root)
        assert rows(incremental.read_published(spark, root, source.schema)) == rows(source)
    assert incremental.stored_boundary(spark, control) == at("2024-01-03")


def test_working_folder_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    one, two = working_folder(spark, "x"), working_folder(spark, "x")
    assert one != two
    if shared:
        assert one.startswith(shared.rstrip("/") + "/x-")


def test_audit(spark, tmp_path):
    table = spark.createDataFrame([("m", 1), ("m", 2), ("n", 5)], "m string, c int")
    audit.write_totals(table, str(tmp_path / "a"), ["m"], total="c")
    stored = spark.read.parquet(str(tmp_path / "a"))
    assert rows(stored) == [("m", 3), ("n", 5)]
    other = spark.createDataFrame([("m", 3), ("o", 1)], "m string, total int")
    compared = audit.compare(stored, other, ["m"], "total")
    assert rows(compared.filter("difference <> 0"), "m", "difference") == [("n", 5), ("o", -1)]


def test_medallion_run(spark, tables, tmp_path):
    bronze = inputs.bronze_sales(spark, tables)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    half = bronze.filter("seq % 2 = 0")
    medallion.run(spark, half, silver, gold)
    medallion.run(spark, bronze, silver, gold)
    assert rows(snapshots.read(spark, gold)) == rows(medallion.latest_sale(medallion.clean_sales(bronze)))
    assert spark.read.parquet(silver).filter("price is null").count() == 0


def test_join_jobs(spark, tables, tmp_path):
    fact = inputs.skewed_events(spark, tables).withColumn("event_date", F.to_date("event_time"))
    users = inputs.users(spark, tables)
    want = rows(fact.join(users, "user_id"), "event_id", "user_id", "user_segment")
    paths = [str(tmp_path / n) for n in "abc"]
    skewjobs.skew_safe(fact, users, ["user_id"], ["event_id"], "event_date", paths[0])
    skewjobs.tuned(fact, users, ["user_id"], ["event_id"], paths[1])
    skewjobs.flat(fact, users, ["user_id"], paths[2])
    for path in paths:
        assert rows(spark.read.parquet(path), "event_id", "user_id", "user_segment") == want


def test_large_files_stay_and_small_ones_end_near_the_target(spark, tables, tmp_path):
    path, orders = str(tmp_path / "t able"), inputs.orders(spark, tables)
    layout.append(orders.repartition(1), path, ["currency"])
    large = {f.path: f.size for f in compaction.data_files(spark, path)}
    target = max(large.values())
    layout.append(orders.withColumn("order_id", -F.col("order_id")).repartition(9), path, ["currency"])
    times = {p: os.stat(p.removeprefix("file:")).st_mtime_ns for p in large}
    small = [f for f in compaction.data_files(spark, path) if f.path not in large]
    want = rows(spark.read.parquet(path))
    assert compaction.compact(spark, path, target, 0.5) == len(small) > 20
    after = compaction.data_files(spark, path)
    assert rows(spark.read.parquet(path)) == want
    assert {p: os.stat(p.removeprefix("file:")).st_mtime_ns for p in large} == times
    new = [f.size for f in after if f.path not in large]
    assert len(new) <= len(small) / 3 and max(new) < 1.5 * target
    assert not os.path.exists(f"{path}/_compacting")
    assert compaction.compact(spark, path, max(new), 0.01) == 0


def test_bins_stay_in_their_folder_and_below_the_target():
    files_ = [compaction.DataFile(f"{d}/{i}", d, size) for d in "ab" for i, size in enumerate([90, 10, 60, 30, 30, 5, 74, 2])]
    groups = compaction.bins(files_, 100)
    assert all(len({f.folder for f in g}) == 1 and sum(f.size for f in g) <= 100 and len(g) > 1 for g in groups)
    assert sorted(f.size for g in groups for f in g) == sorted(2 * [10, 60, 30, 5, 74, 2])
    assert compaction.bins(files_[:1], 1000) == []


@pytest.mark.parametrize("stopped_at", ["delete", "rename"])
def test_a_compaction_that_stops_is_completed(spark, tmp_path, monkeypatch, stopped_at):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(10).write.parquet(path)
    want = rows(spark.read.parquet(path))
    with monkeypatch.context() as broken:
        # The journal is written; the swap is not begun.
        complete, calls = compaction.recover, []
        broken.setattr(compaction, "recover", lambda s, p: calls.append(p) or (complete(s, p) if len(calls) == 1 else None))
        compaction.compact(spark, path)
    assert len(compaction.data_files(spark, path)) == 10 and os.path.exists(f"{path}/_compacting/plan.json")
    if stopped_at == "rename":  # old files are gone, new ones not there yet
        for f in compaction.data_files(spark, path):
            os.remove(f.path.removeprefix("file:"))
    assert compaction.recover(spark, path)
    assert rows(spark.read.parquet(path)) == want and len(compaction.data_files(spark, path)) == 1


def test_a_curve_prunes_for_either_column(spark, tables, tmp_path):
    orders = inputs.orders(spark, tables)
    when = F.lit(at("1997-03-03")).cast("timestamp_ntz")
    left = {}
    for name, laid in (("curve", partitions.curve_clustered(orders, ["user_id", "order_time"], 16)), ("range", partitions.clustered(orders, ["user_id", "order_time"], 16))):
        laid.write.parquet(str(tmp_path / name))
        table = spark.read.parquet(str(tmp_path / name))
        assert rows(table) == rows(orders)
        left[name] = [layout.files_left(table, "user_id", 77)[0], layout.files_left(table, "order_time", when)[0]]
    assert max(left["curve"]) <= 10 and left["range"][1] > 12


def test_curve_ranks_nulls_texts_and_one_value(spark):
    df = spark.sql("SELECT id, IF(id % 4 = 0, NULL, concat('k', lpad(id, 4, '0'))) AS t, 5 AS same, NULL AS none FROM range(512)")
    place = partitions.curve_place(df, ["t", "same", "none"], 4)
    got = df.select("id", "t", place.alias("p")).collect()
    assert all(r["p"] == 0 for r in got if r["t"] is None)
    named = sorted((r["t"], r["p"]) for r in got if r["t"] is not None)
    assert [p for _, p in named] == sorted(p for _, p in named) and len({p for _, p in named}) >= 15
    assert rows(partitions.curve_clustered(df, ["t", "id"])) == rows(df)
    assert partitions.curve_clustered(df.limit(0), ["t", "id"]).count() == 0
