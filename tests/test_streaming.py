import json

import pytest
from pyspark.sql import functions as F

from support import at, rows
from tideline.plans import streams
from tideline.streaming import aggregates, progress, sinks
from tideline.streaming.sources import parse_messages, table_stream


def message(i, merchant, amount, time):
    return json.dumps({"transaction_id": i, "merchant_id": merchant, "user_id": "u", "amount": amount,
                       "event_time": time, "ingestion_time": time})


class Topic:
    """A folder of Parquet files with a ``value`` column; each put is one micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0

    def put(self, *messages):
        self.n += 1
        df = self.spark.createDataFrame([(m.encode(),) for m in messages], "value binary").coalesce(1)
        df.write.mode("append").parquet(str(self.folder))

    def stream(self):
        return self.spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(str(self.folder))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def upsert(spark, topic, root):
    return rows(streams.upsert_run(spark, streams.merchant_metrics(topic.stream()), str(root), ["merchant_id"]),
                "merchant_id", "window_start", "txn_count", "total_amount", "avg_amount")


def shown(found):
    return [(m, str(w)[:16], *rest) for m, w, *rest in found]


def test_replayed_messages_count_once_and_totals_are_updated(spark, topic, tmp_path):
    a, b, c = (message(i, "m", 10.0 * n, f"2024-01-01 10:{n}0:00") for n, i in enumerate("abc", 1))
    topic.put(a, b)
    assert shown(upsert(spark, topic, tmp_path / "out")) == [("m", "2024-01-01 10:00", 2, 30.0, 15.0)]
    topic.put(a, c)
    topic.put(message("d", "n", 5.0, "2024-01-01 11:00:00"), b)
    assert shown(upsert(spark, topic, tmp_path / "out")) == [
        ("m", "2024-01-01 10:00", 3, 60.0, 20.0), ("n", "2024-01-01 11:00", 1, 5.0, 5.0),
    ]
    # A run without new messages, and one with a new checkpoint over the same target, change nothing.
    assert len(upsert(spark, topic, tmp_path / "out")) == 2
    stream = streams.merchant_metrics(topic.stream())
    sinks.finish(sinks.upsert_to(stream, str(tmp_path / "out" / "table"), str(tmp_path / "again"), ["merchant_id"]))
    assert len(upsert(spark, topic, tmp_path / "out")) == 2


def test_replayed_batch_writes_the_same_rows(spark, tmp_path):
    batch = spark.createDataFrame(
        [("2024-01-01 10:00:00", "m", 1), ("2024-01-02 10:00:00", "m", 2)], "t string, m string, n int"
    ).select(F.col("t").cast("timestamp_ntz").alias("window_start"), "m", "n")
    path = str(tmp_path / "t")
    apply = sinks.window_upsert(path, str(tmp_path / "staging"), ["m"])
    apply(batch, 0)
    newer = batch.filter("n = 2").withColumn("n", F.lit(9))
    for batch_id in (1, 1, 2):
        apply(newer, batch_id)
        assert rows(spark.read.parquet(path), "m", "n") == [("m", 1), ("m", 9)]


def test_upsert_rewrites_only_the_days_it_touches(spark, tmp_path):
    path = tmp_path / "t"
    apply = sinks.window_upsert(str(path), str(tmp_path / "staging"), ["m"])
    days = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00' AS window_start, 'm' AS m, 1 AS n UNION ALL SELECT timestamp_ntz'2024-01-02 10:00', 'm', 2")
    apply(days, 0)
    before = {p.name for p in (path / "window_date=2024-01-01").glob("*.parquet")}
    apply(days.filter("n = 2"), 1)
    assert {p.name for p in (path / "window_date=2024-01-01").glob("*.parquet")} == before


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, topic, tmp_path):
    topic.put(message("a", "m", 1.0, "2024-01-01 10:00:00"))
    topic.put(message("b", "m", 1.0, "2024-01-01 20:00:00"))
    topic.put(message("c", "m", 1.0, "2024-01-01 19:00:00"))
    topic.put(message("late", "m", 1.0, "2024-01-01 10:30:00"))
    query = sinks.upsert_to(streams.merchant_metrics(topic.stream()), str(tmp_path / "t"), str(tmp_path / "c"), ["merchant_id"])
    sinks.finish(query)
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1
    assert sum(r[0] for r in rows(spark.read.parquet(str(tmp_path / "t")), "txn_count")) == 3


def test_dedup_state_is_bounded(spark, topic, tmp_path):
    for hour in range(0, 20, 4):
        topic.put(*[message(f"{hour}-{i}", "m", 1.0, f"2024-01-01 {hour:02d}:00:00") for i in range(10)])
    once = aggregates.distinct_events(parse_messages(topic.stream(), streams.MESSAGE_SCHEMA), ["transaction_id"], "event_time", "2 hours")
    query = once.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 20


def test_copies_of_one_id_are_spread_and_still_count_once(spark, topic, tmp_path):
    copies = [message("hot", "m", 1.0, "2024-01-01 10:00:00")] * 30
    for n in range(3):
        spark.createDataFrame([(m.encode(),) for m in [*copies, message(f"e{n}", "m", 1.0, "2024-01-01 10:00:00")]], "value binary") \
            .repartition(4).write.mode("append").parquet(str(topic.folder))
    events = parse_messages(spark.readStream.schema("value binary").parquet(str(topic.folder)), streams.MESSAGE_SCHEMA)
    once = aggregates.distinct_events(events, ["transaction_id"], "event_time", "2 hours", spread_copies=True)
    assert rows(streams.append_run(spark, once, str(tmp_path / "out")), "transaction_id") == [("e0",), ("e1",), ("e2",), ("hot",)]


def test_append_emits_each_closed_window_once(spark, topic, tmp_path):
    def run():
        events = parse_messages(topic.stream(), streams.MESSAGE_SCHEMA).withWatermark("event_time", "1 hour")
        hourly = aggregates.flat_window(events.groupBy(F.window("event_time", "1 hour"), "merchant_id").count())
        return rows(streams.append_run(spark, hourly, str(tmp_path / "out")), "window_start", "count")

    topic.put(message("a", "m", 1.0, "2024-01-01 10:00:00"), message("b", "m", 1.0, "2024-01-01 13:00:00"))
    assert [n for _, n in run()] == [1]
    assert [n for _, n in run()] == [1]
    topic.put(message("c", "m", 1.0, "2024-01-01 18:00:00"))
    assert [str(w)[11:16] for w, _ in run()] == ["10:00", "13:00"]


def test_malformed_message_gives_nulls(spark):
    df = spark.createDataFrame([(b"{not json",), (message("a", "m", 1.0, "2024-01-01 10:00:00").encode(),)], "value binary")
    assert rows(parse_messages(df, streams.MESSAGE_SCHEMA), "transaction_id") == [("a",), (None,)]


def test_rollup_of_daily_counts_equals_the_sliding_window(spark, tables, tmp_path):
    """The last day of each 14-day window has the same count by either way."""
    schema = spark.read.parquet(f"{tables}/events.parquet").schema
    stream = table_stream(spark, f"{tables}/events.parque[t]", schema).select(
        "user_id", F.col("ts").cast("timestamp").alias("event_timestamp")
    )
    daily = aggregates.flat_window(aggregates.daily_counts(stream, ["user_id"], "event_timestamp", "2 days"))
    rolled = streams.roll_up(streams.upsert_run(spark, daily, str(tmp_path / "d"), ["user_id"]))
    sliding = streams.upsert_run(spark, streams.activity_14d(stream), str(tmp_path / "s"), ["user_id"])
    both = rolled.join(
        sliding.select("user_id", F.date_sub(F.to_date("window_end"), 1).alias("event_date"), F.col("event_count").alias("slid")),
        ["user_id", "event_date"],
    )
    assert both.count() == rolled.count() and both.filter("rolling_count <> slid").count() == 0


def test_a_half_replaced_day_is_repaired_by_the_replay(spark, tmp_path, monkeypatch):
    """The crash comes after the merge was staged and the day was deleted, before the new files are in."""
    path, staging = tmp_path / "t", tmp_path / "staging"
    batch = lambda *totals: spark.createDataFrame([(at("2024-01-01 10:00"), m, n) for m, n in totals], "window_start timestamp, m string, n int")
    apply = sinks.window_upsert(str(path), str(staging), ["m"])
    apply(batch(("a", 1), (None, 5)), 0)

    def crashes(df, target, by):
        for day in path.glob("window_date=*"):
            day.rename(tmp_path / f"gone-{day.name}")
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "replace_partitions", crashes)
        with pytest.raises(RuntimeError):
            apply(batch(("b", 2), (None, 6)), 1)
    apply(batch(("b", 2), (None, 6)), 1)
    assert rows(spark.read.parquet(str(path)), "m", "n") == [("a", 1), ("b", 2), (None, 6)]


def test_state_partitions_are_the_configured_ones(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "800")
    try:
        with sinks.start_settings(spark):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "800"
        with sinks.start_settings(spark, 64):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "800"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def activity(spark, *events):
    return spark.createDataFrame([(u, at(t)) for u, t in events], "user_id long, ts timestamp_ntz")


def roll_up_once(spark, root, events):
    events.write.mode("append").parquet(f"{root}/arriving")
    stream = table_stream(spark, f"{root}/arriving", events.schema).select("user_id", F.col("ts").cast("timestamp").alias("event_timestamp"))
    daily = aggregates.flat_window(aggregates.daily_counts(stream, ["user_id"], "event_timestamp", "90 days"))
    return streams.roll_up_run(spark, daily, root)


def test_a_second_run_refreshes_only_what_changed(spark, tmp_path):
    root = str(tmp_path)
    first = activity(spark, (1, "2024-01-01 10:00"), (1, "2024-01-10 10:00"), (1, "2024-01-20 10:00"), (2, "2024-01-02 10:00"), (2, "2024-02-20 10:00"), (None, "2024-01-02 10:00"))
    second = activity(spark, (1, "2024-01-08 10:00"), (3, "2024-01-09 10:00"), (None, "2024-01-03 10:00"))
    roll_up_once(spark, root, first)
    kept = {f for f in streams.rolled_up(spark, root).inputFiles() if "2024-02-20" in f}
    got = roll_up_once(spark, root, second)
    both = first.union(second).groupBy("user_id", F.to_date("ts").alias("event_date")).agg(F.count("*").alias("event_count"))
    want = streams.roll_up(both.withColumn("window_start", F.col("event_date")))
    assert rows(got, *want.columns) == rows(want)
    assert kept and kept <= set(got.inputFiles())
    assert not (tmp_path / "changed").exists()
    assert rows(roll_up_once(spark, root, second.limit(0)), *want.columns) == rows(want)


def test_a_roll_up_that_stops_is_repeated(spark, tmp_path, monkeypatch):
    root, events = str(tmp_path), activity(spark, (1, "2024-01-01 10:00"), (1, "2024-01-05 10:00"))

    def fails(*args):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(streams, "replace_within", fails)
        with pytest.raises(OSError):
            roll_up_once(spark, root, events)
    assert rows(roll_up_once(spark, root, events.limit(0)), "rolling_count") == [(1,), (2,)]


def test_progress_has_a_row_per_event_and_the_late_rows(spark, topic, tmp_path):
    for i, time in enumerate(["10:00", "20:00", "19:00", "10:30", "11:30"]):
        topic.put(message(str(i), "m", 1.0, f"2024-01-01 {time}:00"))
    events = parse_messages(topic.stream(), streams.MESSAGE_SCHEMA)
    once = aggregates.distinct_events(events, ["transaction_id"], "event_time", "2 hours")
    kept = streams.watched_run(spark, once, str(tmp_path / "out"))
    assert rows(kept, "transaction_id") == [("0",), ("1",), ("2",)]
    events = progress.progress(spark, str(tmp_path / "out" / "progress"))
    assert events.filter("input_rows = 1").count() == 5 and events.count() == events.select("run_id", "batch_id").distinct().count()
    assert rows(progress.late_drops(spark, str(tmp_path / "out" / "progress")), "input_rows", "late_rows_dropped") == [(5, 2)]
    # A run without news adds events, but no rows.
    streams.watched_run(spark, once, str(tmp_path / "out"))
    assert rows(progress.late_drops(spark, str(tmp_path / "out" / "progress")), "input_rows", "late_rows_dropped") == [(5, 2)]


def test_state_partitions_follow_the_size_of_the_input(spark, tables, tmp_path):
    """A small input does not pay for as many state partitions as the session has configured, nor does a large one get more."""
    before, events = spark.conf.get("spark.sql.shuffle.partitions"), spark.read.parquet(f"{tables}/events.parquet")
    try:
        for configured, wanted in (("200", sinks.LEAST_STATE_PARTITIONS), ("3", 3)):
            spark.conf.set("spark.sql.shuffle.partitions", configured)
            assert sinks.state_partitions(events) == wanted
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        stream = table_stream(spark, f"{tables}/events.parque[t]", events.schema).select("user_id", F.col("ts").cast("timestamp").alias("event_timestamp"))
        daily = aggregates.flat_window(aggregates.daily_counts(stream, ["user_id"], "event_timestamp", "2 days"))
        streams.roll_up_run(spark, daily, str(tmp_path), state_partitions=sinks.state_partitions(events))
        assert len([p for p in (tmp_path / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()]) == sinks.LEAST_STATE_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
