import pytest
from pyspark.sql import functions as F

from support import at, plan, rows
from tideline.catalog import inputs
from tideline.operators import cdc, joins, merge
from tideline.operators.checks import CheckFailed, require_empty
from tideline.operators.scd import Dimension
from tideline.plans import feeds

LIMITS = [32 << 20, 0]


@pytest.fixture(scope="module")
def target(spark):
    return spark.sql("SELECT * FROM VALUES (1, 'a', 10), (2, 'b', 20), (3, NULL, 30) AS t(k, name, n)")


@pytest.fixture(scope="module")
def source(spark):
    return spark.sql(
        "SELECT * FROM VALUES (2, 'B', 21, 'U'), (3, 'C', 31, 'D'), (4, 'D', 41, 'I'), (5, 'E', 51, 'D') AS s(k, name, n, op)"
    )


@pytest.mark.parametrize("limit", LIMITS)
def test_upsert(target, source, limit):
    got = merge.upsert(target, source, ["k"], limit)
    assert rows(got) == [(1, "a", 10), (2, "B", 21), (3, "C", 31), (4, "D", 41), (5, "E", 51)]
    assert rows(merge.upsert(got, source, ["k"], limit)) == rows(got)


@pytest.mark.parametrize("limit", LIMITS)
def test_merge_clauses(target, source, limit):
    got = merge.merge(
        target, source, ["k"],
        update={"name": "name"}, update_when=F.col("s.n") > F.col("t.n"),
        delete_when=F.col("s.op") == "D",
        insert={"k": "k", "name": "name"}, insert_when=F.col("s.op") != "D", broadcast_limit=limit,
    )
    assert rows(got) == [(1, "a", 10), (2, "B", 20), (4, "D", None)]
    assert got.schema.fieldNames() == target.columns


@pytest.mark.parametrize("limit", LIMITS)
def test_merge_without_clause_changes_nothing(target, source, limit):
    assert rows(merge.merge(target, source, ["k"], broadcast_limit=limit)) == rows(target)


def test_small_source_leaves_the_target_in_place(target, source):
    assert "SortMergeJoin" not in plan(merge.upsert(target, source, ["k"]))
    assert "FullOuter" in plan(merge.matched_pairs(target, source, ["k"], 0))


def test_conflicting_source_rows_are_found(source):
    require_empty(merge.conflicting_keys(source, ["k"]), "conflict")
    with pytest.raises(CheckFailed, match="conflict"):
        require_empty(merge.conflicting_keys(source.union(source), ["k"]), "conflict")


def feed(spark, *events):
    return spark.createDataFrame(
        [(k, c, o, at(t), i) for i, (k, c, o, t) in enumerate(events)],
        "customer_id int, city string, operation string, event_time timestamp_ntz, seq int",
    )


def state_of(spark, *batches):
    state = cdc.empty_state(batches[0], ["customer_id"], ["city"], "event_time", ["seq"])
    for batch in batches:
        state = cdc.apply_feed(state, batch, ["customer_id"], ["city"], "event_time", ["seq"])
    return rows(cdc.live(state, ["customer_id"], ["city"]), "customer_id", "city")


def test_invalid_last_operation_does_not_hide_the_one_before(spark):
    events = feed(spark, (1, "A", "INSERT", "2024-01-01"), (1, "X", "NOOP", "2024-01-02"), (2, "B", "DELETE", "2024-01-01"))
    assert state_of(spark, events) == [(1, "A")]


def test_feed_in_batches_replayed_and_late(spark):
    first = feed(spark, (1, "A", "INSERT", "2024-01-02"), (2, "B", "INSERT", "2024-01-02"))
    second = feed(spark, (1, "C", "UPDATE", "2024-01-03"), (2, "B", "DELETE", "2024-01-03"))
    late = feed(spark, (1, "Z", "UPDATE", "2024-01-01"), (1, "Z", "DELETE", "2024-01-01"))
    assert state_of(spark, first, second) == [(1, "C")]
    assert state_of(spark, first, second, second) == [(1, "C")]
    assert state_of(spark, first, second, late) == [(1, "C")]


def test_feed_by_batch_equals_feed_at_once(spark, tables):
    events = inputs.change_feed(spark, tables)
    parts = [events.filter(F.year("event_time") < 1998), events.filter(F.year("event_time") >= 1998)]
    assert state_of(spark, *parts) == state_of(spark, events)


def test_late_boundary(spark):
    events = feed(spark, (1, "A", "INSERT", "2024-01-01 00:00:00"), (1, "A", "UPDATE", "2024-01-02 00:00:01"))
    assert cdc.late_events(events, "2024-01-03 00:00:00").count() == 1


def test_any_batch_order_gives_the_latest_per_key(spark):
    """Deletes stay known: older events arriving later, and replays, bring nothing back."""
    events = [
        (1, "A", "INSERT", "2024-01-01"), (1, "B", "UPDATE", "2024-01-03"), (1, "B", "DELETE", "2024-01-05"),
        (2, "C", "INSERT", "2024-01-02"), (2, "D", "DELETE", "2024-01-02"), (2, "E", "INSERT", "2024-01-06"),
        (3, "F", "DELETE", "2024-01-04"), (3, "G", "INSERT", "2024-01-04"),
    ]
    whole = feed(spark, *events)
    wanted = [(2, "E"), (3, "G")]
    assert state_of(spark, whole) == wanted
    for cut in (1, 2, 3):
        parts = [whole.filter(F.pmod(F.col("seq") * 5, F.lit(4)) == k) for k in range(4)]
        order = parts[cut:] + parts[:cut] + parts[:1]
        assert state_of(spark, *order) == wanted


@pytest.mark.parametrize("limit", LIMITS)
def test_null_keys_match_each_other(spark, limit):
    stored = spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT), 'a', 1), (2, 'b', 2) AS t(k, name, n)")
    batch = spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT), 'z', 9) AS s(k, name, n)")
    for _ in range(3):
        stored = merge.upsert(stored, batch, ["k"], limit)
    assert rows(stored) == [(2, "b", 2), (None, "z", 9)]
    assert rows(merge.merge(stored, batch, ["k"], update={"n": F.col("t.n") + F.col("s.n")}, insert={"k": "k"}, broadcast_limit=limit)) == [
        (2, "b", 2), (None, "z", 18)
    ]


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("key", [2, None])
def test_a_repeated_source_key_stops_the_job(spark, target, limit, key):
    twice = spark.createDataFrame([(key, "B", 21), (key, "B", 22), (4, "D", 41)], "k int, name string, n int")
    for merged in (
        lambda: merge.merge(target, twice, ["k"], update={"name": "name"}, broadcast_limit=limit),
        lambda: merge.merge(target, twice, ["k"], insert={"k": "k"}, insert_when=F.lit(False), broadcast_limit=limit),
        lambda: merge.upsert(target, twice, ["k"], limit),
    ):
        with pytest.raises(Exception, match="several source rows for the key"):
            merged().collect()
    assert len(rows(merge.upsert(target, twice.filter("n <> 22"), ["k"], limit))) == len(rows(target)) + 1 + (key is None)


def test_the_check_reads_the_source_once(target, source):
    text = plan(merge.one_row_per_key(source, ["k"]))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("LocalTableScan") <= 1


DIM = Dimension(("customer_id",), ("city",), "event_time", ("seq",))


def advance(spark, root, events, keep="10 days"):
    return feeds.advance(spark, events, root, DIM, keep, buckets=4)


def test_marks_of_deletes_go_behind_the_horizon_and_old_events_are_refused(spark, tmp_path):
    root = str(tmp_path / "feed")
    first = feed(spark, (1, "A", "INSERT", "2024-01-01"), (1, "A", "DELETE", "2024-01-03"), (2, "B", "INSERT", "2024-01-03"))
    assert advance(spark, root, first) == feeds.Retention("2023-12-24 00:00:00.000000", 0)
    replay = feed(spark, (1, "A", "INSERT", "2024-01-01"), (2, "Z", "UPDATE", "2024-01-02"))
    advance(spark, root, replay)
    assert rows(feeds.live(spark, root, DIM), "customer_id", "city") == [(2, "B")]
    assert feeds.state(spark, root).filter(cdc.DELETED).count() == 1
    # A newer event of another key moves the horizon past the mark, whose bucket gets no event.
    advance(spark, root, feed(spark, (3, "C", "INSERT", "2024-01-20")))
    assert feeds.state(spark, root).filter(cdc.DELETED).count() == 0
    late = feed(spark, (1, "A", "INSERT", "2024-01-01"), (4, "D", "INSERT", "2024-01-09"), (5, "E", "INSERT", "2024-01-10"), (6, "F", "NOOP", "2024-01-01"))
    assert advance(spark, root, late) == feeds.Retention("2024-01-10 00:00:00.000000", 2)
    assert rows(feeds.live(spark, root, DIM), "customer_id", "city") == [(2, "B"), (3, "C"), (5, "E")]


def test_the_state_is_bounded_by_the_horizon(spark, tmp_path):
    """Every day ten keys come and go: the marks are those of the days kept, however long the feed runs."""
    root, sizes = str(tmp_path / "feed"), []
    for day in range(1, 13):
        keys = [(100 * day + i, "X", o, f"2024-01-{day:02d} {h}") for i in range(10) for o, h in (("INSERT", "01:00"), ("DELETE", "02:00"))]
        advance(spark, root, feed(spark, *keys), "3 days")
        sizes.append(feeds.state(spark, root).count())
    assert max(sizes) <= 40 and sizes[-1] == sizes[5]
    assert feeds.live(spark, root, DIM).count() == 0


def test_events_without_time_and_keys_without_value(spark, tmp_path):
    root = str(tmp_path / "feed")
    odd = feed(spark, (1, "A", "INSERT", "2024-01-01"), (None, "N", "INSERT", "2024-01-01"), (None, "M", "UPDATE", "2024-01-02"))
    untimed = odd.filter("city = 'A'").withColumn("event_time", F.lit(None).cast("timestamp_ntz")).withColumn("city", F.lit("Q"))
    assert advance(spark, root, odd.unionByName(untimed)).refused == 1
    advance(spark, root, odd.limit(0))
    assert rows(feeds.live(spark, root, DIM), "customer_id", "city") == [(1, "A"), (None, "M")]


def test_a_source_of_small_files_and_many_rows_is_not_broadcast(spark, tmp_path):
    """A merge sends a source by the size of its rows, not by that of its compressed files."""
    source = spark.range(100_000).select("id", *[F.lit("the same text in every row").alias(c) for c in "abc"])
    source.write.parquet(str(tmp_path / "source"))
    source, target = spark.read.parquet(str(tmp_path / "source")), spark.range(50_000, 150_000)
    limit = 4 << 20
    assert joins.is_small(source, limit) and not joins.fits(source, limit)
    pairs = merge.matched_pairs(target, source, ["id"], limit)
    assert "FullOuter" in plan(pairs) and pairs.count() == 150_000
    assert "LeftOuter" in plan(merge.matched_pairs(target, source.limit(10), ["id"], limit))
