import pytest
from pyspark.sql import functions as F

from support import plan, rows
from tideline.catalog import inputs
from tideline.operators import joins, partitions, skew
from tideline.plans import skewjobs


@pytest.fixture(scope="module")
def fact(spark, tables):
    return inputs.skewed_events(spark, tables)


@pytest.fixture(scope="module")
def users(spark, tables):
    # Without some users, so that left and inner joins differ.
    return inputs.users(spark, tables).filter("user_id <> 3")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salts", [1, 7, None])
def test_salted_joins_equal_the_plain_join(fact, users, how, salts):
    want = rows(fact.join(users, "user_id", how))
    assert rows(skew.salted_join(fact, users, ["user_id"], ["event_id"], salts, how)) == want
    assert rows(skew.heavy_key_join(fact, users, ["user_id"], ["event_id"], salts and 50 * salts, how)) == want


def test_a_salted_join_copies_the_dimension_for_salts_that_occur(spark):
    """With as many salts as the largest key needs, copies for all of them would be 40 million rows here, broadcast."""
    fact = spark.range(2000).select(F.col("id").alias("event_id"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    dimension = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
    joined = skew.salted_join(fact, dimension, ["k"], ["event_id"], 20_000)
    assert "explode" not in plan(joined)
    assert rows(joined) == rows(fact.join(dimension, "k"))
    spread = fact.withColumn("__salt", skew.salt_of(["event_id"], 20_000))
    assert skew._used_copies(dimension, spread, ["k"]).count() <= fact.count()


def test_salts_follow_the_weight_of_a_key(fact, spark):
    total = fact.filter("user_id = 0").count()
    assert rows(skew.salt_counts(fact, ["user_id"], 100)) == [(0, -(-total // 100))]
    assert skew.salt_counts(fact, ["user_id"], total).count() == 0
    nulls = fact.withColumn("user_id", F.when(F.col("user_id") != 0, F.col("user_id")))
    assert rows(skew.salt_counts(nulls, ["user_id"], 100)) == [(None, -(-total // 100))]
    copies = skew.salted_sides(nulls, nulls.select("user_id").distinct(), ["user_id"], ["event_id"], skew.salt_counts(nulls, ["user_id"], 100))[1]
    assert copies.filter("user_id is null").count() == -(-total // 100)
    assert copies.filter("user_id is not null").count() == nulls.select("user_id").distinct().count() - 1


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("n, partitions", [(60_000, 8), (600_000, 32)])
def test_a_key_with_a_third_of_the_rows_makes_no_task_twice_the_mean(spark, no_broadcast, n, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    fact = spark.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"))
    dimension = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("name"))
    largest = lambda df: partitions_of(df)["max_rows"] / (n / partitions)
    partitions_of = lambda df: partitions_report(df).first()
    assert largest(fact.join(dimension, "k")) > 2
    assert largest(skew.heavy_key_join(fact, dimension, ["k"], ["event_id"])) < 2


def partitions_report(df):
    return partitions.partition_report(df, "joined")


def test_salt_does_not_depend_on_partitioning(fact):
    salt = skew.salt_of(["event_id"], 5).alias("s")
    assert rows(fact.repartition(1).select("event_id", salt)) == rows(fact.repartition(7).select("event_id", salt))


def test_other_join_kinds_are_refused(fact, users):
    with pytest.raises(ValueError):
        skew.salted_join(fact, users, ["user_id"], ["event_id"], 2, "full_outer")


def test_broadcast_only_within_the_size_limit(fact, users, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.dimension_join(fact, users, ["user_id"]))
        assert "SortMergeJoin" in plan(joins.dimension_join(fact, users, ["user_id"], limit=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sum_before_join(fact):
    got = joins.sum_before_join(fact, ["user_id"], total="amount")
    assert got.columns == ["user_id", "total"] and got.count() == fact.select("user_id").distinct().count()


def test_profile_is_sorted(fact):
    counts = [r["row_count"] for r in skew.key_profile(fact, ["user_id"]).collect()]
    assert counts == sorted(counts, reverse=True) and counts[0] > 0.9 * sum(counts)


def test_salted_totals_have_no_cartesian_product(fact):
    assert "Cartesian" not in plan(skew.salted_totals(fact, ["user_id"], ["event_id"], "amount", 4))


def test_top_share(fact):
    row = skew.top_key_share(fact, ["user_id"], 1).first()
    assert row["top_rows"] == fact.filter("user_id = 0").count() and row["all_rows"] == fact.count()


def test_partition_reports(fact):
    total = fact.count()
    for layout, n in ((partitions.by_count(fact, 6), 6), (partitions.merge_down(partitions.by_count(fact, 6), 2), 2)):
        report = partitions.partition_report(layout, "x").first()
        assert (report["partitions"], report["total_rows"]) == (n, total)
        assert report["skew"] < 1.1
    one = partitions.partition_report(partitions.by_keys(fact, 4, ["user_id"]), "x").first()
    two = partitions.partition_report(partitions.by_keys(fact, 4, ["user_id", "event_id"]), "x").first()
    assert two["max_rows"] < one["max_rows"]


def test_range_layout_splits_a_hot_value(fact):
    laid_out = partitions.clustered(fact, ["user_id"], 4)
    report = partitions.partition_report(laid_out, "x").first()
    assert report["partitions"] == 4 and report["max_rows"] < 0.5 * fact.count()
    assert rows(laid_out) == rows(fact)
    ordered = laid_out.select(F.spark_partition_id().alias("p"), "user_id").collect()
    assert all(a["user_id"] <= b["user_id"] for a, b in zip(ordered, ordered[1:]) if a["p"] == b["p"])


def test_three_inputs_give_three_plans(spark, fact, users, tmp_path):
    """A small dimension, a large one with even keys, and a large one with a hot key."""
    even = fact.withColumn("user_id", F.col("event_id") % 100)
    size = joins.planned_bytes(fact)
    cases = {
        skewjobs.BROADCAST: (fact, joins.BROADCAST_BYTES, "BroadcastHashJoin"), skewjobs.PLAIN: (even, 0, "SortMergeJoin"),
        skewjobs.SALTED: (fact, 0, skew._SALT),
    }
    for way, (left, limit, shown) in cases.items():
        chosen = skewjobs.choose(left, users, ["user_id"], limit, size // 8)
        assert chosen.way == way and chosen.partitions == -(-(size + joins.planned_bytes(users)) // (size // 8)) or left is even
        joined = skewjobs.carry_out(chosen, left, users, ["user_id"], ["event_id"])
        text = plan(joined)
        if way != skewjobs.BROADCAST:  # the layout that was asked for is the join's own
            assert text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM") == 2
        assert shown in text and rows(joined) == rows(left.join(users, "user_id"))
    assert skewjobs.choose(fact, users, ["user_id"], 0).partitions == 1  # 256 MB hold it all


def test_metrics_come_with_the_output_and_a_repeat_replaces_its_row(spark, fact, users, tmp_path):
    table = str(tmp_path / "metrics")
    for run_id, left in (("a", fact.limit(0)), ("b", fact.limit(5)), ("b", fact), ("c", fact)):
        skewjobs.tuned(left, users, ["user_id"], ["event_id"], str(tmp_path / "out"), metrics=table, run_id=run_id)
    got = {r["run_id"]: r for r in skew.metrics(spark, table).collect()}
    joined = fact.join(users, "user_id")
    counts = sorted((r[1] for r in joined.groupBy("user_id").count().collect()), reverse=True)
    assert set(got) == {"a", "b", "c"} and got["a"]["all_rows"] == 0 and got["a"]["top_share"] is None
    for run in "bc":
        assert (got[run]["all_rows"], got[run]["largest_key_rows"], got[run]["top_rows"]) == (sum(counts), counts[0], sum(counts[:10]))
