"""Split window groups must give what plain windows give."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import rows
from tideline.operators.ordered import SplitPolicy, window_groups, with_next, with_previous

TIGHT = SplitPolicy(max_share=0.05, min_rows=1)
START = datetime(2024, 1, 1)


def plain(df, order):
    w = Window.partitionBy("k").orderBy(*order)
    return df.select("*", F.lag("v").over(w).alias("before"), F.lead("v").over(w).alias("after"))


def split(df, along, order, policy=TIGHT):
    groups = window_groups(df, ["k"], along, policy)
    return groups, with_next(with_previous(groups, order, {"before": "v"}), order, {"after": "v"}).finished()


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "bigint"])
def test_hot_key_is_cut_and_the_result_is_the_same(spark, kind):
    data = [("hot", START + timedelta(hours=7 * i), i) for i in range(300)]
    data += [(f"k{i % 40}", START + timedelta(hours=i), 1000 + i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v int")
    at = F.col("v").cast("bigint") if kind == "bigint" else F.col("t").cast(kind)
    df = df.withColumn("t", at)
    groups, got = split(df, "t", ["t", "v"])
    assert groups.sliced
    per_slice = groups.rows.filter("k = 'hot'").groupBy("__slice").count().agg(F.max("count")).first()[0]
    assert per_slice < 100
    assert rows(got) == rows(plain(df, ["t", "v"]))


def test_without_heavy_key_the_plan_is_plain(spark):
    df = spark.createDataFrame([("a", START, 1), ("b", START, 2)], "k string, t timestamp_ntz, v int")
    groups, got = split(df, "t", ["t"], SplitPolicy())
    assert not groups.sliced and got.columns == ["k", "t", "v", "before", "after"]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t timestamp_ntz, v int")
    assert split(df, "t", ["t"])[1].count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 12)), min_size=1, max_size=40))
def test_any_rows(spark, pairs):
    data = [(k, START + timedelta(minutes=t), i) for i, (k, t) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v int").coalesce(2)
    assert rows(split(df, "t", ["t", "v"])[1]) == rows(plain(df, ["t", "v"]))


def test_a_burst_is_spread_over_the_slices(spark):
    """20,000 rows of one key within hours, and one of ten years before: slices hold about equally many."""
    data = spark.range(20_000).selectExpr(
        "'hot' AS k", "CASE WHEN id = 0 THEN 0L ELSE 315360000L + id END AS t", "CAST(id AS INT) AS v"
    )
    groups, got = split(data, "t", ["t"])
    sizes = [r["count"] for r in groups.rows.groupBy("__slice").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 20_000 / 20
    assert rows(got) == rows(plain(data, ["t"]))
