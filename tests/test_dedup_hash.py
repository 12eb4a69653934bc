from pyspark.sql import functions as F

from support import plan, rows
from tideline.functions.hashing import row_hash
from tideline.functions.scalars import differs, money, money_out, parse_timestamp
from tideline.operators.dedup import latest_per_key, one_per_key, top_per_key


def hashes(spark, data, schema):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(row_hash(df, df.columns)).collect()]


def test_hash_keeps_the_place_of_nulls(spark):
    a, b = hashes(spark, [("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert a != b


def test_hash_keeps_separators_apart(spark):
    a, b, c, d = hashes(spark, [("a|b", "c"), ("a", "b|c"), ("\\N", "x"), (None, "x")], "x string, y string")
    assert len({a, b, c, d}) == 4


def test_hash_of_doubles_is_that_of_their_decimal(spark):
    (a,) = hashes(spark, [(1e8,)], "x double")
    (b,) = hashes(spark, [("100000000.000000",)], "x string")
    assert a == b
    assert len(set(hashes(spark, [(float("nan"),), (None,), (1e300,)], "x double"))) == 3


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, t int, v string")
    latest = latest_per_key(df, ["k"], ["t", "v"])
    assert rows(latest) == [("a", 2, "new"), ("b", 1, "only")]
    text = plan(latest)
    assert "Partial" in text and text.index("Final") < text.index("Partial")


def test_latest_breaks_ties_the_same_way_in_any_order(spark):
    data = [("a", 1, v) for v in "pqrs"]
    for batch in (data, data[::-1]):
        df = spark.createDataFrame(batch, "k string, t int, v string").repartition(3)
        assert rows(one_per_key(df, ["k"], ["t"])) == [("a", 1, "s")]


def test_one_per_key_keeps_columns_and_drops_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert rows(one_per_key(df, ["k"])) == [("a", 1), ("b", 2)]


def test_top_per_key(spark):
    df = spark.createDataFrame([("x", d, f) for d, f in [(1, 5), (2, 9), (3, 9), (4, 1)]], "city string, d int, fare int")
    top = top_per_key(df, ["city"], ["fare"], 3, then=["d"])
    assert rows(top, "d", "rank") == [(1, 3), (2, 1), (3, 2)]


def test_unreadable_time_is_null_and_differences_are_exact(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 10.01, 10.0), ("bad", 10.02, 10.0)], "t string, a double, b double")
    got = df.select(parse_timestamp("t").isNull(), differs(F.col("a"), F.col("b"), 0.01))
    assert [tuple(r) for r in got.collect()] == [(False, False), (True, True)]
    assert df.select(F.sum(money("a"))).first()[0].as_tuple().exponent == -2


def test_totals_have_room_beyond_single_amounts(spark):
    df = spark.range(20).select(F.lit(9e15).alias("a"))
    assert df.select(money_out(F.sum(money("a")))).first()[0] == 1.8e17
