import pytest
from pyspark.sql import functions as F

from support import at, rows
from tideline.plans import marts, sessions
from tideline.sinks import zones

KINDS = (
    "event_id string, session_id string, user_id string, product_id int, event_type string, "
    "event_time timestamp_ntz, ingestion_time timestamp_ntz"
)
FIRST = [
    ("e1", "s1", "u", 1, "view", at("2024-01-02 10:00"), at("2024-01-02 10:00")),
    ("e2", "s1", "u", 1, "click", at("2024-01-02 11:00"), at("2024-01-02 11:00")),
    ("e3", "s2", "v", 2, "view", at("2024-01-02 12:00"), at("2024-01-02 12:00")),
    ("e4", "s3", "v", 2, "view", at("2024-01-05 12:00"), at("2024-01-05 12:00")),
    ("e5", None, "w", 1, "view", at("2024-01-06 12:00"), at("2024-01-06 12:00")),
    ("e6", "s6", "w", 1, "view", None, at("2024-01-06 12:00")),
    ("e7", "s7", "w", 1, "view", at("2024-01-09 12:00"), at("2024-01-09 12:00")),
]
LATER = [
    ("e8", "s1", "u", 1, "view", at("2024-01-01 23:00"), at("2024-02-01 00:00")),  # the session now starts a day earlier
    ("e4", "s9", "v", 2, "view", at("2024-01-05 12:00"), at("2024-02-01 00:00")),  # the only event of s3 belongs to s9
    ("e9", None, "w", 1, "view", at("2024-01-03 12:00"), at("2024-02-01 00:00")),  # the session without a name moves
    ("e6", "s6", "w", 1, "view", at("2024-01-09 01:00"), at("2024-02-01 00:00")),  # a session without a date gets one
]


@pytest.fixture(scope="module")
def products(spark):
    return spark.sql("SELECT * FROM VALUES (1, 'toys', 2.5D, true), (2, 'food', 9.0D, true) AS p(product_id, category, price, is_active)")


def events(spark, data):
    return spark.createDataFrame(data, KINDS)


def full(spark, data, products):
    return rows(marts.session_metrics(events(spark, data), products))


def test_moved_sessions_leave_their_old_dates(spark, products, tmp_path):
    root = str(tmp_path)
    sessions.publish(events(spark, FIRST), products, root, buckets=4)
    assert rows(sessions.read(spark, root)) == full(spark, FIRST, products)
    before = set(sessions.read(spark, root).filter("session_id = 's2'").inputFiles())
    for _ in range(2):  # a repeated run changes nothing
        sessions.publish(events(spark, FIRST + LATER), products, root, "2024-01-31")
        got = sessions.read(spark, root)
        assert rows(got) == full(spark, FIRST + LATER, products)
        dates = {r[0] and str(r[0]) for r in got.select("event_date").collect()}
        folders = {f.split("event_date=")[1].split("/")[0] for f in got.inputFiles()}
        assert dates == folders == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-09"}
    assert before


def test_untouched_dates_keep_their_files(spark, products, tmp_path):
    root = str(tmp_path)
    sessions.publish(events(spark, FIRST), products, root, buckets=4)
    kept = {f for f in sessions.read(spark, root).inputFiles() if "2024-01-05" in f}
    sessions.publish(events(spark, FIRST + LATER[:1]), products, root, "2024-01-31")
    assert kept and kept <= set(sessions.read(spark, root).inputFiles())


def test_the_index_says_where_sessions_are(spark, products, tmp_path):
    root = str(tmp_path)
    sessions.publish(events(spark, FIRST), products, root, buckets=4)
    sessions.publish(events(spark, FIRST + LATER), products, root, "2024-01-31")
    layout = zones.current(spark, f"{root}/index")
    index = zones.read(spark, f"{root}/index", "index", layout)
    assert rows(index) == rows(sessions.read(spark, root).select("session_id", "event_date"))


def test_a_failed_run_is_repeated(spark, products, tmp_path, monkeypatch):
    """The output is written, the index is not: the next run finds the old dates and ends the same."""
    root = str(tmp_path)
    sessions.publish(events(spark, FIRST), products, root, buckets=4)

    def fails(*args):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(zones, "publish", fails)
        with pytest.raises(OSError):
            sessions.publish(events(spark, FIRST + LATER), products, root, "2024-01-31")
    sessions.publish(events(spark, FIRST + LATER), products, root, "2024-01-31")
    assert rows(sessions.read(spark, root)) == full(spark, FIRST + LATER, products)


def test_the_first_run_takes_all(spark, products, tmp_path):
    with pytest.raises(FileNotFoundError):
        sessions.publish(events(spark, FIRST), products, str(tmp_path), "2024-01-03")


def test_files_are_capped(spark, products, tmp_path, monkeypatch):
    monkeypatch.setattr(sessions, "FILE_ROWS", 10)
    many = spark.range(95).select(
        F.col("id").cast("string").alias("event_id"), F.concat(F.lit("s"), "id").alias("session_id"), F.lit("u").alias("user_id"),
        F.lit(1).alias("product_id"), F.lit("view").alias("event_type"), F.lit(at("2024-01-02")).cast("timestamp_ntz").alias("event_time"),
        F.lit(at("2024-01-02")).cast("timestamp_ntz").alias("ingestion_time"),
    )
    sessions.publish(many, products, str(tmp_path), buckets=2)
    got = sessions.read(spark, str(tmp_path))
    assert got.count() == 95 and len(got.inputFiles()) >= 10
