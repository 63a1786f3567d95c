import pytest
from pyspark.sql import functions as F

from chatloom.operators import compare_runs, latency_summary, load_rate, stamp_latency

# Published run times in seconds: task, records, Spark, Hive on Tez, MapReduce (fixed values).
PUBLISHED = [
    ("count", 34650, 49, 59, 127),
    ("count", 69106, 78, 112, 224),
    ("count", 237531, 232, 347, 768),
    ("censor", 34650, 24, 95, 224),
    ("censor", 69106, 58, 173, 531),
    ("censor", 237531, 195, 328, 1387),
    ("top channels", 34650, 72, 89, 160),
    ("top channels", 69106, 116, 139, 361),
    ("top channels", 237531, 673, 806, 1514),
    ("top users", 34650, 123, 87, 158),
    ("top users", 69106, 123, 144, 260),
    ("top users", 237531, 620, 701, 1415),
]


@pytest.fixture(scope="module")
def published(spark):
    rows = [
        (task, n, engine, seconds)
        for task, n, *per_engine in PUBLISHED
        for engine, seconds in zip(("spark", "tez", "mapreduce"), per_engine, strict=True)
    ]
    return spark.createDataFrame(rows, "task string, n bigint, engine string, seconds int").cache()


def test_summary_of_known_values(spark):
    rows = [("a", 1000), ("a", 2000), ("a", 6000), ("b", 500), ("c", None)]
    frame = spark.createDataFrame(rows, "task string, latency_us bigint")
    got = {row["task"]: tuple(row)[1:] for row in latency_summary(frame, ["task"]).collect()}
    assert got == {
        "a": (3, 3.0, 2.646, 6.0),
        "b": (1, 0.5, None, 0.5),
        "c": (0, None, None, None),
    }


def test_summary_of_millisecond_stamps(spark):
    frame = spark.createDataFrame([(4,), (6,)], "latency_ms bigint")
    row = latency_summary(frame, [], F.col("latency_ms") * 1000).first()
    assert tuple(row) == (2, 5.0, 1.414, 6.0)


# Both spans cross a change to summer time in New York.
ARRIVALS = {
    "timestamp": "timestamp_seconds(1710050400 + s)",
    "timestamp_ntz": "timestamp_ntz'2024-03-10 01:30:00' + make_dt_interval(0, 0, 0, s)",
}


@pytest.mark.parametrize("kind", ARRIVALS)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_rate_counts_real_seconds(spark, kind, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("a", 0), ("a", 1), ("a", 3600 * 4), ("b", 0)]
        frame = spark.createDataFrame(rows, "task string, s int")
        frame = frame.withColumn("arrived_at", F.expr(ARRIVALS[kind]))
        assert dict(frame.dtypes)["arrived_at"] == kind
        got = dict(map(tuple, load_rate(frame, ["task"], unit_s=3600).collect()))
        assert got == {"a": 0.75, "b": None}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_comparison_needs_both_engines(spark):
    rows = [("t", "x", 2.0), ("t", "y", 5.0), ("u", "x", 1.0), ("v", "y", 0.0), ("w", "z", 1.0)]
    frame = spark.createDataFrame(rows, "task string, engine string, v double")
    got = {row["task"]: tuple(row)[1:] for row in
           compare_runs(frame, ["task"], "engine", "x", "y", "v").collect()}
    assert got == {"t": (2.5, 60.0), "u": (None, None), "v": (None, None), "w": (None, None)}


def test_published_batch_runs(published):
    def totals(other, tasks=None):
        rows = published if tasks is None else published.where(F.col("task").isin(*tasks))
        summed = rows.groupBy("engine").agg(F.sum("seconds").alias("seconds"))
        return compare_runs(summed, [], "engine", "spark", other, "seconds").first()

    assert totals("tez")["ratio"] == pytest.approx(1.303, abs=5e-4)
    assert totals("tez")["lag_pct"] == pytest.approx(23.3, abs=0.05)
    assert totals("mapreduce")["ratio"] == pytest.approx(3.02, abs=5e-3)
    grouping = totals("tez", ["count", "top channels", "top users"])
    assert grouping["ratio"] == pytest.approx(1.191, abs=5e-4)
    censoring = totals("tez", ["censor"])
    assert censoring["ratio"] == pytest.approx(2.15, abs=5e-3)
    assert censoring["lag_pct"] == pytest.approx(53.5, abs=0.05)

    cells = compare_runs(published, ["task", "n"], "engine", "spark", "tez", "seconds").collect()
    slower = {(row["task"], row["n"]) for row in cells if row["ratio"] < 1}
    assert slower == {("top users", 34650)}
    mean_lag = [row["lag_pct"] for row in cells if row["task"] == "censor"]
    assert sum(mean_lag) / 3 == pytest.approx(60.6, abs=0.05)


def test_stamp_moves_within_a_query(spark):
    # A slow row pushes the clock of the later ones; a batch-start clock would stand still.
    slow = spark.range(0, 200_000, 1, 1).withColumn("arrived_at", F.current_timestamp())
    work = slow.withColumn("h", F.sha2(F.repeat(F.col("id").cast("string"), 200), 512))
    stamps = stamp_latency(work, "t").select("latency_ms", "h").agg(
        F.count_distinct("latency_ms").alias("n"), F.min("latency_ms").alias("low"), F.max("h")
    )
    row = stamps.first()
    assert row["n"] > 5
    assert row["low"] >= 0
