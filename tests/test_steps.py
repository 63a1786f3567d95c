"""Steps of load and latency up to the commit, against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chatloom.operators import load_steps, with_steps
from chatloom.streaming import commit_latency, format_job, read_commits, read_latency

START = datetime(2024, 3, 10, 1, 30)


def plain_steps(rows, gap_us):
    """(key, step) of each row with a time, in the order of times."""
    out, last = {}, {}
    for i, (key, at) in sorted((x for x in enumerate(rows) if x[1][1] is not None), key=lambda x: x[1][1]):
        before, step = last.get(key, (None, 1))
        if before is not None and (at - before) / timedelta(microseconds=1) > gap_us:
            step += 1
        last[key] = at, step
        out[i] = step
    return out


def random_rows(seed):
    """Bursts, pauses at and just over the gap, ties, null keys and times, times before 1970."""
    rng, rows = random.Random(seed), []
    for key in ("a", "b", None):
        at = START if key else datetime(1969, 12, 31, 23, 59, 58)
        for _ in range(150):
            at += timedelta(microseconds=rng.choice([0, 1, 300, 9_999, 9_999_999, 10_000, 10_001, 20_000, 5_000_000]))
            rows.append((key, at))
    rows += [("a", None), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("gap_ms", [1, 10, 9_999])
def test_steps_equal_a_plain_loop(spark, kind, gap_ms):
    rows = random_rows(gap_ms)
    want = plain_steps(rows, gap_ms * 1000)
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, task string, arrived_at timestamp_ntz")
    frame = frame.withColumn("arrived_at", F.col("arrived_at").cast(kind)).withColumn("load", F.lit("told"))
    for options in ({}, {"max_broadcast": 0}):
        got = with_steps(frame, ["task"], gap_ms, **options).collect()
        assert len(got) == len(rows)
        assert {row.i: row.step for row in got if row.step is not None} == want
    steps = {(r.task, r.step): r for r in load_steps(frame, ["task"], gap_ms).collect()}
    assert {row.i: row.load for row in got if row.step and steps[row.task, row.step].rate is None} == {
        row.i: None for row in got if row.step and steps[row.task, row.step].rate is None
    }
    held = {}
    for i, step in want.items():
        held.setdefault((rows[i][0], step), []).append(rows[i][1])
    assert set(steps) == set(held)
    for key, times in held.items():
        span = (max(times) - min(times)) / timedelta(seconds=1)
        assert steps[key].n == len(times)
        assert (steps[key].rate is None) == (span == 0)
        assert not span or abs(steps[key].rate - len(times) / span) < 1e-5


def test_published_loads_come_from_the_records(spark):
    """Ten seconds each at 31, 77 and 123 messages a second, a minute apart."""
    times = [START + timedelta(minutes=k, microseconds=i * 1_000_000 // load) for k, load in enumerate((31, 77, 123)) for i in range(10 * load + 1)]
    frame = spark.createDataFrame([(at,) for at in times], "arrived_at timestamp_ntz")
    got = with_steps(frame, [], 5_000).groupBy("step", "load").count().collect()
    assert sorted(map(tuple, got)) == [(1, 31, 311), (2, 77, 771), (3, 123, 1231)]


def test_steps_of_nothing(spark):
    none = spark.createDataFrame([], "task string, arrived_at timestamp")
    assert load_steps(none, ["task"], 10).count() == 0 and with_steps(none, ["task"], 10).count() == 0
    with pytest.raises(ValueError):
        load_steps(none, ["task"], 0)


def test_cells_are_ordered_in_blocks(spark):
    frame = spark.range(40_000).select(F.timestamp_seconds("id").alias("arrived_at"))
    plan = load_steps(frame, [], 1_000)._jdf.queryExecution().executedPlan().toString()
    assert "_block" in plan
    assert load_steps(frame, [], 1_000).collect()[0].n == 40_000


def test_commit_latency_of_records(spark):
    records = spark.createDataFrame(
        [("r-0-1", 0, 5), ("r-0-8589934592", 10, 5), ("q-r-1-0", 20, 5), ("r-7-0", 0, 5), (None, 0, 5), ("x", 0, 5)],
        "record string, at long, latency_ms long",
    ).withColumn("arrived_at", F.timestamp_millis("at"))
    commits = spark.createDataFrame([("r-0", 100), ("r-0", 90), ("q-r-1", 50), ("r-2", 1)], "batch string, at long")
    commits = commits.select("batch", F.timestamp_millis("at").alias("committed_at"))
    want = {"r-0-1": 100, "r-0-8589934592": 90, "q-r-1-0": 30, "r-7-0": None, None: None, "x": None}
    for options in ({}, {"max_broadcast": 0}):
        got = commit_latency(records.withColumn("total_ms", F.lit("old")), commits, **options).collect()
        assert {row.record: row.total_ms for row in got} == want and len(got) == len(want)


def test_every_batch_of_a_job_is_logged(spark, tmp_path):
    lines = ['{"message_id":%d,"sent_at":"2024-01-01 00:00:00","user_id":1,"channel_id":1,"text":"t"}' % i for i in range(6)]

    def run():
        raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
        raw = raw.withColumn("arrived_at", F.current_timestamp())
        places = [str(tmp_path / name) for name in ("messages", "checkpoint", "bad")]
        options = {"latency": str(tmp_path / "latency"), "commits": str(tmp_path / "commits"), "trigger": {"availableNow": True}}
        format_job(raw, *places, **options).awaitTermination()

    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(lines[3 * k : 3 * k + 3]) + "\n")
    run()
    (tmp_path / "in" / "2.json").write_text(lines[0] + "\n")
    run()
    commits = read_commits(spark, str(tmp_path / "commits"))
    assert commits.count() == 3 and commits.select("batch").distinct().count() == 3
    through = commit_latency(read_latency(spark, str(tmp_path / "latency")), commits).collect()
    assert len(through) == 7
    assert all(row.total_ms >= row.latency_ms >= 0 for row in through)
