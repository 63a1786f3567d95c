"""Latency records from their topic to the published table."""

import json

import pytest
from pyspark.sql import functions as F

from chatloom.operators import compare_groups, latency_summary
from chatloom.plans.catalog import AVAILABLE_NOW
from chatloom.sources import read_messages, read_messages_stream
from chatloom.streaming import (
    format_job,
    latency_table,
    latency_totals,
    publish_latency,
    read_latency,
    read_latency_stream,
    read_latency_table,
    unique_records,
    wide_table,
)


def value(i, ms, task="censor", engine="spark", load=31, record=None):
    out = {"message_id": i, "task": task, "arrived_at": "2024-01-01T00:00:00.000Z", "latency_ms": ms}
    out |= {"engine": engine, "load": load, "record": record}
    return json.dumps({key: item for key, item in out.items() if item is not None})


def put(folder, name, values):
    (folder / "topic" / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / "topic" / name).write_text("\n".join(values) + "\n")


def publish(spark, folder):
    stream = read_latency_stream(spark, str(folder / "topic"), maxFilesPerTrigger="1")
    publish_latency(stream, str(folder / "table"), str(folder / "checkpoint"), AVAILABLE_NOW).awaitTermination()
    rows = read_latency_table(spark, str(folder / "table")).collect()
    return {(row.task, row.load, row.engine): (row.n, row.mean_ms, row.std_ms, row.max_ms) for row in rows}


def test_copies_count_once_over_batches_and_restarts(spark, tmp_path):
    put(tmp_path, "batch_id=0/a", [value(i, 10 * i, record=f"r-0-{i}") for i in range(3)])
    put(tmp_path, "batch_id=1/b", [value(i, 10 * i, record=f"r-0-{i}") for i in range(3)] + ["{broken", ""])
    first = publish(spark, tmp_path)
    assert first[("censor", 31, "spark")] == (3, 10.0, 10.0, 20.0)
    put(tmp_path, "batch_id=2/c", [value(1, 10, record="r-0-1"), value(1, 10, record="r-1-0"), value(9, 70, load=77), value(9, 70, load=77)])
    second = publish(spark, tmp_path)
    assert second[("censor", 31, "spark")][0] == 4
    # Without a name, the message and its arrival tell.
    assert second[("censor", 77, "spark")] == (1, 70.0, None, 70.0)
    assert len(list((tmp_path / "table").glob("batch_id=*"))) <= 2


def test_stream_equals_batch(spark, tmp_path):
    values = [value(i, (i * 7919) % 1000, engine="ab"[i % 2], load=31 + i % 3, record=f"x-{i}") for i in range(300)]
    put(tmp_path, "a", values[:200])
    put(tmp_path, "b", values[100:])
    got = publish(spark, tmp_path)
    records = unique_records(read_latency(spark, str(tmp_path / "topic")))
    assert records.count() == 300
    want = latency_summary(records, ["task", "load", "engine"], F.col("latency_ms") * 1000).collect()
    assert got == {(r.task, r.load, r.engine): (r.n, r.mean_ms, r.std_ms, r.max_ms) for r in want}


def test_totals_are_exact_and_merge(spark):
    big = 4_000_000_000
    rows = [("t", big + i, "e", 1) for i in range(3)]
    records = spark.createDataFrame(rows, "task string, latency_ms bigint, engine string, load bigint")
    totals = latency_totals(records)
    assert latency_table(totals).first()[3:] == (3, big + 1.0, 1.0, big + 2.0)
    assert latency_table(totals.union(totals)).first().n == 6
    none = latency_totals(records.withColumn("latency_ms", F.lit(None).cast("bigint")))
    assert latency_table(none).first()[3:] == (0, None, None, None)


def test_a_repeated_batch_writes_the_same_records(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"message_id": i, "text": "x"}) for i in (1, 2, 2)]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))

    def run():
        raw = read_messages_stream(spark, str(tmp_path / "in"))
        format_job(
            raw, str(tmp_path / "out"), str(tmp_path / "checkpoint"), str(tmp_path / "bad"),
            latency=str(tmp_path / "latency"), trigger=AVAILABLE_NOW, engine="spark", load=31,
        ).awaitTermination()
        return sorted(map(tuple, read_latency(spark, str(tmp_path / "latency")).collect()))

    first = run()
    assert len({row[-1] for row in first}) == 3 and {row[4:6] for row in first} == {("spark", 31)}
    # As after a failure just before the commit of the batch.
    for name in ("commits/0", "commits/.0.crc"):
        (tmp_path / "checkpoint" / name).unlink(missing_ok=True)
    assert run() == first
    assert read_messages(spark, str(tmp_path / "out")).count() == 3


def test_wide_table(spark):
    rows = [("format", 31, "flink", 5, 3.62, 1.62, 42.0), ("format", 31, "spark", 5, 93.83, None, 743.0)]
    table = spark.createDataFrame(rows, "task string, load bigint, engine string, n bigint, mean_ms double, std_ms double, max_ms double")
    got = wide_table(table, ["flink", "spark", "none"]).first()
    assert tuple(got) == ("format", 31, "3.62±1.62", 42.0, "93.83±0.00", 743.0, None, None)


def test_lag_of_a_group_of_tasks(spark):
    # Published run times of counting and both top lists (fixed values): Spark, then Hive on Tez.
    spark_s = [49, 78, 232, 72, 116, 673, 123, 123, 620]
    tez_s = [59, 112, 347, 89, 139, 806, 87, 144, 701]
    rows = [("ordering", e, float(s)) for e, times in (("spark", spark_s), ("tez", tez_s)) for s in times] + [("other", "tez", 1.0)]
    frame = spark.createDataFrame(rows, "kind string, engine string, seconds double")
    got = {r.kind: r.excess_pct for r in compare_groups(frame, ["kind"], "engine", "spark", "tez", "seconds").collect()}
    assert got["ordering"] == pytest.approx(19.1, abs=0.05) and got["other"] is None
