import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from chatloom.operators import censor_messages, format_messages, stamp_latency
from chatloom.plans import views
from chatloom.plans.catalog import AVAILABLE_NOW
from chatloom.schema import MESSAGE_COLUMNS, RAW, STORED_MESSAGES
from chatloom.session import scratch_dir
from chatloom.sources import read_messages, read_messages_stream, subscribe_channels
from chatloom.sources.messages import MAX_BATCH_OFFSETS, kafka_source_options
from chatloom.streaming import (
    censor_job,
    format_job,
    log_batches,
    read_counts,
    read_latency,
    write_latency_stream,
    write_messages_stream,
)
from chatloom.streaming.progress import batch_durations
from chatloom.streaming.sinks import kafka_sink_options, parse_latency


def line(i, text="hello", day=1):
    sent_at = datetime(2024, 1, day, 12, 0, 0, i).isoformat(sep=" ", timespec="microseconds")
    record = {
        "message_id": i, "sent_at": sent_at, "user_id": i % 3, "channel_id": i % 2, "text": text,
    }
    return json.dumps(record)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(folder, name, lines):
    (folder / "in" / name).write_text("\n".join(lines) + "\n")


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_equals_batch_over_many_batches(spark, folder):
    for n in range(4):
        put(folder, f"{n}.json", [line(n * 10 + i, "an Idiot", 1 + n) for i in range(10)])
    source = read_messages_stream(spark, str(folder / "in"), maxFilesPerTrigger="1")
    query = write_messages_stream(
        censor_messages(format_messages(source), ["idiot"]),
        str(folder / "out"),
        str(folder / "checkpoint"),
        AVAILABLE_NOW,
    )
    query.awaitTermination()
    assert batch_durations(spark, query).agg(F.sum("n_rows")).first()[0] == 40
    assert query.lastProgress["batchId"] == 3
    stored = read_messages(spark, str(folder / "out"))
    values = spark.read.schema(RAW).text(str(folder / "in"))
    assert same_rows(stored, censor_messages(format_messages(values), ["idiot"]))
    days = sorted(path.name for path in (folder / "out").glob("sent_date=*"))
    assert days == [f"sent_date=2024-01-0{day}" for day in (1, 2, 3, 4)]
    plan = stored.where("sent_date = date'2024-01-02'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(sent_date" in plan.toString()


def test_restart_continues_without_duplicates(spark, folder):
    def run():
        source = format_messages(read_messages_stream(spark, str(folder / "in")))
        write_messages_stream(
            source, str(folder / "out"), str(folder / "checkpoint"), AVAILABLE_NOW, files_per_batch=1
        ).awaitTermination()
        return sorted(r["message_id"] for r in read_messages(spark, str(folder / "out")).collect())

    put(folder, "a.json", [line(i) for i in range(5)])
    assert run() == list(range(5))
    assert run() == list(range(5))
    put(folder, "b.json", [line(i) for i in range(5, 8)])
    assert run() == list(range(8))


def test_format_job_splits_good_and_bad(spark, folder):
    put(folder, "a.json", [line(1, " hi "), "{broken", line(2), '{"text":"no id"}'])
    format_job(
        read_messages_stream(spark, str(folder / "in")),
        str(folder / "out"),
        str(folder / "checkpoint"),
        quarantine=str(folder / "bad"),
        latency=str(folder / "latency"),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    stored = read_messages(spark, str(folder / "out"))
    assert stored.schema == STORED_MESSAGES
    rows = stored.orderBy("message_id").collect()
    assert [(row["message_id"], row["text"]) for row in rows] == [(1, "hi"), (2, "hello")]
    bad = [row["value"] for row in spark.read.parquet(str(folder / "bad")).collect()]
    assert sorted(bad) == ['{"text":"no id"}', "{broken"]
    latency = read_latency(spark, str(folder / "latency")).collect()
    assert sorted(row["message_id"] for row in latency) == [1, 2]
    # The file was written just now; its age when processed is the latency.
    assert all(row["task"] == "format" and 0 <= row["latency_ms"] < 120_000 for row in latency)


def test_repeated_batch_replaces_its_output(spark, folder):
    put(folder, "a.json", [line(i, "idiot") for i in range(6)])

    def run(checkpoint):
        censor_job(
            read_messages_stream(spark, str(folder / "in")),
            ["idiot"],
            str(folder / "out"),
            str(folder / checkpoint),
            str(folder / "bad"),
            latency=str(folder / "latency"),
            trigger=AVAILABLE_NOW,
        ).awaitTermination()

    run("checkpoint")
    run("lost-checkpoint")  # batch 0 again, as after a failure before its commit
    stored = spark.read.parquet(str(folder / "out"))
    assert sorted(row["message_id"] for row in stored.collect()) == list(range(6))
    assert {row["text"] for row in stored.collect()} == {"***"}
    assert read_latency(spark, str(folder / "latency")).count() == 6


def test_job_takes_a_lexicon_too_large_for_a_pattern(spark, folder, monkeypatch):
    put(folder, "a.json", [line(1, "idiot and scum"), line(2, "fine")])
    raw = read_messages_stream(spark, str(folder / "in"))
    bare = censor_messages(format_messages(raw), ["scum", "idiot and"], max_pattern_chars=0)
    write_messages_stream(bare, str(folder / "bare"), str(folder / "bare-checkpoint"), AVAILABLE_NOW).awaitTermination()
    stored = read_messages(spark, str(folder / "bare")).orderBy("message_id").collect()
    assert [row["text"] for row in stored] == ["*** ***", "fine"]
    lexicon = spark.createDataFrame([("idiot",), ("scum",)], "word string")
    monkeypatch.setattr(
        "chatloom.streaming.jobs.censor_messages",
        lambda *args: censor_messages(*args, max_pattern_chars=0),
    )
    censor_job(
        raw,
        lexicon,
        str(folder / "out"),
        str(folder / "checkpoint"),
        str(folder / "bad"),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    stored = spark.read.parquet(str(folder / "out")).orderBy("message_id").collect()
    assert [row["text"] for row in stored] == ["*** and ***", "fine"]


def test_channels_may_change_between_batches(spark, folder):
    wanted = [1]

    def run():
        format_job(
            read_messages_stream(spark, str(folder / "in")),
            str(folder / "out"),
            str(folder / "checkpoint"),
            str(folder / "bad"),
            channels=lambda: spark.createDataFrame([(c,) for c in wanted], "channel_id bigint"),
            trigger=AVAILABLE_NOW,
        ).awaitTermination()
        return sorted(r["message_id"] for r in read_messages(spark, str(folder / "out")).collect())

    put(folder, "a.json", [line(i) for i in range(4)])
    assert run() == [1, 3]
    wanted.append(0)
    put(folder, "b.json", [line(i) for i in range(4, 8)])
    assert run() == [1, 3, 4, 5, 6, 7]


def test_every_batch_is_remembered(spark, folder):
    for n in range(105):
        put(folder, f"{n}.json", [line(n)])
    source = read_messages_stream(spark, str(folder / "in"), maxFilesPerTrigger="1")
    query = source.writeStream.format("noop").option("checkpointLocation", str(folder / "c"))
    log_batches(spark)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert batch_durations(spark, query).count() == 105


def test_batches_of_another_session_are_remembered(spark, folder):
    put(folder, "a.json", [line(1)])
    log_batches(spark)
    other = spark.newSession()
    log_batches(other)
    query = read_messages_stream(other, str(folder / "in")).writeStream.format("noop")
    query = query.option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert batch_durations(other, query).count() == 1


def test_subscription_filters_a_stream(spark, folder):
    put(folder, "a.json", [line(i) for i in range(6)])
    channels = spark.createDataFrame([(1,)], "channel_id bigint")
    for name, limit in (("broadcast", 10), ("shuffled", 0)):
        source = format_messages(read_messages_stream(spark, str(folder / "in")))
        write_messages_stream(
            subscribe_channels(source, channels, max_broadcast=limit),
            str(folder / name),
            str(folder / f"{name}-checkpoint"),
            AVAILABLE_NOW,
        ).awaitTermination()
        kept = read_messages(spark, str(folder / name)).collect()
        assert sorted(row["message_id"] for row in kept) == [1, 3, 5]


def test_latency_stream_round_trip(spark, folder):
    put(folder, "a.json", [line(i) for i in range(4)])
    source = read_messages_stream(spark, str(folder / "in"))
    with_id = source.select(
        F.get_json_object("value", "$.message_id").cast("bigint").alias("message_id"), "arrived_at"
    )
    write_latency_stream(
        stamp_latency(with_id, "format"),
        str(folder / "out"),
        str(folder / "checkpoint"),
        AVAILABLE_NOW,
    ).awaitTermination()
    rows = read_latency(spark, str(folder / "out")).collect()
    assert sorted(row["message_id"] for row in rows) == [0, 1, 2, 3]
    assert all(row["latency_ms"] >= 0 and row["arrived_at"] is not None for row in rows)


def test_topic_values_parse_back(spark):
    value = b'{"message_id":1,"task":"t","arrived_at":"2024-01-01T00:00:00.000Z","latency_ms":5}'
    row = parse_latency(spark.createDataFrame([(value,)], "value binary")).first()
    assert (row["message_id"], row["task"], row["latency_ms"]) == (1, "t", 5)


def test_table_stream_reads_files_and_folders(spark, folder, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(folder / "events.parquet"))
    for source in (sf_dir, str(folder)):
        stream = views.read_table_stream(spark, f"{source}/events.parquet", events.schema)
        out = scratch_dir(spark, "events")
        query = stream.writeStream.format("parquet").trigger(availableNow=True)
        query.option("checkpointLocation", f"{out}-checkpoint").start(out).awaitTermination()
        assert same_rows(spark.read.parquet(out), events)


def test_kafka_source_options():
    options = kafka_source_options("chat", **{"kafka.bootstrap.servers": "h:1", "minPartitions": "9"})
    assert options == {
        "subscribe": "chat",
        "kafka.bootstrap.servers": "h:1",
        "minPartitions": "9",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": MAX_BATCH_OFFSETS,
    }
    with pytest.raises(ValueError, match="bootstrap"):
        kafka_source_options("chat")
    with pytest.raises(ValueError, match="exactly one"):
        kafka_source_options("chat", **{"kafka.bootstrap.servers": "h:1", "subscribePattern": "c.*"})
    with pytest.raises(ValueError, match="exactly one"):
        kafka_source_options(**{"kafka.bootstrap.servers": "h:1"})


def test_kafka_sink_options():
    options = kafka_sink_options("latency", **{"kafka.bootstrap.servers": "h:1"})
    assert options == {"topic": "latency", "kafka.bootstrap.servers": "h:1"}
    with pytest.raises(ValueError, match="bootstrap"):
        kafka_sink_options("latency")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared + "/") and first != second


def test_wire_format_round_trip(spark, sf_dir):
    chat = views.chat(spark, sf_dir)
    back = format_messages(views.raw(chat)).select(*MESSAGE_COLUMNS)
    assert same_rows(back, chat.withColumn("text", F.trim("text")).select(*MESSAGE_COLUMNS))


@pytest.mark.parametrize("staged", [False, True])
def test_jobs_cache_nothing_and_parse_clean_batches_once(spark, folder, staged, monkeypatch):
    monkeypatch.delattr(DataFrame, "persist")
    parsed = spark.sparkContext.accumulator(0)
    put(folder, "a.json", [line(i) for i in range(4)])
    put(folder, "b.json", [line(i) for i in range(4, 7)] + ["{broken"])

    @F.udf("string")
    def seen(value):
        parsed.add(1)
        return value

    raw = read_messages_stream(spark, str(folder / "in"), maxFilesPerTrigger="1")
    format_job(
        raw.withColumn("value", seen.asNondeterministic()("value")),
        str(folder / "out"),
        str(folder / "checkpoint"),
        quarantine=str(folder / "bad"),
        latency=str(folder / "latency") if staged else None,
        counts=str(folder / "counts"),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    assert sorted(row["message_id"] for row in read_messages(spark, str(folder / "out")).collect()) == list(range(7))
    assert [row["value"] for row in spark.read.parquet(str(folder / "bad")).collect()] == ["{broken"]
    # The batch with a bad value is parsed again for the quarantine, the other is not.
    assert parsed.value == 4 + 2 * 4
    assert {row[0]: row[1] for row in read_counts(spark, str(folder / "counts"), "channel_id").collect()} == {0: 4, 1: 3}


def test_bad_values_are_kept_though_no_channel_is_wanted(spark, folder):
    put(folder, "a.json", [line(1), "{broken"])
    raw = read_messages_stream(spark, str(folder / "in"))
    nothing = spark.createDataFrame([], "channel_id bigint")
    out, checkpoint, bad = (str(folder / name) for name in ("out", "checkpoint", "bad"))
    format_job(raw, out, checkpoint, bad, channels=lambda: nothing, trigger=AVAILABLE_NOW).awaitTermination()
    assert [row["value"] for row in spark.read.parquet(bad).collect()] == ["{broken"]
