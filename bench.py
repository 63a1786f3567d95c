"""Timings of the batch tasks at the published sizes, and latency of the streaming jobs at the
published loads. Prints one JSON line.

BENCH_SF_DIR    test tables (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default 8)
BENCH_RUNS      timed runs per batch task, the median counts (default 3)
BENCH_SECONDS   length of each streaming latency run (default 6, 0 leaves them out)
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from chatloom.operators import (  # noqa: E402
    censor_messages,
    compare_runs,
    count_messages,
    drop_profane_messages,
    format_messages,
    latency_summary,
    load_rate,
    stamp_latency,
    top_channels,
    top_users,
)
from chatloom.plans import views  # noqa: E402
from chatloom.plans.catalog import AVAILABLE_NOW  # noqa: E402
from chatloom.session import build_session, scratch_dir  # noqa: E402
from chatloom.sources import dataset_prefix, read_messages, read_messages_stream  # noqa: E402
from chatloom.streaming import write_messages_stream  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SECONDS = float(os.environ.get("BENCH_SECONDS", "6"))

# Published experiment: records per batch run, messages per second per streaming run (fixed values).
SIZES = [34_650, 69_106, 237_531]
LOADS = {"format": [31, 77, 123], "censor": [36, 80, 115]}

FILE_MANAGER = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)

TICK_S = 0.05
WARM_UP_S = 4
FILES_PER_CPU = 8


def drain(frame):
    """Computes every row and column of ``frame`` and keeps nothing."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action, runs=RUNS):
    """Median seconds of ``runs`` runs after one warm-up."""
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def store_messages(spark, folder):
    """The message table at rest, with enough copies of the chat for the largest size."""
    chat = views.chat(spark, SF_DIR)
    n = views.table(spark, SF_DIR, "events").count()
    copies = -(-max(SIZES) // n)
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    copied = chat.withColumn("copy", copy).withColumn(
        "message_id", F.col("message_id") + F.col("copy") * n
    )
    path = f"{folder}/messages"
    dated = copied.drop("copy").withColumn("sent_date", F.to_date("sent_at"))
    # Files hold ranges of ids, as a sink would have written them in the order of arrival.
    by_id = dated.repartitionByRange(CPUS * FILES_PER_CPU, "message_id")
    by_id.write.partitionBy("sent_date").parquet(path)
    return read_messages(spark, path)


def batch_times(spark, folder):
    start = time.perf_counter()
    messages = store_messages(spark, folder)
    print(f"stored messages in {time.perf_counter() - start:.1f} s", file=sys.stderr)
    tasks = {
        "count_messages": lambda frame: count_messages(frame).collect(),
        "censor_messages": lambda frame: drain(censor_messages(frame, views.LEXICON)),
        "top_channels": lambda frame: top_channels(frame).collect(),
        "top_users": lambda frame: top_users(frame).collect(),
    }
    times = {}
    for task, action in tasks.items():
        for size in SIZES:
            prefix = dataset_prefix(messages, size)
            times[f"{task}_{size}"] = timed(lambda: action(prefix))
    largest = dataset_prefix(messages, SIZES[-1])
    raw = views.raw(largest)
    extra = {
        "censor_messages_length": lambda: drain(
            censor_messages(largest, views.LEXICON, mask="length")
        ),
        "drop_profane_messages": lambda: drain(drop_profane_messages(largest, views.LEXICON)),
        "format_messages": lambda: drain(format_messages(raw)),
    }
    for name, action in extra.items():
        times[f"{name}_{SIZES[-1]}"] = timed(action)
    log = views.latency_log(spark, SF_DIR)
    times["latency_summary"] = timed(lambda: latency_summary(log, ["task"]).collect())
    times["load_rate"] = timed(lambda: load_rate(log, ["task"], 3600).collect())
    times["compare_runs"] = timed(
        lambda: compare_runs(log, ["task"], "engine", "a", "b", "latency_us").collect()
    )
    raw.write.text(f"{folder}/raw")
    for task in LOADS:
        name = f"stream_{task}_{SIZES[-1]}"
        times[name] = timed(lambda: drain_stream(spark, f"{folder}/raw", task), runs=1)
    return times


def drain_stream(spark, source, task):
    """Streams all stored raw values through a job into a new message table."""
    out = scratch_dir(spark, task)
    messages = transformed(spark, source, task)
    query = write_messages_stream(messages, f"{out}/messages", f"{out}/checkpoint", AVAILABLE_NOW)
    query.awaitTermination()


def transformed(spark, source, task):
    messages = format_messages(read_messages_stream(spark, source), carry=("arrived_at",))
    return censor_messages(messages, views.LEXICON) if task == "censor" else messages


def feed(values, folder, prefix, rate):
    """Drops JSON lines into ``folder`` at ``rate`` per second, one file per tick."""
    begun, sent = time.monotonic(), 0
    while sent < len(values):
        due = min(int((time.monotonic() - begun) * rate) + 1, len(values))
        if due > sent:
            hidden = folder / f".{prefix}{sent}.json"
            hidden.write_text("\n".join(values[sent:due]) + "\n")
            hidden.rename(folder / f"{prefix}{sent}.json")
            sent = due
        time.sleep(TICK_S)


def streaming_latency(spark, folder, task, rate):
    """Mean, deviation and peak of the per-message latency of one job under one load."""
    run = Path(folder) / f"{task}-{rate}"
    incoming = run / "in"
    incoming.mkdir(parents=True)
    warm, total = int(rate * WARM_UP_S), int(rate * (WARM_UP_S + SECONDS))
    chat = dataset_prefix(views.chat(spark, SF_DIR), total)
    values = [row["value"] for row in views.raw(chat).collect()]
    # About a hundred messages per second: one task per batch is enough.
    stamped = stamp_latency(transformed(spark, str(incoming), task), task).coalesce(1)
    query = write_messages_stream(stamped, str(run / "out"), str(run / "checkpoint"))
    # The first batches compile the plan, so they are left out of the summary.
    feed(values[:warm], incoming, "warm", rate)
    query.processAllAvailable()
    begun = time.time()
    feed(values[warm:], incoming, "run", rate)
    query.processAllAvailable()
    query.stop()
    stored = spark.read.parquet(str(run / "out"))
    measured = stored.where(F.unix_millis("arrived_at") >= int(begun * 1000))
    row = latency_summary(measured, [], F.col("latency_ms") * 1000).first()
    return {key: row[key] for key in ("n", "mean_ms", "std_ms", "max_ms")}


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=str(CPUS),
        # Text work is bound by the processor, and the files are small: smaller splits use all of it.
        spark__sql__files__maxPartitionBytes="8m",
        spark__sql__files__openCostInBytes="256k",
        # Without checksum files a local commit starts half as many processes to set permissions.
        spark__hadoop__fs__file__impl="org.apache.hadoop.fs.RawLocalFileSystem",
        spark__hadoop__fs__AbstractFileSystem__file__impl="org.apache.hadoop.fs.local.RawLocalFs",
        # For a local disk only: its rename is atomic, so the logs need no second file system layer.
        spark__sql__streaming__checkpointFileManagerClass=FILE_MANAGER,
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = scratch_dir(spark, "bench")
    times = batch_times(spark, folder)
    latency = {}
    if SECONDS > 0:
        for task, loads in LOADS.items():
            for rate in loads:
                latency[f"{task}_{rate}_per_s"] = streaming_latency(spark, folder, task, rate)
    result = {
        "metric": "batch tasks at published sizes, sum of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "stream_latency": latency,
        "cpus": CPUS,
        "runs": RUNS,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
