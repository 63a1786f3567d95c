"""From latency records, as they come from their topic, to the published table of means, spreads and peaks.

A record may arrive more than once: a batch is repeated after a failure, a task of it is run again. Copies
are found by the record's name, which :func:`chatloom.streaming.jobs.run_job` gives and keeps for a repeated
batch. The stream remembers names for as long as copies may follow each other, so its state is bounded.
Totals are kept exactly, as integers, and the table is worked out from them when it is read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..files import delete
from ..sources.messages import read_messages_stream
from .progress import log_batches
from .sinks import parse_latency

KEYS = ["task", "load", "engine"]
#: How long after a record a copy of it may follow.
COPY_DELAY = "1 day"

_TOTALS = "task string, load bigint, engine string, n bigint, sum_ms decimal(38,0), squares decimal(38,0), max_ms bigint"
_EXACT = "decimal(19,0)"


def read_latency_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Latency records as a stream, with ``written_at``; arguments as for ``read_messages_stream``."""
    if source != "kafka":
        # The jobs write a folder per batch.
        options.setdefault("recursiveFileLookup", "true")
    raw = read_messages_stream(spark, source, **options)
    return parse_latency(raw.withColumnRenamed("arrived_at", "written_at"), carry=("written_at",))


def unique_records(records: DataFrame, delay: str = COPY_DELAY) -> DataFrame:
    """Each record once. A record without a name is known by its message, task and arrival.

    A stream forgets a record once ``written_at`` has moved on by ``delay``; a later copy would count again.
    """
    named = records.select("*", F.coalesce("record", _described()).alias("_name"))
    keys = [*KEYS, "_name"]
    if records.isStreaming:
        unique = named.withWatermark("written_at", delay).dropDuplicatesWithinWatermark(keys)
    else:
        unique = named.dropDuplicates(keys)
    return unique.drop("_name")


def latency_totals(records: DataFrame) -> DataFrame:
    """Exact number, sum, sum of squares and peak of the latency, per task, load and engine."""
    value = F.col("latency_ms").cast(_EXACT)
    return records.groupBy(*KEYS).agg(
        F.count("latency_ms").alias("n"),
        F.sum(value).cast("decimal(38,0)").alias("sum_ms"),
        F.sum((value * value).cast("decimal(38,0)")).alias("squares"),
        F.max("latency_ms").alias("max_ms"),
    )


def latency_table(totals: DataFrame) -> DataFrame:
    """Number, mean, sample deviation and peak, from totals of which several rows may have the same key."""
    n, total, squares = F.sum("n"), F.sum("sum_ms").cast("decimal(38,0)"), F.sum("squares").cast("decimal(38,0)")
    merged = totals.groupBy(*KEYS).agg(n.alias("n"), total.alias("s"), squares.alias("q"), F.max("max_ms").alias("max_ms"))
    # n^2 times the variance is an integer, so it is exact before the one division.
    spread = F.col("n").cast(_EXACT) * F.col("q") - F.col("s").cast(_EXACT) * F.col("s").cast(_EXACT)
    pairs = F.col("n").cast("double") * (F.col("n") - 1)
    return merged.select(
        *KEYS,
        "n",
        F.round(F.try_divide(F.col("s").cast("double"), F.col("n")), 3).alias("mean_ms"),
        F.round(F.sqrt(F.try_divide(spread.cast("double"), F.nullif(pairs, F.lit(0.0)))), 3).alias("std_ms"),
        F.col("max_ms").cast("double").alias("max_ms"),
    )


def publish_latency(
    records: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    delay: str = COPY_DELAY,
    name: str | None = None,
) -> StreamingQuery:
    """Keeps the totals of a stream of records below ``path`` up to date; read by :func:`read_latency_table`."""
    log_batches(records.sparkSession)

    def write(totals: DataFrame, batch_id: int) -> None:
        # There is a row per task, load and engine. One file appears as a whole, or not at all.
        totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        delete(totals.sparkSession, f"{path}/batch_id={batch_id - 2}")

    totals = latency_totals(unique_records(records, delay))
    writer = totals.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.queryName(name or f"latency {path}").start()


def read_latency_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the last batch that :func:`publish_latency` has written."""
    batches = spark.read.schema(f"{_TOTALS}, batch_id bigint").parquet(path)
    last = batches.agg(F.max("batch_id").alias("batch_id"))
    return latency_table(batches.join(F.broadcast(last), "batch_id"))


def wide_table(table: DataFrame, engines: list[str]) -> DataFrame:
    """A row per task and load, and for each engine its mean with spread, and its peak."""

    def of(engine: str, value: Column) -> Column:
        return F.max(F.when(F.col("engine") == engine, value))

    shown = F.format_string("%.2f±%.2f", "mean_ms", F.coalesce("std_ms", F.lit(0.0)))
    columns = [of(e, v).alias(f"{e}_{kind}") for e in engines for kind, v in (("ms", shown), ("peak_ms", F.col("max_ms")))]
    return table.groupBy("task", "load").agg(*columns)


def _described() -> Column:
    return F.concat_ws("/", F.col("message_id").cast("string"), F.unix_micros("arrived_at").cast("string"))
