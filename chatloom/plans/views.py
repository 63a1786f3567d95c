"""Chat views over the test tables.

Events stand for messages: each takes the text of the document whose id is its own id modulo the
number of documents (document ids run from 0).
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.messages import read_table_stream

# The lexicon of the registered queries (fixed values).
LEXICON = [
    "trash", "scum", "idiot", "clown", "worthless",
    "moron", "pathetic", "loser", "stupid", "disgusting",
]

# Micro-batch bound of the streaming queries: a lost driver repeats at most this much.
MAX_BYTES_PER_BATCH = str(2**40)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chat_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without their text, one per event. Counting and ranking need no more."""
    return _headers(table(spark, sf_dir, "events"))


def headers_without_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headers that are left when ``error`` events are not; their ids have holes."""
    events = table(spark, sf_dir, "events")
    return _headers(events.where(F.col("event_type") != "error"))


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with their text."""
    return with_text(chat_headers(spark, sf_dir), table(spark, sf_dir, "documents"))


def with_text(headers: DataFrame, documents: DataFrame) -> DataFrame:
    """``headers`` with the text of each message."""
    # No broadcast hint: documents grow with the data, so Spark decides by their size whether to
    # broadcast or to shuffle, and the keys are even.
    # Their number is read from the file footers.
    keyed = headers.withColumn("doc_id", F.try_mod("message_id", F.lit(documents.count())))
    return keyed.join(documents.select("doc_id", "text"), "doc_id").drop("doc_id")


def chat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as :func:`chat`, as a stream. ``arrived_at`` is the time its file was written."""
    events = table(spark, sf_dir, "events")
    stream = read_table_stream(
        spark, f"{sf_dir}/events.parquet", events.schema, maxBytesPerTrigger=MAX_BYTES_PER_BATCH
    )
    arrived = stream.select("*", F.col("_metadata.file_modification_time").alias("arrived_at"))
    return with_text(_headers(arrived, "arrived_at"), table(spark, sf_dir, "documents"))


def raw(messages: DataFrame) -> DataFrame:
    """``messages`` as the JSON values a broker would hold."""
    carried = [name for name in ("arrived_at",) if name in messages.columns]
    return messages.select(_wire_value().alias("value"), *carried)


def raw_with_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON values of which those of ``error`` events were cut off after the second field."""
    headers = _headers(table(spark, sf_dir, "events"), "event_type")
    messages = with_text(headers, table(spark, sf_dir, "documents"))
    cut = F.format_string('{"message_id":%d,"user_id":%d', "message_id", "user_id")
    whole = F.coalesce(F.col("event_type") != "error", F.lit(True))
    return messages.select(F.when(whole, _wire_value()).otherwise(cut).alias("value"))


def raw_of_several_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON values in three layouts: this package's, and nested ones with the time as microseconds or with a zone."""
    messages = chat(spark, sf_dir)
    nested = [
        F.col("message_id").cast("string").alias("id"),
        F.struct(F.col("user_id").alias("id"), F.lit("someone").alias("login")).alias("user"),
        F.struct(F.col("channel_id").alias("id")).alias("streamer"),
        F.col("text").alias("message"),
    ]
    utc = F.col("sent_at").cast("string")
    micros = F.to_json(F.struct(*nested, F.unix_micros(F.to_timestamp(F.concat(utc, F.lit("+00:00")))).alias("timestamp")))
    ahead = F.concat((F.col("sent_at") + F.expr("INTERVAL 3 HOURS")).cast("string"), F.lit("+03:00"))
    zoned = F.to_json(F.struct(*nested, ahead.alias("timestamp")))
    form = F.col("message_id") % 3
    return messages.select(F.when(form == 0, _wire_value()).when(form == 1, micros).otherwise(zoned).alias("value"))


def latency_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A latency record per event, from two engines."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("task"),
        F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("engine"),
        F.col("ts").alias("arrived_at"),
        F.round(F.col("value") * 1000).cast("bigint").alias("latency_us"),
    )


def latency_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A latency record per event, as a job writes it: two engines, at the three published loads."""
    load = F.element_at(F.array(F.lit(31), F.lit(77), F.lit(123)), (F.col("user_id") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"),
        F.col("event_type").alias("task"),
        F.col("ts").cast("timestamp").alias("arrived_at"),
        F.expr("cast(round(value * 1000) as bigint) div 1000").alias("latency_ms"),
        F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("engine"),
        load.cast("bigint").alias("load"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("record"),
    )


def hourly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency records, named as if the events of each hour were a batch."""
    hour = F.date_format("arrived_at", "yyyyMMddHH")
    return latency_records(spark, sf_dir).withColumn("record", F.concat_ws("-", F.lit("run"), hour, "message_id"))


def hourly_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch log in which each hour is through 250 ms after its last event."""
    hours = hourly_records(spark, sf_dir).groupBy(F.regexp_extract("record", r"^(run-\d+)-", 1).alias("batch"))
    return hours.agg((F.max("arrived_at") + F.expr("INTERVAL 0.25 SECONDS")).alias("committed_at"))


def long_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon, all pairs of its words as phrases, and an entry per document that no text holds."""
    words = spark.createDataFrame([(word,) for word in LEXICON], "word string")
    pairs = words.select(F.explode(F.array(*[F.concat("word", F.lit(f" {word}")) for word in LEXICON])).alias("word"))
    unused = table(spark, sf_dir, "documents").select(F.format_string("qqzzxx%d", "doc_id").alias("word"))
    return words.union(pairs).union(unused)


def popular_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channel list of the subscription query: channels 0 and 1."""
    channels = chat_headers(spark, sf_dir).select("channel_id").distinct()
    return channels.where(F.col("channel_id").isin(0, 1))


def subscription_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of subscriptions: every ``error`` event is one, of its own channel and time."""
    headers = _headers(table(spark, sf_dir, "events").where(F.col("event_type") == "error"))
    return headers.select("channel_id", F.col("sent_at").alias("changed_at"), (F.col("message_id") % 2 == 0).alias("wanted"))


def _headers(events: DataFrame, *extra: str) -> DataFrame:
    return events.select(
        F.col("event_id").alias("message_id"),
        F.col("ts").alias("sent_at"),
        "user_id",
        F.floor(F.col("value") / 10).cast("bigint").alias("channel_id"),
        *extra,
    )


def _wire_value() -> Column:
    sent_at = F.col("sent_at").cast("string").alias("sent_at")
    return F.to_json(F.struct("message_id", sent_at, "user_id", "channel_id", "text"))
