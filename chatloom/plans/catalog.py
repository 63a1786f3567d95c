"""The registered queries, and for each the SQL that must give the same rows."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    censor_messages,
    compare_runs,
    count_messages,
    drop_profane_messages,
    format_messages,
    latency_summary,
    load_rate,
    load_steps,
    quarantine_messages,
    stamp_latency,
    top_channels,
    top_counted,
    top_keys,
    top_users,
    with_steps,
)
from ..operators.rules import format_by_rules, parse_by_rules
from ..schema import MESSAGE_COLUMNS
from ..session import scratch_dir
from ..sources import dataset_prefix, dataset_prefixes, read_messages, subscribe_changes, subscribe_channels
from ..streaming.commits import commit_latency, read_commits
from ..streaming.counts import fold_counts, read_counts, store_counts
from ..streaming.jobs import censor_job, format_job
from ..streaming.layout import compact_messages, store_batch
from ..streaming.latency import publish_latency, read_latency_stream, read_latency_table
from ..streaming.sinks import (
    latency_values,
    read_latency,
    stored_schema,
    write_messages_stream,
)
from . import views
from .sql_tasks import run_sql_task

Query = Callable[[SparkSession, str], DataFrame]

AVAILABLE_NOW = {"availableNow": True}

# The smallest and largest number of records of the published runs (fixed values). The prefix query
# takes the same share of whatever table it is given.
SMALLEST_RUN, LARGEST_RUN = 34_650, 237_531

HALF_HOUR_MS = 1_800_000


def _count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_messages(views.chat_headers(spark, sf_dir))


def _top_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_channels(views.chat_headers(spark, sf_dir))


def _top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_users(views.chat_headers(spark, sf_dir))


def _top_users_by_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_keys(views.chat_headers(spark, sf_dir), "user_id")


def _top_users_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top list from counts of four batches, one of them stored twice, of which three are folded."""
    path = scratch_dir(spark, "counts")
    headers = views.chat_headers(spark, sf_dir)
    for batch_id in (0, 1, 1, 2, 3):
        store_counts(headers.where(F.col("message_id") % 4 == batch_id), path, batch_id, ["user_id"])
        if batch_id == 2:
            fold_counts(spark, path, ["user_id"])
    return top_counted(read_counts(spark, path, "user_id"), "user_id")


def _censor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return censor_messages(views.chat(spark, sf_dir), views.LEXICON)


def _censor_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return censor_messages(views.chat(spark, sf_dir), views.LEXICON, mask="length")


def _censor_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A lexicon with no room in a pattern: every word is found by the join.
    return censor_messages(views.chat(spark, sf_dir), views.LEXICON, max_pattern_chars=0, max_table_chars=0)


def _censor_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Pairs of words are entries too, and the mask is a word.
    return censor_messages(views.chat(spark, sf_dir), views.long_lexicon(spark, sf_dir), "X", max_pattern_chars=0)


def _drop_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_profane_messages(views.chat(spark, sf_dir), views.long_lexicon(spark, sf_dir), max_pattern_chars=0)


def _stream_censor_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_messages(views.raw(views.chat_stream(spark, sf_dir)))
    masked = censor_messages(formatted, views.long_lexicon(spark, sf_dir), "X", max_pattern_chars=0)
    return _through_sink(masked, "stream-censor-phrases").select(*MESSAGE_COLUMNS)


def _drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_profane_messages(views.chat(spark, sf_dir), views.LEXICON)


def _drop_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_profane_messages(views.chat(spark, sf_dir), views.LEXICON, max_pattern_chars=0, max_table_chars=0)


def _format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_as_text(format_messages(views.raw(views.chat(spark, sf_dir))))


def _format_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_as_text(format_by_rules(views.raw_of_several_forms(spark, sf_dir)))


def _reasons_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_by_rules(views.raw_with_damage(spark, sf_dir))
    return parsed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_messages(views.raw_with_damage(spark, sf_dir))


def _format_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_as_text(format_messages(views.raw_with_damage(spark, sf_dir)))


def _subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = views.popular_channels(spark, sf_dir)
    return subscribe_channels(views.chat(spark, sf_dir), channels)


def _subscribe_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = views.popular_channels(spark, sf_dir)
    return subscribe_channels(views.chat(spark, sf_dir), channels, max_broadcast=0)


def _subscribe_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscribe_changes(views.chat(spark, sf_dir), views.subscription_log(spark, sf_dir), at="sent_at")


def _subscribe_many_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.subscription_log(spark, sf_dir)
    # Messages are shuffled here, so the text is added afterwards.
    kept = subscribe_changes(views.chat_headers(spark, sf_dir), log, at="sent_at", max_broadcast=0)
    return views.with_text(kept, views.table(spark, sf_dir, "documents"))


def _stream_subscribe_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_messages(views.raw(views.chat_stream(spark, sf_dir)))
    kept = subscribe_changes(formatted, views.subscription_log(spark, sf_dir), at="sent_at")
    return _through_sink(kept, "stream-subscribe-changes").select(*MESSAGE_COLUMNS)


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages stored as four batches, one of them twice, and packed."""
    path = scratch_dir(spark, "compacted")
    messages = format_messages(views.raw(views.chat(spark, sf_dir)))
    for batch_id in (0, 1, 1, 2, 3):
        store_batch(messages.where(F.col("message_id") % 4 == batch_id), path, batch_id)
    compact_messages(spark, path, date.max)
    return _date_as_text(read_messages(spark, path))


def _prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = views.table(spark, sf_dir, "events").count() * SMALLEST_RUN // LARGEST_RUN
    return dataset_prefix(views.chat(spark, sf_dir), n)


def _prefix_of_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that start at 1000 and stand twice each."""
    headers = views.chat_headers(spark, sf_dir).select("message_id", "user_id")
    n = views.table(spark, sf_dir, "events").count() * SMALLEST_RUN // LARGEST_RUN
    moved = headers.withColumn("message_id", F.col("message_id") + 1000)
    return dataset_prefix(moved.union(moved), 2 * n)


def _prefixes_of_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of three prefixes of a table that has every row twice and ids in steps of ten, and the sums of their ids."""
    headers = views.chat_headers(spark, sf_dir).select((F.col("message_id") - F.col("message_id") % 10).alias("message_id"), "channel_id")
    n = headers.count() * SMALLEST_RUN // LARGEST_RUN
    found = dataset_prefixes(headers.union(headers), [n, 2 * n, 3 * n])
    parts = [frame.withColumn("size", F.lit(size).cast("bigint")) for size, frame in found.items()]
    every = parts[0].union(parts[1]).union(parts[2])
    return every.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("message_id").alias("ids"))


def _prefix_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = views.table(spark, sf_dir, "events").count() * SMALLEST_RUN // LARGEST_RUN
    # The search for the n-th id reads the headers several times, so the text is added afterwards.
    prefix = dataset_prefix(views.headers_without_errors(spark, sf_dir), n)
    return views.with_text(prefix, views.table(spark, sf_dir, "documents"))


def _latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency_summary(views.latency_log(spark, sf_dir), ["task"])


def _load_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Per hour, since the records span a month.
    return load_rate(views.latency_log(spark, sf_dir), ["task"], unit_s=3600)


def _load_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Half an hour without a record ends a step.
    return load_steps(views.latency_log(spark, sf_dir), ["task"], HALF_HOUR_MS, unit_s=3600)


def _latency_by_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    stepped = with_steps(views.latency_log(spark, sf_dir), ["task"], HALF_HOUR_MS, unit_s=3600)
    # Steps are small, so their means often end in a 5 that two engines round differently: exact totals instead.
    totals = [F.count("latency_us").alias("n"), F.sum("latency_us").alias("sum_us"), F.max("latency_us").alias("max_us")]
    return stepped.groupBy("task", "step", "load").agg(*totals)


def _latency_to_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    through = commit_latency(views.hourly_records(spark, sf_dir), views.hourly_commits(spark, sf_dir))
    return latency_summary(through, ["task"], F.col("total_ms") * 1000)


def _compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.latency_log(spark, sf_dir)
    return compare_runs(log, ["task"], "engine", "a", "b", "latency_us")


def _sql(task: str, view: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: run_sql_task(task, view(spark, sf_dir), views.LEXICON)


def _stream_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_messages(views.raw(views.chat_stream(spark, sf_dir)))
    return _date_as_text(_through_sink(formatted, "stream-format"))


def _stream_censor(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_messages(views.raw(views.chat_stream(spark, sf_dir)))
    stored = _through_sink(censor_messages(formatted, views.LEXICON), "stream-censor")
    return stored.select(*MESSAGE_COLUMNS)


def _stream_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = views.popular_channels(spark, sf_dir)
    formatted = format_messages(views.raw(views.chat_stream(spark, sf_dir)))
    stored = _through_sink(subscribe_channels(formatted, channels), "stream-subscribe")
    return stored.select(*MESSAGE_COLUMNS)


def _stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked messages, each stored with the latency that it was stamped with."""
    folder = scratch_dir(spark, "stream-latency")
    messages = views.chat_stream(spark, sf_dir)
    stamped = stamp_latency(censor_messages(messages, views.LEXICON), "censor")
    write_messages_stream(
        stamped, f"{folder}/out", f"{folder}/checkpoint", AVAILABLE_NOW
    ).awaitTermination()
    stored = read_messages(spark, f"{folder}/out", stored_schema(stamped))
    return stored.select("message_id", "text", "task", (F.col("latency_ms") >= 0).alias("measured"))


def _stream_latency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency records, of which a seventh was written twice, through the stream into the published table."""
    folder = scratch_dir(spark, "stream-latency-table")
    records = latency_values(views.latency_records(spark, sf_dir))
    records.write.text(f"{folder}/topic/batch_id=0")
    again = views.latency_records(spark, sf_dir).where(F.col("message_id") % 7 == 0)
    latency_values(again).write.text(f"{folder}/topic/batch_id=1")
    stream = read_latency_stream(spark, f"{folder}/topic", maxBytesPerTrigger=views.MAX_BYTES_PER_BATCH)
    publish_latency(stream, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW).awaitTermination()
    return read_latency_table(spark, f"{folder}/table")


def _job_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job-format")
    format_job(
        views.raw(views.chat_stream(spark, sf_dir)),
        f"{folder}/messages",
        f"{folder}/checkpoint",
        quarantine=f"{folder}/quarantine",
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    return _date_as_text(read_messages(spark, f"{folder}/messages"))


def _job_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per task: messages stored by the censoring job, and how many have a usable latency."""
    folder = scratch_dir(spark, "job-censor")
    censor_job(
        views.raw(views.chat_stream(spark, sf_dir)),
        views.LEXICON,
        f"{folder}/messages",
        f"{folder}/checkpoint",
        f"{folder}/quarantine",
        latency=f"{folder}/latency",
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    stored = spark.read.parquet(f"{folder}/messages").select("message_id")
    latencies = read_latency(spark, f"{folder}/latency")
    return (
        stored.join(latencies, "message_id", "left")
        .groupBy("task")
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.count_if(F.col("latency_ms") >= 0).alias("n_measured"),
        )
    )


def _job_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per task: messages stored by the formatting job, and how many were through after they were stamped."""
    folder = scratch_dir(spark, "job-commits")
    format_job(
        views.raw(views.chat_stream(spark, sf_dir)),
        f"{folder}/messages",
        f"{folder}/checkpoint",
        f"{folder}/quarantine",
        latency=f"{folder}/latency",
        commits=f"{folder}/commits",
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    through = commit_latency(read_latency(spark, f"{folder}/latency"), read_commits(spark, f"{folder}/commits"))
    stored = read_messages(spark, f"{folder}/messages").select("message_id")
    return (
        stored.join(through, "message_id", "left")
        .groupBy("task")
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.count_if(F.col("total_ms") >= F.col("latency_ms")).alias("n_through"),
        )
    )


def _job_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job-subscribe")
    format_job(
        views.raw(views.chat_stream(spark, sf_dir)),
        f"{folder}/messages",
        f"{folder}/checkpoint",
        f"{folder}/quarantine",
        channels=lambda: views.popular_channels(spark, sf_dir),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    return read_messages(spark, f"{folder}/messages").select(*MESSAGE_COLUMNS)


def _date_as_text(messages: DataFrame) -> DataFrame:
    # Spark and DuckDB hand dates to Python as different types, which would compare as unequal.
    return messages.withColumn("sent_date", F.col("sent_date").cast("string"))


def _through_sink(messages: DataFrame, name: str) -> DataFrame:
    """Drains a stream into the message table and reads the table."""
    spark = messages.sparkSession
    folder = scratch_dir(spark, name)
    write_messages_stream(
        messages, f"{folder}/out", f"{folder}/checkpoint", AVAILABLE_NOW
    ).awaitTermination()
    return read_messages(spark, f"{folder}/out", stored_schema(messages))


QUERIES: dict[str, Query] = {
    "count_messages": _count,
    "top_channels": _top_channels,
    "top_users": _top_users,
    "top_users_by_buckets": _top_users_by_buckets,
    "top_users_from_counts": _top_users_from_counts,
    "censor_messages": _censor,
    "censor_messages_length": _censor_length,
    "censor_messages_large_lexicon": _censor_large_lexicon,
    "censor_messages_phrases": _censor_phrases,
    "drop_profane_messages": _drop,
    "drop_profane_messages_phrases": _drop_phrases,
    "drop_profane_messages_large_lexicon": _drop_large_lexicon,
    "format_messages": _format,
    "format_damaged_messages": _format_damaged,
    "quarantine_messages": _quarantine,
    "format_by_rules": _format_by_rules,
    "reasons_by_rules": _reasons_by_rules,
    "subscribe_channels": _subscribe,
    "subscribe_many_channels": _subscribe_many,
    "subscribe_changes": _subscribe_changes,
    "subscribe_many_changes": _subscribe_many_changes,
    "compacted_messages": _compacted,
    "dataset_prefix": _prefix,
    "dataset_prefix_with_holes": _prefix_with_holes,
    "dataset_prefix_of_repeats": _prefix_of_repeats,
    "dataset_prefixes_of_repeats": _prefixes_of_repeats,
    "latency_summary": _latency_summary,
    "load_rate": _load_rate,
    "load_steps": _load_steps,
    "latency_by_step": _latency_by_step,
    "latency_to_commit": _latency_to_commit,
    "compare_runs": _compare_runs,
    "sql_count_messages": _sql("count_messages", views.chat_headers),
    "sql_top_channels": _sql("top_channels", views.chat_headers),
    "sql_top_users": _sql("top_users", views.chat_headers),
    "sql_censor_messages": _sql("censor_messages", views.chat),
    "sql_censor_messages_length": lambda spark, sf_dir: run_sql_task(
        "censor_messages", views.chat(spark, sf_dir), views.LEXICON, mask="length"
    ),
    "sql_drop_profane_messages": _sql("drop_profane_messages", views.chat),
    "stream_format": _stream_format,
    "stream_censor": _stream_censor,
    "stream_censor_phrases": _stream_censor_phrases,
    "stream_subscribe": _stream_subscribe,
    "stream_subscribe_changes": _stream_subscribe_changes,
    "stream_latency": _stream_latency,
    "stream_latency_table": _stream_latency_table,
    "job_format": _job_format,
    "job_latency": _job_latency,
    "job_commits": _job_commits,
    "job_subscribe": _job_subscribe,
}

_CHAT = """
WITH chat AS (
    SELECT e.event_id AS message_id, e.ts AS sent_at, e.user_id,
           CAST(floor(e.value / 10) AS BIGINT) AS channel_id, d.text, e.event_type
    FROM events e
    JOIN documents d ON e.event_id % (SELECT count(*) FROM documents) = d.doc_id
), latency_log AS (
    SELECT event_type AS task, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS engine,
           ts AS arrived_at, CAST(round(value * 1000) AS BIGINT) AS latency_us
    FROM events
)
"""
_BAD = "|".join(views.LEXICON)
_MESSAGE = "message_id, sent_at, user_id, channel_id"
_SMALLEST_SHARE = f"(SELECT count(*) * {SMALLEST_RUN} // {LARGEST_RUN} FROM chat)"


def _masked_by_length() -> str:
    text = "text"
    for length in sorted({len(word) for word in views.LEXICON}):
        words = "|".join(word for word in views.LEXICON if len(word) == length)
        text = rf"regexp_replace({text}, '\b({words})\b', '{'*' * length}', 'gi')"
    return text


_COUNT_SQL = f"{_CHAT} SELECT count(*) AS n FROM chat"
_TOP_CHANNELS_SQL = f"""{_CHAT}
SELECT channel_id, count(*) AS n FROM chat GROUP BY 1 ORDER BY n DESC, channel_id LIMIT 10"""
_TOP_USERS_SQL = f"""{_CHAT}
SELECT user_id, count(*) AS n FROM chat GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10"""
_CENSOR_SQL = rf"""{_CHAT}
SELECT {_MESSAGE}, regexp_replace(text, '\b({_BAD})\b', '***', 'gi') AS text FROM chat"""
_CENSOR_TRIMMED_SQL = rf"""{_CHAT}
SELECT {_MESSAGE}, regexp_replace(trim(text), '\b({_BAD})\b', '***', 'gi') AS text FROM chat"""
_DROP_SQL = rf"""{_CHAT}
SELECT {_MESSAGE}, text FROM chat WHERE NOT regexp_matches(text, '\b({_BAD})\b', 'i')"""
_FORMAT_SQL = f"""{_CHAT}
SELECT {_MESSAGE}, trim(text) AS text, CAST(CAST(sent_at AS DATE) AS VARCHAR) AS sent_date FROM chat"""
_SUBSCRIBE_SQL = f"{_CHAT} SELECT {_MESSAGE}, text FROM chat WHERE channel_id IN (0, 1)"

_CHANGES_SQL = _CHAT.replace("%", "%%") + """, changes AS (
    SELECT channel_id, sent_at AS changed_at, bool_and(message_id %% 2 = 0) AS wanted
    FROM chat WHERE event_type = 'error' GROUP BY ALL
)
SELECT c.message_id, c.sent_at, c.user_id, c.channel_id, %s AS text
FROM chat c ASOF JOIN changes l ON c.channel_id = l.channel_id AND c.sent_at >= l.changed_at WHERE l.wanted"""

_STEPS_SQL = _CHAT + """, begun AS (
    SELECT *, coalesce(epoch_us(arrived_at) - epoch_us(lag(arrived_at) OVER w) > 1800000000, true) AS first
    FROM latency_log WHERE arrived_at IS NOT NULL WINDOW w AS (PARTITION BY task ORDER BY arrived_at)
), stepped AS (
    SELECT *, CAST(count(*) FILTER (first) OVER (PARTITION BY task ORDER BY arrived_at) AS BIGINT) AS step FROM begun
), steps AS (
    SELECT task, step, min(arrived_at) AS started_at, max(arrived_at) AS ended_at, count(*) AS n,
           round(count(*) * 3600.0::DOUBLE * 1000000
                 / nullif(epoch_us(max(arrived_at)) - epoch_us(min(arrived_at)), 0), 6) AS rate
    FROM stepped GROUP BY ALL
)
"""

ORACLE_SQL: dict[str, str] = {
    "count_messages": _COUNT_SQL,
    "top_channels": _TOP_CHANNELS_SQL,
    "top_users": _TOP_USERS_SQL,
    "top_users_by_buckets": _TOP_USERS_SQL,
    "top_users_from_counts": _TOP_USERS_SQL,
    "censor_messages": _CENSOR_SQL,
    "censor_messages_length": f"{_CHAT} SELECT {_MESSAGE}, {_masked_by_length()} AS text FROM chat",
    "censor_messages_large_lexicon": _CENSOR_SQL,
    "censor_messages_phrases": rf"""{_CHAT}
SELECT {_MESSAGE}, regexp_replace(text, '\b(({_BAD})( ({_BAD}))?)\b', 'X', 'gi') AS text FROM chat""",
    "drop_profane_messages": _DROP_SQL,
    "drop_profane_messages_phrases": _DROP_SQL,
    "drop_profane_messages_large_lexicon": _DROP_SQL,
    "format_messages": _FORMAT_SQL,
    "format_by_rules": _FORMAT_SQL,
    "reasons_by_rules": f"""{_CHAT}
SELECT CASE event_type WHEN 'error' THEN 'not an object' END AS reason, count(*) AS n FROM chat GROUP BY 1""",
    "format_damaged_messages": f"{_FORMAT_SQL} WHERE event_type <> 'error'",
    "quarantine_messages": f"""{_CHAT}
SELECT concat('{{"message_id":', message_id, ',"user_id":', user_id) AS value
FROM chat WHERE event_type = 'error'""",
    "subscribe_channels": _SUBSCRIBE_SQL,
    "subscribe_many_channels": _SUBSCRIBE_SQL,
    "subscribe_changes": _CHANGES_SQL % "text",
    "subscribe_many_changes": _CHANGES_SQL % "text",
    "stream_subscribe_changes": _CHANGES_SQL % "trim(text)",
    "compacted_messages": _FORMAT_SQL,
    "dataset_prefix": f"""{_CHAT}
SELECT {_MESSAGE}, text FROM chat ORDER BY message_id LIMIT {_SMALLEST_SHARE}""",
    "dataset_prefix_with_holes": f"""{_CHAT}
SELECT {_MESSAGE}, text FROM chat WHERE event_type <> 'error' ORDER BY message_id LIMIT {_SMALLEST_SHARE}""",
    "dataset_prefix_of_repeats": f"""{_CHAT}
SELECT message_id + 1000 AS message_id, user_id
FROM (SELECT * FROM chat ORDER BY message_id LIMIT {_SMALLEST_SHARE}), range(2)""",
    "dataset_prefixes_of_repeats": f"""{_CHAT}, twice AS (
    SELECT message_id - message_id % 10 AS id, row_number() OVER (ORDER BY message_id - message_id % 10) AS place
    FROM chat, range(2)
), sizes AS (SELECT CAST(unnest([1, 2, 3]) * {_SMALLEST_SHARE} AS BIGINT) AS size)
SELECT size, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM twice JOIN sizes ON place <= size GROUP BY size""",
    "latency_summary": f"""{_CHAT}
SELECT task, count(latency_us) AS n, round(avg(latency_us) / 1000, 3) AS mean_ms,
       round(stddev_samp(latency_us) / 1000, 3) AS std_ms, max(latency_us) / 1000 AS max_ms
FROM latency_log GROUP BY task""",
    "load_rate": f"""{_CHAT}
SELECT task, round(count(*) * 3600.0::DOUBLE * 1000000
                   / nullif(epoch_us(max(arrived_at)) - epoch_us(min(arrived_at)), 0), 6) AS rate
FROM latency_log GROUP BY task""",
    "load_steps": f"{_STEPS_SQL} FROM steps",
    "latency_by_step": f"""{_STEPS_SQL}
SELECT task, step, CAST(round(rate) AS BIGINT) AS load, count(latency_us) AS n,
       CAST(sum(latency_us) AS BIGINT) AS sum_us, max(latency_us) AS max_us
FROM stepped JOIN steps USING (task, step) GROUP BY ALL""",
    "latency_to_commit": f"""{_CHAT}, through AS (
    SELECT task, (epoch_us(max(arrived_at) OVER (PARTITION BY date_trunc('hour', arrived_at))) + 250000) // 1000
           - epoch_us(arrived_at) // 1000 AS ms
    FROM latency_log
)
SELECT task, count(ms) AS n, round(avg(ms), 3) AS mean_ms, round(stddev_samp(ms), 3) AS std_ms,
       CAST(max(ms) AS DOUBLE) AS max_ms
FROM through GROUP BY task""",
    "compare_runs": f"""{_CHAT}, means AS (
    SELECT task, avg(latency_us) FILTER (engine = 'a') AS a,
           avg(latency_us) FILTER (engine = 'b') AS b
    FROM latency_log GROUP BY task
)
SELECT task, round(b / nullif(a, 0), 6) AS ratio,
       round((b - a) / nullif(b, 0) * 100, 6) AS lag_pct
FROM means""",
    "sql_count_messages": _COUNT_SQL,
    "sql_top_channels": _TOP_CHANNELS_SQL,
    "sql_top_users": _TOP_USERS_SQL,
    "sql_censor_messages": _CENSOR_SQL,
    "sql_censor_messages_length": f"{_CHAT} SELECT {_MESSAGE}, {_masked_by_length()} AS text FROM chat",
    "sql_drop_profane_messages": _DROP_SQL,
    "stream_format": _FORMAT_SQL,
    "stream_censor": _CENSOR_TRIMMED_SQL,
    "stream_censor_phrases": rf"""{_CHAT}
SELECT {_MESSAGE}, regexp_replace(trim(text), '\b(({_BAD})( ({_BAD}))?)\b', 'X', 'gi') AS text FROM chat""",
    "stream_subscribe": f"""{_CHAT}
SELECT {_MESSAGE}, trim(text) AS text FROM chat WHERE channel_id IN (0, 1)""",
    "stream_latency": rf"""{_CHAT}
SELECT message_id, regexp_replace(text, '\b({_BAD})\b', '***', 'gi') AS text, 'censor' AS task,
       true AS measured FROM chat""",
    "stream_latency_table": f"""{_CHAT}
SELECT event_type AS task, CASE user_id % 3 WHEN 0 THEN 31::BIGINT WHEN 1 THEN 77 ELSE 123 END AS load,
       CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS engine, count(*) AS n,
       round(avg(ms), 3) AS mean_ms, round(stddev_samp(ms), 3) AS std_ms, CAST(max(ms) AS DOUBLE) AS max_ms
FROM (SELECT *, CAST(round(value * 1000) AS BIGINT) // 1000 AS ms FROM events) GROUP BY ALL""",
    "job_format": _FORMAT_SQL,
    "job_subscribe": f"""{_CHAT}
SELECT {_MESSAGE}, trim(text) AS text FROM chat WHERE channel_id IN (0, 1)""",
    "job_commits": f"{_CHAT} SELECT 'format' AS task, count(*) AS n_messages, count(*) AS n_through FROM chat",
    "job_latency": f"""{_CHAT}
SELECT 'censor' AS task, count(*) AS n_messages, count(*) AS n_measured FROM chat""",
}
