"""Formatting by rules: where a field may stand in a raw value, and which forms it may have.

A value is parsed once, whatever the rules. Each field is taken from the first of its paths that holds something, so
users and streamers may be nested, or named by login. What cannot be formatted keeps a reason, and can be
tried again under other rules, each value once.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import entries, exists
from ..streaming.layout import store_batch

VALUE = "_variant"


class Rule(NamedTuple):
    """A column, the JSON paths it may stand at, its kind (``bigint``, ``timestamp`` or ``text``), and whether a
    message without it is bad."""

    column: str
    paths: Sequence[str]
    kind: str
    required: bool = False


#: The layout of this package, and that of a chat: message, user who sent it, streamer to whom.
RULES = (
    Rule("message_id", ("$.message_id", "$.id"), "bigint", required=True),
    Rule("sent_at", ("$.sent_at", "$.timestamp"), "timestamp"),
    Rule("user_id", ("$.user_id", "$.user.id"), "bigint"),
    Rule("channel_id", ("$.channel_id", "$.streamer.id"), "bigint"),
    Rule("text", ("$.text", "$.message"), "text"),
)
#: Names instead of numbers, or beside them.
LOGINS = (
    Rule("user_login", ("$.user.login", "$.user_login", "$.user"), "text"),
    Rule("channel_login", ("$.streamer.login", "$.channel_login", "$.streamer"), "text"),
)

_ZONE = r"[T ]\d{1,2}:.*(Z|[+-]\d{2}(:?\d{2})?)$"
# Digits are seconds, milliseconds or microseconds since the epoch, by their number: seconds up to the year 5138.
_SECONDS, _MILLIS = 10**11, 10**14


def parse_by_rules(raw: DataFrame, rules: Sequence[Rule] = RULES, value_col: str = "value") -> DataFrame:
    """All columns of ``raw``, ``parsed`` (a struct of the rules' columns) and ``reason``, null for a good value.

    Reasons are ``empty``, ``not an object``, ``no <column>`` for a required field, and ``bad <column>`` for one that is
    there in a form that its kind does not have; the first that applies, in the order of the rules.
    """
    text = F.col(value_col)
    # Exploding a one-element array keeps later filters above the parse.
    held = raw.select("*", F.explode(F.array(F.try_parse_json(text))).alias(VALUE))
    given = held.select("*", F.struct(*[_text_at(rule).alias(rule.column) for rule in rules]).alias("_given"))
    typed = F.struct(*[_typed(F.col("_given")[rule.column], rule.kind).alias(rule.column) for rule in rules])
    parsed = given.select("*", typed.alias("parsed"))
    empty = text.isNull() | (F.trim(text) == "")
    reason = F.when(empty, "empty").when(F.coalesce(F.schema_of_variant(F.col(VALUE)), F.lit("")).startswith("OBJECT") == F.lit(False), "not an object")
    for rule in rules:
        there = F.col("_given")[rule.column].isNotNull()
        reason = reason.when(there & F.col("parsed")[rule.column].isNull(), f"bad {rule.column}")
        if rule.required:
            reason = reason.when(~there, f"no {rule.column}")
    return parsed.select(*raw.columns, "parsed", reason.alias("reason"))


def format_by_rules(
    raw: DataFrame, rules: Sequence[Rule] = RULES, value_col: str = "value", carry: tuple[str, ...] = ()
) -> DataFrame:
    """The good messages of ``raw`` with the rules' columns, and ``sent_date`` if they have ``sent_at``."""
    good = parse_by_rules(raw, rules, value_col).where("reason IS NULL").select("parsed.*", *carry)
    if "sent_at" in good.columns:
        good = good.withColumn("sent_date", F.to_date("sent_at"))
    return good


def quarantine_by_rules(raw: DataFrame, rules: Sequence[Rule] = RULES, value_col: str = "value") -> DataFrame:
    """``value`` and ``reason`` of what cannot be formatted."""
    bad = parse_by_rules(raw, rules, value_col).where("reason IS NOT NULL")
    return bad.select(F.col(value_col).alias("value"), "reason")


def replay_quarantine(
    spark: SparkSession, quarantine: str, path: str, log: str, rules: Sequence[Rule] = RULES
) -> int:
    """Formats what a job has put into ``quarantine`` and ``rules`` now accept, into a message table of its own at ``path``.

    ``log`` remembers which values of which batches were stored, so no value is stored twice, whatever the rules of later
    calls. A call that broke off is done again by the next one, in place of what it left. Returns the number of messages.
    """
    done = [entry.name for entry in entries(spark, log) if exists(spark, f"{log}/{entry.name}/_SUCCESS")]
    number = len(done)
    held = spark.read.schema("value string, batch_id bigint").parquet(quarantine)
    # Equal values of a batch are stored together.
    values = held.groupBy("batch_id", "value").agg(F.count(F.lit(1)).alias("_copies"))
    if done:
        stored = spark.read.schema("batch_id bigint, value string").parquet(*[f"{log}/{name}" for name in done])
        same = [values["batch_id"].eqNullSafe(stored["batch_id"]), values["value"].eqNullSafe(stored["value"])]
        values = values.join(stored, same, "left_anti")
    parsed = parse_by_rules(values, rules).where("reason IS NULL")
    good = parsed.select("batch_id", "value", "parsed", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
    store_batch(good.select("parsed.*"), path, number)
    # The values of this call are found again, now that they are stored, and logged last.
    parsed.select("batch_id", "value").write.mode("overwrite").parquet(f"{log}/call={number}")
    return good.count()


def _text_at(rule: Rule) -> Column:
    """What stands at the first path that holds something; objects and lists do not count as values."""
    found = [F.try_variant_get(F.col(VALUE), path, "variant") for path in rule.paths]
    plain = [F.when(~F.schema_of_variant(item).rlike("^(OBJECT|ARRAY|VOID)"), F.try_variant_get(item, "$", "string")) for item in found]
    return F.coalesce(*plain)


def _typed(text: Column, kind: str) -> Column:
    if kind == "text":
        return F.trim(text)
    if kind == "bigint":
        return text.try_cast("bigint")
    if kind != "timestamp":
        raise ValueError(f"unknown kind of field: {kind}")
    plain = F.trim(text)
    number = F.when(plain.rlike(r"^-?\d{1,18}(\.\d+)?$"), plain.try_cast("decimal(38,6)"))
    size = F.abs(number)
    seconds = F.when(size < _SECONDS, number).when(size < _MILLIS, number / 1000).otherwise(number / 1_000_000)
    # With a zone, the instant; micro-seconds of it are the same in any session's zone.
    colon = F.regexp_replace(plain, r"([+-]\d{2})(\d{2})$", "$1:$2")
    instant = F.unix_micros(colon.try_cast("timestamp")).cast("decimal(38,6)") / 1_000_000
    zoned = plain.rlike(_ZONE)
    return (
        F.when(number.isNotNull(), _utc(seconds))
        .when(zoned, _utc(instant))
        .otherwise(plain.try_cast("timestamp_ntz"))
    )


def _utc(seconds: Column) -> Column:
    """The time in UTC, without a zone, so many seconds after the epoch."""
    zero = F.lit(0)
    gap = F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + gap
