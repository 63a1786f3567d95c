"""Formatting by rules: forms of fields, reasons, and replays."""

import json
from datetime import datetime

import pytest

from chatloom.operators.rules import LOGINS, RULES, Rule, format_by_rules, parse_by_rules, quarantine_by_rules, replay_quarantine
from chatloom.sources import read_messages

WHEN = datetime(2024, 3, 1, 12, 30, 15, 250_000)


def raw(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    "given",
    [
        "2024-03-01 12:30:15.250000", "2024-03-01T12:30:15.25", "2024-03-01T12:30:15.250Z", "2024-03-01T15:30:15.25+03:00",
        "2024-03-01T15:30:15.25+0300", "2024-03-01 07:00:15.250-05:30", 1709296215250, "1709296215250", 1709296215.25, 1709296215250000,
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times(spark, given, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = format_by_rules(raw(spark, [json.dumps({"id": 1, "timestamp": given})])).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.sent_at == WHEN and row.sent_date == WHEN.date()


def test_layouts_of_users_and_streamers(spark):
    values = [
        {"message_id": 1, "user_id": 2, "channel_id": 3, "text": " flat "},
        {"id": "1", "user": {"id": 2, "login": "ann"}, "streamer": {"id": "3", "login": "bob"}, "message": "nested"},
        {"id": 1, "user": "ann", "streamer": "bob", "text": "names"},
        {"id": 1, "user": None, "streamer": {}, "text": None, "other": [1]},
    ]
    rows = format_by_rules(raw(spark, map(json.dumps, values)), RULES + LOGINS).collect()
    got = {(r.message_id, r.user_id, r.channel_id, r.text, r.user_login, r.channel_login) for r in rows}
    assert got == {
        (1, 2, 3, "flat", None, None),
        (1, 2, 3, "nested", "ann", "bob"),
        (1, None, None, "names", "ann", "bob"),
        (1, None, None, None, None, None),
    }


REASONS = {
    None: "empty", "": "empty", "  ": "empty", "{broken": "not an object", "[1]": "not an object", "7": "not an object", "null": "not an object",
    "{}": "no message_id", '{"id":null}': "no message_id", '{"id":"x"}': "bad message_id", '{"id":1.5}': "bad message_id",
    '{"id":99999999999999999999}': "bad message_id", '{"id":1,"sent_at":"soon"}': "bad sent_at", '{"id":1,"user":{"id":"ann"}}': "bad user_id",
    '{"id":1,"timestamp":"2024-13-01"}': "bad sent_at", '{"id":{"a":1}}': "no message_id", '{"id":1}': None, '{"id":-1,"text":5}': None,
}


def test_reasons(spark):
    frame = raw(spark, REASONS)
    assert {r.value: r.reason for r in parse_by_rules(frame).collect()} == REASONS
    assert {r.value for r in quarantine_by_rules(frame).collect()} == {v for v, reason in REASONS.items() if reason}
    assert format_by_rules(frame).count() == 2


def test_a_value_is_parsed_once(spark):
    text = format_by_rules(raw(spark, ["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parse_json") + text.count("ParseJson") + text.count("parseJson") <= 1 or text.lower().count("parsejson(") == 1


def test_replay_stores_each_value_once(spark, tmp_path):
    bad, path, log = (str(tmp_path / name) for name in ("bad", "replayed", "log"))
    raw(spark, ['{"nr":1,"text":"a"}', '{"nr":1,"text":"a"}', '{"key":5}', "junk"]).write.parquet(f"{bad}/batch_id=0")
    rules = (Rule("message_id", ("$.id", "$.nr"), "bigint", required=True), *RULES[1:])
    ids = lambda: sorted(r.message_id for r in read_messages(spark, path).collect())
    assert replay_quarantine(spark, bad, path, log) == 0
    assert replay_quarantine(spark, bad, path, log, rules) == 2 and ids() == [1, 1]
    assert replay_quarantine(spark, bad, path, log, rules) == 0 and ids() == [1, 1]
    raw(spark, ['{"nr":1,"text":"a"}', '{"nr":2}']).write.parquet(f"{bad}/batch_id=1")
    # A call that broke off before its log is done again.
    assert replay_quarantine(spark, bad, path, log, rules) == 2
    (tmp_path / "log" / "call=3" / "_SUCCESS").unlink()
    assert replay_quarantine(spark, bad, path, log, rules) == 2 and ids() == [1, 1, 1, 2]
    rules = (Rule("message_id", ("$.id", "$.nr", "$.key"), "bigint", required=True), *RULES[1:])
    assert replay_quarantine(spark, bad, path, log, rules) == 1 and ids() == [1, 1, 1, 2, 5]
