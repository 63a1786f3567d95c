from datetime import date, datetime

import pytest

from chatloom.operators import format_messages, parse_messages, quarantine_messages

GOOD = '{"message_id":2,"text":"  ok ","sent_at":"2024-01-01 00:00:07.179575"}'
BAD = [
    "{broken",
    "",
    None,
    '{"message_id":"x","text":"t"}',
    '{"text":"t"}',
    '{"message_id":1,"text":"t","sent_at":"nope"}',
    "[]",
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(value,) for value in [GOOD, *BAD]], "value string")


def test_good_values_are_typed_and_trimmed(raw):
    rows = format_messages(raw).collect()
    assert [row.asDict() for row in rows] == [
        {
            "message_id": 2,
            "sent_at": datetime(2024, 1, 1, 0, 0, 7, 179575),
            "user_id": None,
            "channel_id": None,
            "text": "ok",
            "sent_date": date(2024, 1, 1),
        }
    ]


def test_bad_values_are_kept_unchanged(raw):
    got = [row["value"] for row in quarantine_messages(raw).collect()]
    assert sorted(got, key=repr) == sorted(BAD, key=repr)


def test_each_value_is_parsed_once(raw):
    plan = format_messages(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_every_value_goes_one_way(raw):
    flags = [row["is_bad"] for row in parse_messages(raw).collect()]
    assert None not in flags
    assert len(flags) == 1 + len(BAD)
