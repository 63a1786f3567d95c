"""The table of the jobs: folders by date, repeated batches, compaction, and the log of subscriptions."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import MESSAGE_DDL
from pyspark.sql import functions as F

from chatloom.sources import channel_counts, read_messages, selection, subscribe_changes, subscribe_channels
from chatloom.streaming import compact_messages, finish_compaction, store_batch
from chatloom.streaming import layout


def batch(spark, ids, day=1):
    rows = [(i, datetime(2024, 1, day), i % 3, i % 2, f"m{i}") for i in ids]
    return spark.createDataFrame(rows, MESSAGE_DDL).coalesce(1)


def ids(frame):
    return sorted(row["message_id"] for row in frame.collect())


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.glob("sent_date=*/batch_id=*"))


@pytest.fixture
def stored(spark, tmp_path):
    path = tmp_path / "table"
    for number in range(5):
        store_batch(batch(spark, range(10 * number, 10 * number + 3)).union(batch(spark, [100 + number], 2)), str(path), number)
    return path


def test_a_repeated_batch_replaces_all_its_dates(spark, stored):
    store_batch(batch(spark, [7]), str(stored), 4)
    assert ids(read_messages(spark, str(stored))) == sorted([*[10 * n + i for n in range(4) for i in range(3)], 100, 101, 102, 103, 7])
    assert "sent_date=2024-01-02/batch_id=4" not in folders(stored)


def test_compaction_keeps_rows_and_the_newest_batch(spark, stored):
    before = ids(read_messages(spark, str(stored)))
    assert compact_messages(spark, str(stored), date(2024, 1, 2)) == ["2024-01-01"]
    assert [f for f in folders(stored) if "01-01" in f] == ["sent_date=2024-01-01/batch_id=-4", "sent_date=2024-01-01/batch_id=4"]
    assert len(list(stored.glob("sent_date=2024-01-01/batch_id=-4/*.parquet"))) == 1
    assert len([f for f in folders(stored) if "01-02" in f]) == 5
    assert ids(read_messages(spark, str(stored))) == before
    # The newest batch again, and two more that are late for the date.
    store_batch(batch(spark, range(40, 43)).union(batch(spark, [104], 2)), str(stored), 4)
    assert ids(read_messages(spark, str(stored))) == before
    for number in (5, 6):
        store_batch(batch(spark, [number * 10]), str(stored), number)
    assert compact_messages(spark, str(stored), date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    assert [f for f in folders(stored) if "01-01" in f] == ["sent_date=2024-01-01/batch_id=-6", "sent_date=2024-01-01/batch_id=6"]
    assert ids(read_messages(spark, str(stored))) == sorted([*before, 50, 60])
    assert compact_messages(spark, str(stored), date(2024, 1, 3)) == []
    assert not (stored / "_compaction").exists()


def test_a_compaction_that_breaks_off(spark, stored, monkeypatch):
    before = ids(read_messages(spark, str(stored)))

    def fail(*_):
        raise OSError("lost")

    for name in ("finish_compaction", "rename"):
        calls = []
        real = getattr(layout, name)

        def once(*args):
            calls.append(args)
            return fail() if name == "rename" or len(calls) > 1 else real(*args)

        monkeypatch.setattr(layout, name, once)
        with pytest.raises(OSError, match="lost"):
            compact_messages(spark, str(stored), date(2024, 1, 3))
        monkeypatch.setattr(layout, name, real)
        finish_compaction(spark, str(stored))
        assert ids(read_messages(spark, str(stored))) == before
        store_batch(batch(spark, [200 + len(before)]), str(stored), 10 + len(before))
        store_batch(batch(spark, [300 + len(before)]), str(stored), 11 + len(before))
        before = ids(read_messages(spark, str(stored)))
    # Without a plan nothing was exchanged.
    (stored / "_compaction" / "new").mkdir(parents=True)
    finish_compaction(spark, str(stored))
    assert ids(read_messages(spark, str(stored))) == before


def test_bins():
    pick = random.Random(1)
    for _ in range(50):
        sizes = [pick.randint(0, 99) for _ in range(pick.randint(1, 40))]
        bins = layout.first_fit(sizes, 100)
        filled = [sum(s for s, b in zip(sizes, bins) if b == n) for n in range(max(bins) + 1)]
        assert max(filled) <= 100 and all(a + b > 100 for a, b in zip(filled, filled[1:]) if a and b)


def test_dates_are_read_without_listing_the_others(spark, stored):
    frame = read_messages(spark, str(stored), dates=(date(2024, 1, 2), date(2024, 1, 9)))
    assert ids(frame) == [100, 101, 102, 103, 104] and frame.columns[-1] == "sent_date"
    assert all("sent_date=2024-01-02" in name for name in frame.inputFiles())
    assert "sent_date=2024-01-01" not in frame._jdf.queryExecution().executedPlan().toString()
    nothing = read_messages(spark, str(stored), dates=(date(2025, 1, 1), date(2025, 1, 2)))
    assert nothing.count() == 0 and nothing.columns == frame.columns


def test_messages_without_a_time(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, 1, 1, "x")], MESSAGE_DDL)
    for _ in range(2):
        store_batch(rows, str(tmp_path / "t"), 0)
    store_batch(rows, str(tmp_path / "t"), 1)
    store_batch(rows, str(tmp_path / "t"), 2)
    assert compact_messages(spark, str(tmp_path / "t"), date.max) == []
    assert read_messages(spark, str(tmp_path / "t")).count() == 3


@pytest.mark.parametrize("limit", [1000, 0])
def test_subscriptions_are_exact_at_each_change(spark, limit):
    start, pick = datetime(2024, 1, 1), random.Random(3)
    at = lambda s: start + timedelta(seconds=s)
    changes = [(c, at(pick.randint(0, 50)), pick.choice([True, False])) for c in range(4) for _ in range(8)]
    changes += [(9, at(5), True), (9, at(5), False), (8, at(5), True), (8, at(7), None), (None, at(1), True), (7, None, True)]
    rows = [(i, pick.choice([None, 0, 0, 0, 1, 2, 3, 7, 8, 9]), None if i % 50 == 0 else at(pick.randint(-5, 60))) for i in range(600)]
    log = spark.createDataFrame(changes, "channel_id bigint, changed_at timestamp, wanted boolean")
    messages = spark.createDataFrame(rows, "message_id bigint, channel_id bigint, arrived_at timestamp")

    def wanted(channel, time):
        past = [c for c in changes if time is not None and c[0] == channel and None not in c[:2] and c[1] <= time]
        last = max((c[1] for c in past), default=None)
        return bool(past) and all(c[2] for c in past if c[1] == last)

    kept = subscribe_changes(messages, log, max_broadcast=limit)
    assert ids(kept) == sorted(i for i, c, t in rows if c is not None and wanted(c, t))
    assert kept.columns == messages.columns


def test_counts_of_earlier_batches_cut_busy_channels(spark):
    messages = spark.range(3000).select(F.col("id").alias("message_id"), F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("channel_id"))
    counts = channel_counts(messages)
    kept = subscribe_channels(messages, messages.select("channel_id"), max_broadcast=0, counts=counts)
    assert kept.count() == 3000
    hot = layout_pieces(counts)
    assert hot[5] > 600


def layout_pieces(counts):
    from chatloom.functions.skew import hot_keys

    return {row[0]: row[1] for row in hot_keys(counts, "channel_id").collect()}


@pytest.mark.parametrize("limit", [10**6, 0])
def test_a_long_log_of_a_channel_is_searched_in_nodes(spark, monkeypatch, limit):
    monkeypatch.setattr("chatloom.sources.selection.FAN_OUT", 4)
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    # 100 changes of channel 1 take four levels, the two of channel 2 one.
    changes = [(1, at(10 * n), n % 3 > 0) for n in range(100)] + [(2, at(50), True), (2, at(70), False)]
    rows = [(n, channel, at(n - 20)) for channel in (1, 2, 3) for n in range(1050)]
    log = spark.createDataFrame(changes, "channel_id bigint, changed_at timestamp, wanted boolean")
    messages = spark.createDataFrame(rows, "message_id bigint, channel_id bigint, arrived_at timestamp")
    kept = subscribe_changes(messages, log, max_broadcast=limit)
    one = {s + 20 for s in range(1030) if min(s // 10, 99) % 3 > 0}
    assert {(r["channel_id"], r["message_id"]) for r in kept.collect()} == {(1, n) for n in one} | {(2, s + 20) for s in range(50, 70)}
    # No row has a whole log, but at most a node of it.
    levels, leaves, total = selection._tree(log)
    assert len(levels) == 3 and total == 102
    assert max(len(row["_starts"]) for frame in [*levels, leaves] for row in frame.collect()) == 4


def test_compaction_goes_by_rounds_and_shuffles_nothing(spark, stored, monkeypatch):
    before, seen, real = ids(read_messages(spark, str(stored))), [], layout.finish_compaction
    size = max(p.stat().st_size for p in stored.glob("sent_date=*/batch_id=*/*.parquet"))

    def watched(session, path):
        seen.append(sorted(p.name for p in (stored / "_compaction" / "new").glob("sent_date=*")))
        real(session, path)

    frames, pack = [], layout._pack
    monkeypatch.setattr(layout, "_pack", lambda *args: frames.append(pack(*args)) or frames[-1])
    monkeypatch.setattr(layout, "finish_compaction", watched)
    monkeypatch.setattr(layout, "ROUND_BINS", 1)
    assert compact_messages(spark, str(stored), date(2024, 1, 3), target_bytes=2 * size) == ["2024-01-01", "2024-01-02"]
    assert [x for x in seen if x] == [["sent_date=2024-01-01"], ["sent_date=2024-01-02"]]
    assert ids(read_messages(spark, str(stored))) == before
    for frame, day in zip(frames, (1, 2)):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
        held = sorted(p.name for p in (stored / f"sent_date=2024-01-0{day}" / "batch_id=-4").iterdir() if not p.name.startswith("."))
        assert len(held) == 2 and all(name.endswith(".parquet") for name in held)
