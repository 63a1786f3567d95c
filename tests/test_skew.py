import pytest
from pyspark.sql import functions as F

from chatloom.functions.skew import MAX_PIECES, PIECE, copy_keys, cut_rows, hot_keys
from chatloom.sources import subscribe_channels


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows has the key 7, two thirds have keys of their own."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1000)
    return spark.range(30_000).select(F.col("id").alias("message_id"), key.alias("channel_id"))


def counted(frame, *keys):
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def test_hot_keys_are_cut_in_proportion(rows):
    hot = hot_keys(counted(rows, "channel_id"), "channel_id")
    assert [tuple(row) for row in hot.collect()] == [(7, 334)]
    pieces = cut_rows(rows, "channel_id", hot, F.xxhash64("message_id"))
    assert pieces.count() == rows.count()
    largest = counted(pieces, "channel_id", PIECE).agg(F.max("n")).first()[0]
    assert largest < 3 * rows.count() / MAX_PIECES
    copies = copy_keys(rows.select("channel_id").distinct(), "channel_id", hot)
    assert copies.count() == 20_000 + 334


def test_nothing_is_hot_in_an_empty_or_even_table(spark, rows):
    assert hot_keys(counted(rows.limit(0), "channel_id"), "channel_id").isEmpty()
    assert hot_keys(counted(rows, "message_id"), "message_id").isEmpty()


def test_subscription_to_a_hot_channel_is_whole(spark, rows):
    channels = spark.range(2000).select(F.col("id").alias("channel_id"))
    kept = subscribe_channels(rows, channels, max_broadcast=0)
    assert kept.count() == rows.where("channel_id < 2000").count()
    assert kept.exceptAll(rows).isEmpty()
