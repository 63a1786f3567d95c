"""Record count and the two top lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Buckets of each hash, and hashes, of :func:`top_keys`.
BUCKETS, HASHES = 1 << 16, 3


def count_messages(messages: DataFrame) -> DataFrame:
    """One row ``n``: the number of messages."""
    return messages.agg(F.count(F.lit(1)).alias("n"))


def top_channels(messages: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` channels with most messages; ties go to the smaller channel id."""
    return _top(messages, "channel_id", k)


def top_users(messages: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` users with most messages; ties go to the smaller user id."""
    return _top(messages, "user_id", k)


def top_counted(counts: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The top list from counts that are stored already (columns ``key`` and ``n``)."""
    return counts.select(key, "n").orderBy(F.desc("n"), F.asc(key)).limit(k)


def top_keys(messages: DataFrame, key: str, k: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """The same list as :func:`top_users`, for a key with very many values of which few are frequent.

    Messages are first counted by bucket of some hashes of the key, so what is shuffled does not grow with the
    number of values. No value has more messages than any of its buckets. Of the values whose buckets are all among the
    fullest, the k-th most frequent gives a bound; then exactly the values are counted whose buckets all reach it, among
    them all that are in the list. Where no value stands out, that is every value, and the list is still exact.
    """
    ids = messages.select(key)
    hashed = F.array(*[_bucket(key, number, buckets) for number in range(HASHES)])
    each = ids.select(F.posexplode(hashed).alias("hash", "bucket"))
    # HASHES * buckets rows at most.
    counted = materialize(each.groupBy("hash", "bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    fullest = []
    for number in range(HASHES):
        first = counted.where(F.col("hash") == number).orderBy(F.desc("n"), "bucket").limit(4 * k)
        fullest.append(first.select(F.col("bucket").alias(f"_bucket{number}")))
    candidates = _top(_within(ids, key, fullest, buckets), key, k).agg(F.count(F.lit(1)), F.min("n")).first()
    if candidates[0] < k:
        return _top(ids, key, k)
    enough = counted.where(F.col("n") >= candidates[1])
    full = [enough.where(F.col("hash") == n).select(F.col("bucket").alias(f"_bucket{n}")) for n in range(HASHES)]
    return _top(_within(ids, key, full, buckets), key, k)


def _bucket(key: str, number: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(number), F.col(key)), F.lit(buckets)).cast("int")


def _within(ids: DataFrame, key: str, allowed: list[DataFrame], buckets: int) -> DataFrame:
    """The rows all of whose buckets are allowed; the lists are bounded by the number of buckets."""
    for number, places in enumerate(allowed):
        named = ids.withColumn(f"_bucket{number}", _bucket(key, number, buckets))
        ids = named.join(F.broadcast(places), f"_bucket{number}", "left_semi").select(key)
    return ids


def _top(messages: DataFrame, key: str, k: int) -> DataFrame:
    # Counts are combined in each input task before the shuffle, so a channel that holds a third of
    # all rows still arrives as one row per task. Sort and limit fuse into a per-task top k.
    counts = messages.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)
