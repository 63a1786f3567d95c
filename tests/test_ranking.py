"""Top lists by buckets and from stored counts, against plain counting."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.operators import top_counted, top_keys, top_users
from chatloom.plans.catalog import AVAILABLE_NOW
from chatloom.sources import read_messages, read_messages_stream
from chatloom.streaming import fold_counts, format_job, read_counts, store_counts


def users(spark, values):
    return spark.createDataFrame([(v,) for v in values], "user_id bigint")


@pytest.mark.parametrize("buckets", [1, 4, 64, 1 << 16])
@pytest.mark.parametrize("kind", ["skewed", "even", "few", "none"])
def test_buckets_give_the_same_list(spark, kind, buckets):
    pick = random.Random(buckets)
    values = {
        "skewed": [int(pick.paretovariate(0.8)) % 5000 for _ in range(4000)] + [None] * 300,
        "even": [i % 700 for i in range(2100)],
        "few": [1, 2, 2, None],
        "none": [],
    }[kind]
    frame = users(spark, values)
    assert top_keys(frame, "user_id", 5, buckets).collect() == top_users(frame, 5).collect()


def test_few_rows_are_shuffled_for_frequent_keys(spark):
    frame = spark.range(200_000).select(F.when(F.col("id") % 2 > 0, F.col("id") % 20).otherwise(F.col("id")).alias("user_id"))
    frame.write.mode("overwrite").parquet(path := spark.conf.get("spark.checkpoint.dir") + "/many-users")
    result = top_keys(spark.read.parquet(path), "user_id", 10)
    assert result.collect() == top_users(spark.read.parquet(path), 10).collect()
    joins = result._jdf.queryExecution().executedPlan().toString()
    assert joins.count("LeftSemi") >= 3 and "SortMergeJoin" not in joins


def test_counts_by_batch(spark, tmp_path):
    path, pick = str(tmp_path / "counts"), random.Random(2)
    batches = [[pick.choice([None, *range(6)]) for _ in range(50)] for _ in range(6)]

    def check(upto):
        want = Counter(v for values in batches[:upto] for v in values)
        counts = read_counts(spark, path, "user_id")
        assert dict(map(tuple, counts.collect())) == dict(want)
        everyone = users(spark, [v for values in batches[:upto] for v in values])
        assert top_counted(counts, "user_id", 3).collect() == top_users(everyone, 3).collect()

    assert read_counts(spark, path, "user_id").collect() == []
    for number, values in enumerate(batches):
        # The newest batch is repeated after a fold.
        for _ in range(2):
            store_counts(users(spark, values), path, number, ["user_id"])
            check(number + 1)
            fold_counts(spark, path, ["user_id"])
            check(number + 1)
    names = sorted(p.name for p in (tmp_path / "counts" / "user_id").iterdir() if p.name[0] != ".")
    assert names == ["batch_id=5", "up_to=4"]
    read = read_counts(spark, path, "user_id").inputFiles()
    assert all("up_to=4" in name or "batch_id=5" in name for name in read)


def test_a_total_that_broke_off_does_not_count(spark, tmp_path):
    path = str(tmp_path / "counts")
    for number in range(3):
        store_counts(users(spark, [number, 7]), path, number, ["user_id"])
    broken = tmp_path / "counts" / "user_id" / "up_to=1"
    users(spark, [7]).withColumn("n", F.lit(1).cast("bigint")).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert dict(map(tuple, read_counts(spark, path, "user_id").collect())) == {0: 1, 1: 1, 2: 1, 7: 3}
    fold_counts(spark, path, ["user_id"])
    assert dict(map(tuple, read_counts(spark, path, "user_id").collect())) == {0: 1, 1: 1, 2: 1, 7: 3}


def test_a_job_keeps_counts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in range(3):
        lines = [json.dumps({"message_id": 10 * part + i, "user_id": i % 2, "channel_id": part}) for i in range(5)]
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(lines))
    raw = read_messages_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    format_job(
        raw, str(tmp_path / "out"), str(tmp_path / "checkpoint"), str(tmp_path / "bad"), counts=str(tmp_path / "counts"), trigger=AVAILABLE_NOW
    ).awaitTermination()
    for key in ("user_id", "channel_id"):
        want = read_messages(spark, str(tmp_path / "out")).groupBy(key).count().collect()
        assert sorted(map(tuple, read_counts(spark, str(tmp_path / "counts"), key).collect())) == sorted(map(tuple, want))
