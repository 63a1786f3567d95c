"""Minimax sharding against a greedy search over all groups."""

import hashlib
import random
import zlib
from itertools import combinations

import pytest

from chatloom.llm import op13_sharding as op


def greedy(sizes, capacity):
    """Ends of the shards that are filled up to ``capacity`` in turn."""
    ends, filled, at = [], 0, 0
    for size in sizes:
        if filled + size > capacity:
            ends.append(at)
            filled = 0
        filled += size
        at += size
    return [*ends, at]


def smallest_capacity(sizes, shards):
    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while len(greedy(sizes, capacity)) > shards:
        capacity += 1
    return capacity


def brute_shards(texts, shards):
    """The shard of each text."""
    groups = {}
    for text in texts:
        raw = (text or "").encode()
        digest = hashlib.sha256(raw).hexdigest()
        groups[digest] = groups.get(digest, 0) + len(raw) + 16
    left, alone = sum(groups.values()), []
    for digest, size in sorted(groups.items(), key=lambda item: (-item[1], item[0])):
        if shards - len(alone) == 1 or size * (shards - len(alone)) <= left:
            break
        alone.append(digest)
        left -= size
    rest = sorted(set(groups) - set(alone))
    shard_of = {digest: i for i, digest in enumerate(alone)}
    if rest:
        sizes = [groups[digest] for digest in rest]
        ends = greedy(sizes, smallest_capacity(sizes, shards - len(alone)))
        at = 0
        for digest, size in zip(rest, sizes):
            shard_of[digest] = len(alone) + sum(at >= end for end in ends[:-1])
            at += size
    return [shard_of[hashlib.sha256((text or "").encode()).hexdigest()] for text in texts]


def checked(frame, rows, shards):
    got = [tuple(row) for row in frame.collect()]
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    want = sorted((i is None, i or 0, zlib.crc32((t or "").encode()), s) for (i, t), s in zip(rows, brute_shards([t for _, t in rows], shards)))
    assert sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in got) == want
    for number in range(shards):
        slots = sorted(r[4] for r in got if r[3] == number)
        assert slots == list(range(len(slots)))
    return got


@pytest.mark.parametrize(("seed", "shards"), [(0, 1), (1, 3), (2, 7)])
def test_shards_equal_brute_force(spark, seed, shards):
    pick = random.Random(seed)
    texts = [pick.choice("abcdé ") * pick.randint(0, 60) for _ in range(pick.randint(1, 120))]
    texts += [pick.choice(texts) for _ in range(40)] + [None, "", "", "long " * 2000, "hot"] + ["hot"] * 90
    rows = [(None if pick.random() < 0.2 else pick.randint(0, 50), text) for text in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for name in ("size", "shard", "slot", "digest", "n", "own", "start", "row", "range", "_piece", "law"):
        docs = docs.withColumn(name, docs["doc_id"])
    checked(op.shard(docs, shards), rows, shards)


@pytest.mark.parametrize("seed", range(2))
def test_cuts_in_several_passes(spark, seed):
    pick = random.Random(seed)
    sizes = [16 + int(pick.expovariate(1 / 50)) + (pick.randint(0, 4000) if pick.random() < 0.01 else 0) for _ in range(4000)]
    at, groups = 0, []
    for size in sizes:
        groups.append((at, at + size))
        at += size
    frame = spark.createDataFrame(groups, "start bigint, end bigint").cache()
    for shards in (1, 2, 3, 5):
        cuts = op.minimax_cuts(frame, shards, at, max(sizes), blocks=1)
        want = greedy(sizes, smallest_capacity(sizes, shards))
        assert cuts == want + [at] * (shards - len(want))
    frame.unpersist()


def test_the_largest_shard_is_as_small_as_any_partition_allows():
    pick = random.Random(3)
    for _ in range(50):
        sizes = [pick.randint(16, 90) for _ in range(9)]
        best = min(
            max(sum(sizes[a:b]) for a, b in zip((0, *cuts), (*cuts, 9))) for cuts in combinations(range(1, 9), 3)
        )
        assert smallest_capacity(sizes, 4) == best


def test_empty_table_and_wrong_numbers(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert op.shard(docs).collect() == []
    for shards in (0, op.MAX_SHARDS + 1):
        with pytest.raises(ValueError):
            op.shard(docs, shards)


def test_query_and_its_plan(spark, sf_dir):
    frame = op.query(spark, sf_dir)
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = checked(frame.select("doc_id", "size", "text_crc32", "shard", "slot"), rows, op.SHARDS)
    assert len(got) == len(rows)
    assert frame.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {row.law for row in frame.collect()} == {"bytes"}
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
