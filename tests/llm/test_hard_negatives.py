"""Hard negatives against brute force, and the residue products against exact integers."""

import math
import random

import duckdb
import numpy as np
import pytest

from chatloom.llm import op11_hard_negatives as op

LAST = (1 << 63) - 1


def brute(rows, every):
    """(anchor, positive, rank, negative, positive score, negative score) of (id, label, vector) rows."""
    part = []
    for i, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in whole) < 2**53:
            part.append((i, label, whole))
    order = lambda entry: (-entry[0], LAST if entry[1] is None else entry[1])
    out = []
    for at, (anchor, label, vector) in enumerate(part):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, other[2])), other[0], other[1])
            for j, other in enumerate(part)
            if j != at and len(other[2]) == len(vector)
        ]
        for score, positive, _ in sorted((e for e in scored if e[2] == label), key=order)[:5]:
            fits = [e for e in scored if e[2] != label and 30 * score <= 100 * e[0] <= 90 * score]
            out += [(anchor, positive, rank + 1, e[1], score, e[0]) for rank, e in enumerate(sorted(fits, key=order)[:10])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("width", "size"), [(1, 5), (64, 300), (1500, 2**17), (3000, 40), (7, 2**24), (0, 1)])
def test_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-size, size + 1, (9, width)), rng.integers(-size, size + 1, (17, width))
    a[0] = size
    b[0], b[1] = size, -size
    bound = max(int((m.astype(object) ** 2).sum(axis=1).max()) for m in (a, b)) if width else 0
    assert bound < op.MAX_NORM
    assert (op.ResidueProduct(a, bound).times(b).astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_equals_brute_force_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 6)
    monkeypatch.setattr(op, "SPLIT_ROWS", 40)
    pick = random.Random(4)
    vector = lambda n: [pick.choice([-1.0, -0.5, 0.25, 0.3, 1.0]) for _ in range(n)]
    rows = [(i, pick.randrange(3), vector(4)) for i in range(150)]
    rows += [(i, 1, vector(4)) for i in (10, 20, 20)] + [(30, 2, [1.0, 1.0, 1.0, 1.0])] * 8 + [(30, 0, [1.0, 1.0, 1.0, 1.0])] * 2
    rows += [(None, 0, vector(4)), (None, 1, [1.0] * 4), (40, None, vector(4)), (50, 1, None), (60, 1, [1.0, None, 0.0, 0.0])]
    rows += [(70, 1, [math.nan] * 4), (80, 1, [math.inf, 0.0, 0.0, 0.0]), (90, 2, [1e300] * 4), (100, 2, [0.0] * 4), (110, 0, [])]
    rows += [(120, pick.randrange(2), vector(2)) for _ in range(3)] + [(i, pick.randrange(2), vector(2)) for i in range(40)] + [(130, 1, []), (140, 0, [])]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").repartition(3)
    for name in ("id", "row", "vector", "norm", "tile", "split", "kind", "anchor", "score", "rank", "value"):
        frame = frame.withColumn(name, frame["label"])
    got = op.hard_negatives(frame, 10).collect()
    assert sorted((tuple(row) for row in got), key=repr) == brute(rows, 10)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    assert op.hard_negatives(frame, 100).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    got = op.query(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.execute(op.ORACLE_SQL)
    assert got.columns == [d[0] for d in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
