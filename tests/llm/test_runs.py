"""Periodic runs against a brute-force search."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatloom.llm import op12_periodic_runs as op


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                # Smaller periods come first, and a multiple of one spans the same words.
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda run: (run[0], run[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *best,
        None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def runs_by_operator(words):
    return op.text_runs([str(word).encode() for word in words])


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(1, 30)), max_size=6),
)
def test_runs_of_repeated_blocks(blocks):
    words = [word for block, times in blocks for word in block * times]
    assert runs_by_operator(words) == brute_runs(words)


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_nested_and_broken_periods(seed):
    pick = random.Random(seed)
    words = []
    while len(words) < 400:
        block = [pick.randrange(pick.choice([1, 2, 40])) for _ in range(pick.randint(1, 30))]
        words += (block * pick.randint(1, 8))[: pick.randint(1, 150)]
        if pick.random() < 0.3:
            words += words[-pick.randint(1, len(words)) :]
    assert runs_by_operator(words) == brute_runs(words)


def test_one_word_and_fibonacci_words():
    assert runs_by_operator("a" * 5000) == [(0, 5000, 1)]
    assert runs_by_operator("a" * 23) == []
    assert runs_by_operator("a" * 24) == [(0, 24, 1)]
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    assert runs_by_operator(b) == brute_runs(b)


def test_squares_are_found_with_their_left_ends():
    import numpy as np

    words = np.array([9, 1, 2, 1, 2, 1, 2, 8])
    assert {(4, 2, 2), (6, 2, 4)} <= set(op.squares(words))


def test_query_equals_brute_force(spark, tmp_path):
    pick = random.Random(5)
    rows = [(None, "x " * 40), (1, None), (2, ""), (3, " \t\n"), (4, "solo"), (4, "y z " * 30), (4, "y z " * 30)]
    rows.append((5, "\x0bw\x0c" * 30 + "\x1c é é " * 30))
    rows.append((7, "long " * 30_000 + "tail"))
    for doc_id in range(100, 260):
        words = [f"w{pick.randrange(30)}" for _ in range(pick.randint(1, 120))]
        rows.append((doc_id, " ".join(words + words[:9] * pick.choice([0, 0, 5]))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS id", "2 AS runs", "3 AS n_words", "4 AS h", "5 AS words", "6 AS best", "7 AS collapsed"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(row) for row in op.query(spark, str(tmp_path)).collect()]
    known = {(7, rows[8][1]): (7, 1, 0, 30_000, 1, 30_000_000)}
    want = [brute_row(*row) for row in rows if row not in known]
    assert sorted((r for r in got if r[0] != 7), key=repr) == sorted(want, key=repr)
    assert [r[:6] for r in got if r[0] == 7] == list(known.values())


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op.query(spark, str(tmp_path)).collect() == []


def test_given_documents_equal_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [tuple(row) for row in rows if len(row.text or "") < 5000]
    got = {row[0]: tuple(row) for row in op.query(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    assert [got[row[0]] for row in short] == [brute_row(*row) for row in short]
