"""Suffix-array, SimHash and embedding deduplication against brute force."""


import random

import numpy as np
import pytest
import xxhash
from chatloom.llm import op2_suffix_dedup as op2
from chatloom.llm import op5_simhash as op5
from chatloom.llm import op7_embeddings as op7
from chatloom.llm.components import components


def brute_repeats(texts, size):
    """For each text, which bytes a string of ``size`` covers that also starts earlier."""
    seen, out = set(), []
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - size + 1):
            if text[i : i + size] in seen:
                gone[i : i + size] = True
            seen.add(text[i : i + size])
        out.append(gone)
    return out


@pytest.mark.parametrize("size", [64, 100])
def test_windows_of_a_block(size):
    rng = random.Random(size)
    for _ in range(40):
        core = bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 300)))
        texts = []
        for _ in range(rng.randint(1, 8)):
            a = rng.randint(0, len(core))
            part = core[a : rng.randint(a, len(core))]
            texts.append(bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40))) + part + part * rng.randint(0, 2) + b"x" * rng.randint(0, 150))
        seen, want = set(), []
        for text in texts:
            for i in range(len(text) - size + 1):
                want.append(text[i : i + size] in seen)
                seen.add(text[i : i + size])
        assert op2.repeated_windows(texts, size).tolist() == want


def test_only_suffixes_that_tie_are_sorted_again(monkeypatch):
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(0, 256, 5000), np.arange(60), rng.integers(0, 256, 5000), np.arange(60), [256]])
    sizes, sort = [], np.argsort
    monkeypatch.setattr(op2.np, "argsort", lambda key: sizes.append(len(key)) or sort(key))
    order = op2.sorted_suffixes(text, 100)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert len(sizes) > 3 and sum(sizes[1:]) < 1000


def planted(rng):
    letters = "abcdefghijklmnop qrstuvwxyzé"
    prose = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage, other = prose(260), prose(130)
    texts = [prose(300) + passage + prose(50), passage, passage[40:150] + prose(99), "abc " * 200, "x" * 99, "x" * 100, "x" * 101]
    texts += [prose(30) + other + prose(rng.randint(0, 80)) + passage[: rng.randint(90, 140)] for _ in range(30)]
    return [*texts, texts[0], "", "é" * 160, "zé" * 120 + "é" * 60]


@pytest.mark.parametrize("meet", [512, 3, 1])
def test_repeats_over_documents(spark, meet):
    texts = planted(random.Random(1))
    rows = [(i, t) for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    found = op2.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), meet=meet).collect()
    want = brute_repeats([t.encode() for t in texts], 100)
    assert len(found) == len(texts)
    for row in found:
        data, gone = texts[row.id].encode(), want[row.id]
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == (len(data), gone.sum(), runs, kept), row.id


def test_repeats_of_odd_documents(odd_docs, no_docs):
    found = op2.remove_repeats(odd_docs).collect()
    rows = odd_docs.collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.id, []).append(r)
    assert (by_id[0][0].n_bytes, bytes(by_id[0][0].kept)) == (0, b"")
    assert [r.n_removed for r in by_id[6]] == [0, 0] and by_id[50][0].n_removed == by_id[50][0].n_bytes
    assert by_id[51][0].n_removed == by_id[50][0].n_bytes
    assert op2.remove_repeats(no_docs).count() == 0
    kept = op2.strip_repeats(None, odd_docs, "")
    assert kept.columns == odd_docs.columns and kept.count() == len(rows)


def brute_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    codes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def brute_groups(prints, bits):
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_simhash_fingerprints_and_components(spark, sf_dir, odd_docs, no_docs):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in op5.query(spark, sf_dir).collect()}
    prints = [brute_print(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    least = {}
    roots = brute_groups(prints, 4)
    for i, r in zip(ids, roots):
        least[r] = min(i, least.get(r, i))
    assert len(found) == len(rows)
    for i, code, r in zip(ids, prints, roots):
        assert (found[i].fingerprint, found[i].component_id) == (f"{code:016x}", least[r])
    odd = op5.near_duplicates(odd_docs).collect()
    groups = {r.id: r.component for r in odd}
    assert len(odd) == odd_docs.count() and groups[0] == groups[1] == groups[2] == 0 and groups[50] == 6
    assert op5.near_duplicates(no_docs).count() == 0
    kept = op5.keep_first(spark, odd_docs, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({g for g in groups.values() if g is not None})


def test_keep_first_goes_by_row(spark):
    a, b, c, d, e = (" ".join(f"{x}{i * i % 97}" for i in range(60)) for x in "abcde")
    # Copies with and without an id, copies without any id, one id with unrelated texts, whole rows twice.
    rows = [(1, a), (None, a), (2, a), (None, b), (None, b), (None, c), (7, d), (7, e), (8, e), (9, "x"), (9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in op5.keep_first(spark, docs, "").collect()]
    assert sorted(map(repr, kept)) == sorted(map(repr, [(1, a), (None, b), (None, c), (7, d), (7, e), (9, "x")]))


@pytest.mark.parametrize("meet", [256, 2])
def test_links_of_close_fingerprints(spark, meet):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(10):
            code = seed
            for b in rng.sample(range(64), rng.randint(0, 5)):
                code ^= 1 << b
            prints.add(code)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.component for r in components(op5.links(frame, 4, meet), "a", "b").collect()}
    got = [found.get(s, s) for s in signed]
    want = brute_groups(prints, 4)
    pairs = lambda g: {(i, j) for i in range(len(g)) for j in range(i) if g[i] == g[j]}
    assert pairs(got) == pairs(want)


@pytest.mark.parametrize("meet", [3, 256])
def test_exploded_fingerprints_are_never_broadcast(spark, monkeypatch, meet):
    plans, kept = {}, op5.materialize
    text = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(op5, "materialize", lambda frame, name: plans.update({name: text(frame)}) or kept(frame, name))
    frame = spark.createDataFrame([(1 << k,) for k in range(40)], "fp long")
    plans["links"] = text(op5.links(frame, 4, meet))
    assert "candidates" in plans and ("stars" in plans) == (meet == 3)
    for name in ("candidates", "links"):
        assert "SortMergeJoin" in plans[name] and "BroadcastExchange" not in plans[name]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 140)} == {100}
    assert found[301] == found[300] == 300 and 200 not in found
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_lattice_points_are_the_nearest():
    rng = np.random.default_rng(1)
    assert len(op7.ROOTS) == 240 and np.allclose((op7.ROOTS**2).sum(axis=1), 2)
    points = rng.normal(0, 2, (300, 8))
    cells = op7.decode(points)
    assert (np.abs(cells.sum(axis=1) % 2) < 1e-9).all()
    gap = ((points - cells) ** 2).sum(axis=1)
    beside = ((points[:, None] - cells[:, None] - op7.ROOTS) ** 2).sum(axis=2).min(axis=1)
    assert (gap <= beside + 1e-9).all() and gap.max() <= 1 + 1e-9


@pytest.mark.parametrize("group", [256, 3])
def test_embedding_links(spark, group):
    rng = np.random.default_rng(4)
    seeds = rng.standard_normal((12, 16))
    rows = np.concatenate([seeds + 0.04 * rng.standard_normal(seeds.shape) for _ in range(8)] + [seeds, seeds])
    data = [(i, v.tolist(), 0) for i, v in enumerate(rows)]
    data += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [1.0, None] * 8, 1), (904, [1.0], 1), (905, (2 * rows[0]).tolist(), 1), (1, rows[0].tolist(), 2)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("n_links", op7.F.lit("x"))
    found = op7.near_duplicates(frame, group=group).collect()
    sound = [(i, np.array(v)) for i, v, _ in data if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    units = np.array([v / np.linalg.norm(v) for _, v in sound])
    near = units @ units.T >= 0.95
    want = {}
    for k, (i, _) in enumerate(sound):
        want.setdefault(i, []).append(int(near[k].sum()) - 1)
    got = {}
    for r in found:
        got.setdefault(r.id, []).append(r.n_links)
    assert {i: sorted(n) for i, n in got.items() if i < 900 or i == 905} == {i: sorted(n) for i, n in want.items()}
    assert all(r.n_links == 0 and r.component == r.id for r in found if 900 <= r.id < 905)
    assert len(found) == len(data)
    assert {r.component for r in found if r.id == 905} == {0}
    assert op7.near_duplicates(frame.limit(0)).count() == 0


def test_embedding_recall_of_the_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    units = np.array([r.embedding for r in rows], float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    want = (units @ units.T >= 0.95).sum() - len(rows)
    got = sum(r.n_links for r in op7.query(spark, sf_dir).collect())
    assert 0.9 * want <= got <= want


def test_recall_at_the_threshold():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    x, y = op7.codes(a), op7.codes(b)
    met = ((x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)).any(axis=1)
    assert met.mean() >= 0.9


def test_strangers_seldom_meet():
    rng = np.random.default_rng(8)
    units = rng.standard_normal((4_000, 64))
    units /= np.linalg.norm(units, axis=1)[:, None]
    cells = op7.codes(units)
    assert cells.shape == (4_000, op7.TABLES, 1 + op7.PROBES)
    assert all(len(set(row)) == row.size for row in cells.reshape(4_000, -1)[:50])
    own = cells[:, :, 0]
    meetings = sum(len(units) - len(np.unique(own[:, t])) for t in range(op7.TABLES))
    # One block of narrow cells has about 150 here.
    assert meetings <= 5


@pytest.mark.parametrize("blocks", [1, 2, 4])
def test_a_pair_is_counted_where_it_first_meets(blocks):
    rng = np.random.default_rng(blocks)
    a = rng.standard_normal((40, 12))
    units = np.concatenate([a + 0.02 * rng.standard_normal(a.shape) for _ in range(3)])
    units /= np.linalg.norm(units, axis=1)[:, None]
    how = {"tables": 6, "blocks": blocks, "scale": 1.2, "probes": 5}
    cells = op7.codes(units, **how)
    x, y = np.triu_indices(len(units), 1)
    seen = 0
    for i, j in zip(x, y):
        spots = [c for t in range(6) for c in set(cells[i, t]) & set(cells[j, t]) if c in (cells[i, t, 0], cells[j, t, 0])]
        if spots:
            code = np.array(spots)
            here = op7.first_meeting(units, np.full(len(code), i), np.full(len(code), j), code, **how)
            assert here.sum() == 1
            seen += 1
    assert seen >= 40


