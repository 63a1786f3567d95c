"""Quality classifier and language identification."""

import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from chatloom.llm import op1_quality as op1
from chatloom.llm import op4_language as op4
from chatloom.llm.common import flat_bytes, text_chunks


def test_quality_of_held_out_documents(spark, sf_dir):
    rows = {r.doc_id: r for r in op1.query(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in rows.items())
    tried = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    assert np.mean([p == y for p, y in tried]) > 0.9
    assert np.mean([p for p, y in tried if y == 1]) > 0.97


def test_one_text_scores_alike_in_any_batch():
    rng = np.random.default_rng(1)
    model = op1.QualityModel(rng.standard_normal(1 << op1.BITS).astype(np.float32), 0.1)
    texts = [b"some words here here here", b"", b" ", b"x", "ünï".encode(), b"a b\tc\n" * 50]
    ends = np.cumsum([0, *map(len, texts)])
    together = model.score(np.frombuffer(b"".join(texts), np.uint8), ends)
    alone = [model.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone)


def test_scoring_a_large_batch_takes_little_memory():
    texts = pa.array([f"some words about number {i} " * 40 for i in range(8_000)])
    model = op1.QualityModel(np.ones(1 << op1.BITS, np.float32), 0.0)
    tracemalloc.start()
    for part in text_chunks([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", op1.SCORED_BYTES):
        assert len(model.score(*flat_bytes(part.column("text")))) == part.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 8 << 20 and peak < 64 << 20


def test_labels_that_contradict_are_left_out(spark):
    rows = [(1, 1), (1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 7), (5, 0)]
    kept = op1.clean_labels(spark.createDataFrame(rows, "doc_id long, quality int")).collect()
    assert sorted((r._id, r._label) for r in kept) == [(1, 1), (5, 0)]


def test_quality_without_labels_or_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    scored = op1.score(odd_docs, op1.fit(odd_docs, labels), to="score")
    assert {r.score for r in scored.collect()} == {0.5} and scored.count() == odd_docs.count()
    assert op1.score(no_docs, op1.fit(no_docs, labels)).count() == 0
    one = spark.createDataFrame([(6, 1), (7, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in op1.score(odd_docs, op1.fit(odd_docs, one)).collect())


def test_language_of_held_out_documents(spark, sf_dir):
    rows = op4.query(spark, sf_dir).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([langs[r.doc_id] == r.lang_pred for r in held]) > 0.9


def test_forward_sums_all_segmentations():
    cutter = op4.segmenter(op4.public_tokenizers.path(op4.MODEL))
    rng = np.random.default_rng(2)
    chances = rng.uniform(1e-6, 1e-3, (cutter.n, 2))

    def brute(points, i, k):
        if i == len(points):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(points) + 1):
            part = np.array([points[i:j]])
            piece = cutter.keys.find(cutter._key(cutter._prefix(part)[:, -1], j - i))[0]
            if piece < 0 and j == i + 1:
                piece = cutter.n - 1
            if piece >= 0:
                total += chances[piece, k] * brute(points, j, k)
        return total

    for word in ("▁the", "▁nation", "▁日本xß", "▁"):
        points = np.array([[ord(c) for c in word]])
        logs = cutter.logs(points, chances)
        for k in range(2):
            assert math.isclose(math.exp(logs[0, k]), brute(points[0], 0, k), rel_tol=1e-9)
        # Expected uses weigh the pieces' lengths to the whole word.
        uses = cutter.expected(points, np.ones(1), chances[:, 0])
        sizes = np.append(cutter.sizes, 1)
        assert math.isclose((uses * sizes).sum(), len(word), rel_tol=1e-9)


def plain_sums(cutter, word, chances):
    """Log of the sum over all segmentations, and the expected uses of each piece, one character and piece at a time."""
    names = {}
    for size in range(1, cutter.longest + 1):
        for at in range(len(word) - size + 1):
            part = np.array([[ord(c) for c in word[at : at + size]]])
            piece = int(cutter.keys.find(cutter._key(cutter._prefix(part)[:, -1], size))[0])
            if piece >= 0 or size == 1:
                names[at, at + size] = piece if piece >= 0 else cutter.n - 1
    forward, backward = [0.0] + [-math.inf] * len(word), [-math.inf] * len(word) + [0.0]
    for (at, to), piece in sorted(names.items(), key=lambda x: x[0][1]):
        forward[to] = np.logaddexp(forward[to], forward[at] + math.log(chances[piece]))
    for (at, to), piece in sorted(names.items(), key=lambda x: -x[0][0]):
        backward[at] = np.logaddexp(backward[at], backward[to] + math.log(chances[piece]))
    uses = np.zeros(cutter.n)
    for (at, to), piece in names.items():
        uses[piece] += math.exp(forward[at] + math.log(chances[piece]) + backward[to] - forward[-1])
    return forward[-1], uses


LETTERS = np.random.default_rng(9).choice(list("etaoinshrdlu"), 1_500)


@pytest.mark.parametrize("word", ["▁internationalization" * 4, "▁" + "".join(LETTERS), "▁" + "a" * 900, "▁" + "日本語のテキスト" * 90, "▁" + "ab" * 256, "▁" + "q" * 511])
def test_long_words_sum_all_segmentations(word):
    cutter = op4.segmenter(op4.public_tokenizers.path(op4.MODEL))
    chances = np.maximum(np.random.default_rng(len(word)).uniform(0, 1e-3, (cutter.n, 2)) ** 2, op4.FLOOR)
    points = np.array([[ord(c) for c in word]])
    logs = cutter.logs(points, chances)
    for k in range(2):
        want, uses = plain_sums(cutter, word, chances[:, k])
        assert math.isclose(logs[0, k], want, rel_tol=1e-11)
        got = cutter.uses([word[1:]], np.full(1, 3.0), chances[:, k])
        assert math.isclose(got @ np.append(cutter.sizes, 1), 3 * uses @ np.append(cutter.sizes, 1), rel_tol=0.02)
        if word != "▁" + "a" * 900:
            assert np.allclose(got, 3 * uses, rtol=1e-6, atol=1e-9)


def test_a_chunk_that_does_not_agree_is_summed_again(monkeypatch):
    cutter = op4.segmenter(op4.public_tokenizers.path(op4.MODEL))
    chances = np.full((cutter.n, 1), 1e-4)
    points = np.array([[ord(c) for c in "▁" + "".join(LETTERS)]])
    want = cutter.logs(points, chances)
    monkeypatch.setattr(op4, "AGREE", -1.0)
    assert np.allclose(cutter.logs(points, chances), want, rtol=1e-11)


def test_a_million_characters_without_a_break():
    cutter = op4.segmenter(op4.public_tokenizers.path(op4.MODEL))
    points = np.tile(np.array([ord(c) for c in LETTERS]), 667)[None, :1_000_000]
    assert np.isfinite(cutter.logs(points, np.full((cutter.n, 3), 1e-4))).all()


def test_prediction_by_plain_sums(spark):
    texts = [("en", "the nation and the people"), ("en", "of the house"), ("fr", "la nation et le peuple"), ("fr", "dans la maison"), ("de", "das Haus und das Volk")]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = op4.fit(docs)
    cutter = op4.segmenter(model.path)
    given = ["the house and la maison", "das " + "Volkshaus" * 80, "peuple", "nation"]
    rows = op4.predict(spark.createDataFrame(list(enumerate(given)), "doc_id long, text string"), model).collect()
    for row in rows:
        total = model.prior + sum(np.array([plain_sums(cutter, "▁" + w, model.chances[:, k])[0] for k in range(3)]) for w in given[row.doc_id].split())
        assert row.lang_pred == model.langs[int(total.argmax())]
        assert math.isclose(row.score, 1 / np.exp(total - total.max()).sum(), rel_tol=1e-9)


@pytest.mark.parametrize("text", ["x" * 5000, "日" * 500, "a " * 5000])
def test_long_words_stay_finite(text):
    cutter = op4.segmenter(op4.public_tokenizers.path(op4.MODEL))
    model = op4.LanguageModel(["a", "b"], np.full((cutter.n, 2), [op4.FLOOR, 1e-4]), np.zeros(2), op4.public_tokenizers.path(op4.MODEL))
    best, score = model.predict(op4.pa.array([text]))
    assert best[0] == 1 and np.isfinite(score[0])


def test_language_of_odd_documents(spark, odd_docs, no_docs):
    model = op4.fit(odd_docs)
    rows = op4.predict(odd_docs.select("doc_id", "text"), model).collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert all(found[k] == ("und", 0.0) for k in (0, 1, 2, 9)) and found[6] == ("en", 1.0)
    nothing = op4.fit(no_docs)
    assert {r.lang_pred for r in op4.predict(odd_docs.select("doc_id", "text"), nothing).collect()} == {"und"}
    assert op4.predict(no_docs.select("doc_id", "text"), model).count() == 0
