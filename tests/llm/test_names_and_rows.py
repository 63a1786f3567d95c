"""Rows without an id or of one id, columns with the names of results, and vectors of any length and size."""

import math
from collections import Counter

import corpus_pipeline
import pytest

from chatloom.llm import op7_embeddings as op7
from chatloom.llm import op10_licenses as op10


def test_license_rows_of_one_id_keep_their_own_words(spark):
    texts = ["license mit the under", "under the mit license", "mit under license the", "license mit the under"]
    texts += ["x nc y by cc", "cc by nc x y", "y cc by nc x", "Under the MIT license!", None, ""]
    rows = [(i, text) for i in (None, 7) for text in texts]
    found = op10.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = Counter((r.id, r.n_words, r.n_base, r.first_word, r.base_labels) for r in found)
    want = Counter()
    for i, text in rows:
        words = (text or "").lower().replace("!", "").split()
        places = []
        for label, phrase in (("mit", "under the mit license"), ("cc-by-nc", "cc by nc")):
            n = len(phrase.split())
            places += [(at, label) for at in range(len(words) - n + 1) if words[at : at + n] == phrase.split()]
        labels = ",".join(sorted({label for _, label in places}))
        want[(i, len(words), len(places), min(places)[0] if places else None, labels)] += 1
    assert got == want


def brute_links(vectors, least=0.95):
    unit = []
    for v in vectors:
        sound = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        top = max(map(abs, v)) if sound else 1
        scaled = [x / top for x in v] if sound else None
        norm = math.sqrt(sum(x * x for x in scaled)) if sound else 1
        unit.append([x / norm for x in scaled] if sound else None)
    pairs = []
    for i, a in enumerate(unit):
        for j, b in enumerate(unit):
            if i != j and a and b and len(a) == len(b) and sum(x * y for x, y in zip(a, b)) >= least - 1e-12:
                pairs.append((i, j))
    return pairs


def test_vectors_of_all_lengths_and_sizes(spark):
    vectors = [[1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [0.0, 0.0], [], None, [1.0, None], [math.nan, 1.0]]
    vectors += [[1e200 * x for x in (1.0, 2.0, 3.0)], [2e200 * x for x in (1.0, 2.0, 3.0)], [1e308, -1e308], [1e-308, -1e-308]]
    vectors += [[1e-200 * x for x in (1.0, 2.0, 3.0)], [5e-324, 0.0, 0.0], [7.0, 0.0, 0.0], [4.0], [-4.0], [1e-300], [math.inf, 1.0]]
    vectors += [[1.0, 0.0], [0.0, 1.0], [-1.0, -2.0]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in op7.near_duplicates(frame).collect()}
    pairs, least = brute_links(vectors), list(range(len(vectors)))
    for _ in vectors:
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
    links = Counter(i for i, _ in pairs)
    assert got == {i: (links[i], least[i]) for i in range(len(vectors))}


NAMES = [
    "_score", "_score_", "score", "n_removed", "n_spans", "n_bytes", "_key", "_kept", "_own", "key", "new_text", "own", "row", "kept",
    "_n", "_id", "_whole", "n", "id", "whole", "root", "fp", "component", "first", "n_hit", "n_words", "spans", "item_id", "text_2",
]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:4]])
def test_stages_take_columns_of_any_name(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = docs.union(docs.limit(5))
    plain = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    odd = docs
    for number, extra in enumerate(NAMES):
        odd = odd.withColumn(extra, docs["doc_id"] + number)
    result = dict(corpus_pipeline.STAGES)[name](spark, odd, sf_dir)
    assert result.columns == odd.columns
    rows = result.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in plain.collect())
    assert all(r[extra] == r.doc_id + number for r in rows for number, extra in enumerate(NAMES))
