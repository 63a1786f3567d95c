"""Quality classifier: supervised subword embeddings.

Words and character n-grams are hashed into buckets, every bucket has a learned vector, a document is the
mean of the vectors of all its n-grams, and a softmax layer gives the class probabilities. Vectors and
layer are trained together by stochastic gradient descent in numpy. The fit uses a bounded sample of the
labelled rows (``max_train``, those with the smallest hashed ids); scoring reads every whole text.

As the layer is linear, a bucket's vector times the difference of the two output rows is one number, so
scoring adds one number per n-gram and never builds the document's vector.

Defined results: null and empty texts have no n-grams and get the score of the bias and the prior alone. Labels that are
null, not 0 or 1, or contradict each other for one id are left out. Without labels of both classes every
score is the share of good labels (0.5 without any). Repeated ids are separate rows. Columns other than
the id and the text are ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.llm.common import crc_bucket, flat_bytes, free_name, sums, table, text_chunks

BITS = 17
SIZE = 12
GRAMS = (3, 4)
#: Periods of repeated words that have a feature.
PERIODS = 12
#: n-grams that the prior counts as.
SMOOTHING = 30
MAX_TRAIN = 3_000
EPOCHS = 12
RATE = 2.0
#: Bytes of text that are scored at once. The arrays of n-grams take some fifty bytes for each.
SCORED_BYTES = 512 << 10
ODD = 0x9E3779B1


def _mixed(codes: np.ndarray, bits: int) -> np.ndarray:
    codes = codes ^ (codes >> np.uint32(15))
    return (codes * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS, grams: tuple = GRAMS):
    """Hashed features of each text, one group after another: (buckets, offsets by text)."""
    wide = data.astype(np.uint32)
    code = wide.copy()
    for size in range(2, max(grams) + 1):
        if len(data) < size:
            return
        # Each character n-gram is packed into 32 bits (hashed beyond four bytes).
        code = code[:-1] * np.uint32(256 if size <= 4 else ODD) + wide[size - 1 :]
        if size in grams:
            ends = np.maximum(offsets[1:] - size + 1, offsets[:-1])
            if len(offsets) == 2:
                yield _mixed(code + np.uint32(size), bits), np.array([0, ends[0]])
                continue
            inside = np.ones(len(code) + 1, bool)
            # n-grams that reach over the end of a text are none.
            for back in range(1, size):
                cut = offsets[1:] - back
                inside[cut[(cut >= offsets[:-1]) & (cut <= len(code))]] = False
            kept = np.flatnonzero(inside[: len(code)])
            yield _mixed(code[kept] + np.uint32(size), bits), np.searchsorted(kept, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words (cut at white space) and their offsets by text."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~blank
    begins[1:] &= blank[:-1]
    edge = offsets[:-1][np.diff(offsets) > 0]
    begins[edge] = ~blank[edge]
    starts = np.flatnonzero(begins)
    # Sums of mixed (byte, place in the word) pairs: a hash that needs no loop over words.
    head = int(starts[0]) if len(starts) else len(data)
    own = np.repeat(starts, np.diff(np.append(starts, len(data)))).astype(np.uint32)
    place = np.arange(len(data), dtype=np.uint32) - np.concatenate((np.zeros(head, np.uint32), own))
    pair = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(ODD) + place * np.uint32(0xC2B2AE35)
    pair ^= pair >> np.uint32(15)
    pair *= np.uint32(0x27D4EB2F)
    pair ^= pair >> np.uint32(13)
    pair[blank] = 0
    total = np.zeros(len(data) + 1, np.uint32)
    np.cumsum(pair, out=total[1:], dtype=np.uint32)
    codes = total[np.append(starts[1:], len(data))] - total[starts] if len(starts) else starts.astype(np.uint32)
    return codes.astype(np.uint32), np.searchsorted(starts, offsets)


def repeats(codes: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """Word n-grams written with back-references: "the word before again", and "the last two words as p
    words ago" for each p up to PERIODS."""
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for period in range(1, PERIODS + 1):
        same = np.zeros(len(codes), bool)
        same[period:] = (codes[period:] == codes[:-period]) & (row[period:] == row[:-period])
        if period == 1:
            yield _repeat(np.flatnonzero(same), 0, bits), np.searchsorted(np.flatnonzero(same), offsets)
        same[1:] &= same[:-1]
        found = np.flatnonzero(same)
        yield _repeat(found, period, bits), np.searchsorted(found, offsets)


def _repeat(found, kind, bits):
    return np.broadcast_to(_mixed(np.array([0xFFFF0000 + kind], np.uint32), bits), found.shape)


@dataclass
class QualityModel:
    """One number per bucket, a bias, log-odds of the classes, and the hashing they belong to: all that scoring needs."""

    weights: np.ndarray
    bias: float
    prior: float = 0.0
    bits: int = BITS
    grams: tuple = GRAMS

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for buckets, bounds in _groups(data, offsets, self.bits, self.grams):
            total += sums(self.weights[buckets].astype(np.float64), bounds)
            count += np.diff(bounds)
        # A few n-grams say little: a short text starts from the log-odds of the classes.
        margin = (total + SMOOTHING * self.prior) / (count + SMOOTHING) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _groups(data, offsets, bits, grams):
    if len(data):
        codes, bounds = words(data, offsets)
        yield _mixed(codes, bits), bounds
        yield from repeats(codes, bounds, bits)
        yield from features(data, offsets, bits, grams)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits=BITS, size=SIZE, epochs=EPOCHS, rate=RATE, seed=1):
    """Vectors and softmax layer by gradient descent, one document at a time. ``rows``: (buckets, their
    shares of the document, label)."""
    labels = np.array([y for *_, y in rows], int)
    good = labels.mean() if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        share = np.clip(good, 1e-3, 1 - 1e-3)
        return np.zeros(1 << bits, np.float32), float(np.log(share / (1 - share))), 0.0
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << bits, size)).astype(np.float32)
    layer, bias = np.zeros((2, size), np.float32), np.zeros(2, np.float32)
    # Both classes weigh alike, whatever their shares.
    weight = np.where(labels == 1, 0.5 / good, 0.5 / (1 - good))
    done, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, shares, label = rows[k]
            step = rate * (1 - done / steps)
            done += 1
            mean = shares @ vectors[ids] if len(ids) else np.zeros(size, np.float32)
            out = layer @ mean + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[label] -= 1
            error *= weight[k] * step
            back = error @ layer
            layer -= np.outer(error, mean)
            bias -= error * 0.1
            if len(ids):
                vectors[ids] -= shares[:, None] * back
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]), float(np.log(good / (1 - good)))


def clean_labels(labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """One 0/1 label per id; contradictions and other values go."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
    one = known.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
    return one.where("_label = _other").select("_id", F.col("_label").cast("int").alias("_label"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
    bits: int = BITS,
    grams: tuple = GRAMS,
) -> QualityModel:
    """Trains on at most ``max_train`` labelled documents of ``docs``. A document reaches the driver as its
    distinct buckets and their counts, at most 2^bits of them."""
    chosen = clean_labels(labels, label_col, id_col)
    chosen = chosen.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(max_train)
    # At most max_train rows of an id and a label.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.join(F.broadcast(chosen), "_id").select("_text", "_label")

    def work(batches):
        for part in text_chunks(batches, "_text", 1):
            data, offsets = flat_bytes(part.column("_text"))
            found = [b for b, _ in _groups(data, offsets, bits, grams)]
            ids, counts = np.unique(np.concatenate([np.zeros(0, np.uint32), *found]), return_counts=True)
            packed = np.stack([ids, counts]).astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([packed]), part.column("_label")], names=["f", "y"])

    rows = []
    sampled = texts.mapInArrow(work, "f binary, y int").orderBy(F.xxhash64("f"), "y").limit(max_train)
    for row in sampled.toLocalIterator():
        ids, counts = np.frombuffer(row.f, np.uint32).reshape(2, -1)
        rows.append((ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32), row.y))
    weights, bias, prior = train(rows, bits)
    return QualityModel(weights.astype(np.float32), bias, prior, bits, grams)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the probability of the good class for each text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != to), T.StructField(to, T.DoubleType())])
    names = schema.names

    def work(batches):
        for part in text_chunks(batches, text_col, SCORED_BYTES):
            column = part.column(text_col)
            values = held.value.score(*flat_bytes(column))
            columns = dict(zip(part.schema.names, part.columns)) | {to: pa.array(values, pa.float64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return docs.mapInArrow(work, schema)


def training_docs(docs: DataFrame) -> DataFrame:
    """The rows that labels may be learned from."""
    return docs.where(crc_bucket(F.col("doc_id"), 3) != 1)


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> QualityModel:
    return fit(training_docs(docs), training_docs(table(spark, sf_dir, "labels")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out, its score, and the predicted class."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fitted(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` without those predicted to be of low quality."""
    name = free_name(docs, "_score")
    scored = score(docs, fitted(spark, docs, sf_dir), to=name)
    return scored.where(F.col(name) >= 0.5).drop(name)
