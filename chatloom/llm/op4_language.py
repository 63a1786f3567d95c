"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is
the sum over all ways to cut it into pieces (forward algorithm); a text's is the product over its words.
Piece probabilities are learned by expectation maximisation: the forward and backward sums of a word give
the expected number of times that it uses each piece. Words are cut at white space and start with U+2581.

No segmentation is left out, however long a word is. Sums are kept near 1 by scales that are added up as logarithms. A word
of over 512 characters is summed in chunks that advance together, each from some way before its start; there the sums of
the last characters, up to a factor, must be those that the chunk before ended with, or the chunk is summed again from
these. When pieces are learned, the uses in a chunk are counted with 256 characters of
text on both sides, of which what lies further off is independent but for words that repeat one or two letters.

Only the words of a bounded sample of labelled rows are learned from (``max_train``, those with the
smallest hashed ids), and Spark sums their counts by language; prediction reads every whole text. Each
distinct word of a batch is scored once, words of equal length together.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text if no
labelled row was there. Ties go to the language that is first in alphabetical order. Repeated ids are
separate rows. Columns other than the id and the text (to learn: and the language) are ignored.
"""

import functools
import itertools
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.llm.common import SortedKeys, crc_bucket, mix64, sums, table, text_chunks

MODEL = "piece_bpe_32k.model"
MAX_TRAIN = 6_000
ROUNDS = 3
#: Weight of the pooled distribution in each language's own, in pieces.
SMOOTHING = 200.0
CELLS = 1 << 16
MEMO = 500_000
#: No piece is less likely, and sums are scaled every so many characters: so they stay within double precision for pieces
#: of up to 30 characters.
FLOOR = 1e-9
EVERY = 16
#: Longer words are summed in chunks, which start this many characters early.
LONG, CHUNK, EARLY, AROUND = 512, 256, 96, 256
#: Sums of two chunks agree up to this part.
AGREE = 1e-10
BASE = np.uint64(0x9E3779B97F4A7C15)
UNDETERMINED = "und"
HAS_LETTER = r"\p{L}"


class Segmenter:
    """The pieces of a model, and which of them lie where in words of one length."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        skip = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not skip(i)]
        self.sizes = np.array([len(p) for p in pieces])
        self.longest = int(self.sizes.max())
        #: Pieces and one more: any single character without a piece.
        self.n = len(pieces) + 1
        self.powers = np.ones(self.longest + 1, np.uint64)
        self.powers[1:] = np.cumprod(np.full(self.longest, BASE))
        keys = np.zeros(len(pieces), np.uint64)
        for size in np.unique(self.sizes):
            rows = np.flatnonzero(self.sizes == size)
            points = np.array([[ord(c) for c in pieces[r]] for r in rows], np.uint64)
            keys[rows] = self._key(self._prefix(points)[:, -1], size)
        self.keys = SortedKeys(keys)

    @staticmethod
    def _prefix(points):
        out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        spread = mix64(points.astype(np.uint64) + np.uint64(1))
        for i in range(points.shape[1]):
            out[:, i + 1] = out[:, i] * BASE + spread[:, i]
        return out

    @staticmethod
    def _key(hashes, size):
        return mix64(hashes + mix64(np.atleast_1d(size).astype(np.uint64)))

    def ends_at(self, prefix, i):
        """For words with these prefix hashes: the piece from each earlier start to i, or -1."""
        lengths = np.arange(1, min(i, self.longest) + 1)
        hashes = prefix[:, i, None] - prefix[:, i - lengths] * self.powers[lengths]
        piece = self.keys.find(self._key(hashes, lengths))
        piece[:, 0] = np.where(piece[:, 0] < 0, self.n - 1, piece[:, 0])
        return i - lengths, piece

    def forward(self, points, chances, given=None, mark=None):
        """Sums over the segmentations of each prefix of words of one length, under each language (columns of
        ``chances``, one row per piece). ``given`` are the sums of the first prefixes, if words go on from there.

        Returns the sums (scaled), the pieces found, the logarithm of the scale after each ``EVERY`` characters, and the
        sums of the last prefixes (1 at the last) with their logarithm at ``mark`` and at the end.
        """
        prefix, size = self._prefix(points), points.shape[1]
        rows_n = len(points)
        alpha = np.zeros((rows_n, size + 1, chances.shape[1]))
        alpha[:, 0] = 1
        first, found, states = 1, [], []
        if given is not None:
            first = given.shape[1]
            alpha[:, :first] = given
        logs = np.zeros((rows_n, size // EVERY + 1, chances.shape[1]))
        for i in range(first, size + 1):
            starts, piece = self.ends_at(prefix, i)
            rows, cols = np.nonzero(piece >= 0)
            piece, starts = piece[rows, cols], starts[cols]
            found.append((rows, starts, piece))
            terms = alpha[rows, starts] * chances[piece]
            # Every row has a piece here: at least its last character.
            alpha[:, i] = np.add.reduceat(terms, np.searchsorted(rows, np.arange(rows_n)), axis=0)
            if i % EVERY == 0:
                by = alpha[:, i].copy()
                alpha[:, max(0, i - self.longest + 1) : i + 1] /= by[:, None]
                logs[:, i // EVERY :] += np.log(by)[:, None]
            if i in (mark, size):
                last = alpha[:, max(0, i - self.longest + 1) : i + 1]
                states.append((last / alpha[:, i, None], np.log(alpha[:, i]) + logs[:, i // EVERY]))
        return alpha, found, logs, states

    def expected(self, points, weights, chances, inner=slice(None)):
        """Expected uses of each piece in words of one length, by one language's ``chances``: of the pieces that end
        after the characters of ``inner``."""
        alpha, found, logs, states = self.forward(points, chances[:, None])
        alpha, logs, whole, size = alpha[:, :, 0], logs[:, :, 0], states[-1][1][:, 0], points.shape[1]
        # A prefix has the scale of the last time that it was among the last ones.
        scale = logs[:, np.minimum((np.arange(size + 1) + self.longest - 1) // EVERY, size // EVERY)]
        counted = np.zeros(size + 1, bool)
        counted[1:][inner] = True
        beta, behind = np.zeros(alpha.shape), np.zeros(len(points))
        beta[:, size] = 1
        out = np.zeros(self.n)
        for i in range(size, 0, -1):
            if i % EVERY == 0:
                by = beta[:, i].copy()
                beta[:, max(0, i - self.longest) : i + 1] /= by[:, None]
                behind += np.log(by)
            rows, starts, piece = found[i - 1]
            step = chances[piece] * beta[rows, i]
            beta[rows, starts] += step
            if counted[i]:
                share = alpha[rows, starts] * step * np.exp(scale[rows, starts] + (behind - whole)[rows])
                out += np.bincount(piece, share * weights[rows], self.n)
        return out

    def uses(self, words: list[str], weights, chances):
        """Expected uses of each piece in words, by one language's ``chances``."""
        out = np.zeros(self.n)
        for rows, points in self.by_length(words):
            if points.shape[1] <= LONG:
                out += self.expected(points, weights[rows], chances)
                continue
            for row, line in zip(rows, points):
                for spots in self._chunks(line.size, AROUND, AROUND):
                    lo, at, to, hi = spots[0]
                    part = np.stack([line[x[0] : x[3]] for x in spots])
                    out += self.expected(part, np.full(len(part), weights[row]), chances, slice(at - lo, to - lo))
        return out

    @staticmethod
    def _chunks(size: int, before: int, after: int):
        """Chunks ``(start early, start, end, end late)`` of a word, in lists of alike ones that are worked on together."""
        every = [(max(0, at - before), at, min(at + CHUNK, size), min(at + CHUNK + after, size)) for at in range(0, size, CHUNK)]
        shape = lambda x: (x[1] - x[0], x[2] - x[1], x[3] - x[2])
        for _, alike in itertools.groupby(every, shape):
            alike = list(alike)
            step = CELLS // (before + CHUNK + after)
            for k in range(0, len(alike), step):
                yield alike[k : k + step]

    def logs(self, points, chances):
        """Logarithm of the sum over all segmentations of words of one length: (rows, languages)."""
        if points.shape[1] <= LONG:
            return self.forward(points, chances)[3][-1][1]
        return np.stack([self._long_log(line, chances) for line in points])

    def _long_log(self, line, chances):
        total, ended = np.zeros(chances.shape[1]), None
        for spots in self._chunks(line.size, EARLY, 0):
            lo, at, to, _ = spots[0]
            states = self.forward(np.stack([line[x[0] : x[2]] for x in spots]), chances, mark=at - lo or None)[3]
            for k, (_, start, end, _) in enumerate(spots):
                last, log = states[-1][0][k], states[-1][1][k]
                if ended is not None:
                    log = log - states[0][1][k]
                    if not np.allclose(states[0][0][k], ended, rtol=AGREE, atol=0):
                        rest = line[None, start - self.longest + 1 : end]
                        again = self.forward(rest, chances, given=ended[None])[3][-1]
                        last, log = again[0][0], again[1][0]
                total += log
                ended = last
        return total

    def by_length(self, words: list[str]):
        """Code points of ``words`` in blocks of one length: (index of each row's word, matrix)."""
        if not words:
            return
        cut = ["▁" + w for w in words]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.frombuffer("".join(cut).encode("utf-32-le"), np.uint32)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        order = np.argsort(sizes, kind="stable")
        edges = np.searchsorted(sizes[order], np.unique(sizes), "left")
        for lo, hi in zip(edges, [*edges[1:], len(order)]):
            size = int(sizes[order[lo]])
            step = max(1, CELLS // size)
            for at in range(lo, hi, step):
                rows = order[at : min(at + step, hi)]
                yield rows, flat[offsets[rows][:, None] + np.arange(size)]


@functools.lru_cache(2)
def segmenter(path: str) -> Segmenter:
    """Built once in each Python worker."""
    return Segmenter(path)


@dataclass
class LanguageModel:
    """``chances``: probability of each piece (rows) by language (columns); ``prior``: log-shares."""

    langs: list[str]
    chances: np.ndarray
    prior: np.ndarray
    path: str

    def __post_init__(self):
        self.memo, self.known = {}, np.zeros((0, len(self.langs)))

    def __reduce__(self):
        return LanguageModel, (self.langs, self.chances, self.prior, self.path)

    def _new_logs(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)))
        cutter = segmenter(self.path)
        for rows, points in cutter.by_length(words):
            out[rows] = cutter.logs(points, self.chances)
        return out

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word by language, with a memory of the last words."""
        if len(self.memo) > MEMO:
            self.__post_init__()
        slots = np.fromiter((self.memo.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(slots < 0)
        names = [words[k] for k in new.tolist()]
        slots[new] = np.arange(len(self.known), len(self.known) + len(new))
        self.known = np.concatenate((self.known, self._new_logs(names)))
        self.memo.update(zip(names, slots[new].tolist()))
        return self.known[slots]

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index and probability of the likeliest language of each text."""
        words, bounds = split_words(column)
        coded = words.dictionary_encode()
        each = self.word_logs(coded.dictionary.to_pylist())
        total = sums(each[coded.indices.to_numpy(zero_copy_only=False)], bounds) + self.prior
        best = total.argmax(axis=1)
        total -= total.max(axis=1, keepdims=True)
        return best, 1 / np.exp(total).sum(axis=1)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts and the offsets of each text's."""
    texts = pc.utf8_trim_whitespace(pc.fill_null(column.cast(pa.large_string()), ""))
    split = pc.utf8_split_whitespace(texts)
    bounds = split.offsets.to_numpy()
    return split.values.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]


def word_table(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Counts of each word by language."""

    def work(batches):
        for part in text_chunks(batches, text_col):
            langs = part.column(lang_col).to_pylist()
            for lang in sorted(set(langs)):
                rows = pa.array([k for k, x in enumerate(langs) if x == lang])
                words, _ = split_words(part.column(text_col).take(rows))
                counted = pc.value_counts(words)
                n = len(counted)
                columns = [pa.array([lang] * n, pa.string()), counted.field(0).cast(pa.string()), counted.field(1)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    rows = docs.mapInArrow(work, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_train: int = MAX_TRAIN,
    rounds: int = ROUNDS,
    model: str | None = None,
) -> LanguageModel:
    """Learns from at most ``max_train`` rows of ``docs`` with a language and a text."""
    path = model or public_tokenizers.path(MODEL)
    cutter = segmenter(path)
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    chosen = known.select(F.col(id_col).alias("_id")).where("_id is not null")
    chosen = chosen.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(max_train).distinct()
    sample = known.join(F.broadcast(chosen), known[id_col] == F.col("_id"), "left_semi")
    sample = sample.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    shares = {r.lang: r["count"] for r in sample.groupBy("lang").count().toLocalIterator()}
    langs = sorted(shares)
    prior = np.log([shares[x] / sum(shares.values()) for x in langs])
    words = word_table(sample, "text", "lang").persist()
    # Start: early pieces of the vocabulary are frequent ones.
    start = 1 / (np.arange(cutter.n) + 20.0)
    chances = np.tile((start / start.sum())[:, None], len(langs))
    for _ in range(rounds if langs else 0):
        chances = _maximised(_expected(words, langs, chances, path))
    words.unpersist()
    return LanguageModel(langs, chances, prior, path)


def _maximised(counts: np.ndarray) -> np.ndarray:
    pooled = counts.sum(axis=1) + 0.01
    mixed = counts + SMOOTHING * (pooled / pooled.sum())[:, None]
    return np.maximum(mixed / mixed.sum(axis=0), FLOOR)


def _expected(words: DataFrame, langs, chances, path) -> np.ndarray:
    """Expected piece counts by language: a table of fixed size, summed by Spark."""
    held = words.sparkSession.sparkContext.broadcast(chances)

    def work(batches):
        cutter, out = segmenter(path), np.zeros(held.value.shape)
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for k, lang in enumerate(langs):
                part = batch.take(pa.array([i for i, x in enumerate(names) if x == lang], pa.int64()))
                weights = part.column("n").to_numpy(zero_copy_only=False).astype(float)
                out[:, k] += cutter.uses(part.column("word").to_pylist(), weights, held.value[:, k])
        piece, k = np.nonzero(out)
        columns = [pa.array(k), pa.array(piece), pa.array(out[piece, k])]
        yield pa.RecordBatch.from_arrays(columns, names=["k", "piece", "uses"])

    found = words.mapInArrow(work, "k long, piece long, uses double")
    out = np.zeros(chances.shape)
    for row in found.groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toLocalIterator():
        out[row.piece, row.k] = row.uses
    return out


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [n for n in docs.columns if n not in (text_col, "lang_pred", "score")]
    schema = T.StructType([*(docs.schema[n] for n in names), T.StructField("_best", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_letters", T.BooleanType())])

    def work(batches):
        found = held.value
        for part in text_chunks(batches, "_text"):
            n = part.num_rows
            if found.langs:
                best, score = found.predict(part.column("_text"))
                best = [found.langs[k] for k in best.tolist()]
            else:
                best, score = [UNDETERMINED] * n, np.zeros(n)
            columns = dict(zip(part.schema.names, part.columns))
            columns |= {"_best": pa.array(best, pa.string()), "_score": pa.array(score)}
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], names=schema.names)

    letters = F.coalesce(F.col(text_col).rlike(HAS_LETTER), F.lit(False))
    given = docs.select(*names, F.col(text_col).alias("_text"), letters.alias("_letters"))
    scored = given.mapInArrow(work, schema)
    return scored.select(
        *names,
        F.when(F.col("_letters"), F.col("_best")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("_letters"), F.col("_score")).otherwise(0.0).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out, its language, and that language's probability."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(crc_bucket(F.col("doc_id"), 5) != 0))
    held_out = (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out")
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score")
