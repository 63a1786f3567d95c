"""Hard negatives, with exact integer scores from float32 matrix products in a residue number system.

Vectors are scaled to integers. Anchors are taken in tiles of bounded size; every row meets every tile. For a tile
and a chunk of rows the scores are multiplied modulo several small primes: residues are at most half a prime, so a
product of float32 matrices is exact as long as its terms stay below 2^24, and is reduced after so many components.
The residues are put together by the Chinese remainder theorem in mixed radix, to the exact signed score. The
number of primes follows from the largest norm, which bounds every score.

A first pass over all rows selects the positives of each anchor, a second the negatives in the score window of each
positive. Rows of a tile are split over at most ``SPLITS`` tasks, so what tasks hand on for an anchor is bounded, and
each task holds a tile, a chunk and the best so far.

Nulls and ties: a row without a label or vector, or with a component that is null or not finite, takes no part; nor
does one whose scaled squared norm is 2^53 or more, whose scores need not fit the result. Vectors of different lengths
have no score. A null id is no anchor and comes last among equal scores; the id 2^63 - 1 is taken for a null one. Rows that repeat are each counted; a row is
not its own positive, but an equal row is. Labels and sources decide nothing else; extra columns are ignored,
whatever their names. An empty table gives no rows, nor does an anchor without positives or a positive without
negatives.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import table
from chatloom.session import materialize

SCALE = 256
#: Anchors of a tile, and the most tasks its rows are split over.
TILE, SPLITS = 4096, 64
#: Rows worth a task of their own.
SPLIT_ROWS = 8192
#: Anchors and rows that are scored at once.
BLOCK, CHUNK = 512, 1024
#: Squared norms stay below this, so that scores and their percentages are exact 64-bit integers.
MAX_NORM = 2**53
#: Enough primes for any score in those bounds; half of each squared leaves room for hundreds of exact terms.
PRIMES = (251, 241, 239, 233, 229, 227, 223)
POSITIVES, NEGATIVES = 5, 10
#: Least and greatest percentage of the positive's score.
WINDOW = (30, 90)

_NO_ID = np.iinfo(np.int64).max


class ResidueProduct:
    """Exact products of an integer matrix with others, whose results are at most ``bound`` in size."""

    def __init__(self, left: np.ndarray, bound: int):
        self.primes, product = [], 1
        for prime in PRIMES:
            if product > 2 * bound + 1:
                break
            self.primes.append(prime)
            product *= prime
        self.product = product
        self.left = [self._residues(left, prime) for prime in self.primes]
        # Terms that a float32 sum can hold exactly.
        self.terms = 2**24 // ((self.primes[0] // 2) ** 2 + 1) - 1
        # What takes the digits found so far to the next residue.
        self.inverses = [
            pow(int(np.prod(self.primes[:k], dtype=object)), -1, prime) if k else 1 for k, prime in enumerate(self.primes)
        ]

    @staticmethod
    def _residues(matrix: np.ndarray, prime: int) -> np.ndarray:
        """Residues between minus and plus half of ``prime``."""
        half = prime // 2
        return ((matrix + half) % prime - half).astype(np.float32)

    def times(self, right: np.ndarray) -> np.ndarray:
        """The product with the transpose of ``right``, as 64-bit integers."""
        value, radix = None, 1
        for prime, left, inverse in zip(self.primes, self.left, self.inverses):
            other = self._residues(right, prime)
            residue = np.zeros((len(left), len(right)), np.int32)
            for at in range(0, left.shape[1], self.terms):
                part = left[:, at : at + self.terms] @ other[:, at : at + self.terms].T
                residue = (residue + part.astype(np.int32)) % prime
            if value is None:
                value = residue.astype(np.int64)
            else:
                value += (residue - value % prime) * inverse % prime * radix
            radix *= prime
        return np.where(value > self.product // 2, value - self.product, value)


class Best:
    """The ``k`` best (score, id) of each of ``n`` lists: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.least = np.full(n, np.iinfo(np.int64).min)
        self.rows = self.scores = self.ids = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, valid: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row for each list and a column for each of ``ids``."""
        valid = valid & (scores >= self.least[:, None])
        if scores.shape[1] > self.k and np.count_nonzero(valid) > 4 * self.k * len(self.least):
            kept = np.where(valid, scores, np.iinfo(np.int64).min)
            valid &= scores >= np.partition(kept, -self.k, axis=1)[:, -self.k, None]
        at, which = np.nonzero(valid)
        rows, values, names = (np.concatenate(pair) for pair in ((self.rows, at), (self.scores, scores[at, which]), (self.ids, ids[which])))
        order = np.lexsort((names, -values, rows))
        rows, values, names = rows[order], values[order], names[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < self.k
        self.rows, self.scores, self.ids = rows[kept], values[kept], names[kept]
        full = rank == self.k - 1
        self.least[rows[full]] = values[full]


class _Meeting:
    """A block of anchors, and the scores of the rows that they meet."""

    def __init__(self, anchors: pa.RecordBatch, bound: int):
        self.numbers, self.ids, self.labels = (_numbers(anchors, name) for name in ("row", "id", "label"))
        self.vectors = _vectors(anchors)
        self.product = ResidueProduct(self.vectors, bound)

    def scored(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        """Scores, and whether a row has the anchor's label and whether it equals the anchor."""
        scores = self.product.times(vectors)
        same, equal = self.labels[:, None] == labels, np.zeros(scores.shape, bool)
        at, which = np.nonzero(same & (self.ids[:, None] == ids))
        equal[at, which] = (self.vectors[at] == vectors[which]).all(axis=1)
        return scores, same, equal


class _Positives(_Meeting):
    SCHEMA = "anchor bigint, score bigint, id bigint"

    def __init__(self, anchors, bound):
        super().__init__(anchors, bound)
        self.best = Best(len(self.ids), POSITIVES)

    def add(self, ids, labels, vectors):
        scores, same, equal = self.scored(ids, labels, vectors)
        # How many rows equal the anchor is known, so they are not looked for here.
        self.best.add(scores, same & ~equal, ids)

    def result(self):
        best = self.best
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.numbers[best.rows], best.scores, best.ids)], names=["anchor", "score", "id"])


class _Negatives(_Meeting):
    SCHEMA = "anchor bigint, slot bigint, score bigint, id bigint"

    def __init__(self, anchors, bound):
        super().__init__(anchors, bound)
        positives = anchors.column("positive_scores")
        sizes = np.diff(positives.offsets.to_numpy())
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        self.slots = np.arange(len(self.of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.positive = positives.flatten().to_numpy().astype(np.int64)
        self.best = Best(len(self.of), NEGATIVES)

    def add(self, ids, labels, vectors):
        scores, same, _ = self.scored(ids, labels, vectors)
        scores, same = scores[self.of], same[self.of]
        low, high = (np.int64(percent) * self.positive[:, None] for percent in WINDOW)
        hundred = 100 * scores
        self.best.add(scores, ~same & (low <= hundred) & (hundred <= high), ids)

    def result(self):
        best = self.best
        columns = self.numbers[self.of[best.rows]], self.slots[best.rows], best.scores, best.ids
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["anchor", "slot", "score", "id"])


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(batch.num_rows, -1 if batch.num_rows and len(flat) else 0)


def _runs(batches):
    """Cuts Arrow batches where the tile, the split, the width of vectors or the kind of row changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([_numbers(batch, name) for name in ("tile", "split", "width", "kind")], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(edges[:-1], edges[1:]):
            *place, kind = keys[a].tolist()
            yield tuple(place), kind, batch.slice(a, b - a)


def _meet(anchors: DataFrame, rows: DataFrame, tiles: int, splits: int, meeting: type, bound: int) -> DataFrame:
    """What ``meeting`` finds for each anchor among the rows of each split."""

    def work(batches):
        at, blocks = None, []
        for place, kind, part in _runs(batches):
            if place != at:
                yield from (block.result() for block in blocks)
                at, blocks = place, []
            if kind == 0:
                blocks += [meeting(part.slice(i, BLOCK), bound) for i in range(0, part.num_rows, BLOCK)]
                continue
            for i in range(0, part.num_rows if blocks else 0, CHUNK):
                chunk = part.slice(i, CHUNK)
                values = _numbers(chunk, "id"), _numbers(chunk, "label"), _vectors(chunk)
                for block in blocks:
                    block.add(*values)
        yield from (block.result() for block in blocks)

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    tile, split = F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int"), F.pmod(F.xxhash64("row"), F.lit(splits)).cast("int")
    none = F.array().cast("array<bigint>")
    searched = rows.select(each(tiles).alias("tile"), split.alias("split"), "width", F.lit(1).alias("kind"), "row", "id", "label", "vector", none.alias("positive_scores"))
    asking = anchors.select(tile.alias("tile"), each(splits).alias("split"), "width", F.lit(0).alias("kind"), "row", "id", "label", "vector", "positive_scores")
    dealt = asking.union(searched).repartitionByRange(tiles * splits, "tile", "split")
    return dealt.sortWithinPartitions("tile", "split", "width", "kind").mapInArrow(work, meeting.SCHEMA)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``keys`` and ``best``, the first ``k`` (lost, id): by descending score, then id. Each task sends ``k`` at most."""
    entry = F.struct((-F.col("score")).alias("lost"), "id")
    return found.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("best"))


def scaled_rows(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """row, id, label, vector (scaled to integers), width and norm of the rows that take part."""
    value = F.col("value")
    scaled = vectors.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("value"),
    )
    # Not a number is greater than all numbers.
    small = F.forall("value", lambda x: F.coalesce(F.abs(SCALE * x) < 2.0**27, F.lit(False)))
    whole = F.when(small, F.transform(value, lambda x: F.floor(SCALE * x).cast("int")))
    kept = scaled.where(F.col("label").isNotNull() & value.isNotNull()).select("id", "label", whole.alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    sized = kept.where(F.col("vector").isNotNull()).select("*", F.size("vector").alias("width"), norm.alias("norm"))
    return sized.where(F.col("norm") < float(MAX_NORM)).select(F.monotonically_increasing_id().alias("row"), "*")


def hard_negatives(
    vectors: DataFrame, anchor_every: int, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by ``anchor_every``."""
    rows = materialize(scaled_rows(vectors, id_col, label_col, vector_col), "scaled")
    n_rows, bound = rows.agg(F.count("*"), F.max("norm")).first()
    # Equal anchors have equal answers.
    asked = rows.where((F.col("id") % anchor_every == 0) & (F.col("id") != _NO_ID))
    unique = asked.groupBy("id", "label", "vector").agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.first("norm").cast("bigint").alias("norm"))
    anchors = materialize(unique.withColumn("width", F.size("vector")), "anchors")
    tiles = max(1, -(-anchors.count() // TILE))
    splits = min(SPLITS, max(1, -(-n_rows // SPLIT_ROWS)))
    bound = int(bound or 0)
    none = F.array().cast("array<bigint>").alias("positive_scores")
    found = _meet(anchors.select("*", none), rows, tiles, splits, _Positives, bound)
    copies = F.array_repeat(F.lit(0), F.least(F.col("copies") - 1, F.lit(POSITIVES)).cast("int"))
    again = anchors.select(F.col("row").alias("anchor"), F.col("norm").alias("score"), "id", F.explode(copies)).drop("col")
    positives = _best(found.union(again), ["anchor"], POSITIVES)
    known = anchors.join(positives, anchors["row"] == positives["anchor"]).drop("anchor")
    known = materialize(known.withColumn("positive_scores", F.transform("best", lambda entry: -entry["lost"])), "positives")
    negatives = _best(_meet(known, rows, tiles, splits, _Negatives, bound), ["anchor", "slot"], NEGATIVES)
    positive = F.get("best", F.col("slot").cast("int"))
    ranked = negatives.select(F.col("anchor").alias("row"), "slot", F.posexplode("best").alias("at", "negative"))
    answers = ranked.join(known.select("row", F.col("id").alias("anchor_id"), "best", "copies"), "row")
    return answers.select(
        "anchor_id",
        F.nullif(positive["id"], F.lit(_NO_ID)).alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.nullif(F.col("negative.id"), F.lit(_NO_ID)).alias("negative_id"),
        (-positive["lost"]).alias("positive_score"),
        (-F.col("negative.lost")).alias("negative_score"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth vector; every seventh id has a wrong label on purpose."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = ((F.col("label").cast("decimal(20,0)") + 1) % 10).cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("bigint"))
    return hard_negatives(vectors.withColumn("label", label), 100)


ORACLE_SQL = """
WITH named AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM named a JOIN named b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
