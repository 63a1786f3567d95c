"""SimHash near-duplicates by multi-index hashing.

A text's words give shingles, each shingle a 64-bit hash, and a fingerprint bit is set if it is set in over
half of the hashes. Fingerprints within ``max_bits`` of each other are linked.

A fingerprint has two halves of 32 bits. If two differ in at most 4 bits, they differ in at most 2 bits of
the high half or in at most 1 of the low half. So each fingerprint is put into tables under every value
within one bit of its high half, and of its low half; two that are at most 2 bits apart in the high half
meet at a value between them, two that are at most 1 apart in the low half meet at either's own. Those
that meet are verified by their complete distance. Equal fingerprints are one entry of the tables, so
groups of copies cost nothing.

A table value at which many fingerprints meet is not compared pair by pair. Its fingerprints instead
join the points of the whole 64-bit space within half of ``max_bits`` of them: two fingerprints share
such a point if and only if they are linked, so linking each with the least one at the point loses
nothing and adds nothing. This costs a fixed number of rows per fingerprint, whatever the group.

Links become components by rounds of star contraction (``components``).

Defined results: null and empty texts have no words and the fingerprint zero, linked like any other.
A text of fewer words than a shingle has one shingle of all its words. Repeated ids are separate rows; they
get the component of their least id. A null id takes part; it counts as smaller than no other and
gets a null component only where its component has no other id. Other columns are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import table, text_chunks
from chatloom.llm.components import components
from chatloom.session import materialize

SHINGLE = 4
MAX_BITS = 4
#: Bits that may differ in the high half; one less in the low half.
HIGH_BITS = 2
SEED = 42
#: Fingerprints that may meet at a table value and still be compared pair by pair.
MEET = 256
#: Hashes whose bits are counted at once.
BLOCK = 1 << 14


def hashes(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle, repeats included, and the offsets of each text's."""
    out, counts, digest = [], [], xxhash.xxh64_intdigest
    for text in texts:
        # bytes.lower() and bytes.split() know just the letters and blanks of ASCII.
        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not parts:
            counts.append(0)
            continue
        if len(parts) <= words:
            out.append(digest(b" ".join(parts), SEED))
            counts.append(1)
            continue
        joined = memoryview(b" ".join(parts))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        begins = np.concatenate(([0], ends[:-1]))
        spans = zip(begins[: len(parts) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist())
        found = [digest(joined[a:b], SEED) for a, b in spans]
        out += found
        counts.append(len(found))
    return np.array(out, np.uint64), np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def majority(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits set in over half of it."""
    ones = np.zeros((len(offsets) - 1, 64), np.int64)
    for at in range(0, len(values), BLOCK):
        part = values[at : at + BLOCK]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        inside = np.clip(offsets - at, 0, len(part))
        rows = np.flatnonzero(np.diff(inside))
        ones[rows] += np.add.reduceat(bits, inside[rows], axis=0, dtype=np.int64)
    bits = ones * 2 > np.diff(offsets)[:, None]
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """``id, whole, fp`` of each row: its id, a hash of its text, and the fingerprint (as a signed long)."""
    text = F.col(text_col)
    given = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("whole"), text.alias("text"))
    kind = given.schema["id"].dataType.simpleString()

    def work(batches):
        for part in text_chunks(batches, "text"):
            prints = majority(*hashes(part.column("text").to_pylist(), words)).view(np.int64)
            columns = [part.column("id"), part.column("whole"), pa.array(prints)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "whole", "fp"])

    return given.mapInArrow(work, f"id {kind}, whole long, fp long")


def _table_points(half: Column, number: int) -> Column:
    """Where a half is put in table ``number``: its own value, then each value one bit from it."""
    flipped = [half.bitwiseXOR(F.lit(1 << k)) for k in range(32)]
    return F.array(*[F.shiftleft(F.lit(number), 32).bitwiseOR(x) for x in (half, *flipped)])


def ball(bits: int, radius: int) -> list[int]:
    """All patterns of at most ``radius`` of ``bits`` bits, as signed longs."""
    out = []
    for size in range(radius + 1):
        for places in combinations(range(bits), size):
            value = sum(1 << p for p in places)
            out.append(value - (1 << 64) if value >= 1 << 63 else value)
    return out


def links(prints: DataFrame, max_bits: int = MAX_BITS, meet: int = MEET) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (column ``fp``, without repeats) whose components are those
    of all links. Of a group that meets at one table value, at most ``meet`` are compared pair by pair."""
    if max_bits != 2 * HIGH_BITS:
        raise ValueError("the two tables are made for at most 4 bits")
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    points = prints.select("fp", F.posexplode(F.concat(_table_points(high, 0), _table_points(low, 1))).alias("place", "point"))
    points = points.select("fp", "point", (F.col("place") % 33 - 1).alias("bit"))
    met = materialize(points.groupBy("point").agg(F.count("*").alias("n")).where("n > 1"), "met")
    # Spark sizes exploded rows like those before the explode and would broadcast them: they are always shuffled.
    found = materialize(points.hint("merge").join(met, "point"), "candidates")
    few = found.where(F.col("n") <= meet)
    a = few.select("point", F.col("fp").alias("a"), F.col("bit").alias("bit_a"))
    b = few.select(F.col("point").alias("at"), F.col("fp").alias("b"), F.col("bit").alias("bit_b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    in_low = F.shiftright("point", 32) == 1
    # Each pair meets at one chosen point: at a's own half, or half way with a's bit the lower one.
    own = (F.col("bit_a") < 0) & ((F.col("bit_b") >= 0) | (F.col("a") < F.col("b")))
    half_way = (F.col("bit_a") >= 0) & (F.col("bit_b") > F.col("bit_a")) & ~in_low
    # Pairs near in the high half are left to the first table.
    far_high = F.bit_count(F.shiftrightunsigned(differ, 32)) > HIGH_BITS
    same = (F.col("point") == F.col("at")) & (F.col("a") != F.col("b")) & (F.bit_count(differ) <= max_bits)
    near = a.hint("merge").join(b, same & (own | half_way) & (~in_low | far_high)).select("a", "b")
    dense = found.where(F.col("n") > meet).select("fp").distinct()
    if dense.isEmpty():
        return near
    masks = F.array(*[F.lit(m) for m in ball(64, max_bits // 2)])
    spread = dense.select("fp", F.explode(masks).alias("mask"))
    spread = spread.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))
    least = spread.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = spread.hint("merge").join(materialize(least.select("point", "b"), "stars"), "point")
    return near.union(stars.where("fp <> b").select(F.col("fp").alias("a"), "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``id, whole, fp, root, component`` for each row: its id, a hash of its text, its fingerprint, the least
    fingerprint and the least id that links reach."""
    rows = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")), "distinct")
    grouped = components(links(distinct.select("fp"), max_bits), "a", "b")
    rooted = distinct.join(grouped, distinct["fp"] == grouped["node"], "left")
    rooted = rooted.select("fp", "id", F.coalesce("component", "fp").alias("root"))
    # Only fingerprints with links share a root with others.
    rooted = materialize(rooted, "rooted")
    first = materialize(rooted.groupBy("root").agg(F.min("id").alias("component")), "first")
    labels = materialize(rooted.join(first, "root").select("fp", "root", "component"), "labels")
    return rows.join(labels, "fp").select("id", "whole", "fp", "root", "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint in hex and its component."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component, the row with the least id, nulls last. Of rows that repeat this id,
    the one with the least text hash stays, and one of those that repeat both."""
    found = near_duplicates(docs)
    alike = found.groupBy("root", "id", "whole").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "whole", "n")).alias("first")
    kept = alike.groupBy("root").agg(first)
    # A text has one fingerprint, so an id and a text hash are of one component.
    kept = kept.select(F.col("first.id").alias("id"), F.col("first.whole").alias("whole"), F.col("first.n").alias("n"))
    kept = materialize(kept, "kept")
    # As one column, the rows' columns may have any names.
    rows = docs.select(F.struct("*").alias("row"))
    named = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("whole")))
    result = named.where("n = 1").select("row.*")
    if not kept.where("n > 1").isEmpty():
        again = named.where("n > 1").dropDuplicates(["id", "whole"])
        result = result.union(again.select("row.*"))
    return result
