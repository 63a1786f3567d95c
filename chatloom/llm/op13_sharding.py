"""Sharding by minimax contiguous partition: shards of nearly equal bytes, equal texts together.

Equal texts form one group that is never cut. Groups stand in the order of their text digests, which depends
on nothing but the texts. The smallest capacity for which all groups fit in the given number of shards is found
by binary search; a capacity is checked greedily, each shard taking groups until the next does not fit. The
groups are then cut there. A group larger than the mean of what is left gets a shard of its own first, the
largest group before the others, so that one hot group does not set the capacity of all shards.

The search never sees all groups. It works on a bounded summary of blocks of neighbouring groups, which
tells for each capacity the least and the most that the greedy check can reach. What stays open lies near
the cuts, and only there blocks are counted again, finer, until they are single groups. Each pass returns a
number of rows that does not grow with the table, and a few passes are enough for any number of groups.

Groups with over a thousandth of the rows are dealt in pieces, so no task gets a hot group. All of it is
DataFrame functions.

Nulls and ties: a null text has no bytes, counts as the empty text and has its checksum; null ids and rows that
repeat are placed like others. Equal sizes are no tie, since the order of groups is that of their digests. Extra columns are ignored,
whatever their names. An empty table gives no rows; with fewer groups than shards the last shards are empty.
"""

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.skew import PIECE, copy_keys, cut_rows, hot_keys
from chatloom.llm.common import table
from chatloom.session import materialize

SHARDS = 40
#: Bytes that each row costs beside its text.
ROW_BYTES = 16
#: Blocks that a pass of the search aims at. Fewer than 4 * shards**2 would leave too much open, so there are
#: at least as many, which bounds the number of shards.
BLOCKS = 16384
MAX_SHARDS = 500
#: Ranges of digests in which positions are added up; their totals are added up over all ranges.
RANGES = 4096


class Summary:
    """Known ends of groups, in order, and whether a block between two of them is a single group."""

    def __init__(self, blocks: list[tuple[int, int, int]], total: int):
        self.total = total
        self.starts = [start for start, _, _ in blocks]
        self.ends = [end for _, end, _ in blocks]
        self.single = [n == 1 for _, _, n in blocks]

    def reach(self, least: int, most: int, capacity: int) -> tuple[int, int]:
        """Bounds on the last group end within ``capacity`` of a place between ``least`` and ``most``."""
        return self._before(least + capacity)[0], self._before(most + capacity)[1]

    def _before(self, place: int) -> tuple[int, int]:
        """Bounds on the last group end that is not after ``place``."""
        if place >= self.total:
            return self.total, self.total
        at = bisect_right(self.starts, place) - 1
        return self.starts[at], self.starts[at] if self.single[at] else place

    def cuts(self, shards: int, capacity: int) -> list[tuple[int, int]]:
        """Bounds on the end of each shard that is filled greedily up to ``capacity``."""
        out, least, most = [], 0, 0
        for _ in range(shards):
            least, most = self.reach(least, most, capacity)
            out.append((least, most))
        return out

    def smallest(self, shards: int, low: int, high: int, bound: int) -> int:
        """Binary search of the smallest capacity that may (``bound`` 1) or must (0) be enough."""
        while low < high:
            middle = (low + high) // 2
            if self.cuts(shards, middle)[-1][bound] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low


def _blocks(groups: DataFrame, windows: list[tuple[int, int]], blocks: int) -> list[tuple[int, int, int]]:
    """(start, end, number of groups) of blocks of neighbouring groups that start in ``windows``."""
    width = -(-sum(high - low + 1 for low, high in windows) // blocks)
    inside = F.lit(False)
    for low, high in windows:
        inside = inside | F.col("start").between(low, high)
    # Blocks do not cross windows, whose number is that of the cuts.
    window = sum((F.col("start") > high).cast("int") for _, high in windows)
    counted = (
        groups.where(inside)
        .groupBy(window.alias("window"), F.expr(f"start div {width}").alias("block"))
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"))
    )
    return sorted((row["start"], row["end"], row["n"]) for row in counted.collect())


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(windows):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def minimax_cuts(groups: DataFrame, shards: int, total: int, largest: int, blocks: int = BLOCKS) -> list[int]:
    """Where each of ``shards`` shards ends, for ``groups(start, end)`` that follow each other from 0 to ``total``.

    The largest shard is as small as it can be."""
    low, high = max(largest, -(-total // shards)), -(-total // shards) + largest
    windows, blocks = [(0, total)], max(blocks, 4 * shards**2)
    while True:
        summary = Summary(_blocks(groups, windows, blocks), total)
        low = summary.smallest(shards, low, high, 1)
        high = summary.smallest(shards, low, high, 0)
        first, last = summary.cuts(shards, low), summary.cuts(shards, high)
        if low == high and all(least == most for least, most in last):
            return [end for end, _ in last]
        # For every capacity that is still possible, a cut is between these two.
        windows = _merged([(a[0], b[1]) for a, b in zip(first, last)])


def _own_shards(counts: DataFrame, shards: int, total: int) -> list[str]:
    """Digests of the groups that are larger than the mean of what is left without the larger ones."""
    alone: list[str] = []
    for row in counts.orderBy(F.desc("size"), "digest").limit(shards).collect():
        left = shards - len(alone)
        if left == 1 or row["size"] * left <= total:
            break
        alone.append(row["digest"])
        total -= row["size"]
    return alone


def _up_to(amount: str, over: str) -> Column:
    """The sum of ``amount`` over the units before this one in its range."""
    order = Window.partitionBy("range").orderBy("digest", PIECE).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(order), F.lit(0)).alias(over)


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, size, text_crc32, shard and slot of each row, by the minimax partition of equal texts."""
    if not 0 < shards <= MAX_SHARDS:
        raise ValueError(f"from 1 to {MAX_SHARDS} shards")
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text).alias("crc"),
            F.sha2(text, 256).alias("digest"),
            # Tells equal rows apart.
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    counts = materialize(rows.groupBy("digest").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "shard-groups")
    total = counts.agg(F.sum("size")).first()[0]
    if total is None:
        return rows.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    alone = _own_shards(counts, shards, total)
    hot = hot_keys(counts.select("digest", "n"), "digest")
    # A unit is a group, or a piece of a hot one.
    dealt = cut_rows(rows, "digest", hot, F.xxhash64("row"))
    units = dealt.groupBy("digest", PIECE).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    own = F.array_position(F.lit(alone), F.col("digest")) if alone else F.lit(0)
    spread = F.expr(f"cast(conv(substr(digest, 1, 8), 16, 10) as bigint) * {RANGES} div {1 << 32}")
    placed = units.select("*", (own - 1).cast("int").alias("own"), spread.cast("int").alias("range"))
    group = Window.partitionBy("range", "digest")
    # Groups with a shard of their own take no room among the others.
    common = [F.when(F.col("own") < 0, F.col(name)).otherwise(0).alias(f"{name}_here") for name in ("n", "size")]
    summed = materialize(
        placed.select("*", *common).select(
            "*",
            _up_to("size_here", "size_before"),
            _up_to("n_here", "n_before"),
            F.sum("n").over(group.orderBy(PIECE)).alias("n_within"),
            F.sum("size").over(group).alias("size_whole"),
            F.row_number().over(group.orderBy(PIECE)).alias("piece_rank"),
        ).withColumn("size_before", F.min("size_before").over(group)),
        "shard-units",
    )
    # One row per range at most, so adding up over ranges is bounded.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = summed.groupBy("range").agg(F.sum("size_here").alias("s"), F.sum("n_here").alias("n"))
    offsets = ranges.select(
        "range", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("size_offset"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_offset")
    )
    units = summed.join(F.broadcast(offsets), "range").select(
        "digest",
        PIECE,
        "own",
        (F.col("size_before") + F.col("size_offset")).alias("start"),
        (F.col("n_before") + F.col("n_offset")).alias("first_row"),
        (F.col("n_within") - F.col("n")).alias("first_within"),
        "size_whole",
        "piece_rank",
    )
    units = materialize(units, "shard-places")
    groups = units.where("own < 0 and piece_rank = 1").select("start", (F.col("start") + F.col("size_whole")).alias("end"), "size_whole")
    rest, largest = groups.agg(F.max("end"), F.max("size_whole")).first()
    cuts = minimax_cuts(groups, shards - len(alone), rest, largest) if rest else []
    number = sum(((F.col("start") >= cut).cast("int") for cut in cuts[:-1]), F.lit(0))
    numbered = units.select(
        "digest", PIECE, "first_row", "first_within", F.when(F.col("own") >= 0, F.col("own")).otherwise(number + len(alone)).alias("shard"), (F.col("own") >= 0).alias("alone")
    )
    numbered = materialize(numbered, "shard-numbers")
    # One row per shard.
    firsts = numbered.where("not alone").groupBy("shard").agg(F.min("first_row").alias("shard_first"))
    where = numbered.join(F.broadcast(firsts), "shard", "left").select(
        "digest", PIECE, "shard", F.when(F.col("alone"), F.col("first_within")).otherwise(F.col("first_row") - F.col("shard_first")).alias("first")
    )
    joined = dealt.join(where, ["digest", PIECE])
    rank = F.row_number().over(Window.partitionBy("digest", PIECE).orderBy("id", "row"))
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("first") + rank - 1).cast("bigint").alias("slot"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 40, by bytes, and its slot there."""
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
