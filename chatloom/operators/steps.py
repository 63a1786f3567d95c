"""The load that a run was under, from its records: steps of steady arrival with pauses between them."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.skew import PIECE, copy_keys, cut_rows, hot_keys
from ..session import materialize

MAX_BROADCAST = 1_000_000


def load_steps(records: DataFrame, keys: list[str], gap_ms: int, unit_s: int = 1, at: str = "arrived_at") -> DataFrame:
    """Per key its steps, numbered from 1: first and last arrival, records, and records per ``unit_s`` seconds.

    A step ends where no record comes for more than ``gap_ms``. The rate is null if all records of a step come at one
    instant. Records without a time belong to no step; null keys are keys.
    """
    return _steps(_numbered(records, keys, gap_ms, at), unit_s).select(
        *_named(keys), "step", F.col("_first").alias("started_at"), F.col("_last").alias("ended_at"), "n", "rate"
    )


def with_steps(
    records: DataFrame,
    keys: list[str],
    gap_ms: int,
    unit_s: int = 1,
    at: str = "arrived_at",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``records`` with the ``step`` that each belongs to, and as ``load`` the step's rate to the next whole number.

    Columns of these names are replaced. Both are null for records without a time.
    """
    cells = materialize(_numbered(records, keys, gap_ms, at), "steps")
    loads = _steps(cells, unit_s).select("_key", "step", F.round("rate").cast("bigint").alias("load"))
    cells = cells.join(loads, ["_key", "step"]).select(F.struct("_key", "_cell").alias("_place"), "step", "load")
    kept = [name for name in records.columns if name not in ("step", "load")]
    us = records.select("*", _micros(records, at, F.col(at)).alias("_us"))
    place = F.struct(_key(keys).alias("_key"), _floor("_us", gap_ms * 1000).alias("_cell"))
    placed = us.select(*kept, F.when(F.col("_us").isNotNull(), place).alias("_place"))
    if cells.count() <= max_broadcast:
        joined = placed.join(F.broadcast(cells), "_place", "left")
    else:
        hot = hot_keys(placed.groupBy("_place").agg(F.count(F.lit(1)).alias("n")), "_place")
        pieces = cut_rows(placed, "_place", hot, F.xxhash64(*kept))
        joined = pieces.join(copy_keys(cells, "_place", hot), ["_place", PIECE], "left")
    return joined.select(*kept, "step", "load")


def _numbered(records: DataFrame, keys: list[str], gap_ms: int, at: str) -> DataFrame:
    """The cells of ``gap_ms`` that hold records, each with its step.

    Records of one cell are never further apart than the gap, so only cells are ordered, not records. They are
    ordered in blocks, and each block is then told how many steps lie before it: neither the cells of a
    block nor the blocks of a key are more than the square root of all cells.
    """
    if gap_ms < 1:
        raise ValueError("gap_ms must be at least 1")
    gap = gap_ms * 1000
    timed = records.where(F.col(at).isNotNull())
    timed = timed.select(_key(keys).alias("_key"), F.col(at).alias("_at"), _micros(records, at, F.col(at)).alias("_us"))
    first, last = timed.agg(F.min("_us"), F.max("_us")).first()
    width = math.isqrt((last - first) // gap) + 1 if first is not None else 1
    cells = timed.groupBy("_key", _floor("_us", gap).alias("_cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.min("_us").alias("_lo"), F.max("_us").alias("_hi")
    )
    inside = Window.partitionBy("_key", "_block").orderBy("_cell")
    cells = cells.withColumn("_block", _floor("_cell", width))
    cells = cells.withColumn("_new", _begins(inside, gap)).withColumn("_within", F.sum("_new").over(inside))
    over = Window.partitionBy("_key").orderBy("_block")
    blocks = cells.groupBy("_key", "_block").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_new").alias("_news"))
    earlier = F.coalesce(F.sum("_news").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    borders = blocks.withColumn("_border", _begins(over, gap))
    borders = borders.select("_key", "_block", (F.sum("_border").over(over) + earlier).alias("_before"))
    joined = cells.join(borders, ["_key", "_block"])
    step = (F.col("_before") + F.col("_within") + 1).cast("bigint")
    return joined.select("_key", "_cell", "n", "_first", "_last", "_lo", "_hi", step.alias("step"))


def _steps(cells: DataFrame, unit_s: int) -> DataFrame:
    span = F.max("_hi") - F.min("_lo")
    rate = F.try_divide(F.sum("n") * F.lit(unit_s * 1_000_000.0), F.nullif(span, F.lit(0)))
    return cells.groupBy("_key", "step").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("n").alias("n"), F.round(rate, 6).alias("rate")
    )


def _begins(window, gap: int) -> Column:
    """1 where the row comes more than ``gap`` after the one before it; the first row begins nothing."""
    return F.when(F.col("_lo") - F.lag("_hi").over(window) > gap, 1).otherwise(0)


def _key(keys: list[str]) -> Column:
    # As a field of a struct a null key equals itself, in joins too.
    return F.struct(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keys)], F.lit(0).alias("one"))


def _named(keys: list[str]) -> list[Column]:
    return [F.col(f"_key.k{i}").alias(name) for i, name in enumerate(keys)]


def _floor(name: str, size: int) -> Column:
    return F.expr(f"({name} - pmod({name}, {size}L)) div {size}L")


def _micros(records: DataFrame, at: str, value: Column) -> Column:
    if isinstance(records.schema[at].dataType, T.TimestampNTZType):
        since = value - F.lit("1970-01-01").cast("timestamp_ntz")
        return (since.cast("decimal(20,6)") * 1_000_000).cast("bigint")
    return F.unix_micros(value)
