"""Cutting hot join keys into pieces, so that no task gets a large share of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = "_piece"
_PIECES = "_pieces"

# After cutting, no (key, piece) has more than one in this many rows. It also bounds the hot keys.
MAX_PIECES = 1000

# Pieces of every key where rows cannot be counted first, as on a stream.
BLIND_PIECES = 8


def hot_keys(counts: DataFrame, key: str) -> DataFrame:
    """The keys of ``counts(key, n)`` with over 1/``MAX_PIECES`` of all rows, and their pieces.

    Fewer than ``MAX_PIECES`` keys can have such a share, so the result is small by construction.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(total / MAX_PIECES, 1.0)
    pieces = F.ceil(F.col("n") / share).cast("int").alias(_PIECES)
    hot = counts.where(F.col("n") > share).select(key, pieces)
    return counts.sparkSession.createDataFrame(hot.collect(), hot.schema)


def cut_rows(rows: DataFrame, key: str, hot: DataFrame | None, by: Column) -> DataFrame:
    """``rows`` with the piece of each: the hash ``by`` modulo the pieces of its key."""
    return _with_pieces(rows, key, hot).select(
        *rows.columns, F.pmod(by, F.col(_PIECES)).cast("int").alias(PIECE)
    )


def copy_keys(keys: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """``keys`` with one row per piece, to join with :func:`cut_rows` on the key and the piece."""
    numbers = F.sequence(F.lit(0), F.col(_PIECES) - 1)
    return _with_pieces(keys, key, hot).select(*keys.columns, F.explode(numbers).alias(PIECE))


def _with_pieces(frame: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    if hot is None:
        return frame.withColumn(_PIECES, F.lit(BLIND_PIECES))
    joined = frame.join(F.broadcast(hot), key, "left")
    return joined.withColumn(_PIECES, F.coalesce(_PIECES, F.lit(1)))
