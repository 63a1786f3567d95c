"""Connected components of a graph of links by star contraction.

Each round points every node's larger neighbours at its least neighbour, then its smaller neighbours and
itself at the least of those; the graph keeps its components and ends as stars around each component's
least node. Rounds are logarithmic in the size of a component. Every round is a table in the shared
folder, so a lost executor costs no earlier round, and joins are between stored tables, which lets
adaptive execution split a node with very many links.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each ``u`` and its neighbours ``v``."""
    return materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``node, component`` for every node of a link; ``component`` is the least node that it reaches."""
    a, b = F.col(first), F.col(second)
    pairs = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs, before = materialize(pairs, "links"), None
    while (now := _state(pairs)) != before and now[0]:
        before = now
        # Both directions; the least neighbour of a node may be the node itself.
        both = materialize(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        joined = both.join(_least(both), "u").where("v > u")
        large = joined.select(F.col("v").alias("u"), F.least("m", F.col("u")).alias("v"))
        large = materialize(large.distinct(), "large")
        joined = large.join(_least(large), "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = materialize(small.where("u <> v").distinct(), "small")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
