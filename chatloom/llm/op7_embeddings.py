"""Near-duplicate embeddings by lattice hashing.

Unit vectors are projected at random to blocks of eight dimensions, several times (tables), and each block is decoded
to the nearest point of the E8 lattice; a vector's cell in a table is that of all its blocks. A vector also probes the
neighbouring cells that its projection lies closest to, each with one block moved, so pairs near a border still meet.
Pairs that meet are verified by their cosine in double precision. Three blocks with wide cells keep near vectors
together as one block with narrow cells does, and far fewer that are not near.

Equal vectors are one class with a multiplicity. Members of a cell come to one task as blocks: a
cell of many members is cut into groups, and every pair of groups is a task of its own, so no task's size follows
the cell's. A task compares its members by matrix products and returns a count per member and a spanning forest of
its links, never the pairs. A pair that meets several times is counted only where it meets first.

Defined results: null vectors, zero vectors, and those with null or non-finite components link with nothing; vectors
link only with those of their own length; equal vectors of another scale, however great or small, do link. A
null id is a row that links like others and is never a component's least id unless all are null. Rows that
repeat an id are separate rows. Labels and other columns are ignored.
"""

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import mix64, ragged, table
from chatloom.llm.components import components
from chatloom.session import materialize

MIN_COSINE = 0.95
TABLES = 11
BLOCKS = 3
SCALE = 0.6
#: Neighbouring cells that a vector probes in each table.
PROBES = 10
#: Members of a group of a cell; pairs of groups are compared at once.
GROUP = 256
#: Rows of cells that a task compares at once, and numbers held at once while it does.
RUN_ROWS = 8_192
CELLS = 1 << 20
SEED = 7


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0^6) in all places, and (+-1/2)^8 with an even number of minus."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            row = np.zeros(8)
            row[i], row[j] = a, b
            out.append(row)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out)


ROOTS = roots()


def _even(points: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    near = np.rint(points)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    gap = points[odd] - near[odd]
    worst = np.abs(gap).argmax(axis=1)
    near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode(points: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row: of the even integer points and those moved by a half."""
    whole, half = _even(points), _even(points - 0.5) + 0.5
    closer = ((points - half) ** 2).sum(axis=1) < ((points - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def _point_codes(points: np.ndarray, block: np.ndarray) -> np.ndarray:
    """A 64-bit name of each lattice point (rows of eight coordinates) in its block."""
    out = block.astype(np.uint64) + np.uint64(1)
    for k in range(8):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + (2 * points[:, k]).astype(np.int64).view(np.uint64))
    return out


@functools.lru_cache(8)
def planes(size: int, tables: int, blocks: int, scale: float, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each table the projection of vectors of one length, and the shift of the lattice."""
    rng = np.random.default_rng(seed)
    return [(rng.standard_normal((size, 8 * blocks)) * scale, rng.uniform(0, 1, 8 * blocks)) for _ in range(tables)]


def table_codes(units: np.ndarray, t: int, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """For each unit vector the names of its cells in table ``t``: (rows, 1 + probes), its own first."""
    plane, shift = planes(units.shape[1], tables, blocks, scale, seed)[t]
    moved = (units @ plane + shift).reshape(-1, 8)
    points, block = decode(moved), np.tile(np.arange(blocks), len(units))
    names = _point_codes(points, block)
    # Vectors of different lengths never share a cell.
    total = names.reshape(-1, blocks).sum(axis=1) + mix64(np.array([t + (units.shape[1] << 20)], np.uint64))
    out = np.empty((len(units), 1 + probes), np.uint64)
    out[:, 0] = total
    if probes:
        toward = ((moved - points) @ ROOTS.T).reshape(len(units), -1)
        best = np.argpartition(-toward, probes - 1, axis=1)[:, :probes]
        for k in range(probes):
            at = np.arange(len(units)) * blocks + best[:, k] // len(ROOTS)
            beside = points[at] + ROOTS[best[:, k] % len(ROOTS)]
            out[:, 1 + k] = total - names[at] + _point_codes(beside, block[at])
    return mix64(out).view(np.int64)


def codes(units: np.ndarray, tables: int = TABLES, **how) -> np.ndarray:
    """The cells in every table: (rows, tables, 1 + probes)."""
    return np.stack([table_codes(units, t, tables, **how) for t in range(tables)], axis=1)


def _unit(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    # No square is too great or too small for a float then.
    rows = rows / np.abs(rows).max(axis=1, initial=0)[:, None]
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def entries(classes: DataFrame, **how) -> DataFrame:
    """``cls, code, own``: the cells of each class, its own and those that it probes."""

    def work(batches):
        for batch in batches:
            for part in _by_length(batch, 2_000):
                found = codes(_unit(part.column("vector")), **how)
                each = found.shape[1] * found.shape[2]
                own = np.zeros(found.shape, bool)
                own[:, :, 0] = True
                cls = np.repeat(part.column("cls").to_numpy(), each)
                columns = [pa.array(cls), pa.array(found.ravel()), pa.array(own.ravel())]
                yield pa.RecordBatch.from_arrays(columns, names=["cls", "code", "own"])

    return classes.select("cls", "vector").mapInArrow(work, "cls long, code long, own boolean")


def _by_length(batch: pa.RecordBatch, most: int):
    """Parts of at most ``most`` rows whose vectors have one length."""
    lengths = np.diff(batch.column("vector").offsets.to_numpy())
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for at in range(0, len(places), most):
            yield batch.take(pa.array(places[at : at + most]))


def first_meeting(units, a, b, code, tables: int = TABLES, **how) -> np.ndarray:
    """Whether each pair (rows ``a`` and ``b`` of ``units``) is counted at its ``code``: in the first table where either
    probes the other's own cell, at the lesser of such cells. Cells of later tables are only found for pairs that
    have not met yet."""
    here, left, top = np.zeros(len(a), bool), np.arange(len(a)), np.iinfo(np.int64).max
    for t in range(tables):
        if not len(left):
            break
        used, place = np.unique(np.concatenate((a[left], b[left])), return_inverse=True)
        cells, (x, y) = table_codes(units[used], t, tables, **how), place.reshape(2, -1)
        own = cells[:, 0]
        at_a, at_b = np.zeros(len(left), bool), np.zeros(len(left), bool)
        for k in range(cells.shape[1]):
            at_a |= own[x] == cells[y, k]
            at_b |= own[y] == cells[x, k]
        met = at_a | at_b
        first = np.minimum(np.where(at_a, own[x], top), np.where(at_b, own[y], top))
        here[left[met]] = first[met] == code[left[met]]
        left = left[~met]
    return here


def near_pairs(units, own, group, alone, edges, min_cosine):
    """Pairs of rows, the first before the second, of the same run between ``edges`` with this cosine, one of them in its
    own cell, and of different groups unless the run is one group (``alone``). Runs of one size are compared together."""
    sizes, out = np.diff(edges), []
    for size in np.unique(sizes[sizes > 1]).tolist():
        starts = edges[:-1][sizes == size]
        a, b = np.triu_indices(size, 1)
        step = max(1, CELLS // size**2)
        for at in range(0, len(starts), step):
            rows = starts[at : at + step, None] + np.arange(size)
            part = units[rows]
            cosines = (part @ part.transpose(0, 2, 1))[:, a, b]
            run, pair = np.nonzero(cosines >= min_cosine)
            x, y = rows[run, a[pair]], rows[run, b[pair]]
            fits = (own[x] | own[y]) & (alone[x] | (group[x] != group[y]))
            out.append(np.stack([x[fits], y[fits]]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least that it reaches by the links ``a, b``."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def compare(part: pa.Table, edges, min_cosine, how):
    """Links among the members of whole pairs of groups, whose rows lie between ``edges``: classes, the weight that
    each is linked to (pairs counted here only), and the least class here that each reaches."""
    own, group, code = (part.column(k).to_numpy() for k in ("own", "group", "code"))
    alone = part.column("i").to_numpy() == part.column("j").to_numpy()
    units = _unit(part.column("vector").combine_chunks())
    a, b = near_pairs(units, own, group, alone, edges, min_cosine)
    # A class can be in several of the cells.
    cls, first, place = np.unique(part.column("cls").to_numpy(), return_index=True, return_inverse=True)
    weights, units = part.column("times").to_numpy()[first], units[first]
    counts, x, y = np.zeros(len(cls), np.int64), place[a], place[b]
    for at in range(0, len(a), CELLS):
        to = slice(at, at + CELLS)
        here = np.flatnonzero(first_meeting(units, x[to], y[to], code[a[to]], **how)) + at
        np.add.at(counts, x[here], weights[y[here]])
        np.add.at(counts, y[here], weights[x[here]])
    root = least_reached(len(cls), x, y)
    kept = np.flatnonzero((counts > 0) | (root != np.arange(len(root))))
    return cls[kept], counts[kept], cls[root[kept]]


def _whole_runs(batches, keys, rows: int):
    """Parts of about ``rows`` rows of sorted input that cut no run of equal ``keys``, and the edges of their runs."""
    held, n = [], 0

    def take(last):
        part = pa.Table.from_batches(held).combine_chunks()
        keyed = np.stack([part.column(k).to_numpy() for k in keys])
        edges = np.concatenate(([0], np.flatnonzero((keyed[:, 1:] != keyed[:, :-1]).any(axis=0)) + 1, [len(part)]))
        # The last run may go on in the next batch.
        if not last:
            edges = edges[:-1]
        return part, edges

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            part, edges = take(False)
            if edges[-1]:
                yield part.slice(0, edges[-1]), edges
            held = part.slice(edges[-1]).to_batches()
            n = len(part) - int(edges[-1])
    if n:
        yield take(True)


def links(classes: DataFrame, min_cosine: float, group: int, **how) -> DataFrame:
    """``cls, links, root``: parts of each class's number of links, and links that make its component."""
    cells = materialize(entries(classes, **how), "cells")
    met = cells.groupBy("code").agg(F.count("*").alias("n"), F.max("own").alias("any_own"))
    met = materialize(met.where("n > 1 and any_own").select("code", "n"), "met")
    parts = F.ceil(F.col("n") / group).cast("int")
    live = cells.join(met, "code").withColumn("parts", parts)
    live = live.withColumn("group", F.pmod(F.xxhash64("cls", "code"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    live = live.withColumn("other", other)
    live = live.select("cls", "code", "own", "group", F.least("group", "other").alias("i"), F.greatest("group", "other").alias("j"))
    live = materialize(live, "live")
    rows = live.join(classes.select("cls", "vector", "times"), "cls")

    def work(batches):
        for part, edges in _whole_runs(batches, ["code", "i", "j"], RUN_ROWS):
            lengths = np.diff(part.column("vector").combine_chunks().offsets.to_numpy())
            # A cell's vectors have one length.
            for length in np.unique(lengths[edges[:-1]]):
                chosen = np.flatnonzero(lengths[edges[:-1]] == length)
                sizes = np.diff(edges)[chosen]
                rows = ragged(edges[chosen], sizes)
                alike = part if len(rows) == len(part) else part.take(pa.array(rows))
                columns = map(pa.array, compare(alike, np.append(0, np.cumsum(sizes)), min_cosine, how))
                yield pa.RecordBatch.from_arrays([*columns], names=["cls", "links", "root"])

    dealt = rows.repartition("code", "i", "j").sortWithinPartitions("code", "i", "j")
    return dealt.mapInArrow(work, "cls long, links long, root long")


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    min_cosine: float = MIN_COSINE,
    group: int = GROUP,
    tables: int = TABLES,
    scale: float = SCALE,
    probes: int = PROBES,
    blocks: int = BLOCKS,
) -> DataFrame:
    """Per row: ``id, n_links, component``."""
    given = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.size("vector") > 0
    sound = F.coalesce(sound & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0), F.lit(False))
    # Minus zero and zero are one value.
    vector = F.when(sound, F.transform("vector", lambda x: x + F.lit(0.0)))
    given = given.select("id", vector.alias("vector"))
    classes = given.where("vector is not null").groupBy("vector").agg(F.min("id").alias("first"), F.count("*").alias("times"))
    # Numbers are fixed by being stored.
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    found = materialize(links(classes, min_cosine, group, tables=tables, blocks=blocks, scale=scale, probes=probes), "links")
    counted = found.groupBy("cls").agg(F.sum("links").alias("links"))
    reached = components(found, "cls", "root").select(F.col("node").alias("cls"), F.col("component").alias("root"))
    labels = classes.join(reached, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    labels = materialize(labels.select("cls", "root", "first"), "roots")
    least = materialize(labels.groupBy("root").agg(F.min("first").alias("component")), "least")
    named = classes.join(labels.select("cls", "root"), "cls").join(least, "root").join(counted, "cls", "left")
    total = F.col("times") - 1 + F.coalesce("links", F.lit(0))
    named = materialize(named.select(F.col("vector").alias("_vector"), total.alias("total"), "component"), "named")
    joined = given.join(named, F.col("vector") == F.col("_vector"), "left")
    return joined.select(
        "id",
        F.coalesce("total", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_vector").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its links, its component, and whether it is the component's first."""
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").cast("long").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
