"""Reading tables, and Arrow texts as flat arrays."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; one longer text is taken alone.
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``frame`` has it in any case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_bucket(ids: Column, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n``."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % n


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text or binary column as its bytes and the n+1 offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if column.null_count:
        raise ValueError("a null is left")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and len(held) else np.zeros(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return data[first:last], (offsets - first if len(offsets) else np.zeros(1, np.int64))


def text_chunks(batches, text_col: str, limit: int = CHUNK_BYTES):
    """Cuts Arrow batches so that a piece has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of each run, one run after another."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``; runs may be empty."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads an array of 64-bit values; a fixed public finalizer (splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SortedKeys:
    """Finds 64-bit hashes among sorted keys; the leading bits of a hash say where to look."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        bits = max(8, int(len(keys)).bit_length() + 3)
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.append(np.searchsorted(self.keys, edges), len(keys)).astype(np.int32)
        self.most = int(np.diff(self.first).max(initial=0))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash in the keys as given, or -1."""
        shape, hashes = hashes.shape, hashes.ravel()
        slot = (hashes >> self.shift).astype(np.int64)
        low, high = self.first[slot], self.first[slot + 1]
        out = np.full(len(hashes), -1, np.int32)
        live = np.flatnonzero(high > low)
        for _ in range(self.most):
            at = low[live]
            hit = self.keys[at] == hashes[live]
            out[live[hit]] = self.order[at[hit]]
            low[live] += 1
            live = live[~hit & (at + 1 < high[live])]
        return out.reshape(shape)


def word_bytes() -> np.ndarray:
    """For each byte, itself in lower case (A-Z only) if it belongs to a word, else 0. Words are runs of
    digits, letters and non-ASCII bytes."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[65:91] = keep[128:] = True
    return np.where(keep, out, 0).astype(np.uint8)


WORD_BYTES = word_bytes()


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts in ``data``: 64-bit hashes, starts and ends in bytes, and offsets by text."""
    clean = WORD_BYTES[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = clean > 0
    first = inside[1:-1] & ~inside[:-2]
    edge = offsets[:-1][np.diff(offsets) > 0]
    first[edge] = inside[1:-1][edge]
    starts = np.flatnonzero(first)
    # A word ends before the next gap or at the end of its text.
    stop = inside[1:-1] & ~inside[2:]
    stop[offsets[1:][np.diff(offsets) > 0] - 1] = inside[1:-1][offsets[1:][np.diff(offsets) > 0] - 1]
    ends = np.flatnonzero(stop) + 1
    # Each byte is mixed with its place in the word; a word's hash is the sum.
    held = np.flatnonzero(clean)
    place = held - np.repeat(starts, ends - starts)
    mixed = mix64(clean[held].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)))
    return mix64(np.add.reduceat(mixed, np.cumsum(ends - starts) - (ends - starts))) if len(starts) else mixed, starts, ends, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(out)])
    return out
