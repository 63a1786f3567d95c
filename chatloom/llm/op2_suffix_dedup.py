"""Exact substring deduplication with suffix arrays.

A byte is removed if a string of ``min_bytes`` bytes that covers it also starts earlier, in a document with a
smaller id or before in the same document. Matches lie within documents; all strings are judged on the input.

Suffixes of a whole corpus do not fit a task, so strings that could be equal are brought together first. Each
string (window) has an anchor, the least hash among its k-grams, which depends on the window alone. Anchors
that occur once in the corpus have no equal windows. Consecutive windows with one anchor are a segment; of
segments with equal content the first is kept and all windows of the others are repeats. What is left are the
different segments of an anchor. They are dealt out by anchor, and in each block a suffix array and its
Burrows-Wheeler transform are built; from the interval of the empty string, intervals are extended backwards
breadth-first, each level setting the common prefix lengths of its value, up to ``min_bytes``. Neighbours whose
common prefix is still open then share ``min_bytes`` bytes, and in such a group all windows but the first are
repeats. The segments of an
anchor with very many of them are not one block: they are cut into shorter ones, each with the bytes that all its windows
share as a new anchor, and go through the same steps; at last each window is its own anchor. So no block grows with the corpus.

Documents are keyed by a hash of id and text. Their packed texts are dealt out by that key once, in
a checkpoint that keeps the partitioning, so the three reads of texts need no further shuffle.

Defined results: null is empty text: 0 bytes, nothing removed, the hash of no bytes. A null id comes before all
others. Rows that repeat id and text are one document, and each of the rows gets its result. Rows that share an id
but not the text come in the order of their text's hash. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import flat_bytes, mix64, ragged, table, text_chunks
from chatloom.session import materialize, scratch_dir

MIN_BYTES = 100
#: Bytes of the k-grams that anchors are chosen from.
GRAM = 32
#: Different segments that an anchor may have in one block.
MEET = 512
#: Windows of a segment of an anchor with more than that, once it is cut finer.
WIDTH = 16
#: Bytes of a block: its arrays fit a core's cache.
BLOCK = 128 << 10
#: Bytes of text whose anchors are found at once, for the same reason.
CHUNK = 256 << 10
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = mix64(np.arange(256, dtype=np.uint64) + np.uint64(77))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive bytes, for a power of two."""
    out, width, power = SPREAD[data], 1, np.array([BASE])
    while width < size:
        out = out[:-width] * power + out[width:] if len(out) > width else out[:0]
        width, power = 2 * width, power * power
    return mix64(out)


def segments(data: np.ndarray, offsets: np.ndarray, min_bytes: int = MIN_BYTES):
    """Runs of windows with one anchor: (text, first window, number of windows, anchor)."""
    wide = min_bytes - GRAM + 1
    grams = rolling(data, GRAM)
    least, width = grams, 1
    while width * 2 <= wide and len(least) > width:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = wide - width
    least = (np.minimum(least[:-rest], least[rest:]) if rest else least) if len(least) > rest else least[:0]
    sizes = np.diff(offsets) - min_bytes + 1
    rows = np.flatnonzero(sizes > 0)
    if not len(rows) or not len(least):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    windows = ragged(offsets[rows], sizes[rows])
    row = np.repeat(rows, sizes[rows])
    value = least[windows]
    # A run ends where the anchor's hash changes, or where the anchor is the window's first k-gram.
    new = np.ones(len(windows), bool)
    new[1:] = (value[1:] != value[:-1]) | (grams[windows[:-1]] == value[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], windows[at] - offsets[row[at]], np.diff(np.append(at, len(windows))), value[at].view(np.int64)


def content_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each span of ``data``."""
    powers = np.empty(len(data) + 1, np.uint64)
    powers[0] = 1
    powers[1:] = BASE
    powers = np.cumprod(powers)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(SPREAD[data] * powers[:-1], out=total[1:])
    # Spans are moved to one common power, so that equal bytes give equal values anywhere.
    inverse = np.full(len(data) + 1, pow(int(BASE), -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    return mix64((total[starts + sizes] - total[starts]) * inverse[starts] + mix64(sizes.astype(np.uint64))).view(np.int64)


# The suffix array of a block and the expansion of its intervals.


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first ``depth`` symbols or more. Symbols have 15 bits."""
    n, width = len(text), 4
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= 15
        key[: max(0, n - k)] |= text[k:]
    rank, order, slots = np.zeros(n, np.int64), np.arange(n), np.arange(n)
    while True:
        # Only suffixes that are not told apart yet are sorted further; they stay within the slots of their group.
        rows = order[slots]
        sub = np.argsort(key)
        rows, key = rows[sub], key[sub]
        order[slots] = rows
        fresh = np.ones(len(rows) + 1, bool)
        fresh[1:-1] = key[1:] != key[:-1]
        rank[rows] = slots[fresh[:-1]][np.cumsum(fresh[:-1]) - 1]
        slots = slots[~(fresh[:-1] & fresh[1:])]
        if width >= depth or not len(slots) or width >= n:
            return order
        rows = order[slots]
        later = np.minimum(rows + width, n - 1)
        key = rank[rows] * (n + 1) + np.where(rows + width < n, rank[later] + 1, 0)
        width *= 2


def open_prefixes(text: np.ndarray, order: np.ndarray, stop: int) -> np.ndarray:
    """Whether each suffix has ``stop`` symbols or more in common with the one before it in ``order``.

    The last symbol occurs once, so that the text can be read as a circle.
    """
    n = len(text)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    # The transform as a map: where the suffix stands that has one more symbol in front.
    to = place[order - 1]
    before = text[order - 1]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    # By place: the interval and the symbol that led there last, as one number.
    led, stamp = np.full(n + 2, -1, np.int64), 0
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(stop):
        if not len(low):
            break
        sizes = high - low + 1
        rows = ragged(low, sizes)
        mine = np.repeat(np.arange(stamp, stamp + len(low)) << 24, sizes) + before[rows]
        stamp += len(low)
        target = to[rows]
        led[target + 1] = mine
        # Rows of one interval with one symbol before them are neighbours again: the extended interval.
        low, high = np.sort(target[led[target] != mine]), np.sort(target[led[target + 2] != mine])
        # Where the end of an interval is new, its common prefix has this level's length.
        new = ~known[high + 1]
        known[high[new] + 1] = True
        low, high = low[new], high[new]
    return ~known[:n]


def repeated_windows(texts: list[bytes], min_bytes: int = MIN_BYTES) -> np.ndarray:
    """For the segments of a block, in their order of precedence: which windows (one after another, segment
    by segment) also stand in an earlier segment or earlier in their own."""
    sizes = np.array([len(t) for t in texts])
    windows = np.maximum(sizes - min_bytes + 1, 0)
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
    text = np.empty(offsets[-1], np.int64)
    text[ragged(offsets[:-1], sizes)] = np.frombuffer(b"".join(texts), np.uint8)
    text[offsets[1:] - 1] = 256 + np.arange(len(texts))
    order = sorted_suffixes(text, min_bytes)
    same = open_prefixes(text, order, min_bytes)
    group = np.cumsum(~same)
    # Texts stand in the order of precedence, so the least start of a group is the first.
    least = np.full(group[-1] + 1, len(text))
    np.minimum.at(least, group, order)
    repeat = np.zeros(len(text), bool)
    repeat[order] = order > least[group]
    return repeat[ragged(offsets[:-1], windows)]


# Spark.


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string"), text).alias("key"), text.alias("text"))


def _anchors(keyed: DataFrame, min_bytes: int) -> DataFrame:
    """``key, anchor``, as often as it occurs."""

    def work(batches):
        for part in text_chunks(batches, "text", CHUNK):
            data, offsets = flat_bytes(part.column("text"))
            row, _, _, value = segments(data, offsets, min_bytes)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=part.num_rows))))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value))
            yield pa.RecordBatch.from_arrays([part.column("key"), lists], names=["key", "anchors"])

    rows = keyed.select("key", "text").mapInArrow(work, "key long, anchors array<long>")
    return rows.select("key", F.explode("anchors").alias("anchor"))


def _packed(keyed: DataFrame) -> DataFrame:
    """The documents with their texts compressed."""
    kind = keyed.schema["id"].dataType.simpleString()

    def work(batches):
        press = zstandard.ZstdCompressor(level=3)
        for part in text_chunks(batches, "text"):
            packed = [press.compress(t.as_buffer()) for t in part.column("text").cast(pa.binary())]
            columns = [part.column("id"), part.column("key"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "packed"])

    return keyed.mapInArrow(work, f"id {kind}, key long, packed binary")


def _unpacked(part: pa.RecordBatch) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(p) if p else b"" for p in part.column("packed").to_pylist()]


def _small(batches, limit: int = 500):
    for batch in batches:
        for at in range(0, batch.num_rows, limit):
            yield batch.slice(at, limit)


def _segments(stored: DataFrame, min_bytes: int) -> DataFrame:
    """The segments with a repeated anchor: ``id, key, at, n, anchor, content``."""
    kind = stored.schema["id"].dataType.simpleString()

    def work(batches):
        # Packed texts are about a quarter as long.
        for part in text_chunks(batches, "packed", CHUNK // 4):
            texts = _unpacked(part)
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            row, at, n, value = segments(data, offsets, min_bytes)
            # Each document lists all its repeated anchors, so one list serves them together.
            wanted = np.unique(part.column("anchors").flatten().to_numpy(zero_copy_only=False))
            kept = np.isin(value, wanted)
            row, at, n, value = row[kept], at[kept], n[kept], value[kept]
            own = pa.array(row)
            content = content_hashes(data, offsets[row] + at, n + min_bytes - 1)
            columns = [part.column("id").take(own), part.column("key").take(own), pa.array(at), pa.array(n.astype(np.int32)), pa.array(value), pa.array(content)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "at", "n", "anchor", "content"])

    rows = stored.where("anchors is not null").select("id", "key", "packed", "anchors")
    return rows.mapInArrow(work, f"id {kind}, key long, at long, n int, anchor long, content long")


def _with_bytes(stored: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """``wanted`` (id, key, at, n, anchor) with the bytes of each segment."""
    kind = stored.schema["id"].dataType.simpleString()
    spots = wanted.groupBy("key").agg(F.collect_list(F.struct("at", "n", "anchor", "hot")).alias("spots"))

    def work(batches):
        for part in _small(batches):
            for text, row in zip(_unpacked(part), part.select(["id", "key", "spots"]).to_pylist()):
                found = row["spots"]
                columns = [
                    pa.array([row["id"]] * len(found), part.schema.field("id").type),
                    pa.array([row["key"]] * len(found), pa.int64()),
                    pa.array([s["at"] for s in found], pa.int64()),
                    pa.array([s["anchor"] for s in found], pa.int64()),
                    pa.array([s["hot"] for s in found], pa.bool_()),
                    pa.array([text[s["at"] : s["at"] + s["n"] + min_bytes - 1] for s in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "at", "anchor", "hot", "bytes"])

    rows = stored.join(spots, "key").select("id", "key", "packed", "spots")
    return rows.mapInArrow(work, f"id {kind}, key long, at long, anchor long, hot boolean, bytes binary")


def _blocks(batches):
    """Rows sorted by anchor, cut into tables of whole anchors of about BLOCK bytes."""
    held, size = [], 0
    for batch in batches:
        for part in text_chunks([batch], "bytes", BLOCK):
            held.append(part)
            size += part.column("bytes").nbytes
            if size < BLOCK:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            anchors = rows.column("anchor").to_numpy()
            # The last anchor may go on in what comes next.
            cut = int(np.searchsorted(anchors == anchors[-1], True))
            if cut:
                yield rows.slice(0, cut)
            held = rows.slice(cut).to_batches()
            size = sum(x.column("bytes").nbytes for x in held)
    if held:
        yield pa.Table.from_batches(held)


def _repeats_in_blocks(rows: DataFrame, min_bytes: int) -> DataFrame:
    """Runs of repeated windows: ``id, key, at, n``."""
    kind = rows.schema["id"].dataType.simpleString()
    columns = ["id", "key", "at", "anchor", "bytes"]

    def work(batches):
        for block in _blocks(batches):
            keys = [("id", "ascending"), ("key", "ascending"), ("at", "ascending")]
            block = block.take(pc.sort_indices(block, sort_keys=keys, null_placement="at_start")).combine_chunks()
            # A segment of a repeated row is there twice: once is enough.
            same = np.zeros(len(block), bool)
            same[1:] = True
            for name in ("key", "at"):
                values = block.column(name).to_numpy()
                same[1:] &= values[1:] == values[:-1]
            block = block.filter(pa.array(~same))
            texts = block.column("bytes").to_pylist()
            repeat = repeated_windows(texts, min_bytes)
            sizes = np.array([max(len(t) - min_bytes + 1, 0) for t in texts])
            segment = np.repeat(np.arange(len(texts)), sizes)
            offset = ragged(np.zeros(len(texts), np.int64), sizes)
            new = repeat.copy()
            new[1:] &= ~repeat[:-1] | (segment[1:] != segment[:-1])
            begin = np.flatnonzero(new)
            run = np.cumsum(new)[repeat] - 1
            n = np.bincount(run, minlength=len(begin))
            own = pa.array(segment[begin])
            at = block.column("at").to_numpy()[segment[begin]] + offset[begin]
            out = [block.column("id").combine_chunks().take(own), block.column("key").combine_chunks().take(own), pa.array(at), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(out, names=["id", "key", "at", "n"])

    # An anchor has at most MEET segments of less than 2 * min_bytes here.
    dealt = rows.select(columns).repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(work, f"id {kind}, key long, at long, n long")


def _recut(rows: DataFrame, width: int, min_bytes: int) -> DataFrame:
    """The segments of anchors with very many of them, cut finer: at most ``width`` windows each, by the place of the
    anchor in the window. Their new anchor is the hash of the bytes that all windows of a cut share, so equal windows stay
    together and others part. With a width of 1 the shared bytes are the window itself."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for part in text_chunks([batch], "bytes", BLOCK // 2):
                data, offsets = flat_bytes(part.column("bytes"))
                n = np.diff(offsets) - min_bytes + 1
                grams = rolling(data, GRAM).view(np.int64)
                own = np.repeat(np.arange(len(n)), np.diff(offsets))[: len(grams)]
                found = np.flatnonzero(grams == part.column("root").to_numpy()[own])
                # The first place of the anchor is that of all windows of the segment.
                place = found[np.searchsorted(found, offsets[:-1])] - offsets[:-1]
                high, low = place // width, (place - n + 1) // width
                own = np.repeat(np.arange(len(n)), high - low + 1)
                cut = ragged(low, high - low + 1)
                first = np.maximum(place[own] - cut * width - width + 1, 0)
                last = np.minimum(place[own] - cut * width, n[own] - 1)
                shared = place[own] - cut * width
                base = offsets[:-1][own]
                anchor = content_hashes(data, base + shared, np.full(len(own), min_bytes - width + 1))
                size = last - first + min_bytes
                content = content_hashes(data, base + first, size)
                take = pa.array(own)
                raw = data.tobytes()
                pieces = [raw[a:b] for a, b in zip((base + first).tolist(), (base + first + size).tolist())]
                at = part.column("at").to_numpy()[own] + first
                columns = [part.column("id").take(take), part.column("key").take(take), pa.array(at), pa.array((last - first + 1).astype(np.int32))]
                columns += [pa.array(anchor ^ cut), pa.array(content), pa.array(pieces, pa.binary()), part.column("root").take(take)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "at", "n", "anchor", "content", "bytes", "root"])

    given = rows.select("id", "key", "at", "root", "bytes")
    return given.mapInArrow(work, f"id {kind}, key long, at long, n int, anchor long, content long, bytes binary, root long")


def repeats(stored: DataFrame, min_bytes: int = MIN_BYTES, meet: int = MEET) -> DataFrame:
    """Runs of repeated windows of all documents: ``id, key, at, n``."""
    found, out = materialize(_segments(stored, min_bytes), "segments"), None
    me = F.struct("id", "key", "at", "n")
    for width in (WIDTH, 1, None):
        same = found.groupBy("anchor", "content").agg(F.min(me).alias("first"), F.count("*").alias("times"))
        same = materialize(same, "contents")
        several = same.where("times > 1").select("anchor", "content", "first")
        copies = found.join(several, ["anchor", "content"]).where(me != F.col("first"))
        copies = copies.select("id", "key", "at", F.col("n").cast("long").alias("n"))
        out = copies if out is None else out.union(copies)
        kinds = same.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
        mixed = same.join(materialize(kinds, "kinds"), "anchor")
        mixed = mixed.select("first", "anchor", "content", (F.col("kinds") > meet).alias("hot"))
        if "bytes" in found.columns:
            mixed = found.join(mixed, ["anchor", "content"]).where(me == F.col("first"))
            mixed = mixed.select("id", "key", "at", "anchor", "hot", "bytes", "root")
        else:
            mixed = _with_bytes(stored, mixed.select("first.*", "anchor", "hot"), min_bytes)
            mixed = mixed.withColumn("root", F.col("anchor"))
        mixed = materialize(mixed, "mixed")
        out = out.union(_repeats_in_blocks(mixed.where(~F.col("hot")), min_bytes))
        hot = mixed.where("hot")
        if hot.isEmpty():
            return out
        if width is None:
            raise RuntimeError("windows of one hash differ")
        found = materialize(_recut(hot, width, min_bytes), "recut")
    return out


def _cut(text: bytes, spans: list, min_bytes: int) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the number of removed runs."""
    if not spans:
        return text, 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    at, n = np.array([s["at"] for s in spans]), np.array([s["n"] for s in spans])
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n + min_bytes - 1, -1)
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, meet: int = MEET) -> DataFrame:
    """Per row: ``id, key, n_bytes, n_removed, n_spans, kept`` (the bytes that stay), and ``new_text`` (those of whole
    characters, null where nothing is removed)."""
    if min_bytes < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes are asked for")
    keyed = _keyed(docs, id_col, text_col)
    kind = keyed.schema["id"].dataType.simpleString()
    spark = docs.sparkSession
    occurring = _anchors(keyed, min_bytes)
    twice = materialize(occurring.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"), "anchors")
    marked = occurring.join(twice, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    marked = materialize(marked, "marked")
    # Dealt out by key once; the checkpoint keeps that partitioning.
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = _packed(keyed).repartition(width, "key").join(marked.repartition(width, "key"), "key", "left").checkpoint()
    spans = repeats(stored, min_bytes, meet).groupBy("key").agg(F.collect_list(F.struct("id", "at", "n")).alias("spans"))

    def work(batches):
        for part in _small(batches):
            rows = part.select(["id", "key", "spans"]).to_pylist()
            out = [
                (r["id"], r["key"], len(t), *_cut(t, [s for s in r["spans"] or [] if s["id"] == r["id"]], min_bytes))
                for t, r in zip(_unpacked(part), rows)
            ]
            columns = list(zip(*out))
            columns.append([k.decode("utf-8", "ignore") if gone else None for k, gone in zip(columns[3], columns[4])])
            types = [part.schema.field("id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
            names = ["id", "key", "n_bytes", "kept", "n_removed", "n_spans", "new_text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    joined = stored.join(spans, "key", "left").select("id", "key", "packed", "spans")
    return joined.mapInArrow(work, f"id {kind}, key long, n_bytes long, kept binary, n_removed long, n_spans long, new_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its bytes, those removed, the removed runs, and the hash of what stays."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` with the repeated bytes taken out of their texts. A character that
    loses some of its bytes goes whole. Documents stay, texts may become empty."""
    found = remove_repeats(docs)
    changed = materialize(found.where("n_removed > 0").select("key", "new_text").dropDuplicates(["key"]), "changed")
    # As one column, the rows' columns may have any names.
    own = F.xxhash64(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), own.alias("own"))
    joined = rows.join(changed, F.col("own") == F.col("key"), "left")
    text = F.when(F.col("key").isNotNull(), F.col("new_text")).otherwise(F.col("row.text"))
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")
