"""WARC archives: writing with revisit records, and reading by verified boundary chains.

Writing is Spark's text sink with the record separator as its line separator, so archives can be written to any store
and a lost task is repeated. A payload that occurs several times is stored once, in the record of the least id; the
others become revisit records that refer to it.

Reading splits archives anywhere. Each task finds the version line that records start with and emits candidates: the
record's offset and, from its length, that of its successor. The version line may stand inside a payload too, so a
candidate is only a record if the chain of successors from the start of the file reaches it. Within a split the chain is
followed in the task; between splits by pointer jumping: every round joins the candidates' exits with themselves and
doubles the distance, so rounds are logarithmic in the number of splits. Records cut up by a version line in
their payload are put together again from the pieces that their length covers.

Defined results: null html is an empty payload. A null id has no id header and comes back as null; it
is the first of its payload only where no row has an id. Rows that repeat the least id are all responses. Line breaks in a url become spaces,
a null url is left out. A chain that ends in damage ends the file's records there. An empty table makes an archive without records. Other
columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.common import table
from chatloom.session import materialize, scratch_dir

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Shorter payloads are stored every time.
MIN_SHARED = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of the blocks by which pieces find the record that covers them.
BLOCK = 1 << 20
MAX_BROADCAST = 50_000


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(page: Column, digest: Column) -> Column:
    """A record's name, from its id and payload."""
    code = F.md5(F.concat(F.coalesce(page.cast("string"), F.lit("-")), F.lit(" "), digest))
    parts = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``value``: the text of one record per row, without its version line's end being cut."""
    rows = pages.select(
        F.col(id_col).alias("page"), F.regexp_replace(url_col, r"[\r\n]+", " ").alias("url"), F.coalesce(html_col, F.lit("")).alias("html")
    )
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    long = rows.where(F.col("size") >= MIN_SHARED)
    firsts = long.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("copies"))
    firsts = materialize(firsts.where("copies > 1").select(F.col("digest").alias("shared"), "first"), "firsts")
    rows = rows.join(firsts, F.col("digest") == F.col("shared"), "left")
    again = F.col("shared").isNotNull() & F.coalesce(F.col("page") != F.col("first"), F.col("first").isNotNull())
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
        F.when(again, "").otherwise(F.col("html")),
    )
    rows = rows.select("page", "url", "digest", "size", "first", again.alias("again"), block.alias("block"))
    refers = F.when(F.col("again"), F.col("first"))
    header = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page"), F.col("digest"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(F.col("again"), PROFILE)),
        _line("WARC-Refers-To", F.when(F.col("again"), _urn(F.col("first"), F.col("digest")))),
        _line("X-Page-Id", F.col("page").cast("string")),
        _line("X-Payload-Length", F.col("size").cast("string")),
        _line("X-Refers-To-Page", refers.cast("string")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length("block").cast("string")),
    )
    return rows.select(F.concat(header, F.lit("\r\n"), F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """A folder of archives with a record per row of ``pages``."""
    records(pages, **columns).write.option("lineSep", END).text(path)


def parse(piece: bytes) -> tuple[int, dict]:
    """Bytes from the version line to the record's end (0: this is no record), and its headers."""
    at = piece.find(b"\r\n\r\n")
    if at < 0:
        return 0, {}
    headers = {}
    for line in piece[:at].split(b"\r\n"):
        name, found, value = line.partition(b":")
        if found:
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return 0, headers
    return len(VERSION) + at + 4 + int(length) + len(END), headers


def payload(piece: bytes, headers: dict) -> bytes:
    """The payload of a whole record (without its version line)."""
    at = piece.find(b"\r\n\r\n") + 4
    block = piece[at : at + int(headers["content-length"])]
    if headers.get("content-type", "").startswith("application/http"):
        return block[block.find(b"\r\n\r\n") + 4 :]
    return block


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between version lines: ``path, split, value``, in the order of the file in each split."""
    rows = spark.read.option("lineSep", VERSION).text(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


FIELDS = "headers map<string,string>, size long, sha256 string"


def _read(pieces: DataFrame) -> DataFrame:
    """Per piece: its place in the split, bytes, the bytes that it declares, and what a whole record holds."""

    def work(batches):
        here, number, local = None, 0, 0
        for batch in batches:
            out = []
            for path, split, value in zip(*(batch.column(k).to_pylist() for k in ("path", "split", "value"))):
                if (path, split) != here:
                    here, number, local = (path, split), 0, 0
                need, headers = parse(value)
                whole = need and need - len(VERSION) <= len(value)
                body = payload(value, headers) if whole else b""
                digest = hashlib.sha256(body).hexdigest() if whole else None
                out.append((path, split, number, local, len(value), need, list(headers.items()), len(body), digest, bool(whole)))
                number += 1
                local += len(value) + len(VERSION)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.bool_()]
            names = ["path", "split", "number", "local", "bytes", "need", "headers", "size", "sha256", "whole"]
            columns = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return pieces.mapInArrow(work, f"path string, split long, number long, local long, bytes long, need long, {FIELDS}, whole boolean")


def _by_split(frame: DataFrame, schema: str, follow) -> DataFrame:
    """Runs ``follow`` over each split's candidates, sorted by offset. A split bounds their number."""
    return frame.groupBy("path", "split").applyInPandas(follow, schema)


def _exits(pdf):
    """Where the chain from each candidate leaves the split."""
    pdf = pdf.sort_values("start")
    start, goal = pdf["start"].to_numpy(), pdf["next"].to_numpy().copy()
    at = np.searchsorted(start, goal)
    inside = (at < len(start)) & (start[np.minimum(at, len(start) - 1)] == goal)
    hop = np.where(inside, at, np.arange(len(start)))
    while True:
        further = hop[hop]
        if (further == hop).all():
            break
        hop = further
    return pdf[["path", "split", "start"]].assign(exit=goal[hop])


def _reached(pdf):
    """The candidates that the chain from the split's entry passes."""
    pdf = pdf.sort_values("start")
    start, goal, seen = pdf["start"].to_numpy(), pdf["next"].to_numpy(), pdf["entry"].to_numpy().copy()
    at = np.minimum(np.searchsorted(start, goal), len(start) - 1)
    for k in range(len(start)):
        if seen[k] and start[at[k]] == goal[k]:
            seen[at[k]] = True
    return pdf[seen][["path", "start"]]


def boundaries(candidates: DataFrame) -> DataFrame:
    """``path, start`` of the true records among ``path, split, start, next``."""
    exits = materialize(_by_split(candidates, "path string, split long, start long, exit long", _exits), "exits")
    jumps = exits.select("path", "start", F.col("exit").alias("to"))
    entries = materialize(jumps.where("start = 0").select("path", "start"), "entries")
    count = entries.count()
    while True:
        further = entries.join(jumps, ["path", "start"]).select("path", F.col("to").alias("start"))
        entries = materialize(entries.union(further).distinct(), "entries")
        if (now := entries.count()) == count:
            break
        count = now
        doubled = jumps.alias("a").join(jumps.alias("b"), (F.col("a.path") == F.col("b.path")) & (F.col("a.to") == F.col("b.start")))
        jumps = materialize(doubled.select("a.path", "a.start", "b.to"), "jumps")
    entries = entries.withColumn("entry", F.lit(True))
    marked = candidates.join(entries, ["path", "start"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return _by_split(marked, "path string, start long", _reached)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record: ``path, start, headers, size, sha256``, the latter two of its payload."""
    pieces = _pieces(spark, path)
    read = materialize(_read(pieces), "pieces")
    if read.isEmpty():
        return read.select("path", F.col("local").alias("start"), "headers", "size", "sha256")
    ends = read.groupBy("path", "split").agg(F.max(F.col("local") + F.col("bytes") + len(VERSION)).alias("length"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select("path", "split", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("base"))
    start = F.col("base") + F.col("local") - len(VERSION)
    placed = materialize(read.join(materialize(bases, "bases"), ["path", "split"]).withColumn("start", start), "placed")
    candidates = placed.where("need > 0").select("path", "split", "start", (F.col("start") + F.col("need")).alias("next"))
    true = materialize(boundaries(candidates), "records")
    kept = placed.join(true, ["path", "start"])
    whole = kept.where("whole").select("path", "start", "headers", "size", "sha256")
    cut = kept.where(~F.col("whole")).select("path", "start", (F.col("start") + F.col("need")).alias("next"))
    cut = materialize(cut, "cut")
    if cut.isEmpty():
        return whole
    return whole.union(_joined(spark, pieces, placed, cut))


def _joined(spark: SparkSession, pieces: DataFrame, placed: DataFrame, cut: DataFrame) -> DataFrame:
    """The records of ``cut`` put together from all pieces between their start and end."""
    block = lambda c: F.floor(F.col(c) / BLOCK)
    owners = cut.select("path", F.col("start").alias("owner"), "next", F.explode(F.sequence(block("start"), block("next"))).alias("block"))
    parts = placed.withColumn("block", block("start")).join(owners, ["path", "block"])
    parts = parts.where((F.col("start") >= F.col("owner")) & (F.col("start") < F.col("next")))
    parts = materialize(parts.select("path", "split", "number", "start", "owner"), "parts")

    def numbered(batches):
        here, number = None, 0
        for batch in batches:
            numbers = []
            for key in zip(batch.column("path").to_pylist(), batch.column("split").to_pylist()):
                here, number = (key, number + 1) if key == here else (key, 0)
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "number"])

    again = pieces.mapInArrow(numbered, "path string, split long, value binary, number long")
    few = parts.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    found = again.join(F.broadcast(parts) if few else parts, ["path", "split", "number"])
    rows = found.groupBy("path", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))

    def work(batches):
        for batch in batches:
            out = []
            for path, owner, held in zip(*(batch.column(k).to_pylist() for k in ("path", "owner", "parts"))):
                piece = VERSION.encode().join(p["value"] for p in held)
                headers = parse(piece)[1]
                body = payload(piece, headers)
                out.append((path, owner, list(headers.items()), len(body), hashlib.sha256(body).hexdigest()))
            types = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string()]
            columns = zip(*out) if out else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["path", "start", "headers", "size", "sha256"])

    return rows.select("path", "owner", "parts").mapInArrow(work, f"path string, start long, {FIELDS}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, as read back from the archives: its payload's size and hash, and what its record is."""
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = read_archives(spark, path)
    header = lambda name: F.element_at("headers", name)
    again = header("warc-type") == "revisit"
    return found.select(
        header("x-page-id").cast("long").alias("page_id"),
        F.when(again, header("x-payload-length").cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(again, F.substring_index(header("warc-payload-digest"), ":", -1)).otherwise(F.col("sha256")).alias("payload_digest"),
        header("warc-type").alias("record_type"),
        header("x-refers-to-page").cast("long").alias("refers_to"),
    )


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
