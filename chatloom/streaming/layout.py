"""The message table that jobs write: a folder per ``sent_date``, below it one per batch, and its upkeep.

A batch that is repeated replaces its own folders. When a date is finished, the small folders of its batches are
packed into files of a useful size.
"""

from collections.abc import Iterable
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..files import delete, entries, exists, rename
from .sinks import COMPRESSION, with_sent_date

#: Size of the files that compaction makes.
TARGET_BYTES = 256 << 20
#: Files of that size in a round of compaction.
ROUND_BINS = 8
_DATE, _BATCH = "sent_date=", "batch_id="
# Readers pass over names that start so.
_WORK = "_compaction"
# Would make one partition of a union of frames that have one each.
_UNION_AS_ONE = "spark.sql.unionOutputPartitioning"


def store_batch(messages: DataFrame, path: str, batch_id: int, repeated: bool = True) -> None:
    """Writes the messages of a batch in place of what an earlier attempt at it has left.

    ``repeated=False`` promises that there was none, and saves looking at every date.
    """
    if repeated:
        for day in _days(messages.sparkSession, path):
            delete(messages.sparkSession, f"{path}/{day}/{_BATCH}{batch_id}")
    dated = with_sent_date(messages).withColumn("batch_id", F.lit(batch_id))
    # Only the folders of this batch are replaced.
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", COMPRESSION).partitionBy("sent_date", "batch_id").parquet(path)


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: StructType) -> DataFrame:
    """The messages that :func:`store_batch` wrote for a batch."""
    held = [f"{path}/{day}/{_BATCH}{batch_id}" for day in _days(spark, path)]
    held = [place for place in held if exists(spark, place)]
    return spark.read.schema(schema).option("basePath", path).parquet(*held) if held else spark.createDataFrame([], schema)


class _Folder(NamedTuple):
    name: str
    size: int
    files: int

    @property
    def last_batch(self) -> int:
        """The last batch in the folder; a packed folder is named by its last batch, as a negative number."""
        number = int(self.name.removeprefix(_BATCH))
        return number if number >= 0 else -number - 1


def compact_messages(
    spark: SparkSession,
    path: str,
    before: date,
    since: date = date.min,
    target_bytes: int = TARGET_BYTES,
) -> list[str]:
    """Packs small batch folders of the dates from ``since`` up to, not including, ``before``; returns the dates packed.

    The newest batch stays as it is, since it may still be repeated. Dates are packed in rounds, so that no more than a
    few files' worth, or one date, stands twice. The packed files of a round are written beside the table
    and listed; only then do they take the place of the folders they were made from. Whatever breaks off is finished or
    dropped by the next call. Readers of a date should wait while it is exchanged.
    """
    finish_compaction(spark, path)
    held = {day: _folders(spark, f"{path}/{day}") for day in _days(spark, path) if since <= (_date(day) or before) < before}
    newest = max((folder.last_batch for folders in held.values() for folder in folders), default=None)
    packed, waiting = [], []
    for day, folders in sorted(held.items()):
        small = [f for f in folders if f.size < target_bytes and f.last_batch != newest]
        if sum(f.files for f in small) < 2 or (len(small) == 1 and small[0].files * target_bytes <= small[0].size):
            continue
        bins = first_fit([f.size for f in small], target_bytes)
        if len(small) == 1 or max(bins) + 1 < sum(f.files for f in small):
            waiting.append((day, small, bins))
            packed.append(day.removeprefix(_DATE))
            if sum(f.size for _, taken, _ in waiting for f in taken) >= ROUND_BINS * target_bytes:
                _exchange(spark, path, waiting)
                waiting = []
    if waiting:
        _exchange(spark, path, waiting)
    return packed


def _exchange(spark: SparkSession, path: str, days: list[tuple[str, list[_Folder], list[int]]]) -> None:
    """Packs the folders of ``days`` and puts the packed ones in their place."""
    work, plan = f"{path}/{_WORK}", []
    held = spark.conf.get(_UNION_AS_ONE, None)
    spark.conf.set(_UNION_AS_ONE, "false")
    try:
        for day, small, bins in days:
            name = f"{_BATCH}{-max(f.last_batch for f in small) - 1}"
            plan.append((day, name, [f.name for f in small]))
            packed = _pack(spark, [(f"{path}/{day}/{f.name}", number) for f, number in zip(small, bins)])
            # No success marker beside the data.
            writer = packed.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            writer.option("compression", COMPRESSION).parquet(f"{work}/new/{day}/{name}")
    finally:
        spark.conf.unset(_UNION_AS_ONE) if held is None else spark.conf.set(_UNION_AS_ONE, held)
    # From here on the exchange will be finished, by whichever call.
    frame = spark.createDataFrame(plan, "day string, packed string, old array<string>")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{work}/plan")
    finish_compaction(spark, path)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Ends a compaction that was broken off: with all its exchanges if its plan was complete, else with none."""
    work = f"{path}/{_WORK}"
    if exists(spark, f"{work}/plan/_SUCCESS"):
        for row in spark.read.parquet(f"{work}/plan").collect():
            new = f"{work}/new/{row.day}/{row.packed}"
            # Once it is in place, the folders it replaces are gone, and one may have had its name.
            if exists(spark, new):
                for name in row.old:
                    delete(spark, f"{path}/{row.day}/{name}")
                rename(spark, new, f"{path}/{row.day}/{row.packed}")
    delete(spark, work)


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """A bin for each of ``sizes``, so that a bin holds at most ``capacity``; the largest are placed first."""
    room, out = [], [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        number = next((n for n, left in enumerate(room) if left >= sizes[at]), len(room))
        if number == len(room):
            room.append(capacity)
        room[number] -= sizes[at]
        out[at] = number
    return out


def _pack(spark: SparkSession, places: Iterable[tuple[str, int]]) -> DataFrame:
    """The rows of folders, a partition per bin. Each is read as it stands: nothing is shuffled or sorted."""
    bins: dict[int, list[str]] = {}
    for place, number in places:
        bins.setdefault(number, []).append(place)
    schema = spark.read.parquet(bins[0][0]).schema
    return reduce(DataFrame.unionAll, (spark.read.schema(schema).parquet(*held).coalesce(1) for held in bins.values()))


def _days(spark: SparkSession, path: str) -> list[str]:
    return [entry.name for entry in entries(spark, path) if entry.is_folder and entry.name.startswith(_DATE)]


def _date(day: str) -> date | None:
    # Messages without a time have a folder too, which is no date.
    try:
        return date.fromisoformat(day.removeprefix(_DATE))
    except ValueError:
        return None


def _folders(spark: SparkSession, path: str) -> list[_Folder]:
    out = []
    for entry in entries(spark, path):
        if entry.is_folder and entry.name.startswith(_BATCH):
            files = entries(spark, f"{path}/{entry.name}")
            out.append(_Folder(entry.name, sum(file.size for file in files), len(files)))
    return out
