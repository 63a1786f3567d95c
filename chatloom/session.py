"""Session defaults and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "chatloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its zone; ``conf`` keys use ``__`` for dots.

    No shuffle-partition count is set here: adaptive execution coalesces from the cluster's own
    setting, which has to follow the data volume and not this code.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Where the shuffled small side turns out small enough, long texts need not be sorted.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the master is local, since
    executors on other machines could not read it.
    """
    leaf = f"{name}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{leaf}"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix='chatloom-')}/{leaf}"


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` computed once into a table in the shared scratch folder, and read from there.

    For a result that is used several times: unlike a cache it is still there after an executor is
    lost.
    """
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
