"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "shelfline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes.

    AQE sizes shuffle partitions and splits skewed join partitions at run time,
    so no job fixes a partition count. Cluster settings win where given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A hot key is split even when that costs one more exchange afterwards.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM does not compile methods above 8000 bytes; wide aggregates would
        # otherwise run as one huge interpreted method.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is made, but in local mode only: on a
    cluster a machine-local folder would be invisible to the other machines.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="shelfline-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


#: Work paths handed out by this driver and not yet removed.
_MADE: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear_work(spark: SparkSession) -> None:
    """Remove all work tables of this driver; call it once their results are read or written.

    Results are lazy and read these tables, so nothing can remove them earlier.
    """
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Remove the work table that ``df`` reads, once nothing will read it any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 2)[-2] for f in df.inputFiles()}:
        for made in [p for p in _MADE if p.rsplit("/", 1)[-1] == name]:
            path = spark._jvm.org.apache.hadoop.fs.Path(made)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            _MADE.remove(made)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives losing any executor, and fixes the
    values of non-deterministic columns such as partition ids.
    """
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
