"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every job wants.  Cluster sizes (memory, executors) belong to the submitter.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.showConsoleProgress": "false",
}

_MADE: list[str] = []


def build_session(master: str | None = None, app: str = "sluice", **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword names use `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, wherever they run; once per context, before functions are sent there.

    Local workers that inherit a PYTHONPATH with the package need nothing.
    """
    context = spark.sparkContext
    if getattr(context, "_sluice_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    inherited = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if not (context.master.startswith("local") and root in inherited):
        archive = os.path.join(tempfile.mkdtemp(prefix="sluice-"), f"sluice-{uuid.uuid4().hex}.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        out.write(path := os.path.join(folder, name), os.path.relpath(path, root))
        context.addPyFile(archive)
    context._sluice_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from `spark.checkpoint.dir`.

    Only a local master may do without the setting; it then gets a temporary
    folder, which no other machine has to see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", "file://" + made)
    return "file://" + made


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the re-reading of files, not the
    recomputation of everything before.  Each call gets its own sub-folder.
    """
    ship(df.sparkSession)
    path = os.path.join(shared_dir(df.sparkSession), f"{label}-{uuid.uuid4().hex}")
    _MADE.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many tasks as the session shuffles with, at least one a core.

    For rows of few bytes and much work: Spark deals input by bytes, and a file's row group is read by one task, however many cores wait.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """The table, marked for broadcast if it has no more than so many rows.

    Counts the rows, so for materialised tables.  Larger ones are left as they are: joined by shuffle,
    hot keys split by Spark.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def release(spark: SparkSession) -> int:
    """Deletes the tables this process materialised, returns how many there were.  Results that still read them must be stored before."""
    count = len(_MADE)
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
