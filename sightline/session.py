"""A session with the settings that results depend on, and sensible ones for local runs."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once an application, so that functions that
    are pickled by their module's name are found wherever a worker runs."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    target = os.path.join(tempfile.mkdtemp(prefix="sightline-"), "sightline.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"{root.name}/{source.relative_to(root)}")
    context.addPyFile(target)
    _shipped.add(context.applicationId)


#: Folders of local sessions that have no spark.checkpoint.dir; they go when the process ends.
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Where it is unset, a
    local session gets a temporary folder and a cluster an error, as its disks aren't shared."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master or ""):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if spark.sparkContext.applicationId not in _local:
        _local[spark.sparkContext.applicationId] = at = tempfile.mkdtemp(prefix="sightline-tables-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
    return "file://" + _local[spark.sparkContext.applicationId]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder, below the application's id, and read again: cuts lineage,
    survives lost executors.

    The shuffle files of the finished write are of no more use and go at once, where Spark can do that;
    the table itself goes when the application ends."""
    spark = df.sparkSession
    top = f"{shared_dir(spark)}/sightline/{spark.sparkContext.applicationId}"
    path = f"{top}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    place, files = _place(spark, top)
    files.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def _place(spark: SparkSession, path: str):
    """A path, and the file system that it is on."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``kept`` wrote and that nothing reads any more; others are left alone."""
    for df in tables:
        if path := getattr(df, "_kept_at", None):
            place, files = _place(df.sparkSession, path)
            files.delete(place, True)


def session(cpus: int | str = "*", name: str = "sightline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    for k, v in (settings | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df):
    """``df`` dealt out if it has fewer splits than the session has cores, before costly work on each row.

    A large input has more splits than there are cores and passes as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
