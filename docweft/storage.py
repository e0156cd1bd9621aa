"""Reading tables, and cutting lineage through the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import zipfile
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a folder; one of fewer pieces than there are cores is spread over them."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where it is unset and the master is local is a temporary folder made; on a cluster a
    missing setting is an error, since a machine's own folder would not be seen by the others.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = own = tempfile.mkdtemp(prefix="docweft-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return _LOCAL_DIRS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/docweft/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: lineage ends here, executors may be lost."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_counted(df: DataFrame, name: str, *partition_by: str) -> tuple[DataFrame, int]:
    """As ``written``, with the number of rows counted while they are written."""
    seen = Observation()
    return written(df.observe(seen, F.count(F.lit(1)).alias("n")), name, *partition_by), noted(seen, "n")


def noted(seen: Observation, name: str) -> int:
    """A number observed by a finished action; 0 where Spark found the observed part empty and left it out."""
    try:
        return seen.get.get(name) or 0
    except Py4JJavaError as error:
        if "AssertionError" in str(error):
            return 0
        raise


def collect_garbage(spark: SparkSession) -> None:
    """Lets go of what finished queries hold: Spark drops their shuffle files and broadcasts once the driver's objects are collected.

    For jobs of many queries on a driver whose heap would otherwise grow to its limit before it is collected as a whole.
    """
    gc.collect()  # Python's references keep the driver's objects
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables written for one job, deleted together once nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def written(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """As the function ``written``; the files are deleted by ``drop``."""
        path = fresh_path(self.spark, name)
        self.paths.append(path)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """A written table and the number of its rows, counted while it is written."""
        seen = Observation()
        out = self.written(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
        return out, noted(seen, "n")

    def drop(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()


def drop_table(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made and nothing will read again."""
    for path in {str(Path(f)).rpartition("/")[0] for f in df.inputFiles()}:
        drop_path(df.sparkSession, path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder written by this module."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of all executors; once an application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="docweft-")) / "docweft.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, str(path.relative_to(package.parent)))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
