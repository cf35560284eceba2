"""Where intermediate and final tables go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BUCKETED = "shockwell_"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Names of bucketed tables by their folder.
_bucketed: dict[str, list[str]] = {}


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares for intermediate tables.

    That is the setting, or the folder given to ``setCheckpointDir``; there is
    no other choice, because a folder of one machine is lost to the others.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return f"{shared.rstrip('/')}/shockwell-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """``(file system, path)`` in whatever store it lies, as Hadoop objects."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table or folder of the work folder."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


@contextmanager
def work_area(spark: SparkSession) -> Iterator[str]:
    """A work folder for the time of a run; its tables go at the end."""
    folder = work_folder(spark)
    try:
        yield folder
    finally:
        for name in _bucketed.pop(folder, []):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, folder)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Nothing reads the shuffle files of a job that writes once it has ended, so they are freed then."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Write a table and read it back.

    Later steps then depend on files in shared storage: an executor loss costs
    its own tasks, not the steps before.
    """
    spark = df.sparkSession
    with shuffles_freed(spark):
        df.write.mode("overwrite").partitionBy(*partition_by).options(**options).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*(f"`{c.replace('`', '``')}`" for c in df.columns))


def bucketed(df: DataFrame, path: str, key: str, buckets: int, partition_by: tuple[str, ...], **options: str) -> DataFrame:
    """`written`, with the rows of a key in one bucket: what adds up per ``key`` reads them without an exchange.

    Each task should hold whole buckets (``repartition(buckets, key)``), for it
    writes a file per bucket and partition.  Only the session's catalog knows
    about buckets; `work_area` takes the name out again.
    """
    spark, name = df.sparkSession, f"{BUCKETED}{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.format("parquet").partitionBy(*partition_by).bucketBy(buckets, key).options(path=path, **options).saveAsTable(name)
    _bucketed.setdefault(path.rsplit("/", 1)[0], []).append(name)
    return spark.table(name).select(*df.columns)


def settled(df: DataFrame, name: str = "table") -> DataFrame:
    """The table, computed once and kept in the work folder for several uses."""
    return written(df, f"{work_folder(df.sparkSession)}/{name}")
