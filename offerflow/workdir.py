"""The shared folder for written intermediate tables and checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; where it is unset, one below the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/offerflow/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: what follows neither recomputes the input nor depends on the executors
    that made it. Column names, types and rows are unchanged; an empty table stays empty.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    conf, setting = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(setting, "false")
    conf.set(setting, "true")
    try:
        yield
    finally:
        conf.set(setting, before)


def written_alone(df: DataFrame, name: str) -> DataFrame:
    """As ``written``; the shuffle files of the job are removed at its end instead of when the driver collects its garbage.

    For a step that moves much and whose input is not used by another running query.
    """
    with _shuffle_files_removed(df.sparkSession):
        return written(df, name)


def written_by_kind(df: DataFrame, name: str, kinds: list[str]) -> dict[str, tuple[DataFrame, str]]:
    """As ``written_alone``, for rows of several ``kind``: of each kind its rows, without that column, and the folder that holds them."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    with _shuffle_files_removed(spark):
        df.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    found = {}
    for kind in kinds:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/kind={kind}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)  # where there are no such rows
        found[kind] = spark.read.schema(df.drop("kind").schema).parquet(f"{path}/kind={kind}"), f"{path}/kind={kind}"
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared folder that no query needs any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Remove everything this application has written to the shared folder; call it when its results are used."""
    remove(spark, _folder(spark))
