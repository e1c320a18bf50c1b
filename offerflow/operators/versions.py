"""Stored tables that change by whole folders: new data is written aside, and a small commit that names it is written last.

A run that fails before its commit changes nothing, and its repetition overwrites the folder that it left. One
writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET, _FOLD = "_bucket", "_fold"


def read_commits(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The commits of a folder: their fields and ``number``; None if there is none yet."""
    try:
        return spark.read.schema(f"{schema}, number long").json(f"{path}/_commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commit(spark: SparkSession, path: str, number: int, row: dict, schema: str) -> None:
    """Write one commit; it is a single file, so it is there as a whole or not at all."""
    one = spark.createDataFrame([row], schema).coalesce(1)
    one.write.mode("overwrite").json(f"{path}/_commits/number={number}")


@dataclass(frozen=True)
class Runs:
    """A folder of runs, of which the newest committed one counts: ``run=N`` holds its files, its commit says what they are."""

    path: str
    schema: str

    def newest(self, spark: SparkSession) -> dict | None:
        """The newest commit with its ``number``, or None."""
        commits = read_commits(spark, self.path, self.schema)
        found = None if commits is None else commits.orderBy(F.desc("number")).first()
        return None if found is None else found.asDict()

    def folder(self, number: int) -> str:
        return f"{self.path}/run={number}"

    def publish(self, spark: SparkSession, write: Callable[[str], dict]) -> int:
        """``write`` fills the folder of the next run and returns its commit; nothing is visible before that is written."""
        last = self.newest(spark)
        number = 0 if last is None else last["number"] + 1
        commit(spark, self.path, number, write(self.folder(number)), self.schema)
        return number


@dataclass(frozen=True)
class BucketedTable:
    """A table with a unique key, stored by a hash of the key; a fold rewrites the buckets that it touches and no others.

    Every fold has its own folder, with a folder for each bucket that it rewrote; the newest committed one counts. The number of buckets
    is fixed when the table is created; some gigabytes for each are a good size. Rows without a key are
    spread by a hash of the whole row. A fold scans the touched buckets only, and what comes to the driver is at most a row for each bucket.
    """

    path: str
    key: str
    schema: T.StructType
    buckets: int = 64

    _COMMIT = "buckets array<int>, upto long"

    def _bucket(self) -> Column:
        whole = F.xxhash64(*[F.col(c) for c in self.schema.fieldNames()])
        return F.pmod(F.coalesce(F.when(F.col(self.key).isNotNull(), F.xxhash64(self.key)), whole), F.lit(self.buckets)).cast("int")

    def _newest(self, spark: SparkSession) -> tuple[dict[int, int], int, int]:
        """Newest fold of every bucket, number of the last fold and of the last folded micro-batch (-1 before the first)."""
        commits = read_commits(spark, self.path, self._COMMIT)
        if commits is None:
            return {}, -1, -1
        newest = commits.select(F.explode("buckets").alias("bucket"), "number").groupBy("bucket").agg(F.max("number").alias("number"))
        last, upto = commits.agg(F.max("number"), F.max("upto")).first()
        return {r["bucket"]: r["number"] for r in newest.collect()}, last, upto

    def _rows(self, spark: SparkSession, newest: dict[int, int]) -> DataFrame:
        """The rows of some buckets; the condition is on folder names, so other folders are not opened."""
        if not newest:
            return spark.createDataFrame([], self.schema)
        fields = [*self.schema.fields, T.StructField(_FOLD, T.LongType()), T.StructField(_BUCKET, T.IntegerType())]
        chosen = F.lit(False)
        for fold in sorted(set(newest.values())):
            chosen = chosen | ((F.col(_FOLD) == fold) & F.col(_BUCKET).isin([b for b, f in newest.items() if f == fold]))
        return spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/data").where(chosen).select(*self.schema.fieldNames())

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark, self._newest(spark)[0])

    def fold(self, log: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], batch: str | None = "batch_id") -> int:
        """Merge a log into the table: ``merge(rows of the touched buckets, log)``; the number of the last folded micro-batch.

        With a ``batch`` column only later micro-batches than those folded before are read, so a fold that is repeated
        after its commit does nothing. Without one the whole log counts once, as the first filling of a table.
        """
        spark = log.sparkSession
        newest, last, upto = self._newest(spark)
        if batch:
            log = log.where(F.col(batch) > upto)
            upto = log.agg(F.max(batch)).first()[0] if log.columns else None
            if upto is None:
                return self._newest(spark)[2]
        touched = [r[0] for r in log.select(self._bucket()).distinct().collect()]  # at most a row for each bucket
        rows = merge(self._rows(spark, {b: f for b, f in newest.items() if b in set(touched)}), log)
        rows = rows.select(*self.schema.fieldNames()).withColumn(_BUCKET, self._bucket())
        rows.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/data/{_FOLD}={last + 1}")
        commit(spark, self.path, last + 1, {"buckets": sorted(touched), "upto": upto}, self._COMMIT)
        return upto

    def vacuum(self, spark: SparkSession) -> None:
        """Remove folders that no later reader needs: buckets with a newer fold, and folds without a commit."""
        newest, _, _ = self._newest(spark)
        hadoop = spark._jvm.org.apache.hadoop.fs
        top = hadoop.Path(f"{self.path}/data")
        store = top.getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in store.globStatus(hadoop.Path(top, f"{_FOLD}=*/{_BUCKET}=*")):
            place = folder.getPath()
            fold, bucket = (int(p.getName().split("=")[1]) for p in (place.getParent(), place))
            if newest.get(bucket) != fold:
                store.delete(place, True)
