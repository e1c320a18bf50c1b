"""Record-at-a-time behaviour as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from offerflow.functions.text import url_id
from offerflow.operators.enrich import backlog, enrich_offers, enrichable
from offerflow.operators.keyed import first_per_key
from offerflow.operators.upsert import upsert_by_url
from offerflow.operators.versions import BucketedTable
from offerflow.streaming.first import first_items, run_first


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_dedup(items: DataFrame, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """One item per URL, any of those in its first micro-batch. With an event time, state is kept only for ``delay``.

    ``stream_first`` keeps the first item by an order, and may take a URL for new again after a while.
    """
    keyed = items.withColumn("id", url_id(F.col("url")))
    if event_time is None:
        return keyed.dropDuplicates(["id"])
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id"])


def stream_first(items: DataFrame, path: str, checkpoint: str, order: list[Column], event_time: str | None = None,
                 delay: str | None = None, lateness: str = "0 seconds") -> StreamingQuery:
    """Keep the first item per URL: by micro-batch, then by the order. Copies of an item may differ in other columns.

    With an event time, a URL is new again once its item was kept ``delay`` ago; see ``first_items``.
    """
    return run_first(first_items(items, url_id(F.col("url")), order, event_time, delay, lateness), path, checkpoint)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, everything available now, exactly once."""
    return rows.writeStream.format("parquet").outputMode("append") \
        .option("path", path).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def stream_upsert(items: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Log every micro-batch of upserts below its batch number.

    A micro-batch costs what it holds, not what the table holds. Replaying a batch after a
    failure overwrites its own folder, so each item is logged exactly once.
    """
    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    return items.writeStream.foreachBatch(log).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def read_upserts(spark: SparkSession, log_path: str, schema: T.StructType) -> DataFrame:
    """The logged items with their ``batch_id``."""
    return spark.read.schema(T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])) \
        .parquet(log_path)


def fold_into(table: BucketedTable, log: DataFrame, order: list[Column]) -> int:
    """Fold the log into a stored table, whose untouched buckets stay as they are; the number of the last folded batch."""
    return table.fold(log, lambda target, new: fold_upserts(target, new, order))


def fold_upserts(target: DataFrame, log: DataFrame, order: list[Column]) -> DataFrame:
    """The target after all logged upserts, in batch order and then in the given order."""
    return upsert_by_url(target, log, [F.col("batch_id"), *order])


def incremental_enrich(offers: DataFrame, path: str, checkpoint: str, as_of: str,
                       stored: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """Enrich offers that arrived since the last run and have no enrichment, neither in ``stored`` nor from an earlier micro-batch.

    ``stored`` reads the table that the batch job appends to. It is called in every micro-batch and joined on ids only, so an offer
    that the batch job has enriched meanwhile is left out. An offer that arrives again is enriched once; of copies in one micro-batch the
    smallest row counts. Replaying a micro-batch overwrites its own folder, which is left out of the earlier ones. Offers without an id
    are enriched each.
    """
    spark = offers.sparkSession
    ids = T.StructType([T.StructField("offre_id", T.StringType()), T.StructField("batch_id", T.LongType())])

    def enrich(batch: DataFrame, batch_id: int) -> None:
        named = first_per_key(batch.where("id IS NOT NULL"), ["id"], [F.col(c) for c in batch.columns if c != "id"])
        done = [] if stored is None else [stored().select("offre_id")]
        if batch_id > 0:
            done.append(spark.read.schema(ids).parquet(path).where(F.col("batch_id") < batch_id).select("offre_id"))
        for known in done:
            named = backlog(named, known)
        rows = named.unionByName(batch.where("id IS NULL"))
        enrich_offers(rows, as_of).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return offers.where(enrichable()).writeStream.foreachBatch(enrich) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
