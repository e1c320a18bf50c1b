"""The first item of every key of a stream, with state that expires by event time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

# The operator travels with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keys share a state by a hash; a bucket's keys are read and stored at once, so it should hold a few thousand of them.
BUCKETS = 1 << 12
_AT, _ORDER, _KEY, _BUCKET = "_at", "_order", "_key", "_bucket"


class KeepFirst(StatefulProcessor):
    """State of a bucket of keys: for each key the event time (microseconds) of the item kept last, and when the next of them is over.

    Within a micro-batch the items of a key are taken by event time and then by the order. One is kept if no item was
    kept before, or the last one lies ``delay`` or more behind; without a delay only the very first is. A timer drops keys once
    the watermark has passed that delay: whatever arrives later is newer than that, so the timer never changes a result.
    A bucket has one state, read and stored once in a micro-batch, and one timer, however many keys it holds.
    """

    def __init__(self, delay: int | None, orders: int, columns: list[str]) -> None:
        self.delay, self.by, self.columns = delay, [_AT, *(f"{_ORDER}{i}" for i in range(orders))], columns
        self.names = [*columns, *self.by, _KEY, _BUCKET]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", T.StructType([
            T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("at", T.ArrayType(T.LongType())),
            T.StructField("alarm", T.LongType())]))

    def _alarm(self, at: int) -> int:
        """Milliseconds at which the state of an item is over, rounded up."""
        return -(-(at + self.delay) // 1000)

    def _read(self) -> tuple[dict[str | None, int], int | None]:
        state = self.kept.get()
        return (dict(zip(state[0], state[1], strict=True)), state[2]) if state is not None else ({}, None)

    def _store(self, last: dict[str | None, int], timer: int | None) -> None:
        """Keep the state and have its timer, if not the one that is set, go off when the first of its keys is over."""
        alarm = None if self.delay is None else self._alarm(min(last.values()))
        if alarm != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(alarm)
        self.kept.update((list(last), list(last.values()), alarm))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, timer = self._read()
        batch = pd.concat(list(rows), ignore_index=True)
        batch.columns = self.names  # Spark renames columns that begin with an underscore
        batch = batch.sort_values(self.by, na_position="first", kind="stable")
        chosen = []
        for place, name, at in zip(batch.index, batch[_KEY], batch[_AT], strict=True):
            name = name if isinstance(name, str) else None
            before = last.get(name)
            if before is None or (self.delay is not None and at >= before + self.delay):
                chosen.append(place)
                last[name] = int(at)
        if chosen:
            self._store(last, timer)
            yield batch.loc[chosen, self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        last = {name: at for name, at in self._read()[0].items() if self._alarm(at) > now}
        if last:
            self._store(last, None)
        else:
            self.kept.clear()
        return iter([])

    def close(self) -> None:
        pass


def first_items(items: DataFrame, key: Column, order: list[Column], event_time: str | None = None, delay: str | None = None,
                lateness: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """The stream's items that come first for their key, with all their columns and ``id`` (the key).

    Without an event time: the first item by micro-batch, then by the order; every key is remembered for good. With one: items
    later than ``lateness`` behind the newest earlier micro-batch are dropped, and an item is new again once its key was last
    kept ``delay`` ago. State lives in the state store in ``buckets`` of keys, fixed for a checkpoint; a micro-batch touches the
    buckets of its keys and reads nothing that was written. Replays repeat the same result. Items without a key count as one key;
    items from before 1970 are late in any stream, since a watermark begins there.
    """
    columns = [*items.columns, "id"]
    rows = items.withColumn("id", key)
    if event_time is None:
        wait, mode, at = None, "None", F.lit(0).cast("long")
    else:
        rows = rows.withWatermark(event_time, lateness)
        wait = _microseconds(items.sparkSession, delay)
        mode, at = "EventTime", F.unix_micros(F.col(event_time))
    rows = rows.withColumns({_AT: at, **{f"{_ORDER}{i}": c for i, c in enumerate(order)}})
    rows = rows.withColumns({_KEY: F.col("id").cast("string"), _BUCKET: F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")})
    return rows.groupBy(_BUCKET).transformWithStateInPandas(
        KeepFirst(wait, len(order), columns), T.StructType([rows.schema[c] for c in columns]), "Append", mode)


def _microseconds(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select((F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}")))).first()[0]


def run_first(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream from ``first_items`` to a Parquet folder, everything available now, exactly once.

    The operator needs the RocksDB state store; the session's setting is put back once the query has taken it over.
    """
    spark = rows.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return rows.writeStream.format("parquet").outputMode("append").option("path", path) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
