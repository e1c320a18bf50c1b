"""Streams: state that expires, folds that touch their buckets only, stored enrichments."""

import os
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from offerflow import schemas
from offerflow.operators.upsert import upsert_by_key
from offerflow.operators.versions import BucketedTable
from offerflow.streaming import jobs
from offerflow.streaming.first import KeepFirst

AS_OF = "2025-07-01 10:00:00"


def sequence(rows, delay, lateness):
    """The items that stay, one after the other: rows (arrival, second, number, url)."""
    kept, last, newest = [], {}, None
    for arrival in sorted({r[0] for r in rows}):
        here = sorted(r for r in rows if r[0] == arrival)
        for _, at, number, url in here:
            late = newest is not None and at <= newest - lateness
            if not late and (url not in last or at >= last[url] + delay):
                kept.append(number)
                last[url] = at
        newest = max([r[1] for r in here] + ([] if newest is None else [newest]))
    return sorted(kept)


def test_first_items_expire(spark, tmp_path):
    r = random.Random(3)
    rows = [(a, 1000 * a + r.randint(-400, 999) + (0 if r.random() < 0.8 else -1500), i, f"u{r.randint(0, 12)}") for i in range(600) for a in [i // 100]]
    rows = [(a, 100_000 + at, i, u) for a, at, i, u in rows]
    schema, found = "arrival int, at timestamp, _number int, url string", str(tmp_path / "found")
    states = []
    for arrival in range(6):
        part = [(a, at, i, u) for a, at, i, u in rows if a == arrival]
        frame = spark.createDataFrame(part, "arrival int, s long, _number int, url string")
        frame.select("arrival", F.timestamp_seconds("s").alias("at"), "_number", "url").write.mode("append").parquet(str(tmp_path / "in"))
        items = jobs.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        query = jobs.stream_first(items, found, str(tmp_path / "checkpoint"), [F.col("_number")], "at", "700 seconds", "300 seconds")
        query.awaitTermination()
        states.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]])
    read = spark.read.schema(f"{schema}, id string").parquet(found)
    assert sorted(x[0] for x in read.select("_number").collect()) == sequence(rows, 700, 300)
    assert read.where("id = md5(url)").count() == read.count()
    # nothing new: nothing is added, and the last run's timers have dropped states of views that are long past
    query = jobs.stream_first(items, found, str(tmp_path / "checkpoint"), [F.col("_number")], "at", "700 seconds", "300 seconds")
    query.awaitTermination()
    assert read.count() == spark.read.parquet(found).count()


def test_states_are_dropped_when_their_time_is_over(spark, tmp_path):
    counts = []
    for step in range(3):
        frame = spark.range(50).select(F.timestamp_seconds(F.lit(10_000 * (step + 1))).alias("at"), F.concat(F.lit(f"step{step}-"), "id").alias("url"))
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        items = jobs.read_stream(spark, str(tmp_path / "in"), frame.schema)
        query = jobs.stream_first(items, str(tmp_path / "out"), str(tmp_path / "checkpoint"), [F.col("url")], "at", "100 seconds", "10 seconds")
        query.awaitTermination()
        counts.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 150
    assert counts[-1] < 150  # the keys of the first steps are forgotten


class Handle:
    """A state store and timers for one group, with the number of calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def called(self, result=None):
        self.calls += 1
        return result

    def get(self):
        return self.called(self.value)

    def update(self, value):
        self.value = self.called(value)

    def clear(self):
        self.value = self.called()

    def registerTimer(self, at):
        self.called(self.timers.add(at))

    def deleteTimer(self, at):
        self.called(self.timers.remove(at))


def test_many_keys_cost_one_read_and_one_write(spark):
    handle, first = Handle(), KeepFirst(10_000, 1, ["number", "id"])
    first.init(handle)
    r, kept, last = random.Random(4), [], {}
    for arrival in range(3):
        handle.calls = 0
        rows = [(i, f"k{i % 200}" if i % 201 else None, 1000 * (10 * arrival + r.randint(0, 14)), i) for i in range(arrival * 1000, arrival * 1000 + 1000)]
        frame = pd.DataFrame([(n, key, at, o, key, 0) for n, key, at, o in rows], columns=["number", "id", "a", "b", "c", "d"], dtype=object)
        found = [int(n) for f in first.handleInputRows((0,), iter([frame[:300], frame[300:]]), None) for n in f["number"]]
        kept = []
        for n, key, at, _ in sorted(rows, key=lambda row: (row[2], row[3])):
            if key not in last or at >= last[key] + 10_000:
                kept.append(n)
                last[key] = at
        assert found == kept and handle.calls <= 4
        assert handle.timers == {min(last.values()) // 1000 + 10}
    # the timer drops the keys that are over and is set again for the others
    now = handle.timers.pop()
    first.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: now), SimpleNamespace(getExpiryTimeInMs=lambda: now))
    left = {key: at for key, at in last.items() if at // 1000 + 10 > now}
    assert dict(zip(*handle.value[:2], strict=True)) == left and handle.timers == {min(left.values()) // 1000 + 10}


def table_of(spark, tmp_path, buckets=8):
    schema = spark.createDataFrame([], "id string, value int").schema
    return BucketedTable(str(tmp_path / "table"), "id", schema, buckets)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def merge(target, log):
    return upsert_by_key(target, log, "id", [F.col("batch_id")])


def test_folds_touch_their_buckets_only(spark, tmp_path):
    table = table_of(spark, tmp_path)
    log = spark.createDataFrame([(str(i), i, 0) for i in range(200)], "id string, value int, batch_id long")
    assert table.fold(log, merge) == 0
    before = files(tmp_path / "table/data")
    assert len({os.path.dirname(f) for f in before}) == 8
    more = log.unionByName(spark.createDataFrame([("7", 70, 1), ("7", 77, 2)], log.schema))
    assert table.fold(more, merge) == 2
    after = files(tmp_path / "table/data")
    assert before.items() <= after.items()
    assert len({os.path.dirname(f) for f in after.keys() - before.keys()}) == 1
    assert dict(map(tuple, table.read(spark).collect())) == {str(i): 77 if i == 7 else i for i in range(200)}
    assert table.fold(more, merge) == 2 and files(tmp_path / "table/data") == after  # repeated: nothing to do
    table.vacuum(spark)
    left = files(tmp_path / "table/data")
    assert len(left) < len(after) and left.items() <= after.items()
    assert table.read(spark).count() == 200


def test_a_failed_fold_changes_nothing(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    log = spark.createDataFrame([(str(i), i, 0) for i in range(20)], "id string, value int, batch_id long")
    table.fold(log, merge)
    later = log.unionByName(spark.createDataFrame([("3", -3, 1), ("new", 1, 1)], log.schema))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("offerflow.operators.versions.commit", broken)
        with pytest.raises(RuntimeError):
            table.fold(later, merge)
    assert table.read(spark).count() == 20
    assert table.fold(later, merge) == 1
    assert dict(map(tuple, table.read(spark).collect()))["3"] == -3 and table.read(spark).count() == 21


def test_rows_without_a_key_are_spread_and_empty_tables_read(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.read(spark).collect() == []
    assert table.fold(spark.createDataFrame([], "id string, value int, batch_id long"), merge) == -1
    log = spark.createDataFrame([(None, i, 0) for i in range(100)], "id string, value int, batch_id long")
    table.fold(log, lambda target, new: target.unionByName(new.drop("batch_id")))
    assert table.read(spark).count() == 100
    assert len({os.path.dirname(f) for f in files(tmp_path / "table/data")}) > 4


def test_offers_that_the_batch_job_enriched_meanwhile(spark, tmp_path):
    offers = schemas.conform(spark.createDataFrame([(str(i), "Comptable", "x" * 80) for i in range(8)], "id string, title string, description string"), schemas.OFFERS)
    stored, found = str(tmp_path / "stored"), str(tmp_path / "found")

    def enriched(ids):
        rows = spark.createDataFrame([(i,) for i in ids], "offre_id string")
        schemas.conform(rows, schemas.ENRICHED).write.mode("append").parquet(stored)

    def run():
        arrivals = jobs.read_stream(spark, str(tmp_path / "in"), schemas.OFFERS)
        jobs.incremental_enrich(arrivals, found, str(tmp_path / "checkpoint"), AS_OF,
                                lambda: spark.read.schema(schemas.ENRICHED).parquet(stored)).awaitTermination()
        return sorted(r[0] for r in spark.read.schema(schemas.ENRICHED).parquet(found).select("offre_id").collect())

    enriched(["0"])
    offers.where("id < 3").unionByName(offers.where("id = 1")).write.parquet(str(tmp_path / "in"))
    assert run() == ["1", "2"]
    enriched(["4"])
    offers.where("id >= 2").write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == ["1", "2", "3", "5", "6", "7"]
