"""Feeds with a value and a timer for each id: expiry, restarts and nulls."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest

from tidemark.operators import quality as Q
from tidemark.streaming import feeds

SCHEMA = "id string, seq long, digest string, at timestamp"


class Feed:
    """A folder that a stream reads a file at a time, in the order of adding."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0
        os.makedirs(f"{path}/in")

    def add(self, *rows):
        made = f"{self.path}/made{self.n}"
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.parquet(made)
        part = next(f for f in os.listdir(made) if f.endswith(".parquet"))
        os.rename(f"{made}/{part}", f"{self.path}/in/{self.n}.parquet")
        os.utime(f"{self.path}/in/{self.n}.parquet", (time.time() + self.n - 1000,) * 2)
        self.n += 1

    def absorb(self, **options):
        """What the query has given so far, after running to the end of what is there."""
        with feeds.on_disk_state(self.spark):
            stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")
            out = feeds.absorbed(stream, **options)
            assert "TransformWithState" in out._jdf.queryExecution().analyzed().toString()
            out.writeStream.format("parquet").option("checkpointLocation", f"{self.path}/state").outputMode("append").trigger(availableNow=True).start(f"{self.path}/out").awaitTermination()
        return sorted((r["seq"], r["supersedes"]) for r in self.spark.read.schema("id string, seq long, digest string, supersedes boolean").parquet(f"{self.path}/out").collect())


def at(day):
    return dt.datetime(2024, 1, day, 12)


@pytest.mark.parametrize(("forget", "want"), [("7 days", [0, 1, 2, 3]), ("60 days", [0, 1, 2])])
def test_state_expires(spark, tmp_path, forget, want):
    f = Feed(spark, tmp_path)
    for k, (i, day) in enumerate([("a", 1), ("b", 20), ("c", 21), ("a", 22), ("a", 23)]):
        f.add((i, k, "same", at(day)))
    assert f.absorb(time="at", forget_after=forget) == [(k, False) for k in want]


def test_newer_rows_put_the_timer_off(spark, tmp_path):
    f = Feed(spark, tmp_path)
    for k, day in enumerate([1, 5, 9, 13, 17]):
        f.add(("a", 2 * k, "same", at(day)), ("b", 2 * k + 1, f"d{k}", at(day)))
    assert f.absorb(time="at", forget_after="6 days") == [(0, False), (1, False), (3, True), (5, True), (7, True), (9, True)]


def test_a_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    f = Feed(spark, tmp_path)
    f.add(("a", 0, "x", at(1)), ("b", 1, None, at(1)), (None, 2, "n", at(1)))
    first = f.absorb(time="at", forget_after="30 days")
    assert first == [(0, False), (1, False), (2, False)]
    assert f.absorb(time="at", forget_after="30 days") == first  # nothing new
    f.add(("a", 3, "x", at(2)), ("a", 4, "y", at(2)), ("b", 5, None, at(2)), ("b", 6, "z", at(2)), (None, 7, "n", at(2)), ("c", 8, "c", at(2)))
    assert f.absorb(time="at", forget_after="30 days") == [*first, (4, True), (6, True), (8, False)]


def test_without_a_time_ids_are_kept(spark, tmp_path):
    f, rows = Feed(spark, tmp_path), [("a", 0, "x", at(1)), ("a", 1, "y", at(2)), ("b", 2, "x", None), ("a", 3, "y", at(30)), ("a", 4, "x", at(30))]
    for r in rows:
        f.add(r)
    batch = Q.absorbed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert f.absorb() == sorted((r["seq"], r["supersedes"]) for r in batch)
