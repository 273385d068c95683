"""Streams: event feeds delivered once, bars from ticks, points used only when available, idempotent appends.

Each works on a streaming DataFrame; the batch forms are in operators.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidemark.operators.availability import availability
from tidemark.operators.bars import bars


_STORE = "spark.sql.streaming.stateStore.providerClass"


class _Absorb(StatefulProcessor):
    """An id's last digest, until its timer runs out."""

    def __init__(self, order: str, digest: str, key: str, time: str | None, forget_ms: int) -> None:
        self.order, self.digest, self.key, self.time, self.forget_ms = order, digest, key, time, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "digest string, until bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.last.exists()
        last, until = self.last.get() if known else (None, None)
        batch = pd.concat(list(rows)).sort_values(self.order)  # one id's rows of one micro-batch
        now = batch[self.digest].astype(object).where(batch[self.digest].notna(), None)
        new = [a != b for a, b in zip(now, [last, *now[:-1]], strict=True)]
        new[0] |= not known
        if self.time is not None:
            newest = int(batch[self.time].max().timestamp() * 1000)
            later = max(newest, timerValues.getCurrentWatermarkInMs(), (until or 0) - self.forget_ms) + self.forget_ms
            if later != until:
                if until is not None:
                    self.handle.deleteTimer(until)
                self.handle.registerTimer(later)
            until = later
        self.last.update((now.iloc[-1], until))
        out = batch.assign(**{self.key: key[0], "supersedes": [known] + [True] * (len(batch) - 1)})[new]
        yield out[[self.key, self.order, self.digest, "supersedes"]]

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def absorbed(feed: DataFrame, key: str = "id", order: str = "seq", digest: str = "digest", time: str | None = None, late: str = "10 minutes", forget_after: str = "7 days") -> DataFrame:
    """An at-least-once feed (id, seq, digest) once: rows whose digest is their id's last one go, other
    digests of a known id supersede. With a time column, an id whose last row is forget_after older than
    the watermark is forgotten, and would be delivered anew; without one, ids are kept for good.

    The state of an id is one value and one timer, in a store on the executors' disks: call this and start
    the query inside on_disk_state(). A session whose store is in memory has no timers for single keys;
    there the same is done with a timeout for each id.
    """
    if "RocksDB" not in feed.sparkSession.conf.get(_STORE):
        return _absorbed_in_memory(feed, key, order, digest, time, late, forget_after)
    types = dict(feed.dtypes)
    schema = f"{key} {types[key]}, {order} {types[order]}, {digest} {types[digest]}, supersedes boolean"
    processor = _Absorb(order, digest, key, time, int(pd.Timedelta(forget_after).total_seconds() * 1000))
    feed = feed if time is None else feed.withWatermark(time, late)
    return feed.groupBy(key).transformWithStateInPandas(processor, schema, "append", "none" if time is None else "eventTime")


def _absorbed_in_memory(feed: DataFrame, key: str, order: str, digest: str, time: str | None, late: str, forget_after: str) -> DataFrame:
    types = dict(feed.dtypes)
    ms = int(pd.Timedelta(forget_after).total_seconds() * 1000)

    def absorb(ids: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = state.exists
        rows = pd.concat(list(frames)).sort_values(order)  # one id's rows of one micro-batch
        now = rows[digest].astype(object).where(rows[digest].notna(), None)
        before = [state.get[0] if known else None, *now[:-1]]
        new = [a != b for a, b in zip(now, before, strict=True)]
        new[0] |= not known
        state.update((now.iloc[-1],))
        if time is not None:
            newest = int(rows[time].max().timestamp() * 1000)
            state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + ms)
        out = rows.assign(**{key: ids[0], "supersedes": [known] + [True] * (len(rows) - 1)})[new]
        yield out[[key, order, digest, "supersedes"]]

    schema = f"{key} {types[key]}, {order} {types[order]}, {digest} {types[digest]}, supersedes boolean"
    timeout = GroupStateTimeout.NoTimeout if time is None else GroupStateTimeout.EventTimeTimeout
    feed = feed if time is None else feed.withWatermark(time, late)
    return feed.groupBy(key).applyInPandasWithState(absorb, schema, "last string", "append", timeout)


@contextmanager
def on_disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, as operators with timers need; the setting comes back after."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def bars_from(ticks: DataFrame, interval: str = "Minute", late: str = "10 minutes", order: list | None = None) -> DataFrame:
    """Bars of a stream of trades (ticker, ts, price, volume); in append mode a bar comes out, and its
    state goes, when the watermark has passed its end."""
    return bars(ticks.withWatermark("ts", late), interval, order)


def usable_points(points: DataFrame, kind: str, period: str | None = None, late: str = "1 day") -> DataFrame:
    """Points with their availability as event time; points that break a rule are left out."""
    return availability(points, kind, period).where("error is null").withWatermark("available", late)


def append_points(points: DataFrame, path: str, checkpoint: str, columns: list[str], time: str, late: str = "1 day"):  # noqa: ANN201
    """Starts a query that appends points to path once each: repeats within the watermark are dropped,
    and a batch that runs again after a failure writes to the folder of its number again."""
    once = points.withWatermark(time, late).dropDuplicatesWithinWatermark(columns)

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def from_cursor(feed: DataFrame, cursor: int, order: str = "seq") -> DataFrame:
    """Rows after a cursor; a stream's own checkpoint does the same for restarts."""
    return feed.where(F.col(order) > cursor)
