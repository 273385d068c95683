"""Queries that run the streams over the events table to their end and return what came out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming import feeds

from .common import MINUTES, r, register, rounded
from .lake import _folder


def _source(s: SparkSession, d: str) -> DataFrame:
    """events as a stream. The table may be one file, and a stream reads folders or patterns."""
    return s.readStream.schema(s.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/event[s].parquet")


def _finished(s: SparkSession, out: DataFrame) -> DataFrame:
    at = _folder(s)
    out.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start(f"{at}/out").awaitTermination()
    return s.read.schema(out.schema).parquet(f"{at}/out")


def _st1(s: SparkSession, d: str) -> DataFrame:
    feed = _source(s, d).select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("digest"), F.col("ts").cast("timestamp").alias("at"))
    with feeds.on_disk_state(s):
        out = feeds.absorbed(feed, time="at", forget_after="90 days")
        return _finished(s, out).select("seq", "supersedes")


register(
    "st1_absorb_feed",
    _st1,
    "SELECT seq, n > 1 AS supersedes FROM (SELECT event_id AS seq, event_type, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE before IS NULL OR before <> event_type",
)


def _st3(s: SparkSession, d: str) -> DataFrame:
    at = _folder(s)
    points = _source(s, d).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    feeds.append_points(points.unionByName(points), f"{at}/points", f"{at}/state", ["event_id"], "ts").awaitTermination()
    return s.read.parquet(f"{at}/points").select("event_id", "user_id")


register("st3_append_points", _st3, "SELECT event_id, user_id FROM events")


def _st4(s: SparkSession, d: str) -> DataFrame:
    points = _source(s, d).select(F.col("user_id").alias("ticker"), F.to_date("ts").cast("string").alias("timestamp"), "value", F.lit(None).cast("string").alias("available_at"))
    out = feeds.usable_points(points, "period_aggregate", "1d").groupBy("ticker", "available").agg(F.count("*").alias("n"))
    return _finished(s, out).select("ticker", F.date_format("available", "yyyy-MM-dd").alias("day"), "n")


# a day's points come out once the watermark, a day behind the last of them, has reached it
register("st4_available_points", _st4, "SELECT user_id AS ticker, strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1, 2")


def _st5(s: SparkSession, d: str) -> DataFrame:
    ticks = _source(s, d).select(F.col("user_id").alias("ticker"), "ts", F.col("value").alias("price"), F.lit(1.0).alias("volume"), "event_id")
    out = feeds.bars_from(ticks.withColumn("ts", F.col("ts").cast("timestamp")), "Hour", order=["ts", "event_id"])
    return _finished(s, out).select("ticker", F.col("ts").cast("timestamp_ntz").alias("ts"), *(rounded(c).alias(c) for c in _BAR))


_BAR = ("open", "high", "low", "close", "volume")
# bars that the watermark, ten minutes behind the last event, has passed
register("st5_bars_from_stream", _st5, f"WITH {MINUTES.replace(chr(39) + 'minute' + chr(39), chr(39) + 'hour' + chr(39))} SELECT ticker, ts, {', '.join(f'{r(c)} AS {c}' for c in _BAR)} FROM bars WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE")
