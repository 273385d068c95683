"""How the generic test tables stand in for market data, on both sides of the comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import bars

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Prices are cents by small integers, so values often end in a 5 at the seventh place, which engines
#: round differently; a small shift before rounding moves them off the tie on both sides.
SHIFT = 1.37e-7


def rounded(x: Column | str) -> Column:
    """Six places, and no negative zero."""
    return F.round((F.col(x) if isinstance(x, str) else x).cast("double") + SHIFT, 6) + F.lit(0.0)


def r(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE) + {SHIFT}, 6) + 0.0"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of suppliers: price of a line item is its extended price by its quantity."""
    li = table(spark, sf_dir, "lineitem")
    trades = li.select(F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").alias("ts"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("volume"), "l_orderkey", "l_linenumber", "l_partkey")
    return bars(trades, "Day", ["l_orderkey", "l_linenumber", "l_partkey", "price", "volume"])


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades from events: the user is the ticker, the value the price."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("ticker"), "ts", F.col("value").alias("price"), F.lit(1.0).alias("volume"), "event_id")


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(ticks(spark, sf_dir), "Minute", ["ts", "event_id"])


DAILY = """
t AS (SELECT l_suppkey AS ticker, l_shipdate AS ts, l_extendedprice / l_quantity AS price, l_quantity AS volume,
        l_orderkey AS o, l_linenumber AS n, l_partkey AS k FROM lineitem),
bars AS (SELECT ticker, date_trunc('day', ts) AS ts, first(price ORDER BY o, n, k, price, volume) AS open, max(price) AS high, min(price) AS low,
        last(price ORDER BY o, n, k, price, volume) AS close, sum(volume) AS volume FROM t GROUP BY 1, 2)"""

MINUTES = """
bars AS (SELECT user_id AS ticker, date_trunc('minute', ts) AS ts, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
        last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events WHERE value IS NOT NULL GROUP BY 1, 2)"""

#: Columns that several formulas need, so that no window stands inside another.
STEPS = """
x AS (SELECT *, lag(close) OVER w AS pc, lag(high, 2) OVER w AS h2, lag(low, 2) OVER w AS l2, CAST(ts AS DATE) AS day,
        date_diff('minute', CAST(CAST(ts AS DATE) AS TIMESTAMP), ts) - 570 AS minute FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ts)),
y AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, close - pc AS ch, ln(close / pc) AS lr,
        avg(close) OVER w5 AS ma5, count(close) OVER w5 AS n5, list(close) OVER w10 AS l10, count(close) OVER w10 AS n10 FROM x
        WINDOW w5 AS (PARTITION BY ticker ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), w10 AS (PARTITION BY ticker ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""

T = "(PARTITION BY ticker ORDER BY ts)"
SESSION = "(PARTITION BY ticker, day ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def win(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {win(n)} = {n} THEN {agg}({x}) OVER {win(n)} END"
