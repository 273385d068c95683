"""Bars (open, high, low, close, volume) from trades, for batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Grains of bars. A window of n means n bars of the panel's grain.
GRAINS = {"Day": "1 day", "Hour": "1 hour", "Minute": "1 minute"}


def bars(trades: DataFrame, interval: str = "Day", order: list[str | Column] | None = None) -> DataFrame:
    """ticker, ts (start of the bar), open, high, low, close, volume of trades (ticker, ts, price, volume).

    One shuffle of partial aggregates. order: a total order of trades inside a bar, the default is
    (ts, price, volume). Trades without a price are ignored; an empty table gives no bars.
    """
    place = F.struct(*(order or ["ts", "price", "volume"]))
    bar = F.window("ts", GRAINS[interval])
    # a stream closes its bars by the whole window; a table's are told apart by the start
    bar, start = (bar.alias("bar"), "bar.start") if trades.isStreaming else (bar.start.alias("bar"), "bar")
    return (
        trades.where(F.col("price").isNotNull())
        .groupBy("ticker", bar)
        .agg(
            F.min_by("price", place).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", place).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("ticker", F.col(start).alias("ts"), "open", "high", "low", "close", "volume")
    )
