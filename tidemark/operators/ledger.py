"""State and recency from ledgers: fills, cash transactions, orders and app events, seen at clock rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof, days_between, minutes_between, running


def since(clock: DataFrame, events: DataFrame, keys: list[str], time: str, event_time: str, unit: str = "days", name: str = "since", strictly_before: bool = False) -> DataFrame:
    """clock with the days or minutes since the last event; null before the first.

    strictly_before: an event at the clock's own time isn't seen yet.
    """
    at = F.col(event_time).cast("timestamp") + F.expr("INTERVAL 1 MICROSECOND") if strictly_before else F.col(event_time)
    found = asof(clock, events.withColumn("__e", F.col(event_time)).withColumn("__v", at.cast(dict(clock.dtypes)[time])), keys, time, "__v", {"__last": F.col("__e")})
    apart = days_between(time, "__last") if unit == "days" else minutes_between(time, "__last")
    return found.withColumn(name, apart).drop("__last")


def matching(orders: DataFrame, **filters: object) -> DataFrame:
    """Rows that meet every filter that isn't None; lists mean any of, min_/max_ mean bounds."""
    for name, value in filters.items():
        if value is None:
            continue
        if name.startswith(("min_", "max_")):
            c = F.col(name[4:])
            orders = orders.where(c >= value if name.startswith("min_") else c <= value)
        else:
            orders = orders.where(F.col(name).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    return orders


def days_since_order(clock: DataFrame, orders: DataFrame, keys: list[str], time: str, order_time: str, order_status: str = "Filled", **filters: object) -> DataFrame:
    return since(clock, matching(orders, status=order_status, **filters), keys, time, order_time, "days")


def minutes_since_order(clock: DataFrame, orders: DataFrame, keys: list[str], time: str, order_time: str, order_status: str = "Filled", **filters: object) -> DataFrame:
    return since(clock, matching(orders, status=order_status, **filters), keys, time, order_time, "minutes")


def last_order_price(clock: DataFrame, orders: DataFrame, keys: list[str], time: str, order_time: str, side: str | None = None, order_status: str = "Filled") -> DataFrame:
    return asof(clock, matching(orders, status=order_status, side=side), keys, time, order_time, {"order_no": F.col("order_no"), "price": F.col("price")})


def sum_orders(clock: DataFrame, orders: DataFrame, keys: list[str], time: str, order_time: str, amount: Column, seconds: int, **filters: object) -> DataFrame:
    return running(clock, matching(orders, **filters), keys, time, order_time, {"value": amount}, seconds)


def positions(clock: DataFrame, fills: DataFrame, key: str = "ticker", time: str = "ts", fill_time: str = "filled_at", price: str = "close", span: str | None = None) -> DataFrame:
    """clock (a row for each ticker and time, with a price) with quantity, value, cash_flow and cost.

    fills: quantity (negative when sold) and price. cost: the position at the average price of all
    that was bought so far. span: as running() has it, for tickers with very many rows.
    """
    bought = F.when(F.col("quantity") > 0, F.col("quantity")).otherwise(0)
    totals = {"quantity": F.col("quantity"), "cash_flow": -F.col("quantity") * F.col("price"), "__in": bought, "__paid": bought * F.col("price")}
    out = running(clock, fills, [key], time, fill_time, totals, span=span)
    value = F.col("quantity") * F.col(price)
    return out.withColumn("value", value).withColumn("cost", F.try_divide(F.col("__paid"), F.col("__in")) * F.col("quantity")).drop("__in", "__paid")


def portfolio_values(held: DataFrame, initial_cash: float, time: str = "ts") -> DataFrame:
    """ts, buying_power, portfolio_value of positions() rows."""
    out = held.groupBy(time).agg((F.lit(initial_cash) + F.sum("cash_flow")).alias("buying_power"), F.sum("value").alias("held"))
    return out.select(time, "buying_power", (F.col("buying_power") + F.col("held")).alias("portfolio_value"))


def with_episodes(held: DataFrame, key: str = "ticker", time: str = "ts") -> DataFrame:
    """positions() rows with episode: how often the position has been opened, null while there is none."""
    w = Window.partitionBy(key).orderBy(time)
    opened = (F.col("quantity") != 0) & (F.coalesce(F.lag("quantity").over(w), F.lit(0)) == 0)
    number = F.sum(opened.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return held.withColumn("episode", F.when(F.col("quantity") != 0, number))


def worst_swing(value: str, keys: list[str], time: str, rise: bool = False) -> tuple[Column, Column]:
    """(running extreme, percent move from it) whose running maximum is the drawdown or draw-up."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    top = F.min(value).over(w) if rise else F.max(value).over(w)
    move = 100 * (F.try_divide(F.col(value), top) - 1)
    return top, F.coalesce(move if rise else -move, F.lit(0.0))
