"""Queries of as-of series, memberships, availability rules, recency and portfolio state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import asof as A
from tidemark.operators import availability as V
from tidemark.operators import ledger as L

from .common import DAILY, MINUTES, T, daily, minutes, r, register, rounded, table


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A disclosed value of tickers, that is customers: an order's total, public on its date."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("ticker"), F.col("o_orderdate").alias("at")).agg(F.max("o_totalprice").alias("value"))


FACTS = "f AS (SELECT o_custkey AS ticker, o_orderdate AS seen, max(o_totalprice) AS value FROM orders GROUP BY 1, 2)"


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).select("ticker", "ts", "close")


DAYS = f"{DAILY}, b AS (SELECT ticker, ts, close FROM bars)"
CLOCK = f"{MINUTES}, c AS (SELECT ticker, ts FROM bars)"


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minutes(spark, sf_dir).select("ticker", "ts")


def events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(F.col("user_id").alias("ticker"), F.col("ts").alias("at"))


def _jn3(spark: SparkSession, sf_dir: str, span: str | None = None) -> DataFrame:
    return A.asof(days(spark, sf_dir), facts(spark, sf_dir), ["ticker"], "ts", "at", {"value": F.col("value")}, span=span).select("ticker", "ts", rounded("value").alias("value"))


_JN3 = f"WITH {DAYS}, {FACTS} SELECT b.ticker, b.ts, {r('f.value')} AS value FROM b ASOF LEFT JOIN f ON b.ticker = f.ticker AND b.ts >= f.seen"
register("jn3_fundamental", _jn3, _JN3)
register("jn3_fundamental_by_years", lambda spark, sf_dir: _jn3(spark, sf_dir, "year"), _JN3)


def _earnings(name: str, forward: bool) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = A.asof(clock(spark, sf_dir), events(spark, sf_dir, "view"), ["ticker"], "ts", "at", {"e": F.col("at")}, forward=forward)
        return out.select("ticker", "ts", (A.days_between("e", "ts") if forward else A.days_between("ts", "e")).alias("days"))

    e = "e AS (SELECT DISTINCT user_id AS ticker, ts AS seen FROM events WHERE event_type = 'view')"
    apart = "date_diff('day', CAST(c.ts AS DATE), CAST(e.seen AS DATE))" if forward else "date_diff('day', CAST(e.seen AS DATE), CAST(c.ts AS DATE))"
    register(name, query, f"WITH {CLOCK}, {e} SELECT c.ticker, c.ts, {apart} AS days FROM c ASOF LEFT JOIN e ON c.ticker = e.ticker AND c.ts {'<=' if forward else '>='} e.seen")


_earnings("jn4_days_until_earnings", True)
_earnings("jn5_days_since_earnings", False)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.to_timestamp_ntz(F.lit("1995-06-01 00:00:00")) + F.make_dt_interval(F.col("s_suppkey") % 50 * 10)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ticker"), start.alias("start"))
    return s.withColumn("end", F.when(F.col("ticker") % 2 == 1, F.col("start") + F.make_dt_interval(F.lit(700))))


def _jn6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.in_interval(daily(spark, sf_dir).select("ticker", "ts"), members(spark, sf_dir), "ticker", "ts")


MEMBERS = """m AS (SELECT s_suppkey AS ticker, TIMESTAMP '1995-06-01' + to_days(CAST(s_suppkey % 50 * 10 AS INT)) AS s,
    CASE WHEN s_suppkey % 2 = 1 THEN TIMESTAMP '1995-06-01' + to_days(CAST(s_suppkey % 50 * 10 + 700 AS INT)) END AS e FROM supplier)"""
register("jn6_is_index_member", _jn6, f"WITH {DAILY}, {MEMBERS} SELECT b.ticker, b.ts, (EXISTS (SELECT 1 FROM m WHERE m.ticker = b.ticker AND m.s <= b.ts AND (m.e IS NULL OR b.ts < m.e)))::INT AS member FROM bars b")


def _pf11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.select import universe

    return universe(daily(spark, sf_dir).select("ticker", "ts"), "SP500", members=members(spark, sf_dir).withColumn("index", F.lit("SP500")))


register("pf11_universe", _pf11, f"WITH {DAILY}, {MEMBERS} SELECT b.ticker, b.ts FROM bars b WHERE EXISTS (SELECT 1 FROM m WHERE m.ticker = b.ticker AND m.s <= b.ts AND (m.e IS NULL OR b.ts < m.e))")


def _pt2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.compound_growth(days(spark, sf_dir), facts(spark, sf_dir), 2, "ticker", "ts", "at", "value")
    return out.select("ticker", "ts", rounded("growth").alias("growth"))


register(
    "pt2_compound_annual_growth_rate",
    _pt2,
    f"""WITH {DAYS}, {FACTS}, n AS (SELECT b.*, f.value AS v1 FROM b ASOF LEFT JOIN f ON b.ticker = f.ticker AND b.ts >= f.seen),
    g AS (SELECT *, ts - INTERVAL 24 MONTH AS before FROM n), o AS (SELECT g.*, f.value AS v0 FROM g ASOF LEFT JOIN f ON g.ticker = f.ticker AND g.before >= f.seen)
    SELECT ticker, ts, {r('CASE WHEN v0 > 0 AND v1 > 0 THEN pow(v1 / v0, 1.0 / 2) - 1 END')} AS growth FROM o""",
)


def _calendar(name: str, metric: int) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        series = facts(spark, sf_dir).where(F.col("ticker") == metric)
        out = A.asof_calendar(daily(spark, sf_dir).select("ticker", "ts"), series, "ts", "at", {"value": F.col("value")})
        return out.select("ticker", "ts", rounded("value").alias("value"))

    register(name, query, f"WITH {DAILY}, {FACTS}, s AS (SELECT * FROM f WHERE ticker = {metric}) SELECT b.ticker, b.ts, {r('s.value')} AS value FROM bars b ASOF LEFT JOIN s ON b.ts >= s.seen")


_calendar("pt3_economic", 3)
_calendar("pt4_index", 4)


def _pt5(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = facts(spark, sf_dir).select("ticker", F.to_date("at").cast("string").alias("timestamp"), "value", F.lit(None).cast("string").alias("available_at"))
    known = V.availability(points, "period_aggregate", "1d").groupBy("ticker", "available").agg(F.max("value").alias("value"))
    known = known.withColumn("available", F.col("available").cast("timestamp_ntz"))
    return A.asof(days(spark, sf_dir), known, ["ticker"], "ts", "available", {"value": F.col("value")}).select("ticker", "ts", rounded("value").alias("value"))


register(
    "pt5_custom_indicator",
    _pt5,
    f"WITH {DAYS}, {FACTS}, k AS (SELECT ticker, CAST(CAST(seen AS DATE) + 1 AS TIMESTAMP) AS seen, max(value) AS value FROM f GROUP BY 1, 2) SELECT b.ticker, b.ts, {r('k.value')} AS value FROM b ASOF LEFT JOIN k ON b.ticker = k.ticker AND b.ts >= k.seen",
)


def _pt6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ticker"), F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("at")).agg(F.count("*").alias("score"))
    return A.asof(days(spark, sf_dir), scores, ["ticker"], "ts", "at", {"score": F.col("score")}).select("ticker", "ts", "score")


register("pt6_stock_report", _pt6, f"WITH {DAYS}, k AS (SELECT o_custkey AS ticker, date_trunc('month', o_orderdate) AS seen, count(*) AS score FROM orders GROUP BY 1, 2) SELECT b.ticker, b.ts, k.score FROM b ASOF LEFT JOIN k ON b.ticker = k.ticker AND b.ts >= k.seen")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose availability is missing, a date, or an instant, by the order's key."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    given = F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.date_add(day, (k % 5 - 1).cast("int")).cast("string")).otherwise(F.concat(F.date_add(day, (k % 4).cast("int")).cast("string"), F.lit("T06:30:00Z")))
    return o.select(k.alias("point"), day.cast("string").alias("timestamp"), F.col("o_totalprice").alias("value"), given.alias("available_at"))


POINTS = """p AS (SELECT o_orderkey AS point, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 1 AS INT) END AS ad,
    CASE WHEN o_orderkey % 3 = 2 THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INT) AS TIMESTAMP) + INTERVAL 390 MINUTE END AS ai FROM orders)"""
_TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _kind(name: str, kind: str, period: str | None, available: str, error: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = V.availability(_points(spark, sf_dir), kind, period)
        return out.select("point", F.date_format("available", "yyyy-MM-dd HH:mm:ss").alias("available"), F.col("error").isNotNull().alias("wrong"))

    register(name, query, f"WITH {POINTS} SELECT point, CASE WHEN NOT ({error}) THEN {_TEXT.format(available)} END AS available, {error} AS wrong FROM p")


_TS = "CAST({} AS TIMESTAMP)"
def _fields(s: SparkSession, d: str) -> DataFrame:
    """Each event as the fields of a point, named now one way, now the other, some with a field too many or too few."""
    i, day = F.col("event_id"), F.to_date("ts").cast("string")
    fields = F.create_map(
        *(F.lit("timestamp"), F.when(i % 17 != 0, day)),
        *(F.lit("value"), F.when(i % 19 != 0, F.col("user_id").cast("string"))),
        *(F.when(i % 2 == 0, "assetType").otherwise("asset_type"), F.col("event_type")),
        *(F.when(i % 23 == 0, "note").when(i % 3 == 0, "availableAt").otherwise("available_at"), F.when(i % 5 != 0, day)),
    )
    return table(s, d, "events").select("event_id", fields.alias("fields"))


register(
    "pt8_points_of_fields",
    lambda s, d: V.points_of(_fields(s, d), "fields").drop("fields"),
    """SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN day END AS timestamp, CASE WHEN event_id % 19 <> 0 THEN CAST(user_id AS VARCHAR) END AS value, CAST(NULL AS VARCHAR) AS ticker, event_type AS asset_type,
        CASE WHEN event_id % 23 <> 0 AND event_id % 5 <> 0 THEN day END AS available_at,
        CASE WHEN event_id % 23 = 0 THEN 'unknown field note' WHEN event_id % 17 = 0 THEN 'no timestamp' WHEN event_id % 19 = 0 THEN 'no value' END AS error
    FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)""",
)
_kind("pt7_observation", "observation", None, "coalesce(CASE WHEN ad = d THEN CAST(d AS TIMESTAMP) ELSE CAST(ad + 1 AS TIMESTAMP) END, ai, CAST(d AS TIMESTAMP))", "coalesce(coalesce(ad, CAST(ai AS DATE)) > d, false)")
_kind("pt7_disclosed", "disclosed", None, "coalesce(CAST(ad + 1 AS TIMESTAMP), ai)", "(ad IS NULL AND ai IS NULL)")
_kind("pt7_period_1d", "period_aggregate", "1d", "coalesce(CAST(ad + 1 AS TIMESTAMP), ai, CAST(d + 1 AS TIMESTAMP))", "coalesce(coalesce(CAST(ad + 1 AS TIMESTAMP), ai) < CAST(d + 1 AS TIMESTAMP), false)")
_kind("pt7_period_1w", "period_aggregate", "1w", "coalesce(CAST(ad + 1 AS TIMESTAMP), ai, CAST(d + 7 AS TIMESTAMP))", "(isodow(d) <> 1 OR coalesce(coalesce(CAST(ad + 1 AS TIMESTAMP), ai) < CAST(d + 7 AS TIMESTAMP), false))")
_kind("pt7_period_1mo", "period_aggregate", "1mo", "coalesce(CAST(ad + 1 AS TIMESTAMP), ai, CAST(d + INTERVAL 1 MONTH AS TIMESTAMP))", "(day(d) <> 1 OR coalesce(coalesce(CAST(ad + 1 AS TIMESTAMP), ai) < CAST(d + INTERVAL 1 MONTH AS TIMESTAMP), false))")
_kind("pt7_period_1q", "period_aggregate", "1q", "coalesce(CAST(ad + 1 AS TIMESTAMP), ai, CAST(d + INTERVAL 3 MONTH AS TIMESTAMP))", "(day(d) <> 1 OR month(d) NOT IN (1, 4, 7, 10) OR coalesce(coalesce(CAST(ad + 1 AS TIMESTAMP), ai) < CAST(d + INTERVAL 3 MONTH AS TIMESTAMP), false))")


def _pt9(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir)
    return p.select("point", V.date_only("available_at").isNotNull().alias("is_date"), F.date_format(V.utc_instant("available_at"), "yyyy-MM-dd HH:mm:ss").alias("instant"))


register("pt9_date_or_instant", _pt9, f"WITH {POINTS} SELECT point, ad IS NOT NULL AS is_date, {_TEXT.format('coalesce(CAST(ad AS TIMESTAMP), ai)')} AS instant FROM p")


def _pt10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("point", F.date_format(V.normalized_availability("available_at"), "yyyy-MM-dd HH:mm:ss").alias("available"))


register("pt10_date_only_availability", _pt10, f"WITH {POINTS} SELECT point, {_TEXT.format('coalesce(CAST(ad + 1 AS TIMESTAMP), ai)')} AS available FROM p")


def _pt11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.read_series(facts(spark, sf_dir).withColumn("series", F.lit("totals")), "totals", 3, "at").select("ticker", F.col("at").alias("seen"), rounded("value").alias("value"))


register("pt11_read_series", _pt11, f"WITH {FACTS} SELECT ticker, seen, {r('value')} AS value FROM f WHERE ticker = 3")


# -- orders, transactions, app events ------------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "Filled").when(F.col("o_orderstatus") == "O", "Pending").otherwise("Partially Filled")
    return o.select(
        F.col("o_custkey").alias("ticker"), F.col("o_orderdate").alias("at"), k.alias("order_no"), F.col("o_totalprice").alias("price"), (k % 5 + 1).alias("quantity"), status.alias("status"),
        F.when(F.col("o_orderpriority") < "3", "Buy").otherwise("Sell").alias("side"), F.when(k % 2 == 0, "call").otherwise("put").alias("option_type"), F.when(k % 3 == 0, "open").otherwise("close").alias("position_effect"),
        F.when(k % 4 == 0, "vertical").otherwise("custom").alias("spread_type"), (k % 60).alias("dte"), F.when(k % 7 == 0, "rebalance_option").otherwise("order").alias("kind"), F.when(k % 5 < 3, "long").otherwise("short").alias("direction"),
    )


ORDERS = """q AS (SELECT o_custkey AS ticker, o_orderdate AS seen, o_orderkey AS order_no, o_totalprice AS price, o_orderkey % 5 + 1 AS quantity,
    CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Pending' ELSE 'Partially Filled' END AS status, CASE WHEN o_orderpriority < '3' THEN 'Buy' ELSE 'Sell' END AS side,
    CASE WHEN o_orderkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, CASE WHEN o_orderkey % 3 = 0 THEN 'open' ELSE 'close' END AS position_effect,
    CASE WHEN o_orderkey % 4 = 0 THEN 'vertical' ELSE 'custom' END AS spread_type, o_orderkey % 60 AS dte, CASE WHEN o_orderkey % 7 = 0 THEN 'rebalance_option' ELSE 'order' END AS kind FROM orders)"""


def _recency(name: str, source: Callable[[SparkSession, str], DataFrame], ledger: Callable[[SparkSession, str], DataFrame], unit: str, cte: str, rows: str, where: str, strictly: bool = False) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = L.since(source(spark, sf_dir), ledger(spark, sf_dir), ["ticker"], "ts", "at", unit, "since", strictly)
        return out.select("ticker", "ts", (rounded("since") if unit == "minutes" else F.col("since")).alias("since"))

    e = f"e AS (SELECT DISTINCT ticker, seen FROM {where})"
    apart = r("date_diff('microsecond', e.seen, c.ts) / 60000000.0") if unit == "minutes" else "date_diff('day', CAST(e.seen AS DATE), CAST(c.ts AS DATE))"
    register(name, query, f"WITH {cte}, {e} SELECT c.ticker, c.ts, {apart} AS since FROM {rows} c ASOF LEFT JOIN e ON c.ticker = e.ticker AND c.ts {'>' if strictly else '>='} e.seen")


_DO = f"{DAYS}, {ORDERS}"
_buy = lambda s, d: L.matching(orders(s, d), status="Filled", side="Buy")
_opt = lambda s, d: L.matching(orders(s, d), status="Filled", option_type="call", spread_type="vertical", position_effect="open", min_dte=5, max_dte=50)
_reb = lambda s, d: L.matching(orders(s, d), status="Filled", kind="rebalance_option")
_BUY, _OPT = "q WHERE status = 'Filled' AND side = 'Buy'", "q WHERE status = 'Filled' AND option_type = 'call' AND spread_type = 'vertical' AND position_effect = 'open' AND dte BETWEEN 5 AND 50"
_recency("ps9_days_since_order", days, _buy, "days", _DO, "b", _BUY)
_recency("ps10_minutes_since_order", days, _buy, "minutes", _DO, "b", _BUY)
_recency("ps11_days_since_option_order", days, _opt, "days", _DO, "b", _OPT)
_recency("ps12_minutes_since_option_order", days, _opt, "minutes", _DO, "b", _OPT)
_recency("ps13_days_since_last_rebalance_option_order", days, _reb, "days", _DO, "b", "q WHERE status = 'Filled' AND kind = 'rebalance_option'")
_app = lambda kind: (lambda s, d: events(s, d, kind))
_APP = "(SELECT user_id AS ticker, ts AS seen FROM events WHERE event_type = '{}')"
_recency("ps14_days_since_transaction", clock, _app("signup"), "days", CLOCK, "c", _APP.format("signup"))
_recency("ps15_days_since_alert", clock, _app("error"), "days", CLOCK, "c", _APP.format("error"))
_recency("ps16_minutes_since_alert", clock, _app("error"), "minutes", CLOCK, "c", _APP.format("error"))
_recency("ps17_days_since_agent", clock, _app("click"), "days", CLOCK, "c", _APP.format("click"))
_recency("ps18_minutes_since_agent", clock, _app("click"), "minutes", CLOCK, "c", _APP.format("click"))
_fired = lambda s, d: clock(s, d).where(F.hour("ts") < 6).select("ticker", F.col("ts").alias("at"))
_recency("ps19_days_since_strategy_fired", clock, _fired, "days", CLOCK, "c", "(SELECT ticker, ts AS seen FROM c WHERE hour(ts) < 6)", True)


def _ps8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.last_order_price(days(spark, sf_dir), orders(spark, sf_dir), ["ticker"], "ts", "at", side="Buy").select("ticker", "ts", rounded("price").alias("price"))


register("ps8_last_order_price", _ps8, f"WITH {_DO}, e AS (SELECT ticker, seen, arg_max(price, order_no) AS price FROM {_BUY} GROUP BY 1, 2) SELECT b.ticker, b.ts, {r('e.price')} AS price FROM b ASOF LEFT JOIN e ON b.ticker = e.ticker AND b.ts >= e.seen")


def _sum_orders(name: str, amount: Callable[[], Column], sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = L.sum_orders(days(spark, sf_dir), orders(spark, sf_dir), ["ticker"], "ts", "at", amount(), 30 * 86_400, status="Filled", side="Buy")
        return out.select("ticker", "ts", rounded("value").alias("value"))

    register(name, query, f"WITH {_DO}, e AS (SELECT * FROM {_BUY}) SELECT b.ticker, b.ts, {r(f'coalesce((SELECT sum({sql}) FROM e WHERE e.ticker = b.ticker AND e.seen <= b.ts AND e.seen >= b.ts - INTERVAL 30 DAY), 0)')} AS value FROM b")


_sum_orders("ag14_sum_order_amount", lambda: F.col("quantity") * F.col("price"), "quantity * price")
_sum_orders("ag15_sum_order_quantity", lambda: F.col("quantity"), "quantity")


# -- positions -----------------------------------------------------------------------------------


def held(spark: SparkSession, sf_dir: str, span: str | None = None) -> DataFrame:
    fills = L.matching(orders(spark, sf_dir), status="Filled").select("ticker", F.col("at").alias("filled_at"), F.when(F.col("side") == "Buy", F.col("quantity")).otherwise(-F.col("quantity")).alias("quantity"), (F.col("price") / 1000).alias("price"))
    return L.positions(days(spark, sf_dir), fills, span=span)


HELD = f"""{_DO}, fl AS (SELECT ticker, seen, CASE WHEN side = 'Buy' THEN quantity ELSE -quantity END AS quantity, price / 1000 AS price FROM q WHERE status = 'Filled'),
    hh AS (SELECT b.ticker, b.ts, b.close, coalesce(sum(fl.quantity), 0) AS quantity, coalesce(sum(-fl.quantity * fl.price), 0) AS cash_flow,
        sum(CASE WHEN fl.quantity > 0 THEN fl.quantity * fl.price END) / sum(CASE WHEN fl.quantity > 0 THEN fl.quantity END) AS average FROM b LEFT JOIN fl ON fl.ticker = b.ticker AND fl.seen <= b.ts GROUP BY 1, 2, 3),
    h AS (SELECT *, quantity * close AS value, average * quantity AS cost FROM hh),
    pv AS (SELECT ts, 100000 + sum(cash_flow) AS buying_power, 100000 + sum(cash_flow) + sum(value) AS portfolio_value FROM h GROUP BY 1)"""


def _ps(name: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    register(name, lambda spark, sf_dir: build(held(spark, sf_dir)), f"WITH {HELD} {sql}")


_pv = lambda h: L.portfolio_values(h, 100_000)
_ps("ps1_portfolio_value", lambda h: _pv(h).select("ts", rounded("portfolio_value").alias("value")), f"SELECT ts, {r('portfolio_value')} AS value FROM pv")
register(
    "ps1_portfolio_value_by_years",
    lambda spark, sf_dir: _pv(held(spark, sf_dir, "year")).select("ts", rounded("portfolio_value").alias("value")),
    f"WITH {HELD} SELECT ts, {r('portfolio_value')} AS value FROM pv",
)
_ps("ps2_buying_power", lambda h: _pv(h).select("ts", rounded("buying_power").alias("value")), f"SELECT ts, {r('buying_power')} AS value FROM pv")
_ps("ps3_initial_value", lambda h: _pv(h).agg(rounded(F.min_by("portfolio_value", "ts")).alias("value")), f"SELECT {r('arg_min(portfolio_value, ts)')} AS value FROM pv")
_ps("ps4_position_value", lambda h: h.where("ticker in (1, 2, 3)").groupBy("ts").agg(rounded(F.sum("value")).alias("value")), f"SELECT ts, {r('sum(value)')} AS value FROM h WHERE ticker IN (1, 2, 3) GROUP BY 1")
_ps("ps5_position_percent_change", lambda h: h.select("ticker", "ts", rounded(100 * (F.try_divide("value", "cost") - 1)).alias("value")), f"SELECT ticker, ts, {r('100 * (value / nullif(cost, 0) - 1)')} AS value FROM h")


def _swing(h: DataFrame, rise: bool) -> DataFrame:
    e = L.with_episodes(h).where("episode is not null").withColumn("worth", F.abs("value"))
    move = L.worst_swing("worth", ["ticker", "episode"], "ts", rise)[1]
    w = Window.partitionBy("ticker", "episode").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumn("move", move).select("ticker", "ts", rounded(F.max("move").over(w)).alias("value"))


def _swing_sql(rise: bool) -> str:
    fall = "100 * (worth / min(worth) OVER w - 1)" if rise else "100 * (1 - worth / max(worth) OVER w)"
    return f""", o AS (SELECT *, (quantity <> 0 AND coalesce(lag(quantity) OVER {T}, 0) = 0)::INT AS opened FROM h), g AS (SELECT *, sum(opened) OVER {T} AS episode, abs(value) AS worth FROM o),
        d AS (SELECT *, {fall} AS move FROM g WHERE quantity <> 0 WINDOW w AS (PARTITION BY ticker, episode ORDER BY ts))
        SELECT ticker, ts, {r('max(move) OVER (PARTITION BY ticker, episode ORDER BY ts)')} AS value FROM d"""


register("ps6_position_max_drawdown", lambda s, d: _swing(held(s, d), False), f"WITH {HELD}{_swing_sql(False)}")
register("ps7_position_max_drawup", lambda s, d: _swing(held(s, d), True), f"WITH {HELD}{_swing_sql(True)}")
