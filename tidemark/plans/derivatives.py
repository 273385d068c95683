"""Queries of option chains, spreads, volatility and positions."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import indicators as I
from tidemark.operators import evaluate as E
from tidemark.operators import options as O
from tidemark.operators import select as K

from .common import DAILY, STEPS, T, daily, full, r, register, rounded, table


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of a contract for each part: its price is the strike, its size the days to expiration."""
    k, strike, spot = F.col("p_partkey"), F.col("p_retailprice"), 1000 + 10 * F.col("d") + 3 * F.col("underlying")
    p = table(spark, sf_dir, "part").withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("underlying", k % 7)
    first, call = F.to_date(F.lit("2024-01-01")), k % 2 == 0
    bid = 5 + k % 20 * 0.5
    return p.select(
        "underlying", F.date_add(first, F.col("d")).alias("ts"), F.date_add(first, F.col("p_size") + 10).alias("expiration"), strike.alias("strike"), F.when(call, "call").otherwise("put").alias("option_type"), spot.alias("spot"),
        bid.alias("bid"), (bid + 0.1 * (k % 7 + 1)).alias("ask"), (0.2 + k % 50 / 250 + F.col("d") * 0.01).alias("iv"), F.when(k % 17 != 0, F.when(call, 0.5).otherwise(-0.5) - (strike - spot) / 2000).alias("delta"), (k % 100).alias("open_interest"), k.alias("k"), "d",
    )


CHAIN = """ch AS (SELECT *, CASE WHEN k % 17 <> 0 THEN CASE WHEN k % 2 = 0 THEN 0.5 ELSE -0.5 END - (strike - spot) / 2000 END AS delta, date_diff('day', ts, expiration) AS days FROM (
    SELECT p_partkey % 7 AS underlying, DATE '2024-01-01' + CAST(d AS INT) AS ts, DATE '2024-01-01' + p_size + 10 AS expiration, p_retailprice AS strike, CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_type,
        1000 + 10 * d + 3 * (p_partkey % 7) AS spot, 5 + p_partkey % 20 * 0.5::DOUBLE AS bid, 5 + p_partkey % 20 * 0.5::DOUBLE + 0.1::DOUBLE * (p_partkey % 7 + 1) AS ask, 0.2::DOUBLE + p_partkey % 50 / 250.0::DOUBLE + d * 0.01::DOUBLE AS iv, p_partkey % 100 AS open_interest, p_partkey AS k, d
    FROM part, (SELECT unnest(range(0, 10)) AS d)))"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = chain(spark, sf_dir), F.col("k")
    value = (F.col("bid") + F.col("ask")) / 2 + F.col("d") * (k % 5 - 2) * 0.3
    return c.where(k % 3 == 0).select(
        (k % 500).alias("spread_id"), "underlying", "ts", "expiration", "strike", "option_type", F.when(k % 5 < 3, "long").otherwise("short").alias("direction"), F.when(k % 4 == 0, "vertical").otherwise("custom").alias("spread_type"),
        value.alias("value"), ((F.col("bid") + F.col("ask")) / 2 - (k % 9 - 4) * 0.7).alias("cost"), (F.col("strike") * 0.2).alias("collateral"), F.date_add(F.to_date(F.lit("2024-01-01")), -(k % 30).cast("int")).alias("opened"), (1 + k % 4).alias("quantity"), "delta", "iv", "k",
    )


POS = f"""{CHAIN}, po AS (SELECT k % 500 AS spread_id, underlying, ts, expiration, strike, option_type, CASE WHEN k % 5 < 3 THEN 'long' ELSE 'short' END AS direction, CASE WHEN k % 4 = 0 THEN 'vertical' ELSE 'custom' END AS spread_type,
    (bid + ask) / 2 + d * (k % 5 - 2) * 0.3::DOUBLE AS value, (bid + ask) / 2 - (k % 9 - 4) * 0.7::DOUBLE AS cost, strike * 0.2::DOUBLE AS collateral, DATE '2024-01-01' - CAST(k % 30 AS INT) AS opened, 1 + k % 4 AS quantity, delta, iv, k, days FROM ch WHERE k % 3 = 0),
    pp AS (SELECT *, date_diff('day', opened, ts) AS held, 100 * (value - cost) / nullif(abs(cost), 0) AS pnl FROM po)"""

_IV = """at AS (SELECT *, row_number() OVER (PARTITION BY underlying, ts, expiration ORDER BY abs(strike - spot), strike, option_type) AS n FROM ch WHERE days > 0),
    pt AS (SELECT underlying, ts, max(days) FILTER (days <= 30) AS dl, min(days) FILTER (days >= 30) AS dh, arg_max(iv * iv * days, days) FILTER (days <= 30) AS tl, arg_min(iv * iv * days, days) FILTER (days >= 30) AS th FROM at WHERE n = 1 GROUP BY 1, 2),
    iv AS (SELECT underlying, ts, sqrt(CASE WHEN dl IS NULL THEN th / dh WHEN dh IS NULL THEN tl / dl WHEN dl = dh THEN tl / dl ELSE (tl + (th - tl) * (30 - dl) / (dh - dl)) / 30 END) AS iv FROM pt)""".replace("at AS", "am AS").replace("FROM at", "FROM am")
register("opt1_implied_volatility", lambda s, d: O.implied_volatility(chain(s, d)).select("underlying", "ts", rounded("iv").alias("iv")), f"WITH {CHAIN}, {_IV} SELECT underlying, ts, {r('iv')} AS iv FROM iv")


def _vol(name: str, node: I.Indicator, expr: str) -> None:
    """A volatility measure over daily bars: the relative range of a bar stands in for its implied volatility."""
    base = lambda s, d: daily(s, d).withColumn("iv", F.round((F.col("high") - F.col("low")) / F.col("close"), 6))
    register(name, lambda s, d: I.evaluate(base(s, d), value=node).select("ticker", "ts", rounded("value").alias("value")), f"WITH {DAILY}, {STEPS}, v AS (SELECT *, round((high - low) / close, 6) AS iv FROM y), v2 AS (SELECT *, list(iv) OVER w AS li, count(iv) OVER w AS ni FROM v WINDOW w AS (PARTITION BY ticker ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) SELECT ticker, ts, {r(expr)} AS value FROM v2")


_X = I.Volume(metric="iv")
_lo, _hi = full("min", "iv", 20), full("max", "iv", 20)
_vol("opt2_iv_rank", O.iv_rank(_X, 20), f"100 * (iv - ({_lo})) / nullif(({_hi}) - ({_lo}), 0)")
_vol("opt3_iv_percentile", O.iv_percentile(_X, 20), "CASE WHEN ni = 20 THEN 100.0 * len(list_filter(li, lambda q: q < iv)) / 20 END")
_vol("opt4_iv_hv_ratio", O.iv_hv_ratio(_X, 20), f"iv / nullif(({full('stddev_samp', 'lr', 20)}) * sqrt(252), 0)")

_CALL = O.Leg("call", "long", 20, 45, 2.0, bounds={"open_interest": (5, None)})
_PUT = O.Leg("put", "short", 10, 60, -0.45, "delta", "farthest", fallback=("percent", 5.0))
_DOLLAR = O.Leg("call", "short", 20, 45, 60.0, "dollars", "middle", 2, max_spread_percent=6.0)


def _pick(where: str, order: str, keys: str = "") -> str:
    return f"SELECT {keys}underlying, ts, expiration, strike, (bid + ask) / 2 AS mid FROM (SELECT *, row_number() OVER (PARTITION BY {keys}underlying, ts ORDER BY {order}) AS n FROM ch{', g' if keys else ''} WHERE {where}) WHERE n = 1"


_CALLS = _pick("option_type = 'call' AND days BETWEEN 20 AND 45 AND open_interest >= 5", "days, expiration, abs(strike - spot * 1.02), strike")
_PUTS = _pick("option_type = 'put' AND days BETWEEN 10 AND 60", "(delta IS NULL)::INT, -days, expiration, coalesce(abs(delta + 0.45), abs(strike - spot * 0.95)), strike")
_DOLLARS = _pick("option_type = 'call' AND days BETWEEN 20 AND 45 AND 100 * (ask - bid) / ((bid + ask) / 2) <= 6", "abs(2 * days - 65), expiration, abs(strike - (spot + 60)), strike")
for _name, _leg, _sql in (("opt5_leg_percent", _CALL, _CALLS), ("opt5_leg_delta", _PUT, _PUTS), ("opt5_leg_dollars", _DOLLAR, _DOLLARS)):
    register(_name, lambda s, d, leg=_leg: O.select_leg(chain(s, d), leg).select("underlying", "ts", "expiration", rounded("strike").alias("strike")), f"WITH {CHAIN} SELECT underlying, ts, expiration, {r('strike')} AS strike FROM ({_sql})")


def _spread_rows(df: DataFrame) -> DataFrame:
    return df.select("underlying", "ts", F.size("legs").alias("legs"), rounded(F.get("legs", 0)["strike"]).alias("first_strike"), rounded("cost").alias("cost"))


_SPREAD = f"sp AS (SELECT a.underlying, a.ts, a.strike, a.mid - b.mid AS cost FROM ({_CALLS}) a JOIN ({_PUTS}) b USING (underlying, ts))"
_SP_OUT = f"SELECT underlying, ts, 2 AS legs, {r('strike')} AS first_strike, {r('cost')} AS cost FROM sp"
register("opt6_options_builder", lambda s, d: _spread_rows(O.options_builder(chain(s, d), [_CALL, _PUT])), f"WITH {CHAIN}, {_SPREAD} {_SP_OUT}")
register("opt7_structure_template", lambda s, d: _spread_rows(O.structure_template(chain(s, d), "risk reversal", [_CALL, _PUT], F.col("spot") > 1050)), f"WITH {CHAIN.replace('ch AS', 'c0 AS')}, ch AS (SELECT * FROM c0 WHERE spot > 1050), {_SPREAD} {_SP_OUT}")
register("rk11_open_option", lambda s, d: O.open_option(O.options_builder(chain(s, d), [_CALL, _PUT]), 5_000).select("underlying", "ts", "action", "contracts"), f"WITH {CHAIN}, {_SPREAD} SELECT underlying, ts, 'open' AS action, floor(5000 / nullif(abs(cost) * 100, 0))::BIGINT AS contracts FROM sp")


def _rk4(s: SparkSession, d: str) -> DataFrame:
    c = chain(s, d)
    names = c.select(F.col("underlying").alias("ticker"), "ts", "spot").distinct()
    w = K.weights(K.select_top(names, "spot", 3), "spot")
    return O.rebalance_option(w, O.options_builder(c, [_CALL, _PUT]), 50, 34).select("underlying", "ts", rounded("dollars").alias("dollars"))


register("rk4_rebalance_option", _rk4, f"WITH {CHAIN}, {_SPREAD}, nm AS (SELECT DISTINCT underlying, ts, spot FROM ch), tp AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY spot DESC, underlying) AS n FROM nm), wt AS (SELECT underlying, ts, spot / sum(spot) OVER (PARTITION BY ts) AS w FROM tp WHERE n <= 3) SELECT underlying, ts, {r('least(w, 0.34) * 5000')} AS dollars FROM wt JOIN sp USING (underlying, ts)")


def _p(name: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    register(name, lambda s, d: build(positions(s, d)), f"WITH {POS}{sql if sql.startswith(',') else ' ' + sql}")


def _trigger(name: str, test: Callable[[], Column], sql: str) -> None:
    _p(name, lambda p: p.where(test()).select("k", "ts"), f"SELECT k, ts FROM pp WHERE {sql}")


_trigger("opt8_pnl_trigger", lambda: O.pnl_trigger(-10, 20), "pnl <= -10 OR pnl >= 20")
_trigger("opt9_dte_trigger", lambda: O.dte_trigger(None, 14), "days <= 14")
_trigger("opt10_days_held_trigger", lambda: O.days_held_trigger(21, None), "held >= 21")
_trigger("opt11_greeks_trigger", lambda: O.greeks_trigger(min_delta=-0.5, max_delta=0.45, min_iv=0.3), "delta >= -0.5 AND delta <= 0.45 AND iv >= 0.3")
_p("opt12_close_option", lambda p: O.close_option(p, [O.pnl_trigger(None, 20), O.dte_trigger(None, 14)], 2, direction="long", spread_type="custom").select("k", "ts", "action", "close_quantity"), "SELECT k, ts, 'close' AS action, 2 AS close_quantity FROM pp WHERE (pnl >= 20 OR days <= 14) AND direction = 'long' AND spread_type = 'custom'")
_p(
    "opt13_against_parent",
    lambda p: O.against_parent(p.where("direction = 'short' and k < 200"), p.where("k < 200"), min_pnl_percent=0, max_coverage=1.0, strike_rule="above").select("k", "ts", "parent_id"),
    "SELECT s.k, s.ts, l.spread_id AS parent_id FROM pp s JOIN pp l USING (underlying, ts) WHERE s.k < 200 AND l.k < 200 AND s.direction = 'short' AND l.direction = 'long' AND l.pnl >= 0 AND s.quantity <= l.quantity AND s.strike > l.strike",
)
for _id, _m, _sql in (
    ("opt14_option_collateral", "collateral", "sum(collateral)"),
    ("opt15_option_days_held_min", "days_held_min", "min(held)"),
    ("opt15_option_days_held_max", "days_held_max", "max(held)"),
    ("opt16_option_days_to_expiration_min", "days_to_expiration_min", "min(days)"),
    ("opt16_option_days_to_expiration_max", "days_to_expiration_max", "max(days)"),
    ("opt18_option_position_count", "position_count", "count(*)"),
    ("opt19_option_spread_count", "spread_count", "count(DISTINCT spread_id)"),
    ("opt20_option_position_value", "position_value", "sum(value)"),
    ("opt21_option_unrealized_pnl", "unrealized_pnl", "sum(value - cost)"),
    ("opt22_option_position_percent_change", "position_percent_change", "100 * (sum(value) / nullif(sum(cost), 0) - 1)"),
):
    _p(_id, lambda p, m=_m: O.position_measure(p, m, ["underlying"], option_type="call", direction="long").select("underlying", "ts", rounded("value").alias("value")), f"SELECT underlying, ts, {r(_sql)} AS value FROM pp WHERE option_type = 'call' AND direction = 'long' GROUP BY 1, 2")
_p("opt17_option_gross_exposure_percent", lambda p: O.gross_exposure_percent(p, p.select("ts").distinct().withColumn("portfolio_value", F.lit(100_000.0))).select("ts", rounded("value").alias("value")), f"SELECT ts, {r('sum(abs(value)) / 1000')} AS value FROM pp GROUP BY 1")
_p(
    "opt23_option_position_max_drawdown",
    lambda p: O.position_max_drawdown(p, ["underlying"], direction="long").select("underlying", "ts", rounded("value").alias("value")),
    f", v AS (SELECT underlying, ts, sum(value) AS value FROM pp WHERE direction = 'long' GROUP BY 1, 2), w AS (SELECT *, 100 * (1 - value / max(value) OVER (PARTITION BY underlying ORDER BY ts)) AS dd FROM v) SELECT underlying, ts, {r('max(dd) OVER (PARTITION BY underlying ORDER BY ts)')} AS value FROM w",
)


def _sweep(name: str, genes: dict[str, list], build: Callable[[DataFrame], DataFrame], sql: str, source: Callable[[SparkSession, str], DataFrame] = positions, cte: str = POS) -> None:
    values = ", ".join(str(tuple([i, *v])) for i, v in enumerate(product(*genes.values())))
    g = f"g AS (SELECT * FROM (VALUES {values}) t(param_id, {', '.join(genes)}))"
    register(name, lambda s, d: build(E.over(source(s, d), E.grid(s, genes))), f"WITH {cte}, {g}{sql if sql.startswith(',') else ' ' + sql}")


_count = lambda p: p.groupBy("param_id", "ts").agg(F.count("*").alias("n"))
_n = "SELECT param_id, ts, count(*) AS n FROM pp, g WHERE {} GROUP BY 1, 2"
_sweep("ev16_gene_roll_trigger_dte", {"roll": [7, 14, 21]}, lambda p: _count(p.where(O.dte_trigger(None, F.col("roll")))), _n.format("days <= roll"))
_sweep("ev17_gene_take_profit_pct", {"take": [5, 10, 20]}, lambda p: _count(p.where(O.pnl_trigger(None, F.col("take")))), _n.format("pnl >= take"))
_sweep("ev18_gene_stop_loss_pct", {"stop": [-5, -10]}, lambda p: _count(p.where(O.pnl_trigger(F.col("stop"), None))), _n.format("pnl <= stop"))


def _leg_gene(name: str, genes: dict[str, list], leg: O.Leg, where: str, order: str) -> None:
    _sweep(name, genes, lambda c: O.select_leg(c, leg, ["param_id"]).select("param_id", "underlying", "ts", "expiration", rounded("strike").alias("strike")), f"SELECT param_id, underlying, ts, expiration, {r('strike')} AS strike FROM ({_pick(where, order, 'param_id, ')})", chain, CHAIN)


_leg_gene("ev22_gene_option_delta", {"goal": [0.3, 0.5]}, O.Leg("call", "long", 20, 45, "goal", "delta", fallback=("percent", 2.0)), "option_type = 'call' AND days BETWEEN 20 AND 45", "(delta IS NULL)::INT, days, expiration, coalesce(abs(delta - goal), abs(strike - spot * 1.02)), strike")
_leg_gene("ev23_gene_strike_distance", {"away": [1.0, 5.0]}, O.Leg("put", "short", 20, 45, "away"), "option_type = 'put' AND days BETWEEN 20 AND 45", "days, expiration, abs(strike - spot * (1 - away / 100)), strike")
_leg_gene("ev24_gene_dte_bracket", {"most": [25, 40]}, O.Leg("call", "long", 15, "most", 2.0, preference="farthest"), "option_type = 'call' AND days BETWEEN 15 AND most", "-days, expiration, abs(strike - spot * 1.02), strike")
_leg_gene("ev25_gene_max_spread_pct", {"wide": [2.0, 6.0]}, O.Leg("call", "long", 20, 45, 2.0, max_spread_percent="wide"), "option_type = 'call' AND days BETWEEN 20 AND 45 AND 100 * (ask - bid) / ((bid + ask) / 2) <= wide", "days, expiration, abs(strike - spot * 1.02), strike")


def _structures(c: DataFrame) -> DataFrame:
    kinds = {"single": [_CALL], "reversal": [_CALL, _PUT]}
    parts = [O.structure_template(c.where(F.col("kind") == k), k, legs, keys=["param_id"]) for k, legs in kinds.items()]
    return parts[0].unionByName(parts[1]).select("param_id", "underlying", "ts", "template", rounded("cost").alias("cost"))


_sweep(
    "ev19_gene_structure_kind", {"kind": ["single", "reversal"]}, _structures,
    f", {_SPREAD} SELECT 0 AS param_id, underlying, ts, 'single' AS template, {r('mid')} AS cost FROM ({_CALLS}) UNION ALL SELECT 1, underlying, ts, 'reversal', {r('cost')} FROM sp", chain, CHAIN,
)
