"""Option chains: contract selection, spreads, volatility measures, positions and close triggers.

A chain has a row for each underlying, time and contract: expiration, strike, option_type, bid, ask,
iv, delta and so on, with the underlying's spot price. Days to expiration count from the row's time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import indicators as I
from tidemark.functions import rolling

_AT = ["underlying", "ts"]


def days_to_expiration(expiration: str = "expiration", time: str = "ts") -> Column:
    return F.datediff(F.to_date(expiration), F.to_date(time))


def best_of(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row by order of each group of keys.

    Rows are dealt to tasks by strike too before any are sorted: each task keeps its own first row of a
    group, so neither a file of many rows nor a large group is sorted in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.repartition(*keys, "strike").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


# -- volatility --------------------------------------------------------------------------------------


def implied_volatility(chain: DataFrame, dte: int = 30) -> DataFrame:
    """underlying, ts, iv at a constant maturity: the contract nearest the money of each expiry, then
    linear in total variance between the expiries around dte, the nearest one outside them."""
    alive = chain.where("iv is not null").withColumn("days", days_to_expiration()).where("days > 0")
    atm = best_of(alive, [*_AT, "expiration"], [F.abs(F.col("strike") - F.col("spot")), "strike", "option_type"])
    point = F.struct("days", (F.col("iv") * F.col("iv") * F.col("days")).alias("total"))
    both = atm.groupBy(*_AT).agg(F.max(F.when(F.col("days") <= dte, point)).alias("lo"), F.min(F.when(F.col("days") >= dte, point)).alias("hi"))
    lo, hi = F.coalesce("lo", "hi"), F.coalesce("hi", "lo")
    share = F.try_divide(F.lit(dte) - lo["days"], hi["days"] - lo["days"])
    between = lo["total"] + (hi["total"] - lo["total"]) * F.coalesce(share, F.lit(0.0))
    flat = lo["total"] / lo["days"]
    return both.select(*_AT, F.sqrt(F.when(lo["days"] == hi["days"], flat).otherwise(between / dte)).alias("iv"))


def iv_rank(iv: I.Indicator, length: int = 252) -> I.Indicator:
    """100 (iv - least) / (greatest - least) of the window; null where they are equal."""

    def build(p: I.Panel) -> Column:
        x = iv.column(p)
        low, high = p.full(x, length, F.min), p.full(x, length, F.max)
        return 100 * F.try_divide(x - low, high - low)

    return I.Indicator(build, iv)


def iv_percentile(iv: I.Indicator, length: int = 252) -> I.Indicator:
    """Percent of the window's values below the current one."""
    return I.ranked(iv, length, rolling.percent_below)


def historical_volatility(window: int = 20, price: I.Indicator | None = None) -> I.Indicator:
    price = price or I.Price()

    def build(p: I.Panel) -> Column:
        x = price.column(p)
        change = F.log(F.try_divide(x, F.lag(x).over(p.ordered())))
        return p.full(change, window, F.stddev_samp) * 252**0.5

    return I.Indicator(build, price)


def iv_hv_ratio(iv: I.Indicator, hv_window: int = 20) -> I.Indicator:
    return iv / historical_volatility(hv_window)


# -- legs and spreads ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Leg:
    """One contract of each underlying and time. distance: of the strike from spot in percent or
    dollars (up for calls, down for puts), or the contract's delta. bounds: column -> (min, max), None open."""

    option_type: str
    direction: str
    min_days_to_expiration: int
    max_days_to_expiration: int
    distance: float | str
    distance_type: str = "percent"
    preference: str = "nearest"
    ratio: int = 1
    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    max_spread_percent: float | str | None = None
    fallback: tuple[str, float] | None = None

    def __post_init__(self) -> None:
        if self.distance_type not in ("percent", "dollars", "delta"):
            raise ValueError("distance_type is percent, dollars or delta")
        if self.distance_type == "delta" and self.fallback is None:
            raise ValueError("a delta needs a fallback: (percent or dollars, distance)")


def _value(x: float | str) -> Column:
    """A number, or a parameter's column."""
    return F.col(x) if isinstance(x, str) else F.lit(x)


def _away(leg: Leg, kind: str, distance: float | str) -> Column:
    d = _value(distance)
    if kind == "delta":
        return F.abs(F.col("delta") - d)
    up = 1 if leg.option_type == "call" else -1
    target = F.col("spot") * (1 + up * d / 100) if kind == "percent" else F.col("spot") + up * d
    return F.abs(F.col("strike") - target)


def select_leg(chain: DataFrame, leg: Leg, keys: list[str] | None = None) -> DataFrame:
    """The leg's contract of each underlying and time (and key), with direction and ratio.

    Expiries by preference: nearest, farthest, or middle of the range; then the strike nearest the
    target, the lower strike at a tie. Where no contract has a delta, the fallback distance counts.
    """
    keys = keys or []
    days = days_to_expiration()
    rows = chain.where((F.col("option_type") == leg.option_type) & days.between(_value(leg.min_days_to_expiration), _value(leg.max_days_to_expiration))).withColumn("days", days)
    for c, (low, high) in leg.bounds.items():
        rows = rows if low is None else rows.where(F.col(c) >= low)
        rows = rows if high is None else rows.where(F.col(c) <= high)
    if leg.max_spread_percent is not None:
        middle = (F.col("bid") + F.col("ask")) / 2
        rows = rows.where(100 * F.try_divide(F.col("ask") - F.col("bid"), middle) <= _value(leg.max_spread_percent))
    away = _away(leg, leg.distance_type, leg.distance)
    has = F.lit(0)
    if leg.distance_type == "delta":
        has = F.when(F.col("delta").isNull(), 1).otherwise(0)
        away = F.coalesce(away, _away(leg, *leg.fallback))
    by_day = {"nearest": F.col("days"), "farthest": -F.col("days"), "middle": F.abs(2 * F.col("days") - _value(leg.min_days_to_expiration) - _value(leg.max_days_to_expiration))}[leg.preference]
    best = best_of(rows, [*keys, *_AT], [has, by_day, "expiration", away, "strike"])
    return best.withColumns({"direction": F.lit(leg.direction), "ratio": F.lit(leg.ratio)})


def options_builder(chain: DataFrame, legs: list[Leg], spread_type: str = "custom", keys: list[str] | None = None) -> DataFrame:
    """underlying, ts, spread_type, legs (array of contracts), cost of the spreads all of whose legs were found."""
    keys = keys or []
    picks = []
    for k, leg in enumerate(legs):
        middle = (F.col("bid") + F.col("ask")) / 2
        signed = middle * F.col("ratio") * (1 if leg.direction == "long" else -1)
        picks.append(select_leg(chain, leg, keys).select(*keys, *_AT, F.lit(k).alias("k"), F.struct("option_type", "expiration", "strike", "direction", "ratio").alias("leg"), signed.alias("signed")))
    all_ = reduce(DataFrame.unionByName, picks)
    out = all_.groupBy(*keys, *_AT).agg(F.array_sort(F.collect_list(F.struct("k", "leg"))).alias("__legs"), F.sum("signed").alias("cost"), F.count("*").alias("__n"))
    return out.where(F.col("__n") == len(legs)).select(*keys, *_AT, F.lit(spread_type).alias("spread_type"), F.transform("__legs", lambda x: x["leg"]).alias("legs"), "cost")


def structure_template(chain: DataFrame, name: str, legs: list[Leg], eligibility: Column | None = None, spread_type: str = "custom", keys: list[str] | None = None) -> DataFrame:
    rows = chain if eligibility is None else chain.where(F.coalesce(eligibility, F.lit(False)))
    return options_builder(rows, legs, spread_type, keys).withColumn("template", F.lit(name))


def open_option(spreads: DataFrame, amount: Column | float) -> DataFrame:
    """An open intent of each spread: dollars, and whole contracts of 100 that they pay for."""
    dollars = amount if isinstance(amount, Column) else F.lit(float(amount))
    return spreads.withColumns({"action": F.lit("open"), "dollars": dollars, "contracts": F.floor(F.try_divide(dollars, F.abs(F.col("cost")) * 100))})


def rebalance_option(weights: DataFrame, spreads: DataFrame, total_budget: float, per_name: float | None = None, value: float = 10_000, key: str = "ticker") -> DataFrame:
    """Spreads of the selected underlyings with dollars: weight (capped at per_name percent) of the budget."""
    share = F.col("weight") if per_name is None else F.least("weight", F.lit(per_name / 100))
    w = weights.select(F.col(key).alias("underlying"), "ts", "weight")
    return open_option(spreads.join(w, _AT), share * value * total_budget / 100)


# -- positions ---------------------------------------------------------------------------------------


def bounded(c: Column, low: object = None, high: object = None, outside: bool = False) -> Column:
    """Whether c lies in the bounds, or with outside beyond them; open bounds don't count, null is false."""
    tests = [c <= low if outside else c >= low] if low is not None else []
    tests += [c >= high if outside else c <= high] if high is not None else []
    join = (lambda a, b: a | b) if outside else (lambda a, b: a & b)
    return F.coalesce(reduce(join, tests), F.lit(False)) if tests else F.lit(not outside)


def pnl_percent() -> Column:
    return 100 * F.try_divide(F.col("value") - F.col("cost"), F.abs("cost"))


def pnl_trigger(min_pnl_percent: object = None, max_pnl_percent: object = None) -> Column:
    """The position's profit is at or beyond a bound."""
    return bounded(pnl_percent(), min_pnl_percent, max_pnl_percent, outside=True)


def dte_trigger(min_dte: object = None, max_dte: object = None) -> Column:
    return bounded(days_to_expiration(), min_dte, max_dte)


def days_held() -> Column:
    return F.datediff(F.to_date("ts"), F.to_date("opened"))


def days_held_trigger(min_days_held: object = None, max_days_held: object = None) -> Column:
    return bounded(days_held(), min_days_held, max_days_held)


def greeks_trigger(**bounds: float) -> Column:
    """min_/max_ of delta, iv, theta: every stated one holds."""
    tests = [bounded(F.col(k[4:]), v) if k.startswith("min_") else bounded(F.col(k[4:]), None, v) for k, v in bounds.items()]
    return reduce(lambda a, b: a & b, tests)


def positions_like(positions: DataFrame, underlying: object = None, option_type: str | None = None, direction: str | None = None, spread_type: str | None = None) -> DataFrame:
    for c, v in (("underlying", underlying), ("option_type", option_type), ("direction", direction), ("spread_type", spread_type)):
        if v is not None:
            positions = positions.where(F.col(c).isin(*v) if isinstance(v, (list, tuple)) else F.col(c) == v)
    return positions


def close_option(positions: DataFrame, triggers: list[Column], quantity: float | None = None, **filters: object) -> DataFrame:
    """Positions that meet the filters and any trigger (or have none to meet), with the quantity to close."""
    any_ = reduce(lambda a, b: a | b, triggers) if triggers else F.lit(True)
    return positions_like(positions, **filters).where(any_).withColumns({"action": F.lit("close"), "close_quantity": F.lit(quantity)})


def against_parent(shorts: DataFrame, positions: DataFrame, min_pnl_percent: float | None = None, max_pnl_percent: float | None = None, max_coverage: float = 1.0, strike_rule: str | None = None) -> DataFrame:
    """Short legs with a long parent on the same underlying and time: profit in bounds, no more contracts
    than max_coverage of the parent's, and the strike above or below the parent's if stated."""
    parent = positions_like(positions, direction="long").where(bounded(pnl_percent(), min_pnl_percent, max_pnl_percent))
    parent = parent.select(*_AT, F.col("spread_id").alias("parent_id"), F.col("strike").alias("parent_strike"), F.col("quantity").alias("parent_quantity"))
    out = shorts.join(parent, _AT).where(F.col("quantity") <= F.col("parent_quantity") * max_coverage)
    return out if strike_rule is None else out.where(F.col("strike") > F.col("parent_strike") if strike_rule == "above" else F.col("strike") < F.col("parent_strike"))


#: What option state indicators compute over the matching positions of a time.
MEASURES = {
    "collateral": lambda: F.sum("collateral"),
    "days_held_min": lambda: F.min(days_held()),
    "days_held_max": lambda: F.max(days_held()),
    "days_to_expiration_min": lambda: F.min(days_to_expiration()),
    "days_to_expiration_max": lambda: F.max(days_to_expiration()),
    "position_count": lambda: F.count("*"),
    "spread_count": lambda: F.count_distinct("spread_id"),
    "position_value": lambda: F.sum("value"),
    "unrealized_pnl": lambda: F.sum(F.col("value") - F.col("cost")),
    "position_percent_change": lambda: 100 * (F.try_divide(F.sum("value"), F.sum("cost")) - 1),
}


def position_measure(positions: DataFrame, measure: str, keys: list[str] | None = None, **filters: object) -> DataFrame:
    return positions_like(positions, **filters).groupBy(*(keys or []), "ts").agg(MEASURES[measure]().alias("value"))


def gross_exposure_percent(positions: DataFrame, portfolio_values: DataFrame) -> DataFrame:
    gross = positions.groupBy("ts").agg(F.sum(F.abs("value")).alias("gross"))
    return gross.join(portfolio_values, "ts").select("ts", (100 * F.try_divide("gross", "portfolio_value")).alias("value"))


def position_max_drawdown(positions: DataFrame, keys: list[str], **filters: object) -> DataFrame:
    """Largest percent fall so far of the matching positions' value, for each key."""
    from .ledger import worst_swing

    v = position_measure(positions, "position_value", keys, **filters)
    w = Window.partitionBy(*keys).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return v.withColumn("__dd", worst_swing("value", keys, "ts")[1]).select(*keys, "ts", F.max("__dd").over(w).alias("value"))
