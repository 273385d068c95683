"""Indicators and conditions over a price panel (ticker, ts, open, high, low, close, volume).

An Indicator is an expression that becomes a Column once the panel is known. Indicators compose with
+ - * / and compare into Conditions, which compose with & and |. A window of n is n bars of the
panel's grain, and is null until n values are there; n must be positive. asset=None means the row's
own ticker (the candidate); a symbol means that ticker's value at the same time. Formulas are
textbook definitions. Division by zero and logarithms of non-positive numbers are null; a comparison
with null is false.
"""

from __future__ import annotations

import operator
import math
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from . import rolling

Build = Callable[["Panel"], Column]


@dataclass(frozen=True)
class Panel:
    """Names of the panel's key and time, and the exchange's session hours in its zone."""

    key: str = "ticker"
    time: str = "ts"
    zone: str = "UTC"
    opens: int = 9 * 60 + 30
    closes: int = 16 * 60
    staged: dict[int, str] = field(default_factory=dict)

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(self.key).orderBy(self.time)

    def last(self, n: int) -> WindowSpec:
        return self.ordered().rowsBetween(1 - n, 0)

    def so_far(self) -> WindowSpec:
        return self.ordered().rowsBetween(Window.unboundedPreceding, 0)

    def local(self) -> Column:
        return F.from_utc_timestamp(self.time, self.zone)

    def in_session(self) -> WindowSpec:
        return Window.partitionBy(self.key, F.to_date(self.local())).orderBy(self.time).rowsBetween(Window.unboundedPreceding, 0)

    def full(self, x: Column, n: int, agg: Callable[[Column], Column]) -> Column:
        return F.when(F.count(x).over(self.last(n)) == n, agg(x).over(self.last(n)))


class Indicator:
    def __init__(self, build: Build, *parts: Any, staged: Callable[[DataFrame, Panel, str], DataFrame] | None = None) -> None:
        self._build, self.parts, self.staged = build, parts, staged

    def column(self, panel: Panel) -> Column:
        return F.col(panel.staged[id(self)]) if id(self) in panel.staged else self._build(panel)

    def __add__(self, other: Any) -> Indicator:
        return Plus(self, other)

    def __radd__(self, other: Any) -> Indicator:
        return Plus(other, self)

    def __sub__(self, other: Any) -> Indicator:
        return Minus(self, other)

    def __rsub__(self, other: Any) -> Indicator:
        return Minus(other, self)

    def __mul__(self, other: Any) -> Indicator:
        return Multiply(self, other)

    def __rmul__(self, other: Any) -> Indicator:
        return Multiply(other, self)

    def __truediv__(self, other: Any) -> Indicator:
        return Divide(self, other)

    def __rtruediv__(self, other: Any) -> Indicator:
        return Divide(other, self)

    def __gt__(self, other: Any) -> Condition:
        return compare(self, "greaterThan", other)

    def __lt__(self, other: Any) -> Condition:
        return compare(self, "lessThan", other)

    def __ge__(self, other: Any) -> Condition:
        return compare(self, "greaterThanOrEqual", other)

    def __le__(self, other: Any) -> Condition:
        return compare(self, "lessThanOrEqual", other)

    def eq(self, other: Any) -> Condition:
        return compare(self, "equal", other)

    def ne(self, other: Any) -> Condition:
        return compare(self, "notEqual", other)


class Condition:
    """A boolean expression that is never null."""

    def __init__(self, build: Build, *parts: Any) -> None:
        self._build, self.parts = build, parts

    def column(self, panel: Panel) -> Column:
        return F.coalesce(self._build(panel), F.lit(False))

    def __and__(self, other: Condition) -> Condition:
        return Condition(lambda p: self.column(p) & other.column(p), self, other)

    def __or__(self, other: Condition) -> Condition:
        return Condition(lambda p: self.column(p) | other.column(p), self, other)


# Names of comparators.
COMPARATORS = {
    "greaterThan": operator.gt,
    "lessThan": operator.lt,
    "greaterThanOrEqual": operator.ge,
    "lessThanOrEqual": operator.le,
    "equal": operator.eq,
    "notEqual": operator.ne,
}


def _node(x: Any) -> Indicator:
    return x if isinstance(x, Indicator) else Value(x)


def _needs_evaluate(p: Panel) -> Column:
    raise ValueError("this indicator needs evaluate()")


def _of(asset: Any, build: Build, *parts: Any) -> Indicator:
    """build of the row's own ticker, or of one ticker at the same time: its rows are a short series, joined by time."""
    if asset is None:
        return Indicator(build, *parts)

    def stage(df: DataFrame, p: Panel, name: str) -> DataFrame:
        one = df.where(F.col(p.key) == asset).withColumn(name, build(p)).groupBy(p.time).agg(F.max(name).alias(name))
        return df.join(one, p.time, "left")

    return Indicator(_needs_evaluate, *parts, staged=stage)


def compare(left: Any, comparator: str, right: Any) -> Condition:
    a, b = _node(left), _node(right)
    return Condition(lambda p: COMPARATORS[comparator](a.column(p), b.column(p)), a, b)


def multi(count: int, comparator: str, *conditions: Condition) -> Condition:
    """How many of the conditions hold, compared with count."""

    def build(p: Panel) -> Column:
        total = F.lit(0)
        for c in conditions:
            total = total + c.column(p).cast("int")
        return COMPARATORS[comparator](total, F.lit(count))

    return Condition(build, *conditions)


def at_least(count: int, *conditions: Condition) -> Condition:
    return multi(count, "greaterThanOrEqual", *conditions)


def at_most(count: int, *conditions: Condition) -> Condition:
    return multi(count, "lessThanOrEqual", *conditions)


def fewer_than(count: int, *conditions: Condition) -> Condition:
    return multi(count, "lessThan", *conditions)


def exactly(count: int, *conditions: Condition) -> Condition:
    return multi(count, "equal", *conditions)


def always() -> Condition:
    return Condition(lambda p: F.lit(True))


# -- scalars ------------------------------------------------------------------------------------


def Value(value: float = 0) -> Indicator:
    return Indicator(lambda p: F.lit(value))


def _two(f: Callable[[Column, Column], Column]) -> Callable[[Any, Any], Indicator]:
    def make(left: Any, right: Any) -> Indicator:
        a, b = _node(left), _node(right)
        return Indicator(lambda p: f(a.column(p), b.column(p)), a, b)

    return make


def _one(f: Callable[[Column], Column]) -> Callable[[Any], Indicator]:
    def make(operand: Any) -> Indicator:
        a = _node(operand)
        return Indicator(lambda p: f(a.column(p)), a)

    return make


Plus = _two(operator.add)
Minus = _two(operator.sub)
Multiply = _two(operator.mul)
Divide = _two(F.try_divide)
Max = _two(lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b)))
Min = _two(lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.least(a, b)))
AbsoluteValue = _one(F.abs)
Negative = _one(F.negative)
SquareRoot = _one(lambda a: F.when(a >= 0, F.sqrt(a)))


def Exponentiation(operand: Any, exponent: float = 2) -> Indicator:
    a = _node(operand)
    return Indicator(lambda p: F.pow(a.column(p), F.lit(exponent)), a)


def Log(operand: Any, base: float = 10) -> Indicator:
    a = _node(operand)
    return Indicator(lambda p: F.when(a.column(p) > 0, F.log(float(base), a.column(p))), a)


# -- calendar -----------------------------------------------------------------------------------


def _clock(f: Callable[[Column], Column]) -> Callable[[], Indicator]:
    return lambda: Indicator(lambda p: f(p.local()))


def _minutes(t: Column) -> Column:
    return F.hour(t) * 60 + F.minute(t) + F.second(t) / 60


Year, Month, Day = _clock(F.year), _clock(F.month), _clock(F.dayofmonth)
Date = _clock(lambda t: F.date_format(t, "yyyyMMdd").cast("int"))
CurrentTimeHours, CurrentTimeMinutes, CurrentTimeSeconds = _clock(F.hour), _clock(F.minute), _clock(F.second)


def MinutesAfterOpen() -> Indicator:
    return Indicator(lambda p: _minutes(p.local()) - p.opens)


def MinutesUntilClose() -> Indicator:
    return Indicator(lambda p: p.closes - _minutes(p.local()))


# -- membership ---------------------------------------------------------------------------------


def IsAsset(match_asset: Any, asset: Any = None) -> Indicator:
    return Indicator(lambda p: ((F.lit(asset) if asset is not None else F.col(p.key)) == match_asset).cast("int"))


def IsNotAsset(match_asset: Any, asset: Any = None) -> Indicator:
    return Indicator(lambda p: ((F.lit(asset) if asset is not None else F.col(p.key)) != match_asset).cast("int"))


def IsAssetType(asset: Any = None, asset_type: str = "Stock", column: str = "asset_type") -> Indicator:
    return _of(asset, lambda p: F.coalesce(F.col(column) == asset_type, F.lit(False)).cast("int"))


def IsIndustry(asset: Any, industry: str, column: str = "industries") -> Indicator:
    return _of(asset, lambda p: F.coalesce(F.array_contains(column, industry), F.lit(False)).cast("int"))


# -- prices -------------------------------------------------------------------------------------


def _panel(build: Build) -> Callable[..., Indicator]:
    return lambda asset=None: _of(asset, build)


def _lag(p: Panel, x: str | Column, n: int = 1) -> Column:
    return F.lag(x, n).over(p.ordered())


Price = _panel(lambda p: F.col("close"))
OpeningPrice = _panel(lambda p: F.first("open").over(p.in_session()))
HighOfDay = _panel(lambda p: F.max("high").over(p.in_session()))
LowOfDay = _panel(lambda p: F.min("low").over(p.in_session()))
PreviousClosingPrice = _panel(lambda p: _lag(p, "close"))
GapSize = _panel(lambda p: F.col("open") - _lag(p, "close"))
GapPercentage = _panel(lambda p: 100 * (F.try_divide("open", _lag(p, "close")) - 1))
VWAP = _panel(lambda p: F.try_divide(F.sum((F.col("high") + F.col("low") + F.col("close")) / 3 * F.col("volume")).over(p.in_session()), F.sum("volume").over(p.in_session())))
TrueRange = _panel(lambda p: _true_range(p))
BullishFairValueGap = _panel(lambda p: F.greatest(F.col("low") - _lag(p, "high", 2), F.lit(0.0)))
BearishFairValueGap = _panel(lambda p: F.greatest(_lag(p, "low", 2) - F.col("high"), F.lit(0.0)))
UnderlyingMaxDrawdown = _panel(lambda p: F.max(100 * (1 - F.try_divide("close", F.max("close").over(p.so_far())))).over(p.so_far()))


def PriceChangeSinceOpen(asset: Any = None, percent: bool = False) -> Indicator:
    def build(p: Panel) -> Column:
        change = F.col("close") - F.col("open")
        return 100 * F.try_divide(change, "open") if percent else change

    return _of(asset, build)


def Volume(asset: Any = None, metric: str = "volume") -> Indicator:
    """Volume, or another column of the panel by name."""
    return _of(asset, lambda p: F.col(metric))


def _true_range(p: Panel) -> Column:
    before = _lag(p, "close")
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


# -- windows over any indicator -------------------------------------------------------------------


def _windowed(agg: Callable[[Panel, Column, int], Column], default: int = 30) -> Callable[..., Indicator]:
    def make(operand: Any, length: int = default, interval: str = "Day") -> Indicator:
        if length < 1:
            raise ValueError("length must be positive")
        a = _node(operand)
        return Indicator(lambda p: agg(p, a.column(p), length), a)

    return make


def _of_price(make: Callable[..., Indicator], default: int = 30) -> Callable[..., Indicator]:
    def of_price(asset: Any = None, length: int = default, interval: str = "Day") -> Indicator:
        own = make(Price(), length, interval)
        return own if asset is None else _of(asset, own.column, own)

    return of_price


def ranked(operand: Any, length: int, measure: rolling.Measure) -> Indicator:
    """An order statistic of the last `length` values, found by rank in one ordered pass."""
    if length < 1:
        raise ValueError("length must be positive")
    x = _node(operand)

    def stage(df: DataFrame, p: Panel, name: str) -> DataFrame:
        value = f"{name}_x"
        return rolling.with_rolling(df.withColumn(value, x.column(p).cast("double")), p.key, p.time, value, length, measure, name).drop(value)

    return Indicator(_needs_evaluate, x, staged=stage)


def _swing(sign: int) -> Callable[..., Indicator]:
    """Largest percent fall (+1) or rise (-1) from the running extreme inside the window.

    A run of bars is summed up by its extremes and its largest swing, two runs that follow each other
    by theirs; so a window is put together from runs of 1, 2, 4, ... bars, each from two shorter ones.
    """

    def joined(a: Column, b: Column) -> Column:
        move = 1 - F.try_divide(b["low"], a["high"]) if sign > 0 else F.try_divide(b["high"], a["low"]) - 1
        return F.struct(F.greatest(a["high"], b["high"]).alias("high"), F.least(a["low"], b["low"]).alias("low"), F.greatest(a["most"], b["most"], 100 * move).alias("most"))

    def make(operand: Any, length: int = 30, interval: str = "Day") -> Indicator:
        if length < 1:
            raise ValueError("length must be positive")
        x = _node(operand)

        def stage(df: DataFrame, p: Panel, name: str) -> DataFrame:
            value, run, got, n = f"{name}_x", f"{name}_run", None, 1
            df = df.withColumn(value, x.column(p).cast("double"))
            df = df.withColumn(run, F.struct(F.col(value).alias("high"), F.col(value).alias("low"), F.lit(0.0).alias("most")))
            before = lambda c, k: F.lag(c, k).over(p.ordered()) if k else F.col(c)
            covered = 0
            while True:
                if length & n:
                    df = df.withColumn(name, joined(before(run, covered), F.col(name)) if got else F.col(run))
                    got, covered = True, covered + n
                if 2 * n > length:
                    break
                df = df.withColumn(run, joined(before(run, n), F.col(run)))
                n *= 2
            full = F.count(value).over(p.last(length)) == length
            return df.withColumn(name, F.when(full, F.col(name)["most"])).drop(value, run)

        return Indicator(_needs_evaluate, x, staged=stage)

    return make


IndicatorSimpleMovingAverage = _windowed(lambda p, x, n: p.full(x, n, F.avg))
IndicatorStandardDeviation = _windowed(lambda p, x, n: p.full(x, n, F.stddev_samp))
IndicatorMeanAbsoluteDeviation = lambda operand, length=30, interval="Day": ranked(operand, length, rolling.mean_deviation)
IndicatorRateOfChange = _windowed(lambda p, x, n: 100 * (F.try_divide(x, F.lag(x, n).over(p.ordered())) - 1))
IndicatorWindowAgo = _windowed(lambda p, x, n: F.lag(x, n).over(p.ordered()))
TrailingSum = _windowed(lambda p, x, n: p.full(x, n, F.sum), 4)
_window_max = _windowed(lambda p, x, n: p.full(x, n, F.max))
_window_min = _windowed(lambda p, x, n: p.full(x, n, F.min))

SimpleMovingAverage = _of_price(IndicatorSimpleMovingAverage)
PriceStandardDeviation = _of_price(IndicatorStandardDeviation)
PriceMeanAbsoluteDeviation = _of_price(IndicatorMeanAbsoluteDeviation)
PriceRateOfChange = _of_price(IndicatorRateOfChange)
MaximumPrice, MinimumPrice = _of_price(_window_max), _of_price(_window_min)
MaxDrawdown, MaxDrawup = _of_price(_swing(1)), _of_price(_swing(-1))
AverageTrueRange = lambda asset=None, length=14, interval="Day": _of(asset, lambda p: p.full(_true_range(p), length, F.avg))


def RelativeStrengthIndex(asset: Any = None, length: int = 30, interval: str = "Day") -> Indicator:
    """100 - 100 / (1 + mean gain / mean loss) of n changes; 100 where nothing was lost."""

    def build(p: Panel) -> Column:
        change = F.col("close") - _lag(p, "close")
        gain = p.full(F.greatest(change, change * 0), length, F.avg)
        loss = p.full(F.greatest(-change, change * 0), length, F.avg)
        return F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))

    return _of(asset, build)


def BollingerBand(asset: Any = None, length: int = 30, interval: str = "Day", num_standard_deviations: float = 1) -> Indicator:
    def build(p: Panel) -> Column:
        x = F.col("close")
        return p.full(x, length, F.avg) + num_standard_deviations * p.full(x, length, F.stddev_pop)

    return _of(asset, build)


def _before(p: Panel, x: Indicator) -> Column:
    return F.lag(x.column(p)).over(p.ordered())


def CrossAbove(left: Any, right: Any) -> Condition:
    a, b = _node(left), _node(right)
    return Condition(lambda p: (a.column(p) > b.column(p)) & (_before(p, a) <= _before(p, b)), a, b)


def CrossBelow(left: Any, right: Any) -> Condition:
    a, b = _node(left), _node(right)
    return Condition(lambda p: (a.column(p) < b.column(p)) & (_before(p, a) >= _before(p, b)), a, b)


def ConsecutiveTrue(condition: Condition, length: int = 1, interval: str = "Day") -> Indicator:
    return Indicator(lambda p: F.coalesce(p.full(condition.column(p), length, F.bool_and), F.lit(False)).cast("int"), condition)


def CountTrue(condition: Condition, length: int = 1, interval: str = "Day") -> Indicator:
    return Indicator(lambda p: p.full(condition.column(p).cast("int"), length, F.sum), condition)


def IndicatorAtMinutesAfterOpen(operand: Any, minutes_after_open: int = 30) -> Indicator:
    """The last value at or before k minutes after the open, from then to the end of the session."""
    a = _node(operand)

    def build(p: Panel) -> Column:
        minute = _minutes(p.local()) - p.opens
        held = F.last(F.when(minute <= minutes_after_open, a.column(p)), ignorenulls=True).over(p.in_session())
        return F.when(minute >= minutes_after_open, held)

    return Indicator(build, a)


def IndicatorExponentialMovingAverage(operand: Any, length: int = 30, interval: str = "Day") -> Indicator:
    """E = a x + (1 - a) E before, a = 2 / (n + 1), from the first value on; nulls keep E as it is."""
    a, weight = _node(operand), 2 / (length + 1)

    def stage(df: DataFrame, p: Panel, name: str) -> DataFrame:
        return smoothed(df.withColumn(name, a.column(p).cast("double")), p, name, weight)

    return Indicator(_needs_evaluate, a, staged=stage)


def ExponentialMovingAverage(asset: Any = None, length: int = 30, interval: str = "Day") -> Indicator:
    own = IndicatorExponentialMovingAverage(Price(), length, interval)
    return own if asset is None else _of(asset, own.column, own)


def smoothed(df: DataFrame, panel: Panel, name: str, weight: float) -> DataFrame:
    """The column replaced by its recursive average, in windows by (key, time).

    With q = 1 - weight the average is a sum of weight x q^age over the values so far (the first
    without the weight). It is taken over blocks of values, so long that what an older block than the
    one before adds is below any double, as q^place times a running sum of x / q^place.
    """
    x, q = F.when(~F.isnan(name), F.col(name)), 1 - weight
    if q <= 0:
        return df.withColumn(name, F.last(x, ignorenulls=True).over(panel.so_far()))
    block = max(1, int(100 * math.log(10) / -math.log(q)))
    nth, part, own = f"{name}_nth", f"{name}_part", f"{name}_own"
    df = df.withColumns({name: x, nth: F.count(x).over(panel.so_far()) - 1})
    df = df.withColumns({part: F.floor(F.col(nth) / block), nth: F.col(nth) % block})
    place = F.col(nth).cast("double")
    first = (F.col(part) == 0) & (F.col(nth) == 0)
    term = F.when(first, F.col(name)).otherwise(weight * F.col(name)) * F.pow(F.lit(1 / q), place)
    inside = Window.partitionBy(panel.key, part).orderBy(panel.time).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn(own, F.sum(term).over(inside) * F.pow(F.lit(q), place))
    ends = F.when(F.col(name).isNotNull() & (F.col(nth) == block - 1), F.col(own))
    older = F.last(ends, ignorenulls=True).over(panel.ordered().rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn(own, F.when(F.col(name).isNotNull(), F.col(own) + F.coalesce(older * F.pow(F.lit(q), place + 1), F.lit(0.0))))
    return df.withColumn(name, F.last(own, ignorenulls=True).over(panel.so_far())).drop(nth, part, own)


def evaluate(df: DataFrame, panel: Panel | None = None, **outputs: Indicator | Condition) -> DataFrame:
    """df with a column for each output. Nodes that stand in several places, and recursive averages,
    are computed once, inner ones first; all other windows share one exchange by (key, time)."""
    panel = panel or Panel()
    seen: dict[int, int] = {}
    order: list[Any] = []

    def visit(node: Any) -> None:
        seen[id(node)] = seen.get(id(node), 0) + 1
        if seen[id(node)] == 1:
            for part in node.parts:
                visit(part)
            order.append(node)

    for node in outputs.values():
        visit(node)
    stage = Panel(panel.key, panel.time, panel.zone, panel.opens, panel.closes)
    made = []
    for node in order:
        staged = getattr(node, "staged", None)
        if isinstance(node, Indicator) and (staged or seen[id(node)] > 1 and node.parts):
            name = f"__node_{len(made)}"
            df = staged(df, stage, name) if staged else df.withColumn(name, node.column(stage))
            stage.staged[id(node)] = name
            made.append(name)
    return df.withColumns({name: node.column(stage) for name, node in outputs.items()}).drop(*made)
