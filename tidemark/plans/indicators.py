"""Queries of the indicator and condition builders over bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import indicators as I

from .common import DAILY, MINUTES, SESSION, STEPS, T, daily, full, minutes, r, register, rounded, win


def _panel(name: str, node: I.Indicator | I.Condition, expr: str, intraday: bool = False, keep: str = "") -> None:
    source, cte = (minutes, MINUTES) if intraday else (daily, DAILY)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = I.evaluate(source(spark, sf_dir), value=node)
        value = F.col("value").cast("boolean") if isinstance(node, I.Condition) else rounded("value")
        return out.select("ticker", "ts", value.alias("value"))

    value = f"coalesce({expr}, false)" if isinstance(node, I.Condition) else r(expr)
    register(name, query, f"WITH RECURSIVE {cte}, {STEPS}{keep} SELECT ticker, ts, {value} AS value FROM {'z' if keep else 'y'}")


P, V = I.Price, I.Value
SMA5, MA5 = I.SimpleMovingAverage(None, 5), "CASE WHEN n5 = 5 THEN ma5 END"

# conditions and arithmetic
_panel("pf1_comparison", P() > SMA5, f"close > {MA5}")
_panel("pf2_arithmetic", (P() * 2 + I.Volume()) / (P() - 1), "(close * 2 + volume) / nullif(close - 1, 0)")
_panel("pf3_and_or", (P() > SMA5) & (I.Volume() > 30) | (P() < I.PreviousClosingPrice()), f"coalesce(close > {MA5} AND volume > 30, false) OR coalesce(close < pc, false)")
_three, _n = (P() > SMA5, I.Volume() > 30, I.GapSize() > 0), f"coalesce(close > {MA5}, false)::INT + coalesce(volume > 30, false)::INT + coalesce(open - pc > 0, false)::INT"
_panel("pf4_at_least", I.at_least(2, *_three), f"{_n} >= 2")
_panel("pf5_at_most", I.at_most(1, *_three), f"{_n} <= 1")
_panel("pf6_fewer_than", I.fewer_than(2, *_three), f"{_n} < 2")
_panel("pf7_exactly", I.exactly(2, *_three), f"{_n} = 2")
_panel("pf8_multi", I.multi(1, "notEqual", *_three), f"{_n} <> 1")
_panel("pf9_always", I.always(), "true")

# scalars
_panel("fn1_value", V(42), "42")
_panel("fn2_plus", I.Plus(P(), I.OpeningPrice()), "close + open")
_panel("fn3_minus", I.Minus(P(), I.OpeningPrice()), "close - open")
_panel("fn4_multiply", I.Multiply(P(), I.Volume()), "close * volume")
_panel("fn5_divide", I.Divide(P(), I.Minus(I.Volume(), 25)), "close / nullif(volume - 25, 0)")
_panel("fn6_absolute_value", I.AbsoluteValue(P() - I.OpeningPrice()), "abs(close - open)")
_panel("fn7_negative", I.Negative(P()), "-close")
_panel("fn8_exponentiation", I.Exponentiation(P() / 1000), "(close / 1000) * (close / 1000)")
_panel("fn9_square_root", I.SquareRoot(P() - I.OpeningPrice()), "CASE WHEN close - open >= 0 THEN sqrt(close - open) END")
_panel("fn10_log", I.Log(P() - I.OpeningPrice()), "CASE WHEN close - open > 0 THEN log10(close - open) END")
_panel("fn11_max", I.Max(P(), I.PreviousClosingPrice()), "CASE WHEN pc IS NOT NULL THEN greatest(close, pc) END")
_panel("fn12_min", I.Min(P(), I.PreviousClosingPrice()), "CASE WHEN pc IS NOT NULL THEN least(close, pc) END")

# calendar
_panel("fn13_year", I.Year(), "year(ts)")
_panel("fn14_month", I.Month(), "month(ts)")
_panel("fn15_day", I.Day(), "day(ts)")
_panel("fn16_date", I.Date(), "CAST(strftime(ts, '%Y%m%d') AS INT)")
_panel("fn17_hour", I.CurrentTimeHours(), "hour(ts)", True)
_panel("fn18_minute", I.CurrentTimeMinutes(), "minute(ts)", True)
_panel("fn19_second", I.CurrentTimeSeconds(), "second(ts)", True)
_panel("fn20_minutes_after_open", I.MinutesAfterOpen(), "minute", True)
_panel("fn21_minutes_until_close", I.MinutesUntilClose(), "960 - 570 - minute", True)
_panel("fn22_is_asset", I.IsAsset(7), "(ticker = 7)::INT")
_panel("fn23_is_not_asset", I.IsNotAsset(7), "(ticker <> 7)::INT")

# prices
_panel("ts1_price", P(), "close")
_panel("ts2_opening_price", I.OpeningPrice(), f"first(open) OVER {SESSION}", True)
_panel("ts3_high_of_day", I.HighOfDay(), f"max(high) OVER {SESSION}", True)
_panel("ts4_low_of_day", I.LowOfDay(), f"min(low) OVER {SESSION}", True)
_panel("ts5_previous_closing_price", I.PreviousClosingPrice(), "pc")
_panel("ts6_price_change_since_open", I.PriceChangeSinceOpen(), "close - open")
_panel("ts6_price_change_since_open_percent", I.PriceChangeSinceOpen(percent=True), "100 * (close - open) / nullif(open, 0)")
_panel("ts7_gap_size", I.GapSize(), "open - pc")
_panel("ts8_gap_percentage", I.GapPercentage(), "100 * (open / nullif(pc, 0) - 1)")
_panel("ts9_volume", I.Volume(), "volume")
_panel("ts10_vwap", I.VWAP(), f"sum((high + low + close) / 3 * volume) OVER {SESSION} / nullif(sum(volume) OVER {SESSION}, 0)", True)
_panel("ts11_simple_moving_average", I.SimpleMovingAverage(None, 20), full("avg", "close", 20))
_panel("ts11_simple_moving_average_of_fixed_asset", I.SimpleMovingAverage(7, 5), "max(CASE WHEN ticker = 7 AND n5 = 5 THEN ma5 END) OVER (PARTITION BY ts)")
_EMA = """, s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts) AS rn FROM y),
    e AS (SELECT ticker, ts, rn, {x} AS ema FROM s WHERE rn = 1 UNION ALL
        SELECT s.ticker, s.ts, s.rn, e.ema + 2.0 / 11 * ({sx} - e.ema) FROM e JOIN s ON s.ticker = e.ticker AND s.rn = e.rn + 1),
    z AS (SELECT ticker, ts, ema FROM e)"""
_panel("ts12_exponential_moving_average", I.ExponentialMovingAverage(None, 10), "ema", keep=_EMA.format(x="close", sx="s.close"))
_panel(
    "ts13_relative_strength_index",
    I.RelativeStrengthIndex(None, 14),
    f"CASE WHEN {full('avg', 'greatest(-ch, ch * 0)', 14)} = 0 THEN 100 ELSE 100 - 100 / (1 + ({full('avg', 'greatest(ch, ch * 0)', 14)}) / nullif({full('avg', 'greatest(-ch, ch * 0)', 14)}, 0)) END",
)
_panel("ts14_bollinger_band", I.BollingerBand(None, 20, num_standard_deviations=-2), f"({full('avg', 'close', 20)}) - 2 * ({full('stddev_pop', 'close', 20)})")
_panel("ts15_price_standard_deviation", I.PriceStandardDeviation(None, 20), full("stddev_samp", "close", 20))
_MAD = "CASE WHEN n10 = 10 THEN list_avg(list_transform(l10, lambda v: abs(v - list_avg(l10)))) END"
_panel("ts16_price_mean_absolute_deviation", I.PriceMeanAbsoluteDeviation(None, 10), _MAD)
_panel("ts17_price_rate_of_change", I.PriceRateOfChange(None, 10), f"100 * (close / nullif(lag(close, 10) OVER {T}, 0) - 1)")
_panel("ts18_maximum_price", I.MaximumPrice(None, 20), full("max", "close", 20))
_panel("ts19_minimum_price", I.MinimumPrice(None, 20), full("min", "close", 20))
_panel("ts20_max_drawdown", I.MaxDrawdown(None, 10), "CASE WHEN n10 = 10 THEN list_max(list_transform(range(1, 11), lambda i: 100 * (1 - l10[i] / list_max(l10[1:i])))) END")
_panel("ts21_max_drawup", I.MaxDrawup(None, 10), "CASE WHEN n10 = 10 THEN list_max(list_transform(range(1, 11), lambda i: 100 * (l10[i] / list_min(l10[1:i]) - 1))) END")
_panel(
    "ts22_underlying_max_drawdown",
    I.UnderlyingMaxDrawdown(),
    f"max(dd) OVER {T}",
    keep=f", z AS (SELECT *, 100 * (1 - close / max(close) OVER {T}) AS dd FROM y)",
)
_panel("ts23_true_range", I.TrueRange(), "tr")
_panel("ts24_average_true_range", I.AverageTrueRange(None, 14), full("avg", "tr", 14))
_panel("ts25_bullish_fair_value_gap", I.BullishFairValueGap(), "greatest(low - h2, 0)")
_panel("ts26_bearish_fair_value_gap", I.BearishFairValueGap(), "greatest(l2 - high, 0)")
_CROSS = f", z AS (SELECT *, lag({MA5}) OVER {T} AS pma FROM y)"
_panel("ts27_cross_above", I.CrossAbove(P(), SMA5), f"close > {MA5} AND pc <= pma", keep=_CROSS)
_panel("ts28_cross_below", I.CrossBelow(P(), SMA5), f"close < {MA5} AND pc >= pma", keep=_CROSS)
_UP = "coalesce(close > pc, false)"
_panel("ts29_consecutive_true", I.ConsecutiveTrue(P() > I.PreviousClosingPrice(), 3), f"coalesce({full('bool_and', _UP, 3)}, false)::INT")
_panel("ag12_count_true", I.CountTrue(P() > I.PreviousClosingPrice(), 5), full("sum", f"{_UP}::INT", 5))
_RANGE, _W20 = I.HighOfDay() - I.LowOfDay(), "high - low"
_panel("ts30_indicator_simple_moving_average", I.IndicatorSimpleMovingAverage(_RANGE, 20), full("avg", _W20, 20))
_panel("ts31_indicator_exponential_moving_average", I.IndicatorExponentialMovingAverage(P() - I.OpeningPrice(), 10), "ema", keep=_EMA.format(x="close - open", sx="s.close - s.open"))
_panel("ts32_indicator_standard_deviation", I.IndicatorStandardDeviation(_RANGE, 20), full("stddev_samp", _W20, 20))
_panel("ts33_indicator_mean_absolute_deviation", I.IndicatorMeanAbsoluteDeviation(P(), 10), _MAD)
_panel("ts34_indicator_rate_of_change", I.IndicatorRateOfChange(SMA5, 3), f"100 * (({MA5}) / nullif(lag({MA5}, 3) OVER {T}, 0) - 1)")
_panel("ts35_indicator_window_ago", I.IndicatorWindowAgo(SMA5, 3), f"lag({MA5}, 3) OVER {T}")
_panel(
    "ts36_indicator_at_minutes_after_open",
    I.IndicatorAtMinutesAfterOpen(P(), 30),
    f"CASE WHEN minute >= 30 THEN last(CASE WHEN minute <= 30 THEN close END IGNORE NULLS) OVER {SESSION} END",
    True,
)
_panel("ag13_trailing_sum", I.TrailingSum(I.Volume(), 4), full("sum", "volume", 4))
# a shared sub-tree, and a window inside a window
_RSI5 = I.RelativeStrengthIndex(None, 5)
_panel(
    "ts30_average_of_rsi_is_shared",
    I.IndicatorSimpleMovingAverage(_RSI5, 3) - _RSI5,
    f"({full('avg', 'rsi', 3)}) - rsi",
    keep=f", z AS (SELECT *, CASE WHEN {full('avg', 'greatest(-ch, ch * 0)', 5)} = 0 THEN 100 ELSE 100 - 100 / (1 + ({full('avg', 'greatest(ch, ch * 0)', 5)}) / nullif({full('avg', 'greatest(-ch, ch * 0)', 5)}, 0)) END AS rsi FROM y)",
)


def _typed(name: str, node: I.Indicator, expr: str) -> None:
    """Parts as assets: a type by their number, tags from their type and name."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = spark.read.parquet(f"{sf_dir}/part.parquet")
        panel = p.select(F.col("p_partkey").alias("ticker"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("ts"), F.when(F.col("p_partkey") % 3 == 0, "Stock").when(F.col("p_partkey") % 3 == 1, "Option").alias("asset_type"), F.split(F.concat_ws(" ", "p_type", "p_name"), " ").alias("industries"))
        return I.evaluate(panel, value=node).select("ticker", rounded("value").alias("value"))

    register(name, query, f"SELECT p_partkey AS ticker, {r(expr)} AS value FROM part")


_typed("fn24_is_asset_type", I.IsAssetType(), "coalesce(p_partkey % 3 = 0, false)::INT")
_typed("fn25_is_industry", I.IsIndustry(None, "SMALL"), "(list_contains(string_split(p_type || ' ' || p_name, ' '), 'SMALL'))::INT")


def _st5(interval: str, unit: str) -> None:
    from tidemark.operators.bars import bars

    from .common import ticks

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = bars(ticks(spark, sf_dir), interval, ["ts", "event_id"])
        return out.select("ticker", "ts", *(rounded(c).alias(c) for c in ("open", "high", "low", "close", "volume")))

    sql = MINUTES.replace("'minute'", f"'{unit}'")
    register(f"st5_bars_{unit}", query, f"WITH {sql} SELECT ticker, ts, {', '.join(f'{r(c)} AS {c}' for c in ('open', 'high', 'low', 'close', 'volume'))} FROM bars")


for _i, _u in (("Day", "day"), ("Hour", "hour"), ("Minute", "minute")):
    _st5(_i, _u)
