"""Queries of universes, ranking, weights, rebalancing, evaluation and sweeps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import indicators as I
from tidemark.operators import evaluate as E
from tidemark.operators import select as K
from tidemark.operators import stats as S
from tidemark.sources.storage import written

from .common import DAILY, STEPS, T, daily, full, r, register, rounded, table


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with the indicators that the strategies rank and filter by."""
    return I.evaluate(daily(spark, sf_dir), ma=I.SimpleMovingAverage(None, 20), roc=I.PriceRateOfChange(None, 10), up=I.Price() > I.SimpleMovingAverage(None, 20), metric=I.Volume())


PANEL = f"""{DAILY}, {STEPS}, p AS (SELECT *, {full('avg', 'close', 20)} AS ma, round(100 * (close / nullif(lag(close, 10) OVER {T}, 0) - 1), 6) AS roc, volume AS metric FROM y),
    pp AS (SELECT *, coalesce(close > ma, false) AS up FROM p)"""


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).withColumn("roc", F.round("roc", 6))


def _q(name: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    register(name, lambda spark, sf_dir: build(ranked(spark, sf_dir)), f"WITH {PANEL}{sql if sql.startswith(',') else ' ' + sql}")


_q("pf10_filter", lambda p: p.where("up").select("ticker", "ts"), "SELECT ticker, ts FROM pp WHERE up")
_q("rk1_select_top", lambda p: K.select_top(p, "roc", 5).select("ticker", "ts"), "SELECT ticker, ts FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n FROM pp WHERE roc IS NOT NULL) WHERE n <= 5")
_q("rk1_select_lowest", lambda p: K.select_top(p, "roc", 3, "Lowest").select("ticker", "ts"), "SELECT ticker, ts FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc, ticker) AS n FROM pp WHERE roc IS NOT NULL) WHERE n <= 3")
_q("rk2_select_percentile", lambda p: K.select_percentile(p, "roc", 10).select("ticker", "ts"), "SELECT ticker, ts FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n, count(*) OVER (PARTITION BY ts) AS c FROM pp WHERE roc IS NOT NULL) WHERE n <= ceil(c * 0.1)")


def book(p: DataFrame) -> DataFrame:
    """The flagship: above the average, five best by rate of change, equal weights."""
    return K.dynamic_rebalance(p, [lambda d: d.where("up"), lambda d: K.select_top(d, "roc", 5)])


BOOK = "w AS (SELECT ts, ticker, 1.0 / count(*) OVER (PARTITION BY ts) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n FROM pp WHERE up AND roc IS NOT NULL) WHERE n <= 5)"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book(ranked(spark, sf_dir)).select("ts", "ticker", rounded("weight").alias("weight"))


register("rk3_dynamic_rebalance", flagship, f"WITH {PANEL}, {BOOK} SELECT ts, ticker, {r('weight')} AS weight FROM w")
_q(
    "rk3_signal_weights",
    lambda p: K.dynamic_rebalance(p, [lambda d: d.where("up")], "roc", 8, 90, 40).select("ts", "ticker", rounded("weight").alias("weight")),
    f"SELECT ts, ticker, {r('least(coalesce(greatest(roc, 0) / nullif(sum(greatest(roc, 0)) OVER (PARTITION BY ts), 0), 0) * 0.9, 0.4)')} AS weight FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n FROM pp WHERE up AND roc IS NOT NULL) WHERE n <= 8",
)
_q(
    "rk3_can_sell",
    lambda p: K.dynamic_rebalance(p, [lambda d: K.select_top(d, "roc", 5)], can_sell=F.col("up")).select("ts", "ticker", rounded("weight").alias("weight")),
    f""", v AS (SELECT ts, ticker, 1.0 / count(*) OVER (PARTITION BY ts) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n FROM pp WHERE roc IS NOT NULL) WHERE n <= 5),
    a AS (SELECT pp.ts, pp.ticker, last_value(CASE WHEN v.weight IS NOT NULL THEN v.weight WHEN pp.up THEN -1 END IGNORE NULLS) OVER (PARTITION BY pp.ticker ORDER BY pp.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS weight FROM pp LEFT JOIN v ON v.ts = pp.ts AND v.ticker = pp.ticker)
    SELECT ts, ticker, {r('weight')} AS weight FROM a WHERE weight >= 0""",
)
_q(
    "rk5_sleeves",
    lambda p: K.sleeves({"a": K.weights(K.select_top(p, "roc", 2)), "b": K.weights(K.select_top(p.where("up"), "metric", 3), "metric")}).select("sleeve", "ts", "ticker", rounded("weight").alias("weight")),
    f"""SELECT 'a' AS sleeve, ts, ticker, {r('1.0 / count(*) OVER (PARTITION BY ts)')} AS weight FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n FROM pp WHERE roc IS NOT NULL) WHERE n <= 2
    UNION ALL SELECT 'b', ts, ticker, {r('metric / sum(metric) OVER (PARTITION BY ts)')} FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY metric DESC, ticker) AS n FROM pp WHERE up) WHERE n <= 3""",
)
_HIGH = I.Price() > I.SimpleMovingAverage(None, 20)
_q(
    "rk6_strategy",
    lambda p: K.strategy(p, "trend", _HIGH, lambda d: K.intents(d, "buy", 5, portfolio_value=10_000)).select("strategy", "ticker", "ts", "action", rounded("dollars").alias("dollars")),
    f"SELECT 'trend' AS strategy, ticker, ts, 'buy' AS action, {r('500')} AS dollars FROM pp WHERE up",
)
_q(
    "rk7_portfolio",
    lambda p: K.portfolio([K.strategy(p, "in", _HIGH, lambda d: K.intents(d, "buy", 100, "dollars")), K.strategy(p, "out", I.Price() < 900, lambda d: K.intents(d, "sell", 2, "num assets"))]).select("strategy", "priority", "ticker", "ts", "action", rounded("dollars").alias("dollars")),
    f"SELECT 'in' AS strategy, 0 AS priority, ticker, ts, 'buy' AS action, {r('100')} AS dollars FROM pp WHERE up UNION ALL SELECT 'out', 1, ticker, ts, 'sell', {r('2 * close')} FROM pp WHERE close < 900",
)
_q("rk8_buy", lambda p: K.intents(p, "buy", 10, "percent of buying power", buying_power=F.col("volume") * 100).select("ticker", "ts", rounded("dollars").alias("dollars")), f"SELECT ticker, ts, {r('volume * 10')} AS dollars FROM pp")
_q("rk9_sell", lambda p: K.intents(p, "sell", 50, "percent of current positions", position_value=F.col("close") * 4).select("ticker", "ts", rounded("dollars").alias("dollars")), f"SELECT ticker, ts, {r('close * 2')} AS dollars FROM pp")
_q("rk10_alert", lambda p: K.strategy(p, "watch", I.Price() > 2000, K.alert("high")).select("ticker", "ts", "action", "message"), "SELECT ticker, ts, 'alert' AS action, 'high' AS message FROM pp WHERE close > 2000")

# names and eligibility
register("pf12_stock_asset", lambda s, d: table(s, d, "customer").select("c_custkey", K.stock_asset("c_name").alias("symbol")), "SELECT c_custkey, upper(trim(c_name)) AS symbol FROM customer")
# Symbols as users state them: brands and segments with blanks, in either case, some with the pair's end.
_SYMBOL = "CASE p_partkey % 4 WHEN 0 THEN lower(p_brand) WHEN 1 THEN concat(' ', p_brand, ' ') WHEN 2 THEN concat(p_brand, '-usd') ELSE substring(p_brand, 1, p_partkey % 3) END"
register(
    "pf13_crypto_asset",
    lambda s, d: table(s, d, "part").select("p_partkey", K.crypto_asset(F.expr(_SYMBOL)).alias("pair")),
    f"SELECT p_partkey, CASE WHEN s = '' THEN NULL WHEN s LIKE '%-USD' THEN s ELSE s || '-USD' END AS pair FROM (SELECT p_partkey, upper(trim({_SYMBOL})) AS s FROM part)",
)


def _parts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 11 != 0, F.col("p_retailprice")).alias("market_cap"), F.when(F.col("p_partkey") % 13 != 0, F.split("p_type", " ")).alias("industries"))


_PARTS = "q AS (SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS cap, CASE WHEN p_partkey % 13 <> 0 THEN string_split(p_type, ' ') END AS tags FROM part)"
register("pf14_eligibility_any", lambda s, d: K.eligible(_parts(s, d), 950, 1800, ["SMALL", "PROMO"]).select("p_partkey"), f"WITH {_PARTS} SELECT p_partkey FROM q WHERE cap >= 950 AND cap <= 1800 AND list_has_any(tags, ['SMALL', 'PROMO'])")
register("pf14_eligibility_all", lambda s, d: K.eligible(_parts(s, d), None, None, ["ECONOMY"], "ALL").select("p_partkey"), f"WITH {_PARTS} SELECT p_partkey FROM q WHERE list_has_all(tags, ['ECONOMY'])")
register(
    "pf15_approved_per_day",
    lambda s, d: K.approved_per_day(table(s, d, "events"), 2, ["user_id"], order=["event_id"]).select("event_id"),
    "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, CAST(ts - INTERVAL 5 HOUR AS DATE) ORDER BY ts, event_id) AS n FROM events) WHERE n <= 2",  # January: five hours behind
)

# what a rebalance would do: the flagship book against the one by volume
_TARGET = lambda p: K.weights(K.select_top(p, "roc", 3)).select("ts", "ticker", "weight")
_CURRENT = lambda p: K.weights(K.select_top(p, "metric", 4), "metric").select("ts", "ticker", "weight")
_CH = f"""ta AS (SELECT ts, ticker, 1.0 / count(*) OVER (PARTITION BY ts) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY roc DESC, ticker) AS n FROM pp WHERE roc IS NOT NULL) WHERE n <= 3),
    cu AS (SELECT ts, ticker, metric / sum(metric) OVER (PARTITION BY ts) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY metric DESC, ticker) AS n FROM pp) WHERE n <= 4),
    ch AS (SELECT coalesce(ta.ts, cu.ts) AS ts, coalesce(ta.ticker, cu.ticker) AS ticker, coalesce(ta.weight, 0) - coalesce(cu.weight, 0) AS change FROM ta FULL JOIN cu ON ta.ts = cu.ts AND ta.ticker = cu.ticker),
    mn AS (SELECT ticker, avg(close / pc - 1) AS mean FROM pp GROUP BY 1),
    me AS (SELECT ts, sum(abs(change)) AS turnover, sum(change * coalesce(mean, 0) * 0.5) * 50000 AS benefit FROM ch LEFT JOIN mn USING (ticker) GROUP BY 1)"""


def _means(p: DataFrame) -> DataFrame:
    return K.returns(p).groupBy("ticker").agg(F.avg("ret").alias("mean"))


for _name, _metric, _sql in (
    ("rk13_allocation_drift", "allocationDrift", "turnover / 2"),
    ("rk14_planned_turnover", "plannedTurnover", "turnover"),
    ("rk15_estimated_cost", "estimatedCost", "turnover * 0.001 * 50000"),
    ("rk16_expected_benefit", "expectedBenefit", "benefit"),
    ("rk17_net_benefit", "netBenefit", "benefit - turnover * 0.001 * 50000"),
):
    _q(_name, lambda p, m=_metric: K.plan_metric(K.plan_metrics(K.weight_changes(_TARGET(p), _CURRENT(p)), _means(p), 50_000), m).select("ts", rounded("value").alias("value")), f", {_CH} SELECT ts, {r(_sql)} AS value FROM me")


def _cov(p: DataFrame) -> DataFrame:
    return K.covariance(K.returns(p))


_CV = """re AS (SELECT ticker, ts, close / pc - 1 AS ret FROM pp WHERE pc IS NOT NULL),
    cv AS (SELECT a.ticker AS i, b.ticker AS j, count(*) AS n, covar_samp(a.ret, b.ret) * CASE WHEN a.ticker = b.ticker THEN 1 ELSE 0.75 END AS cov FROM re a JOIN re b USING (ts) GROUP BY 1, 2 HAVING count(*) >= 20)"""
_EQ = f"eq AS (SELECT ticker, CASE k WHEN 0 THEN 0.01 ELSE (ticker + 1) / 5050.0 END AS weight, k FROM (SELECT DISTINCT ticker FROM re), (SELECT unnest([0, 1]) AS k))"


def _two_books(rets: DataFrame) -> DataFrame:
    names = rets.select("ticker").distinct()
    return names.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("weight", F.when(F.col("k") == 0, 0.01).otherwise((F.col("ticker") + 1) / 5050))


def _stored(p: DataFrame) -> DataFrame:
    return K.stored_returns(K.returns(p))


def _book_variance(rets: DataFrame) -> DataFrame:
    return K.book_variance(_two_books(rets), rets, ["k"])


def _volatility_target(rets: DataFrame) -> DataFrame:
    return K.volatility_target(_two_books(rets), None, ["k"], variance=_book_variance(rets))


def _diversification_ratio(rets: DataFrame) -> DataFrame:
    return K.diversification_ratio(_two_books(rets), K.variances(rets), ["k"], _book_variance(rets))


def _utilities(rets: DataFrame) -> DataFrame:
    means = rets.groupBy("ticker").agg(F.avg("ret").alias("mean"))
    return K.utilities(_two_books(rets), means, None, ["k"], variance=_book_variance(rets))


_VAR = "va AS (SELECT a.k, sum(a.weight * b.weight * cov) AS variance FROM eq a JOIN eq b ON a.k = b.k JOIN cv ON cv.i = a.ticker AND cv.j = b.ticker GROUP BY 1)"
_q("rk19_covariance_panel", lambda p: _cov(p).select("i", "j", "n", rounded("cov").alias("cov")), f", {_CV} SELECT i, j, n, {r('cov')} AS cov FROM cv")
_q("rk18_volatility_target", lambda p: _volatility_target(_stored(p)).select("k", rounded("scale").alias("scale")), f", {_CV}, {_EQ}, {_VAR} SELECT k, {r('least(1.0, 12 / (sqrt(variance * 252) * 100))')} AS scale FROM va")
_q("rk20_inverse_volatility", lambda p: K.inverse_volatility(K.variances(K.returns(p))).select("ticker", rounded("weight").alias("weight")), f", {_CV} SELECT i AS ticker, {r('1 / sqrt(cov) / sum(1 / sqrt(cov)) OVER ()')} AS weight FROM cv WHERE i = j")
_q("rk21_diversification_ratio", lambda p: _diversification_ratio(_stored(p)).select("k", rounded("ratio").alias("ratio")), f", {_CV}, {_EQ}, {_VAR}, ms AS (SELECT k, sum(weight * sqrt(cov)) AS m FROM eq JOIN cv ON i = j AND i = ticker GROUP BY 1) SELECT k, {r('m / sqrt(variance)')} AS ratio FROM ms JOIN va USING (k)")
_q(
    "rk22_mean_variance_choice",
    lambda p: K.best_candidate(_utilities(_stored(p)), "k").select("k", rounded("utility").alias("utility")),
    f", {_CV}, {_EQ}, {_VAR}, mn AS (SELECT ticker, avg(ret) AS mean FROM re GROUP BY 1), ut AS (SELECT k, sum(weight * mean * 0.5) - 2 * any_value(variance) AS u FROM eq JOIN mn USING (ticker) JOIN va USING (k) GROUP BY 1) SELECT k, {r('u')} AS utility FROM ut ORDER BY u DESC, k LIMIT 1",
)

# -- evaluation --------------------------------------------------------------------------------------


def _path(p: DataFrame) -> DataFrame:
    p = written(p.select("ticker", "ts", "close", "roc", "up"), "panel")  # read for the book, the returns and the calendar
    return E.backtest(book(p), K.returns(p))


def _path_sql(weights: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    on = f"m.{keys}, " if keys else ""
    return f"""re AS (SELECT ticker, ts, close / pc - 1 AS ret FROM pp WHERE pc IS NOT NULL), nb AS (SELECT ts, row_number() OVER (ORDER BY ts) AS k FROM (SELECT DISTINCT ts FROM re)),
    ww AS (SELECT {k}ticker, nb.k AS kk, weight FROM {weights} JOIN nb USING (ts)),
    mv AS (SELECT {k}ticker, kk, sum(weight) AS weight, sum(was) AS was FROM (SELECT {k}ticker, kk, weight, 0.0 AS was FROM ww UNION ALL SELECT {k}ticker, kk + 1, 0.0, weight FROM ww) GROUP BY ALL),
    bk AS (SELECT {on}nb.ts, sum(was * coalesce(ret, 0)) - sum(abs(weight - was)) * 0.001 AS ret, sum(abs(weight - was)) AS turnover, sum(greatest(was - weight, 0)) AS sold, sum(weight) AS deployed, count(*) FILTER (weight > 0) AS names
        FROM mv m JOIN nb ON nb.k = m.kk LEFT JOIN re ON re.ticker = m.ticker AND re.ts = nb.ts GROUP BY {on}nb.ts),
    pa AS (SELECT *, 10000 * exp(sum(ln(greatest(1 + ret, 1e-12))) OVER ({'PARTITION BY ' + keys if keys else ''} ORDER BY ts)) AS equity FROM bk)"""


_q(
    "ev1_backtest",
    lambda p: _path(p).select("ts", rounded("ret").alias("ret"), rounded("turnover").alias("turnover"), rounded(F.col("equity") / 10_000).alias("growth"), "names"),
    f", {BOOK}, {_path_sql('w')} SELECT ts, {r('ret')} AS ret, {r('turnover')} AS turnover, {r('equity / 10000')} AS growth, names FROM pa",
)
_q("ev1_baseline", lambda p: E.buy_and_hold(p, 7).select("ts", rounded("baseline").alias("baseline")), f"SELECT ts, {r('10000 * close / first(close) OVER (ORDER BY ts)')} AS baseline FROM pp WHERE ticker = 7")
_q(
    "ev1_fees",
    lambda p: E.fees(p.select("ticker", "ts", F.when(F.col("ticker") % 2 == 0, "Stock").otherwise("Option").alias("asset_type"), F.col("close").alias("dollars")), {"Stock": ("percent", 0.1), "Option": ("dollars", 0.65)}).select("ticker", "ts", rounded("fee").alias("fee")),
    f"SELECT ticker, ts, {r('CASE WHEN ticker % 2 = 0 THEN close * 0.001 ELSE 0.65 END')} AS fee FROM pp",
)


def swept(p: DataFrame, genes: dict[str, list], build: Callable[[DataFrame], DataFrame], before: Callable[[DataFrame], DataFrame] = lambda p: p) -> DataFrame:
    """Backtest rows of every combination of the genes. before: what is done with the panel whatever the genes, once for all."""
    p = written(p.select("ticker", "ts", "close", "volume", "roc", "metric", "up"), "panel")  # read for the books, the returns and the calendar
    return E.backtest(build(E.over(before(p), E.grid(p.sparkSession, genes))).select("param_id", "ts", "ticker", "weight"), K.returns(p), ["param_id"])


def swept_limits(p: DataFrame, metric: str, limits: list[int]) -> DataFrame:
    """Backtest rows of the best by metric, for each number of names: ranked once for all."""
    p = written(p.select("ticker", "ts", "close", metric), "panel")
    best = E.by_limit(p, metric, E.combinations({"k": limits}), "k")
    return E.backtest(K.weights(best, keys=["param_id"]).select("param_id", "ts", "ticker", "weight"), K.returns(p), ["param_id"])


_KEYS = ["param_id", "ts"]


def _by(p: DataFrame, metric: str, limit: object) -> DataFrame:
    return K.weights(K.select_top(p, metric, limit, keys=["param_id"]), keys=["param_id"])


def _best(p: DataFrame) -> DataFrame:
    return K.select_top(p, "roc", 3)


def _fit(path: DataFrame) -> DataFrame:
    # prices of the test tables leap, so growth is compared by its logarithm
    f = E.fitness(path, ["param_id"])
    f = f.withColumns({"percentChange": F.log(F.greatest(1 + F.col("percentChange") / 100, F.lit(1e-12))), "ulcerPerformanceIndex": F.log(F.abs("ulcerPerformanceIndex"))})
    return f.select("param_id", *(rounded(c).alias(c) for c in ("sharpeRatio", "sortinoRatio", "maxDrawdown", "avgDrawdown", "percentChange", "ulcerPerformanceIndex", "participationRate", "medianDeployment")))


_FIT = f""", dw AS (SELECT *, 100 * (1 - equity / max(equity) OVER (PARTITION BY param_id ORDER BY ts)) AS dd FROM pa), ft AS (SELECT param_id, avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(252) AS sh, avg(ret) / nullif(sqrt(avg(pow(least(ret, 0), 2))), 0) * sqrt(252) AS so, max(dd) AS md, avg(dd) AS ad,
    100 * (arg_max(equity, ts) / arg_min(equity / (1 + ret), ts) - 1) AS pc, sqrt(avg(dd * dd)) AS ul, avg((names > 0)::INT) AS pr, quantile_cont(deployed, 0.5) AS de FROM dw GROUP BY 1)
    SELECT param_id, {r('sh')} AS "sharpeRatio", {r('so')} AS "sortinoRatio", {r('md')} AS "maxDrawdown", {r('ad')} AS "avgDrawdown", {r('ln(greatest(1 + pc / 100, 1e-12))')} AS "percentChange", {r('ln(abs(pc / nullif(ul, 0)))')} AS "ulcerPerformanceIndex", {r('pr')} AS "participationRate", {r('de')} AS "medianDeployment" FROM ft"""


def _gene(name: str, genes: dict[str, list], build: Callable[[DataFrame], DataFrame] | None, weights: str, path: Callable[[DataFrame], DataFrame] | None = None, before: Callable[[DataFrame], DataFrame] = lambda p: p) -> None:
    """weights: SQL for param_id, ts, ticker, weight from pp and g (the grid). path: the backtest's rows, else made of build and before."""
    names = list(genes)
    from itertools import product

    values = ", ".join(str((i, *v)) for i, v in enumerate(product(*genes.values())))
    grid = f"g AS (SELECT * FROM (VALUES {values}) t(param_id, {', '.join(names)}))"
    _q(name, lambda p: _fit(path(p) if path else swept(p, genes, build, before)), f", {grid}, w AS ({weights}), {_path_sql('w', 'param_id')}{_FIT}")


_EQW = "SELECT param_id, ts, ticker, {scale} / count(*) OVER (PARTITION BY param_id, ts) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY param_id, ts ORDER BY {metric} DESC, ticker) AS n FROM pp, g WHERE {where}) WHERE n <= {limit}"


def _sql(metric: str = "roc", where: str = "roc IS NOT NULL", limit: object = 3, scale: str = "1.0") -> str:
    return _EQW.format(metric=metric, where=where, limit=limit, scale=scale)


_gene("ev4_fitness", {"k": [1, 2, 3]}, None, _sql(limit="k"), lambda p: swept_limits(p, "roc", [1, 2, 3]))
_gene("ev7_gene_subject", {"subject": [1, 4, 7]}, lambda p: _by(p.where(F.col("ticker") == F.col("subject")), "roc", 1), _sql(where="roc IS NOT NULL AND ticker = subject", limit=1))
_ENTRY = lambda: {0: F.col("up"), 1: F.col("roc") > 5}
_gene("ev8_gene_entry_condition", {"entry": [0, 1]}, lambda p: _by(p.where(F.coalesce(E.chosen(_ENTRY(), "entry"), F.lit(False))), "roc", 3), _sql(where="roc IS NOT NULL AND CASE entry WHEN 0 THEN up ELSE roc > 5 END"))
_EXIT = lambda: {0: F.col("roc") < -5, 1: ~F.col("up")}
_gene("ev9_gene_exit_condition", {"leave": [0, 1]}, lambda p: _by(p.where(~F.coalesce(E.chosen(_EXIT(), "leave"), F.lit(False))), "roc", 3), _sql(where="roc IS NOT NULL AND NOT coalesce(CASE leave WHEN 0 THEN roc < -5 ELSE NOT up END, false)"))
_gene("ev11_gene_rank_signal", {"signal": ["roc", "metric"]}, lambda p: _by(p.where("roc is not null").withColumn("m", E.chosen({"roc": F.col("roc"), "metric": F.col("metric")}, "signal")), "m", 3), _sql(metric="CASE signal WHEN 'roc' THEN roc ELSE metric END"))
for _id, _g in (("ev12_gene_buying_power_pct", "power"), ("ev13_gene_allocation_pct", "allocation"), ("ev14_gene_total_budget_pct", "budget"), ("ev15_gene_deployment_pct", "deployment")):
    _gene(_id, {_g: [25, 50, 100]}, lambda p, g=_g: K.weights(p, keys=["param_id"]).withColumn("weight", F.col("weight") * F.col(g) / 100), _sql(scale=f"{_g} / 100.0"), before=_best)


def _policy(best: DataFrame) -> DataFrame:
    return K.weights(best.withColumn("signal", E.chosen({"equal": F.lit(1.0), "signal": F.col("metric")}, "policy")), "signal", keys=["param_id"])


_gene("ev20_gene_allocation_policy", {"policy": ["equal", "signal"]}, _policy, _sql().replace("1.0 / count(*) OVER (PARTITION BY param_id, ts)", "CASE policy WHEN 'equal' THEN 1.0 / count(*) OVER (PARTITION BY param_id, ts) ELSE metric / sum(metric) OVER (PARTITION BY param_id, ts) END"), before=_best)
_gene("ev21_gene_exposure_policy", {"target": [5, 20]}, lambda p: K.weights(p, keys=["param_id"]).withColumn("weight", F.col("weight") * F.least(F.lit(1.0), F.col("target") / 100 * 5)), _sql(scale="least(1.0, target / 100.0 * 5)"), before=_best)
_gene("ev26_gene_select_top_limit", {"top": [1, 2, 5]}, lambda p: _by(p, "roc", F.col("top")), _sql(limit="top"))
_gene("ev27_gene_universe_pipeline_filter", {"f": [0, 1]}, lambda p: _by(p.where(F.coalesce(E.chosen({0: F.col("volume") > 20, 1: F.col("close") > 1500}, "f"), F.lit(False))), "roc", 3), _sql(where="roc IS NOT NULL AND CASE f WHEN 0 THEN volume > 20 ELSE close > 1500 END"))
_K3 = f", g AS (SELECT * FROM (VALUES (0, 1), (1, 2), (2, 3)) t(param_id, k)), w AS ({_sql(limit='k')}), {_path_sql('w', 'param_id')}"
_sweep = lambda p: swept_limits(p, "roc", [1, 2, 3])
_q(
    "ev5_selection_policy",
    lambda p: E.select_by_policy(E.fitness(_sweep(p), ["param_id"]).withColumns({c: F.round(c, 6) for c in ("sharpeRatio", "percentChange")}), ["sharpeRatio"], {"percentChange": 0.0}).select("param_id", "meets_floors", "rank"),
    _K3 + _FIT.replace("SELECT param_id, round", ', xx AS (SELECT param_id, round', 1) + ') SELECT param_id, coalesce("percentChange" >= 0, false) AS meets_floors, row_number() OVER (ORDER BY coalesce("percentChange" >= 0, false) DESC, "sharpeRatio" DESC NULLS LAST, param_id) AS rank FROM xx',
)
_FOLDS = {"start": dt.date(1996, 1, 1), "end": dt.date(2000, 12, 31), "count": 3}
_FSQL = "fo AS (SELECT * FROM (VALUES " + "{rows}" + ") t(fold, role, f, u))"


def _fold_rows(mode: str) -> str:
    day, out, length = dt.timedelta(days=1), [], None
    for k in range(3):
        test_to = dt.date(2000, 12, 31) - day * 252 * (2 - k)
        known_to = test_to - day * 251 - day * 15
        length = length or (known_to - dt.date(1996, 1, 1)).days + 1
        begin = dt.date(1996, 1, 1) if mode == "anchored" else known_to - day * (length - 1)
        split = begin + day * int(((known_to - begin).days + 1) * 0.75)
        out += [(k, "train", begin, split - day), (k, "validation", split, known_to), (k, "test", test_to - day * 251, test_to)]
    return ", ".join(f"({k}, '{role}', DATE '{a}', DATE '{b}')" for k, role, a, b in out)


for _mode in ("rolling", "anchored"):
    register(f"ev2_fold_calendar_{_mode}", lambda s, d, m=_mode: E.folds(s, mode=m, **_FOLDS).select("fold", "role", F.col("from").alias("f"), F.col("to").alias("u")).join(table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")), F.col("day").between(F.col("f"), F.col("u"))).groupBy("fold", "role", "f", "u").agg(F.count("*").alias("n")), f"WITH {_FSQL.format(rows=_fold_rows(_mode))} SELECT fold, role, f, u, count(*) AS n FROM fo JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN f AND u GROUP BY ALL")
_q(
    "ev2_walk_forward",
    lambda p: E.walk_forward(_sweep(p), E.folds(p.sparkSession, **_FOLDS)).select("fold", "param_id", *(rounded(c).alias(c) for c in ("validation", "train", "test", "degradation"))),
    _K3 + f", {_FSQL.format(rows=_fold_rows('rolling'))}, sc AS (SELECT fold, role, param_id, avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(252) AS s FROM pa JOIN fo ON CAST(ts AS DATE) BETWEEN f AND u GROUP BY ALL), b AS (SELECT fold, param_id, s FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY s DESC NULLS LAST, param_id) AS n FROM sc WHERE role = 'validation') WHERE n = 1) SELECT b.fold, b.param_id, {r('b.s')} AS validation, {r('a.s')} AS train, {r('t.s')} AS test, {r('a.s - b.s')} AS degradation FROM b LEFT JOIN sc a ON a.fold = b.fold AND a.param_id = b.param_id AND a.role = 'train' LEFT JOIN sc t ON t.fold = b.fold AND t.param_id = b.param_id AND t.role = 'test'",
)
_q(
    "ev3_optimization",
    lambda p: E.select_by_policy(E.fitness(E.by_fold(_sweep(p), E.windows(p.sparkSession, dt.date(1996, 1, 1), dt.date(2000, 12, 31), 3, 25)), ["fold", "param_id"]).withColumn("sharpeRatio", F.round("sharpeRatio", 6)), ["sharpeRatio"], within=["fold"]).where("rank <= 2").select("fold", "param_id", "rank", rounded("sharpeRatio").alias("sharpe")),
    _K3 + ", wi AS (SELECT k AS fold, DATE '1996-01-01' + CAST(floor(k * floor(1827 / 2.5) * 0.75) AS INT) AS f FROM (SELECT unnest([0, 1, 2]) AS k)), sc AS (SELECT fold, param_id, round(avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(252), 6) AS s FROM pa JOIN wi ON CAST(ts AS DATE) BETWEEN f AND f + CAST(floor(1827 / 2.5) AS INT) - 1 GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY s DESC NULLS LAST, param_id) AS rank FROM sc) SELECT fold, param_id, rank, " + r("s") + " AS sharpe FROM b WHERE rank <= 2",
)
register(
    "ev10_gene_entry_cooldown_days",
    lambda s, d: S.ordered_cooldown(panel(s, d).where("up").select("ticker", "ts"), ["ticker"], "ts", 5),
    f"WITH RECURSIVE {PANEL}, e AS MATERIALIZED (SELECT ticker, ts FROM pp WHERE up), c AS (SELECT ticker, min(ts) AS ts FROM e GROUP BY 1 UNION ALL SELECT e.ticker, min(e.ts) FROM c JOIN e ON e.ticker = c.ticker AND e.ts >= c.ts + INTERVAL 5 DAY GROUP BY 1) SELECT ticker, ts FROM c",
)
