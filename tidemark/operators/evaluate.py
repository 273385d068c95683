"""Set-based evaluation of weight panels: returns, fitness, parameter sweeps, walk-forward folds.

A weight panel has a row for each parameter set (keys), time and ticker. A bar's weight earns the
next bar's return. Trading inside a bar, fills and margin are not modelled.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .select import order_of

# Names of fitness functions, and those of which less is better.
FITNESS = ("sharpeRatio", "sortinoRatio", "maxDrawdown", "avgDrawdown", "percentChange", "dollarsSold", "ulcerPerformanceIndex", "participationRate", "distinctUnderlyingsTraded", "medianDeployment")
SMALLER_IS_BETTER = ("maxDrawdown", "avgDrawdown")


def backtest(weights: DataFrame, rets: DataFrame, keys: list[str] | None = None, cost_bps: float = 10.0, initial_value: float = 10_000, start: object = None, end: object = None, key: str = "ticker", time: str = "ts") -> DataFrame:
    """keys, ts, ret, turnover, sold, deployed, names, equity of each bar that has returns.

    rets: ticker, ts, ret (a bar's return from the bar before). ret of the book = sum of the weights
    set at the bar before times returns, less cost_bps of the turnover. sold: the share of the value
    that was sold; a name that is no longer listed has been sold.
    """
    keys = keys or []
    inside = rets if start is None else rets.where(F.col(time) >= F.lit(start))
    inside = inside if end is None else inside.where(F.col(time) <= F.lit(end))
    # the market's calendar: each bar's next one, a row for each bar whatever the names
    calendar = inside.select(time).distinct().withColumn("__next", F.lead(time).over(Window.orderBy(time)))
    w = weights.join(calendar, time).withColumn("__side", F.explode(F.array(F.lit(0), F.lit(1))))
    later = F.col("__side") == 1
    at = F.when(later, F.col("__next")).otherwise(F.col(time)).alias(time)
    sides = w.select(*keys, key, at, F.when(later, 0.0).otherwise(F.col("weight")).alias("weight"), F.when(later, F.col("weight")).otherwise(0.0).alias("was")).where(F.col(time).isNotNull())
    moved = sides.groupBy(*keys, key, time).agg(F.sum("weight").alias("weight"), F.sum("was").alias("was"))
    earned = moved.join(inside.select(key, time, "ret"), [key, time], "left")
    book = earned.groupBy(*keys, time).agg(
        F.sum(F.col("was") * F.coalesce("ret", F.lit(0.0))).alias("gross"),
        F.sum(F.abs(F.col("weight") - F.col("was"))).alias("turnover"),
        F.sum(F.greatest(F.col("was") - F.col("weight"), F.lit(0.0))).alias("sold"),
        F.sum("weight").alias("deployed"),
        F.count_if(F.col("weight") > 0).alias("names"),
    )
    out = book.select(*keys, time, (F.col("gross") - F.col("turnover") * cost_bps / 10_000).alias("ret"), "turnover", "sold", "deployed", "names")
    path = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    growth = F.exp(F.sum(F.log(F.greatest(1 + F.col("ret"), F.lit(1e-12)))).over(path))
    return out.withColumn("equity", initial_value * growth)


def buy_and_hold(panel: DataFrame, symbol: object, initial_value: float = 10_000, key: str = "ticker", time: str = "ts", price: str = "close") -> DataFrame:
    one = panel.where(F.col(key) == symbol)
    first = F.first(price).over(Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, 0))
    return one.select(time, (initial_value * F.try_divide(price, first)).alias("baseline"))


def fees(trades: DataFrame, config: dict[str, tuple[str, float]], asset_type: str = "asset_type", dollars: str = "dollars") -> DataFrame:
    """trades with fee by asset type: ("percent", p) of the amount, or ("dollars", d)."""
    fee: Column = F.lit(0.0)
    for kind, (how, much) in config.items():
        fee = F.when(F.col(asset_type) == kind, F.abs(dollars) * much / 100 if how == "percent" else F.lit(float(much))).otherwise(fee)
    return trades.withColumn("fee", fee)


def fitness(path: DataFrame, keys: list[str], traded: DataFrame | None = None, periods: int = 252, time: str = "ts", key: str = "ticker") -> DataFrame:
    """All fitness functions of each parameter set's backtest() rows. traded: the weights, for names traded."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    d = path.withColumn("dd", 100 * (1 - F.col("equity") / F.max("equity").over(w)))
    year = periods**0.5
    down = F.sqrt(F.avg(F.pow(F.least("ret", F.lit(0.0)), F.lit(2))))
    ulcer = F.sqrt(F.avg(F.pow("dd", F.lit(2))))
    change = 100 * (F.try_divide(F.max_by("equity", time), F.min_by(F.col("equity") / (1 + F.col("ret")), time)) - 1)
    out = d.groupBy(*keys).agg(
        (F.try_divide(F.avg("ret"), F.stddev_samp("ret")) * year).alias("sharpeRatio"),
        (F.try_divide(F.avg("ret"), down) * year).alias("sortinoRatio"),
        F.max("dd").alias("maxDrawdown"),
        F.avg("dd").alias("avgDrawdown"),
        change.alias("percentChange"),
        F.sum(F.col("sold") * F.col("equity")).alias("dollarsSold"),
        F.try_divide(change, ulcer).alias("ulcerPerformanceIndex"),
        F.avg((F.col("names") > 0).cast("double")).alias("participationRate"),
        F.percentile("deployed", F.lit(0.5)).alias("medianDeployment"),
    )
    if traded is None:
        return out
    return out.join(traded.where("weight > 0").groupBy(*keys).agg(F.count_distinct(key).alias("distinctUnderlyingsTraded")), keys, "left")


def combinations(genes: dict[str, list]) -> list[dict[str, object]]:
    """Every combination of the genes, each with its param_id."""
    return [{"param_id": i, **dict(zip(genes, v, strict=True))} for i, v in enumerate(product(*genes.values()))]


def grid(spark: SparkSession, genes: dict[str, list]) -> DataFrame:
    """param_id and a column for each gene: every combination. Grids are parameters, small by nature."""
    rows = [tuple(p.values()) for p in combinations(genes)]
    return spark.createDataFrame(rows, ["param_id", *genes])


def over(panel: DataFrame, params: DataFrame) -> DataFrame:
    """The panel once for each parameter set, the parameters broadcast."""
    return panel.crossJoin(F.broadcast(params))


def by_limit(candidates: DataFrame, metric: str, params: list[dict[str, object]], limit: str, direction: str = "Highest", key: str = "ticker", time: str = "ts") -> DataFrame:
    """select_top() for parameter sets that differ in how many they select: candidates with the set's columns.

    Candidates are ranked once, as far as the largest limit; a rank then goes to each set whose limit
    reaches it. params: what grid() is made of; its sets cost only the rows that they select.
    """
    most = max((p[limit] for p in params), default=0)
    w = Window.partitionBy(time).orderBy(*order_of(metric, direction, key))
    ranked = candidates.where(F.col(metric).isNotNull()).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most)
    sets = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in p.items())) for p in params))
    held = F.explode(F.filter(sets, lambda p: p[limit] >= F.col("__n")))
    return ranked.withColumn("__set", held).select(*candidates.columns, "__set.*")


def chosen(options: dict[object, Column], gene: str) -> Column:
    """The option that the gene's column names: sweeps conditions, signals, structures or policies."""
    return reduce(lambda rest, kv: F.when(F.col(gene) == kv[0], kv[1]).otherwise(rest), options.items(), F.lit(None))


def select_by_policy(scores: DataFrame, objectives: list[str], floors: dict[str, float] | None = None, tie: str = "param_id", within: list[str] | None = None) -> DataFrame:
    """scores with rank: candidates that meet every floor first, then by the objectives in order, then by tie."""
    meets = reduce(lambda a, b: a & b, (F.coalesce(F.col(k) >= v, F.lit(False)) for k, v in (floors or {}).items()), F.lit(True))
    order = [F.asc_nulls_last(o) if o in SMALLER_IS_BETTER else F.desc_nulls_last(o) for o in objectives]
    out = scores.withColumn("meets_floors", meets)
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(*(within or [])).orderBy(F.desc("meets_floors"), *order, tie)))


def folds(spark: SparkSession, start: dt.date, end: dt.date, count: int, mode: str = "rolling", oos_days: int = 252, validation_percent: float = 25, embargo_days: int = 14) -> DataFrame:
    """fold, role (train, validation, test), from, to (both ends in). The last test ends at `end`.

    Before each test of oos_days lies an embargo, before that the validation part and the training
    part; anchored training always begins at `start`, rolling keeps the first fold's length.
    """
    if not 2 <= count <= 8:
        raise ValueError("2 to 8 folds")
    day = dt.timedelta(days=1)
    rows, length = [], None
    for k in range(count):
        test_to = end - day * oos_days * (count - 1 - k)
        test_from = test_to - day * (oos_days - 1)
        known_to = test_from - day * (embargo_days + 1)
        known = (known_to - start).days + 1
        length = length or known
        known_from = start if mode == "anchored" else known_to - day * (length - 1)
        if length < 2 or known_from > known_to:
            raise ValueError("the range is too short for these folds")
        split = known_from + day * int(((known_to - known_from).days + 1) * (1 - validation_percent / 100))
        rows += [(k, "train", known_from, split - day), (k, "validation", split, known_to), (k, "test", test_from, test_to)]
    return spark.createDataFrame(rows, "fold int, role string, `from` date, `to` date")


def windows(spark: SparkSession, start: dt.date, end: dt.date, count: int, overlap_percent: float = 0) -> DataFrame:
    """fold, role 'window', from, to: equal windows over the range, each overlapping the one before."""
    total = (end - start).days + 1
    width = int(total / (count - (count - 1) * overlap_percent / 100))
    step = width * (1 - overlap_percent / 100)
    rows = [(k, "window", start + dt.timedelta(days=int(k * step)), start + dt.timedelta(days=int(k * step) + width - 1)) for k in range(count)]
    return spark.createDataFrame(rows, "fold int, role string, `from` date, `to` date")


def by_fold(path: DataFrame, fold_table: DataFrame, time: str = "ts") -> DataFrame:
    """path's rows with each fold and role that they fall in; the fold table is a few rows."""
    day = F.to_date(time)
    return path.join(F.broadcast(fold_table), (day >= F.col("from")) & (day <= F.col("to"))).drop("from", "to")


def walk_forward(path: DataFrame, fold_table: DataFrame, objective: str = "sharpeRatio", floors: dict[str, float] | None = None, param: str = "param_id") -> DataFrame:
    """For each fold the winner of its validation part: fold, param, validation, train, test, degradation."""
    scores = fitness(by_fold(path, fold_table), ["fold", "role", param])
    ranked = select_by_policy(scores.where("role = 'validation'"), [objective], floors, param, ["fold"]).where("rank = 1")
    out = ranked.select("fold", param, F.col(objective).alias("validation"))
    for role in ("train", "test"):
        out = out.join(scores.where(F.col("role") == role).select("fold", param, F.col(objective).alias(role)), ["fold", param], "left")
    return out.withColumn("degradation", F.col("train") - F.col("validation"))
