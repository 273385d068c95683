"""Universes, per-time ranking and weights, rebalancing metrics, and covariance over a panel.

A candidates table has a row for each time and ticker. Ties of a metric go to the smaller ticker; a
null metric is never selected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import indicators as I
from tidemark.sources.storage import written

from .asof import in_interval

# Sources of a universe.
SOURCES = ("ALL_US_STOCKS", "SP500", "NASDAQ100", "DJIA", "CRYPTO", "SPECIFIC_ASSETS")


def stock_asset(symbol: str | Column) -> Column:
    """The symbol in upper case; null for a blank one."""
    return F.nullif(F.upper(F.trim(symbol)), F.lit(""))


def crypto_asset(symbol: str | Column) -> Column:
    """The dollar pair of a coin's symbol: -USD appended unless it is there; null for a blank one."""
    s = stock_asset(symbol)
    return F.when(s.endswith("-USD"), s).otherwise(F.concat(s, F.lit("-USD")))


def universe(panel: DataFrame, source: str, assets: list | None = None, members: DataFrame | None = None, key: str = "ticker", time: str = "ts", type_column: str = "asset_type") -> DataFrame:
    """Rows of the panel in the universe. Index universes need members (key, index, start, end)."""
    if source not in SOURCES:
        raise ValueError(f"source must be one of {SOURCES}")
    if (source == "SPECIFIC_ASSETS") != bool(assets):
        raise ValueError("SPECIFIC_ASSETS, and nothing else, has assets")
    if source == "SPECIFIC_ASSETS":
        return panel.where(F.col(key).isin(*assets))
    if source in ("ALL_US_STOCKS", "CRYPTO"):
        return panel.where(F.col(type_column) == ("Stock" if source == "ALL_US_STOCKS" else "Cryptocurrency"))
    if members is None:
        raise ValueError(f"{source} needs members")
    return in_interval(panel, members.where(F.col("index") == source), key, time, name="__in").where("__in = 1").drop("__in")


def eligible(stocks: DataFrame, min_cap: float | None = None, max_cap: float | None = None, industries: list[str] | None = None, match: str = "ANY", cap: str = "market_cap", tags: str = "industries") -> DataFrame:
    """Stocks within market-cap bounds (a missing cap is out once there is one) and industry tags."""
    for bound, test in ((min_cap, lambda c: c >= min_cap), (max_cap, lambda c: c <= max_cap)):
        if bound is not None:
            stocks = stocks.where(test(F.col(cap)))
    if industries:
        wanted = F.array(*map(F.lit, industries))
        stocks = stocks.where(F.arrays_overlap(tags, wanted) if match == "ANY" else F.size(F.array_except(wanted, F.col(tags))) == 0)
    return stocks


def approved_per_day(actions: DataFrame, most: int, keys: list[str], time: str = "ts", zone: str = "America/New_York", order: list[str] | None = None) -> DataFrame:
    """The first `most` actions of each calendar day of the zone."""
    day = F.to_date(F.from_utc_timestamp(time, zone))
    w = Window.partitionBy(*keys, day).orderBy(time, *(order or []))
    return actions.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def order_of(metric: str, direction: str, key: str) -> list[Column]:
    return [F.desc(metric) if direction == "Highest" else F.asc(metric), F.asc(key)]


def select_top(candidates: DataFrame, metric: str, limit: int | Column, direction: str = "Highest", key: str = "ticker", time: str = "ts", keys: list[str] | None = None) -> DataFrame:
    """The `limit` candidates of each time with the highest or lowest metric."""
    w = Window.partitionBy(*(keys or []), time).orderBy(*order_of(metric, direction, key))
    return candidates.where(F.col(metric).isNotNull()).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= limit).drop("__n")


def select_percentile(candidates: DataFrame, metric: str, percentile: float, direction: str = "Highest", key: str = "ticker", time: str = "ts") -> DataFrame:
    """The highest or lowest percentile of each time, rounded up to whole candidates."""
    w = Window.partitionBy(time)
    ranked = candidates.where(F.col(metric).isNotNull()).withColumns({"__n": F.row_number().over(w.orderBy(*order_of(metric, direction, key))), "__of": F.count("*").over(w)})
    return ranked.where(F.col("__n") <= F.ceil(F.col("__of") * percentile / 100)).drop("__n", "__of")


def weights(candidates: DataFrame, signal: str | None = None, deployment_percent: float = 100, per_name: float | None = None, time: str = "ts", keys: list[str] | None = None) -> DataFrame:
    """candidates with weight: in proportion to the signal (negative counts as 0), or equal; each capped at per_name percent."""
    w = Window.partitionBy(*(keys or []), time)
    own = F.greatest(F.coalesce(F.col(signal), F.lit(0.0)), F.lit(0.0)) if signal else F.lit(1.0)
    share = F.coalesce(F.try_divide(own, F.sum(own).over(w)), F.lit(0.0)) * deployment_percent / 100
    return candidates.withColumn("weight", share if per_name is None else F.least(share, F.lit(per_name / 100)))


Stage = Callable[[DataFrame], DataFrame]


def dynamic_rebalance(panel: DataFrame, pipeline: list[Stage], signal: str | None = None, limit: int | None = None, deployment_percent: float = 100, per_name: float | None = None, can_sell: Column | None = None, key: str = "ticker", time: str = "ts") -> DataFrame:
    """ts, ticker, weight: the universe through the stages in order, limited by signal, weighted.

    can_sell: a condition on the panel's rows. A name that would go while it doesn't hold keeps its
    weight, from bar to bar of its own, until it holds or the name is chosen anew.
    """
    chosen = panel
    for stage in pipeline:
        chosen = stage(chosen)
    if limit is not None:
        chosen = select_top(chosen, signal, limit, key=key, time=time) if signal else select_top(chosen.withColumn("__same", F.lit(0)), "__same", limit, key=key, time=time)
    out = weights(chosen, signal, deployment_percent, per_name, time).select(time, key, "weight")
    if can_sell is None:
        return out
    w = Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    all_ = panel.select(time, key, F.coalesce(can_sell, F.lit(False)).alias("__can")).join(out, [time, key], "left")
    # the last bar at which the name was chosen or could go decides
    settled = F.when(F.col("weight").isNotNull() | F.col("__can"), F.struct("weight"))
    return all_.select(time, key, F.last(settled, ignorenulls=True).over(w)["weight"].alias("weight")).where("weight is not null")


def sleeves(books: dict[str, DataFrame]) -> DataFrame:
    """The sub-books one under another, with their names."""
    parts = [b.withColumn("sleeve", F.lit(name)) for name, b in books.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def intents(rows: DataFrame, action: str, amount: float, allocation_type: str = "percent of portfolio", portfolio_value: Column | float = 0.0, buying_power: Column | float = 0.0, position_value: Column | float = 0.0, price: str = "close") -> DataFrame:
    """rows with action and dollars, by what the amount is a share or count of."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    kinds = {
        "percent of portfolio": as_column(portfolio_value) * amount / 100,
        "percent of buying power": as_column(buying_power) * amount / 100,
        "percent of current positions": as_column(position_value) * amount / 100,
        "dollars": F.lit(float(amount)),
        "num assets": F.col(price) * amount,
    }
    return rows.withColumns({"action": F.lit(action), "dollars": kinds[allocation_type]})


def strategy(panel: DataFrame, name: str, condition: I.Condition, action: Stage, active: bool = True) -> DataFrame:
    """The intent rows of the bars on which the condition holds, with the strategy's name."""
    fired = I.evaluate(panel, __fires=condition).where(F.col("__fires") & F.lit(active)).drop("__fires")
    return action(fired).withColumn("strategy", F.lit(name))


def portfolio(strategies: list[DataFrame], initial_value: float = 10_000) -> DataFrame:
    """All strategies' intents with their priority (their place in the list)."""
    parts = [s.withColumns({"priority": F.lit(k), "initial_value": F.lit(float(initial_value))}) for k, s in enumerate(strategies)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def alert(message: str) -> Stage:
    return lambda rows: rows.withColumns({"action": F.lit("alert"), "message": F.lit(message)})


# -- what a rebalance would do ---------------------------------------------------------------------


def weight_changes(target: DataFrame, current: DataFrame, key: str = "ticker", time: str = "ts") -> DataFrame:
    t, c = target.select(time, key, F.col("weight").alias("to")), current.select(time, key, F.col("weight").alias("was"))
    return t.join(c, [time, key], "full_outer").select(time, key, (F.coalesce("to", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))).alias("change"))


def plan_metrics(changes: DataFrame, means: DataFrame | None = None, value: float = 1.0, cost_bps: float = 10.0, shrinkage: float = 0.5, key: str = "ticker", time: str = "ts") -> DataFrame:
    """allocationDrift, plannedTurnover, estimatedCost, expectedBenefit and netBenefit of each time.

    Drift is half the absolute change, cost is turnover at cost_bps of the value, benefit is the
    change's mean return (means: ticker, mean), shrunk toward 0.
    """
    joined = changes.join(means, key, "left") if means is not None else changes.withColumn("mean", F.lit(None).cast("double"))
    turnover, benefit = F.sum(F.abs("change")), F.sum(F.col("change") * F.coalesce("mean", F.lit(0.0)) * (1 - shrinkage)) * value
    out = joined.groupBy(time).agg((turnover / 2).alias("allocationDrift"), turnover.alias("plannedTurnover"), (turnover * cost_bps / 10_000 * value).alias("estimatedCost"), benefit.alias("expectedBenefit"))
    return out.withColumn("netBenefit", F.col("expectedBenefit") - F.col("estimatedCost"))


def plan_metric(metrics: DataFrame, metric: str = "netBenefit", time: str = "ts") -> DataFrame:
    return metrics.select(time, F.col(metric).alias("value"))


def returns(panel: DataFrame, key: str = "ticker", time: str = "ts", price: str = "close") -> DataFrame:
    w = Window.partitionBy(key).orderBy(time)
    return panel.select(key, time, (F.try_divide(price, F.lag(price).over(w)) - 1).alias("ret")).where("ret is not null")


def stored_returns(rets: DataFrame, key: str = "ticker", time: str = "ts") -> DataFrame:
    """rets as a table that is made once for all that read it, with each name's mean and what tells names
    with the same bars: how many there are, and two hashes of them."""
    own = Window.partitionBy(key)
    known = rets.where(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col("ret").isNotNull())
    bars = F.struct(F.count("*").over(own).alias("n"), F.bit_xor(F.xxhash64(time)).over(own).alias("h"), F.bit_xor(F.xxhash64(time, F.lit(1))).over(own).alias("k"))
    return written(known.select(key, time, "ret", F.avg("ret").over(own).alias("mean"), bars.alias("bars")), "returns")


#: Names of a group, and bars of a part, at most about: a task has the returns of two groups in one part,
#: 4 matrices of PART_BARS x GROUP_NAMES doubles (16 MB) and as many of GROUP_NAMES x GROUP_NAMES (32 MB).
GROUP_NAMES, PART_BARS = 1024, 512
#: Names that a group has at least where groups are made for more tasks only.
FEW_NAMES = 64


def covariance_blocks(names: int, bars: int, tasks: int) -> tuple[int, int, int]:
    """groups of names, parts of the bars, and splits of the parts, so that matrices are bounded and tasks enough."""
    groups = max(1, -(-names // GROUP_NAMES), min(math.isqrt(2 * tasks), -(-names // FEW_NAMES)))
    parts = max(1, -(-bars // PART_BARS))
    pairs = groups * (groups + 1) // 2
    splits = min(max(1, bars), -(-tasks // pairs))
    return groups, max(parts, splits), splits


#: Pairs of names that leave a task at once, and weight sets that a block's covariances are applied to at once.
PAIR_ROWS, SETS = 1 << 17, 256
_PACKED = ("names", "times", "sets", "who", "at", "x")


def _hashable(values: pa.Array) -> list:
    """Equal exactly where the values are; times by their instant, whatever the zone."""
    if pa.types.is_struct(values.type):
        return list(zip(*(_hashable(v) for v in values.flatten()), strict=True))
    return (values.cast(pa.int64()) if pa.types.is_timestamp(values.type) else values).to_pylist()


def _encoded(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values, and the place of each value among them."""
    if not pa.types.is_struct(values.type):
        encoded = values.dictionary_encode(null_encoding="encode")
        return encoded.dictionary, encoded.indices.to_numpy()
    code = np.zeros(len(values), np.int64)
    for field in values.flatten():
        known, place = _encoded(field)
        code = np.unique(code * len(known) + place, return_inverse=True)[1]
    return _nullable(values.take(pa.array(np.unique(code, return_index=True)[1]))), code


def _nullable(values: pa.Array) -> pa.Array:
    """A struct's fields may be null, as in Spark's type."""
    return pa.StructArray.from_arrays([_nullable(v) for v in values.flatten()], names=[f.name for f in values.type]) if pa.types.is_struct(values.type) else values


def _packed(rows: pa.Table) -> pa.Table:
    """The rows of a group of names and a part as one row: distinct names, distinct times (or sets), and for
    each value the places of its name and time, as little-endian bytes."""
    (names, name), (ats, at) = (_encoded(rows[c].combine_chunks()) for c in ("name", "at"))
    one = lambda v, kind: pa.array([v], kind)
    whole = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
    raw = lambda v, kind: one(np.ascontiguousarray(v, kind).tobytes(), pa.binary())
    columns = [rows["g"].combine_chunks()[:1], rows["p"].combine_chunks()[:1], whole(names), whole(ats)]
    columns += [raw(name, "<i4"), raw(at, "<i4"), raw(rows["x"].to_numpy(), "<f8")]
    return pa.table(columns, names=["g", "p", "names", "ats", "who", "at", "x"])


def _pack(rows: DataFrame, ats: str) -> DataFrame:
    """rows (g, p, name, at, x) a row for each g and p; the distinct values of at are named ats."""
    kinds = dict(rows.dtypes)
    schema = f"g int, p int, names array<{kinds['name']}>, ats array<{kinds['at']}>, who binary, at binary, x binary"
    return rows.groupBy("g", "p").applyInArrow(_packed, schema).withColumnRenamed("ats", ats)


class _Cross:
    """Sums over common bars of the pairs of two groups, as matrices that grow with the names met; and the
    groups' weights, packed."""

    def __init__(self) -> None:
        self.places: tuple[dict, dict] = ({}, {})
        self.names: tuple[list, list] = ([], [])
        self.sums = np.zeros((4, 0, 0))
        self.books: list[list] = []

    def add(self, sides: list[dict]) -> None:
        if sides[0]["sets"].is_valid:
            self.books.append(sides)
            return
        times = {t: k for k, t in enumerate(_hashable(sides[0]["times"].values))}
        at = [np.array([times.get(t, -1) for t in _hashable(side["times"].values)], np.int64) for side in sides]
        (i, x, m), (j, y, k) = (self._matrices(n, sides[n], at[n], len(times)) for n in (0, 1))
        grow = [len(p) - have for p, have in zip(self.places, self.sums.shape[1:], strict=True)]
        if any(grow):
            self.sums = np.pad(self.sums, ((0, 0), (0, grow[0]), (0, grow[1])))
        counts = m.astype(np.float32).T @ k.astype(np.float32)  # exact: a part has less than 2^24 bars
        for s, product in zip(self.sums, (counts, x.T @ k, m.T @ y, x.T @ y), strict=True):
            s[np.ix_(i, j)] += product

    def _matrices(self, n: int, side: dict, at: np.ndarray, bars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places, values = self.places[n], side["names"].values
        keys, before = _hashable(values), len(self.places[n])
        place = np.array([places.setdefault(key, len(places)) for key in keys], np.int64)
        if len(places) > before:
            self.names[n].append(values.take(pa.array(np.flatnonzero(place >= before))))
        who, bar = np.frombuffer(side["who"].as_buffer(), "<i4"), at[np.frombuffer(side["at"].as_buffer(), "<i4")]
        common = bar >= 0
        x, there = np.zeros((bars, len(keys))), np.zeros((bars, len(keys)))
        x[bar[common], who[common]], there[bar[common], who[common]] = np.frombuffer(side["x"].as_buffer(), "<f8")[common], 1
        return place, x, there

    def pairs(self, both: bool, least: int) -> Iterator[pa.RecordBatch]:
        """i, j, n, sx, sy, sxy of pairs with `least` common bars, some rows of the matrix at a time."""
        if not self.sums.size:
            return
        left, right = (pa.concat_arrays(names) for names in self.names)
        step = max(1, PAIR_ROWS // len(right))
        for start in range(0, len(left), step):
            sums = self.sums[:, start : start + step]
            i, j = np.nonzero(sums[0] >= least)
            columns = [left.take(pa.array(i + start)), right.take(pa.array(j)), pa.array(np.full(len(i), both)), *(pa.array(s[i, j]) for s in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "both", "n", "sx", "sy", "sxy"])

    def variances(self, same: bool, least: int) -> Iterator[pa.RecordBatch]:
        """set, variance, pairs: each weight set's sum over this block, the names of two groups in both orders."""
        if not self.sums.size or not self.books:
            return
        n, sx, sy, sxy = self.sums
        known = n >= max(least, 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            cov = np.where(known, _cov(n, sx, sy, sxy), 0.0)
        for sides in self.books:
            sets = sides[0]["sets"].values
            order = {key: k for k, key in enumerate(_hashable(sets))}
            at = [np.array([order.get(key, -1) for key in _hashable(side["sets"].values)], np.int64) for side in sides]
            for start in range(0, len(sets), SETS):
                some = min(SETS, len(sets) - start)
                (u, a), (v, b) = (self._weights(k, sides[k], at[k] - start, some) for k in (0, 1))
                total = ((u @ cov) * v).sum(axis=1) * (1 if same else 2)
                pairs = ((a @ known.astype(float)) * b).sum(axis=1)
                yield pa.RecordBatch.from_arrays([sets.slice(start, some), pa.array(total), pa.array(pairs)], names=["set", "variance", "pairs"])

    def _weights(self, n: int, side: dict, at: np.ndarray, sets: int) -> tuple[np.ndarray, np.ndarray]:
        places = self.places[n]
        place = np.array([places.get(key, -1) for key in _hashable(side["names"].values)], np.int64)
        who, row = place[np.frombuffer(side["who"].as_buffer(), "<i4")], at[np.frombuffer(side["at"].as_buffer(), "<i4")]
        fits = (who >= 0) & (row >= 0) & (row < sets)
        w, there = np.zeros((sets, len(places))), np.zeros((sets, len(places)))
        np.add.at(w, (row[fits], who[fits]), np.frombuffer(side["x"].as_buffer(), "<f8")[fits])
        there[row[fits], who[fits]] = 1
        return w, there


def _cov(n: Any, sx: Any, sy: Any, sxy: Any) -> Any:
    """Of columns or arrays."""
    return (sxy - sx * sy / n) / (n - 1)


def _over_blocks(batches: Iterable[pa.RecordBatch], out: Callable[[_Cross, int, int], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """What out gives of each pair of groups, of rows that each have one part of both."""
    at, cross = None, _Cross()
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        for r in range(batch.num_rows):
            here = (columns["a"][r].as_py(), columns["b"][r].as_py())
            if at is not None and here != at:
                yield from out(cross, *at)
                cross = _Cross()
            at = here
            cross.add([{c: columns[f"{c}_{side}"][r] for c in _PACKED} for side in "ab"])
    if at is not None:
        yield from out(cross, *at)


def _block_pairs(own: DataFrame, blocks: tuple[int, int, int] | None, sets: DataFrame | None = None) -> tuple[DataFrame, int]:
    """A row for each two groups of names (a <= b) and part, with both groups' packed returns (or weights) in
    it; the rows of two groups come to one task for each split. And the number of splits.

    own has name, at, x; sets has a set as at and its weights as x. Packed returns are stored once, by group.
    Each pair of groups reads its two, so that no row is copied to the other groups' tasks. With weights
    there is one split.
    """
    if blocks is None:
        names, bars = own.agg(F.approx_count_distinct("name"), F.approx_count_distinct("at")).first()
        blocks = covariance_blocks(names, bars, own.sparkSession.sparkContext.defaultParallelism)
    groups, parts, splits = blocks
    spread = lambda c, n: (F.shiftrightunsigned(F.xxhash64(c), 1) % F.lit(n)).cast("int")
    packed = _pack(own.select("name", "at", F.col("x").cast("double").alias("x"), spread("name", groups).alias("g"), spread("at", parts).alias("p")), "times")
    if sets is not None:
        splits = 1
        # a part below 0 holds weights: a share of the sets
        packed = packed.unionByName(_pack(sets.withColumns({"g": spread("name", groups), "p": -1 - spread("at", 16)}), "sets"), allowMissingColumns=True)
    else:
        packed = packed.withColumn("sets", F.lit(None).cast("array<int>"))
    dealt = packed.withColumn("s", F.pmod("p", F.lit(splits))).withColumn("to", F.col("g") * splits + F.col("s")).repartitionById(groups * splits, "to")
    side = lambda k: dealt.select(F.col("g").alias(k), F.col("s").alias(f"s_{k}"), F.col("p").alias(f"p_{k}"), *(F.col(c).alias(f"{c}_{k}") for c in _PACKED))
    both = side("a").join(side("b").hint("shuffle_replicate_nl"), (F.col("s_a") == F.col("s_b")) & (F.col("p_a") == F.col("p_b")) & (F.col("a") <= F.col("b")))
    return both.drop("s_a", "s_b", "p_a", "p_b"), splits


def _centred(rets: DataFrame, key: str, time: str) -> DataFrame:
    """name, at, x, bars of stored returns (or of others, stored first): sums of what is about 0 lose no digits."""
    rets = rets if "bars" in rets.columns else stored_returns(rets, key, time)
    return rets.select(F.col(key).alias("name"), F.col(time).alias("at"), (F.col("ret") - F.col("mean")).alias("x"), "bars")


def covariance(rets: DataFrame, least: int = 20, shrinkage: float = 0.25, key: str = "ticker", time: str = "ts", blocks: tuple[int, int, int] | None = None) -> DataFrame:
    """i, j, n, cov of every pair of names (both orders, and a name with itself) with at least `least`
    common bars; off the diagonal shrunk toward 0.

    Names are dealt to groups and times to parts, of a size that is counted first: whatever their number,
    a task has two groups' returns in one part, whose products are the sums over common bars that a
    covariance is made of. It adds up part after part, so rows leave it once for each pair of names, and
    are exchanged only where few names have their parts split over several tasks.
    """
    both, splits = _block_pairs(_centred(rets, key, time), blocks)
    kind, alone = dict(rets.dtypes)[key], max(least, 2) if splits == 1 else 1
    run = lambda batches: _over_blocks(batches, lambda cross, a, b: cross.pairs(a != b, alone))
    sums = both.mapInArrow(run, f"i {kind}, j {kind}, both boolean, n double, sx double, sy double, sxy double")
    if splits > 1:
        sums = sums.groupBy("i", "j", "both").agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy")))
    cov = _cov(*(F.col(c) for c in ("n", "sx", "sy", "sxy")))
    pairs = sums.where((F.col("n") >= least) & (F.col("n") > 1)).withColumns({"cov": F.when(F.col("i") == F.col("j"), cov).otherwise(cov * (1 - shrinkage)), "n": F.col("n").cast("long")})
    # names of two groups have met once, as (i, j)
    one, other = F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    return pairs.withColumn("ij", F.explode(F.when(F.col("both"), F.array(one, other)).otherwise(F.array(one)))).select("ij.i", "ij.j", "n", "cov")


def variances(rets: DataFrame, least: int = 20, key: str = "ticker", time: str = "ts") -> DataFrame:
    """The rows of covariance() whose names are the same: one sum for each name."""
    known = rets.where(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col("ret").isNotNull())
    each = known.groupBy(F.col(key).alias("i")).agg(F.count("*").alias("n"), F.var_samp("ret").alias("cov"))
    return each.where((F.col("n") >= least) & (F.col("n") > 1)).select("i", F.col("i").alias("j"), "n", "cov")


def book_variance(w: DataFrame, rets: DataFrame, keys: list[str], least: int = 20, shrinkage: float = 0.25, key: str = "ticker", time: str = "ts", blocks: tuple[int, int, int] | None = None) -> DataFrame:
    """portfolio_variance() of w over covariance() of rets, summed where a block's covariances are made, so
    that no pair of names leaves a task: a row for each weight set and pair of groups does. A weight that
    is null counts for nothing. A task holds the weights of two groups of names.

    Names with the same bars have the same common bars with any other, so that a set's sum over their
    covariances is the covariance of their weighted sum: where more names than sets have the same bars,
    each set's sum stands for them. What shrinkage leaves of a name's own variance is added name by name.
    """
    own = _centred(rets, key, time)
    kind = dict(own.dtypes)["name"]
    sets = w.select(F.col(key).cast(kind).alias("name"), F.struct(F.lit(0).alias("__set"), *keys).alias("at"), F.col("weight").cast("double").alias("x"))
    sets = sets.where(reduce(lambda a, b: a & b, (F.col(f"at.`{k}`").isNotNull() for k in keys), F.col("name").isNotNull() & F.col("x").isNotNull()))
    sets = written(sets.groupBy("name", "at").agg(F.sum("x").alias("x")), "weights")
    held = written(sets.groupBy("name").agg(F.collect_list(F.struct("at", F.col("x").alias("w"))).alias("sets")), "held")  # few bytes, so that Spark may broadcast it
    alike = _alike(own, sets.select("at").distinct().count())
    summed = alike.where("name = first").select("bars", "first")
    sums = own.join(summed, "bars").join(held, "name").select("first", F.col("at").alias("bar"), "x", F.explode("sets").alias("s"))
    sums = written(sums.groupBy("first", "s.at", "bar").agg(F.sum(F.col("s.w") * F.col("x")).alias("x")), "sums")
    itself, a_sum = F.struct("name", F.lit(None).cast(dict(sets.dtypes)["at"]).alias("set")), F.struct(F.col("first").alias("name"), F.col("at").alias("set"))
    units = own.join(summed, "bars", "left_anti").select(itself.alias("name"), "at", "x").union(sums.select(a_sum, "bar", "x"))
    weights = sets.join(alike.where("first is not null"), "name", "left_anti").select(itself.alias("name"), "at", "x").union(sums.select(a_sum, "at", F.lit(1.0)).distinct())
    both, _ = _block_pairs(units, blocks, weights)
    run = lambda batches: _over_blocks(batches, lambda cross, a, b: cross.variances(a == b, least))
    kinds = dict(w.dtypes)
    parts = both.mapInArrow(run, f"set struct<__set:int,{','.join(f'`{k}`:{kinds[k]}' for k in keys)}>, variance double, pairs double")
    left = sets.join(alike.where(F.col("bars.n") >= max(least, 2)), "name").groupBy(F.col("at").alias("set")).agg(F.sum(F.col("x") * F.col("x") * F.col("variance")).alias("variance"))
    total = parts.withColumn("variance", F.col("variance") * (1 - shrinkage)).union(left.select("set", F.col("variance") * shrinkage, F.lit(0.0)))
    return total.groupBy("set").agg(F.sum("variance").alias("variance"), F.sum("pairs").alias("pairs")).where("pairs > 0").select(*(F.col(f"set.`{k}`").alias(k) for k in keys), "variance")


def _alike(own: DataFrame, sets: int) -> DataFrame:
    """name, bars, variance, and first: the smallest of the names with the same bars, where they are more than sets."""
    each = own.groupBy("name", "bars").agg(F.var_samp("x").alias("variance"))
    first = each.groupBy("bars").agg(F.min("name").alias("first"), F.count("*").alias("names")).where(F.col("names") > sets)
    return written(each.join(first.select("bars", "first"), "bars", "left").select("name", "bars", "variance", "first"), "names")


def portfolio_variance(w: DataFrame, cov: DataFrame, keys: list[str], key: str = "ticker") -> DataFrame:
    """variance of each weight set (keys, ticker, weight)."""
    a, b = w.select(*keys, F.col(key).alias("i"), F.col("weight").alias("wi")), w.select(*keys, F.col(key).alias("j"), F.col("weight").alias("wj"))
    return a.join(b, keys).join(cov, ["i", "j"]).groupBy(*keys).agg(F.sum(F.col("wi") * F.col("wj") * F.col("cov")).alias("variance"))


def volatility_target(w: DataFrame, cov: DataFrame | None, keys: list[str], target_percent: float = 12.0, periods: int = 252, variance: DataFrame | None = None) -> DataFrame:
    """scale of each weight set: the target over its annualised volatility, 1 at most. variance: that of
    the sets where it is known (book_variance), so that no covariances are needed."""
    vol = F.sqrt(F.col("variance") * periods) * 100
    variance = portfolio_variance(w, cov, keys) if variance is None else variance
    return variance.withColumn("scale", F.least(F.lit(1.0), F.try_divide(F.lit(target_percent), vol)))


def inverse_volatility(cov: DataFrame) -> DataFrame:
    """ticker, weight: risk parity where correlations are equal. variances() will do for cov."""
    own = cov.where((F.col("i") == F.col("j")) & (F.col("cov") > 0)).select(F.col("i").alias("ticker"), (1 / F.sqrt("cov")).alias("inv"))
    return own.join(F.broadcast(own.agg(F.sum("inv").alias("all"))), how="inner").select("ticker", (F.col("inv") / F.col("all")).alias("weight"))


def diversification_ratio(w: DataFrame, cov: DataFrame, keys: list[str], variance: DataFrame | None = None) -> DataFrame:
    """mean_sd, variance and their ratio of each weight set; with the sets' variance, variances() will do for cov."""
    own = cov.where("i = j").select(F.col("i").alias("ticker"), F.sqrt("cov").alias("sd"))
    mean = w.join(own, "ticker").groupBy(*keys).agg(F.sum(F.col("weight") * F.col("sd")).alias("mean_sd"))
    variance = portfolio_variance(w, cov, keys) if variance is None else variance
    return mean.join(variance, keys).withColumn("ratio", F.try_divide(F.col("mean_sd"), F.sqrt("variance")))


def utilities(w: DataFrame, means: DataFrame, cov: DataFrame | None, keys: list[str], current: DataFrame | None = None, risk_aversion: float = 4.0, mean_shrinkage: float = 0.5, turnover_penalty: float = 1.0, cost_bps: float = 10.0, variance: DataFrame | None = None) -> DataFrame:
    """utility of each candidate weight set: shrunk mean - aversion / 2 x variance - penalised turnover cost.
    variance: that of the sets where it is known (book_variance), else it comes from cov."""
    mean = w.join(means, "ticker").groupBy(*keys).agg(F.sum(F.col("weight") * F.col("mean") * (1 - mean_shrinkage)).alias("mean"))
    out = mean.join(portfolio_variance(w, cov, keys) if variance is None else variance, keys)
    if current is None:
        out = out.withColumn("turnover", F.lit(0.0))
    else:
        both = w.join(current.select("ticker", F.col("weight").alias("was")), "ticker", "left")
        out = out.join(both.groupBy(*keys).agg(F.sum(F.abs(F.col("weight") - F.coalesce("was", F.lit(0.0)))).alias("turnover")), keys)
    return out.withColumn("utility", F.col("mean") - risk_aversion / 2 * F.col("variance") - turnover_penalty * cost_bps / 10_000 * F.col("turnover"))


def best_candidate(utility: DataFrame, key: str) -> DataFrame:
    """The candidate of the greatest utility (the smaller name at a tie)."""
    return utility.orderBy(F.desc("utility"), key).limit(1)
