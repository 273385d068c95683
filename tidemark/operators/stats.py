"""Statistics of series: calendar alignment, HAC slopes, block bootstrap, false-discovery control,
mean-shift breaks, unit roots and specification curves.

Functions take long tables; a `group` column separates series that are worked on together. Nulls and
NaN are left out. Random replicates come from (seed, replicate), so a seed always gives the same
result, whatever the partitions; draws are our own. A series may be of any length: ranks, resampling
and unit roots work on chunks of it, whose sums are added.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.storage import written

from .ordered import CHUNK_ROWS, GROUP, in_chunks, laid_out, least_from_here, ranked


def align_calendar(calendar: DataFrame, sessions: DataFrame, how: str = "sum", lead: int = 1, day: str = "day", value: str = "value", session: str = "session_date") -> DataFrame:
    """session_date, predictor, n_days_collapsed: each calendar day goes to its lead-th session after it
    (lead 0: the session of that day or the last one before); days without one are dropped.

    Sessions are numbered once (a calendar is small); days are placed by a running count of sessions.
    """
    if how not in ("sum", "mean") or lead < 0:
        raise ValueError("how is sum or mean, lead at least 0")
    s = sessions.where(F.col(session).isNotNull()).select(F.to_date(session).alias("d")).distinct()
    numbered = s.withColumn("k", F.row_number().over(Window.orderBy("d")))
    one = Window.orderBy("d", "side")  # calendars: a row a day
    both = s.select("d", F.lit(0).alias("side"), F.lit(None).cast("double").alias("v")).unionByName(calendar.where(F.col(day).isNotNull()).select(F.to_date(day).alias("d"), F.lit(1).alias("side"), F.col(value).cast("double").alias("v")))
    upto = F.sum((F.col("side") == 0).cast("int")).over(one.rowsBetween(Window.unboundedPreceding, 0))
    placed = both.withColumn("k", upto + lead).where("side = 1 and k > 0")
    agg = F.sum("v") if how == "sum" else F.avg("v")
    return placed.join(numbered.select("k", F.col("d").alias("session_date")), "k").groupBy("session_date").agg(agg.alias("predictor"), F.count("*").alias("n_days_collapsed"))


def next_session(calendar: DataFrame, rets: DataFrame, how: str = "sum", lead: int = 1, session: str = "session_date", ret: str = "asset_return") -> DataFrame:
    """align_calendar() joined with the sessions' returns; null returns dropped, repeated dates raise."""
    r = rets.select(F.to_date(session).alias("session_date"), F.col(ret).cast("double").alias("asset_return"))
    twice = F.raise_error(F.lit("return dates must be unique")).cast("double")
    r = r.groupBy("session_date").agg(F.when(F.count("*") > 1, twice).otherwise(F.first("asset_return")).alias("asset_return"))
    aligned = align_calendar(calendar, r, how, lead)
    return aligned.join(r.where("asset_return is not null"), "session_date")


def benjamini_hochberg(p: DataFrame, family: list[str], pvalue: str = "p", alpha: float = 0.05) -> DataFrame:
    """p with adjusted and reject: step-up over each family; null and NaN stay, untested.

    A family may be all rows: ranks and running minima go over from one range of p-values to the next.
    """
    ok = F.col(pvalue).isNotNull() & ~F.isnan(pvalue)
    tested = ranked(laid_out(p.withColumn("__ok", ok), [*family, "__ok"], [pvalue]), "__rank", "__tests")
    raw = tested.withColumn("__raw", F.col(pvalue) * F.col("__tests") / (F.col("__rank") + 1))
    return _rejected(least_from_here(raw, "__raw", "__least"), p.columns, ok, alpha)


def _rejected(p: DataFrame, columns: list[str], ok: Column, alpha: float) -> DataFrame:
    out = p.select(*columns, F.when(ok, F.least("__least", F.lit(1.0))).alias("adjusted"))
    return out.withColumn("reject", F.coalesce(F.col("adjusted") <= alpha, F.lit(False)))


def _step_up(p: DataFrame, pvalue: str, alpha: float) -> DataFrame:
    """benjamini_hochberg() of one family of as many rows as parameters have been stated: one small window."""
    ok = F.col(pvalue).isNotNull() & ~F.isnan(pvalue)
    w = Window.partitionBy(ok)
    raw = p.withColumn("__rank", F.row_number().over(w.orderBy(pvalue))).withColumn("__raw", F.col(pvalue) * F.count("*").over(w) / F.col("__rank"))
    least = F.min("__raw").over(w.orderBy(F.desc("__rank")).rowsBetween(Window.unboundedPreceding, 0))
    return _rejected(raw.withColumn("__least", least), p.columns, ok, alpha)


def finite(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df


def correlation(x: str, y: str) -> Column:
    """Pearson's, null where either is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value; on a row for each group only, since Spark has no erfc."""

    @F.pandas_udf("double")
    def p(z: pd.Series) -> pd.Series:
        return z.map(lambda v: None if v is None or v != v else math.erfc(abs(v) / math.sqrt(2)))

    return p(z)


def hac_slope(xy: DataFrame, group: list[str], order: str, x: str = "x", y: str = "y", maxlags: int = 5) -> DataFrame:
    """n, slope, hac_se, t, p, lags of y on x for each group: Bartlett weights, no small-sample correction;
    also the correlation r and the spans of x and y, from the same pass.

    slope is null where n < 3 or x is constant. Cross-moments of lagged products are plain window and
    group aggregates, so a group may be of any length.
    """
    d = finite(xy, x, y).select(*group, order, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    line = d.groupBy(*group).agg(F.count("*").alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.regr_slope("y", "x").alias("slope"), F.regr_sxx("y", "x").alias("sxx"), correlation("x", "y").alias("r"), (F.max("x") - F.min("x")).alias("span"), (F.max("y") - F.min("y")).alias("y_span"))
    line = line.withColumn("lags", F.greatest(F.lit(1), F.least(F.lit(maxlags), F.col("n") - 2)))
    u = d.join(line, group).withColumn("__u", (F.col("x") - F.col("mx")) * (F.col("y") - F.col("my") - F.col("slope") * (F.col("x") - F.col("mx"))))
    # with a constant in the regression the slope's variance needs only (x - mean x) e
    w = Window.partitionBy(*group).orderBy(order)
    total = F.col("__u") * F.col("__u")
    for k in range(1, maxlags + 1):
        weight = F.greatest(F.lit(0.0), 1 - k / (F.col("lags") + 1))
        total = total + 2 * weight * F.coalesce(F.col("__u") * F.lag("__u", k).over(w), F.lit(0.0))
    s = u.withColumn("part", total).groupBy(*group).agg(F.sum("part").alias("meat"))
    fine = (F.col("n") >= 3) & (F.col("span") > 0)
    out = line.join(s, group).select(*group, "n", F.when(fine, F.col("slope")).alias("slope"), F.when(fine, F.sqrt(F.greatest("meat", F.lit(0.0))) / F.col("sxx")).alias("hac_se"), "lags", "r", "span", "y_span")
    return out.withColumn("t", F.try_divide("slope", "hac_se")).withColumn("p", two_sided_p(F.col("t")))


#: Tasks that a group's replicates are dealt to, at least; a long series has as many chunks.
BATCHES = 16


@dataclass(frozen=True)
class Chunk:
    """A stretch of a group's series, with neighbours: places first..until are its own, of n in all."""

    values: list[np.ndarray]
    places: np.ndarray
    n: int
    first: int
    until: int
    batch: int
    batches: int

    def own(self) -> slice:
        return slice(*np.searchsorted(self.places, [self.first, self.until]))


def _by_chunk(series: DataFrame, group: list[str], order: str, values: list[str], work: Callable[[Chunk], pd.DataFrame], schema: str, before: Column | int = 0, after: Column | int = 0, circular: bool = False, batches: int = 1, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows of work(chunk) of each chunk of each group's series, with the group's columns.

    A series of one chunk goes to `batches` tasks, of more to fewer each, so that none is copied more
    often than that.
    """
    parts = ranked(laid_out(series.select(*group, order, *values), group, [order]), "__i", "__n")
    return _over_chunks(parts, group, values, work, schema, before, after, circular, batches, chunk_rows)


def _over_chunks(parts: DataFrame, group: list[str], values: list[str], work: Callable[[Chunk], pd.DataFrame], schema: str, before: Column | int = 0, after: Column | int = 0, circular: bool = False, batches: int = 1, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """_by_chunk() of rows that have their place __i and their group's size __n."""
    many = F.greatest(F.lit(1), F.ceil(batches / F.ceil(F.col("__n") / chunk_rows))).cast("int")
    dealt = in_chunks(parts, "__i", "__n", before, after, circular, chunk_rows).withColumns({"__of": many, "__batch": F.explode(F.sequence(F.lit(0), many - 1))})
    kinds = dict(parts.dtypes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__pos", kind="stable")
        one = rows.iloc[0]
        out = work(Chunk([rows[v].to_numpy(float) for v in values], rows["__pos"].to_numpy(), *(int(one[c]) for c in ("__n", "__first", "__until", "__batch", "__of"))))
        for k, g in enumerate(group):
            out.insert(k, g, pd.Series([one[g]] * len(out), dtype=rows[g].dtype))
        return out

    dealt = dealt.select(*group, *values, GROUP, "__n", "__pos", "__first", "__until", "__batch", "__of")
    return dealt.groupBy(GROUP, "__first", "__batch").applyInPandas(run, ", ".join([*(f"`{g}` {kinds[g]}" for g in group), schema]))


def _alike(a: DataFrame, b: DataFrame, group: list[str], how: str = "left") -> DataFrame:
    """a joined with b on the group's columns, nulls being equal; without columns b is one row."""
    if not group:
        return a.crossJoin(b)
    other = b.withColumnsRenamed({g: f"__of_{g}" for g in group})
    return a.join(other, reduce(lambda x, y: x & y, (F.col(g).eqNullSafe(F.col(f"__of_{g}")) for g in group)), how).drop(*(f"__of_{g}" for g in group))


def block_bootstrap_corr(xy: DataFrame, group: list[str], order: str, x: str = "x", y: str = "y", block: int = 5, n_boot: int = 2000, seed: int = 12345, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """n, r, ci_low, ci_high, p of each group's Pearson correlation by a circular moving-block bootstrap.

    A replicate is only block starts, drawn by (seed, replicate). A task has a chunk of the series, and
    the few rows after it that a block may reach into; it adds up the blocks that start there, as
    differences of running sums. The chunks' sums of a replicate are then added.
    """
    d = finite(xy, x, y).select(*group, order, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    known = d.groupBy(*group).agg(F.count("*").alias("n"), correlation("x", "y").alias("r"), F.avg("x").alias("mx"), F.avg("y").alias("my"), (F.max("x") - F.min("x")).alias("sx"), (F.max("y") - F.min("y")).alias("sy"))
    fine = (F.col("n") >= 3) & (F.col("sx") > 0) & (F.col("sy") > 0)
    known = known.withColumn("r", F.when(fine, F.col("r")))
    centred = _alike(d, known.where(fine).select(*group, "mx", "my"), group, "inner").select(*group, order, (F.col("x") - F.col("mx")).alias("x"), (F.col("y") - F.col("my")).alias("y"))
    names = ["a", "b", "aa", "bb", "ab"]

    def draw(c: Chunk) -> pd.DataFrame:
        x, y = c.values
        upto = np.concatenate([np.zeros((5, 1)), np.cumsum([x, y, x * x, y * y, x * y], axis=1)], axis=1)
        length = np.minimum(block, c.n - block * np.arange(-(-c.n // block)))
        out = []
        for rep in range(c.batch, n_boot, c.batches):
            start = np.random.default_rng([seed, rep]).integers(0, c.n, len(length))
            mine = (start >= c.first) & (start < c.until)
            at, size = start[mine] - c.first, length[mine]
            out.append((rep, *(upto[:, at + size] - upto[:, at]).sum(axis=1)))
        return pd.DataFrame(out, columns=["rep", *names])

    sums = _by_chunk(centred, group, order, ["x", "y"], draw, "rep int, " + ", ".join(f"{c} double" for c in names), after=block - 1, circular=True, batches=BATCHES, chunk_rows=max(chunk_rows, block))
    sums = _alike(sums.groupBy(*group, "rep").agg(*(F.sum(c).alias(c) for c in names)), known.select(*group, "n", "r"), group)
    va, vb = F.col("aa") - F.col("a") * F.col("a") / F.col("n"), F.col("bb") - F.col("b") * F.col("b") / F.col("n")
    boot = F.when((va > 1e-12) & (vb > 1e-12), (F.col("ab") - F.col("a") * F.col("b") / F.col("n")) / F.sqrt(va * vb)).otherwise(0.0)
    boots = sums.withColumn("boot", boot)
    other = F.avg(F.when(F.col("r") > 0, (F.col("boot") <= 0).cast("double")).otherwise((F.col("boot") >= 0).cast("double")))
    found = boots.groupBy(*group).agg(F.percentile("boot", F.lit(0.025)).alias("ci_low"), F.percentile("boot", F.lit(0.975)).alias("ci_high"), F.least(F.lit(1.0), F.greatest(F.lit(1 / n_boot), 2 * other)).alias("p"))
    return _alike(known.select(*group, "n", "r"), found, group)


def split_scores(series: DataFrame, group: list[str], order: str, value: str, step: int = 30, min_side: int = 30) -> DataFrame:
    """Each candidate split's absolute mean shift: at, n, split (values before it), score."""
    w = Window.partitionBy(*group)
    upto = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = finite(series, value).withColumns({"i": F.row_number().over(w.orderBy(order)) - 1, "n": F.count("*").over(w), "all": F.sum(value).over(w), "before": F.sum(value).over(upto)})
    fits = (F.col("i") >= min_side) & (F.col("i") <= F.col("n") - min_side) & ((F.col("i") - min_side) % step == 0) & (F.col("n") >= 2 * min_side + 1)
    score = F.abs(F.col("before") / F.col("i") - (F.col("all") - F.col("before")) / (F.col("n") - F.col("i")))
    return d.where(fits).select(*group, F.col(order).alias("at"), "n", F.col("i").alias("split"), score.alias("score"))


def mean_shift_break(series: DataFrame, group: list[str], order: str, value: str, step: int = 30, min_abs_shift: float | None = None, alpha: float = 0.05, n_perm: int = 500, seed: int = 12345, min_side: int = 30, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The best split of each group: n, score, at, split, detected, p.

    detected by min_abs_shift if stated, else by permutation: p = (1 + exceeding) / (1 + n_perm) < alpha.
    Groups too short for a split give detected false and null score.
    """
    if step < 1:
        raise ValueError("step must be at least 1")
    sizes = finite(series, value).groupBy(*group).agg(F.count("*").alias("n"))
    scores = split_scores(series, group, order, value, step, min_side)
    best = scores.groupBy(*group).agg(F.max_by(F.struct("at", "split", "score"), F.struct("score", -F.col("split"))).alias("b")).select(*group, "b.at", "b.split", "b.score")
    out = _alike(sizes, best, group)
    if min_abs_shift is not None:
        return out.withColumns({"p": F.lit(None).cast("double"), "detected": F.coalesce(F.col("score") >= min_abs_shift, F.lit(False))})

    def permute(c: Chunk) -> pd.DataFrame:
        v, out = c.values[0], [pd.DataFrame({"rep": np.empty(0, np.int32), "segment": np.empty(0, np.int64), "total": np.empty(0)})]
        last = (c.n - 2 * min_side) // step + 1  # segments lie between the splits: before the first, ..., after the last
        for rep in range(c.batch, n_perm if c.n > 2 * min_side else 0, c.batches):
            place = shuffled_place(c.places, c.n, seed, rep)
            segment = np.where(place < min_side, 0, np.minimum((place - min_side) // step + 1, last))
            some, at = np.unique(segment, return_inverse=True)
            out.append(pd.DataFrame({"rep": rep, "segment": some, "total": np.bincount(at, v)}))
        return pd.concat(out, ignore_index=True)

    d = finite(series, value).select(*group, order, F.col(value).cast("double").alias("__v"))
    span = d.groupBy(*group).agg(F.avg("__v").alias("__mean"), (F.max("__v") - F.min("__v")).alias("__span"))
    d = _alike(d, span, group).withColumn("__v", F.col("__v") - F.col("__mean"))
    sums = _by_chunk(d, group, order, ["__v"], permute, "rep int, segment long, total double", batches=BATCHES, chunk_rows=chunk_rows)
    sums = sums.groupBy(*group, "rep", "segment").agg(F.sum("total").alias("total"))
    w = Window.partitionBy(*group, "rep")
    sums = sums.withColumns({"before": F.sum("total").over(w.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), "whole": F.sum("total").over(w)})
    known = _alike(out.select(*group, "n", F.col("score").alias("__own")), span, group)
    split = min_side + step * (F.col("segment") - 1)
    shift = F.abs(F.col("before") / split - (F.col("whole") - F.col("before")) / (F.col("n") - split))
    best = _alike(sums.where("segment > 0"), known, group).withColumn("shift", shift).groupBy(*group, "rep", "__own", "__span").agg(F.max("shift").alias("shift"))
    # sums in another order differ in their last digits only
    over = (F.col("__span") == 0) | (F.col("shift") >= F.col("__own") - 1e-9 * F.col("__span"))
    p = best.groupBy(*group).agg(((1 + F.sum(over.cast("int"))) / (1 + F.count("*"))).alias("p"))
    return _alike(out, p, group).withColumn("detected", F.coalesce(F.col("p") < alpha, F.lit(False)))


def shuffled_place(places: np.ndarray, n: int, seed: int, rep: int) -> np.ndarray:
    """Where a pseudo-random permutation of n places, drawn by (seed, rep), puts the given ones.

    Halves of a place's bits are mixed into each other in rounds, which permutes the next power of 4;
    places that land outside n go on until they are inside. So a task can permute its own places only.
    """
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys, mask = np.random.SeedSequence([seed, rep]).generate_state(6, np.uint64), np.uint64((1 << half) - 1)
    out = places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for key in keys:
            z = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((z ^ (z >> np.uint64(32))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def predictor_transforms(x: DataFrame, order: str, value: str, baseline: float | None = None, group: list[str] | None = None) -> DataFrame:
    """Long: transform (level, diff, dlog if all values are positive, basedev if there is a baseline), value."""
    group = group or []
    w = Window.partitionBy(*group).orderBy(order)
    v, before = F.col(value), F.lag(value).over(w)
    positive = F.bool_and(v > 0).over(Window.partitionBy(*group))
    made = x.select(*group, order, v.alias("level"), (v - before).alias("diff"), F.when(positive & (v > 0) & (before > 0), F.log(F.when(v > 0, v)) - F.log(F.when(before > 0, before))).alias("dlog"), *([(v / baseline - 1).alias("basedev")] if baseline else []))
    names = ["level", "diff", "dlog", *(["basedev"] if baseline else [])]
    return made.unpivot([*group, order], names, "transform", "value").where("value is not null")


def target_transforms(y: DataFrame, order: str, value: str, vol_window: int = 5, group: list[str] | None = None) -> DataFrame:
    """Long: target (signed_return, abs_return, realized_vol), value."""
    group = group or []
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(1 - vol_window, 0)
    vol = F.when(F.count(value).over(w) == vol_window, F.stddev_samp(value).over(w))
    made = y.select(*group, order, F.col(value).alias("signed_return"), F.abs(value).alias("abs_return"), vol.alias("realized_vol"))
    return made.unpivot([*group, order], ["signed_return", "abs_return", "realized_vol"], "target", "value").where("value is not null")


def _most_lags(n: int) -> int:
    """The largest lag order that is tried on n values."""
    return max(0, min(int(np.ceil(12 * (n / 100) ** 0.25)), (n - 2) // 2 - 2))


def _lag_sums(c: Chunk) -> pd.DataFrame:
    """What a chunk adds to the sums of products of levels and lagged changes; and the series' ends."""
    v, own, most = c.values[0], c.own(), _most_lags(c.n)
    d, t = np.diff(v), c.places
    until = own.stop if c.until < c.n else own.stop - 1  # the last level has no change after it
    out = []
    for k in range(most + 1):
        a = max(own.start, k + own.start - int(t[own.start]))  # place k is the first with a lag of k
        now, then = slice(a, max(a, until)), slice(a - k, max(a, until) - k)
        out += [("changes", k, d[now] @ d[then]), ("levels", k, v[now] @ d[then])]
    level = v[own.start : until]
    out += [("sum", 0, level.sum()), ("squares", 0, level @ level)]
    for name, low, high in (("head", 0, most + 1), ("tail", c.n - 1 - most, c.n)):
        mine = np.arange(own.start, own.stop)
        mine = mine[(t[mine] >= low) & (t[mine] < high)]
        out += [(name, int(k), x) for k, x in zip(t[mine] - low, v[mine], strict=True)]
    return pd.DataFrame(out, columns=["what", "k", "x"])


def _unit_root(n: int, sums: dict[str, dict[int, float]]) -> tuple[int | None, float | None, bool | None]:
    """Lag order, statistic and verdict of an augmented Dickey-Fuller test with a constant, from the sums."""
    if n < 10 or sums["squares"].get(0, 0.0) <= 0:
        return None, None, None
    most, last = _most_lags(n), n - 1
    array = lambda what: np.array([sums[what][k] for k in sorted(sums[what])])
    changes, levels, head, tail = (array(x) for x in ("changes", "levels", "head", "tail"))
    dh, dt = np.diff(head), np.diff(tail)  # the first and last `most` changes

    def gram(m: int, lags: int) -> np.ndarray:
        """Products of (change, level, 1, changes 1..lags before) over the places from m on."""
        g = np.empty((lags + 3, lags + 3))
        at = [0, *range(3, lags + 3)]
        for i in range(lags + 1):
            g[1, at[i]] = levels[i] - head[i:m] @ dh[: m - i]
            g[2, at[i]] = tail[most - i] - head[m - i]
            for j in range(i, lags + 1):
                k = j - i
                late = dt[most - i :] @ dt[most - j : most - k] if i else 0.0
                g[at[i], at[j]] = g[at[j], at[i]] = changes[k] - dh[k : m - i] @ dh[: m - i - k] - late
        g[1, 1], g[1, 2], g[2, 2] = sums["squares"][0] - head[:m] @ head[:m], sums["sum"][0] - head[:m].sum(), last - m
        g[2, 1] = g[1, 2]
        g[:, 1:3] = g[1:3].T.copy()
        return g

    def fit(g: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """Coefficients, squared residuals and the inverse of the products; columns are scaled to one length."""
        scale = np.sqrt(np.maximum(np.diag(g), 1e-300))
        z = g / np.outer(scale, scale)
        inverse = np.linalg.pinv(z[1:, 1:], rcond=1e-12, hermitian=True)
        beta = inverse @ z[1:, 0]
        left = max(float(1 - z[1:, 0] @ beta), 0.0) * g[0, 0]
        return beta * scale[0] / scale[1:], left, inverse / np.outer(scale[1:], scale[1:])

    best = None
    full = gram(most, most)
    for lags in range(most + 1):
        keep = np.arange(lags + 3)
        _, left, _ = fit(full[np.ix_(keep, keep)])
        size = last - most
        criterion = size * np.log(max(left, 1e-300) / size) + 2 * (lags + 2)
        if best is None or criterion < best[0]:
            best = criterion, lags
    lags = best[1]
    g = gram(lags, lags)
    beta, left, inverse = fit(g)
    size = last - lags
    if left <= 1e-12 * g[0, 0]:
        return lags, None, None
    statistic = float(beta[0] / np.sqrt(left / max(1, size - lags - 2) * inverse[0, 0]))
    # The 5 % critical value's response surface for a constant (MacKinnon).
    critical = -2.86154 - 2.8903 / size - 4.234 / size**2 - 40.04 / size**3
    return lags, statistic, bool(statistic > critical)


def unit_root(series: DataFrame, group: list[str], order: str, value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """n, lags, statistic, nonstationary of each group: an augmented Dickey-Fuller test with a constant, the
    lag order by Akaike's criterion on one sample; nonstationary where a unit root isn't rejected at 5 %.

    Null for series that are short, constant, or fitted without a rest. A regression needs only sums of
    products of levels and lagged changes, which chunks of the series add up, and some 12 (n / 100)^(1/4)
    values at either end; so a task solves the regressions of a series from a few numbers.
    """
    d = finite(series, value).select(*group, order, F.col(value).cast("double").alias("__v"))
    return _unit_roots(ranked(laid_out(d, group, [order]), "__i", "__n"), group, chunk_rows)


def _unit_roots(parts: DataFrame, group: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """unit_root() of finite values __v that have their place __i and their group's size __n."""
    known = parts.groupBy(*group).agg(F.count("*").alias("n"), F.avg("__v").alias("__mean"), (F.max("__v") - F.min("__v")).alias("__span"))
    centred = _alike(parts, known.drop("n"), group).withColumn("__v", F.when(F.col("__span") > 0, F.col("__v") - F.col("__mean")).otherwise(0.0))
    most = F.ceil(12 * F.pow(F.col("__n") / 100, F.lit(0.25))) + 2
    sums = _over_chunks(centred, group, ["__v"], _lag_sums, "what string, k long, x double", before=most, after=1, chunk_rows=chunk_rows)
    sums = sums.groupBy(*group, "what", "k").agg(F.sum("x").alias("x"))
    sums = sums.groupBy(*group).agg(F.collect_list(F.struct("what", "k", "x")).alias("sums"))  # some 4 * lags rows

    @F.pandas_udf("lags int, statistic double, nonstationary boolean")
    def solve(n: pd.Series, sums: pd.Series) -> pd.DataFrame:
        out = []
        for size, rows in zip(n, sums, strict=True):
            by: dict[str, dict[int, float]] = defaultdict(dict)
            for r in rows:
                by[r["what"]][r["k"]] = r["x"]
            out.append(_unit_root(int(size), by))
        return pd.DataFrame(out, columns=["lags", "statistic", "nonstationary"]).astype({"lags": "Int32", "nonstationary": "boolean"})

    return _alike(known.select(*group, "n"), sums, group).withColumn("__r", solve("n", "sums")).select(*group, "n", "__r.*")


def nonstationary(series: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """nonstationary of each group, as unit_root() has it."""
    return unit_root(series, group, order, value).select(*group, "nonstationary")


def spec_curve(predictor: DataFrame, rets: DataFrame, order: str = "ts", value: str = "value", baseline: float | None = None, regimes: list[tuple[str, object, object]] | None = None, vol_window: int = 5, maxlags: int = 5, min_n: int = 20, alpha: float = 0.05) -> DataFrame:
    """A row for each sample x predictor transform x target: spec, sample, transform, target, n, r, hac_p,
    likely_spurious_levels, hac_p_fdr, survives_fdr, skipped (why it was not tested, else null).

    Both series are laid out once; transforms look at neighbours within chunks. They meet by time, one row
    with all transforms and targets, which then becomes a row for each specification: a single table of
    which slopes, correlations and sizes are aggregates.
    """
    samples = [("full", None, None), *(regimes or [])]
    held = F.array(*(F.when(F.lit(True) if a is None else F.col("t").between(F.lit(a), F.lit(b)), F.lit(name)) for name, a, b in samples))
    x, y = (df.select(F.col(order).alias("t"), F.col(value).cast("double").alias("__v")) for df in (predictor, rets))
    in_samples = lambda df, side: df.select(F.lit(side).alias("side"), F.explode(F.filter(held, lambda s: s.isNotNull())).alias("sample"), "t", "__v")
    whole = x.select(F.lit("x").alias("side"), F.lit("full").alias("sample"), "t", "__v")
    both = _union([whole, in_samples(finite(x, "__v"), "level"), in_samples(y, "y")])
    parts = ranked(laid_out(both, ["side", "sample"], ["t"]), "__i", "__n")

    w = Window.partitionBy(GROUP, "__first").orderBy("__pos")
    near = lambda side, n: in_chunks(parts.where(F.col("side") == side), "__i", "__n", before=n)
    own = (F.col("__pos") >= F.col("__first")) & (F.col("__pos") < F.col("__until"))
    v, before = F.col("__v"), F.col("__before")
    xs = near("x", 1).withColumn("__before", F.lag("__v").over(w)).where(own)
    dlog = F.when((v > 0) & (before > 0), F.log(F.when(v > 0, v)) - F.log(F.when(before > 0, before)))
    changed = {"level": v, "diff": v - before, "dlog": dlog} | ({"basedev": v / baseline - 1} if baseline else {})
    xs = xs.select("t", *(c.alias(name) for name, c in changed.items()))
    window = w.rowsBetween(1 - vol_window, 0)
    vol = F.when(F.count("__v").over(window) == vol_window, F.stddev_samp("__v").over(window))
    ys = near("y", vol_window - 1).withColumn("realized_vol", vol).where(own).select("sample", "t", v.alias("signed_return"), F.abs("__v").alias("abs_return"), "realized_vol")

    targets = ["signed_return", "abs_return", "realized_vol"]
    listed = lambda names, kind, to: F.explode(F.array(*(F.struct(F.lit(n).alias(kind), F.col(n).alias(to)) for n in names)))
    cells = xs.join(ys, "t").withColumn("px", listed(changed, "transform", "x")).withColumn("py", listed(targets, "target", "y"))
    cells = finite(cells.select("sample", "t", "px.*", "py.*"), "x", "y")

    keys = ["sample", "transform", "target"]
    # a transform is there if it has a value, logarithms only if all values have one
    there = xs.agg(*(F.count(c).alias(c) for c in changed), F.bool_and(F.col("level") > 0).alias("positive"))
    named = [F.when((F.col(c) > 0) & (F.col("positive") if c == "dlog" else F.lit(True)), F.lit(c)) for c in changed]
    grid = there.select(F.explode(F.filter(F.array(*named), lambda c: c.isNotNull())).alias("transform"))
    grid = grid.select(F.explode(F.array(*(F.lit(n) for n, _, _ in samples))).alias("sample"), "transform").select("sample", "transform", F.explode(F.array(*map(F.lit, targets))).alias("target"))
    hac = hac_slope(cells, keys, "t", maxlags=maxlags).select(*keys, "n", "r", "span", "y_span", F.col("p").alias("hac_p"))
    unit = _unit_roots(parts.where("side = 'level'"), ["sample"]).select("sample", F.lit("level").alias("transform"), "nonstationary")
    out = grid.join(hac, keys, "left").join(unit, ["sample", "transform"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    skipped = F.when(F.col("n") < min_n, F.lit(f"n<{min_n}")).when((F.col("span") == 0) | (F.col("y_span") == 0), "degenerate (no variance)")
    tested = skipped.isNull()
    out = out.select(
        F.concat("sample", F.lit(":"), "transform", F.lit("->"), "target").alias("spec"), *keys, "n", F.when(tested, F.col("r")).alias("r"), F.when(tested, F.col("hac_p")).alias("hac_p"), F.when(tested, F.col("nonstationary")).alias("likely_spurious_levels"), skipped.alias("skipped")
    )
    fdr = _step_up(out, "hac_p", alpha)
    return fdr.withColumn("survives_fdr", F.col("reject") & ~F.coalesce("likely_spurious_levels", F.lit(False))).withColumnRenamed("adjusted", "hac_p_fdr").drop("reject")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ordered_cooldown(entries: DataFrame, group: list[str], time: str, days: int) -> DataFrame:
    """Entries of each group at least `days` after the last entry kept: one ordered pass with one date of state."""
    schema = entries.schema

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key, last = None, None
        for f in frames:
            took = []
            for *key, t in zip(*(f[g] for g in group), f[time], strict=True):
                fine = key != last_key or (t - last).days >= days
                if fine:
                    last_key, last = key, t
                took.append(fine)
            yield f[np.array(took, bool)] if took else f

    return entries.repartition(*group).sortWithinPartitions(*group, time).mapInPandas(keep, schema)
