"""As-of lookups and running totals by one shuffle: both sides are unioned and read in time order.

A right row is seen by left rows at its own time and later (backward), or at its own time and
before (forward). Right rows without a time are never seen; of several right rows at one time the
greatest values win. Left rows are never dropped or repeated. Keys are matched as groupBy does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The side of rows that bring what is carried over into a span.
CARRIED = -1


def _stacked(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, values: dict[str, Column], right_first: bool) -> tuple[DataFrame, list[Column]]:
    own = F.struct(*(F.col(c) for c in left.columns))
    seen = F.struct(F.col(right_time).alias("__at"), *(v.alias(k) for k, v in values.items()))
    r = right.where(F.col(right_time).isNotNull()).select(*keys, F.col(right_time).alias("__t"), F.lit(0 if right_first else 2).alias("__side"), seen.alias("__seen"))
    l = left.select(*keys, F.col(time).alias("__t"), F.lit(1).alias("__side"), own.alias("__own"))
    return r.unionByName(l, allowMissingColumns=True), [F.col("__t"), F.col("__side"), F.col("__seen")]


def asof(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, values: dict[str, Column], found_at: str | None = None, forward: bool = False, span: str | None = None) -> DataFrame:
    """left with the values of the last right row at or before its time (forward: the next at or after it).

    span (year, month, day, ...): a key's history is looked up in tasks of such a length each, and what
    a span leaves unseen is carried over from the ones before (forward: after); for keys with very
    long histories.
    """
    both, order = _stacked(left, right, keys, time, right_time, values, not forward)
    parts = list(keys)
    if forward:
        order[2] = order[2].desc()
    if span is not None:
        both = both.withColumn("__span", F.date_trunc(span, "__t"))
        both = both.unionByName(_carried(both, keys, forward), allowMissingColumns=True)
        parts.append("__span")
        order.insert(0, F.col("__side") == CARRIED if forward else F.col("__side") != CARRIED)
    w = Window.partitionBy(*parts).orderBy(*order)
    if forward:
        seen = F.first("__seen", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    else:
        seen = F.last("__seen", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("__seen", seen).where("__side = 1")
    at = [F.col("__seen.__at").alias(found_at)] if found_at else []
    return out.select("__own.*", *(F.col(f"__seen.{k}").alias(k) for k in values), *at)


def _carried(both: DataFrame, keys: list[str], forward: bool) -> DataFrame:
    """For each span with left rows, what the spans before (forward: after) it have last (first), if anything.

    Only right rows are sorted for it; left rows only tell which spans there are.
    """
    micros = F.unix_micros(F.col("__t").cast("timestamp"))
    edge = F.max(F.struct((-micros if forward else micros).alias("__m"), "__seen")).alias("__edge")
    edges = both.where("__side <> 1").groupBy(*keys, "__span").agg(edge)
    asked = both.where("__side = 1").select(*keys, "__span").distinct()
    # a span's own edge comes after its question, so that only other spans answer it
    w = Window.partitionBy(*keys).orderBy(F.desc("__span") if forward else F.asc("__span"), F.col("__edge").isNotNull())
    last = F.last("__edge.__seen", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    answers = edges.unionByName(asked, allowMissingColumns=True).withColumn("__seen", last)
    return answers.where("__edge IS NULL AND __seen IS NOT NULL").select(*keys, "__span", F.lit(CARRIED).alias("__side"), "__seen")


def asof_calendar(panel: DataFrame, series: DataFrame, time: str, series_time: str, values: dict[str, Column]) -> DataFrame:
    """One series for every key: looked up once for each distinct time, then joined on the time."""
    calendar = panel.select(time).distinct().withColumn("__one", F.lit(1))
    found = asof(calendar, series.withColumn("__one", F.lit(1)), ["__one"], time, series_time, values)
    return panel.join(found.drop("__one"), time, "left")


def running(left: DataFrame, events: DataFrame, keys: list[str], time: str, event_time: str, totals: dict[str, Column], seconds: int | None = None, span: str | None = None) -> DataFrame:
    """left with sums over the events at or before its time, or in the `seconds` up to it (both ends in).

    span (year, month, day, ...): a key's history is added up in tasks of such a length each, and the sums
    of the spans before are carried over; not with seconds, whose sums don't reach back far.
    """
    if seconds is not None and span is not None:
        raise ValueError("a span is for sums over all that came before")
    both, _ = _stacked(left, events, keys, time, event_time, totals, True)
    parts = list(keys)
    if span is not None:
        both = both.withColumn("__span", F.date_trunc(span, "__t"))
        parts.append("__span")
    if seconds is None:
        w = Window.partitionBy(*parts).orderBy("__t", "__side").rangeBetween(Window.unboundedPreceding, 0)
    else:
        both = both.withColumn("__s", F.unix_micros(F.col("__t").cast("timestamp")))
        w = Window.partitionBy(*keys).orderBy("__s").rangeBetween(-seconds * 1_000_000, 0)
    sums = {f"__sum_{k}": F.coalesce(F.sum(f"__seen.{k}").over(w), F.lit(0)) for k in totals}
    out = both.withColumns(sums).where("__side = 1")
    if span is not None:
        out = _added(out, both, keys, list(totals))
    return out.select("__own.*", *(F.col(f"__sum_{k}").alias(k) for k in totals))


def _added(out: DataFrame, both: DataFrame, keys: list[str], totals: list[str]) -> DataFrame:
    """out, its sums with those of all spans before added."""
    w = Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    spans = both.groupBy(*keys, "__span").agg(*(F.sum(f"__seen.{k}").alias(f"__was_{k}") for k in totals))
    spans = spans.withColumns({f"__was_{k}": F.sum(f"__was_{k}").over(w) for k in totals})
    joined = _by_span(out, spans, keys)
    return joined.withColumns({f"__sum_{k}": F.col(f"__sum_{k}") + F.coalesce(f"__was_{k}", F.lit(0)) for k in totals})


def _by_span(out: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """out with the columns of the row of its key and span; keys are matched as groupBy does."""
    names = {c: f"__e_{i}" for i, c in enumerate([*keys, "__span"])}
    return out.join(spans.withColumnsRenamed(names), [F.col(c).eqNullSafe(F.col(e)) for c, e in names.items()], "left")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    micros = lambda c: F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))
    return (micros(later) - micros(earlier)) / 60_000_000


def in_interval(left: DataFrame, intervals: DataFrame, key: str, time: str, start: str = "start", end: str = "end", name: str = "member") -> DataFrame:
    """left with 1 where some interval [start, end) of its key holds its time, else 0; no end: still open.

    The running number of starts less ends, so that overlapping intervals count once and none multiplies rows.
    """
    steps = intervals.where(F.col(start).isNotNull()).select(key, F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("step")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("step")))).alias("s")).select(key, "s.t", "s.step")
    out = running(left, steps, [key], time, "t", {"__open": F.col("step")})
    return out.withColumn(name, (F.col("__open") > 0).cast("int")).drop("__open")
