"""When a point of a user series may be used, by its kind.

observation: from its own instant (a date counts from its UTC midnight); disclosed: only from a
stated availability; period_aggregate (1d, 1w, 1mo, 1q): from the end of its period or later. A date
as availability means the next UTC midnight. Rows that break a rule get an error and no availability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import asof

KINDS = ("observation", "period_aggregate", "disclosed")
PERIODS = ("1d", "1w", "1mo", "1q")
_INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_only(value: str | Column) -> Column:
    """The date of a strict YYYY-MM-DD text, else null."""
    return F.when(F.rlike(_c(value), F.lit(r"^\d{4}-\d{2}-\d{2}$")), _c(value).try_cast("date"))


def utc_instant(value: str | Column) -> Column:
    """The instant of a date (its UTC midnight) or of a time with an explicit offset, else null."""
    day = date_only(value)
    midnight = F.concat(_c(value), F.lit("T00:00:00Z")).try_cast("timestamp")
    return F.when(day.isNotNull(), midnight).when(F.rlike(_c(value), F.lit(_INSTANT)), _c(value).try_cast("timestamp"))


def _midnight(day: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("T00:00:00Z")).try_cast("timestamp")


def normalized_availability(value: str | Column) -> Column:
    """A date means the next UTC midnight, an instant itself."""
    day = date_only(value)
    return F.when(day.isNotNull(), _midnight(F.date_add(day, 1))).otherwise(utc_instant(value))


def _utc_date(t: Column) -> Column:
    return F.to_date(F.to_utc_timestamp(t, F.current_timezone()))


def availability(points: DataFrame, kind: str, period: str | None = None, timestamp: str = "timestamp", available: str = "available_at") -> DataFrame:
    """points with available (a timestamp) and error."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    if (kind == "period_aggregate") != (period in PERIODS) or kind != "period_aggregate" and period is not None:
        raise ValueError(f"period_aggregate, and nothing else, has a period: {PERIODS}")
    given, event = F.col(available), utc_instant(timestamp)
    day, given_day = date_only(timestamp), date_only(available)
    explicit = normalized_availability(available)
    if kind == "observation":
        at = F.when(given.isNull(), event).when(given_day == day, event).otherwise(explicit)
        wrong = F.when(_utc_date(utc_instant(available)) > _utc_date(event), "available after the event date")
    elif kind == "disclosed":
        at, wrong = explicit, F.when(given.isNull(), "a disclosed point states when it was available")
    else:
        start = _utc_date(event)
        end = {"1d": F.date_add(start, 1), "1w": F.date_add(start, 7), "1mo": F.add_months(start, 1), "1q": F.add_months(start, 3)}[period]
        begins = {"1d": F.lit(True), "1w": F.weekday(start) == 0, "1mo": F.dayofmonth(start) == 1, "1q": start == F.to_date(F.date_trunc("quarter", start))}[period]
        close = _midnight(end)
        at = F.coalesce(explicit, close)
        wrong = (
            F.when(event.isNull(), "not a date or an instant with an offset")
            .when(event != _midnight(start), "not a UTC midnight")
            .when(~begins, f"not the start of a {period} period")
            .when(explicit < close, "available before the period's end")
        )
    return points.withColumn("error", wrong).withColumn("available", F.when(F.col("error").isNull(), at))


def compound_growth(panel: DataFrame, facts: DataFrame, years: int, key: str, time: str, fact_time: str, value: str) -> DataFrame:
    """panel with growth: (value now / value known `years` ago) ^ (1 / years) - 1, of positive values."""
    now = asof(panel, facts, [key], time, fact_time, {"__now": F.col(value)})
    now = now.withColumn("__ago", F.col(time) - F.make_ym_interval(F.lit(years)))
    both = asof(now, facts, [key], "__ago", fact_time, {"__then": F.col(value)})
    fine = (F.col("__now") > 0) & (F.col("__then") > 0)
    return both.withColumn("growth", F.when(fine, F.pow(F.col("__now") / F.col("__then"), F.lit(1 / years)) - 1)).drop("__now", "__ago", "__then")


def read_series(points: DataFrame, series: str, ticker: object = None, time: str = "timestamp") -> DataFrame:
    """One series in time order, of one ticker if stated."""
    out = points.where(F.col("series") == series)
    return (out if ticker is None else out.where(F.col("ticker") == ticker)).orderBy(time)


#: Names that points may come with, and what they are stored as.
FIELDS = {"timestamp": "timestamp", "value": "value", "ticker": "ticker", "assetType": "asset_type", "asset_type": "asset_type", "availableAt": "available_at", "available_at": "available_at"}


def normalized_points(points: DataFrame) -> DataFrame:
    """Points with stored names; an unknown field, or none for time or value, is an error."""
    unknown = [c for c in points.columns if c not in FIELDS]
    if unknown or not {"timestamp", "value"} <= {*points.columns}:
        raise ValueError(f"unknown fields: {unknown}" if unknown else "timestamp and value are required")
    return points.withColumnsRenamed({c: FIELDS[c] for c in points.columns})


def points_of(rows: DataFrame, fields: str) -> DataFrame:
    """rows with timestamp, value, ticker, asset_type, available_at and error, from a map of each point's own fields.

    Values are text (times as ISO 8601). A field's stored name comes before its other one where both have
    a value; fields without a value count as missing. error (null: a point): an unknown field, in name
    order the first, or no timestamp or value.
    """
    f = F.coalesce(F.col(fields), F.create_map().cast("map<string,string>"))
    names: dict[str, list[str]] = {}
    for given, stored in FIELDS.items():
        names.setdefault(stored, []).insert(0 if given == stored else len(names.get(stored, [])), given)
    out = {stored: F.coalesce(*(F.try_element_at(f, F.lit(n)) for n in given)) for stored, given in names.items()}
    unknown = F.array_min(F.array_except(F.map_keys(f), F.array(*map(F.lit, FIELDS))))
    error = F.when(unknown.isNotNull(), F.concat(F.lit("unknown field "), unknown))
    for needed in ("timestamp", "value"):
        error = F.coalesce(error, F.when(out[needed].isNull(), F.lit(f"no {needed}")))
    return rows.withColumns({**out, "error": error})
