"""Registered datasets: where they lie, how they are partitioned, what a read returns by default."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .statements import read_only, written_within

#: Partition columns of each grain; a snapshot is replaced as a whole.
GRAINS = {"year": ("year",), "day": ("day",), "snapshot": (), "flat_date": ("day",), "month": ("month",), "hive": ("month", "type", "dte")}
#: Calendar days that a read of day partitions may span unless it says otherwise.
MOST_DAYS = 62
#: Option rows that a read returns at most unless it says otherwise.
MOST_OPTION_ROWS = 100_000


@dataclass(frozen=True)
class Dataset:
    name: str
    grain: str
    identity: str
    columns: tuple[str, ...] | None  # None: all
    notes: str = ""

    def __post_init__(self) -> None:
        if self.grain not in GRAINS:
            raise ValueError(f"grain must be one of {tuple(GRAINS)}")

    @property
    def partitions(self) -> tuple[str, ...]:
        return GRAINS[self.grain]


# Names, grains, identities and default columns of the registered datasets.
_BAR = ("ticker", "timestamp", "open", "high", "low", "close", "volume")
_OPTION = ("ticker", "underlying", "expirationDate", "strike", "optionType", "timestamp", "open", "high", "low", "close", "volume", "transactions", "implied_volatility", "delta", "gamma", "theta", "vega", "rho")
_SLIM_OPTION = ("ticker", "underlying", "expirationDate", "strike", "optionType", "timestamp", "close", "volume", "implied_volatility", "delta", "gamma", "theta")
_OHLC = ("date", "openingPrice", "highestPrice", "lowestPrice", "closingPrice")
_REPORT = ("ticker", "symbol", "date", "name", "totalRevenue", "netIncome", "ebitda", "grossProfit", "freeCashFlow", "totalAssets", "totalLiab", "commonStockSharesOutstanding", "shortTermDebt", "longTermDebt", "operatingIncome")
_EARNINGS = ("ticker", "symbol", "date", "epsActual", "epsEstimate", "epsDifference", "surprisePercent")
_DAILY = ("ticker", *_OHLC, "volume", "marketCap", "peRatioTTM")

CATALOG = {
    d.name: d
    for d in (
        Dataset("sec_daily_ohlc", "year", "ticker", (*_DAILY, "psRatioTTM", "pbRatioTTM", "enterpriseValue", "dividendYield"), "preferred daily bars, split-adjusted"),
        Dataset("daily_ohlc", "year", "ticker", _DAILY),
        Dataset("crypto_daily", "year", "symbol", ("symbol", *_OHLC, "tradingVolume")),
        Dataset("options_daily", "year", "underlying", _OPTION),
        Dataset("intraday_stock", "day", "ticker", _BAR),
        Dataset("intraday_crypto", "day", "ticker", _BAR),
        Dataset("intraday_options", "day", "underlying", _OPTION),
        Dataset("intraday_options_v2", "day", "underlying", _OPTION),
        Dataset("intraday_options_quotes", "flat_date", "underlying", None),
        Dataset("intraday_stock_monthly", "month", "ticker", _BAR),
        Dataset("intraday_options_v3_type_dte_monthly", "hive", "underlying", None),
        Dataset("intraday_options_day_substrate_v1", "hive", "underlying", None),
        Dataset("canonical_quarterly_financials", "year", "ticker", _REPORT, "date is the public date"),
        Dataset("canonical_annual_financials", "year", "ticker", _REPORT, "date is the public date"),
        Dataset("sec_quarterly_financials", "year", "ticker", _REPORT, "date is the public date"),
        Dataset("sec_annual_financials", "year", "ticker", _REPORT, "date is the public date"),
        Dataset("quarterly_financials", "year", "ticker", _REPORT, "date is the public date"),
        Dataset("annual_financials", "year", "ticker", _REPORT, "date is the public date"),
        Dataset("sec_quarterly_earnings", "year", "ticker", _EARNINGS),
        Dataset("quarterly_earnings", "year", "ticker", _EARNINGS),
        Dataset("sec_facts", "year", "ticker", ("cik", "ticker", "taxonomy", "concept", "unit", "val", "periodStart", "periodEnd", "filed", "availableAt", "accession")),
        Dataset("economic", "year", "indicator", ("indicator", "date", "value")),
        Dataset("dividends", "year", "ticker", ("ticker", "cashAmount", "declarationDate", "exDividendDate", "recordDate", "payDate", "frequency", "dividendType")),
        Dataset("stock_splits", "year", "ticker", ("ticker", "executionDate", "splitFrom", "splitTo"), "not to be applied to the preferred daily bars again"),
        Dataset("stock_industries", "snapshot", "ticker", ("ticker", "symbol", "name", "description")),
        Dataset("stock_industry_classifications", "snapshot", "ticker", ("ticker", "symbol", "name", "description", "classifiedAt")),
        Dataset("index_constituents", "snapshot", "indexCode", ("indexCode", "indexName", "componentCode", "componentName", "sector", "industry", "weight", "startDate", "endDate", "isActive"), "intervals of membership"),
        Dataset("international_stock", "year", "ticker", ("ticker", "symbol", "country", "commonStockSharesOutstanding", "date", "name")),
    )
}


class Lake:
    """Datasets under one root, each a Parquet table partitioned by its grain's columns."""

    def __init__(self, spark: SparkSession, root: str, catalog: dict[str, Dataset] | None = None) -> None:
        self.spark, self.root, self.datasets = spark, root.rstrip("/"), catalog or CATALOG

    def table(self, name: str, grain: str | None = None) -> DataFrame:
        """The whole dataset; schemas that have drifted are merged by name, missing columns null."""
        d = self.datasets[name]
        if grain is not None and d.grain != grain:
            raise ValueError(f"{name} is of grain {d.grain}, not {grain}")
        path = f"{self.root}/{name}/current" if d.grain == "snapshot" else f"{self.root}/{name}"
        return self.spark.read.option("mergeSchema", "true").parquet(path)

    def _projected(self, name: str, df: DataFrame, where: str | None, args: dict | None, columns: list[str] | str | None) -> DataFrame:
        if where is not None:
            view = "__lake_read"
            df = self.spark.sql(f"SELECT * FROM {{{view}}} WHERE {where}", args=args or {}, **{view: df})
        if columns == "*" or columns is None and self.datasets[name].columns is None:
            return df
        wanted = [*(columns or [c for c in self.datasets[name].columns if c in df.columns])]
        if any(not c.isidentifier() for c in wanted):
            raise ValueError(f"not column names: {wanted}")
        return df.select(*wanted)

    def read_years(self, name: str, years: list[int] | None = None, start: dt.date | None = None, end: dt.date | None = None, where: str | None = None, args: dict | None = None, columns: list[str] | str | None = None, row_cap: int | None = None) -> DataFrame:
        """Rows of the stated years, or of those that start..end (either order) spans: only those partitions are read."""
        df = self.table(name, "year")
        if years is None and (start or end):
            a, b = sorted((start or end, end or start))
            years = list(range(a.year, b.year + 1))
        if years is not None:
            df = df.where(F.col("year").isin(*years))
        return capped(self._projected(name, df, where, args, columns), row_cap, name)

    def read_days(self, name: str, start: dt.date, end: dt.date, where: str | None = None, args: dict | None = None, columns: list[str] | str | None = None, max_days: int = MOST_DAYS, allow_large: bool = False) -> DataFrame:
        """Rows of every day in start..end (either order); more than max_days are refused before anything is read."""
        a, b = sorted((start, end))
        if (b - a).days + 1 > max_days and not allow_large:
            raise ValueError(f"{(b - a).days + 1} days; at most {max_days} unless allow_large")
        return self._projected(name, self.table(name, "day").where(F.col("day").between(F.lit(a), F.lit(b))), where, args, columns)

    def read_snapshot(self, name: str, where: str | None = None, args: dict | None = None, columns: list[str] | str | None = None) -> DataFrame:
        return self._projected(name, self.table(name, "snapshot"), where, args, columns)

    def years(self) -> DataFrame:
        """dataset, years present, of the datasets by year that exist."""
        parts = []
        for d in self.datasets.values():
            if d.grain != "year":
                continue
            try:
                parts.append(self.table(d.name).select(F.lit(d.name).alias("dataset"), "year").distinct())
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("dataset").agg(F.array_sort(F.collect_set("year")).alias("years"))

    def register(self) -> list[str]:
        """A temporary view for each dataset that exists, for sql()."""
        made = []
        for name in self.datasets:
            try:
                self.table(name).createOrReplaceTempView(name)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            made.append(name)
        return made

    def sql(self, query: str, args: list | dict | None = None, max_rows: int | None = None, max_bytes: int | None = None, seconds: float | None = None) -> DataFrame:
        """A query over the registered views with bound values (scalars, or lists for array_contains).

        Only queries are let through (NotReadOnly, or a parse error, before anything runs). With max_bytes
        or seconds the query runs at once and its result is written; over a limit it is cancelled and
        deleted (OverLimit). Without them it runs when it is read, where max_rows holds too.
        """
        df = self.spark.sql(read_only(query), args=args)
        if max_bytes is None and seconds is None:
            return capped(df, max_rows, "the query")
        return written_within(df, "the query", seconds, max_bytes, max_rows)

    def contents(self) -> DataFrame:
        """dataset, grain, part, rows, columns of what lies under the root: a row for each partition (a snapshot: one, null)."""
        parts = []
        for d in self.datasets.values():
            try:
                df = self.table(d.name)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            part = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in d.partitions)) if d.partitions else F.lit(None).cast("string")
            counted = df.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
            parts.append(counted.select(F.lit(d.name).alias("dataset"), F.lit(d.grain).alias("grain"), "part", "rows", F.array(*(F.lit(c) for c in df.columns)).alias("columns")))
        return union_by_name(parts)

    def listing(self) -> DataFrame:
        rows = [(d.name, d.grain, d.identity, list(d.partitions), d.notes) for d in self.datasets.values()]
        return self.spark.createDataFrame(rows, "name string, grain string, identity string, partitions array<string>, notes string")

    def inspect(self, name: str, year: int | None = None, rows: int = 3) -> tuple[list[tuple[str, str]], DataFrame]:
        """Columns with types, and up to 20 rows. A dataset by year needs a year; other grains don't guess a partition."""
        d = self.datasets[name]
        if d.grain not in ("year", "snapshot") or d.grain == "year" and year is None:
            raise ValueError("state a year" if d.grain == "year" else f"{name}: read a partition of it instead")
        df = self.table(name) if year is None else self.table(name).where(F.col("year") == year)
        return df.dtypes, df.limit(min(rows, 20))


def capped(df: DataFrame, cap: int | None, label: str) -> DataFrame:
    """df's rows, no more than cap of them; a result over the cap fails when it is read, it is never cut.

    A capped result is small, so it is numbered in one task, and is computed once.
    """
    if cap is None:
        return df
    place = F.row_number().over(Window.orderBy(F.lit(0)))
    over = F.raise_error(F.lit(f"{label} has more than {cap} rows")).cast("boolean")
    return df.limit(cap + 1).withColumn("__place", place).where(F.when(F.col("__place") > cap, over).otherwise(True)).drop("__place")


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Parts one under another by column name; columns that a part lacks are null there."""
    if not parts:
        raise ValueError("no part can be read")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def shard_paths(spark: SparkSession, base: str, years: list[int]) -> DataFrame:
    """year, path: the live shards that {base}/{year}.manifest.json lists, else {base}/{year}-all.parquet."""
    wanted = spark.createDataFrame([(y,) for y in years], "year int")
    canonical = F.concat(F.lit(f"{base}/"), F.col("year").cast("string"), F.lit("-all.parquet"))
    try:
        listed = spark.read.schema("shards array<string>").option("multiLine", True).json(f"{base}/*.manifest.json").withColumn("year", F.regexp_extract(F.input_file_name(), r"(\d{4})\.manifest\.json", 1).cast("int"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return wanted.select("year", canonical.alias("path"))
    live = listed.select("year", F.explode("shards").alias("shard"))
    return wanted.join(live, "year", "left").select("year", F.coalesce(F.concat(F.lit(f"{base}/"), "shard"), canonical).alias("path"))


def with_backup(standard: DataFrame, backup: DataFrame, key: str = "year") -> DataFrame:
    """standard, and backup's rows of years that standard hasn't got."""
    absent = backup.join(standard.select(key).distinct(), key, "left_anti")
    return standard.unionByName(absent, allowMissingColumns=True)


def bars_of(df: DataFrame, symbols: list[str], start: dt.date | None = None, end: dt.date | None = None, years: list[int] | None = None, key: str = "ticker", date: str = "date", columns: list[str] | None = None) -> DataFrame:
    """Rows of a symbol set, upper-cased on both sides, within bounds (both ends in) and years; all hold."""
    out = df.where(F.upper(F.col(key)).isin(*(s.upper() for s in symbols)))
    out = out if start is None else out.where(F.to_date(date) >= F.lit(start))
    out = out if end is None else out.where(F.to_date(date) <= F.lit(end))
    out = out if years is None else out.where(F.year(date).isin(*years))
    return out if columns is None else out.select(*columns)


def options_of(df: DataFrame, underlyings: list[str], years: list[int] | None = None, start: dt.date | None = None, end: dt.date | None = None, option_type: str | None = None, columns: list[str] | None = None, row_cap: int | None = MOST_OPTION_ROWS) -> DataFrame:
    """Chain rows of underlyings; a window of years or dates is required."""
    if years is None and start is None and end is None:
        raise ValueError("state years or dates")
    out = bars_of(df, underlyings, start, end, years, "underlying", "timestamp")
    out = out if option_type is None else out.where(F.lower("optionType") == option_type.lower())
    return capped(out.select(*(columns or [c for c in _SLIM_OPTION if c in df.columns])), row_cap, "the option chain")


def event_windows(df: DataFrame, dates: DataFrame, pre_days: int = 5, post_days: int = 5, time: str = "timestamp", date: str = "date") -> DataFrame:
    """Rows whose day lies within a window around any date; a row once, however many windows hold it.

    The windows become their distinct days, so that this is an equal join that grows with both sides.
    """
    days = dates.select(F.explode(F.sequence(F.date_sub(F.to_date(date), pre_days), F.date_add(F.to_date(date), post_days))).alias("__day")).distinct()
    return df.join(days, F.to_date(time) == F.col("__day"), "left_semi")


def typed_rows(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as their types; what can't be read is null. Times are UTC."""
    return df.withColumns({c: F.try_to_timestamp(c) if t == "timestamp" else F.col(c).try_cast(t) for c, t in types.items()})


# Type names of result manifests, and Spark's.
TYPES = {
    "BOOLEAN": "boolean", "TINYINT": "tinyint", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint", "UTINYINT": "smallint", "USMALLINT": "int", "UINTEGER": "bigint", "UBIGINT": "decimal(20,0)", "HUGEINT": "decimal(38,0)",
    "FLOAT": "float", "REAL": "float", "DOUBLE": "double", "VARCHAR": "string", "TEXT": "string", "STRING": "string", "UUID": "string", "JSON": "string", "BLOB": "binary", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMPTZ": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp", "TIME": "string", "TIME WITH TIME ZONE": "string", "INTERVAL": "interval day to second",
}


def spark_type(name: str) -> str:
    """Spark's name of a manifest type; anything not listed is refused."""
    import re

    t = name.strip().upper()
    if t.endswith("[]"):
        return f"array<{spark_type(t[:-2])}>"
    if m := re.fullmatch(r"(?:DECIMAL|NUMERIC)\((\d+),\s*(\d+)\)", t):
        if int(m[1]) > 38 or int(m[2]) > int(m[1]):
            raise ValueError(f"not a type: {name}")
        return f"decimal({m[1]},{m[2]})"
    if re.fullmatch(r"VARCHAR\(\d+\)", t):
        return "string"
    if t not in TYPES:
        raise ValueError(f"not a type: {name}")
    return TYPES[t]


def empty_relation(spark: SparkSession, columns: list[tuple[str, str]]) -> DataFrame:
    """A typed relation without rows, for a result that matched nothing."""
    return spark.createDataFrame([], ", ".join(f"`{c}` {spark_type(t)}" for c, t in columns))
