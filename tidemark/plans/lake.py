"""Queries of dataset reads. The lake of these queries is the test tables, partitioned on the fly where a read needs it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.sources import catalog as C
from tidemark.sources.storage import new_path

from .common import r, register, rounded, table

_FACTS = C.Dataset("order_facts", "year", "ticker", ("ticker", "day", "val"))
_DAYS = C.Dataset("activity", "day", "ticker", ("ticker", "day", "value"))
_SNAP = C.Dataset("suppliers", "snapshot", "s_suppkey", ("s_suppkey", "s_name"))
_ALL = C.Dataset("regions", "snapshot", "r_regionkey", None)


def _folder(spark: SparkSession) -> str:
    return new_path(spark, "lake")


def lake(spark: SparkSession, sf_dir: str, *names: str) -> C.Lake:
    """A lake that holds the named ones of four datasets."""
    root = _folder(spark)
    for name in names:
        _write(spark, sf_dir, f"{root}/{name}", name)
    return C.Lake(spark, root, {d.name: d for d in (_FACTS, _DAYS, _SNAP, _ALL)})


def _write(spark: SparkSession, sf_dir: str, at: str, name: str) -> None:
    if name == "order_facts":
        o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("val"), F.year("o_orderdate").alias("year"))
        o.repartition("year").write.partitionBy("year").parquet(at)
    elif name == "activity":
        e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("ticker"), F.to_date("ts").alias("day")).agg(F.count("*").alias("value"))
        e.repartition("day").write.partitionBy("day").parquet(at)
    else:
        table(spark, sf_dir, "region" if name == "regions" else "supplier").write.parquet(f"{at}/current")


_Y = "SELECT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS day, {v} AS val FROM orders WHERE {w}"
_V = r("o_totalprice")
register("sc3_read_years", lambda s, d: lake(s, d, "order_facts").read_years("order_facts", [1996, 1998], where="val > :low", args={"low": 50000}).withColumn("val", rounded("val")), _Y.format(v=_V, w="year(o_orderdate) IN (1996, 1998) AND o_totalprice > 50000"))
register("sc3_read_years_of_dates", lambda s, d: lake(s, d, "order_facts").read_years("order_facts", start=dt.date(1998, 3, 1), end=dt.date(1997, 6, 1), columns=["ticker", "day"]), "SELECT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS day FROM orders WHERE year(o_orderdate) IN (1997, 1998)")
register("sc4_read_days", lambda s, d: lake(s, d, "activity").read_days("activity", dt.date(2024, 1, 24), dt.date(2024, 1, 5)), "SELECT user_id AS ticker, CAST(ts AS DATE) AS day, count(*) AS value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-24' GROUP BY 1, 2")
register("sc5_read_snapshot", lambda s, d: lake(s, d, "suppliers").read_snapshot("suppliers", "s_nationkey = 3"), "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 3")
register("sc15_inspect_table", lambda s, d: lake(s, d, "regions").inspect("regions", rows=20)[1], "SELECT * FROM region")  # it has fewer rows than inspection shows
register("sc16_years_present", lambda s, d: (lambda k: k.years().select("dataset", F.explode("years").alias("year")))(lake(s, d, "order_facts")), "SELECT DISTINCT 'order_facts' AS dataset, year(o_orderdate) AS year FROM orders")
register(
    "sc20_catalog",
    lambda s, d: lake(s, d, "order_facts").contents().select("dataset", "part", "rows", F.array_join("columns", ",").alias("columns")),
    "SELECT 'order_facts' AS dataset, 'year=' || year(o_orderdate) AS part, count(*) AS rows, 'ticker,day,val,year' AS columns FROM orders GROUP BY 2",
)


def _sc2(s: SparkSession, d: str) -> DataFrame:
    """What the catalog says of each dataset beside what lies on disk."""
    k = lake(s, d, "order_facts", "activity", "suppliers")
    held = k.contents().groupBy("dataset").agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"))
    return k.listing().join(held, F.col("name") == F.col("dataset")).select("dataset", "grain", "identity", F.array_join("partitions", ",").alias("partitions"), "parts", "rows")


register(
    "sc2_catalog_of_datasets",
    _sc2,
    """SELECT 'order_facts' AS dataset, 'year' AS grain, 'ticker' AS identity, 'year' AS partitions, count(DISTINCT year(o_orderdate)) AS parts, count(*) AS rows FROM orders
    UNION ALL SELECT 'activity', 'day', 'ticker', 'day', count(DISTINCT CAST(ts AS DATE)), count(DISTINCT (user_id, CAST(ts AS DATE))) FROM events UNION ALL SELECT 'suppliers', 'snapshot', 's_suppkey', '', 1, count(*) FROM supplier""",
)


def _sc19(s: SparkSession, d: str) -> DataFrame:
    k = lake(s, d, "order_facts")
    k.register()
    return k.sql("SELECT ticker, count(*) AS n FROM order_facts WHERE array_contains(?, year) AND ticker < ? GROUP BY ticker", [[1996, 1997], 500], 100_000)


register("sc19_sql_with_binds", _sc19, "SELECT o_custkey AS ticker, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1997) AND o_custkey < 500 GROUP BY 1")


def _sc19_limits(s: SparkSession, d: str) -> DataFrame:
    k = lake(s, d, "order_facts", "activity")
    k.register()
    query = """WITH days AS (SELECT day, count(DISTINCT ticker) AS tickers, sum(value) AS value FROM activity GROUP BY day)
        SELECT day, tickers, value, rank() OVER (ORDER BY value DESC, day) AS place FROM days -- the busiest first
        WHERE day >= (SELECT min(day) FROM activity WHERE value > :least) ORDER BY place;"""
    return k.sql(query, {"least": 1}, max_rows=100_000, max_bytes=64 << 20, seconds=600)


register(
    "sc19_sql_within_limits",
    _sc19_limits,
    """WITH activity AS (SELECT user_id AS ticker, CAST(ts AS DATE) AS day, count(*) AS value FROM events GROUP BY 1, 2),
    days AS (SELECT day, count(DISTINCT ticker) AS tickers, sum(value)::BIGINT AS value FROM activity GROUP BY day)
    SELECT day, tickers, value, (rank() OVER (ORDER BY value DESC, day))::INTEGER AS place FROM days WHERE day >= (SELECT min(day) FROM activity WHERE value > 1)""",
)


def _sc7(s: SparkSession, d: str) -> DataFrame:
    c, p = table(s, d, "customer"), table(s, d, "supplier")
    a = c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = p.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return C.union_by_name([a, b]).where("balance > 100").select("id", rounded("balance").alias("balance"), "segment")


register("sc7_union_by_name", _sc7, f"SELECT id, {r('balance')} AS balance, segment FROM (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier) WHERE balance > 100")


def _sc6(s: SparkSession, d: str) -> DataFrame:
    """The shards of years: a manifest lists two for 1997, other years have the canonical one."""
    base = _folder(s)
    years = [r_["y"] for r_ in table(s, d, "orders").select(F.year("o_orderdate").alias("y")).distinct().orderBy("y").collect()]  # a row for each year
    s.createDataFrame([('{"shards": ["1997-a.parquet", "1997-b.parquet"]}',)], "value string").coalesce(1).write.text(f"{base}/tmp")
    path = s._jvm.org.apache.hadoop.fs.Path(f"{base}/tmp")
    fs = path.getFileSystem(s._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("part-"))
    fs.rename(part, s._jvm.org.apache.hadoop.fs.Path(f"{base}/1997.manifest.json"))
    return C.shard_paths(s, base, years).select("year", F.element_at(F.split("path", "/"), -1).alias("shard"))


register("sc6_shards_of_years", _sc6, "SELECT y AS year, CASE WHEN y <> 1997 THEN y || '-all.parquet' ELSE x END AS shard FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (VALUES ('1997-a.parquet'), ('1997-b.parquet')) v(x) WHERE y = 1997 OR x = '1997-a.parquet'")


def _named(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select(F.concat(F.lit("t"), (F.col("o_custkey") % 20).cast("string")).alias("ticker"), F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("closingPrice"))


register("sc10_read_ohlc", lambda s, d: C.bars_of(_named(s, d), ["T3", "t5"], dt.date(1996, 1, 1), dt.date(1998, 6, 30), [1996, 1998]).select("ticker", "date", rounded("closingPrice").alias("price")), f"SELECT 't' || (o_custkey % 20) AS ticker, o_orderdate AS date, {r('o_totalprice')} AS price FROM orders WHERE o_custkey % 20 IN (3, 5) AND o_orderdate >= '1996-01-01' AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30' AND year(o_orderdate) IN (1996, 1998)")
register("sc11_read_crypto_daily", lambda s, d: C.bars_of(_named(s, d), ["T7"], start=dt.date(1999, 1, 1)).select("ticker", "date"), "SELECT 't' || (o_custkey % 20) AS ticker, o_orderdate AS date FROM orders WHERE o_custkey % 20 = 7 AND o_orderdate >= '1999-01-01'")


def _chain(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    return o.select(F.concat(F.lit("u"), (F.col("o_custkey") % 20).cast("string")).alias("underlying"), F.col("o_orderdate").alias("timestamp"), F.when(F.col("o_orderkey") % 2 == 0, "Call").otherwise("Put").alias("optionType"), F.col("o_orderkey").alias("ticker"))


register("sc12_read_options_daily", lambda s, d: C.options_of(_chain(s, d), ["U3"], [1997], option_type="call"), "SELECT o_orderkey AS ticker, 'u3' AS underlying, 'Call' AS \"optionType\", o_orderdate AS timestamp FROM orders WHERE o_custkey % 20 = 3 AND year(o_orderdate) = 1997 AND o_orderkey % 2 = 0")
register("sc13_event_windows", lambda s, d: C.event_windows(_chain(s, d), table(s, d, "orders").groupBy(F.year("o_orderdate")).agg(F.max_by("o_orderdate", F.struct("o_totalprice", "o_orderkey")).alias("date")), 3, 2).select("ticker", "timestamp"), "WITH e AS (SELECT arg_max(o_orderdate, (o_totalprice, o_orderkey)) AS at FROM orders GROUP BY year(o_orderdate)) SELECT o_orderkey AS ticker, o_orderdate AS timestamp FROM orders o WHERE EXISTS (SELECT 1 FROM e WHERE CAST(o.o_orderdate AS DATE) BETWEEN CAST(e.at AS DATE) - 3 AND CAST(e.at AS DATE) + 2)")
register("sc16_fallback_to_backup", lambda s, d: C.with_backup(*(table(s, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", F.lit(x).alias("role")).where(w) for x, w in (("standard", "year <> 1996"), ("backup", "year < 1998")))), "SELECT year(o_orderdate) AS year, o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN 'backup' ELSE 'standard' END AS role FROM orders")
register("sc18_typed_rows", lambda s, d: C.typed_rows(table(s, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("a"), F.when(F.col("event_id") % 2 == 0, F.to_date("ts").cast("string")).otherwise(F.lit("soon")).alias("t")), {"a": "int", "t": "timestamp"}).withColumn("t", F.col("t").cast("timestamp_ntz")), "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS a, CASE WHEN event_id % 2 = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS t FROM events")
register("sc23_empty_relation", lambda s, d: C.empty_relation(s, [("a", "BIGINT"), ("b", "VARCHAR(9)"), ("c", "DOUBLE[]")]).unionByName(table(s, d, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_orderstatus").alias("b"), F.array("o_totalprice").alias("c"))).select("a", "b"), "SELECT o_orderkey AS a, o_orderstatus AS b FROM orders")


def _sc21(s: SparkSession, d: str) -> DataFrame:
    at = _folder(s)
    table(s, d, "orders").repartition(3, "o_orderkey").write.parquet(at)
    m = Q.written_manifest(s, at).withColumn("manifest", F.lit("orders"))
    return Q.manifest_audit(m).select("manifest", "valid", "n")


register("sc21_result_manifest", _sc21, "SELECT 'orders' AS manifest, true AS valid, 3 AS n")


def _sc27(s: SparkSession, d: str) -> DataFrame:
    at = _folder(s)
    rows = table(s, d, "events").select(F.to_date("ts").cast("string").alias("timestamp"), "value", F.col("event_type").alias("ticker"), "event_id").where("value is not null")
    Q.write_rows(rows, f"{at}/rows", f"{at}/rejected", ["view", "click"])
    return s.read.schema("timestamp string, value double, ticker string, event_id bigint").json(f"{at}/rows").select("event_id", "timestamp", "ticker")


register("sc27_sc28_write_rows", _sc27, "SELECT event_id, strftime(ts, '%Y-%m-%d') AS timestamp, event_type AS ticker FROM events WHERE value IS NOT NULL AND event_type IN ('view', 'click')")
