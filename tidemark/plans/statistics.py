"""Queries of the statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import stats as S

from .common import r, register, rounded, table


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each day."""
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").cast("double").alias("value"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays, with a return made of that day's events."""
    e = table(spark, sf_dir, "events").withColumn("session_date", F.to_date("ts")).where(F.weekday("session_date") < 5)
    return e.groupBy("session_date").agg((F.avg("value") / 100 - 0.5).alias("asset_return"))


CAL = "c AS (SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1), s AS (SELECT CAST(ts AS DATE) AS session_date, avg(value) / 100 - 0.5 AS asset_return FROM events WHERE isodow(ts) < 6 GROUP BY 1)"


def _align(name: str, how: str, lead: int) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = S.align_calendar(calendar(spark, sf_dir), sessions(spark, sf_dir), how, lead)
        return out.select("session_date", rounded("predictor").alias("predictor"), "n_days_collapsed")

    k = f"(SELECT count(*) FROM s WHERE s.session_date <= c.day) + {lead}"
    agg = "sum" if how == "sum" else "avg"
    register(name, query, f"WITH {CAL}, n AS (SELECT session_date, row_number() OVER (ORDER BY session_date) AS k FROM s), p AS (SELECT c.*, {k} AS k FROM c) SELECT n.session_date, {r(f'{agg}(value)')} AS predictor, count(*) AS n_days_collapsed FROM p JOIN n USING (k) GROUP BY 1")


_align("jn2_align_calendar", "sum", 1)
_align("jn2_align_calendar_same_day", "mean", 0)
_align("jn2_align_calendar_two_ahead", "sum", 2)
register(
    "jn1_next_session",
    lambda spark, d: S.next_session(calendar(spark, d), sessions(spark, d)).select("session_date", rounded("predictor").alias("predictor"), "n_days_collapsed", rounded("asset_return").alias("asset_return")),
    f"WITH {CAL}, n AS (SELECT *, row_number() OVER (ORDER BY session_date) AS k FROM s), p AS (SELECT c.*, (SELECT count(*) FROM s WHERE s.session_date <= c.day) + 1 AS k FROM c) SELECT n.session_date, {r('sum(value)')} AS predictor, count(*) AS n_days_collapsed, {r('any_value(asset_return)')} AS asset_return FROM p JOIN n USING (k) WHERE asset_return IS NOT NULL GROUP BY 1",
)


def pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by language: a number in [0, 1] of each document, every seventh one missing."""
    d = table(spark, sf_dir, "documents")
    p = (F.col("doc_id") * 7919 % 100_003) / 100_003
    return d.select(F.col("lang").alias("family"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 7 != 0, p * p).alias("p"))


register(
    "ag1_benjamini_hochberg",
    lambda spark, d: S.benjamini_hochberg(pvalues(spark, d), ["family"]).select("family", "pos", rounded("adjusted").alias("adjusted"), "reject"),
    f"""WITH v AS (SELECT lang AS family, doc_id AS pos, CASE WHEN doc_id % 7 <> 0 THEN pow((doc_id * 7919 % 100003) / 100003.0, 2) END AS p FROM documents),
    a AS (SELECT *, p * count(*) OVER (PARTITION BY family) / row_number() OVER (PARTITION BY family ORDER BY p) AS raw FROM v WHERE p IS NOT NULL),
    b AS (SELECT *, least(1.0, min(raw) OVER (PARTITION BY family ORDER BY p DESC)) AS adjusted FROM a)
    SELECT v.family, v.pos, {r('b.adjusted')} AS adjusted, coalesce(b.adjusted <= 0.05, false) AS reject FROM v LEFT JOIN b USING (family, pos)""",
)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type's mean value and count of each hour."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("g"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("x"), F.count("*").cast("double").alias("y"), F.sum("value").alias("total"))


SER = "z AS (SELECT event_type AS g, date_trunc('hour', ts) AS ts, avg(value) AS x, CAST(count(*) AS DOUBLE) AS y, sum(value) AS total FROM events GROUP BY 1, 2)"
_LAGS = " + ".join(f"2 * (1 - {k} / 6.0) * coalesce(g1 * lag(g1, {k}) OVER w, 0)" for k in range(1, 6))
register(
    "ag2_newey_west_slope",
    lambda spark, d: S.hac_slope(series(spark, d), ["g"], "ts").select("g", "n", rounded("slope").alias("slope"), rounded("hac_se").alias("hac_se"), rounded("t").alias("t")),
    f"""WITH {SER}, l AS (SELECT g, count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_slope(y, x) AS slope, regr_sxx(y, x) AS sxx FROM z GROUP BY 1),
    u AS (SELECT z.g, z.ts, (x - mx) * (y - my - slope * (x - mx)) AS g1 FROM z JOIN l USING (g)), m AS (SELECT g, g1 * g1 + {_LAGS} AS part FROM u WINDOW w AS (PARTITION BY g ORDER BY ts)),
    s AS (SELECT g, sqrt(greatest(sum(part), 0)) AS meat FROM m GROUP BY 1)
    SELECT g, n, {r('slope')} AS slope, {r('meat / sxx')} AS hac_se, {r('slope / (meat / sxx)')} AS t FROM l JOIN s USING (g)""",
)
register("ag3_block_bootstrap_corr", lambda spark, d: S.block_bootstrap_corr(series(spark, d), ["g"], "ts", n_boot=500))
_BREAK = f"""i AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, sum(total) OVER (PARTITION BY g) AS al, sum(total) OVER (PARTITION BY g ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS be FROM z),
    c AS (SELECT g, ts, i, n, abs(be / i - (al - be) / (n - i)) AS score FROM i WHERE i >= 30 AND i <= n - 30 AND (i - 30) % 10 = 0 AND n >= 61),
    k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, i) AS rn FROM c)"""
register(
    "ag4_mean_shift_break",
    lambda spark, d: S.mean_shift_break(series(spark, d), ["g"], "ts", "total", step=10, min_abs_shift=30.0).select("g", "n", F.col("at").alias("split_at"), "split", rounded("score").alias("score"), "detected"),
    f"WITH {SER}, {_BREAK} SELECT a.g, a.n, k.ts AS split_at, k.i AS split, {r('k.score')} AS score, coalesce(k.score >= 30.0, false) AS detected FROM (SELECT g, count(*) AS n FROM z GROUP BY 1) a LEFT JOIN k ON a.g = k.g AND k.rn = 1",
)
register("ag4_mean_shift_break_by_permutation", lambda spark, d: S.mean_shift_break(series(spark, d), ["g"], "ts", "total", step=10, n_perm=100))


def _pred(spark: SparkSession, d: str) -> DataFrame:
    return series(spark, d).where("g = 'click'").select("ts", F.col("x").alias("value"))


def _rets(spark: SparkSession, d: str) -> DataFrame:
    return series(spark, d).where("g = 'view'").select("ts", (F.col("x") / 50 - 1).alias("value"))


_PX = f"""{SER}, p AS (SELECT ts, x AS value FROM z WHERE g = 'click'), q AS (SELECT ts, x / 50 - 1 AS value FROM z WHERE g = 'view'),
    pt AS (SELECT ts, value AS v, lag(value) OVER (ORDER BY ts) AS b, bool_and(value > 0) OVER () AS pos FROM p),
    px AS (SELECT ts, 'level' AS transform, v AS value FROM pt UNION ALL SELECT ts, 'diff', v - b FROM pt WHERE b IS NOT NULL UNION ALL
        SELECT ts, 'dlog', ln(v) - ln(b) FROM pt WHERE pos AND b IS NOT NULL UNION ALL SELECT ts, 'basedev', v / 40 - 1 FROM pt),
    qt AS (SELECT ts, value AS v, CASE WHEN count(value) OVER w = 5 THEN stddev_samp(value) OVER w END AS vol FROM q WINDOW w AS (ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
    qx AS (SELECT ts, 'signed_return' AS target, v AS value FROM qt UNION ALL SELECT ts, 'abs_return', abs(v) FROM qt UNION ALL SELECT ts, 'realized_vol', vol FROM qt WHERE vol IS NOT NULL)"""
register("ag6_predictor_transforms", lambda spark, d: S.predictor_transforms(_pred(spark, d), "ts", "value", 40.0).select("ts", "transform", rounded("value").alias("value")), f"WITH {_PX} SELECT ts, transform, {r('value')} AS value FROM px")
register("ag7_target_transforms", lambda spark, d: S.target_transforms(_rets(spark, d), "ts", "value").select("ts", "target", rounded("value").alias("value")), f"WITH {_PX} SELECT ts, target, {r('value')} AS value FROM qx")
register(
    "ag5_spec_curve",
    lambda spark, d: S.spec_curve(_pred(spark, d), _rets(spark, d), baseline=40.0).select("spec", "n", rounded("r").alias("r"), F.col("skipped").isNotNull().alias("left_out")),
    f"WITH {_PX} SELECT 'full:' || transform || '->' || target AS spec, count(*) AS n, {r('corr(px.value, qx.value)')} AS r, false AS left_out FROM px JOIN qx USING (ts) GROUP BY transform, target",
)
register("ag5_spec_curve_survivors", lambda spark, d: S.spec_curve(_pred(spark, d), _rets(spark, d), baseline=40.0))
register("ag8_unit_root", lambda spark, d: S.nonstationary(series(spark, d), ["g"], "ts", "x"))
register(
    "jn13_inner_join_of_specs",
    lambda spark, d: _pred(spark, d).withColumnRenamed("value", "x").join(_rets(spark, d).withColumnRenamed("value", "y"), "ts").dropna().select("ts", rounded("x").alias("x"), rounded("y").alias("y")),
    f"WITH {_PX} SELECT ts, {r('p.value')} AS x, {r('q.value')} AS y FROM p JOIN q USING (ts) WHERE p.value IS NOT NULL AND q.value IS NOT NULL",
)
