"""Registered queries against their SQL, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
#: One or two of each family; the driver compares all of them.
NAMES = [
    "pf1_comparison", "pf8_multi", "ts11_simple_moving_average", "ts12_exponential_moving_average", "ts20_max_drawdown", "ts30_average_of_rsi_is_shared", "fn16_date", "st5_bars_hour", "jn3_fundamental", "jn4_days_until_earnings",
    "jn6_is_index_member", "pt7_period_1mo", "ps1_portfolio_value", "ps7_position_max_drawup", "ag14_sum_order_amount", "ag1_benjamini_hochberg", "ag2_newey_west_slope", "rk2_select_percentile", "rk3_can_sell", "rk19_covariance_panel",
    "ev2_walk_forward", "ev4_fitness", "opt1_implied_volatility", "opt6_options_builder", "opt13_against_parent", "ag9_lineage_map_void", "jn10_page_states", "ag10_page_audit", "tx2_tables_in_text", "tx7_tx8_row_schema_and_constants", "se6_replay_work",
    "sc3_read_years", "sc13_event_windows", "st1_absorb_feed", "sc2_catalog_of_datasets", "sc20_catalog", "st4_available_points", "st5_bars_from_stream", "pf13_crypto_asset", "pf18_suspect_text", "ts11_simple_moving_average_of_fixed_asset", "ts21_max_drawup", "ev1_backtest",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def shown(v: object) -> str:
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return ""
    if isinstance(v, bool) or type(v).__name__ == "bool":
        return str(bool(v))
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return repr(float(v)) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)


def rows(p: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(map(shown, r)) for r in p[sorted(p.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["ts", "ticker", "weight"]


def test_panel_windows_share_one_exchange(spark):
    from tidemark.functions import indicators as I
    from tidemark.plans.common import daily

    out = I.evaluate(daily(spark, SF), a=I.SimpleMovingAverage(None, 20), b=I.RelativeStrengthIndex(None, 14), c=I.PreviousClosingPrice(), d=I.MaximumPrice(None, 30))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticker") <= 2 and "SinglePartition" not in plan


def test_indicators_do_not_look_ahead(spark):
    from tidemark.functions import indicators as I
    from tidemark.plans.common import daily

    panel = daily(spark, SF).where("ticker < 3")
    nodes = {"a": I.RelativeStrengthIndex(None, 5), "b": I.BollingerBand(None, 5), "c": I.MaxDrawdown(None, 5), "d": I.ExponentialMovingAverage(None, 5)}
    whole = I.evaluate(panel, **nodes).where("ts < '1998-01-01'").select("ticker", "ts", *nodes)
    cut = I.evaluate(panel.where("ts < '1998-01-01'"), **nodes).select("ticker", "ts", *nodes)
    assert rows(whole.toPandas()) == rows(cut.toPandas())


def test_recursive_average_over_blocks_and_nulls(spark):
    from tidemark.functions import indicators as I

    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=700).cumsum() + 50
    gone = rng.random(700) < 0.2
    gone[:3] = True
    rows = [(t, i, None if gone[i] else float(x[i] * (t + 1))) for t in range(2) for i in range(700)]
    panel = spark.createDataFrame(rows, "ticker int, ts int, close double").repartition(5)
    out = I.evaluate(panel, a=I.ExponentialMovingAverage(None, 2), b=I.ExponentialMovingAverage(None, 1), c=I.ExponentialMovingAverage(1, 40)).toPandas()
    for n, name, of in ((2, "a", None), (1, "b", None), (40, "c", 1)):
        for t in range(2):
            values = pd.Series(np.where(gone, np.nan, x * ((t if of is None else of) + 1)))
            want = values.ewm(alpha=2 / (n + 1), adjust=False, ignore_na=True).mean().ffill()
            got = out[out.ticker == t].sort_values("ts")[name].to_numpy(float)
            assert np.allclose(got, want, rtol=1e-12, equal_nan=True)


@pytest.mark.parametrize("n", [1, 2, 7, 12])
def test_swings_in_windows(spark, n):
    from tidemark.functions import indicators as I

    import numpy as np

    x = np.random.default_rng(n).uniform(1, 9, 60)
    rows = [(1, i, None if i == 30 else float(v)) for i, v in enumerate(x)]
    out = I.evaluate(spark.createDataFrame(rows, "ticker int, ts int, close double"), down=I.MaxDrawdown(None, n), up=I.MaxDrawup(None, n)).orderBy("ts").collect()
    for i, r in enumerate(out):
        w = x[max(0, i - n + 1) : i + 1]
        if i < n - 1 or i - n < 30 - 0 <= i and i - n + 1 <= 30:
            assert r["down"] is None and r["up"] is None
            continue
        assert r["down"] == pytest.approx(max(100 * (1 - b / a) for k, a in enumerate(w) for b in w[k:]))
        assert r["up"] == pytest.approx(max(100 * (b / a - 1) for k, a in enumerate(w) for b in w[k:]))


def test_can_sell_carries_over_bars(spark):
    from tidemark.operators import select as K

    rows = [(t, "a", 5.0 if t in (0, 6) else 0.0, t in (4, 9)) for t in range(11)] + [(t, "b", 1.0, True) for t in range(11)]
    p = spark.createDataFrame(rows, "ts int, ticker string, m double, free boolean")
    out = K.dynamic_rebalance(p, [lambda d: d.where("m > 0"), lambda d: K.select_top(d, "m", 1)], can_sell=F.col("free")).where("ticker = 'a'").orderBy("ts").collect()
    assert [(r["ts"], r["weight"]) for r in out] == [(t, 1.0) for t in (0, 1, 2, 3, 6, 7, 8)]


@pytest.mark.parametrize("name", ["rk18_volatility_target", "rk21_diversification_ratio", "rk22_mean_variance_choice"])
def test_risk_queries_read_lineitem_once(spark, monkeypatch, name):
    """Returns are stored; books, means and variances come from there."""
    from tidemark.operators import select as K

    reads = lambda df: "l_suppkey" in df._jdf.queryExecution().analyzed().toString()
    made, written = [], K.written
    monkeypatch.setattr(K, "written", lambda df, stem: (made.append(stem) if reads(df) else None, written(df, stem))[1])
    assert not reads(entry.queries()[name](spark, SF)) and made == ["returns"]
