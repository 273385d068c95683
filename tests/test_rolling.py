"""Rolling order statistics against lists of each window."""

from __future__ import annotations

import math
import time

import numpy as np
import pyarrow as pa
import pytest

from tidemark.functions import indicators as I
from tidemark.functions import rolling
from tidemark.operators import options as O


def plain(values, n, f):
    return [f(values[i - n + 1 : i + 1]) if i + 1 >= n and None not in values[i - n + 1 : i + 1] else None for i in range(len(values))]


def deviation(w):
    mean = sum(w) / len(w)
    return sum(abs(v - mean) for v in w) / len(w)


def percent(w):
    return 100 * sum(v < w[-1] or w[-1] != w[-1] and v == v for v in w) / len(w)


def series(seed=1, long=2500):
    r = np.random.default_rng(seed)
    out = {"long": r.normal(1000, 50, long).tolist(), "steps": r.integers(0, 4, 400).astype(float).tolist(), "flat": [7.25] * 300, "short": [1.0, 2.0], None: r.normal(size=150).tolist()}
    out["gaps"] = [None if g else v for v, g in zip(r.normal(size=600).tolist(), r.random(600) < 0.02, strict=True)]
    out["odd"] = [math.nan if i == 90 else math.inf if i == 170 else -0.0 if i % 9 == 0 else 0.0 if i % 5 == 0 else float(i % 13) for i in range(300)]
    return out


@pytest.mark.parametrize("n", [1, 2, 20, 64])
@pytest.mark.parametrize("block", [1, 37, 1 << 20])
def test_blocks_of_any_size(n, block):
    """The keys stand one after the other in batches that cut through them."""
    data = series(long=700)
    keys = [k for k, v in data.items() for _ in v]
    values = [x for v in data.values() for x in v]
    for measure, f in ((rolling.mean_deviation, deviation), (rolling.percent_below, percent)):
        blocks, got = rolling._Blocks(n, measure), []
        for at in range(0, len(keys), block):
            got += blocks.next(pa.array(keys[at : at + block], pa.string()), pa.array(values[at : at + block], pa.float64())).to_pylist()
        want = [x for v in data.values() for x in plain(v, n, f)]
        for a, b in zip(got, want, strict=True):
            assert (a is None) == (b is None)
            if b is not None:
                assert a == pytest.approx(b, abs=1e-9, nan_ok=True)


def test_indicators_over_a_panel(spark, monkeypatch):
    monkeypatch.setattr(rolling, "BLOCK_ROWS", 100)
    data = series()
    rows = [(k, i, v, "x") for k, vs in data.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "ticker string, ts int, close double, __node_0_y string").repartition(3, "ts")
    got = I.evaluate(df, mad=I.PriceMeanAbsoluteDeviation(None, 30), mad2=I.IndicatorMeanAbsoluteDeviation(I.Price() * 2, 30), iv=O.iv_percentile(I.Price(), 30), other=I.PriceMeanAbsoluteDeviation("flat", 5))
    assert set(got.columns) == {*df.columns, "mad", "mad2", "iv", "other"}
    at = {(r["ticker"], r["ts"]): r for r in got.collect()}
    assert len(at) == len(rows)
    for k, vs in data.items():
        for i, (m, p) in enumerate(zip(plain(vs, 30, deviation), plain(vs, 30, percent), strict=True)):
            r = at[k, i]
            assert r["mad"] == (None if m is None else pytest.approx(m, abs=1e-9, nan_ok=True))
            assert r["mad2"] == (None if m is None else pytest.approx(2 * m, abs=1e-9, nan_ok=True))
            assert r["iv"] == p
            assert r["other"] == (0.0 if 4 <= i < 300 else None)
    assert I.evaluate(df.limit(0), mad=I.PriceMeanAbsoluteDeviation(None, 30)).count() == 0
    with pytest.raises(ValueError, match="positive"):
        I.PriceMeanAbsoluteDeviation(None, 0)


def test_long_windows_cost_what_short_ones_do():
    r = np.random.default_rng(2)
    keys, values = pa.array(["a"] * 100_000), pa.array(r.normal(size=100_000))

    def took(n):
        out = []
        for _ in range(3):
            blocks, began = rolling._Blocks(n, rolling.mean_deviation), time.perf_counter()
            for at in range(0, 100_000, rolling.BLOCK_ROWS):
                blocks.next(keys.slice(at, rolling.BLOCK_ROWS), values.slice(at, rolling.BLOCK_ROWS))
            out.append(time.perf_counter() - began)
        return min(out)

    assert took(5_000) < 2 * took(50)
