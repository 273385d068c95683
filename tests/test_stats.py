"""Calendar alignment, false discovery, breaks, slopes and bootstrap on small series."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from tidemark.operators import stats as S


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def calendar(spark, rows):
    return spark.createDataFrame([(day(d), float(v)) for d, v in rows], "day date, value double")


def sessions(spark, days):
    return spark.createDataFrame([(day(d),) for d in days], "session_date date")


@pytest.mark.parametrize(
    ("rows", "days", "how", "lead", "expected"),
    [
        ([("2025-01-02", 10), ("2025-01-03", 3), ("2025-01-04", 2), ("2025-01-05", 1)], ["2025-01-02", "2025-01-03", "2025-01-06", "2025-01-07"], "sum", 1, {"2025-01-03": (10, 1), "2025-01-06": (6, 3)}),
        ([("2024-12-31", 5), ("2025-01-01", 7), ("2025-01-02", 4)], ["2024-12-31", "2025-01-02", "2025-01-03"], "sum", 1, {"2025-01-02": (12, 2), "2025-01-03": (4, 1)}),
        ([("2025-01-02", 1), ("2025-01-03", 2)], ["2025-01-02", "2025-01-03"], "sum", 0, {"2025-01-02": (1, 1), "2025-01-03": (2, 1)}),
        ([("2025-01-04", 10), ("2025-01-05", 20)], ["2025-01-03", "2025-01-06"], "mean", 1, {"2025-01-06": (15, 2)}),
        ([("2025-01-03", 9)], ["2025-01-03", "2025-01-06"], "sum", 0, {"2025-01-03": (9, 1)}),
    ],
)
def test_align_calendar(spark, rows, days, how, lead, expected):
    got = S.align_calendar(calendar(spark, rows), sessions(spark, days), how, lead).collect()
    assert {str(r["session_date"]): (r["predictor"], r["n_days_collapsed"]) for r in got} == expected


def test_next_session_refuses_repeated_dates(spark):
    r = spark.createDataFrame([(day("2025-01-03"), 0.01)] * 2, "session_date date, asset_return double")
    with pytest.raises(Exception, match="unique"):
        S.next_session(calendar(spark, [("2025-01-02", 1)]), r).collect()


def test_benjamini_hochberg(spark):
    p = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0001, 0.6, 0.7, 0.8, 0.9])] + [("b", 0, None), ("b", 1, 0.001), ("b", 2, None)], "family string, pos long, p double")
    got = {(r["family"], r["pos"]): (r["adjusted"], r["reject"]) for r in S.benjamini_hochberg(p, ["family"]).collect()}
    assert [k for k, v in got.items() if v[1]] and {k for k, v in got.items() if v[1]} == {("a", 0), ("b", 1)}
    assert got["b", 0] == (None, False) and got["a", 0][0] == pytest.approx(0.0005)


def test_break(spark):
    rows = [("x", i, 0.0 if i < 100 else 10.0) for i in range(200)] + [("short", i, 1.0) for i in range(3)]
    got = {r["g"]: r for r in S.mean_shift_break(spark.createDataFrame(rows, "g string, i long, v double"), ["g"], "i", "v", step=10, min_side=20, min_abs_shift=5).collect()}
    assert got["x"]["detected"] and got["x"]["score"] >= 5 and got["x"]["split"] == 100
    assert not got["short"]["detected"] and got["short"]["score"] is None


def test_slope_and_bootstrap(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=200)
    y = 2 * x + rng.normal(size=200)
    rows = [("a", i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))] + [("flat", i, 1.0, float(i)) for i in range(10)]
    xy = spark.createDataFrame(rows, "g string, i long, x double, y double")
    got = {r["g"]: r for r in S.hac_slope(xy, ["g"], "i").collect()}
    assert abs(got["a"]["slope"] - 2) < 0.2 and got["a"]["p"] < 0.01 and got["flat"]["p"] is None
    boot = [S.block_bootstrap_corr(xy.where("g = 'a'"), ["g"], "i", n_boot=200).first() for _ in range(2)]
    assert boot[0]["ci_low"] == pytest.approx(boot[1]["ci_low"]) and boot[0]["p"] == boot[1]["p"] and boot[0]["r"] > 0.4 and boot[0]["ci_low"] < boot[0]["r"] < boot[0]["ci_high"] and boot[0]["p"] == pytest.approx(1 / 200)


def test_bootstrap_equals_its_definition(spark):
    rng = np.random.default_rng(5)
    n, block, reps = 43, 5, 300
    x = rng.normal(size=n)
    y = 0.5 * x + rng.normal(size=n)
    xy = spark.createDataFrame([("a", i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "g string, i long, x double, y double")
    got = S.block_bootstrap_corr(xy, ["g"], "i", block=block, n_boot=reps, seed=9).first()
    boot = []
    for rep in range(reps):
        start = np.random.default_rng([9, rep]).integers(0, n, -(-n // block))
        at = [(s + k) % n for s in start for k in range(block)][:n]
        boot.append(np.corrcoef(x[at], y[at])[0, 1])
    assert got["r"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert (got["ci_low"], got["ci_high"]) == pytest.approx(tuple(np.percentile(boot, [2.5, 97.5])))
    other = np.mean(np.array(boot) <= 0) if got["r"] > 0 else np.mean(np.array(boot) >= 0)
    assert got["p"] == pytest.approx(min(1, max(1 / reps, 2 * other)))


def test_break_by_permutation(spark):
    rng = np.random.default_rng(11)
    noise = rng.normal(size=200)
    rows = [("null", i, float(v)) for i, v in enumerate(noise)] + [("shift", i, float(v + 3 * (i >= 90))) for i, v in enumerate(noise)] + [("short", i, float(i)) for i in range(3)]
    out = S.mean_shift_break(spark.createDataFrame(rows, "g string, i long, v double"), ["g"], "i", "v", step=10, min_side=20, alpha=0.01, n_perm=100, seed=11)
    got = {r["g"]: r for r in out.collect()}
    assert not got["null"]["detected"] and got["null"]["p"] > 0.01
    assert got["shift"]["detected"] and got["shift"]["p"] == pytest.approx(1 / 101) and got["shift"]["split"] == 90
    best = max(abs(noise[:k].mean() - noise[k:].mean()) for k in range(20, 181, 10))
    assert got["null"]["score"] == pytest.approx(best)
    assert not got["short"]["detected"] and got["short"]["score"] is None
    again = {r["g"]: r["p"] for r in S.mean_shift_break(out.sparkSession.createDataFrame(rows, "g string, i long, v double").repartition(7), ["g"], "i", "v", step=10, min_side=20, n_perm=100, seed=11).collect()}
    assert again["null"] == got["null"]["p"]


def test_unit_roots(spark):
    rng = np.random.default_rng(4)
    steps = rng.normal(size=300)
    kinds = {"walk": np.cumsum(steps), "noise": steps, "constant": np.ones(50), "short": steps[:5]}
    rows = [(g, i, float(v)) for g, x in kinds.items() for i, v in enumerate(x)]
    got = {r["g"]: r["nonstationary"] for r in S.nonstationary(spark.createDataFrame(rows, "g string, i long, v double"), ["g"], "i", "v").collect()}
    assert got == {"walk": True, "noise": False, "constant": None, "short": None}


def plain_unit_root(v):
    """Lag order, statistic and verdict by least squares on the whole series."""
    n, d = len(v), np.diff(v)
    if n < 10 or np.ptp(v) == 0:
        return None, None, None
    most = max(0, min(int(np.ceil(12 * (n / 100) ** 0.25)), (len(d) - 1) // 2 - 2))

    def fit(lags, start):
        rows = np.arange(start, len(d))
        x = np.column_stack([v[rows], np.ones(len(rows)), *(d[rows - k] for k in range(1, lags + 1))])
        beta = np.linalg.lstsq(x, d[rows], rcond=None)[0]
        return x, beta, d[rows] - x @ beta

    def criterion(lags):
        x, _, e = fit(lags, most)
        return len(x) * np.log(e @ e / len(x)) + 2 * x.shape[1]

    lags = min(range(most + 1), key=criterion)
    x, beta, e = fit(lags, lags)
    t = beta[0] / np.sqrt(e @ e / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    size = len(x)
    return lags, t, t > -2.86154 - 2.8903 / size - 4.234 / size**2 - 40.04 / size**3


@pytest.mark.parametrize("chunk_rows", [1 << 18, 40])
def test_unit_roots_equal_least_squares(spark, chunk_rows):
    """50 series: walks, noise, trends and waves, near and far from 0, in one chunk or many."""
    rng, kinds = np.random.default_rng(8), {}
    for k in range(50):
        n = int(rng.integers(10, 400))
        e = rng.normal(size=n)
        smooth = np.convolve(e, [1, 0.6, 0.3], "same")
        kinds[None if k == 7 else f"s{k}"] = [np.cumsum(e), e, np.cumsum(smooth) + 1e4, 0.05 * np.arange(n) + smooth, np.sin(np.arange(n) / 9) + 0.1 * e][k % 5]
    rows = [(g, i, float(v)) for g, x in kinds.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, i long, v double").repartition(5)
    got = {r["g"]: r for r in S.unit_root(df, ["g"], "i", "v", chunk_rows).collect()}
    assert len(got) == 50
    for g, x in kinds.items():
        lags, t, verdict = plain_unit_root(x)
        assert (got[g]["n"], got[g]["lags"], got[g]["nonstationary"]) == (len(x), lags, verdict)
        assert got[g]["statistic"] == pytest.approx(t, rel=1e-6)


def test_unit_roots_without_an_answer(spark):
    kinds = {"constant": np.full(50, 0.1), "short": np.arange(9.0), "line": np.arange(60.0), "one": np.ones(1)}
    rows = [(g, i, float(v)) for g, x in kinds.items() for i, v in enumerate(x)] + [("null", 0, None)]
    got = {r["g"]: r["nonstationary"] for r in S.unit_root(spark.createDataFrame(rows, "g string, i long, v double"), ["g"], "i", "v").collect()}
    assert got == {"constant": None, "short": None, "line": None, "one": None}
    noise = spark.range(300).selectExpr("id AS i", "sin(id * id) AS v")
    assert S.unit_root(noise, [], "i", "v").first()["nonstationary"] is False


@pytest.mark.parametrize("chunk_rows", [7, 20])
def test_bootstrap_of_many_chunks_equals_that_of_one(spark, chunk_rows):
    rng = np.random.default_rng(5)
    rows = [(g, i, float(rng.normal()), float(rng.normal())) for g, n in (("a", 43), (None, 61), ("b", 3), ("c", 2)) for i in range(n)]
    xy = spark.createDataFrame(rows, "g string, i long, x double, y double")
    one, many = ({r["g"]: r for r in S.block_bootstrap_corr(xy, ["g"], "i", n_boot=100, chunk_rows=k).collect()} for k in (1000, chunk_rows))
    assert one.keys() == many.keys() == {"a", None, "b", "c"} and one["c"]["p"] is None
    for g, r in one.items():
        assert many[g][:] == pytest.approx(r[:], nan_ok=True) if r["p"] is not None else many[g]["p"] is None


@pytest.mark.parametrize("n", [1, 2, 5, 61, 1000])
def test_shuffled_places_are_permutations(n):
    places = np.arange(n)
    seen = [S.shuffled_place(places, n, 3, rep) for rep in range(400)]
    assert all(sorted(p) == list(range(n)) for p in seen)
    assert (S.shuffled_place(places[n // 2 :], n, 3, 7) == seen[7][n // 2 :]).all()
    if n == 5:  # every place is taken about as often by each
        counts = np.array([np.bincount([p[i] for p in seen], minlength=5) for i in range(5)])
        assert ((counts - 80) ** 2 / 80).sum(axis=1).max() < 25
        assert len({tuple(p) for p in seen}) > 50


def test_break_by_permutation_in_chunks_equals_its_definition(spark):
    rng = np.random.default_rng(21)
    v = rng.normal(size=130) + 0.5 * (np.arange(130) > 80)
    rows = [(None, i, float(x)) for i, x in enumerate(v)] + [("flat", i, 0.1) for i in range(80)] + [("short", i, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    splits = np.arange(20, 111, 10)
    score = lambda x: max(abs(x[:k].mean() - x[k:].mean()) for k in splits)
    shuffled = []
    for rep in range(60):
        x = np.empty(130)
        x[S.shuffled_place(np.arange(130), 130, 4, rep)] = v
        shuffled.append(score(x))
    want = (1 + sum(s >= score(v) for s in shuffled)) / 61
    for chunk_rows in (25, 1000):
        got = {r["g"]: r for r in S.mean_shift_break(df, ["g"], "i", "v", step=10, min_side=20, n_perm=60, seed=4, chunk_rows=chunk_rows).collect()}
        assert got[None]["p"] == pytest.approx(want) and got[None]["score"] == pytest.approx(score(v))
        assert got["flat"]["p"] == 1.0 and not got["flat"]["detected"]
        assert got["short"]["p"] is None and got["short"]["score"] is None and not got["short"]["detected"]


def test_cooldown(spark):
    rng = np.random.default_rng(2)
    days = {t: sorted(rng.choice(200, 60, replace=False).tolist()) for t in (1, 2)}
    rows = [(t, dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for t, ds in days.items() for d in ds]
    want = set()
    for t, ds in days.items():
        last = None
        for d in ds:
            if last is None or d - last >= 5:
                last = d
                want.add((t, dt.datetime(2024, 1, 1) + dt.timedelta(days=d)))
    got = S.ordered_cooldown(spark.createDataFrame(rows, "ticker int, ts timestamp_ntz"), ["ticker"], "ts", 5).collect()
    assert {(r["ticker"], r["ts"]) for r in got} == want and len(got) == len(want)


def test_covariance_of_gaps_and_many_groups(spark):
    from tidemark.operators import select as K

    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 9)) * 5 + 100
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 8] = np.nan
    x[:15, 8] = 1.0
    rows = [(t, i, float(x[t, i])) for t in range(60) for i in range(9) if x[t, i] == x[t, i]]
    got = {(r["i"], r["j"]): (r["n"], r["cov"]) for r in K.covariance(spark.createDataFrame(rows, "ts int, ticker int, ret double"), blocks=(4, 6, 2)).collect()}
    for i in range(9):
        for j in range(9):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if both.sum() < 20:
                assert (i, j) not in got
                continue
            assert got[i, j][0] == both.sum() and got[i, j][1] == pytest.approx(np.cov(x[both, i], x[both, j])[0, 1] * (1 if i == j else 0.75))


def test_covariance_blocks_are_bounded():
    from tidemark.operators import select as K

    assert K.covariance_blocks(1, 0, 8)[0] == 1
    for names, bars, tasks in ((1, 1, 1), (100, 2_500, 8), (3_000, 30, 4), (3_000, 250, 4_000), (100_000, 1_000_000, 4_000)):
        groups, parts, splits = K.covariance_blocks(names, bars, tasks)
        assert names / groups <= K.GROUP_NAMES and bars / parts <= K.PART_BARS and splits <= parts
        assert groups <= max(names / K.GROUP_NAMES + 1, (2 * tasks) ** 0.5)
        assert groups * (groups + 1) / 2 * splits >= min(tasks, bars)


def test_covariance_of_many_names(spark):
    """3,000 names in blocks that are counted; no task holds a matrix of all names."""
    from pyspark.sql import functions as F

    from tidemark.operators import select as K

    rng = np.random.default_rng(6)
    x = rng.normal(size=(25, 3_000)) + rng.normal(size=(25, 1))
    rows = spark.createDataFrame([(t, x[t].tolist()) for t in range(25)], "ts int, x array<double>").select("ts", F.posexplode("x").alias("ticker", "ret"))
    groups = K.covariance_blocks(3_000, 25, spark.sparkContext.defaultParallelism)[0]
    got = K.covariance(rows, shrinkage=0.0)
    sums = got.groupBy("i").agg(F.count("*").alias("n"), F.sum("cov").alias("s"), F.sum(F.col("cov") * F.col("j")).alias("by_j"), F.min("n").alias("least")).collect()
    cov = np.cov(x.T)
    assert len(sums) == 3_000 and groups >= 3
    for r in sums:
        assert (r["n"], r["least"]) == (3_000, 25)
        assert r["s"] == pytest.approx(cov[r["i"]].sum()) and r["by_j"] == pytest.approx(cov[r["i"]] @ np.arange(3_000))


def _gaps() -> list[tuple]:
    rng = np.random.default_rng(8)
    x = rng.normal(size=(70, 11)) + rng.normal(size=(70, 1))
    x[rng.random(x.shape) < 0.4] = np.nan
    return [(t, f"n{i}", float(x[t, i])) for t in range(70) for i in range(11) if x[t, i] == x[t, i]]


@pytest.mark.parametrize("blocks", [None, (4, 6, 2), (1, 1, 1)])
def test_book_variance_is_that_of_the_covariances(spark, blocks):
    from tidemark.operators import select as K

    rets = spark.createDataFrame(_gaps(), "ts int, ticker string, ret double")
    books = [(b, "x" if b % 2 else "y", f"n{i}", float((i * 7 + b) % 5 - 1)) for b in range(5) for i in range(12) if b != 3 or i == 11]
    w = spark.createDataFrame([*books, (9, None, "n1", 1.0), (0, "y", "n3", 0.5)], "b int, kind string, ticker string, weight double")
    cov = K.covariance(rets, least=22)
    want = {(r["b"], r["kind"]): r["variance"] for r in K.portfolio_variance(w, cov, ["b", "kind"]).collect()}
    got = {(r["b"], r["kind"]): r["variance"] for r in K.book_variance(w, rets, ["b", "kind"], least=22, blocks=blocks).collect()}
    assert set(got) == set(want) == {(0, "y"), (1, "x"), (2, "y"), (4, "y")}
    assert 11 < cov.count() < 121 and all(got[k] == pytest.approx(want[k]) for k in want)


def test_variances_are_the_diagonal(spark):
    from tidemark.operators import select as K

    rets = spark.createDataFrame(_gaps(), "ts int, ticker string, ret double")
    want = {r["i"]: (r["n"], r["cov"]) for r in K.covariance(rets, least=40).where("i = j").collect()}
    got = {r["i"]: (r["n"], r["cov"]) for r in K.variances(rets, least=40).collect()}
    assert set(got) == set(want) and 0 < len(got) < 11
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in got)


def test_no_pair_of_names_is_exchanged(spark):
    """Returns are stored once by group, not copied to each other group, and pairs stay where they are made."""
    from tidemark.operators import select as K

    rets = spark.createDataFrame(_gaps(), "ts int, ticker string, ret double")
    plan = K.covariance(rets, blocks=(4, 3, 1))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "hashpartitioning(i" not in plan and plan.count("Generate explode") == 1
    weights = rets.select("ticker").distinct().selectExpr("ticker", "1 as k", "0.1 as weight")
    assert "Generate" not in K.book_variance(weights, rets, ["k"], blocks=(4, 3, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in K.variances(rets)._jdf.queryExecution().executedPlan().toString()


def test_names_with_the_same_bars_are_summed(spark, monkeypatch):
    """Where more names than sets have the same bars, blocks get a sum for each set, not the names."""
    from pyspark.sql import functions as F

    from tidemark.operators import select as K

    rng = np.random.default_rng(12)
    x, seen = rng.normal(size=(80, 40)) + rng.normal(size=(80, 1)), rng.random((80, 5)) < 0.6
    seen[:, 3] = np.arange(80) < 30  # few bars: unknown with some
    kind = np.repeat(np.arange(5), (20, 12, 2, 5, 1))
    rets = spark.createDataFrame([(t, i, float(x[t, i])) for t in range(80) for i in range(40) if seen[t, kind[i]]], "ts int, ticker int, ret double")
    w = [(b, i, float((i * 7 + b) % 5 - 1)) for b in range(3) for i in range(40) if b != 2 or kind[i] != 1]
    w = spark.createDataFrame([*w, (0, 0, 2.5), (1, 7, None), (0, 99, 1.0), (4, 99, 1.0)], "b int, ticker int, weight double")
    pairs, met = K._block_pairs, []
    monkeypatch.setattr(K, "_block_pairs", lambda own, *a: (met.append(own), pairs(own, *a))[1])
    want = {r["b"]: r["variance"] for r in K.portfolio_variance(w, K.covariance(rets, least=22), ["b"]).collect()}
    met.clear()
    got = {r["b"]: r["variance"] for r in K.book_variance(w, rets, ["b"], least=22).collect()}
    assert set(got) == set(want) == {0, 1, 2} and all(got[b] == pytest.approx(want[b]) for b in want)
    # four sets: 20, 12 and 5 names become 3, 2 and 3 sums (set 2 has none of the 12, set 4 has no known name), 3 names stay
    assert met[0].select("name").distinct().count() == 3 + 2 + 3 + 3


def test_returns_are_stored_once(spark):
    """Books, variances and covariances of stored returns read their table, not what it was made of."""
    from tidemark.operators import select as K

    rets = K.stored_returns(spark.createDataFrame([*_gaps(), (3, None, 1.0), (4, "n1", None)], "ts int, ticker string, ret double").dropDuplicates(["ts", "ticker"]))
    plans = [K.covariance(rets, blocks=(1, 1, 1)), K.variances(rets)]
    plans = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert all("returns-" in p and "LocalTableScan" not in p and "ExistingRDD" not in p for p in plans)
