"""Running sums and as-of lookups by spans of time equal those over whole histories."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof as A


def tables(spark):
    rng = np.random.default_rng(3)
    at = lambda: dt.datetime(2020, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 400)))
    keys = ["a", "a", "a", "b", None]
    left = [(keys[i % 5], at() if i % 31 else None, i) for i in range(400)]
    right = [(keys[i % 5], at() if i % 29 else None, float(i) if i % 7 else None, i % 3) for i in range(300)]
    right += [(k, t, 1000.0, 1) for k, t, _ in left[:40]]  # at the very time of a left row
    return spark.createDataFrame(left, "k string, t timestamp, no int"), spark.createDataFrame(right, "k string, at timestamp, v double, w int")


def test_running_sums_by_spans(spark):
    left, right = tables(spark)
    totals = {"s": F.col("v"), "n": F.col("w")}
    whole = {r["no"]: r for r in A.running(left, right, ["k"], "t", "at", totals).collect()}
    events = right.where("at is not null").collect()
    for no, r in list(whole.items())[::7]:
        mine = [e for e in events if e["k"] == r["k"] and r["t"] is not None and e["at"] <= r["t"]]
        assert r["n"] == sum(e["w"] for e in mine) and r["s"] == pytest.approx(sum(e["v"] or 0 for e in mine))
    for span in ("month", "day", "year"):
        got = A.running(left, right, ["k"], "t", "at", totals, span=span)
        assert got.columns == ["k", "t", "no", "s", "n"]
        rows = {r["no"]: r for r in got.collect()}
        assert rows.keys() == whole.keys() and all(rows[i]["n"] == whole[i]["n"] and rows[i]["s"] == pytest.approx(whole[i]["s"]) for i in rows)
    with pytest.raises(ValueError, match="span"):
        A.running(left, right, ["k"], "t", "at", totals, seconds=5, span="day")


@pytest.mark.parametrize("forward", [False, True])
def test_lookups_by_spans(spark, forward):
    left, right = tables(spark)
    values = {"v": F.col("v"), "w": F.col("w")}
    whole, *others = (sorted(map(tuple, A.asof(left, right, ["k"], "t", "at", values, "found", forward, span).collect()), key=str) for span in (None, "month", "day"))
    assert all(o == whole for o in others) and len(whole) == 400


@pytest.mark.parametrize("forward", [False, True])
def test_only_right_rows_are_sorted_for_what_is_carried(spark, forward):
    left, right = tables(spark)
    out = A.asof(left, right, ["k"], "t", "at", {"v": F.col("v")}, "found", forward, "month")
    plan = out._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString()
    # left rows are grouped only to tell which spans there are, which needs no sort
    sorted_for = [line for line in plan.toString().splitlines() if "Aggregate" in line and "max(" in line]
    assert len(sorted_for) == 1 and "Union" not in plan.toString().split(sorted_for[0])[1]


def test_spans_without_right_rows_and_the_first_one(spark):
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    left = spark.createDataFrame([("a", day(n), n) for n in (0, 5, 40, 100, 400, 1000)] + [("b", day(7), 7), ("b", None, -1)], "k string, t timestamp, no int")
    right = spark.createDataFrame([("a", day(5), 1.0), ("a", day(50), 2.0), ("a", day(450), None), ("c", day(0), 9.0)], "k string, at timestamp, v double")
    for forward, want in ((False, [None, None, 1.0, None, 1.0, 2.0, 2.0, None]), (True, [None, 1.0, 1.0, None, 2.0, None, None, None])):
        for span in (None, "day", "month", "year"):
            got = A.asof(left, right, ["k"], "t", "at", {"v": F.col("v")}, "found", forward, span).orderBy("no").collect()
            assert [(r["no"], r["v"]) for r in got] == list(zip((-1, 0, 5, 7, 40, 100, 400, 1000), want, strict=True))
