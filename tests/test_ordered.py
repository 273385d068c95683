"""Ranks and running minima carried from part to part."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered as R
from tidemark.operators import stats as S


def step_up(ps):
    """Adjusted p-values by the definition."""
    n, order = len(ps), sorted(range(len(ps)), key=lambda i: ps[i])
    out, least = [0.0] * n, 1.0
    for k in range(n, 0, -1):
        least = min(least, ps[order[k - 1]] * n / k)
        out[order[k - 1]] = least
    return out


@pytest.fixture
def many_parts(spark):
    """Ranges are cut into as many parts as there are partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 13
    for k, v in before.items():
        spark.conf.set(k, v)


def test_false_discovery_over_many_parts(spark, many_parts):
    rng = np.random.default_rng(1)
    families = {"hot": rng.random(3000) ** 3, "ties": rng.integers(0, 4, 500) / 10.0, "one": np.array([0.03]), None: rng.random(40)}
    rows = [(f, i, float(p), 0) for f, ps in families.items() for i, p in enumerate(ps)]
    odd = [("hot", 9_000, None, 0), ("hot", 9_001, math.nan, 0), ("none", 9_002, None, 0)]
    df = spark.createDataFrame(rows + odd, "family string, pos long, p double, __size long").repartition(5)
    out = S.benjamini_hochberg(df, ["family"])
    assert out.columns == [*df.columns, "adjusted", "reject"]
    got = {(r["family"], r["pos"]): r for r in out.collect()}
    assert len(got) == len(rows) + 3
    for f, ps in families.items():
        for i, a in enumerate(step_up(ps.tolist())):
            assert got[f, i]["adjusted"] == pytest.approx(a) and got[f, i]["reject"] == (got[f, i]["adjusted"] <= 0.05)
    assert all(got[f, i]["adjusted"] is None and not got[f, i]["reject"] for f, i, _, _ in odd)
    whole = S.benjamini_hochberg(df.where("family = 'hot' and pos < 3000"), []).collect()
    assert {r["pos"]: pytest.approx(r["adjusted"]) for r in whole} == dict(enumerate(step_up(families["hot"].tolist())))
    assert S.benjamini_hochberg(df.limit(0), ["family"]).count() == 0


def test_one_group_is_many_equal_parts(spark, many_parts):
    df = spark.range(20_000).select(F.lit("all").alias("g"), F.lit(0.5).alias("x"), "id")  # all tie
    parts = R.laid_out(df, ["g"], ["x"])
    sizes = [r["count"] for r in parts.groupBy(R.PART).count().collect()]
    assert len(sizes) == many_parts and max(sizes) < 2 * 20_000 / many_parts
    got = R.ranked(parts, "rank", "n")
    assert got.select("rank").distinct().count() == 20_000 and got.agg(F.min("rank"), F.max("rank"), F.min("n"), F.max("n")).first()[:] == (0, 19_999, 20_000, 20_000)
