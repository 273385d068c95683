"""Sweeps that share their ranking."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import select as K


def test_limits_share_one_ranking(spark):
    rng = np.random.default_rng(4)
    rows = [(t, i, float(v), 7) for t in range(30) for i, v in enumerate(rng.integers(0, 6, 12))] + [(0, 99, None, 7), (31, 1, None, 7)]
    df = spark.createDataFrame(rows, "ts int, ticker int, roc double, other int")
    genes = {"top": [1, 3, 20], "mode": ["a", "b"]}
    for direction in ("Highest", "Lowest"):
        got = E.by_limit(df, "roc", E.combinations(genes), "top", direction)
        want = K.select_top(E.over(df, E.grid(spark, genes)), "roc", F.col("top"), direction, keys=["param_id"])
        assert sorted(got.select(want.columns).collect()) == sorted(want.collect()) and got.count() == 2 * 30 * (1 + 3 + 12)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Join" not in plan


def test_a_sweep_reads_its_panel_once(spark):
    """The bars and indicators are computed once, not for each book, the returns and the calendar."""
    import __spark_entry__ as entry

    for name in ("ev20_gene_allocation_policy", "ev15_gene_deployment_pct", "ev9_gene_exit_condition"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" not in plan and "l_suppkey" not in plan
