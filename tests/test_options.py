"""Contracts of chains."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import options as O


def test_the_best_contract_of_a_large_group_is_not_sorted_for_in_one_task(spark):
    first = dt.date(2024, 1, 1)
    chain = spark.range(4_000).coalesce(1).select(F.lit("u").alias("underlying"), F.lit(first).alias("ts"), F.date_add(F.lit(first), (20 + F.col("id") % 2 * 20).cast("int")).alias("expiration"), (F.col("id") % 997 + 1).cast("double").alias("strike"), F.when(F.col("id") < 2_000, "put").otherwise("call").alias("option_type"), F.lit(500.5).alias("spot"), (F.col("id") / 1e4).alias("iv"))
    best = O.best_of(chain, ["underlying", "ts", "expiration"], [F.abs(F.col("strike") - F.col("spot")), "strike", "option_type", "iv"])
    ids = lambda parity: [i for i in range(4_000) if i % 2 == parity]
    want = {min(ids(p), key=lambda i: (abs(i % 997 + 1 - 500.5), i % 997 + 1, "put" if i < 2_000 else "call", i)) for p in (0, 1)}
    assert {round(r["iv"] * 1e4) for r in best.collect()} == want
    for out in (O.implied_volatility(chain), O.select_leg(chain, O.Leg("call", "long", 10, 50, 1.0))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("REPARTITION_BY_COL") :]
        assert "strike" in plan and "Sort" not in below and "Window" not in below
