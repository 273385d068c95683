"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of equal size. Block i of a source of weight w is
released at slot floor(i / w) and due by ceil((i + 1) / w); of the released blocks the one with the
earliest deadline takes the slot. So after any number of slots each source has had its weight's
share to within less than one block. Weights are exact fractions (a float is the decimal that it
prints as), brought to whole numbers, so that nothing is rounded. Their sum is the period after which
the schedule repeats; of a period longer than there are blocks only the slots that are needed are
made, so the schedule has at most one row for each block, and rows find their slot by a join. Blocks
grow with the table beyond SLOTS of them, so the schedule, which one machine makes in order, doesn't.
When a source has no block left, the others go on with their weights scaled up (a new phase, which
counts its slots and blocks anew), so that no row is dropped or repeated.

Defined cases: a null source is a source of its own; weights of sources that have no rows count for
nothing; a source without a stated weight raises; an empty table gives an empty result; repeated
rows each take a place of their own; texts are not looked at, so empty and very long ones are like
any others; the order inside a source is pseudo-random by doc_id.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked_in_groups, sheltered

#: Documents in a block at least, and blocks of a table (besides one more for each source) at most.
BLOCK, SLOTS = 64, 1 << 20
#: Default weights are a source's share to this power: below 1, small sources come earlier.
TEMPERATURE = 0.7
#: Rows of a schedule that are sent to every task; a longer one is shuffled.
SENT = 500_000
#: Deadlines beyond this are this: no table has so many blocks.
FAR = 1 << 60
#: The columns that mix_sources adds; a caller's columns of these names are replaced.
MADE = ("mix_phase", "mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_place")


def whole_weights(weights: list[float | Fraction]) -> list[int]:
    """Whole numbers in exactly the weights' proportions, without a common divisor."""
    exact = [Fraction(str(w)) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    out = [int(w * scale) for w in exact]
    divisor = math.gcd(*out)
    return [w // divisor for w in out]


def _slots(quota: list[int]) -> Iterator[tuple[int, int, int, int]]:
    period = sum(quota)
    release = lambda s, i: i * period // quota[s]
    due = lambda s, i: -(-(i + 1) * period // quota[s])
    waiting = [(0, s, 0) for s in range(len(quota))]
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, i), s, i))
        deadline, s, i = heapq.heappop(ready)
        yield s, i, release(s, i), deadline
        if i + 1 < quota[s]:
            heapq.heappush(waiting, (release(s, i + 1), s, i + 1))
        slot += 1


def schedule(quota: list[int], slots: int | None = None) -> list[tuple[int, int, int, int]]:
    """Earliest-deadline-first over one period, or its first slots: for each (source, block, release, deadline)."""
    return list(islice(_slots(quota), slots))


def phases(blocks: list[int], weights: list[float | Fraction]) -> list[dict]:
    """The schedule of each phase: sources left, blocks each has had before, slots before, period.

    plan: source, block, release and deadline of each slot of a period, or of the phase if that is
    shorter; quota: how many blocks of each source the plan has.
    """
    done, begun, out = [0] * len(blocks), 0, []
    live = [s for s, n in enumerate(blocks) if n]
    while live:
        quota = whole_weights([weights[s] for s in live])
        # whole periods before any source runs dry, then slot by slot up to the first that does
        whole = min((blocks[s] - done[s]) // q for s, q in zip(live, quota, strict=True))
        left = [blocks[s] - done[s] - whole * q for s, q in zip(live, quota, strict=True)]
        plan, had, length, over = tuple(array("q") for _ in range(4)), [0] * len(live), 0, not all(left)
        for k, i, release, deadline in _slots(quota):
            if over and not whole:
                break
            for column, x in zip(plan, (k, i, release, min(deadline, FAR)), strict=True):
                column.append(x)
            had[k] += 1
            if not over:
                left[k] -= 1
                length += 1
                over = not left[k]
        period = len(plan[0])
        out.append({"live": live, "quota": had, "plan": plan, "done": [done[s] for s in live], "begun": begun, "period": period})
        for k, s in enumerate(live):
            done[s] = blocks[s] - left[k]
        begun += whole * period + length
        live = [s for s in live if done[s] < blocks[s]]
    return out


def mix_sources(df: DataFrame, weights: dict[str | None, float | Fraction] | None = None, source: str = "source", block_rows: int | None = None) -> DataFrame:
    """df's rows with mix_block (of its source), mix_slot, mix_release, mix_deadline, mix_phase, mix_place.

    Sorting by (mix_slot, mix_place) gives the mixed order. weights: by source, the default is each
    source's share of the rows to the power TEMPERATURE. block_rows: BLOCK, or as many as it takes
    to have no more than SLOTS blocks.
    """
    spark = df.sparkSession
    df, columns = sheltered(df.drop(*MADE), "doc_id", source)
    key, rank = "source_no", "rank_in_source"
    # a row for each source: what the schedule is made of
    found = sorted(df.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n")).collect(), key=lambda r: (r["s"] is None, str(r["s"])))
    block_rows = block_rows or max(BLOCK, -(-sum(r["n"] for r in found) // SLOTS))
    share = [weights[r["s"]] if weights is not None else r["n"] ** TEMPERATURE for r in found]
    if any(w <= 0 for w in share):
        raise ValueError("weights must be positive")
    names = spark.createDataFrame([(i, None if r["s"] is None else str(r["s"])) for i, r in enumerate(found)], "no int, s string")
    few = F.broadcast(names) if len(found) <= SENT else names
    numbered = df.join(few.withColumnRenamed("no", key), df[source].cast("string").eqNullSafe(F.col("s")))
    ranked = ranked_in_groups(numbered, key, [F.col("doc_id")], rank)

    # a row for each phase, source and block of a plan; the phase of a block is known by its number
    parts, steps = [], [[] for _ in found]
    for p, x in enumerate(phases([-(-r["n"] // block_rows) for r in found], share)):
        k, i, release, due = (np.frombuffer(c, np.int64) for c in x["plan"])
        parts.append((np.array(x["live"])[k], np.full(len(k), p), i, np.full(len(k), x["period"]), np.full(len(k), x["begun"]), np.arange(len(k)), release, due))
        for s, first, quota in zip(x["live"], x["done"], x["quota"], strict=True):
            if quota:
                steps[s].append((first, p, quota))
    kinds = {"src": "int32", "phase": "int32", "i": "int64", "period": "int64", "begun": "int64", "t": "int64", "rel": "int64", "due": "int64"}
    whole = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0)] * len(kinds)
    template = spark.createDataFrame(pa.table({name: c.astype(kind) for (name, kind), c in zip(kinds.items(), whole, strict=True)}))
    template = F.broadcast(template) if len(whole[0]) <= SENT else template
    bounds = spark.createDataFrame(list(enumerate(steps)), "src int, steps array<struct<first: long, phase: int, quota: long>>")
    block = (F.col(rank) / F.lit(block_rows)).cast("long")
    ph = F.element_at(F.filter("steps", lambda s: s["first"] <= F.col("mix_block")), -1)
    placed = (
        ranked.withColumn("mix_block", block)
        .join((F.broadcast(bounds) if len(found) <= SENT else bounds).withColumnRenamed("src", key), key)
        .withColumn("ph", ph)
        .withColumns({"mix_phase": F.col("ph.phase"), "i": ((F.col("mix_block") - F.col("ph.first")) % F.col("ph.quota")).cast("long"), "turn": ((F.col("mix_block") - F.col("ph.first")) / F.col("ph.quota")).cast("long")})
        .drop("steps", "ph")
        .join(template.withColumnsRenamed({"src": key, "phase": "mix_phase"}), [key, "mix_phase", "i"])
    )
    base = F.col("begun") + F.col("turn") * F.col("period")
    made = {"mix_slot": base + F.col("t"), "mix_release": base + F.col("rel"), "mix_deadline": base + F.col("due"), "mix_place": (F.col(rank) % block_rows).cast("int")}
    return placed.withColumns(made).select(*columns, *MADE)


def mixed(df: DataFrame, weights: dict[str | None, float | Fraction] | None = None) -> DataFrame:
    """df's rows and columns, stored in mixed order: by slot over and within partitions."""
    out = mix_sources(df, weights).repartitionByRange("mix_slot").sortWithinPartitions("mix_slot", "mix_place")
    return out.select(*df.columns)


def stored_order(df: DataFrame, name: str) -> DataFrame:
    """df with a number that grows along its rows as they are stored: by part file and row of a Parquet
    table, else by partition and row."""
    try:
        file = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("long")
        at = F.shiftleft(F.coalesce(file, F.lit(0).cast("long")), 40) + F.col("_metadata.row_index")
        return df.select("*", at.alias(name))
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())


def max_deviation(quota: list[int], slots: int | None = None) -> Fraction:
    """Largest distance, in blocks, between what a source has had and its share, over one period or its first slots."""
    period, had, worst = sum(quota), [0] * len(quota), Fraction(0)
    for t, (s, *_rest) in enumerate(schedule(quota, slots), 1):
        had[s] += 1
        worst = max([worst, *(abs(Fraction(q * t, period) - h) for q, h in zip(quota, had, strict=True))])
    return worst
