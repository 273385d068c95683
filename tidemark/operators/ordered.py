"""Rows of a table in order, dealt to parts of equal size: what a group's rows need of those before them
is carried over from part to part, so that no task holds or sorts a whole group.

A group may be all rows. The parts come from a range partitioning by (group, order), so they are as
equal as its sample makes them, whatever the groups; rows that tie are dealt to several parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.storage import written

#: Columns that laid_out() adds: the group, the part, the place in the part.
GROUP, PART, PLACE = "__group", "__part", "__place"


def laid_out(df: DataFrame, group: list[str], order: list[str | Column]) -> DataFrame:
    """df as a written table, sorted within parts that follow each other by (group, order)."""
    tie, at = "__tie", "__at"
    keyed = df.withColumns({GROUP: F.struct(*group) if group else F.struct(F.lit(0)), tie: F.rand(17)})
    by = [*group, *order, tie]
    placed = keyed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(at, F.monotonically_increasing_id())
    # the number's high bits are the partition's, the low ones count its rows
    placed = placed.withColumns({PART: F.shiftright(at, 33).cast("int"), PLACE: F.col(at).bitwiseAND(F.lit((1 << 33) - 1))})
    return written(placed.drop(tie, at), "ordered")


def ranks(parts: DataFrame) -> DataFrame:
    """GROUP, PART, __size (rows of the group in the part), __first (their least place), __before (rows of
    the group in earlier parts), __all (in all parts): what makes places into ranks of the group."""
    sizes = parts.groupBy(GROUP, PART).agg(F.count("*").alias("__size"), F.min(PLACE).alias("__first"))
    w = Window.partitionBy(GROUP)
    before = F.sum("__size").over(w.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumns({"__before": F.coalesce(before, F.lit(0)), "__all": F.sum("__size").over(w)})


def ranked(parts: DataFrame, rank: str, size: str) -> DataFrame:
    """Adds each row's rank in its group, from 0, and the group's rows; the rows don't move."""
    known = ranks(parts).select(GROUP, PART, (F.col("__before") - F.col("__first")).alias("__shift"), F.col("__all").alias(size))
    return parts.join(known, [GROUP, PART]).withColumn(rank, F.col(PLACE) + F.col("__shift")).drop("__shift")


def least_from_here(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Adds the least value of a row and all later ones of its group: within its part, then over later parts."""
    inside = Window.partitionBy(GROUP, PART).orderBy(F.desc(PLACE)).rowsBetween(Window.unboundedPreceding, 0)
    w = Window.partitionBy(GROUP).orderBy(F.desc(PART)).rowsBetween(Window.unboundedPreceding, -1)
    later = rows.groupBy(GROUP, PART).agg(F.min(value).alias("__later")).withColumn("__later", F.min("__later").over(w))
    return rows.withColumn(out, F.min(value).over(inside)).join(later, [GROUP, PART]).withColumn(out, F.least(out, "__later")).drop("__later")


#: Rows of a group that a task works on together, besides those that it needs of its neighbours.
CHUNK_ROWS = 1 << 18


def in_chunks(rows: DataFrame, rank: str, size: str, before: Column | int = 0, after: Column | int = 0, circular: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """rows of ranked() dealt to chunks of chunk_rows neighbours, the last one of up to twice as many: adds
    __first and __until, the chunk's own places, and __pos, the row's.

    A chunk also gets the `before` rows that precede it and the `after` rows that follow it (chunk_rows
    at most each); circular: after a group's last row come its first ones, with places from its size on.
    """
    i, n = F.col(rank), F.col(size)
    last = F.greatest(F.floor(n / chunk_rows) - 1, F.lit(0))
    own = F.least(F.floor(i / chunk_rows), last)
    at = lambda chunk, pos: F.struct(chunk.cast("long").alias("chunk"), pos.cast("long").alias("pos"))
    places = [at(own, i), F.when((own < last) & (i >= (own + 1) * chunk_rows - before), at(own + 1, i)), F.when((own > 0) & (i - own * chunk_rows < after), at(own - 1, i))]
    if circular:
        places.append(F.when(i < after, at(last, i + n)))
    dealt = rows.withColumn("__to", F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())))
    first = F.col("__to.chunk") * chunk_rows
    until = F.when(F.col("__to.chunk") == last, n).otherwise(first + chunk_rows)
    return dealt.withColumns({"__first": first, "__until": until.cast("long"), "__pos": F.col("__to.pos")}).drop("__to")


def bare(df: DataFrame) -> DataFrame:
    return df.drop(GROUP, PART, PLACE)
