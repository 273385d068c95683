"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries of the text digests find the digests that may be frequent; an exact count
verifies them, and their winners are broadcast so that copies are marked where they are read. All
other digests go through an ordinary shuffle by digest, whose groups are small by construction.

Defined cases: a null text counts as empty, empty texts are equal to each other; of equal texts the
one with the most code points stays, then the smallest doc_id (null ids last); of rows that repeat
the same id and length one stays. Very long texts are hashed whole where they are read. An empty table gives an empty result. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, sheltered, written

#: Counters of a Misra-Gries summary. A digest of more than rows / (COUNTERS + 1) rows is never missed:
#: each step that takes c from the COUNTERS + 1 largest counts takes that many rows, so all steps, those
#: of the merge included, take no more than rows / (COUNTERS + 1) from any digest's count.
COUNTERS = 4096


def with_digest(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds text_sha256 of the text without [\\x20\\x09-\\x0D], and its code points as written."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")
    return df.withColumns({"text_sha256": F.sha2(bare.cast("binary"), 256), "text_length": F.length(whole).cast("long")})


def _reduced(counts: pd.Series, counters: int) -> pd.Series:
    """The Misra-Gries step: subtract the (counters+1)-th largest count, keep what is positive."""
    if len(counts) <= counters:
        return counts
    cut = np.partition(counts.to_numpy(), -counters - 1)[-counters - 1]
    left = counts - cut
    return left[left > 0]


def misra_gries(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """One summary of at most `counters` rows for each partition: digest, least count."""

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.Series(dtype="int64")
        for frame in frames:
            held = _reduced(held.add(frame[column].value_counts(), fill_value=0).astype("int64"), counters)
        yield pd.DataFrame({column: held.index.astype(object), "n": held.to_numpy("int64")})

    return digests.select(column).mapInPandas(summarise, f"{column} string, n long")


def heavy_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests with the row that stays; at most `counters` rows.

    digests: doc_id, text_sha256, text_length of every row, cheap to read twice.
    """
    rows = digests.count()
    summed = misra_gries(digests, "text_sha256", counters).groupBy("text_sha256").agg(F.sum("n").alias("n"))
    # The merge: what would be left above the (counters + 1)-th largest sum is among the `counters` largest.
    candidates = summed.orderBy(F.desc("n"), "text_sha256").limit(counters).select("text_sha256")
    best = F.max(F.struct("text_length", F.col("doc_id").isNotNull(), -F.col("doc_id")))
    return (
        digests.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("heavy_size"), best.alias("best"))
        .where((F.col("heavy_size") > F.lit(rows / (counters + 1))) & (F.col("heavy_size") > 1))
        .select("text_sha256", "heavy_size", F.col("best.text_length").alias("heavy_length"), (-F.col("best.col3")).alias("heavy_id"))
    )


def _wins() -> Column:
    return (F.col("text_length") == F.col("heavy_length")) & F.col("doc_id").eqNullSafe(F.col("heavy_id"))


def repeats_a_winner(digests: DataFrame, heavy: DataFrame) -> bool:
    """Whether several rows equal a frequent digest's winner in length and id."""
    equal = digests.join(F.broadcast(heavy), "text_sha256").where(_wins())
    return not equal.groupBy("text_sha256").count().where("count > 1").isEmpty()


def mark_duplicates(df: DataFrame, heavy: DataFrame, repeated: bool = True) -> DataFrame:
    """Adds keep_id, group_size and kept to rows that have text_sha256 and text_length.

    Rows of a frequent digest are marked where they are read. Those that equal its winner in length
    and id are told apart in two steps, first within what each task has read; where it is known that
    there are no such repeated rows, all are marked in one reading.
    """
    place, part = fresh(df, "place"), fresh(df, "part")
    joined = df.join(F.broadcast(heavy), "text_sha256", "left")
    frequent = F.col("heavy_size").isNotNull()
    known = {"keep_id": F.col("heavy_id"), "group_size": F.col("heavy_size")}
    at_once = joined.where(frequent & ~_wins()).withColumns({**known, "kept": F.lit(False)})
    same = Window.partitionBy("text_sha256")
    ordered = same.orderBy(F.desc("text_length"), F.asc_nulls_last("doc_id"))
    rest = joined.where(~frequent if repeated else ~frequent | _wins()).withColumn(place, F.row_number().over(ordered))
    size = F.count(F.lit(1)).over(same)
    rest = rest.withColumns({"keep_id": F.first("doc_id").over(ordered), "group_size": size if repeated else F.coalesce("heavy_size", size), "kept": F.col(place) == 1}).drop(place)
    out = at_once.unionByName(rest)
    if not repeated:
        return out.drop("heavy_size", "heavy_length", "heavy_id")
    equal = joined.where(frequent & _wins()).withColumn(part, F.spark_partition_id())
    equal = equal.withColumn(place, F.row_number().over(Window.partitionBy("text_sha256", part).orderBy("text_length")))
    first = equal.where(F.col(place) == 1)
    first = first.withColumn(place, F.row_number().over(Window.partitionBy("text_sha256").orderBy(part)))
    equal = equal.where(F.col(place) > 1).unionByName(first.withColumn(place, F.when(F.col(place) == 1, 1).otherwise(2)))
    equal = equal.withColumns({**known, "kept": F.col(place) == 1}).drop(part, place)
    return out.unionByName(equal).drop("heavy_size", "heavy_length", "heavy_id")


def exact_dedup(df: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """df's rows that stay, with df's columns; texts cross the network once, frequent copies never."""
    own, columns = sheltered(df, "doc_id", "text")
    d = with_digest(own)
    narrow = written(d.select("doc_id", "text_sha256", "text_length"))
    heavy = written(heavy_winners(narrow, counters))
    kept = mark_duplicates(d, heavy, repeats_a_winner(narrow, heavy)).where("kept")
    return kept.select(*columns)


def exact_dedup_report(df: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = written(with_digest(df.select("doc_id", "text")).select("doc_id", "text_sha256", "text_length"))
    marked = mark_duplicates(narrow, written(heavy_winners(narrow, counters)))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
