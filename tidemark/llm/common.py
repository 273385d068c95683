"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.sources.storage import new_path

#: Characters fed to numpy at a time; bounds a Python worker's memory whatever the split size.
BATCH_CHARS = 250_000
#: Rows of an Arrow batch that are turned into pandas at a time (Spark bounds the batch itself in bytes).
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _give_back() -> None:
    """Returns what a task has freed to the system: Python workers live on after it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def map_frames(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """df.mapInPandas(fn, schema), with at most `rows` rows of a batch as pandas objects at a time."""
    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (b.slice(a, rows).to_pandas() for b in batches for a in range(0, b.num_rows, rows))
        for out in fn(frames):
            yield pa.RecordBatch.from_pandas(out, schema=out_schema, preserve_index=False)
        _give_back()

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """What is run inside hands Python workers `rows` rows at a time; the session's setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, "part")
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, mod modulus, is the remainder (null ids count as not held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == remainder, F.lit(False))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have yet, so that callers' extra columns never clash."""
    have = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in have:
        name = f"_{name}"
    return name


def sheltered(df: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """df with every column but the used ones under a name that can't clash, and columns that undo it."""
    names = {c: c if c in used else f"__own_{i}" for i, c in enumerate(df.columns)}
    return df.select(*(F.col(f"`{c}`").alias(names[c]) for c in df.columns)), [F.col(names[c]).alias(c) for c in df.columns]


def ranked_in_groups(df: DataFrame, group: str, order: list[Column], rank: str, rows_per_bucket: int = 2_000, bucket: Column | None = None) -> DataFrame:
    """Adds a dense 0-based rank of each row within its group, however large one group is.

    Rows are dealt by (group, bucket); each bucket is ranked by itself and shifted by the rows in the
    group's earlier buckets. bucket: a number that grows with the order, of few rows each. Without
    one the order inside a group is pseudo-random by hash of the order columns, then the order
    columns; rows whose order columns are all null are dealt by where they are read. group must not
    be null.
    """
    h, b, off = (fresh(df, x) for x in ("hash", "bucket", "before"))
    if bucket is None:
        n = max(1, df.select(group).count())
        buckets = max(1, -(-n // rows_per_bucket))
        nothing = F.forall(F.array(*(x.cast("string") for x in order)), lambda x: x.isNull())
        df = df.withColumn(h, F.when(nothing, F.xxhash64(F.spark_partition_id())).otherwise(F.xxhash64(*order)))
        df = df.withColumn(b, F.shiftrightunsigned(h, 1) % F.lit(buckets))
        order = [F.col(h), *order]
    else:
        df = df.withColumn(b, bucket)
    sizes = df.groupBy(group, b).agg(F.count("*").alias(off))
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, b, F.coalesce(F.sum(off).over(before), F.lit(0)).alias(off))
    inside = Window.partitionBy(group, b).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(inside) - 1)
    return ranked.join(offsets, [group, b]).withColumn(rank, (F.col(rank) + F.col(off)).cast("long")).drop(h, b, off)


def chunks(frames: Iterator[pd.DataFrame], text: str, most: int = BATCH_CHARS) -> Iterator[pd.DataFrame]:
    """Cuts frames into runs of whole rows of about `most` characters."""
    for frame in frames:
        if not len(frame):
            continue
        ends = frame[text].str.len().fillna(0).to_numpy(np.int64).cumsum()
        cuts = np.flatnonzero(np.diff(ends // most)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(frame)], strict=True):
            yield frame.iloc[a:b]


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of frames sorted by keys, one at a time."""
    held: list[pd.DataFrame] = []
    for f in frames:
        if not len(f):
            continue
        if held:
            f = pd.concat([*held, f], ignore_index=True)
        new = np.zeros(len(f), bool)
        for k in keys:
            x = f[k].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(new)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield f.iloc[a:b]
        held = [f.iloc[cuts[-1] :]]
    if held:
        yield held[0]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of characters other than space and \\x09-\\x0D, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
