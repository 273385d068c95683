"""N-gram Jaccard self-join with Bayesian candidate pruning, and near deduplication on top of it.

A document is its set of five-word shingles. Texts of one set are one class of copies and go on as
a single representative. MinHash bands give candidates: bands and rows are chosen so that a pair at
the threshold is missed with a probability of some 3e-6. In each band's buckets MinHash values are
compared a few at a time, and a pair is dropped once the posterior probability (uniform prior) that
its similarity reaches the threshold is below TOLERANCE. The shingle sets of what is left are
compared exactly. A pair is looked at only in the first band that it shares. Buckets of any size are
cut into blocks, one task's work is two blocks, and only per-document link counts and a spanning
forest leave it, never all pairs.

Defined cases: words are lower-cased (A-Z) runs of characters other than space and \\x09-\\x0D; a
text of one to four words has one shingle, all of it; texts without words (and null texts) have no
shingles, are linked to nothing and are all kept. Links count copies. Of a class the smallest doc_id
stays (null ids last; repeated rows stay once). A very long text is one row's work; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_frames, sheltered, whole_groups, words_of, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: MinHash values compared between two looks at the posterior.
STEP = 16
TOLERANCE = 1e-7
#: Representatives of a bucket in a block.
BLOCK = 256
#: Keys that a node's neighbours are dealt over where components() joins by node.
PARTS = 16
#: Bits of the filters that spare most texts a second reading: at least, at most, and for each id.
FILTER_BITS, MOST_BITS, BITS_AN_ID = 1 << 23, 1 << 30, 16

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    h = w[:n].copy()
    for k in range(1, SHINGLE):
        h *= _PRIME
        h += w[k : k + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


@cache
def _family() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20_240_229)
    a, b = r.integers(0, 1 << 32, (2, BANDS * ROWS), dtype=np.uint32) | np.uint32(1)
    return a, b


def minhash(h: np.ndarray) -> np.ndarray:
    """BANDS * ROWS least values of a non-empty set under as many hash functions."""
    a, b = _family()
    lo, hi = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), 512):
        np.minimum(out, (lo[k : k + 512, None] * a + hi[k : k + 512, None] * b).min(axis=0), out=out)
    return out


def _digest(h: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(h.tobytes())


def sketches(df: DataFrame) -> DataFrame:
    """doc_id, digest of the shingle set, its size, its MinHash values as bytes; of every row."""
    key = df.schema["doc_id"].dataType.simpleString()

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = map(shingles, f["text"])
            made = [(_digest(h), len(h), minhash(h).tobytes() if len(h) else b"") for h in sets]
            d, n, s = zip(*made, strict=True) if made else ((), (), ())
            yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy(object), "digest": d, "size": np.array(n, np.int32), "sig": s})

    safe = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = map_frames(safe, sketch, "doc_id string, digest binary, size int, sig binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(key))


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n values: the fewest matches with which a pair is worth another look."""
    out = {}
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance and m < n:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _survivors(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the group's two blocks, and which of their pairs (left by right) are worth comparing."""
    i, j = g["i"].iloc[0], g["j"].iloc[0]
    block, band = g["block"].to_numpy(), int(g["band"].iloc[0])
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    sig = np.frombuffer(b"".join(g["sig"]), np.uint32).reshape(len(g), -1)
    size = g["size"].to_numpy(np.int64)
    a, b = sig[left], sig[right]
    small, large = np.minimum(size[left][:, None], size[right]), np.maximum(size[left][:, None], size[right])
    alive = small >= THRESHOLD * large - 1e-9
    if i == j:
        alive &= np.triu(np.ones_like(alive), 1)
    for k in range(band + 1):  # the first shared band is this one
        if not alive.any():
            return left, right, alive
        same = alive.copy()
        for x in range(k * ROWS, (k + 1) * ROWS):
            same &= a[:, x][:, None] == b[:, x]
        alive = same if k == band else alive & ~same
    matches = np.zeros(alive.shape, np.int16)
    for n, least in least_matches().items():
        if not alive.any():
            break
        for x in range(n - STEP, n):
            matches += a[:, x][:, None] == b[:, x]
        alive &= matches >= least
    return left, right, alive


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Which of the pairs have exact similarity of at least the threshold."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        both = np.intersect1d(*sets, assume_unique=True).size
        common = np.full(alive.shape, both, np.int64)
    else:
        flat = np.concatenate(sets)
        who = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(flat, kind="stable")
        flat, who = flat[order], who[order]
        new = np.concatenate([[True], flat[1:] != flat[:-1]])
        column = np.cumsum(new) - 1
        shared = np.bincount(column)[column] > 1
        column, who = column[shared], who[shared]
        column = np.unique(column, return_inverse=True)[1] if len(column) else column
        common = np.zeros(alive.shape, np.float64)
        for c in range(0, int(column.max(initial=-1)) + 1, 4096):
            part = slice(*np.searchsorted(column, [c, c + 4096]))
            x = np.zeros((len(sets), 4096), np.float32)
            x[who[part], column[part] - c] = 1
            common += x[left] @ x[right].T
    return alive & (common >= THRESHOLD * (size[left][:, None] + size[right] - common) - 1e-9)


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The least row that each row of the group is connected with."""
    label = np.arange(n)
    while True:
        was = label.copy()
        np.minimum.at(label, left, np.where(links, label[right], n).min(axis=1, initial=n))
        np.minimum.at(label, right, np.where(links, label[left][:, None], n).min(axis=0, initial=n))
        label = label[label]
        if (label == was).all():
            return label


def _blocks(candidates: DataFrame) -> DataFrame:
    """A row for each pair of blocks that a representative takes part in, sorted by (key, i, j)."""
    parts = F.ceil(F.col("bucket_size") / F.lit(BLOCK)).cast("int")
    dealt = (
        candidates.withColumn("parts", parts)
        .withColumn("block", (F.shiftrightunsigned(F.xxhash64("digest"), 1) % F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    return dealt.drop("parts", "other", "bucket_size")


def _grouped(df: DataFrame) -> DataFrame:
    return df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "digest")


def _worth_comparing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[pd.DataFrame] = []
    for g in whole_groups(frames, ["key", "i", "j"]):
        left, right, alive = _survivors(g)
        rows = np.union1d(left[alive.any(axis=1)], right[alive.any(axis=0)])
        if len(rows):
            out.append(g.iloc[rows])
        if len(out) >= 500:
            yield pd.concat(out)
            out = []
    if out:
        yield pd.concat(out)


def _compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for g in whole_groups(frames, ["key", "i", "j"]):
        g = g.loc[~g["digest"].duplicated()].reset_index(drop=True)
        left, right, alive = _survivors(g)
        links = _linked([np.frombuffer(x, np.uint64) for x in g["shingles"]], left, right, alive)
        weight, digest = g["copies"].to_numpy(np.int64), g["digest"].to_numpy()
        count = np.zeros(len(g), np.int64)
        np.add.at(count, left, links @ weight[right])
        np.add.at(count, right, links.T @ weight[left])
        root = _forest(links, left, right, len(g))
        some = np.flatnonzero(count)
        out += zip(digest[some], count[some], digest[root[some]], strict=True)
        if len(out) >= 5000:
            yield pd.DataFrame(out, columns=["digest", "links", "root"])
            out = []
    yield pd.DataFrame(out, columns=["digest", "links", "root"])


def filter_bits(ids: int) -> int:
    """Bits for a filter of so many ids: a sixteenth of the other ids pass at most, until MOST_BITS are reached."""
    return min(MOST_BITS, max(FILTER_BITS, 1 << (BITS_AN_ID * ids).bit_length()))


def bitmap(ids: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A set of hashed ids: false alarms, no misses."""
    rows = (
        ids.select((_position(column, bits) + 1).alias("at"))  # Spark's buckets and bits begin with the number 1
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()  # at most bits / 32768 rows of 4 KB
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * 4096 :][: len(part)] = part
    return out


def _position(column: str, bits: int = FILTER_BITS) -> Column:
    """The bit of bitmap() that stands for the id."""
    return (F.shiftrightunsigned(F.xxhash64(F.col(column).cast("string")), 1) % F.lit(bits)).cast("long")


def _in_bitmap(at: np.ndarray, held: np.ndarray) -> np.ndarray:
    at = at.astype(np.int64)
    return (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _beside_least(near: DataFrame, low: DataFrame) -> DataFrame:
    """near (u, v) with low's m of u. A node with very many neighbours is PARTS keys, not one."""
    near = near.withColumn("part", (F.shiftrightunsigned(F.xxhash64("v"), 1) % F.lit(PARTS)).cast("int"))
    return near.join(low.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), ["u", "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node it is connected with) of an undirected graph (u, v), by alternating
    large-star and small-star steps until nothing changes; a few rounds whatever the graph's shape."""
    both = lambda e: e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    state = None
    edges = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        near = both(edges)
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _beside_least(near.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _beside_least(large, low).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def similarity_classes(df: DataFrame) -> DataFrame:
    """doc_id, digest, class_id, n_links of every row of df (doc_id, text)."""
    df = df.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = written(sketches(df))
    classes = written(rows.where("size > 0").groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("sig").alias("sig")))

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substr("sig", k * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    keys = classes.select("digest", F.posexplode(bands).alias("band", "key"))
    full = keys.groupBy("key").agg(F.count("*").alias("bucket_size")).where("bucket_size > 1")
    candidates = keys.join(full, "key").join(classes.select("digest", "copies", "size", "sig"), "digest")
    columns = "key long, i int, j int, block int, band int, digest binary, copies long, size int, sig binary"
    dealt = _grouped(_blocks(candidates).select(*(c.split()[0] for c in columns.split(", "))))
    worth = written(map_frames(dealt, _worth_comparing, columns))

    reps = worth.select("digest").distinct().join(classes.select("digest", "rep"), "digest")
    bits = filter_bits(reps.count())
    held = df.sparkSession.sparkContext.broadcast(bitmap(reps, "rep", bits))

    def again(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f[_in_bitmap(f["at"].to_numpy(), held.value)]
            sets = [h for h in map(shingles, f["text"]) if len(h)]
            yield pd.DataFrame({"digest": [_digest(h) for h in sets], "shingles": [h.tobytes() for h in sets]})

    # copies have equal sets: of the rows that pass the filter one for each digest is joined
    found = map_frames(df.select(_position("doc_id", bits).alias("at"), "text"), again, "digest binary, shingles binary").dropDuplicates(["digest"])
    verified = map_frames(_grouped(worth.join(found, "digest")), _compared, "digest binary, links long, root binary")
    links = written(verified)

    roots = components(links.select(F.col("digest").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("digest").agg(F.sum("links").alias("links"))
    known = classes.select("digest", "copies", "rep").join(counts, "digest", "left").join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    known = known.withColumn("root", F.coalesce("root", "digest"))
    first = known.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "digest")).alias("first"))
    known = known.join(first, "root").select(
        "digest", F.col("first.rep").alias("class_id"), (F.col("first.digest") == F.col("digest")).alias("stays"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    wordless = F.col("size") == 0
    return rows.select("doc_id", "digest", "size").join(known, "digest", "left").select(
        "doc_id",
        "digest",
        F.when(wordless, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (wordless | F.col("stays") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )


def near_dedup_report(df: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), n_links, kept; one row per row of df."""
    return similarity_classes(df).select("doc_id", "class_id", "n_links", "kept")


def near_dedup(df: DataFrame) -> DataFrame:
    """df's rows of which one of each class stays, with df's columns.

    Only rows whose id is that of a row that goes, or repeats, are told apart by their text.
    """
    own, columns = sheltered(df, "doc_id", "text")
    report = written(similarity_classes(own).select("doc_id", "digest", "kept"))
    by_id = report.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and("kept").alias("all_kept"))
    doubted = by_id.where("n > 1 or not all_kept")
    bits = filter_bits(doubted.count())
    held = own.sparkSession.sparkContext.broadcast(bitmap(doubted, "doc_id", bits))

    @F.pandas_udf("boolean")
    def doubtful(at: pd.Series) -> pd.Series:
        return pd.Series(_in_bitmap(at.to_numpy(), held.value))

    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([_digest(shingles(t)) for t in texts])

    marked = own.withColumn("doubt", doubtful(_position("doc_id", bits)))
    stay = report.where("kept").select(F.col("doc_id").alias("stay_id"), F.col("digest").alias("stay_digest")).distinct()
    unsure = written(marked.where("doubt").withColumn("digest", digest("text")))
    unsure = unsure.join(stay, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("digest") == F.col("stay_digest")), "left_semi")
    once = Window.partitionBy("doc_id", "digest").orderBy("text")
    unsure = unsure.withColumn("place", F.row_number().over(once)).where("place = 1").drop("digest", "place")
    return marked.where(~F.col("doubt")).unionByName(unsure).select(*columns)
