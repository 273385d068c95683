"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component, so that the largest inner product is the smallest distance. A
bounded sample is split in halves by balanced two-means until the parts are small; their means are
the lists' centroids, linked into a graph with their neighbours that lives in each task's memory.
Every row is indexed: it goes to its nearest centroid's list, and to those of other centroids that
are nearly as near (boundary vectors), the nearest REPLICAS at most. A query finds its nearest
centroids through the graph, as far as a ratio of its nearest centroid's distance, and reads those
lists, ranking all their vectors exactly. Where rows are so many that lists are long, each list is
split the same way into cells, on a bounded sample of its own, and queries read the cells within the
ratio. Lists and cells are stored in pages of bounded size, so that one crowded by equal vectors is
many tasks' work; a page's queries pass by in blocks.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; a query's own row (same vec_id) is no candidate; rows that repeat a vec_id
count once, with the smallest of their usable vectors, and ask if one of them asks; ties go to the
smaller vec_id; queries with fewer than k candidates get all of them; extra columns and texts are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rows of the sample that the lists are fitted on, about; every row is indexed.
SAMPLE = 20_000
#: Rows in a list, about, and lists at most (the sample must fill them).
LIST_ROWS, MOST_LISTS = 512, SAMPLE // 16
#: Lists that hold a vector at most, and how much further than the nearest they may be.
REPLICAS, BOUNDARY = 2, 1.05
#: Lists are read up to this times the nearest centroid's distance.
RATIO = 1.1
#: Vectors in a page of a cell; lists of more are split into cells of CELL_ROWS, about, MOST_CELLS at most.
PAGE, CELL_ROWS, MOST_CELLS = 2048, 1024, 1024
#: Rows of a list's sample for each of its cells, and rows of a list that get their cells together.
CELL_SAMPLE, TOGETHER = 16, 32_768
#: Lists and cells whose number of pages is sent to every task; that of more is joined.
SENT = 100_000
#: Neighbours of a centroid in the graph.
DEGREE = 24


Lift = Callable[[np.ndarray], np.ndarray]


def fit_lists(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of balanced parts of x: halved by two-means at the median, largest part first."""
    rng, parts = np.random.default_rng(seed), [np.arange(len(x))]
    while len(parts) < lists:
        k = max(range(len(parts)), key=lambda i: len(parts[i]))
        rows = parts.pop(k)
        if len(rows) < 2:
            parts.append(rows)
            break
        y = x[rows]
        a, b = y[rng.choice(len(y), 2, replace=False)]
        for _ in range(6):
            first = np.zeros(len(y), bool)
            first[np.argsort(y @ (a - b), kind="stable")[len(y) // 2 :]] = True
            a, b = y[first].mean(axis=0), y[~first].mean(axis=0)
        parts += [rows[first], rows[~first]]
    return np.stack([x[p].mean(axis=0) for p in parts])


class CentroidGraph:
    """Centroids and, for each, its DEGREE nearest ones and those that have it among theirs."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE) -> None:
        self.c, n = centroids, len(centroids)
        self.norm = (centroids**2).sum(axis=1)
        near = np.argsort(self.norm[:, None] + self.norm - 2 * centroids @ centroids.T, axis=1, kind="stable")[:, 1 : degree + 1]
        links = [set(map(int, r)) for r in near]
        for a, row in enumerate(near):
            for b in row:
                if len(links[b]) < 2 * degree:
                    links[b].add(a)
        width = max([1, *map(len, links)])
        self.near = np.array([[*s, *[i] * (width - len(s))] for i, s in enumerate(links)], np.int64).reshape(n, width)
        self.entry = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))

    def search(self, q: np.ndarray, most: int, reach: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Best-first from a few entries: each row's centroids found, nearest first, and their distances.

        It stops at a centroid that is neither among the `most` nearest found nor within `reach` times
        the nearest one's distance; those not found come last, infinitely far.
        """
        n, k = len(self.c), min(most, len(self.c))
        own = (q**2).sum(axis=1)
        seen, expanded = np.full((len(q), n), np.inf), np.zeros((len(q), n), bool)

        def look(rows: np.ndarray, at: np.ndarray) -> None:
            new = ~np.isfinite(seen[rows, at])
            rows, at = rows[new], at[new]
            seen[rows, at] = np.maximum(own[rows] + self.norm[at] - 2 * np.einsum("pd,pd->p", q[rows], self.c[at]), 0)

        live = np.arange(len(q))
        look(np.repeat(live, len(self.entry)), np.tile(self.entry, len(live)))
        while len(live):
            d = seen[live]
            bound = np.maximum(np.partition(d, k - 1, axis=1)[:, k - 1], reach**2 * d.min(axis=1))
            d[expanded[live]] = np.inf
            at = d.argmin(axis=1)
            best = d[np.arange(len(live)), at]
            go = np.isfinite(best) & (best <= bound)
            live, at = live[go], at[go]
            expanded[live, at] = True
            near = self.near[at]
            look(np.repeat(live, near.shape[1]), near.ravel())
        order = np.argsort(seen, axis=1, kind="stable")
        return order, np.sqrt(np.take_along_axis(seen, order, 1))


def homes(graph: CentroidGraph, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, whether it is the row's nearest) of the lists that hold each row."""
    lists, far = (a[:, :REPLICAS] for a in graph.search(x, REPLICAS))
    row, k = np.nonzero(far <= BOUNDARY * far[:, :1])
    return row, lists[row, k], k == 0


def probes(graph: CentroidGraph, q: np.ndarray, ratio: float = RATIO, primary: np.ndarray | None = None, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(query, list) of the lists to read: all within the ratio, the nearest two at least, and as many
    as hold `least` rows (primary: how many rows have each list as their nearest)."""
    lists, far = graph.search(q, 2, ratio)
    read = (far <= ratio * far[:, :1]) | (np.arange(lists.shape[1]) < 2)
    if primary is not None:
        few = (primary[lists] * read).sum(axis=1) < least
        if few.any():  # hardly any rows near: look at all lists
            lists[few], far[few] = graph.search(q[few], len(graph.c))
            read[few] |= np.cumsum(primary[lists[few]], axis=1) - primary[lists[few]] < least
    row, k = np.nonzero(read & np.isfinite(far))
    return row, lists[row, k]


def _usable(v: Column, size: int) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == size) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _merged(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of a query's (vec_id, score), each id once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def best_of_page(q: np.ndarray, own: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query its k best ids of a page: a fast product first, then exactly what may count."""
    ids, first = np.unique(ids, return_index=True)
    v = v[first]
    fast = q @ v.T
    fast[own[:, None] == ids] = -np.inf
    if fast.shape[1] > k:
        cut = np.partition(fast, -k, axis=1)[:, -k]
    else:
        cut = np.full(len(q), -np.inf)
    slack = 1e-9 * (1 + np.abs(cut))
    for i in range(len(q)):
        at = np.flatnonzero((fast[i] >= cut[i] - slack[i]) & np.isfinite(fast[i])) if np.isfinite(cut[i]) else np.flatnonzero(np.isfinite(fast[i]))
        yield _merged(ids[at], (v[at] * q[i]).sum(axis=1), k)


def _in_cells(both: DataFrame, long: list[tuple[int, int, int]], read: Callable[[pd.Series], np.ndarray], lifted: Lift, asking: Lift, ratio: float) -> DataFrame:
    """both (list, query, id, vector) with the cell of each row, and the cells that each query reads.

    long: (list, cells, rows) of the lists that are split; cell is 0 in all others.
    """
    spark = both.sparkSession
    rows = [(i, cells, -(-n // TOGETHER), min(1.0, CELL_SAMPLE * cells / n)) for i, cells, n in long]
    plan = F.broadcast(spark.createDataFrame(rows, "list int, cells int, parts int, share double"))  # MOST_LISTS rows at most
    both = written(both)
    split = both.join(plan, "list")
    draw = F.shiftrightunsigned(F.xxhash64("id"), 1)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = lifted(read(rows["vector"]))
        centres = fit_lists(x, int(rows["cells"].iloc[0]))
        return pd.DataFrame({"list": rows["list"].iloc[:1], "vector": [centres.tobytes()]})

    sample = split.where(~F.col("query") & (draw < (F.col("share") * F.lit(float(2**63 - 1))).cast("long")))
    centres = written(sample.select("list", "cells", "vector").groupBy("list").applyInPandas(fit, "list int, vector binary"))
    dealt = split.select("list", (draw % F.col("parts")).cast("int").alias("part"), F.when(F.col("query"), 2).otherwise(1).alias("kind"), "id", "vector")
    every = centres.join(plan, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), "vector")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, graph = None, None
        for f in frames:
            for (*at, kind), g in f.groupby(["list", "part", "kind"], sort=False):
                if at != last:
                    last, graph = at, None
                if not kind:
                    graph = CentroidGraph(np.frombuffer(g["vector"].iloc[0]).reshape(-1, width))
                    continue
                for a in range(0, len(g), 512):
                    part = g.iloc[a : a + 512]
                    x = read(part["vector"])
                    if graph is None:
                        row, cell = np.arange(len(x)), np.zeros(len(x), np.int64)
                    elif kind == 1:
                        row, cell, _ = homes(graph, lifted(x))
                    else:
                        row, cell = probes(graph, asking(x), ratio)
                    yield pd.DataFrame({"list": at[0], "cell": cell, "query": kind == 2, "id": part["id"].to_numpy()[row], "vector": part["vector"].to_numpy()[row]})

    width = lifted(read([both.where("not query").first()["vector"]])).shape[1]
    both_kinds = dealt.unionByName(every).repartition("list", "part").sortWithinPartitions("list", "part", "kind")
    placed = both_kinds.mapInPandas(place, "list int, cell int, query boolean, id long, vector binary")
    others = both.join(plan, "list", "left_anti").withColumn("cell", F.lit(0))
    return written(placed.unionByName(others))


def search(df: DataFrame, queries: Column, k: int = 20, vector: str = "embedding", key: str = "vec_id", ratio: float = RATIO) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest rows found. queries: which rows ask."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stored_as = "<f4" if df.schema[vector].dataType.simpleString() == "array<float>" else "<f8"
    read = lambda blobs: np.stack([np.frombuffer(b, stored_as) for b in blobs]).astype(float)
    df = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")).where("vec_id is not null")
    sizes = df.groupBy(F.size("v").alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return empty
    size = sizes["n"]
    rows = written(df.where(_usable(F.col("v"), size)).groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, top = rows.agg(F.count("*"), F.max(squares)).first()
    if not n:
        return empty
    share = F.shiftrightunsigned(F.xxhash64("vec_id"), 1) < F.lit(int(min(1, SAMPLE / n) * (2**63 - 1)))
    sample = np.array([r["v"] for r in rows.where(share).limit(2 * SAMPLE).select("v").collect()] or [rows.select("v").first()["v"]])
    lifted = lambda x: np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))])
    asking = lambda x: np.column_stack([x, np.zeros(len(x))])
    graph = CentroidGraph(fit_lists(lifted(sample), max(1, min(MOST_LISTS, -(-n // LIST_ROWS)))))
    held = spark.sparkContext.broadcast(graph)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a in range(0, len(f), 2048):
                part = f.iloc[a : a + 2048]
                x = np.stack(part["v"].to_numpy())
                row, home, first = homes(held.value, lifted(x))
                yield pd.DataFrame({"list": home, "vec_id": part["vec_id"].to_numpy()[row], "first": first, "asks": part["asks"].to_numpy()[row], "vector": [x[i].astype(stored_as).tobytes() for i in row]})

    indexed = written(rows.mapInPandas(index, "list int, vec_id long, first boolean, asks boolean, vector binary"))
    sizes = indexed.groupBy("list").agg(F.count("*").alias("all"), F.count_if("first").alias("first")).collect()  # a row for each list
    primary = np.zeros(len(graph.c), np.int64)
    for r in sizes:
        primary[r["list"]] = r["first"]

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a in range(0, len(f), 512):
                part = f.iloc[a : a + 512]
                x = read(part["vector"])
                row, at = probes(held.value, asking(x), ratio, primary, 2 * (k + 1))
                yield pd.DataFrame({"list": at, "query": True, "id": part["vec_id"].to_numpy()[row], "vector": part["vector"].to_numpy()[row]})

    stored = indexed.select("list", F.lit(False).alias("query"), F.col("vec_id").alias("id"), "vector")
    asked = indexed.where("asks and first").select("vec_id", "vector").mapInPandas(ask, "list int, query boolean, id long, vector binary")
    both = stored.unionByName(asked)
    long = [(r["list"], min(MOST_CELLS, -(-r["all"] // CELL_ROWS)), r["all"]) for r in sizes if r["all"] > PAGE]
    both = _in_cells(both, long, read, lifted, asking, ratio) if long else both.withColumn("cell", F.lit(0))
    held_rows = both.where("not query") if long else stored.withColumn("cell", F.lit(0))
    pages = held_rows.groupBy("list", "cell").agg(F.ceil(F.count("*") / F.lit(PAGE)).cast("int").alias("pages"))
    page = (F.shiftrightunsigned(F.xxhash64("id"), 1) % F.col("pages")).cast("int")
    pages_of = F.when(F.col("query"), F.sequence(F.lit(0), F.col("pages") - 1)).otherwise(F.array(page))
    number = len(sizes) + sum(cells for _, cells, _ in long)  # of lists and cells
    both = both.join(F.broadcast(pages) if number <= SENT else pages, ["list", "cell"]).select("list", "cell", F.explode(pages_of).alias("page"), "query", "id", "vector")

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> pd.DataFrame:
            made = pd.DataFrame({"query_id": list(best), "ids": [i for i, _ in best.values()], "scores": [s for _, s in best.values()]})
            best.clear()
            return made

        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None
        for f in frames:
            # a page's rows come before its queries
            for (*at, asks), g in f.groupby(["list", "cell", "page", "query"], sort=False):
                if at != last:
                    held, last = [], at
                x, ids = read(g["vector"]), g["id"].to_numpy()
                if not asks:
                    held.append((x, ids))
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held = [tuple(np.concatenate(part) for part in zip(*held, strict=True))]
                for a in range(0, len(x), 256):
                    for one, (i, s) in zip(ids[a : a + 256], best_of_page(x[a : a + 256], ids[a : a + 256], *held[0], k), strict=True):
                        if one in best:
                            i, s = _merged(np.concatenate([best[one][0], i]), np.concatenate([best[one][1], s]), k)
                        best[one] = i, s
                if len(best) > 20_000:
                    yield out()
        if best:
            yield out()

    both = both.repartition("list", "cell", "page").sortWithinPartitions("list", "cell", "page", "query")
    found = both.mapInPandas(scan, "query_id long, ids array<long>, scores array<double>")
    # a query has a row from each task at most: k of each meet here
    pairs = F.flatten(F.collect_list(F.arrays_zip("ids", "scores")))
    ordered = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: F.struct((-p["scores"]).alias("minus"), p["ids"].alias("id")))))
    return (
        found.groupBy("query_id")
        .agg(F.slice(ordered, 1, k).alias("best"))
        .select("query_id", F.posexplode("best").alias("at", "b"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.minus")).alias("score"))
    )
