"""Source divergence audit: how the terms of each source differ from its language's and other sources'.

Terms are counted by sorting pointers. A task joins the texts of a slice of rows into one buffer of
bytes; each term's start is a pointer into it. A multikey quicksort orders the pointers of each (lang,
source) group by eight bytes at a time, going deeper only where pointers still tie; runs of equal terms
give the term's occurrences and documents there. Spark adds up the runs of all slices.

Divergences are sums over all kept terms of exact integers. Terms that a source lacks all have one
probability there, so a pair's sum is one value for terms in neither source, a value for each count of a
term in one source, and a correction for each term in both: no source is filled up with zeros.

Defined cases: null text, lang and source count as ''; every row is a document, repeated rows too; a
text without terms still makes its group occur; a language without kept terms has pairs of value 0 and
no terms; a source alone in its language has no pairs; a very long text is sorted in pieces, cut between
terms, and counts as one document; extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bytes of text in a slice, about; longer texts are slices of their own, sorted piece by piece.
SLICE_BYTES = 1 << 23
#: Rows of counts that a task gives back at a time.
ROWS_OUT = 100_000
#: Documents of a language that a kept term is in, at least, and ranks of the terms that are told.
LEAST_DOCS, MOST_TERMS = 3, 200

_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of terms: all but ASCII ones that are no letters.
_IN_TERM = (_BYTE >= 128) | ((_LOWER >= 97) & (_LOWER <= 122))


def pointers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms in a buffer of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IN_TERM[data]
    edge = np.diff(inside)
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def multikey_sort(data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers' order by (group, term), stable, and where a run of equal ones begins in it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    order = np.argsort(group, kind="stable")
    first = np.diff(group[order], prepend=-1) != 0
    tied, depth = np.arange(len(order)), 0  # places in the order that are not settled
    while True:
        run = np.cumsum(first)[tied]
        size = np.bincount(run)
        tied = tied[size[run] > 1]
        if not len(tied):
            return order, first
        run, at = run[size[run] > 1], order[tied]
        left = np.clip(length[at] - depth, 0, 8)
        eight = padded[np.minimum(start[at] + depth, len(data))[:, None] + np.arange(8)]
        eight[np.arange(8) >= left[:, None]] = 0
        key = eight.view(">u8")[:, 0].astype(np.uint64)
        by = np.lexsort((key, run))
        order[tied], key, left = at[by], key[by], left[by]
        new = np.ones(len(tied), bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        first[tied] |= new
        tied, depth = tied[left == 8], depth + 8


def runs(data: np.ndarray, begin: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each distinct (group, term) in data: group, where a place of the term starts, its length, occurrences, documents.

    begin: where each text begins in data; group: of each text.
    """
    start, length = pointers(data)
    if not len(start):
        return (np.empty(0, np.int64),) * 5
    text = np.searchsorted(begin, start, side="right") - 1
    order, first = multikey_sort(data, start, length, group[text])
    begins = np.flatnonzero(first)
    count = np.diff(np.append(begins, len(order)))
    # Pointers of a run stand as in the buffer, so those of one text are neighbours.
    docs = np.add.reduceat((first | (np.diff(text[order], prepend=-1) != 0)).astype(np.int64), begins)
    at = order[begins]
    return group[text[at]], start[at], length[at], count, docs


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The stretches of data as text."""
    ends = np.cumsum(length)
    at = np.repeat(start - (ends - length), length) + np.arange(int(length.sum()))
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data[at])]).cast(pa.string())


def _long_text(data: np.ndarray, most: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms of one long text and their occurrences, by pieces that end between terms."""
    total: Counter[str] = Counter()
    gaps, at = np.flatnonzero(~_IN_TERM[data]), 0
    while at < len(data):
        k = np.searchsorted(gaps, at + most)
        to = int(gaps[k]) + 1 if k < len(gaps) else len(data)
        piece = data[at:to]
        _, start, length, count, _ = runs(piece, np.zeros(1, np.int64), np.zeros(1, np.int64))
        for term, n in zip(_strings(piece, start, length).to_pylist(), count.tolist(), strict=True):
            total[term] += n
        at = to
    return pa.array(list(total), pa.string()), np.array(list(total.values()), np.int64)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Runs of rows of about `most` bytes: the lower-cased bytes of their texts, a space after each, and where each begins."""
    texts = batch.column("text").cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, side="right")) - 1)
        size, begin = np.diff(at[a : b + 1]), at[a:b] - at[a] + np.arange(b - a)
        data = np.full(int(size.sum()) + b - a, 32, np.uint8)
        gap = np.zeros(len(data), bool)
        gap[begin + size] = True
        data[~gap] = _LOWER[whole[at[a] : at[b]]]
        yield data, begin, batch.slice(a, b - a)
        a = b


def term_counts(df: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents; term '' once for each group, n 0, docs all of it."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, begin, rows in _slices(batch, slice_bytes):
                names: dict[tuple[str, str], int] = {}
                pairs = zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), strict=True)
                group = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
                if len(begin) == 1 and len(data) > slice_bytes:
                    term, count = _long_text(data, slice_bytes)
                    of, docs = np.zeros(len(count), np.int64), np.ones(len(count), np.int64)
                else:
                    of, start, length, count, docs = runs(data, begin, group)
                    term = _strings(data, start, length)
                k = len(names)
                of, n, docs = np.append(np.arange(k), of), np.append(np.zeros(k, np.int64), count), np.append(np.bincount(group), docs)
                named = [pa.array([p[i] for p in names], pa.string()).take(pa.array(of)) for i in (0, 1)]
                out = pa.RecordBatch.from_arrays([*named, pa.concat_arrays([pa.array([""] * k, pa.string()), term]), pa.array(n), pa.array(docs)], schema=schema)
                for a in range(0, out.num_rows, ROWS_OUT):
                    yield out.slice(a, ROWS_OUT)

    named = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = named.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column) -> Column:
    """1 + floor(1000000000 * (n + 1) / total), exact for any long n; total may be 0 only where nothing is asked."""
    parts = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return 1 + F.call_function("div", parts, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q), below 2^63 for any two shares."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(df: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: `pair` to each other source, `term` for its terms above the language's share."""
    counts = written(term_counts(df))
    groups = counts.where("term = ''").select("lang", "source")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term <> ''").withColumns({"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)})
    kept = written(kept.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("v"))
    zero = F.lit(0).cast("long")
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.withColumns({c: F.coalesce(c, zero) for c in ("total", "lang_total", "v")})
    groups = written(groups.withColumns({"of": F.col("total") + F.col("v"), "lang_of": F.col("lang_total") + F.col("v")}).withColumn("absent", _share(zero, F.col("of"))))

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("of")))
    terms = shares.withColumn("q", _share(F.col("lang_n"), F.col("lang_of"))).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))

    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    neither = _gap(p0, q0)
    one, other = (groups.select("lang", F.col("source").alias(s), F.col("absent").alias(a), "v") for s, a in (("source", "p0"), ("item", "q0")))
    pairs = one.join(other.drop("v"), "lang").where("source <> item")
    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    lone = lambda s, x: pairs.join(levels.withColumnsRenamed({"source": s, "p": x}), ["lang", s])
    both = shares.select("lang", "term", "source", "p", F.col("absent").alias("p0"))
    both = both.join(shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("absent").alias("q0")), ["lang", "term"]).where("source <> item")
    parts = [
        pairs.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * neither).otherwise(zero).alias("value")),
        lone("source", "p").select("lang", "source", "item", (F.col("m") * (_gap(p, q0) - neither)).alias("value")),
        lone("item", "q").select("lang", "source", "item", (F.col("m") * (_gap(p0, q) - neither)).alias("value")),
        both.select("lang", "source", "item", (_gap(p, q) - _gap(p, q0) - _gap(p0, q) + neither).alias("value")),
    ]
    summed = parts[0]
    for x in parts[1:]:
        summed = summed.unionByName(x)
    summed = summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    summed = summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = terms.withColumn("rank", rank).where(F.col("rank") <= most_terms)
    return summed.withColumn("rank", rank).unionByName(best)
