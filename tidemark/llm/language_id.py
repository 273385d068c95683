"""Language identification by rank-order n-gram profiles.

A language's profile is its most frequent letter n-grams (1 to 3, with word boundaries) in rank
order. A document's own most frequent n-grams are compared with each profile by the out-of-place
distance: the sum of rank differences, the profile's length for an n-gram that it lacks. The
nearest profile wins.

Defined cases: null texts and texts without a letter are `und` with score 0, as is every text where
nothing could be learned; rows without a language teach nothing; ties of count go to the smaller
n-gram, ties of distance to the smaller language name; very long texts are counted whole, one at a
time; repeated rows count and are tagged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_CHARS, BATCH_ROWS, chunks, fresh, map_frames, small_batches

#: N-grams in a profile.
PROFILE = 400
#: Languages that are learned, at most: those with the most rows (profiles are sent with the tasks).
MOST_LANGUAGES = 1_000
BOUNDARY = ord("_")
#: Distinct (language, n-gram) pairs that a task holds before it passes them on.
HELD = 500_000


@cache
def _folded() -> np.ndarray:
    """For each code point its lower-case letter, BOUNDARY for what isn't a letter."""
    out = np.full(0x110000, BOUNDARY, np.int64)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def gram_counts(texts: list[str | None], group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram, count) of the texts, sorted by group and n-gram. group: a small number for each text.

    An n-gram is one integer: its code points, 21 bits each.
    """
    joined = "\n" + "\n".join(t or "" for t in texts) + "\n"
    x = _folded()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    g = np.concatenate([group[:1], np.repeat(group, lengths)])
    letter = x != BOUNDARY
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    x, g, letter = x[keep], g[keep], letter[keep]
    symbols, ids = np.unique(x, return_inverse=True)
    s = len(symbols)
    total = s + s * s + s * s * s
    one = g[letter] * total + ids[letter]
    two = np.where(letter[:-1], g[:-1], g[1:]) * total + s + ids[:-1] * s + ids[1:]
    two = two[letter[:-1] | letter[1:]]
    mid = letter[1:-1]
    three = (g[1:-1] * total + s + s * s + (ids[:-2] * s + ids[1:-1]) * s + ids[2:])[mid]
    keys = np.concatenate([one, two, three])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    n = np.diff(np.append(first, len(keys)))
    who, code = np.divmod(keys[first], total)
    return who, _packed(code, symbols), n


def _packed(code: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    s = len(symbols)
    out = np.empty(len(code), np.int64)
    a, b = code < s, code >= s + s * s
    m = ~a & ~b
    out[a] = symbols[code[a]]
    c = code[m] - s
    out[m] = symbols[c // s] << 21 | symbols[c % s]
    c = code[b] - s - s * s
    out[b] = symbols[c // (s * s)] << 42 | symbols[c // s % s] << 21 | symbols[c % s]
    return out


def learn_profiles(df: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Each language's `size` most frequent n-grams over all rows of df, most frequent first.

    Of more than MOST_LANGUAGES languages those with the most rows are learned.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: dict[str, int] = {}
        held: list[tuple] = []

        def merged() -> tuple:
            who, gram, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((gram, who))
            who, gram, n = who[order], gram[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (gram[1:] != gram[:-1])]))
            return who[first], gram[first], np.add.reduceat(n, first)

        def out() -> pd.DataFrame:
            who, gram, n = merged()
            return pd.DataFrame({"lang": np.array(list(names), object)[who], "gram": gram, "n": n})

        rows = 0
        for f in chunks(frames, "text"):
            group = np.fromiter((names.setdefault(x, len(names)) for x in f["lang"]), np.int64, len(f))
            counted = gram_counts(f["text"].tolist(), group)
            if not len(counted[0]):
                continue
            held.append(counted)
            rows += len(counted[0])
            if rows > HELD:
                held = [merged()]
                rows = len(held[0][0])
                if rows > HELD // 2:
                    yield out()
                    held, rows = [], 0
        if held:
            yield out()

    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    names = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        rows = rows.where(F.col("lang").isin(names[:MOST_LANGUAGES]))
    counts = map_frames(rows, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    with small_batches(df.sparkSession):
        rows = top.orderBy("lang", "rank").collect()
    for r in rows:
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


def nearest(texts: list[str | None], names: list[str], grams: np.ndarray, ranks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest language of each text and 1 - its distance over the largest possible one."""
    n = len(texts)
    lang, score = np.full(n, "und", object), np.zeros(n)
    who, gram, count = gram_counts(texts, np.arange(n))
    if not len(who) or not names:
        return lang, score
    order = np.argsort(who * (int(count.max()) + 1) - count, kind="stable")
    who, gram = who[order], gram[order]
    start = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
    rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
    top = rank < size
    who, gram, rank = who[top], gram[top], rank[top]
    at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
    at[grams[at] != gram] = len(grams)
    known = ranks[at]
    apart = np.where(known < 0, size, np.abs(known - rank[:, None]))
    start = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
    apart = np.add.reduceat(apart, start, axis=0)
    best = apart.argmin(axis=1)
    docs = who[start]
    lang[docs] = np.array(names, object)[best]
    score[docs] = 1 - apart[np.arange(len(docs)), best] / (size * np.diff(np.append(start, len(who))))
    return lang, score


def identify(df: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE) -> DataFrame:
    """df with lang_pred and score. profiles: `size` integers for each language, sent with the tasks."""
    names = sorted(profiles)
    grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    ranks = np.full((len(grams) + 1, len(names)), -1, np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(grams, profiles[name]), k] = np.arange(len(profiles[name]))

    @F.arrow_udf("lang_pred string, score double")
    def tag(texts: pa.Array) -> pa.Array:
        found: list[tuple[str, float]] = []
        for a in range(0, len(texts), BATCH_ROWS):
            part = texts.slice(a, BATCH_ROWS).to_pylist()
            for i, j in _runs(part):
                found += zip(*nearest(part[i:j], names, grams, ranks, size), strict=True)
        lang, score = zip(*found, strict=True) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    # only texts go to Python; all other columns stay where they are
    own, tagged = df.drop("lang_pred", "score"), fresh(df, "tagged")
    out = own.withColumn(tagged, tag.asNondeterministic()(F.col(text)))  # so that no filter repeats it
    return out.select(*(F.col(f"`{c}`") for c in own.columns), F.col(tagged)["lang_pred"].alias("lang_pred"), F.col(tagged)["score"].alias("score"))


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about BATCH_CHARS characters."""
    first, held = 0, 0
    for i, t in enumerate(texts, 1):
        held += len(t or "")
        if held >= BATCH_CHARS or i == len(texts):
            yield first, i
            first, held = i, 0
