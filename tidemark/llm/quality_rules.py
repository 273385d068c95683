"""Quality rules on repetition within a text, found by a suffix array of its words.

The words of a run of texts are numbered so that texts share none. Prefix doubling sorts their suffixes;
the orders by 1, 2, 4, ... words tell the longest common prefix of neighbours. Intervals of these are
the maximal repeated substrings (which can be extended neither way at all their places); the union of
their spans and the longest of them are limited, beside counts of words, characters, symbols and lines.

Defined cases: a null text has no words; words are runs of characters other than space and \\x09-\\x0D,
compared as they are; repeats may overlap; a very long text is one row's work, with 4 bytes a word for
each doubling up to its longest repeat; repeated rows are judged one by one; ids may be null; extra
columns are not looked at by the report and kept by the filter; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, chunks, map_frames

#: Words of a repeat that counts, at least.
LEAST_WORDS = 8
#: Fewest words of a text that stays, and most of its words in repeats, in hundredths.
FEWEST_WORDS, MOST_REPEATED = 20, 30
#: The method's own limits: most of its characters in repeats, in hundredths, and words of its longest repeat.
MOST_COVERED, LONGEST_REPEAT = 30, 100

_SYMBOL = re.compile(r"[#*$%&|<>]")


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers that no two texts share, and where each text ends."""
    ids, base = [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        ids += [base + own.setdefault(w, len(own)) for w in words]
        base += len(own)
    return np.array(ids, np.int32), np.cumsum([len(w) for w in texts], dtype=np.int64)


def suffix_array(ids: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted suffixes (each up to its text's end), and their ranks by the first 1, 2, 4, ... words.

    Equal ranks mean equal words. Only suffixes that tie are sorted again.
    """
    n = len(ids)
    sa = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[sa], prepend=-1))
    rank = np.empty(n, np.int32)
    rank[sa] = np.repeat(first, np.diff(np.append(first, n)))
    ranks, tied, h = [rank], sa, 1
    while True:
        group = rank[tied]
        new = np.diff(group, prepend=-1) != 0
        size = np.diff(np.append(np.flatnonzero(new), len(tied)))
        keep = np.repeat(size > 1, size)
        tied, group = tied[keep], group[keep]
        if not len(tied):
            return sa, ranks
        inside = tied + h < end[tied]
        second = np.where(inside, rank[np.minimum(tied + h, n - 1)] + 1, 0)
        order = np.lexsort((second, group))
        tied, group, second = tied[order], group[order], second[order]
        new = np.diff(group, prepend=-1) != 0
        at = np.arange(len(tied))
        place = group + at - np.maximum.accumulate(np.where(new, at, 0))
        sa[place] = tied
        new |= np.diff(second, prepend=-1) != 0
        rank = rank.copy()
        rank[tied] = place[np.maximum.accumulate(np.where(new, at, 0))]
        ranks.append(rank)
        h *= 2


def common_prefixes(sa: np.ndarray, ranks: list[np.ndarray], end: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """At r: how many words the suffixes at r - 1 and r share, where they are `least` or more; else 0."""
    out = np.zeros(len(sa) + 1, np.int64)
    level = least.bit_length() - 1
    if level >= len(ranks):
        return out
    in_order = ranks[level][sa]
    at = np.flatnonzero(in_order[1:] == in_order[:-1]) + 1
    a, b = sa[at - 1], sa[at]
    shared = np.zeros(len(at), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < end[a]) & (y < end[b])
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        shared += np.where(inside & (ranks[k][x] == ranks[k][y]), 1 << k, 0)
    out[at] = np.where(shared >= least, shared, 0)
    return out


def maximal_repeats(ids: np.ndarray, start: np.ndarray, sa: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(words, first, last) of each maximal repeat: its places are sa[first..last].

    An interval of common prefixes can't be extended to the right; it can't to the left if its places
    come after different words, or one of them begins a text.
    """
    stack: list[list[int]] = []  # words, first place, the word before all of them (-1: they differ)
    for r in np.flatnonzero((shared > 0) | (np.append(0, shared[:-1]) > 0)):
        now, p = int(shared[r]), int(sa[r - 1])
        first, before = int(r) - 1, int(ids[p - 1]) if p > start[p] else -1
        while stack and stack[-1][0] > now:
            words, f, y = stack.pop()
            before = y if y == before else -1
            if before < 0:
                yield words, f, int(r) - 1
            first = f
        if stack and stack[-1][0] == now:
            stack[-1][2] = before if before == stack[-1][2] else -1
        elif now:
            stack.append([now, first, before])


def repetition(texts: list[list[bytes]], least: int = LEAST_WORDS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each text: its spans of words that lie in repeats, how many maximal repeats, and the longest's words."""
    ids, ends = numbered(texts)
    count, longest = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    none = np.empty((0, 2), np.int64)
    if not len(ids):
        return [none] * len(texts), count, longest
    sizes = np.diff(ends, prepend=0)
    text, end, start = (np.repeat(x, sizes) for x in (np.arange(len(texts)), ends, ends - sizes))
    sa, ranks = suffix_array(ids, end)
    shared = common_prefixes(sa, ranks, end, least)
    del ranks
    for words, first, _ in maximal_repeats(ids, start, sa, shared):
        t = text[sa[first]]
        count[t] += 1
        longest[t] = max(longest[t], words)
    # The deepest interval of a suffix has its longest repeat; all others there lie within it.
    reach = np.zeros(len(ids), np.int64)
    reach[sa] = np.maximum(shared[:-1], shared[1:])
    at = np.flatnonzero(reach)
    if not len(at):
        return [none] * len(texts), count, longest
    until = np.maximum.accumulate(at + reach[at])
    opens = np.append(True, (at[1:] > until[:-1]) | (text[at[1:]] != text[at[:-1]]))
    closes = np.append(np.flatnonzero(opens)[1:] - 1, len(at) - 1)
    spans = np.column_stack([at[opens], until[closes]]) - start[at[opens]][:, None]
    cuts = np.searchsorted(text[at[opens]], np.arange(len(texts) + 1))
    return [spans[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], count, longest


def judged(texts: list[str | None], most_covered: int = MOST_COVERED, longest_repeat: int = LONGEST_REPEAT) -> pd.DataFrame:
    """Counts, spans and verdicts of each text."""
    words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    spans, count, longest = repetition(words)
    rows = []
    for t, w, s in zip(texts, words, spans, strict=True):
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r")]
        chars = np.cumsum([0, *(len(x.decode("utf-8", "surrogatepass")) for x in w)])
        repeated, covered = int((s[:, 1] - s[:, 0]).sum()), int((chars[s[:, 1]] - chars[s[:, 0]]).sum())
        rows.append((len(w), int(chars[-1]), len(_SYMBOL.findall(t or "")), len(lines) - len(set(lines)), repeated, covered, s.tolist()))
    out = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "repeat_spans"])
    out["n_repeats"], out["longest_repeat"] = count, longest
    out["base_failed"] = (out.n_words < FEWEST_WORDS) | (100 * out.n_repeat_words > MOST_REPEATED * out.n_words)
    out["kept"] = ~(out.base_failed | (100 * out.covered_chars > most_covered * out.word_chars) | (out.longest_repeat > longest_repeat))
    return out


_COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, covered_chars bigint"
_VERDICTS = "repeat_spans array<array<bigint>>, n_repeats bigint, longest_repeat bigint, base_failed boolean, kept boolean"


def quality_report(df: DataFrame, most_covered: int = MOST_COVERED, longest_repeat: int = LONGEST_REPEAT) -> DataFrame:
    """One row per document: its counts, repeat_spans (words, the end exclusive), base_failed and kept."""
    key = df.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in chunks(frames, "text"):
            out = judged(f["text"].tolist(), most_covered, longest_repeat)
            out.insert(0, "doc_id", f["doc_id"].to_numpy(object))
            yield out

    named = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return map_frames(named, run, f"doc_id string, {_COUNTS}, {_VERDICTS}").withColumn("doc_id", F.col("doc_id").cast(key))


def quality_filter(df: DataFrame, most_covered: int = MOST_COVERED, longest_repeat: int = LONGEST_REPEAT) -> DataFrame:
    """df's rows that keep to the rules, with df's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH_ROWS):
                rows = b.slice(at, BATCH_ROWS)
                texts = rows.select(["text"]).to_pandas()
                kept = [judged(f["text"].tolist(), most_covered, longest_repeat)["kept"] for f in chunks(iter([texts]), "text")]
                yield rows.filter(pa.array(np.concatenate(kept)))

    return df.mapInArrow(run, df.schema)
