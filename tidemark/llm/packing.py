"""Packing documents into token sequences: dominance reduction, then best fit.

Documents are tokenised, longer ones cut into full pieces (the first may be shorter). What packing
has to know is only how many pieces there are of each length, at most `capacity` numbers, so the
plan is made on that histogram on the driver: sets of one or two pieces that provably dominate every
other way to fill a sequence (Martello and Toth) are fixed, the rest goes best-fit by decreasing
length, whole groups of equal sequences at a time. Groups are then spread evenly over the output: the
j-th of n equal sequences stands at (j + 1/2) / n of it, and the places for a length are filled in
that order by the pieces' rank among those of their length. Where documents come in an order that
matters, sequences are numbered by the earliest document that they hold, and so follow it as far as
filling them allows.

Defined cases: a null text counts as empty; an empty text is the end token alone; a very long text is
cut into as many pieces as it takes; repeated rows and null ids are packed like any others; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_frames, ranked_in_groups, written

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
#: Sequences of a group that are worked out together, and of a group at most (so that products fit 64 bits).
TOGETHER, GROUP = 65_536, 1 << 30
# Fixed value: the vocabulary's own rule for cutting text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same rule for texts in which no two white-space characters meet: without a look ahead it is matched far faster.
APART = PATTERN.removesuffix(r"\s+(?!\S)|\s+") + r"\s"


def _ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level file as bytes: printable bytes stand for themselves, the others are moved up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return {bytes(char[c] for c in token): i for token, i in vocabulary.items() if token not in _special(path)}


@cache
def _special(path: str) -> dict[str, int]:
    """The tokens that a vocabulary file takes out of a text before the text is cut."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


@cache
def encoder(tokenizer: str = TOKENIZER) -> Callable[[str], bytes]:
    """text -> its ids as little-endian unsigned 32-bit integers, by a vocabulary file's name or path.

    Special tokens in a text have their own ids. A text is cut by the rule without a look ahead where
    that is exact: where every white-space character stands alone, as nearly everywhere.
    """
    import public_tokenizers
    import tiktoken

    path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
    special, ranks = _special(path), _ranks(path)
    by_rule, by_apart = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens=special) for p in (PATTERN, APART))
    together, every = re.compile(r"\s\s").search, set(special)

    def whole(text: str) -> bytes:
        bpe = by_rule if together(text) else by_apart
        return bpe.encode_to_numpy(text, allowed_special=every, disallowed_special=()).astype("<u4", copy=False).tobytes()

    return whole


def pieces(df: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False, place: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (ids, as bytes, and place, df's column of that name) of every document's tokens and end."""
    key = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", place long" * bool(place)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer), int(END).to_bytes(4, "little")
        for f in chunks(frames, "text"):
            rows = []
            for doc, text, at in zip(f["doc_id"], f["text"], f["place"], strict=True):
                ids = (encode(text) if text else b"") + end
                n = len(ids) // 4
                a, b, k = 0, (n - 1) % capacity + 1, 0
                while a < n:
                    part = ids[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(part), *[part] * with_ids, *[at] * bool(place)))
                    a, b, k = b, b + capacity, k + 1
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    # ids as text keep what pandas can't: nulls beside large integers
    safe = df.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(place) if place else F.lit(0)).cast("long").alias("place"))
    out = map_frames(safe, cut, schema.replace(f"doc_id {key}", "doc_id string", 1))
    return out.withColumn("doc_id", F.col("doc_id").cast(key))


def dominated(counts: np.ndarray) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Martello and Toth's reduction. counts[w]: pieces of length w, is lowered by what gets fixed.

    Returns (((length, how many), ...), sequences). A set holding the piece w is fixed if it leaves
    no room for anything else worth having: it is full, or w fits with nothing, or its one partner
    is at least as long as any two that would fit with w (and three never do).
    """
    capacity, fixed = len(counts) - 1, []

    def fix(w: int, a: int) -> None:
        # what dominates still does once copies of it are gone: fewer others are left to do better
        n = int(counts[w]) if not a else int(counts[w]) // 2 if a == w else int(min(counts[w], counts[a]))
        counts[w] -= n
        if a:
            counts[a] -= n
        fixed.append((((w, 2),) if a == w else ((w, 1), (a, 1)) if a else ((w, 1),), n))

    for w in range(capacity, 0, -1):
        while counts[w]:
            room = capacity - w
            others = counts.copy()
            others[w] -= 1
            have = np.flatnonzero(others)
            if not room or not len(have) or have[0] > room:
                fix(w, 0)
                continue
            a = int(have[have <= room][-1])
            least = np.repeat(have[:3], np.minimum(others[have[:3]], 3))[:3]
            if a < room and len(least) > 1 and least[0] + least[1] <= room:
                if len(least) == 3 and least.sum() <= room or _longest_pair(have, others, room) > a:
                    break
            fix(w, a)
    return fixed


def _longest_pair(have: np.ndarray, others: np.ndarray, room: int) -> int:
    best, lo, hi = 0, 0, len(have) - 1
    while lo <= hi:
        total = int(have[lo] + have[hi])
        if total > room:
            hi -= 1
        else:
            if lo < hi or others[have[lo]] > 1:
                best = max(best, total)
            lo += 1
    return best


def best_fit(counts: np.ndarray) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit by decreasing length over a histogram; equal sequences are handled as one group."""
    capacity = len(counts) - 1
    open_: list[list[list]] = [[] for _ in range(capacity + 1)]
    for w in range(capacity, 0, -1):
        left = int(counts[w])
        for room in [*range(w, capacity), capacity]:
            if not left:
                break
            groups = open_[room] if room < capacity else [[(), left]]
            open_[room], fits = [], room // w
            for held, n in groups:
                full = min(n, left // fits)
                if full:
                    open_[room - fits * w].append([(*held, (w, fits)), full])
                    left -= full * fits
                if left and full < n and left < fits:
                    open_[room - left * w].append([(*held, (w, left)), 1])
                    left, full = 0, full + 1
                if full < n and room < capacity:
                    open_[room].append([held, n - full])
    return [(held, n) for groups in open_ for held, n in groups]


def plan(counts: np.ndarray) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    rest = counts.astype(np.int64).copy()
    fixed = dominated(rest)
    return fixed + best_fit(rest)


def places(groups: np.ndarray, which: int, first: int, end: int) -> pd.DataFrame:
    """length, rank, sequence_id, offset of every place of sequences first..end-1 of one group.

    groups: (group, sequences, length, how many of it in each, where they begin) of all groups. The
    rank of a place counts the places for its length that come before it in all groups.
    """
    j, out = np.arange(first, end), []
    own = groups[groups[:, 0] == which]
    n = int(own[0, 1])
    ids = ((2 * j + 1) << 31) // (2 * n) << 16 | which
    for _, _, w, each, at in own:
        rank = np.zeros(len(j), np.int64)
        for other, m, _, fits, _ in groups[groups[:, 2] == w]:
            # sequences i of the other group with (2 i + 1) / 2 m below (2 j + 1) / 2 n; equal ones by group
            apart = (2 * j + 1) * m - n
            before = j if other == which else apart // (2 * n) + 1 if other < which else -(-apart // (2 * n))
            rank += fits * np.clip(before, 0, m)
        for k in range(each):
            out.append(pd.DataFrame({"length": w, "rank_of_length": rank + k, "sequence_id": ids, "offset": at + k * w}))
    return pd.concat(out)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (doc_id, piece, length, ...; stored, since it is read more than once) with sequence_id and offset.

    Where cut has a column place, pieces of a length are taken in its order, else in a pseudo-random one.
    """
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").count().collect():  # at most `capacity` rows
        counts[r["length"]] = r["count"]
    equal = [(held, min(GROUP, n - a)) for held, n in plan(counts) for a in range(0, n, GROUP)]
    rows = [(g, n, w, each, sum(v * k for v, k in held[:i])) for g, (held, n) in enumerate(equal) for i, (w, each) in enumerate(held)]
    groups = spark.sparkContext.broadcast(np.array(rows, np.int64).reshape(-1, 5))

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for g, a, b in zip(f["g"], f["a"], f["b"], strict=True):
                for i in range(a, b, TOGETHER):
                    yield places(groups.value, g, i, min(b, i + TOGETHER))

    runs = [(g, a, min(n, a + 16 * TOGETHER)) for g, (_, n) in enumerate(equal) for a in range(0, n, 16 * TOGETHER)]
    listed = spark.createDataFrame(runs, "g int, a long, b long").repartition("g", "a")
    slots = map_frames(listed, spread, "length long, rank_of_length long, sequence_id long, offset long")
    order = [F.col("doc_id"), F.col("piece")]
    if "place" in cut.columns:
        ranked = ranked_in_groups(cut, "length", [F.col("place"), *order], "rank_of_length", bucket=F.shiftright("place", 11))
    else:
        ranked = ranked_in_groups(cut, "length", order, "rank_of_length")
    # as many rows as pieces, which Spark can't know: never to be sent to every task
    placed = ranked.join(slots.hint("merge"), ["length", "rank_of_length"]).select(*cut.columns, "sequence_id", "offset")
    if "place" not in cut.columns:
        return placed
    placed = written(placed)
    heads = placed.groupBy("sequence_id").agg(F.min(F.struct("place", "piece")).alias("head")).select("sequence_id", "head.*", F.lit(0).alias("all"))
    numbers = ranked_in_groups(heads, "all", [F.col("place"), F.col("piece"), F.col("sequence_id")], "number", bucket=F.shiftright("place", 11))
    renumbered = placed.join(numbers.select("sequence_id", "number"), "sequence_id").withColumn("sequence_id", F.col("number"))
    return renumbered.select(*(c for c in cut.columns if c != "place"), "sequence_id", "offset")


def pack_documents(df: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False, place: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of all of df.

    place: a whole-number column by which the documents are in order, for sequences that follow it.
    """
    return pack(written(pieces(df, capacity, tokenizer, with_ids, place)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids as bytes, of what pack_documents(with_ids=True) gives."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
