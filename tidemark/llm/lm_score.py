"""Language-model scores: deleted interpolation with weights by context frequency.

Tokens are words and one end for each text; a text is preceded by starts. The maximum-likelihood
estimates of a token given the two tokens before, given one, and given nothing are mixed with the
uniform one, by weights that depend on how often the longest known context was seen, in buckets by
powers of two. The weights are learned by expectation-maximisation on a part of the training texts
that is held out of the counts; then all training texts count. All words, pairs and triples count.

Texts become chunks of whole texts, numbered words with the words' hashes, so they are cut into words
once. A chunk asks for the counts of its own distinct n-grams: it sends them, sorted, with its own
counts, to the n-grams' ranges of hashes; a range adds up what all chunks send and answers each in
the order it asked. So one shuffle of distinct n-grams both counts and looks up, no range or chunk
grows with the corpus, and nothing but a histogram for the weights reaches the driver. Words are told
apart by 64 bits; pairs and triples by so many that two of the corpus agree by chance once in 2^SPARE.

Defined cases: null and empty texts are an end alone; null ids count as training; without training
texts every probability is uniform; buckets that no held-out token fell in take the weights of the
nearest one below; a very long text is a chunk of its own; repeated rows are scored and counted like
any others; other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_frames, small_batches, whole_groups, words_of, written

ORDER = 3
#: Tokens of a chunk, about, and distinct n-grams of a range, about.
CHUNK, RANGE = 3 << 18, 1 << 21
#: Bits by which n-grams' hashes are longer than it takes to number the corpus's tokens.
SPARE = 20
ROUNDS = 30
#: Parts that a chunk's text belongs to: counted at first, counted later, never counted.
KEPT, DELETED, HELD_OUT = 0, 1, 2
#: Chunk numbers of rows that tell how many n-grams there are.
TRAINED, COUNTED = -1, -2
_START, _END = xxhash.xxh3_64_intdigest(b"\t"), xxhash.xxh3_64_intdigest(b" ")  # no word holds white space
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Buckets: 64 by the pair of tokens before, 64 by the one before, one for neither known.
BUCKETS = 129
_BINS = 32


def packed(x: np.ndarray) -> bytes:
    """Whole numbers, not negative, by byte planes: a few bytes each where they are small."""
    x = np.ascontiguousarray(x, "<u8")
    width = (int(x.max(initial=0)).bit_length() + 7) // 8
    return zstandard.compress(x.view(np.uint8).reshape(-1, 8).T[:width].tobytes(), 1)


def unpacked(b: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(-1, n) if n else np.empty((0, 0), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<u8")


def chunked(df: DataFrame, held_out: Column, deleted: Column) -> DataFrame:
    """chunk, part, docs (ids as text), tokens (how many), lengths, words (hashes of the distinct ones), text (their numbers)."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = count(TaskContext.get().partitionId() << 32)
        held: dict[int, tuple[list, list[np.ndarray], defaultdict[bytes, int]]] = {}

        def out(part: int) -> pd.DataFrame:
            docs, texts, words = held.pop(part)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            row = (next(numbers), part, docs, int(lengths.sum()), packed(lengths), hashes.tobytes(), packed(np.concatenate(texts)))
            return pd.DataFrame([row], columns=["chunk", "part", "docs", "tokens", "lengths", "words", "text"])

        for f in frames:
            for doc, part, text in zip(f["doc_id"], f["part"], f["text"], strict=True):
                if part not in held:
                    held[part] = [], [], defaultdict(count().__next__)
                    held[part][2][b" "]  # the end is word 0
                docs, texts, words = held[part]
                w = words_of(text)
                docs.append(doc)
                texts.append(np.fromiter(map(words.__getitem__, [*w, b" "]), np.int64, len(w) + 1))
                if sum(map(len, texts[-1:])) >= CHUNK or len(texts) % 64 == 0 and sum(map(len, texts)) >= CHUNK:
                    yield out(part)
        for part in list(held):
            yield out(part)

    part = F.when(held_out, HELD_OUT).when(deleted, DELETED).otherwise(KEPT)
    safe = df.select(F.col("doc_id").cast("string").alias("doc_id"), part.alias("part"), F.col("text").cast("string").alias("text"))
    return map_frames(safe, cut, "chunk long, part int, docs array<string>, tokens long, lengths binary, words binary, text binary")


class Grams:
    """The n-grams of a chunk: hashes of each order's, token by token, and which tokens begin a text."""

    def __init__(self, lengths: np.ndarray, words: np.ndarray, text: np.ndarray, bits: int) -> None:
        h, first = words[text], np.cumsum(lengths) - lengths
        place = np.arange(len(h)) - np.repeat(first, lengths)
        self.first, self.begins = first, place == 0
        before = [h]
        for k in range(1, ORDER):
            x = np.full(len(h), _START, np.uint64)
            x[k:] = h[:-k]
            x[place < k] = _START
            before.append(x)
        self.hashes = [h]
        for n in range(2, ORDER + 1):
            key = np.zeros(len(h), np.uint64)
            for x in before[n - 1 :: -1]:
                key = (key + x) * _PRIME
                key ^= key >> np.uint64(29)
            self.hashes.append(key * _PRIME >> np.uint64(64 - bits))


def _chunk_of(row: object, bits: int) -> Grams:
    lengths = unpacked(row.lengths, len(row.docs)).astype(np.int64)
    return Grams(lengths, np.frombuffer(row.words, np.uint64), unpacked(row.text, row.tokens).astype(np.int64), bits)


def _width(order: int, bits: int) -> int:
    return 64 if order == 1 else bits


def exchanged(corpus: DataFrame, bits: int, ranges: int) -> DataFrame:
    """chunk, part, gram_order, hash_range, n, counts (of all training texts), kept (of the kept ones, for deleted chunks).

    2^ranges ranges. Rows of chunk TRAINED and COUNTED tell how many n-grams of a range training and kept texts have.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                out = []
                for order, hashes in enumerate(_chunk_of(row, bits).hashes, 1):
                    keys, n = np.unique(hashes, return_counts=True)
                    shift = _width(order, bits) - ranges
                    at = keys >> np.uint64(shift) if ranges else np.zeros(len(keys), np.uint64)
                    bounds = [*np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])), len(keys)]
                    for a, b in zip(bounds, bounds[1:], strict=False):
                        steps = np.diff(keys[a:b], prepend=at[a] << np.uint64(shift) if ranges else np.uint64(0))
                        out.append((row.chunk, row.part, order, int(at[a]), b - a, packed(steps), packed(n[a:b]) if row.part != HELD_OUT else None))
                yield pd.DataFrame(out, columns=["chunk", "part", "gram_order", "hash_range", "n", "keys", "counts"])

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, ["gram_order", "hash_range"]):
            order, at = int(g["gram_order"].iloc[0]), int(g["hash_range"].iloc[0])
            start = np.uint64(at << (_width(order, bits) - ranges) if ranges else 0)
            keys = np.concatenate([np.cumsum(unpacked(k, n)) + start for k, n in zip(g["keys"], g["n"], strict=True)])
            own = [unpacked(c, n) if p != HELD_OUT else np.zeros(n, np.uint64) for c, n, p in zip(g["counts"], g["n"], g["part"], strict=True)]
            distinct, which = np.unique(keys, return_inverse=True)
            ends = np.cumsum(g["n"].to_numpy())
            kept = np.concatenate([c if p == KEPT else np.zeros_like(c) for c, p in zip(own, g["part"], strict=True)])
            total = [np.bincount(which, x, len(distinct)).astype(np.int64) for x in (np.concatenate(own), kept)]
            out = [(c, HELD_OUT, order, at, int((t > 0).sum()), None, None) for c, t in zip((TRAINED, COUNTED), total, strict=True)]
            for chunk, part, n, e in zip(g["chunk"], g["part"], g["n"], ends, strict=True):
                mine = which[e - n : e]
                out.append((chunk, part, order, at, n, packed(total[0][mine]), packed(total[1][mine]) if part == DELETED else None))
            yield pd.DataFrame(out, columns=["chunk", "part", "gram_order", "hash_range", "n", "counts", "kept"])

    asked = map_frames(corpus, ask, "chunk long, part int, gram_order int, hash_range long, n int, keys binary, counts binary", 1)
    dealt = asked.repartition("gram_order", "hash_range").sortWithinPartitions("gram_order", "hash_range", "chunk")
    return map_frames(dealt, answer, "chunk long, part int, gram_order int, hash_range long, n int, counts binary, kept binary")


def with_counts(corpus: DataFrame, answers: DataFrame, column: str, bits: int, use: Callable[..., pd.DataFrame], schema: str) -> DataFrame:
    """use(chunk's row, Grams, each order's counts of its tokens) of every chunk, with its answers beside it."""
    own = [c for c in corpus.columns if c not in ("chunk", "part")]
    mine = corpus.withColumns({"gram_order": F.lit(0), "hash_range": F.lit(0).cast("long"), "n": F.lit(0), "answer": F.lit(None).cast("binary")})
    theirs = answers.where("chunk >= 0").select("chunk", "part", "gram_order", "hash_range", "n", F.col(column).alias("answer"), *(F.lit(None).cast(corpus.schema[c].dataType).alias(c) for c in own))
    both = mine.unionByName(theirs).repartition("chunk").sortWithinPartitions("chunk", "gram_order", "hash_range")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, ["chunk"]):
            rows = g.itertuples()
            row = next(rows)
            grams = _chunk_of(row._replace(tokens=int(row.tokens)), bits)
            got: list[list[np.ndarray]] = [[] for _ in range(ORDER)]
            for r in rows:
                got[r.gram_order - 1].append(unpacked(r.answer, r.n))
            counts = []
            for n in range(ORDER):  # an order's hashes go once its counts are there
                which = np.unique(grams.hashes[n], return_inverse=True)[1]
                grams.hashes[n] = None
                counts.append(np.concatenate(got[n]).astype(np.int64)[which])
            yield use(row, grams, counts)

    return map_frames(both, run, schema)


def estimates(counts: list[np.ndarray], begins: np.ndarray, texts: int, total: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The tokens' buckets, and their maximum-likelihood estimates, longest context first (0 where it is unknown).

    texts, total: texts and tokens that were counted. A context was seen as often as it was followed,
    that is as often as it occurs, the start of a text as often as there are texts.
    """
    contexts = [np.full(len(begins), total, np.int64)]
    for c in counts[:-1]:
        contexts.append(np.where(begins, texts, np.concatenate([[0], c[:-1]])))
    parts = [c / np.maximum(x, 1) for c, x in zip(counts, contexts, strict=True)][::-1]
    level = lambda x: np.log2(np.maximum(x, 1)).astype(np.int64)
    bucket = np.where(contexts[2] > 0, 64 + level(contexts[2]), np.where(contexts[1] > 0, level(contexts[1]), BUCKETS - 1))
    return bucket, parts


def default_weights() -> np.ndarray:
    """For each bucket equal weights of the estimates that its contexts have, the uniform one last."""
    out = np.full((BUCKETS, ORDER + 1), 1 / 4)
    out[:64] = 0, 1 / 3, 1 / 3, 1 / 3
    out[-1] = 0, 0, 1 / 2, 1 / 2
    return out


def mixture_weights(bucket: np.ndarray, parts: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Each bucket's weights by EM on rows of (bucket, estimates, how many tokens); others as the nearest
    bucket below in their family that has rows, or else the nearest above."""
    out, learned = default_weights(), np.zeros(BUCKETS, bool)
    for b in np.unique(bucket):
        at = bucket == b
        w, x, m = out[b], parts[at], n[at]
        for _ in range(rounds):
            mixed = x * w
            w = (mixed / mixed.sum(axis=1, keepdims=True) * m[:, None]).sum(axis=0) / m.sum()
        out[b], learned[b] = w, True
    for family in (range(64), range(64, BUCKETS - 1)):
        known = [b for b in family if learned[b]]
        for b in family:
            if known and not learned[b]:
                out[b] = out[max((k for k in known if k < b), default=known[0])]
    return out


def learn_weights(corpus: DataFrame, answers: DataFrame, bits: int, texts: int, total: int, types: int) -> np.ndarray:
    """Weights from the deleted chunks' tokens by the kept counts. Tokens meet the driver as a histogram:
    by bucket and the powers of two of their estimates, with the estimates' means."""
    if not total:
        return default_weights()

    def tally(row: object, grams: Grams, counts: list[np.ndarray]) -> pd.DataFrame:
        bucket, parts = estimates(counts, grams.begins, texts, total)
        cell = bucket
        for x in parts:
            cell = cell * _BINS + np.where(x > 0, np.clip(-np.log2(np.maximum(x, 1e-300)), 0, _BINS - 2).astype(np.int64), _BINS - 1)
        cells, which = np.unique(cell, return_inverse=True)
        sums = {f"s{k}": np.bincount(which, x) for k, x in enumerate(parts)}
        return pd.DataFrame({"cell": cells, "n": np.bincount(which), **sums})

    schema = ", ".join(["cell long, n long", *(f"s{k} double" for k in range(ORDER))])
    cells = with_counts(corpus.where(F.col("part") == DELETED), answers.where(F.col("part") == DELETED), "kept", bits, tally, schema)
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(ORDER))).toPandas()
    n = rows["n"].to_numpy(float)
    parts = np.column_stack([*(rows[f"s{k}"].to_numpy(float) / n for k in range(ORDER)), np.full(len(n), 1 / (types + 1))])
    return mixture_weights(rows["cell"].to_numpy(np.int64) // _BINS**ORDER, parts, n)


def score(df: DataFrame, held_out: Column, deleted: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of df.

    held_out: rows that teach nothing. deleted: rows, of the others, that teach only the weights first.
    """
    key = df.schema["doc_id"].dataType.simpleString()
    corpus = written(chunked(df, held_out, deleted))
    size = {r["part"]: (r["tokens"], r["texts"]) for r in corpus.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.sum(F.size("docs")).alias("texts")).collect()}
    tokens, texts = ([size.get(p, (0, 0))[i] for p in (KEPT, DELETED, HELD_OUT)] for i in (0, 1))
    bits = min(64, SPARE + sum(tokens).bit_length())
    answers = written(exchanged(corpus, bits, (sum(tokens) // RANGE).bit_length()))
    distinct = {r["chunk"]: r["n"] for r in answers.where("chunk < 0 and gram_order = 1").groupBy("chunk").agg(F.sum("n").alias("n")).collect()}
    types = distinct.get(TRAINED, 0)
    with small_batches(df.sparkSession):
        weights = learn_weights(corpus, answers, bits, texts[KEPT], tokens[KEPT], distinct.get(COUNTED, 0))
    total, counted = tokens[KEPT] + tokens[DELETED], texts[KEPT] + texts[DELETED]
    if not total:
        weights[:] = [0] * ORDER + [1]

    def scored(row: object, grams: Grams, counts: list[np.ndarray]) -> pd.DataFrame:
        bucket, parts = estimates(counts, grams.begins, counted, total)
        p = weights[bucket, ORDER] / (types + 1)
        for k, x in enumerate(parts):
            p += weights[bucket, k] * x
        each = lambda x: np.add.reduceat(x, grams.first)
        return pd.DataFrame(
            {
                "doc_id": row.docs,
                "held_out": row.part == HELD_OUT,
                "n_tokens": np.diff(np.append(grams.first, len(p))),
                "n_known": each((counts[0] > 0).astype(np.int64)),
                "base_score": each(np.log10((counts[0] + 1) / (total + types + 1))),
                "score": each(np.log10(np.maximum(p, 1e-300))),
            }
        )

    out = with_counts(corpus, answers, "counts", bits, scored, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("doc_id").cast(key).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
