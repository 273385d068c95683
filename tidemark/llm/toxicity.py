"""Toxicity by a linear-chain conditional random field over the words of a text.

Labels mark whole documents, so words are labelled from them: in a bounded sample of labelled
documents, words and word parts that toxic documents have and clean ones lack become the field's
features, and a word that shows one is a toxic word if its document is toxic. The field (two states,
feature weights, transitions) is trained on the words around such places. Each whole text is then
tagged by forward-backward: a run of words without a feature is one step, the same matrix raised to
the run's length, so long texts cost no more than their marked words. The marginals of a document's
words give its score through a logistic curve fitted on the same sample, and the offsets of words
whose marginal is a half or more are its offending spans.

Defined cases: null and empty texts score like any text without marked words; labels that are null
teach nothing, of several labels of one document the highest counts; where nothing toxic was
labelled every score is 0; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_frames, small_batches

#: Labelled documents of each kind that the classifier is fitted on, about (the only sample here).
TOXIC_SAMPLE, CLEAN_SAMPLE = 6_000, 12_000
#: A feature is so many times likelier in toxic documents, by so much evidence (log-likelihood ratio).
LEAST_ODDS, LEAST_EVIDENCE = 12.0, 25.0
MOST_FEATURES = 4_000
#: Of the sample, documents of each kind that the field is trained on, about: their words meet on the driver.
FIELD_SAMPLE = 1_200
#: Words on either side of a marked one that the field is trained on, and words of a training sequence.
AROUND, SEQUENCE = 4, 32
#: Words of one document that the field is trained on, at most.
TRAINING_WORDS = 1_024
PARTS = (4, 5, 6)
#: Distinct words whose weights a Python worker keeps.
KEPT_WORDS = 250_000

_TRIM = re.compile(r"^[\W_]+|[\W_]+$")


def features(token: str) -> list[str]:
    word = _TRIM.sub("", token).lower()
    return [f"={word}", *(f"{word[:n]}-" for n in PARTS if len(word) > n)] if word else []


class Emissions(dict):
    """token -> its weight for the toxic state above the bias, None for tokens without a feature."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> float | None:
        found = [self.weights[f] for f in features(token) if f in self.weights]
        value = sum(found) if found else None
        if len(self) < KEPT_WORDS:
            self[token] = value
        return value


def _kin(text: str) -> str:
    """Four least word hashes: texts that are copies but for a few words mostly share it."""
    return "-".join(str(min((xxhash.xxh3_64_intdigest(w, k) for w in set(text.split())), default=0)) for k in range(4))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[DataFrame, dict[int, float], dict[int, float]]:
    """doc_id, text, y of a sample bounded by TOXIC_SAMPLE and CLEAN_SAMPLE, each kind's sampled share,
    and how much of its bound it fills."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = {y: min(1.0, most / max(1, n.get(y, 0))) for y, most in ((0, CLEAN_SAMPLE), (1, TOXIC_SAMPLE))}
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / F.lit(float(2**63))
    picked = known.where(draw < F.when(F.col("y") == 1, share[1]).otherwise(share[0])).limit(2 * (TOXIC_SAMPLE + CLEAN_SAMPLE))
    # how full each kind's part of the sample is
    full = {y: max(1e-9, min(1.0, n.get(y, 0) / most)) for y, most in ((0, CLEAN_SAMPLE), (1, TOXIC_SAMPLE))}
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id"), share, full


def learn_features(sample: DataFrame) -> list[str]:
    """The features that mark toxic documents, each kin of copies counted once."""

    @F.pandas_udf("string")
    def kin(texts: pd.Series) -> pd.Series:
        return texts.map(_kin)

    once = sample.withColumn("kin", kin("text")).dropDuplicates(["kin", "y"])

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter[tuple[str, int]] = Counter()
        for f in frames:
            for text, y in zip(f["text"], f["y"], strict=True):
                n.update((x, y) for x in {x for w in set(text.split()) for x in features(w)})
                n["", y] += 1
        yield pd.DataFrame([(x, y, k) for (x, y), k in n.items()], columns=["feature", "y", "n"])

    n = map_frames(once, counted, "feature string, y int, n long").groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("n"))), F.lit(0)).alias("toxic"), F.coalesce(F.sum(F.when(F.col("y") == 0, F.col("n"))), F.lit(0)).alias("clean")
    )
    total = n.where("feature = ''").first()
    if total is None or not total["toxic"]:
        return []
    rate = lambda k, of: (F.col(k) + 0.5) / F.lit(of + 1.0)
    odds = rate("toxic", total["toxic"]) / rate("clean", total["clean"])
    here, both = F.col("toxic"), F.col("toxic") + F.col("clean")
    part = lambda k, of: F.when(k > 0, k * F.log(k / both * F.lit((total["toxic"] + total["clean"]) / max(1, of)))).otherwise(0.0)
    evidence = 2 * (part(here, total["toxic"]) + part(F.col("clean"), total["clean"]))
    top = n.where((F.col("feature") != "") & (odds >= LEAST_ODDS) & (evidence >= LEAST_EVIDENCE)).orderBy(evidence.desc(), "feature").limit(MOST_FEATURES)
    return [r["feature"] for r in top.collect()]


class Field:
    """A two-state linear chain: feature weights, a bias, a start and three free transitions."""

    def __init__(self, names: list[str], weights: np.ndarray, chain: np.ndarray) -> None:
        self.weights = dict(zip(names, map(float, weights), strict=True))
        self.bias, self.start, to_toxic, to_clean, stay = map(float, chain)
        self.move = np.exp(np.array([[0.0, to_toxic], [to_clean, stay]]))
        values, vectors = np.linalg.eig(self.move * [1.0, math.exp(self.bias)])
        values, vectors = values.real / values.real.max(), vectors.real
        self.powers = lambda r, a=values, v=vectors, i=np.linalg.inv(vectors): (v * a**r) @ i

    def __reduce__(self) -> tuple:
        moves = np.log(self.move)
        return Field, ([*self.weights], np.array([*self.weights.values()]), np.array([self.bias, self.start, moves[0, 1], moves[1, 0], moves[1, 1]]))

    def marginals(self, at: list[int], emission: list[float], n: int) -> np.ndarray:
        """P(toxic) of the words at the places, of n words of which all others have no feature."""
        k = len(at)
        forward, backward = np.empty((k, 2)), np.ones((k, 2))
        here = np.column_stack([np.ones(k), np.exp(self.bias + np.array(emission))])
        state = np.array([1.0, math.exp(self.start)])
        if at[0]:
            state = state * [1.0, math.exp(self.bias)] @ self.powers(at[0] - 1) @ self.move
        for i in range(k):
            state = state * here[i]
            forward[i] = state = state / state.sum()
            if i + 1 < k:
                state = state @ self.powers(at[i + 1] - at[i] - 1) @ self.move
        state = self.powers(n - 1 - at[-1]) @ np.ones(2)
        for i in range(k - 1, -1, -1):
            backward[i] = state / state.sum()
            if i:
                state = self.powers(at[i] - at[i - 1] - 1) @ (self.move @ (here[i] * backward[i]))
        both = forward * backward
        return both[:, 1] / both.sum(axis=1)


def _chain(emission: np.ndarray, mask: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word and P(state, next state) of each pair, of many sequences at once."""
    n, t = emission.shape
    move = np.exp(np.array([[0.0, chain[2]], [chain[3], chain[4]]]))
    own = np.stack([np.ones((n, t)), np.exp(np.clip(emission, -30, 30))], axis=2)
    forward, backward = np.empty((n, t, 2)), np.ones((n, t, 2))
    forward[:, 0] = own[:, 0] * [1.0, np.exp(chain[1])]
    forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        x = forward[:, i - 1] @ move * own[:, i]
        forward[:, i] = np.where(mask[:, i, None], x / x.sum(axis=1, keepdims=True), forward[:, i - 1])
    for i in range(t - 2, -1, -1):
        x = (own[:, i + 1] * backward[:, i + 1]) @ move.T
        backward[:, i] = np.where(mask[:, i + 1, None], x / x.sum(axis=1, keepdims=True), backward[:, i + 1])
    one = forward * backward
    one /= one.sum(axis=2, keepdims=True)
    two = forward[:, :-1, :, None] * move * (own * backward)[:, 1:, None, :]
    two /= two.sum(axis=(2, 3), keepdims=True)
    return one[:, :, 1], two * mask[:, 1:, None, None]


def train_field(sequences: list[tuple[list[list[int]], list[int]]], names: list[str], rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximum likelihood with an L2 penalty by Adam. sequences: each word's features and its state."""
    n, t = len(sequences), max(len(y) for _, y in sequences)
    width = max([1, *(len(f) for x, _ in sequences for f in x)])
    feature, mask, y = np.full((n, t, width), len(names), np.int32), np.zeros((n, t), bool), np.zeros((n, t))
    for i, (xs, ys) in enumerate(sequences):
        mask[i, : len(ys)], y[i, : len(ys)] = True, ys
        for j, f in enumerate(xs):
            feature[i, j, : len(f)] = f
    theta = np.zeros(len(names) + 5)
    theta[-5] = -2.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    states = np.stack([1 - y, y], axis=2)
    seen = (states[:, :-1, :, None] * states[:, 1:, None, :] * mask[:, 1:, None, None]).sum(axis=(0, 1))
    for k in range(1, rounds + 1):
        w, chain = np.append(theta[:-5], 0.0), theta[-5:]
        one, two = _chain(w[feature].sum(axis=2) + chain[0], mask, chain)
        error = (y - one) * mask
        slope = np.empty_like(theta)
        slope[:-5] = np.bincount(feature.ravel(), weights=np.repeat(error.ravel(), width), minlength=len(names) + 1)[:-1]
        pairs = seen - two.sum(axis=(0, 1))
        slope[-5:] = error.sum(), error[:, 0].sum(), pairs[0, 1], pairs[1, 0], pairs[1, 1]
        slope = slope / n - decay * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += 0.15 * first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return Field(names, theta[:-5], theta[-5:])


def training_sequences(sample: DataFrame, names: list[str]) -> list[tuple[list[list[int]], list[int]]]:
    """The words around marked ones, and each text's first words, of the bounded sample."""
    number = {x: i for i, x in enumerate(names)}

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Emissions(dict.fromkeys(names, 1.0))
        for f in frames:
            rows = []
            for text, y in zip(f["text"], f["y"], strict=True):
                tokens = text.split()
                marked = [i for i, e in enumerate(map(memo.__getitem__, tokens)) if e is not None]
                taken = sorted({*range(min(len(tokens), 2 * AROUND)), *(j for i in marked for j in range(max(0, i - AROUND), min(len(tokens), i + AROUND + 1)))})
                if len(taken) > TRAINING_WORDS:  # stretches from all over the text
                    step = -(-len(taken) // TRAINING_WORDS)
                    taken = [j for i, j in enumerate(taken) if i // SEQUENCE % step == 0]
                parts, on = [], set(marked)
                for j in taken:
                    if not parts or parts[-1][-1] != j - 1 or len(parts[-1]) == SEQUENCE:
                        parts.append([])
                    parts[-1].append(j)
                for p in parts:
                    rows.append(([[number[x] for x in features(tokens[j]) if x in number] for j in p], [int(y and j in on) for j in p]))
            yield pd.DataFrame(rows, columns=["x", "y"])

    rows = map_frames(sample, cut, "x array<array<int>>, y array<int>").collect()
    return [(r["x"], r["y"]) for r in rows]


def _tagged(text: str | None, field: Field, memo: Emissions) -> tuple[list[int], np.ndarray, int]:
    tokens = text.split() if text else []
    found = list(map(memo.__getitem__, tokens))
    at = [i for i, e in enumerate(found) if e is not None] if {*found} - {None} else []
    return at, field.marginals(at, [found[i] for i in at], len(tokens)) if at else np.empty(0), len(tokens)


def _summary(p: np.ndarray) -> tuple[float, float]:
    return (float(p.max()), math.log1p(float(p.sum()))) if len(p) else (0.0, 0.0)


def fit_curve(rows: np.ndarray, rounds: int = 60, decay: float = 1e-4) -> np.ndarray:
    """Weighted logistic regression by Newton steps, each halved until it helps. rows: y, weight, inputs."""
    y, weight, x = rows[:, 0], rows[:, 1] / rows[:, 1].sum(), np.column_stack([np.ones(len(rows)), rows[:, 2:]])
    loss = lambda b: weight @ np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ b)) + decay / 2 * b @ b
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = logistic(x @ beta)
        slope = x.T @ (weight * (y - p)) - decay * beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(beta)), slope)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[Field, np.ndarray] | None:
    sample, share, full = labelled_sample(docs, labels, label)
    names = learn_features(sample)
    if not names:
        return None
    part = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(1)), 1) / F.lit(float(2**63))
    few = sample.where(part < F.when(F.col("y") == 1, min(1.0, FIELD_SAMPLE / TOXIC_SAMPLE)).otherwise(min(1.0, FIELD_SAMPLE / CLEAN_SAMPLE)) / (F.when(F.col("y") == 1, full[1]).otherwise(full[0])))
    field = train_field(training_sequences(few, names), names)

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Emissions(field.weights)
        for f in frames:
            got = [_summary(_tagged(t, field, memo)[1]) for t in f["text"]]
            yield pd.DataFrame({"y": f["y"].astype(float), "m": [a for a, _ in got], "k": [b for _, b in got]})

    rows = map_frames(sample, summed, "y double, m double, k double").toPandas().to_numpy()  # the bounded sample
    return field, fit_curve(np.column_stack([rows[:, 0], np.where(rows[:, 0] > 0, 1 / share[1], 1 / share[0]), rows[:, 1:]]))


def score(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start:end in code points) of every row of docs.

    held_out: by doc_id; texts and labels of such rows teach nothing, not even how many there are.
    """
    with small_batches(docs.sparkSession):
        model = fit(docs.where(~held_out), labels.where(~held_out), label)
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = "doc_id string, held_out boolean, score double, predicted int, spans string"

    def tag(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, beta = model or (None, None)
        memo = Emissions(field.weights) if field else None
        for f in chunks(frames, "text"):
            out = []
            for text in f["text"]:
                if field is None:
                    out.append((0.0, 0, ""))
                    continue
                at, p, _ = _tagged(text, field, memo)
                value = float(logistic(beta @ [1.0, *_summary(p)]))
                bad = {i for i, x in zip(at, p, strict=True) if x >= 0.5}
                spans = ",".join(f"{m.start()}:{m.end()}" for i, m in enumerate(re.finditer(r"\S+", text)) if i in bad) if bad else ""
                out.append((value, int(value >= 0.5), spans))
            made = pd.DataFrame(out, columns=["score", "predicted", "spans"])
            yield made.assign(doc_id=f["doc_id"].to_numpy(object), held_out=f["held_out"].to_numpy())

    safe = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_frames(safe, tag, schema).withColumn("doc_id", F.col("doc_id").cast(key))
