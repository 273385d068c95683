"""License scans: a generalised suffix automaton of template words, then chained matches.

The automaton accepts every run of words of every template. A text's words are streamed through it,
which gives for each place the longest template run that ends there (matching statistics). Maximal
runs of MIN_MATCH words or more are chained, in template order and with small gaps on both sides,
into spans; a template whose words a chain covers well enough gives its label. The best chain is taken
with all matches that share words with it, and what is left is chained again, so that each place of a
notice gives its own span. Only stretches whose
neighbouring words are neighbours in some template can hold such runs, so only they are streamed.

Defined cases: A-Z is lower-cased, words are runs of 0-9, a-z and everything beyond ASCII; a null
text counts as empty; empty texts have no words and no labels; overlapping places of a phrase all
count; very long texts are scanned whole, by themselves; repeated rows are scanned alike; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache
from itertools import repeat
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_frames

MIN_MATCH = 4
#: Words that may lie between two chained matches, in the text and in the template.
GAP = 8
#: Share of a template's words that a chain must cover.
COVERAGE = 0.6

# The phrases of the base result and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices as published with the licenses.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "gpl-3": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "mpl-2": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}

# Whole licenses, the file's name is the label; where the text names a holder, from the grant on.
FULL_TEXTS = Path(__file__).parent / "licenses"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Match(NamedTuple):
    start: int  # in the text, in words
    template: int
    at: int  # in the template
    length: int


class SuffixAutomaton:
    """Of several word sequences. After a run of words, ends() tells where in which templates it stands."""

    def __init__(self, templates: list[list[int]]) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.own: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate(templates):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                self.own[last].append((k, i))
        # a run stands wherever the runs that it is a suffix of stand
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.own[self.link[state]] += self.own[state]
        self.own = [sorted(set(x)) for x in self.own]

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.own.append([])
        return len(self.step) - 1

    def _split(self, before: int, state: int, word: int) -> int:
        """The state for state's runs that end `before` and then the word, set apart from longer ones."""
        if self.length[state] == self.length[before] + 1:
            return state
        apart = self._new(self.length[before] + 1, self.link[state], dict(self.step[state]))
        self.link[state] = apart
        while before >= 0 and self.step[before].get(word) == state:
            self.step[before][word] = apart
            before = self.link[before]
        return apart

    def _extend(self, last: int, word: int) -> int:
        if (there := self.step[last].get(word)) is not None:
            return self._split(last, there, word)
        new, at = self._new(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, self.step[at][word], word)
        return new

    def maximal_matches(self, sequence: list[int], least: int) -> list[Match]:
        """Longest template runs that can't be continued by the next word, of `least` words or more."""
        out, state, n = [], 0, 0
        for i, word in enumerate([*sequence, -2]):
            if word not in self.step[state] and n >= least:
                out += [Match(i - n, k, e - n + 1, n) for k, e in self.own[state]]
            while state and word not in self.step[state]:
                state = self.link[state]
                n = self.length[state]
            if word in self.step[state]:
                state, n = self.step[state][word], n + 1
        return out


def _chained(ordered: list[Match], gap: int) -> list[tuple[int, int, int]]:
    """For each match (in order of start) the best chain that ends with it, as in chains()."""
    best: list[tuple[int, int, int]] = []
    reach = gap + max(m.length for m in ordered)
    for i, m in enumerate(ordered):
        top = (m.length, m.start, m.start + m.length)
        for j in range(i - 1, -1, -1):
            before = ordered[j]
            if m.start - before.start > reach:
                break
            text, template = m.start - before.start - before.length, m.at - before.at - before.length
            shared = max(0, -text, -template)
            if m.start > before.start and m.at > before.at and max(text, template) <= gap and shared < m.length:
                top = max(top, (best[j][0] + m.length - shared, best[j][1], m.start + m.length))
        best.append(top)
    return best


def chains(matches: list[Match], least: float, gap: int = GAP) -> list[tuple[int, int, int]]:
    """(template words covered, first word, end word) of chains of one template's matches that share no words.

    The best chain comes first, whatever it covers; then the best of what is left, and so on, while
    they cover `least` words.
    """
    out: list[tuple[int, int, int]] = []
    taken: list[tuple[int, int]] = []

    def free(first: int, end: int) -> bool:
        k = bisect_left(taken, (end, end))
        return not k or taken[k - 1][1] <= first

    left = sorted(matches)
    while left:
        best = _chained(left, gap)
        for k in sorted(range(len(left)), key=best.__getitem__, reverse=True):
            covered, first, end = best[k]
            if out and covered < least:
                break
            if free(first, end):
                out.append(best[k])
                insort(taken, (first, end))
            elif free(left[k].start, left[k].start + left[k].length):
                break  # its match is left, but not all of its chain: chained again
        else:
            return out
        if out and covered < least:
            return out
        left = [m for m in left if free(m.start, m.start + m.length)]
    return out


class Scanner:
    def __init__(self) -> None:
        full = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(FULL_TEXTS.glob("*.txt"))]
        texts = [(label, t) for label, own in TEMPLATES.items() for t in own] + full
        self.labels = [label for label, _ in texts]
        templates = [words(t) for _, t in texts]
        phrases = [p.encode().split() for p in PHRASES]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in (*templates, *phrases) for w in t}))}
        ids = lambda t: [self.vocabulary[w] for w in t]
        self.templates, self.phrases = [ids(t) for t in templates], [(ids(p), label) for p, label in zip(phrases, PHRASES.values(), strict=True)]
        self.automaton = SuffixAutomaton(self.templates)
        # a last row and column for words that no template has
        self.pair = np.zeros((len(self.vocabulary) + 1,) * 2, bool)
        for t in self.templates:
            self.pair[t[:-1], t[1:]] = True

    def scan(self, texts: list[str | None]) -> list[tuple]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of each text."""
        unknown = len(self.vocabulary)
        parts, bounds = [], [0]
        for t in texts:
            w = words(t)
            parts.append(np.fromiter(map(self.vocabulary.get, w, repeat(unknown)), np.int32, len(w)))
            parts.append(np.array([unknown], np.int32))  # nothing runs on into the next text
            bounds.append(bounds[-1] + len(w) + 1)
        flat, ends = np.concatenate(parts) if parts else np.empty(0, np.int32), np.array(bounds)
        base: list[list[tuple[int, str]]] = [[] for _ in texts]
        for phrase, label in self.phrases:
            hit = np.ones(max(0, len(flat) - len(phrase) + 1), bool)
            for k, w in enumerate(phrase):
                hit &= flat[k : k + len(hit)] == w
            for i in np.flatnonzero(hit):
                doc = int(np.searchsorted(ends, i, side="right")) - 1
                base[doc].append((int(i) - bounds[doc], label))
        found: dict[int, list[Match]] = {}
        near = np.concatenate([[False], self.pair[flat[:-1], flat[1:]], [False]])
        turns = np.flatnonzero(near[1:] != near[:-1])
        for a, b in zip(turns[::2], turns[1::2], strict=True):  # pairs a..b-1 stand in templates
            if b - a + 1 >= MIN_MATCH:
                doc = int(np.searchsorted(ends, a, side="right")) - 1
                for m in self.automaton.maximal_matches(flat[a : b + 1].tolist(), MIN_MATCH):
                    found.setdefault(doc, []).append(m._replace(start=m.start + int(a) - bounds[doc]))
        out = []
        for d in range(len(texts)):
            starts, own = [s for s, _ in base[d]], {x for _, x in base[d]}
            labels, score, spans = set(own), float(bool(own)), []
            of_template: dict[int, list[Match]] = {}
            for m in found.get(d, ()):
                of_template.setdefault(m.template, []).append(m)
            for k in sorted(of_template):
                size, label = len(self.templates[k]), self.labels[k]
                own_chains = chains(of_template[k], COVERAGE * size)
                score = max(score, min(1.0, own_chains[0][0] / size))
                places = sorted((first, end) for covered, first, end in own_chains if covered / size >= COVERAGE)
                labels.update([label] * bool(places))
                spans += [f"{label}:{first}:{end}" for first, end in places]
            out.append((bounds[d + 1] - bounds[d] - 1, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), score, ",".join(spans)))
        return out


@cache
def scanner() -> Scanner:
    return Scanner()


def license_scan(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label:first:end, in words)."""
    key = df.schema["doc_id"].dataType.simpleString()
    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in chunks(frames, "text"):
            rows = pd.DataFrame(scanner().scan(f["text"].tolist()), columns=[x.split()[0] for x in schema.split(", ")])
            rows[["first_word", "last_word"]] = rows[["first_word", "last_word"]].astype("Int64")
            yield rows.assign(doc_id=f["doc_id"].to_numpy(object))

    safe = df.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = map_frames(safe, scan, f"doc_id string, {schema}")
    return out.withColumn("doc_id", F.col("doc_id").cast(key))
