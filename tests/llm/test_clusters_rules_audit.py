"""Centroid clustering, quality rules and the source divergence audit against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids, quality_rules, source_audit

# -- 11 -------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, v string, apex int, cluster int, label int"


def plain_clusters(rows, k=16, rounds=3, dims=64):
    """(vec_id, cluster, distance, cluster inertia, inertia, hash), sorted, by Python integers."""
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cs = [list(v) for _, v in sorted(kept, key=key)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[near(v)[1]].append(v)
        for j, vs in of.items():
            cs[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    sums = Counter()
    for _, j, d in out:
        sums[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, j, d, sums[j], sum(sums.values()), sha[j]) for i, j, d in out), key=str)


def vectors(n, clusters, dims=64, seed=5):
    r = np.random.default_rng(seed)
    at = r.normal(size=(clusters, dims))
    return [(i, (at[i % clusters] + 0.1 * r.normal(size=dims)).tolist()) for i in range(n)]


def found(df, **options):
    return sorted(map(tuple, centroids.cluster(df, **options).collect()), key=str)


def frame(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(i, e, "x", 1, 2, 3) for i, e in rows], schema)


def test_clusters_match_plain_integers(spark):
    rows = vectors(300, 7)
    bad = [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [math.nan] + [0.0] * 63), (905, [math.inf] + [0.0] * 63), (906, [-math.inf] * 64)]
    same = [(7, rows[7][1])] * 40 + [(None, rows[3][1]), (None, rows[9][1]), (500, [0.0] * 64), (501, [-0.0] * 64)]
    assert found(frame(spark, rows + bad + same)) == plain_clusters(rows + bad + same)
    assert found(frame(spark, rows + same), k=5, rounds=1, pivot_rounds=1) == plain_clusters(rows + same, 5, 1)


def test_clusters_of_few_equal_and_no_vectors(spark):
    few = vectors(5, 5)
    assert found(frame(spark, few)) == plain_clusters(few)
    equal = [(i, [0.5] * 64) for i in range(30)]
    assert found(frame(spark, equal)) == plain_clusters(equal)
    none = centroids.cluster(frame(spark, [(1, None)]))
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and none.count() == 0
    assert centroids.cluster(frame(spark, [])).count() == 0


def test_large_components(spark):
    most = [(i, [float(s * 2_000_000)] * 64) for i, s in enumerate((1, -1, 1, -1, 0))]
    assert found(frame(spark, most), k=2) == plain_clusters(most, 2)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(frame(spark, [(1, [1e300] * 64)]))


def test_bounds_enclose_distances_and_filter():
    x = np.floor(64 * np.array([e for _, e in vectors(2000, 40)])).astype(np.int64)
    simplex = centroids.Simplex(x[:20])
    assert len(simplex.pivots) == 20
    a = simplex.project(x)
    assert np.allclose(simplex.project(x, simplex.project(x)[:, :20]), a)
    far = np.sqrt(centroids.squared_distances(x, x[100:130]).astype(float))
    c = a[100:130]
    flat = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    low, high = (np.sqrt(flat + (a[:, None, -1] + s * c[None, :, -1]) ** 2) for s in (-1, 1))
    assert (low <= far + 1e-3).all() and (high >= far - 1e-3).all()
    best, d, measured = centroids.nearest(x, a, x[100:130], c)
    exact = centroids.squared_distances(x, x[100:130])
    assert (best == exact.argmin(axis=1)).all() and (d == exact.min(axis=1)).all()
    assert measured < 0.5 * exact.size


def test_pivots_in_the_span_of_others_are_left_out():
    x = np.zeros((5, 64), np.int64)
    x[1, 0], x[2, 0], x[3, 1] = 10, 30, 7  # the third lies on the line of the first two, the fifth equals the first
    assert centroids.Simplex(x).pivots.tolist() == x[[0, 1, 3]].tolist()


# -- 12 -------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, words string, kept int, n_words int"


def plain_rules(text, least=8):
    """Counts, verdicts, spans and maximal repeats by comparing all pairs of places."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines, seen, dup = t.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n, longest, cover, repeats = len(w), 0, set(), set()
    for a in range(n):
        for b in range(a + 1, n):
            k = 0
            while b + k < n and w[a + k] == w[b + k]:
                k += 1
            if k >= least:
                longest = max(longest, k)
                cover |= {*range(a, a + k), *range(b, b + k)}
                if a == 0 or w[a - 1] != w[b - 1]:
                    repeats.add(tuple(w[a : a + k]))
    chars = sum(map(len, w))
    failed = n < 20 or 100 * len(cover) > 30 * n
    kept = not failed and 100 * sum(len(w[i]) for i in cover) <= 30 * chars and longest <= 100
    return n, chars, len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), failed, kept, longest, len(repeats)


def test_rules_match_all_pairs_of_places():
    r = np.random.default_rng(3)
    texts = [" ".join(r.choice(list("ab"), r.integers(0, 60))) for _ in range(60)]
    texts += [" ".join(r.choice(["x", "yy", "é#é", "|", "w&"], r.integers(0, 120), p=[0.8, 0.05, 0.05, 0.05, 0.05])) for _ in range(40)]
    texts += ["a " * 150, None, "", " \n\t", "one", "a b c d e f g h " * 2, "\n".join(["p q r", "p q r", " ", " ", "p q r\r", "\x0b"] * 3), " x  x y\x1cz"]
    passage = [f"w{i}" for i in range(120)]
    texts.append(" ".join([*passage, *(f"u{i}" for i in range(900)), *passage]))  # under 30 % but one long repeat
    got = quality_rules.judged(texts)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "longest_repeat", "n_repeats"]
    assert list(got[columns].itertuples(index=False, name=None)) == [plain_rules(t) for t in texts]
    assert not got["kept"].iloc[-1] and not got["base_failed"].iloc[-1]
    assert got["repeat_spans"].iloc[-1] == [[0, 120], [1020, 1140]]
    alone = [quality_rules.judged([t]).iloc[0].to_dict() for t in texts]
    assert alone == [x.to_dict() for _, x in got.iterrows()]  # texts judged together don't meet


def odd_docs(spark):
    long = " ".join(f"n{i}" for i in range(60_000))
    rows = [(1, long), (2, None), (3, ""), (None, "a b " * 30), (5, long[:500]), (5, long[:500])]
    return spark.createDataFrame([(i, t, "en", "a", "x", 1, 2) for i, t in rows], DOCS)


def test_rules_of_odd_rows(spark):
    d = odd_docs(spark)
    got = {(r["doc_id"], r["n_words"]): r["kept"] for r in quality_rules.quality_report(d).collect()}
    assert got == {(1, 60_000): True, (2, 0): False, (3, 0): False, (None, 60): False, (5, len(long_words(500))): True}
    assert quality_rules.quality_report(d).count() == 6
    stays = quality_rules.quality_filter(d)
    assert stays.schema == d.schema and sorted(r["doc_id"] for r in stays.collect()) == [1, 5, 5]
    assert quality_rules.quality_report(d.limit(0)).count() == 0 and quality_rules.quality_filter(d.limit(0)).count() == 0


def long_words(chars):
    return " ".join(f"n{i}" for i in range(60_000))[:chars].split()


# -- 13 -------------------------------------------------------------------------------------------------


def plain_audit(rows, least=3, most=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))) for text, lang, source in rows]
    docs, groups = defaultdict(Counter), defaultdict(set)
    for lang, source, ts in terms:
        docs[lang].update(set(ts))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        count = {s: Counter() for s in sources}
        for g, s, ts in terms:
            if g == lang:
                count[s].update(t for t in ts if docs[lang][t] >= least)
        every = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        f = lambda p, q: (p - q) * (p - q) // q
        q = share(every)
        ps = {s: share(count[s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, f(ps[s][t], q[t])) for t in kept if count[s][t] and ps[s][t] > q[t]]
            for part, items, cap in (("pair", pairs, len(pairs)), ("term", own, most)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:cap]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def audit(spark, rows, **options):
    d = spark.createDataFrame([(i, t, g, s, "x", 1, 2) for i, (t, g, s) in enumerate(rows)], DOCS)
    return sorted(map(tuple, source_audit.divergence(d, **options).collect()))


def test_divergence_matches_plain_counts(spark):
    r = np.random.default_rng(8)
    words = ["The", "the", "tHe", "élan", "ÉLAN", "extraordinarily", "extraordinarilY", "extraordinary", "a", "ab", "日本語", "x1y", "don't", "z" * 40, "z" * 39 + "a"]
    rows = [(" ".join(r.choice(words, r.integers(0, 25))), r.choice(["en", "fr", "de"]), r.choice(["a", "b", "c", "d"])) for _ in range(150)]
    rows += [(None, "en", "a"), ("", None, None), ("the the", None, ""), ("...", "en", "only empty"), ("rare words", "xx", "s"), ("rare", "xx", "t"), ("alone alone", "yy", "s")]
    rows += [("the", "en", "hot")] * 60
    assert audit(spark, rows) == plain_audit(rows)
    assert audit(spark, rows, least_docs=1, most_terms=2) == plain_audit(rows, 1, 2)
    assert audit(spark, []) == []


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_slices_of_any_size_give_the_same_counts(spark, size):
    rows = [("Word word other " * 40 + "x" * 300, "en", "a"), ("word", "en", "a"), ("a-b_c\x00d", "en", "b"), ("é" * 20 + "!", "fr", "b"), (None, None, None)]
    d = spark.createDataFrame([(i, t, g, s, "x", 1, 2) for i, (t, g, s) in enumerate(rows)], DOCS).coalesce(1)
    got = {tuple(x)[:3]: tuple(x)[3:] for x in source_audit.term_counts(d, size).collect()}
    assert got == {
        ("en", "a", ""): (0, 2), ("en", "b", ""): (0, 1), ("fr", "b", ""): (0, 1), ("", "", ""): (0, 1),
        ("en", "a", "word"): (81, 2), ("en", "a", "other"): (40, 1), ("en", "a", "x" * 300): (1, 1),
        ("en", "b", "a"): (1, 1), ("en", "b", "b"): (1, 1), ("en", "b", "c"): (1, 1), ("en", "b", "d"): (1, 1), ("fr", "b", "é" * 20): (1, 1),
    }


def test_multikey_sort_is_a_stable_sort():
    r = np.random.default_rng(1)
    text = " ".join("".join(r.choice(list("ab"), r.integers(1, 30))) for _ in range(3000)) + " " + "ab" * 12 + " " + "ab" * 12
    data = np.frombuffer(text.encode(), np.uint8)
    start, length = source_audit.pointers(data)
    terms = text.split()
    group = r.integers(0, 3, len(terms))
    order, first = source_audit.multikey_sort(data, start, length, group)
    assert order.tolist() == sorted(range(len(terms)), key=lambda i: (group[i], terms[i]))
    key = [(group[i], terms[i]) for i in order]
    assert first.tolist() == [i == 0 or key[i] != key[i - 1] for i in range(len(key))]


def test_counts_are_exact_beyond_64_bits(spark):
    n, of = 9_000_000_000_000, 20_000_000_000_007
    row = spark.range(1).select(source_audit._share(F.lit(n), F.lit(of)).alias("p"), source_audit._gap(F.lit(1_000_000_000).cast("long"), F.lit(1).cast("long")).alias("f")).first()
    assert row["p"] == 1 + 10**9 * (n + 1) // of and row["f"] == (10**9 - 1) ** 2


# -- 8: very many spans in one text ------------------------------------------------------------------------


def test_a_hundred_thousand_spans_in_one_text(spark):
    """A row's work grows with its spans, not with pairs of them; rows that repeat stay apart."""
    import time

    from tidemark.llm import pii

    unit = "ann@ex.org 4111111111111111 (212) 555-0123 bob [at] ex.com "
    began = time.monotonic()
    rows = [(1, unit * 25_000), (2, unit * 2), (2, unit * 2), (None, "nothing here")]
    got = pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert time.monotonic() - began < 90
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 4 and by[None]["spans"] == "" and sum(r["doc_id"] == 2 for r in got) == 2
    assert (by[1]["n_email"], by[1]["n_card"], by[1]["n_phone"], by[1]["n_ip"]) == (25_000, 25_000, 0, 0)
    few = Counter(x.split(":")[0] for x in by[2]["spans"].split(","))
    assert Counter(x.split(":")[0] for x in by[1]["spans"].split(",")) == {k: 12_500 * n for k, n in few.items()}
    spans = [tuple(map(int, x.split(":")[1:])) for x in by[1]["spans"].split(",")]
    assert len(spans) == len(set(spans)) >= 50_000
