"""Each training-data operator against brute force on small tables with nulls, ties, repeats and extra columns."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, exact_dedup, language_id, license_scan, lm_score, mixing, near_dedup, packing, pii, queries, toxicity
from tidemark.llm.common import held_out

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, score double, place int"


def odd(spark):
    """Nulls in every column, empty texts, repeated rows, a long text, columns that clash with inner names."""
    long = "word " * 30_000
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 1, "x", 0.5, 1),
        (2, "Thequick brown fox jumps over the lazydog\n", "en", "a", 1, "x", 0.5, 1),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "", 0.0, 0),
        (5, " \t\n", "fr", "b", 0, "", 0.0, 0),
        (None, "call +1 (269) 555-3296 4524132264652876 or a.b@c.com", "en", "a", 1, "x", 0.5, 1),
        (7, long, "de", "a", 1, "x", 0.5, 1),
        (7, long, "de", "a", 1, "x", 0.5, 1),
        (8, "12345 !!", "en", "c", 1, "x", 0.5, 1),
        (9, "Released under the MIT License. under the mit license cc by nc " + "é" * 40, "fr", "c", 1, "x", 0.5, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- 1 --------------------------------------------------------------------------------------------------


def grams_of(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text or ""):
        w = "_" + "".join(c.lower() if len(c.lower()) == 1 else c for c in word) + "_"
        out.update(c for c in w[1:-1])
        out.update(w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1))
    return out


def top(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], len(kv[0]), kv[0]))[:size]]


def test_language_profiles_and_distance(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    rows = docs.collect()
    profiles = language_id.learn_profiles(docs, size=60)
    by_lang = defaultdict(Counter)
    for r in rows:
        by_lang[r["lang"]].update(grams_of(r["text"]))
    mine = {lang: top(c, 60) for lang, c in by_lang.items()}
    pack = lambda g: int(sum(ord(c) << (21 * k) for k, c in enumerate(reversed(g))))
    assert {k: [pack(g) for g in v] for k, v in mine.items()} == profiles
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, profiles, size=60).collect()}
    for r in rows:
        own = top(grams_of(r["text"]), 60)
        far = {lang: sum(abs(p.index(g) - i) if g in p else 60 for i, g in enumerate(own)) for lang, p in mine.items()}
        best = min(far, key=lambda x: (far[x], x))
        assert got[r["doc_id"]] == (best, pytest.approx(1 - far[best] / (60 * len(own))))


def test_language_of_odd_rows(spark):
    d = odd(spark)
    out = language_id.identify(d, language_id.learn_profiles(d)).collect()
    assert len(out) == 10 and {r["lang_pred"] for r in out if r["doc_id"] in (3, 4, 5, 8)} == {"und"}
    assert language_id.identify(empty(spark), {}).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(d, {}).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    out = queries.op1_language_id(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    assert out.where("lang_pred = lang").count() >= 0.95 * out.count()


# -- 2 --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("weights", [[1.0], [1, 1, 1], [0.7, 0.2, 0.1], [5, 3, 3, 1, 0.01]])
def test_schedule_deviates_less_than_a_block(weights):
    quota = mixing.whole_weights(weights)
    assert [q / sum(quota) for q in quota] == pytest.approx([w / sum(weights) for w in weights])
    assert mixing.max_deviation(quota) < 1
    for slot, (_, _, release, due) in enumerate(mixing.schedule(quota)):
        assert release <= slot < due


def test_schedule_equals_a_plain_earliest_deadline_first():
    quota = mixing.whole_weights([0.55, 0.25, 0.125, 0.075])
    period, done, want = sum(quota), [0] * 4, []
    for slot in range(period):
        due = {s: -(-(i + 1) * period // quota[s]) for s, i in enumerate(done) if i < quota[s] and i * period // quota[s] <= slot}
        s = min(due, key=lambda x: (due[x], x))
        want.append((s, done[s]))
        done[s] += 1
    assert [(s, i) for s, i, _, _ in mixing.schedule(quota)] == want


def test_mixing_of_many_sources_and_null_ids(spark):
    d = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), (F.col("id") % 4500).cast("string").alias("source"))
    out = mixing.mix_sources(d, {str(i): 1 for i in range(4500)}).toPandas()
    assert len(out) == 9000 and out.doc_id.isna().sum() == 3000
    assert out.groupby(["mix_slot", "mix_place"]).size().max() == 1 and sorted(out.mix_slot.unique()) == list(range(4500))


def test_mixing_keeps_to_the_target_weights(spark):
    weights = [0.9, 0.05, 0.03, 0.01, 0.005, 0.003, 0.001, 0.001]
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("array_position(transform(array(3600, 3800, 3920, 3960, 3980, 3992, 3996, 4000), x -> id < x), true)").cast("string").alias("source"))
    out = mixing.mix_sources(d, {str(i + 1): w for i, w in enumerate(weights)}, block_rows=1).toPandas()
    order = out.sort_values("mix_slot").source.astype(int).to_numpy()
    had = np.cumsum(order[:, None] == np.arange(1, 9), axis=0)
    assert len(order) == 4000 and (out.mix_phase == 0).all() and sorted(out.mix_slot) == list(range(4000))
    assert np.abs(had - np.outer(np.arange(1, 4001), weights)).max() < 1
    for odd_weights in ([1e6, 1, 1 / 3], [n**0.7 for n in (1_000_003, 977, 12, 1)]):  # far longer periods than slots
        assert mixing.max_deviation(mixing.whole_weights(odd_weights), 3000) < 1


def test_mixing_places_every_row_once(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 100, None).otherwise((F.col("id") % 7).cast("string")).alias("source"), F.lit(9).alias("t"))
    out = mixing.mix_sources(d, block_rows=16).toPandas()
    assert len(out) == 3000 and sorted(out.doc_id) == list(range(3000)) and (out.t == 9).all()
    assert out.groupby(["mix_slot", "mix_place"]).size().max() == 1
    slots = out.groupby("mix_slot").source.nunique(dropna=False)
    assert slots.max() == 1 and sorted(slots.index) == list(range(len(slots)))
    sizes = out.groupby([out.source.fillna("?"), "mix_block"]).size()
    assert all((g.iloc[:-1] == 16).all() for _, g in sizes.groupby(level=0))
    assert ((out.mix_slot >= out.mix_release) & (out.mix_slot < out.mix_deadline)).all()
    assert mixing.mix_sources(odd(spark)).count() == 10 and mixing.mix_sources(empty(spark)).count() == 0
    assert mixing.mixed(odd(spark)).columns == odd(spark).columns


# -- 3 --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("counters", [2, 4096])
def test_exact_dedup(spark, counters):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(docs.collect()):
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(bare.encode()).hexdigest()].append((-len(text or ""), doc is None, doc or 0, i, doc))
    want = Counter((x[4], min(g)[4], len(g), sha) for sha, g in groups.items() for x in g)
    out = exact_dedup.exact_dedup_report(docs, counters).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    assert sum(r["kept"] for r in out) == len(groups)
    kept = exact_dedup.exact_dedup(odd(spark), counters)
    assert kept.columns == odd(spark).columns and kept.count() == 6
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_repeated_rows_of_a_frequent_text_keep_one(spark):
    d = spark.range(3000, numPartitions=8).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot  text")).when(F.col("id") % 3 == 1, F.lit("hottext")).otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.exact_dedup_report(d, 16).toPandas()
    hot = out[out.group_size == 2000]
    assert len(out) == 3000 and len(hot) == 2000 and hot.kept.sum() == 1 and (hot.keep_id == 5).all() and hot[hot.kept].doc_id.tolist() == [5]
    assert out[out.group_size == 1].kept.all() and len(out[out.group_size == 1]) == 1000
    for rows, left in ((d, 1001), (d.where("id % 3 > 0 or id = 0"), 1001)):  # with and without repeated winners
        kept = exact_dedup.exact_dedup(rows, 16)
        assert kept.count() == left and kept.where("text like 'hot %'").count() == 1


# -- 4 --------------------------------------------------------------------------------------------------


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    bad = [(-1, None), (-2, [0.0] * 64), (-3, [float("nan")] * 64), (-4, [None] * 64), (-5, [1.0] * 3), (None, [1.0] * 64)]
    d = rows.unionByName(spark.createDataFrame(bad, "vec_id long, embedding array<float>")).withColumn("list", F.lit(1))
    out = ann.search(d, F.col("vec_id") % 20 == 0, k=20).toPandas()
    p = rows.toPandas()
    x, ids = np.stack(p.embedding).astype(float), p.vec_id.to_numpy()
    found = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        s[i] = -np.inf
        want = np.lexsort((ids, -s))[:20]
        got = out[out.query_id == ids[i]].sort_values("rank")
        assert list(got["rank"]) == list(range(1, 21)) and np.allclose(got.score, [s[list(ids).index(v)] for v in got.vec_id], atol=1e-12)
        found += len({*ids[want]} & {*got.vec_id})
    assert found >= 0.9 * 20 * (ids % 20 == 0).sum()
    assert ann.search(d.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.search(rows.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_neighbours_of_repeated_ids(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(101, 8))
    x[1] = 3 * x[0]  # the nearest, many times, and with a second vector
    rows = [(i, v.tolist(), i == 0) for i, v in enumerate(x)] + [(1, x[1].tolist(), False)] * 40 + [(1, (x[1] + [9, *[0] * 7]).tolist(), False), (0, x[0].tolist(), True), (1, None, False)]
    out = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, own boolean"), F.col("own"), k=20).toPandas()
    s = x @ x[0]
    s[0] = -np.inf
    want = np.lexsort((np.arange(101), -s))[:20]
    assert list(out.sort_values("rank").vec_id) == list(want) and np.allclose(out.sort_values("rank").score, s[want])
    (ids, _), = ann.best_of_page(x[:1], np.array([0]), np.vstack([x, x[[1] * 30]]), np.array([*range(101), *[1] * 30]), 20)
    assert list(ids) == list(want)


def test_ties_of_neighbours_go_to_the_smaller_id(spark):
    x = [[1.0, 0.0]] * 30 + [[0.5, 0.5]] * 5
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>").withColumn("cell", F.lit("x")).withColumn("page", F.lit(2))
    out = ann.search(d.union(d), F.col("vec_id") == 3, k=20).toPandas().sort_values("rank")
    assert out.vec_id.tolist() == [i for i in range(22) if i != 3][:20] and (out.score == 1).all()


def test_graph_search_stops_and_finds():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 6))
    graph, q = ann.CentroidGraph(x), rng.normal(size=(50, 6))
    far = np.sqrt(((q[:, None] - x) ** 2).sum(axis=2))
    lists, d = graph.search(q, 4)
    assert np.isfinite(d).sum(axis=1).mean() < 250  # not all are looked at
    assert (lists[:, 0] == far.argmin(axis=1)).mean() > 0.95
    row, at = ann.probes(graph, q, 1.3)
    want = [{*np.flatnonzero(far[i] <= 1.3 * far[i].min()), *np.argsort(far[i])[:2]} for i in range(50)]
    found = [{*at[row == i]} for i in range(50)]
    assert sum(len(a & b) for a, b in zip(want, found, strict=True)) >= 0.95 * sum(map(len, want))


def test_long_lists_are_split_into_cells(spark, monkeypatch):
    for name, value in (("MOST_LISTS", 4), ("PAGE", 64), ("CELL_ROWS", 40), ("TOGETHER", 100)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 8))
    x = np.vstack([centres[rng.integers(0, 12, 1500)] + 0.2 * rng.normal(size=(1500, 8)), np.tile(centres[:1], (500, 1))])  # a quarter equal
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.search(d, F.col("vec_id") % 20 == 0, k=10).toPandas()
    found = 0
    for i in range(0, 2000, 20):
        s = (x * x[i]).sum(axis=1)
        s[i] = -np.inf
        got = out[out.query_id == i].sort_values("rank")
        assert len(got) == 10 and got.vec_id.is_unique and np.allclose(got.score, s[got.vec_id])
        found += (got.score.to_numpy() >= np.sort(s)[-10] - 1e-9).sum()
    assert found >= 0.9 * 1000


# -- 5 --------------------------------------------------------------------------------------------------


def test_field_equals_enumeration():
    field = toxicity.Field(["=x"], np.array([2.0]), np.array([-1.0, 0.3, -0.5, 0.2, 0.8]))
    n, at, emission = 6, [1, 4], [2.0, 0.7]
    e = [-1.0 + dict(zip(at, emission, strict=True)).get(i, 0.0) for i in range(n)]
    move = [[0.0, -0.5], [0.2, 0.8]]
    total, toxic = 0.0, [0.0] * n
    for code in range(2**n):
        s = [code >> i & 1 for i in range(n)]
        w = math.exp(0.3 * s[0] + sum(e[i] * s[i] for i in range(n)) + sum(move[a][b] for a, b in zip(s, s[1:], strict=False)))
        total += w
        for i in range(n):
            toxic[i] += w * s[i]
    assert field.marginals(at, emission, n) == pytest.approx([toxic[i] / total for i in at])


def test_toxicity_learns_words(spark):
    docs = spark.createDataFrame([(i, f"some plain words {i} here " + ("you utter grumbler! " if i % 4 == 0 else "dear friend ") + f"end {i}") for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")).unionByName(spark.createDataFrame([(1, None)], "doc_id long, toxic int"))
    out = toxicity.score(docs, labels, held_out("doc_id", 5, 0)).toPandas()
    assert ((out.doc_id % 4 == 0) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    assert out[out.doc_id == 0].spans.iloc[0]
    assert toxicity.score(odd(spark), labels.limit(0), held_out("doc_id", 5, 0)).where("score = 0").count() == 10
    assert toxicity.score(empty(spark), labels, held_out("doc_id", 5, 0)).count() == 0


def test_scores_and_spans_equal_a_dense_chain(spark):
    rows = [(i, f"some  plain words {i} here " + ("you utter grumbler! grumbling again " * (1 + i % 2) if i % 4 == 0 else "dear friend ") + "the end " * (i % 7)) for i in range(300)]
    rows += rows[:3] + [(1000, None), (1001, ""), (1002, "grumbler " * 5000), (None, "you grumbler")]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, spans string, y double")
    labels = docs.where("doc_id < 300").select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    out = held_out("doc_id", 5, 0)
    field, beta = toxicity.fit(docs.where(~out), labels.where(~out))
    want = Counter()
    for doc, text in rows:
        places = list(re.finditer(r"\S+", text or ""))
        found = [[field.weights[f] for f in toxicity.features(m[0]) if f in field.weights] for m in places]
        p = np.zeros(len(places))
        if any(found):
            own = np.array([[1.0, math.exp(field.bias + sum(f))] for f in found])
            a, b = np.empty_like(own), np.ones_like(own)
            a[0] = own[0] * [1.0, math.exp(field.start)]
            for i in range(1, len(own)):
                a[i] = (a[i - 1] / a[i - 1].sum()) @ field.move * own[i]
            for i in range(len(own) - 2, -1, -1):
                b[i] = field.move @ (own[i + 1] * b[i + 1] / b[i + 1].sum())
            p = (a * b)[:, 1] / (a * b).sum(axis=1)
        marked = [i for i, f in enumerate(found) if f]
        q = p[marked]
        value = 1 / (1 + math.exp(-(beta @ ([1.0, q.max(), math.log1p(q.sum())] if len(q) else [1.0, 0.0, 0.0]))))
        want[doc, round(value, 6), int(value >= 0.5), ",".join(f"{places[i].start()}:{places[i].end()}" for i in marked if p[i] >= 0.5)] += 1
    got = toxicity.score(docs, labels, out).collect()
    assert Counter((r["doc_id"], round(r["score"], 6), r["predicted"], r["spans"]) for r in got) == want
    assert {r["predicted"] for r in got if r["doc_id"] in (0, 4, 1002, None)} == {1} and {r["predicted"] for r in got if r["doc_id"] in (1, 1000, 1001)} == {0}


def test_held_out_labels_teach_nothing(spark, monkeypatch):
    for name, most in (("TOXIC_SAMPLE", 60), ("CLEAN_SAMPLE", 80), ("FIELD_SAMPLE", 20)):
        monkeypatch.setattr(toxicity, name, most)
    docs = spark.createDataFrame([(i, f"some plain words {i} here " + ("you utter grumbler! " if i % 4 == 0 else "dear friend ") * (1 + i % 3)) for i in range(800)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    out = held_out("doc_id", 5, 0)
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b, c = (sorted(map(tuple, toxicity.score(docs, x, out).collect())) for x in (labels, flipped, labels.where(~out)))
    assert a == b == c and {r[3] for r in a} == {0, 1}


def test_curve_of_separable_and_huge_inputs():
    rows = np.array([[float(i > 5), 1.0, float(i > 5), 900.0 * (i > 5)] for i in range(12)])
    beta = toxicity.fit_curve(rows)
    p = toxicity.logistic(np.column_stack([np.ones(12), rows[:, 2:]]) @ beta)
    assert np.isfinite(beta).all() and (p[:6] < 0.1).all() and (p[6:] > 0.9).all()
    assert toxicity.logistic(np.array([-1e9, 1e9])).tolist() == pytest.approx([0, 1])


# -- 6 --------------------------------------------------------------------------------------------------


def test_suffix_automaton_matches():
    rng = np.random.default_rng(3)
    templates = [rng.integers(0, 4, 12).tolist() for _ in range(3)]
    sa = license_scan.SuffixAutomaton(templates)
    text = rng.integers(0, 4, 200).tolist()
    got = {(m.start, m.length) for m in sa.maximal_matches(text, 3)}
    inside = lambda s: any(t[i : i + len(s)] == s for t in templates for i in range(len(t) - len(s) + 1))
    longest = [max((n for n in range(13) if i + 1 >= n and inside(text[i + 1 - n : i + 1])), default=0) for i in range(len(text))]
    want = {(i + 1 - n, n) for i, n in enumerate(longest) if n >= 3 and (i + 1 == len(text) or longest[i + 1] <= n)}
    assert got == want
    for m in sa.maximal_matches(text, 3):
        assert text[m.start : m.start + m.length] == templates[m.template][m.at : m.at + m.length]


def test_license_scan(spark):
    got = {r["doc_id"]: r for r in license_scan.license_scan(odd(spark)).collect()}
    r = got[9]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (3, 1, 9, "cc-by-nc,mit") and r["score"] == 1
    assert got[3]["n_words"] == 0 and got[3]["first_word"] is None and got[3]["labels"] == ""
    gpl = spark.createDataFrame([(1, "This work is licensed under the GNU General Public License, version 3.")], "doc_id long, text string")
    assert license_scan.license_scan(gpl).first()["labels"] == "gpl-3" and license_scan.license_scan(empty(spark)).count() == 0


def test_phrases_of_the_base_equal_a_plain_reading(spark):
    extra = ["under the MIT license under the mit license", "Apache License, Version 2.0", "under the mit licenses cc-by-nc CC BY NC cc by nc", "üunder the mit license", None, ""]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(extra)], "doc_id long, text string")).withColumn("labels", F.lit("x"))
    got = {r["doc_id"]: r for r in license_scan.license_scan(docs).collect()}
    hits = 0
    for doc, text in docs.select("doc_id", "text").collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        r, at = got[doc], [i for i, _ in places]
        hits += len(at)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert {*r["base_labels"].split(",")} - {""} <= {*r["labels"].split(",")} and 0 <= r["score"] <= 1
    assert hits > 5


def test_every_place_of_a_notice_is_a_span(spark):
    mpl = license_scan.TEMPLATES["mpl-2"][0]
    n = len(license_scan.words(mpl))
    cut = " ".join(mpl.split()[:11])  # enough of it
    texts = {1: f"{mpl} {mpl}", 2: f"{mpl} " + "other words " * 50 + mpl + " then " + cut, 3: f"{mpl} " * 2000}
    got = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame([*texts.items()], "doc_id long, text string")).collect()}
    assert got[1]["spans"] == f"mpl-2:0:{n},mpl-2:{n}:{2 * n}"
    assert got[2]["spans"] == f"mpl-2:0:{n},mpl-2:{n + 100}:{2 * n + 100},mpl-2:{2 * n + 101}:{2 * n + 112}"
    assert got[3]["spans"].split(",") == [f"mpl-2:{k * n}:{k * n + n}" for k in range(2000)]
    assert all(r["labels"] == "mpl-2" and r["score"] == 1 for r in got.values())
    many = license_scan.scanner().scan([f"{mpl} " * 20_000])[0]
    assert len(many[-1].split(",")) == 20_000


def test_whole_licenses_are_one_span(spark):
    texts = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(license_scan.FULL_TEXTS.glob("*.txt"))]
    docs = spark.createDataFrame([(label, "some words before " + t + " and after") for label, t in texts], "doc_id string, text string")
    got = {r["doc_id"]: r for r in license_scan.license_scan(docs).collect()}
    assert len(texts) == 6
    for label, t in texts:
        assert f"{label}:3:{3 + len(license_scan.words(t))}" in got[label]["spans"].split(",") and got[label]["score"] == 1


# -- 7 --------------------------------------------------------------------------------------------------


def test_packing_round_trip(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text").where("doc_id is not null and doc_id <> 7").withColumn("doc_id", -F.col("doc_id")))
    docs = docs.unionByName(spark.createDataFrame([(-100, "two  spaces \n\n tabs\t\there <|endoftext|> it's x "), (-101, " lead and trail "), (-102, "a <|endoftext|> b"), (-103, "<|endoftext|><|endoftext|>x <|endof text|>")], "doc_id long, text string"))
    p = packing.pack_documents(docs, with_ids=True).toPandas()
    for doc, text in docs.collect():
        ids = np.array([*tk.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = p[p.doc_id == doc].sort_values("piece")
        assert np.array_equal(np.frombuffer(b"".join(own.ids), "<u4"), ids)
        assert list(own.ids_crc32) == [zlib.crc32(x) for x in own.ids] and (own.length.iloc[1:] == 1024).all()
    q = p.sort_values(["sequence_id", "offset"])
    assert (q.offset == q.groupby("sequence_id").length.cumsum() - q.length).all() and q.groupby("sequence_id").length.sum().max() <= 1024
    assert p.sequence_id.nunique() <= math.ceil(p.length.sum() / 1024) * 1.02 + 1
    assert p[p.doc_id == -102].length.tolist() == [5] and np.frombuffer(p[p.doc_id == -102].ids.iloc[0], "<u4").tolist() == [64, 220, 50256, 275, 2]
    o = packing.pack_documents(odd(spark)).toPandas()
    assert o.doc_id.isna().sum() == 1 and packing.pack_documents(empty(spark)).count() == 0
    # repeated rows are packed each
    assert o[o.doc_id == 7].piece.value_counts().unique().tolist() == [2] and not o.duplicated(["sequence_id", "offset"]).any()


def test_ids_are_the_vocabularys_whatever_the_white_space():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tk, encode, rng = Tokenizer.from_file(P.path("byte_bpe_50k.json")), packing.encoder(), np.random.default_rng(12)
    parts = [*" \n\t\r\x0b\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200b'.-7é😀", "'s", "'ll", "word", "Ñandú", "don't", "12", "<|endoftext|>", "<|end"]
    for k in range(4_000):
        some = rng.choice(parts, rng.integers(1, 14))
        text = "".join(some) if k % 2 else "".join(f"{x}{'x1.'[i % 3]}" for i, x in enumerate(some))  # every second one: no two spaces meet
        assert np.frombuffer(encode(text), "<u4").tolist() == tk.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_words_cost_no_more_than_known_ones():
    import public_tokenizers as P
    import tiktoken

    rng, path = np.random.default_rng(13), P.path("byte_bpe_50k.json")
    plain, encode = tiktoken.Encoding("rule", pat_str=packing.PATTERN, mergeable_ranks=packing._ranks(path), special_tokens={}).encode_ordinary, packing.encoder()
    spent = {plain: [], encode: []}
    for _ in range(3):
        texts = [" ".join("".join(map(chr, rng.integers(97, 123, n))) + "," for n in rng.integers(4, 9, 400)) for _ in range(200)]
        for fn, seconds in spent.items():
            t = time.process_time()
            for x in texts:
                fn(x)
            seconds.append(time.process_time() - t)
    assert min(spent[encode]) < min(spent[plain]), spent


def test_sequences_follow_the_order_of_documents(spark):
    rng = np.random.default_rng(6)
    cut = spark.createDataFrame([(i, 0, int(n), i) for i, n in enumerate(rng.integers(1, 1025, 6000))], "doc_id long, piece int, length long, place long")
    p = packing.pack(cut).toPandas()
    assert len(p) == 6000 and p.doc_id.nunique() == 6000 and not p.duplicated(["sequence_id", "offset"]).any()
    assert p.groupby("sequence_id").doc_id.min().is_monotonic_increasing and p.doc_id.corr(p.sequence_id) > 0.7
    assert packing.pack(cut.drop("place")).toPandas().sequence_id.nunique() == p.sequence_id.nunique()


def test_equal_pieces_are_fixed_together():
    counts = np.zeros(1025, np.int64)
    counts[[500, 520, 200, 250]] = 40_000
    assert len(packing.plan(counts)) < 20


def fewest(lengths, capacity):
    best = len(lengths)

    def go(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        w, *more = rest
        for r in {x for x in rooms if x >= w}:
            left = list(rooms)
            left.remove(r)
            go(more, [*left, r - w])
        go(more, [*rooms, capacity - w])

    go(sorted(lengths, reverse=True), [])
    return best


def test_dominance_keeps_the_optimum():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(1, 21, 8).tolist()
        counts = np.bincount(lengths, minlength=21)
        rest = counts.astype(np.int64).copy()
        fixed = packing.dominated(rest)
        left = [w for w in range(21) for _ in range(rest[w])]
        assert sum(n for _, n in fixed) + fewest(left, 20) == fewest(lengths, 20)
        whole = packing.plan(counts)
        assert Counter(w for held, n in whole for w, k in held for _ in range(k * n)) == Counter(lengths)
        assert all(sum(w * k for w, k in held) <= 20 for held, _ in whole)


# -- 8 --------------------------------------------------------------------------------------------------


def luhn(x):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(x))) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
]


def test_pii(spark):
    hard = ["a@b.com_x@c.de a@b.co.x-y@z.com", "1.2.3.4.5 999.1.1.1 01.2.3.255 12.34.56", "4111 1111 1111 1111-x 4111-1111-1111-1112", "é😀 +44 (0) 20 7946 0018, +1 2", "x" * 20_000 + "@", "1" * 5_000, "@".join("a" * 300), *("é jo@ex.com 10.1.2.3 " * n for n in (63, 64, 65, 128, 3_000))]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(hard)], "doc_id long, text string")).unionByName(odd(spark).select("doc_id", "text").where("doc_id is null or doc_id = 3"))
    got = {r["doc_id"]: r for r in pii.scan(docs).collect()}
    for doc, text in docs.where("doc_id is not null").collect():
        spans = [(k, f"{k}:{m.start()}:{m.end()}") for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]
        r = got[doc]
        assert {k: r[f"n_{k}"] for k, _, _ in BASE} == {k: sum(x == k for x, _ in spans) for k, _, _ in BASE}
        assert r["base_sha256"] == hashlib.sha256(",".join(s for _, s in spans).encode()).hexdigest()
        assert {s for _, s in spans} <= {*r["spans"].split(",")}
    assert pii.scan(empty(spark)).count() == 0
    clash = docs.limit(20).withColumns({"spans": F.lit(1), "base": F.lit("x"), "more": F.lit(2), "s": F.lit(3)})
    assert sorted(map(tuple, pii.scan(clash).collect()), key=str) == sorted(map(tuple, pii.scan(docs.limit(20)).collect()), key=str)
    plan = pii.candidates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_added_spans_equal_a_plain_reading(spark):
    import regex

    extra = ["write to jo [at] site [dot] com or ann@x.org", "card 4111 1111 1111 1111 2 and 4111111111111111", "4111-1111-1111-1111 now", "call (555) 123-4567 or 555-123-4567 or +1 555 123 4567 x", "tel 020.123.4567; no 12-34", "a@b.de 10.0.0.1 555.123.4567.89", ""]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    rows = docs.collect()
    digits = lambda x: re.sub(r"[^0-9]", "", x)
    valid = {"email": lambda m: len(m) <= 254, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")), "card": lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda m: 9 <= len(digits(m)) <= 15}

    def seen(kind, pattern, text):
        end = 0
        for m in regex.finditer(pattern, text):
            before, after = text[end : m.start()][-pii.BEFORE :], text[m.end() : m.end() + 1]
            end = m.end()
            says = [regex.search(pii.FORM[kind], m[0]), valid[kind](m[0]), regex.search(pii.GAZETTEER[kind], m[0]), regex.search(pii.CUES[kind], before), not regex.search(r"[\p{L}0-9]", before[-1:]) and not regex.search(r"[\p{L}0-9]", after)]
            yield m.start(), m.end(), sum(bool(v) << k for k, v in enumerate(says)), min(3, (m.end() - m.start()) // 8)

    base, more, patterns = {}, {}, Counter()
    for doc, text in rows:
        own, new = [], []
        for k, kind in enumerate(pii.KINDS):
            found = list(seen(kind, pii.BASE[kind], text or ""))
            own += [(k, *s) for s in found if kind == "email" or s[2] & pii.VALID]
            new += [(k, *s) for s in seen(kind, pii.FURTHER[kind], text or "")] if kind in pii.FURTHER else []
        base[doc], more[doc] = own, new
        patterns.update((k, v, size) for k, _, _, v, size in own + new)
    models = {}
    for k in range(4):
        mine = [(v, size, n) for (kind, v, size), n in patterns.items() if kind == k]
        votes = Counter()
        for v, _, n in mine:
            votes[v] += n
        if mine:
            models[k] = pii.train(mine, pii.reliabilities(dict(votes))[2])
    got = {r["doc_id"]: r["spans"] for r in pii.scan(docs).collect()}
    meets = lambda a, b: a[1] < b[2] and b[1] < a[2]
    added = 0
    for doc, _ in rows:
        good = [s for s in more[doc] if s[3] & pii.VALID and sum(a * b for a, b in zip(models[s[0]], pii._inputs(s[3], s[4]), strict=True)) >= 0 and not any(meets(s, b) for b in base[doc])]
        alone = [s for s in good if not any(o[0] < s[0] and meets(s, o) for o in good)]
        added += len(alone)
        assert got[doc] == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b, *_ in sorted(base[doc] + alone)), doc
    assert added


def test_reliabilities_find_the_better_labelers():
    counts = {0b11111: 100, 0b00111: 80, 0b00000: 100, 0b11000: 60}
    share, rates, real = pii.reliabilities(counts)
    assert real[0b11111] > 0.9 > 0.1 > real[0b00000] and 0 < share < 1 and rates[0][0] > rates[0][1]


# -- 9 --------------------------------------------------------------------------------------------------


def test_near_dedup(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    base = [f"w{i}" for i in range(120)]
    near = [(-i - 1, " ".join(base[:k] + [f"z{i}"] + base[k + 1 :])) for i, k in enumerate(range(0, 120, 5))]
    docs = docs.unionByName(spark.createDataFrame([*near, (-100, "a b c"), (-101, "A  b c"), (-102, None), (-103, "")], "doc_id long, text string"))
    rows = docs.collect()
    words = [(t or "").encode().lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    links, parent = Counter(), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root(i)].append(doc)
    got = {r["doc_id"]: r for r in near_dedup.near_dedup_report(docs).collect()}
    for i, (doc, _) in enumerate(rows):
        first = min(least[root(i)])
        assert (got[doc]["class_id"], got[doc]["n_links"], got[doc]["kept"]) == (first, links[i], doc == first)
    kept = near_dedup.near_dedup(docs.withColumn("digest", F.lit("mine")))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(v) for v in least.values()) and kept.columns == ["doc_id", "text", "digest"]
    assert near_dedup.near_dedup(odd(spark)).count() == 9 and near_dedup.near_dedup(empty(spark)).count() == 0


def test_copies_of_a_hot_text_are_compared_once(spark, monkeypatch):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words))] * 300 + [(2, " ".join([*words[:-1], "z"]))]
    sizes, grouped = [], near_dedup._grouped
    monkeypatch.setattr(near_dedup, "_grouped", lambda df: (sizes.append(df.count()), grouped(df))[1])
    out = near_dedup.near_dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sizes[1] <= sizes[0] <= 2 * near_dedup.BANDS
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in out} == {(1, 1, 300), (2, 1, 300)}
    assert near_dedup.filter_bits(5) == near_dedup.FILTER_BITS and near_dedup.filter_bits(3_500_000) >= 16 * 3_500_000


def test_components_of_a_star_and_a_chain(spark):
    edges = [(f"s{i:05d}", "hub") for i in range(10_000)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(200)]
    got = near_dedup.components(spark.createDataFrame(edges, "u string, v string")).toPandas()
    assert set(got.root) == {"hub", "c000"} and len(got) == 10_000 + 200


def test_pruning_bound():
    for n, least in near_dedup.least_matches().items():
        tail = lambda m: sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))  # noqa: B023, E731
        assert tail(least) >= near_dedup.TOLERANCE and (least == 0 or tail(least - 1) < near_dedup.TOLERANCE)


# -- 10 -------------------------------------------------------------------------------------------------


def test_lm_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 10_000))
    rows = [(d, (t or "").encode().lower().split()) for d, t in docs.collect()]
    part = lambda d: {2: "out", 3: "deleted"}.get(zlib.crc32(str(d).encode()) % 7, "kept") if d is not None else "kept"
    end = b" "
    grams = lambda t: [tuple([b"^", b"^", *t, end][i : i + 3]) for i in range(len(t) + 1)]

    def counts(parts):
        seen = [g for d, t in rows if part(d) in parts for g in grams(t)]
        c = [Counter(g[2 - k :] for g in seen) for k in range(3)]
        return c, [Counter(g[2 - k : -1] for g in seen) for k in range(3)]

    def estimates(g, c, ctx):
        f = [c[k][g[2 - k :]] / max(1, ctx[k][g[2 - k : -1]]) for k in (2, 1, 0)]
        a, b = ctx[2][g[:-1]], ctx[1][g[1:-1]]
        return (64 + a.bit_length() - 1 if a else b.bit_length() - 1 if b else 128), [*f, 1 / (len(c[0]) + 1)]

    kept, train = counts({"kept"}), counts({"kept", "deleted"})
    held = [estimates(g, *kept) for d, t in rows if part(d) == "deleted" for g in grams(t)]
    weights = lm_score.mixture_weights(np.array([b for b, _ in held]), np.array([f for _, f in held]), np.ones(len(held)))
    n, v = sum(train[0][0].values()), len(train[0][0])
    want = Counter()
    for d, t in rows:
        g = grams(t)
        model = sum(math.log10(weights[b] @ f) for b, f in (estimates(x, *train) for x in g))
        base = sum(math.log10((train[0][0][x[2:]] + 1) / (n + v + 1)) for x in g)
        want[d, part(d) == "out", len(g), sum(train[0][0][x[2:]] > 0 for x in g), n, round(base, 6), round(model, 1)] += 1
    got = lm_score.score(docs, held_out("doc_id", 7, 2), held_out("doc_id", 7, 3)).collect()
    near = sorted(want.elements(), key=str)
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), r["score"]) for r in got), key=str)
    by_id = lambda rs: sorted(rs, key=lambda r: (r[0] is None, r[0] or 0))
    for a, b in zip(by_id(near), by_id(mine), strict=True):
        assert a[:6] == b[:6] and b[6] == pytest.approx(a[6], rel=0.01, abs=0.06)
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])
    assert lm_score.score(empty(spark), held_out("doc_id", 7, 2), held_out("doc_id", 7, 3)).count() == 0


def test_lm_chunks_and_ranges_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(120).withColumn("part", F.lit("x")).withColumn("n", F.lit(1))
    args = held_out("doc_id", 7, 2), held_out("doc_id", 7, 3)
    a = lm_score.score(docs, *args).toPandas().sort_values("doc_id", ignore_index=True)
    monkeypatch.setattr(lm_score, "CHUNK", 3_000)
    monkeypatch.setattr(lm_score, "RANGE", 500)
    b = lm_score.score(docs, *args).toPandas().sort_values("doc_id", ignore_index=True)
    assert (a.n_known == b.n_known).all() and np.allclose(a.base_score, b.base_score) and np.allclose(a.score, b.score)


def test_lm_without_training_texts_is_uniform(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = lm_score.score(docs, F.lit(True), F.lit(False)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in out] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def test_mixture_is_a_distribution():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 6, n) for n in rng.integers(1, 9, 40)]
    flat = np.concatenate([np.append(t + 1, 0) for t in texts])
    lengths = np.array([len(t) + 1 for t in texts])
    words = rng.integers(1, 2**62, 8).astype(np.uint64)
    c = [dict(zip(*np.unique(h, return_counts=True), strict=True)) for h in lm_score.Grams(lengths, words, flat, 40).hashes]
    held = rng.integers(0, 129, 500), rng.random((500, 4)), np.ones(500)
    weights = lm_score.mixture_weights(*held)
    for before in ([], [1], [1, 2], [7, 7], [3, 7], [7, 3]):  # 7 is never seen
        total = 0.0
        for word in range(8):
            g = lm_score.Grams(np.array([len(before) + 1]), words, np.array([*before, word]), 40)
            counts = [np.array([seen.get(h, 0) for h in hashes]) for seen, hashes in zip(c, g.hashes, strict=True)]
            bucket, parts = lm_score.estimates(counts, g.begins, len(texts), len(flat))
            w = weights[bucket[-1]] * (lm_score.default_weights()[bucket[-1]] > 0)
            total += (w / w.sum()) @ [*(x[-1] for x in parts), 1 / 8]
        assert total == pytest.approx(1)


def test_untrained_buckets_take_the_nearest_below():
    w = lm_score.mixture_weights(np.array([66, 66, 3]), np.array([[0.5, 0.1, 0.1, 0.1], [0.4, 0.2, 0.1, 0.1], [0, 0.5, 0.1, 0.1]]), np.ones(3))
    assert (w[70] == w[66]).all() and (w[64] == w[66]).all() and (w[9] == w[3]).all() and w[66][0] > 0.5 and w[3][0] == 0


def test_packed_numbers():
    for x in ([], [0], [0, 255, 256, 2**40], [2**64 - 1, 1]):
        assert lm_score.unpacked(lm_score.packed(np.array(x, np.uint64)), len(x)).tolist() == x


# -- the pipeline -----------------------------------------------------------------------------------------


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    report = near_dedup.near_dedup_report(docs)
    assert kept == {r["doc_id"] for r in report.where("kept").select("doc_id").collect()}
    packed = P.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == kept


def test_mixing_reaches_the_sequences(spark):
    import corpus_pipeline as P
    from tidemark.llm.common import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [r["source"] for r in docs.select("source").distinct().orderBy("source").collect()]
    share = {}
    for heavy in (names[0], names[-1]):
        weights = {n: 50.0 if n == heavy else 1.0 for n in names}
        slots = mixing.mix_sources(docs, weights, block_rows=1).select("doc_id", "source", "mix_slot").toPandas().set_index("doc_id")
        stored = written(mixing.mix_sources(docs, weights, block_rows=1).repartitionByRange(3, "mix_slot").sortWithinPartitions("mix_slot").select(*docs.columns))
        p = P.packed(spark, stored, SF).toPandas().set_index("doc_id").join(slots)
        assert p.groupby("sequence_id").mix_slot.min().is_monotonic_increasing and p.sequence_id.min() == 0
        early = p.sort_values("sequence_id").head(len(p) // 8)
        share[heavy] = (early.source == heavy).mean(), (early.source != heavy).mean()
    again = [sorted(map(tuple, P.run(spark, SF).collect())) for _ in range(2)]
    assert again[0] == again[1]
    assert all(a > b / len(names) for a, b in share.values())


def test_pipeline_rejects_texts_in_no_language(spark):
    import base64

    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(4)
    junk = [
        " ".join("".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 11, 500)),
        base64.b64encode(rng.bytes(15_000)).decode(),
        rng.bytes(3_000).hex(),
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια",
        "12345 !!",
        None,
    ]
    planted = [(-i - 1, t, None) for i, t in enumerate(junk)] + [(-100, "of it", None)]
    out = P.in_a_language(spark, docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string, lang string")), SF)
    clean = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == clean | {-100}
