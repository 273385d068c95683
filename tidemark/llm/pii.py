"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans. Five labelers vote on each: its written form, its validity (checksum or
ranges), gazetteers (issuers, countries, domains, networks), words before it, and what touches it.
Votes are counted by pattern over all documents; expectation-maximisation on these few counts
estimates how reliable each labeler is for each kind and how likely each pattern is personal data,
and a logistic span classifier is trained on that. Spans of the base definition always stay; the
classifier adds others, such as a card or phone number that runs on into its neighbour.

Defined cases: a null text counts as empty; texts without spans give zeros and empty strings;
offsets are code points, ends exclusive; of overlapping spans the base one stays, and of added ones
the first by kind; very long texts are read whole; repeated rows are scanned alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

KINDS = ("email", "ip", "card", "phone")
LABELERS = 5
#: The validity labeler's bit. A span that fails its checksum or ranges teaches, but is never added.
VALID = 1 << 1
ROUNDS = 50
#: Characters before a span in which cue words count.
BEFORE = 32
#: Spans of a run: what is copied for each span added, whatever the text's length.
RUN = 64
_SPAN = "array<struct<match:string,start:int,end:int,before:string,after:string>>"
_RUNS = f"array<struct<at:int,out:{_SPAN}>>"

_LOCAL = r"[A-Za-z0-9._%+-]"
#: What each kind's base matches must look like. Possessive where the next character can't belong to
#: the part, and not begun inside a part that has failed as a whole: the same matches in linear time.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further proposals; ip has none.
FURTHER = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[\x20.-]?)?(?<![0-9])(?:\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
}
#: What a text must contain to hold any match.
NEEDS = {"email": "@", "phone": "+"}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# Domains that aren't two letters (a country), issuers of cards, country codes of phones.
_DOMAINS = "[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|tel|cat|asia|dev|app|xyz|online|site|store|shop|tech|cloud|blog|example"
_ISSUERS = "4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|095|[689])|6(?:011|4[4-9]|5|2|7)|35(?:2[89]|[3-8])|50|5[6-8]"
_COUNTRIES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|(?:2[1-69]|3[578]|42|5[09]|6[7-9]|8[0578]|9[679])[0-9]"
FORM = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@.*\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})$",
    "phone": r"^(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$",
}
GAZETTEER = {
    "email": rf"(?i)(?:\.|dot[\])] ?)(?:{_DOMAINS})$",
    "ip": r"^(?!0|10\.|127\.|2(?:2[4-9]|[3-5][0-9])\.)",
    "card": rf"^(?:{_ISSUERS})",
    "phone": rf"^(?:\+(?:{_COUNTRIES})|\()",
}
CUES = {
    "email": r"(?i)(?:e-?mail|mailto|contact|write|reach|address|from|to|cc|reply|@)\W*$",
    "ip": r"(?i)(?:\bipv?4?\b|host|server|address|from|client|gateway|proxy|login|ping|ssh)\W*$",
    "card": r"(?i)(?:card|visa|master|amex|maestro|discover|credit|debit|payment|number|pan|no)\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|contact|number|dial|text|sms|whatsapp|line)\W*$",
}


def _spans(matches: Column, gaps: str) -> Column:
    """Matches with their offsets and surroundings. gaps: the column of what lies between them."""
    between = F.col(gaps)
    pieces = F.transform(matches, lambda m, i: F.struct(m.alias("match"), F.get(between, i).alias("gap"), F.substring(F.get(between, i + 1), 1, 1).alias("after")))
    none = F.array().cast(_SPAN)

    def add(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["gap"])
        end = begin + F.length(p["match"])
        span = F.struct(p["match"].alias("match"), begin.alias("start"), end.alias("end"), F.right(p["gap"], F.lit(BEFORE)).alias("before"), p["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).cast(_SPAN).alias("out"))

    def add_run(state: Column, run: Column) -> Column:
        start = F.struct(F.coalesce(F.get(state, F.size(state) - 1)["at"], F.lit(0)).alias("at"), none.alias("out"))
        return F.concat(state, F.array(F.aggregate(run, start, add))).cast(_RUNS)

    # an array grows by copying, so spans are added in runs, and runs to the list of runs
    def in_runs(p: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(p), F.lit(RUN)), lambda i: F.slice(p, i, RUN))
        return F.aggregate(runs, F.array().cast(_RUNS), add_run, lambda s: F.flatten(F.transform(s, lambda r: r["out"])))

    # the pieces are made once: as an expression inside the runs they would be made anew for each
    return F.when(F.size(matches) > 0, F.get(F.transform(F.array(pieces), in_runs), 0)).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return F.rlike(match, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _votes(kind: str, s: Column) -> Column:
    """A bit for each labeler that votes for the span."""
    says = (
        F.rlike(s["match"], F.lit(FORM[kind])),
        _valid(kind, s["match"]) if kind != "email" else F.length(s["match"]) <= 254,
        F.rlike(s["match"], F.lit(GAZETTEER[kind])),
        F.rlike(s["before"], F.lit(CUES[kind])),
        ~F.rlike(F.right(s["before"], F.lit(1)), F.lit(r"[\p{L}0-9]")) & ~F.rlike(s["after"], F.lit(r"[\p{L}0-9]")),
    )
    out = F.lit(0)
    for k, v in enumerate(says):
        out = out + F.when(v, F.lit(1 << k)).otherwise(0)
    return out


def candidates(df: DataFrame) -> DataFrame:
    """doc_id and spans (kind number, base, start, end, votes, size class) of every row of df."""
    df = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text, digit = F.col("text"), F.rlike("text", F.lit("[0-9]"))
    proposals = [(k, True, BASE[k]) for k in KINDS] + [(k, False, FURTHER[k]) for k in FURTHER]
    cut = []
    for k, base, pattern in proposals:
        may = F.contains(text, F.lit(NEEDS[k])) if base and k in NEEDS else F.rlike("text", F.lit(r"[\[(]at[\])]")) if k == "email" else digit
        none = F.array().cast("array<string>")
        name = f"{k}_{'base' if base else 'more'}"
        cut += [F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias(f"m_{name}"), F.when(may, F.split(text, pattern, -1)).otherwise(none).alias(f"g_{name}")]
    found = df.select("doc_id", *cut)
    return found.select("doc_id", F.concat(*(_rated(k, base) for k, base, _ in proposals)).alias("spans"))


def _rated(kind: str, base: bool) -> Column:
    """The kind's spans with their votes; of the base pattern's the valid ones."""
    name = f"{kind}_{'base' if base else 'more'}"
    spans = _spans(F.col(f"m_{name}"), f"g_{name}")
    rated = lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), s["start"].alias("start"), s["end"].alias("end"), _votes(kind, s).alias("votes"), F.least(F.lit(3), ((s["end"] - s["start"]) / 8).cast("int")).alias("size")
    )
    return F.transform(F.filter(spans, lambda s: _valid(kind, s["match"])) if base else spans, rated)


def reliabilities(counts: dict[int, int], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """EM over vote patterns of one kind: the share that is real, each labeler's rate of votes for
    real and for other spans, and each pattern's probability to be real. Starts from the majority."""
    real = {v: 0.9 if 2 * v.bit_count() > LABELERS else 0.1 for v in counts}
    share, rates, total = 0.5, [], sum(counts.values())
    for _ in range(rounds):
        n = sum(c * real[v] for v, c in counts.items())
        share = (n + 1) / (total + 2)
        rates = []
        for k in range(LABELERS):
            yes = sum(c * real[v] for v, c in counts.items() if v >> k & 1)
            no = sum(c * (1 - real[v]) for v, c in counts.items() if v >> k & 1)
            # a labeler is taken to be better than chance until the counts say otherwise
            rates.append(((yes + 2) / (n + 3), (no + 1) / (total - n + 3)))
        for v in counts:
            odds = math.log(share / (1 - share))
            for k, (a, b) in enumerate(rates):
                odds += math.log(a / b) if v >> k & 1 else math.log((1 - a) / (1 - b))
            real[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, rates, real


def _inputs(votes: int, size: int) -> list[float]:
    return [1.0, *(float(votes >> k & 1) for k in range(LABELERS)), *(float(size == k) for k in range(1, 4))]


def train(rows: list[tuple[int, int, int]], real: dict[int, float], rounds: int = 300) -> list[float]:
    """Logistic weights for (votes, size class, count) rows, by gradient steps toward EM's probabilities."""
    w = [0.0] * (LABELERS + 4)
    total = sum(n for _, _, n in rows)
    for _ in range(rounds):
        slope = [0.0] * len(w)
        for votes, size, n in rows:
            x = _inputs(votes, size)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x, strict=True))))))
            for k, v in enumerate(x):
                slope[k] += n / total * (real[votes] - p) * v
        w = [a + 2.0 * s - 0.002 * a for a, s in zip(w, slope, strict=True)]
    return w


def _meets(of: Column) -> Column:
    """Whether a span overlaps one of the row's spans that `of` holds for, by its neighbours in order of start."""
    w, until = Window.partitionBy("row"), (Window.unboundedPreceding, 0)
    rank = F.when(of, 0).otherwise(1)
    before = F.max(F.when(of, F.col("end"))).over(w.orderBy("start", rank).rowsBetween(*until))
    after = F.last(F.when(of, F.col("start")), ignorenulls=True).over(w.orderBy(F.desc("start"), rank).rowsBetween(*until))
    return F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))


def alone(spans: DataFrame) -> DataFrame:
    """Of (row, kind, base, start, end) the added spans that meet no base span, nor one of an earlier kind that meets none."""
    free = spans.withColumn("met", _meets(F.col("base"))).where(~F.col("base") & ~F.col("met")).drop("met")
    kinds = [KINDS.index(k) for k in FURTHER]
    free = free.withColumns({f"met_{k}": _meets(F.col("kind") < k) for k in kinds[1:]})
    return free.where(reduce(lambda rest, k: F.when(F.col("kind") == k, ~F.col(f"met_{k}")).otherwise(rest), kinds[1:], F.lit(True)))


def scan(df: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of df."""
    found = written(candidates(df).withColumn("row", F.monotonically_increasing_id()))
    each = found.select(F.explode("spans").alias("s"))
    patterns = each.groupBy("s.kind", "s.votes", "s.size").count().collect()  # kinds x patterns x sizes at most
    models: dict[int, list[float]] = {}
    for k in range(len(KINDS)):
        rows = [(r["votes"], r["size"], r["count"]) for r in patterns if r["kind"] == k]
        counts: dict[int, int] = {}
        for votes, _, n in rows:
            counts[votes] = counts.get(votes, 0) + n
        if counts:
            models[k] = train(rows, reliabilities(counts)[2])

    def likely(s: Column) -> Column:
        out = F.lit(False)
        for k, w in models.items():
            total = F.lit(w[0])
            for i in range(LABELERS):
                total = total + w[1 + i] * F.shiftright(s["votes"], i).bitwiseAND(1)
            for size in range(1, 4):
                total = total + F.when(s["size"] == size, w[LABELERS + size]).otherwise(0.0)
            out = F.when(s["kind"] == k, total >= 0).otherwise(out)
        return out

    more = F.filter("spans", lambda s: ~s["base"] & (s["votes"].bitwiseAND(VALID) > 0) & likely(s))
    parted = found.select("row", "doc_id", F.filter("spans", lambda s: s["base"]).alias("base"), more.alias("more"))
    added = alone(parted.where(F.size("more") > 0).select("row", F.explode(F.concat("base", "more")).alias("s")).select("row", "s.kind", "s.base", "s.start", "s.end"))
    parted = parted.drop("more").join(added.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")), "row", "left")
    name = F.array(*map(F.lit, KINDS))

    def text(spans: Column) -> Column:
        ordered = F.array_sort(spans)
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")

    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return parted.select("doc_id", *map(number, range(len(KINDS))), F.sha2(text(plain), 256).alias("base_sha256"), text(F.concat(plain, F.coalesce("more", F.array()))).alias("spans"))
