"""Record quality: row contracts, provenance, manifests, content keys, feeds, replay ledgers.

Rows are never dropped silently: checks add columns that say what is wrong, callers filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validated(rows: DataFrame, timestamp: str = "timestamp", value: str = "value", ticker: str = "ticker") -> DataFrame:
    """rows with reason (null: valid): YYYY-MM-DD time, finite number, ticker null or not blank."""
    number = F.col(value).cast("double")
    reason = (
        F.when(F.col(timestamp).isNull() | ~F.rlike(F.col(timestamp), F.lit(r"^\d{4}-\d{2}-\d{2}$")), "timestamp")
        .when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), "value")
        .when(F.trim(F.col(ticker)) == "", "ticker")
    )
    return rows.withColumn("reason", reason)


def write_rows(rows: DataFrame, path: str, rejected_path: str | None = None, tickers: list[str] | None = None, partial: bool = False) -> None:
    """Writes valid rows as JSON lines. Any invalid row fails the whole write, unless partial, which
    keeps them apart under rejected_path. A job's output appears when it commits, or not at all."""
    checked = validated(rows if tickers is None else rows.where(F.col("ticker").isin(*tickers)))
    bad = checked.where("reason is not null")
    if not partial and (first := bad.first()) is not None:
        raise ValueError(f"invalid {first['reason']}: {first.asDict()}")
    checked.where("reason is null").drop("reason").write.mode("overwrite").json(path)
    if rejected_path is not None:
        bad.write.mode("overwrite").json(rejected_path)


def deduped(ids: str | Column) -> Column:
    """Distinct ids in their order."""
    return F.array_distinct(ids)


def clean_ids(ids: Column) -> Column:
    """Ids of a list: trimmed, blanks and nulls dropped."""
    return F.filter(F.transform(ids, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def direct_source_ids(canonical: list[Column], legacy: list[Column]) -> Column:
    """Distinct ids of the canonical fields together, else of the first legacy field that has any. Each is an array of strings."""
    none = F.array().cast("array<string>")
    cleaned = [F.coalesce(clean_ids(c), none) for c in canonical]
    own = F.array_distinct(F.concat(*cleaned))
    old = reduce(lambda rest, c: F.when(F.size(c) > 0, c).otherwise(rest), reversed([F.array_distinct(F.coalesce(clean_ids(c), none)) for c in legacy]), none)
    return F.when(F.size(own) > 0, own).otherwise(old)


def row_identity(*fields: str) -> Column:
    """The first field that isn't blank."""
    return F.coalesce(*(F.nullif(F.trim(F.col(f).cast("string")), F.lit("")) for f in fields))


def lineage_map(lines: DataFrame, output_id: str = "output_row_id", sources: str = "source_ids", malformed: str = "malformed") -> DataFrame:
    """output id, sources, void: one repeated id or malformed line voids the whole map; lines without id or sources count for nothing."""
    usable = lines.where(~F.col(malformed) & F.col(output_id).isNotNull() & (F.size(sources) > 0))
    per_id = usable.groupBy(output_id).agg(F.count("*").alias("__n"), F.first(sources).alias(sources))
    broken = lines.agg(F.max(F.col(malformed).cast("int")).alias("__bad"))
    twice = per_id.agg(F.max((F.col("__n") > 1).cast("int")).alias("__twice"))
    void = broken.crossJoin(twice).select((F.coalesce("__bad", F.lit(0)) + F.coalesce("__twice", F.lit(0)) > 0).alias("void"))  # one row
    return per_id.drop("__n").crossJoin(F.broadcast(void))


def attributed(rows: DataFrame, lineage: DataFrame, identity: str, sources: str) -> DataFrame:
    """rows with attributed: direct sources, or an identity in a lineage map that isn't void."""
    known = lineage.where(~F.col("void")).select(F.col(lineage.columns[0]).alias(identity), F.lit(True).alias("__known"))
    return rows.join(known, identity, "left").withColumn("attributed", (F.coalesce(F.size(sources), F.lit(0)) > 0) | F.coalesce("__known", F.lit(False))).drop("__known")


def unattributed_count(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """missing, total, enforced: the contract holds only where documents were fetched."""
    n = documents.agg((F.count("*") > 0).alias("enforced"))
    return rows.agg(F.count_if(~F.col("attributed")).alias("missing"), F.count("*").alias("total")).crossJoin(n)


def fetched_documents(ledger: DataFrame) -> DataFrame:
    """ids of fetched documents from ledger (id, ok, object_key, content_type, malformed): ok, with an
    object key, PDF by type or suffix; one malformed line disarms the whole ledger."""
    disarmed = ledger.agg(F.coalesce(F.max((F.col("malformed") | F.col("id").isNull()).cast("int")), F.lit(0)).alias("__bad"))
    mime = F.lower(F.trim(F.element_at(F.split(F.coalesce(F.nullif("content_type", F.lit("")), F.lit("application/pdf")), ";"), 1)))
    fine = F.col("ok") & (F.trim("object_key") != "") & ((mime == "application/pdf") | F.lower("object_key").endswith(".pdf"))
    return ledger.where(F.coalesce(fine, F.lit(False))).crossJoin(F.broadcast(disarmed)).where("__bad = 0").select("id")


def last_by_key(lines: DataFrame, key: str = "id", order: str = "line") -> DataFrame:
    """Of lines with the same id the last."""
    names = [c for c in lines.columns if c != key]
    return lines.groupBy(key).agg(F.max_by(F.struct(*names), order).alias("__r")).select(key, "__r.*")


def ledger_conflicts(requests: DataFrame, ledger: DataFrame, key: str = "id", url: str = "url") -> DataFrame:
    """Requests whose id is recorded with another URL, or with none."""
    known = ledger.select(key, F.col(url).alias("recorded"))
    return requests.join(known, key).where(F.col("recorded").isNull() | (F.col(url) != F.col("recorded")))


def manifest_audit(parts: DataFrame, manifest: str = "manifest") -> DataFrame:
    """manifest, valid, reason, n of part lists: numbers from 0 without gaps or repeats, 64-hex digests, sizes not negative."""
    w = Window.partitionBy(manifest).orderBy("part")
    each = parts.withColumns({"__i": F.row_number().over(w) - 1, "__twice": F.count("*").over(Window.partitionBy(manifest, "part")) > 1})
    wrong = (
        F.when(F.col("part").isNull() | F.col("sha256").isNull() | F.col("byte_size").isNull(), "missing")
        .when((F.col("part") < 0) | (F.col("byte_size") < 0), "negative")
        .when(~F.rlike(F.col("sha256"), F.lit("^[0-9a-f]{64}$")), "digest")
        .when(F.col("__twice"), "repeated")
        .when(F.col("__i") != F.col("part"), "gap")
    )
    return each.withColumn("__w", wrong).groupBy(manifest).agg(F.min("__w").alias("reason"), F.count("*").alias("n")).withColumn("valid", F.col("reason").isNull())


#: Bytes of a file that a task holds at a time.
RANGE_BYTES = 8 << 20


def _digest(path: str) -> str:
    """SHA-256 of a file of any size, read range by range."""
    scheme, _, rest = path.partition(":")
    store, at = (LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else FileSystem.from_uri(path)
    digest = hashlib.sha256()
    with store.open_input_stream(at) as f:
        while piece := f.read(RANGE_BYTES):
            digest.update(piece)
    return digest.hexdigest()


def written_manifest(spark, path: str, known: DataFrame | None = None) -> DataFrame:  # noqa: ANN001
    """part, path, sha256, byte_size, modified of the Parquet files under path, in name order.

    Spark lists the files; a task streams each one that it digests. known: an earlier manifest of them;
    files of the same size and time keep its digest, so a manifest that was broken off goes on from there.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    listed = files.select("path", F.col("length").alias("byte_size"), F.col("modificationTime").alias("modified"))

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at, size, time in f.itertuples(index=False):  # a row at a time: a file may be long
                yield pd.DataFrame({"path": [at], "sha256": [_digest(at)], "byte_size": [size], "modified": [time]})

    same = ["path", "byte_size", "modified"]
    todo = listed if known is None else listed.join(known, same, "left_anti")
    done = todo.repartition("path").mapInPandas(digests, "path string, sha256 string, byte_size bigint, modified timestamp")
    if known is not None:
        done = done.unionByName(listed.join(known.select(*same, "sha256"), same))
    return done.withColumn("part", F.row_number().over(Window.orderBy("path")) - 1)  # a row for each file


def content_key(*columns: str) -> Column:
    """A key over the named columns' names and values; nulls differ from missing text."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def collapsed(specs: DataFrame, columns: list[str], order: str) -> DataFrame:
    """specs with key and first (the first spec of the same content), so that work is done once and fanned out."""
    keyed = specs.withColumn("key", content_key(*columns))
    first = keyed.groupBy("key").agg(F.min(order).alias("first"))
    return keyed.join(first, "key")


def replay(requests: DataFrame, ledger: DataFrame, columns: list[str], result: str = "result") -> tuple[DataFrame, DataFrame]:
    """(requests whose result is in the ledger, with it; requests still to do), by content key."""
    keyed = requests.withColumn("key", content_key(*columns))
    return keyed.join(ledger.select("key", result), "key"), keyed.join(ledger, "key", "left_anti")


def absorbed(feed: DataFrame, key: str = "id", order: str = "seq", digest: str = "digest") -> DataFrame:
    """An at-least-once feed once: rows whose digest is their id's last one go; others of a known id supersede."""
    w = Window.partitionBy(key).orderBy(order)
    before = F.lag(digest).over(w)
    out = feed.withColumns({"__before": before, "supersedes": F.row_number().over(w) > 1})
    return out.where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.col(digest))).drop("__before")


def new_points(points: DataFrame, series: DataFrame, columns: list[str]) -> DataFrame:
    """Points that the series hasn't got; rows repeated inside the batch come once, nulls match nulls."""
    fresh = points.dropDuplicates(columns)
    same = reduce(lambda a, b: a & b, (fresh[c].eqNullSafe(series[c]) for c in columns))
    return fresh.join(series, same, "left_anti")


def replaced(series: DataFrame, points: DataFrame, name: str, allow_shrink: bool = False) -> DataFrame:
    """series with the named one replaced by points; fewer points than before are refused unless allowed."""
    out = series.where(F.col("series") != name).unionByName(points.withColumn("series", F.lit(name)), allowMissingColumns=True)
    if allow_shrink:
        return out
    sizes = points.agg(F.count("*").alias("new")).crossJoin(series.where(F.col("series") == name).agg(F.count("*").alias("old")))
    fine = sizes.select(F.when(F.col("new") < F.col("old"), F.raise_error(F.lit("the series would shrink")).cast("boolean")).otherwise(True).alias("__fine"))
    return out.crossJoin(F.broadcast(fine)).where("__fine").drop("__fine")  # one row: checked as the result is read


def one_to_one(expected: DataFrame, returned: DataFrame, index: str = "idx") -> DataFrame:
    """idx, error of rows that break it: missing, duplicate, out of range."""
    n = returned.groupBy(index).agg(F.count("*").alias("n"))
    both = expected.select(index, F.lit(True).alias("want")).join(n, index, "full_outer")
    error = F.when(F.col("want").isNull(), "out of range").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return both.select(index, error.alias("error")).where("error is not null")


def upserted(ledger: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """ledger with fresh records by id; their fields win where they have a value."""
    names = [c for c in ledger.columns if c != key]
    f = fresh.select(key, *(F.col(c).alias(f"__{c}") for c in names))
    return ledger.join(f, key, "full_outer").select(key, *(F.coalesce(f"__{c}", c).alias(c) for c in names))


def domain_violations(rows: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """rows with needs_review and reason: the first field whose value, trimmed and case-folded, is outside its closed set."""
    found = [F.when((F.trim(F.col(c).cast("string")) != "") & ~F.lower(F.trim(F.col(c).cast("string"))).isin(*map(str.lower, d)), F.lit(c)) for c, d in domains.items()]
    first = F.coalesce(*found)
    return rows.withColumns({"needs_review": first.isNotNull(), "reason": F.concat(F.lit("value_outside_declared_domain:"), first)})


def requires_evidence(value: str | Column, rule: str | Column) -> Column:
    """Whether a JSON value must be cited: always, truthy, falsey, nonempty (text that isn't blank, a list that isn't empty)."""
    v = F.trim(F.col(value) if isinstance(value, str) else value)
    blank = v.isNull() | v.isin("", "null", '""')
    falsey = blank | v.isin("false", "0", "0.0", "[]", "{}")
    empty = blank | v.isin("[]", "{}") | F.rlike(v, F.lit(r'^"\s*"$'))
    k = F.col(rule) if isinstance(rule, str) else rule
    return F.when(k == "always", True).when(k == "truthy", ~falsey).when(k == "falsey", falsey).when(k == "nonempty", ~empty)


def flat_pointer(path: Column) -> Column:
    """A JSON pointer, of keys and indexes without escapes, as a path for get_json_object."""
    steps = F.transform(F.slice(F.split(path, "/"), 2, 1000), lambda s: F.when(F.rlike(s, F.lit(r"^(0|[1-9]\d*)$")), F.concat(F.lit("["), s, F.lit("]"))).otherwise(F.concat(F.lit("['"), s, F.lit("']"))))
    return F.concat(F.lit("$"), F.array_join(steps, ""))


def _looked_up(doc: Column, pointer: Column) -> Column:
    """struct<v: variant, e: string> of what a JSON pointer finds in a variant, step by step."""

    def step(at: Column, raw: Column) -> Column:
        key = F.replace(F.replace(raw, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))
        place = F.when(F.rlike(key, F.lit(r"^(0|[1-9]\d{0,8})$")), key.try_cast("int"))
        fields, items = F.try_variant_get(at["v"], "$", "map<string,variant>"), F.try_variant_get(at["v"], "$", "array<variant>")
        found = F.coalesce(F.try_element_at(fields, key), F.get(items, place))
        wrong = F.coalesce(at["e"], F.when(F.rlike(raw, F.lit("~(?![01])")), "bad escape"), F.when(found.isNull(), "not found"))
        return F.struct(F.when(wrong.isNull(), found).alias("v"), wrong.alias("e"))

    begin = F.when(doc.isNull() | pointer.isNull(), "unreadable").when(pointer == "", "root").when(~pointer.startswith("/"), "not a pointer")
    steps = F.split(F.coalesce(pointer, F.lit("")), "/")
    return F.aggregate(F.slice(steps, 2, F.size(steps)), F.struct(doc.alias("v"), begin.alias("e")), step)


def resolved_pointers(refs: DataFrame, raw: str = "raw", path: str = "path") -> DataFrame:
    """refs with value and error of each pointer into its record: a scalar that isn't blank, by the path
    as given, then without a /raw prefix. Escapes, arrays and any keys; a record is parsed once."""
    doc, given = F.col("__doc"), F.col(path)

    def scalar(c: Column) -> Column:
        text = F.try_variant_get(c["v"], "$", "string")
        kind = F.schema_of_variant(c["v"])
        wrong = F.coalesce(c["e"], F.when(F.rlike(kind, F.lit("^(OBJECT|ARRAY)")), "container"), F.when(text.isNull() | ~F.rlike(text, F.lit(r"\S")), "blank"))
        return F.struct(F.when(wrong.isNull(), text).alias("value"), wrong.alias("error"))

    once = refs.withColumn("__doc", F.try_parse_json(raw)).withColumn("__a", scalar(_looked_up(doc, given)))
    short = F.col("__a.error").isNotNull() & given.startswith("/raw/")
    again = once.withColumn("__a", F.when(short, scalar(_looked_up(doc, F.substring(given, 5, 1 << 30)))).otherwise(F.col("__a")))
    return again.select(*refs.columns, "__a.value", "__a.error")


def uncited(requirements: DataFrame, refs: DataFrame, keys: list[str]) -> DataFrame:
    """Required predicates of a record that no reference names."""
    return requirements.join(refs, keys, "left_anti")


def inclusion_supported() -> Column:
    """Neither contradicted nor excluded; null where a component isn't a boolean."""
    return ~(F.col("contradicted") | F.col("excluded"))
