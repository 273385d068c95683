"""Document pages and the tables in their text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Grades by confidence.
POOR, FAIR = 0.70, 0.85
LOW = ("POOR", "FAIR")


def snake_case(header: str | Column) -> Column:
    """Lower case, runs of anything but letters and digits as one underscore, none at the ends; column if nothing is left."""
    c = F.lower(F.trim(F.col(header) if isinstance(header, str) else header))
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(c, "[^0-9a-zA-Z]+", "_"), "^_+|_+$", ""), F.lit("")), F.lit("column"))


def suspect_text(text: str | Column) -> Column:
    """Three or more characters of broken encodings, or words that turn from lower to upper case inside."""
    t = F.col(text) if isinstance(text, str) else text
    return (F.regexp_count(t, F.lit(r"[\x{FFFD}-\x{FFFF}\x{E000}-\x{F8FF}]")) >= 3) | (F.regexp_count(t, F.lit(r"(?<![\p{L}\p{N}_])[a-z]+[A-Z]")) >= 3)


def grade(average: str | Column, minimum: str | Column) -> Column:
    score = F.coalesce(average, minimum)
    return F.when(score < POOR, "POOR").when(score < FAIR, "FAIR").when(score.isNotNull(), "GOOD")


def needs_review(grade: Column, rows: Column) -> Column:
    return (rows <= 0) | F.coalesce(grade.isin(*LOW), F.lit(False))


def review_reason(failure: Column, grade: Column, rows: Column) -> Column:
    low = F.coalesce(grade.isin(*LOW), F.lit(False))
    return F.coalesce(failure, F.when(rows <= 0, F.when(low, "no_apparent_table_low_confidence").otherwise("no_apparent_table")).when(low, "low_confidence"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _cells(line: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(line, r"^\|+|\|+$", ""), r"\|"), lambda c: F.trim(c))


def table_rows(block: Column) -> Column:
    """The rows of a block that is a pipe table, as arrays of (column, value): keyed by its header, blank
    cells null, all-blank rows dropped, a row as long as the shorter of header and cells; of repeated
    headers the last counts. Empty for other text."""
    empty = F.array().cast("array<array<struct<name:string,value:string>>>")

    def pairs(header: Column, once: Column, cells: Column) -> Column:
        n = F.least(F.size(header), F.size(cells))
        both = F.arrays_zip(F.slice(header, 1, n).alias("name"), F.slice(cells, 1, n).alias("value"))
        last = F.filter(both, lambda p, i: ~F.exists(F.slice(header, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda h: h == p["name"]))
        return F.when(once, both).otherwise(last)

    def rows(t: Column) -> Column:
        row = lambda line: _let(F.transform(_cells(line), lambda c: F.nullif(c, F.lit(""))), lambda cells: pairs(t["header"], t["once"], cells))
        return F.filter(F.transform(t["body"], row), lambda r: F.exists(r, lambda p: p["value"].isNotNull()))

    def parted(lines: Column) -> Column:
        begin = F.when(F.rlike(F.get(lines, 1), F.lit(r"^\|?[\s\-:|]+\|?$")), 3).otherwise(2)
        body = F.filter(F.slice(lines, begin, F.greatest(F.size(lines), F.lit(1))), lambda x: x.startswith("|"))
        header = F.transform(_cells(F.get(lines, 0)), snake_case)
        table = _let(header, lambda h: F.struct(h.alias("header"), (F.size(F.array_distinct(h)) == F.size(h)).alias("once"), body.alias("body")))
        return F.when((F.size(lines) >= 2) & F.get(lines, 0).startswith("|"), _let(table, rows)).otherwise(empty)

    return _let(F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: x != ""), parted)


def tables_in_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' other columns with block, row and cells (a map) of every row of every pipe table."""
    keep = [c for c in docs.columns if c != text]
    blocks = docs.select(*keep, F.posexplode(F.split(text, r"\n\s*\n")).alias("block", "__b")).where(F.contains("__b", F.lit("|")))
    rows = blocks.select(*keep, "block", F.posexplode(table_rows(F.col("__b"))).alias("row", "__r"))
    return rows.withColumn("cells", F.map_from_entries("__r")).drop("__r")


def apparent_rows(text: str | Column) -> Column:
    """Pipe-table rows and <tr tags of a text."""
    t = F.col(text) if isinstance(text, str) else text
    blocks = F.filter(F.split(t, r"\n\s*\n"), lambda b: F.contains(b, F.lit("|")))
    return F.aggregate(blocks, F.lit(0), lambda a, b: a + F.size(table_rows(b))) + F.regexp_count(F.lower(t), F.lit(r"<tr\b"))


def page_text(markdown: str, tables: str) -> Column:
    """A page's text and those of its tables' contents that it doesn't hold already."""
    own = F.coalesce(F.col(markdown), F.lit(""))
    more = F.filter(F.array_distinct(F.transform(tables, lambda t: F.trim(t["content"]))), lambda c: (c != "") & ~F.contains(own, c))
    return F.array_join(F.filter(F.concat(F.array(own), F.coalesce(more, F.array().cast("array<string>"))), lambda x: x != ""), "\n\n")


def table_evidence(markdown: str, tables: str) -> Column:
    """Whether a table's payload or visible table markup is there."""
    payload = F.exists(F.coalesce(F.col(tables), F.array().cast("array<struct<content:string,format:string>>")), lambda t: F.trim(F.coalesce(t["content"], F.lit(""))) != "")
    return payload | (apparent_rows(F.coalesce(F.col(markdown), F.lit(""))) > 0)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_schema(cells: str | Column, aliases: dict[str, str], fields: list[str]) -> Column:
    """A map with snake-case keys, aliases folded onto their fields (the last of equals wins), keys with
    an underscore first left alone, and null for fields that are not there."""
    m = F.col(cells) if isinstance(cells, str) else cells
    names = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)) if aliases else F.create_map().cast("map<string,string>")
    field = lambda key: bound(snake_case(key), lambda name: F.coalesce(F.try_element_at(names, name), name))
    entries = F.transform(F.map_entries(m), lambda e: F.struct(F.when(e["key"].startswith("_"), e["key"]).otherwise(field(e["key"])).alias("key"), e["value"].alias("value")))

    def folded(entries: Column) -> Column:
        last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda o: o["key"] == e["key"]))
        missing = F.filter(F.array(*map(F.lit, fields)), lambda f: ~F.exists(entries, lambda e: e["key"] == f)) if fields else F.array().cast("array<string>")
        nulls = F.transform(missing, lambda f: F.struct(f.alias("key"), F.lit(None).cast("string").alias("value")))
        return F.map_from_entries(F.concat(last, nulls))

    return bound(entries, folded)


def with_constants(cells: Column, constants: dict[str, Column]) -> Column:
    """A map with constants for keys that it hasn't got; a key with null is there."""
    each = F.array(*(F.struct(snake_case(F.lit(k)).alias("key"), v.cast("string").alias("value")) for k, v in constants.items()))
    extra = lambda have: F.filter(each, lambda e: e["value"].isNotNull() & ~F.map_contains_key(have, e["key"]))
    return bound(cells, lambda have: F.map_concat(have, F.map_from_entries(extra(have))))


def table_frame_rows(rows: DataFrame, page_index: int, page_grade: str | None, source: str) -> DataFrame:
    """Extracted rows: blank or nan is null, all-null rows dropped, page stamped from 0 and from 1."""
    cleaned = [F.when(~F.lower(F.trim(F.col(c).cast("string"))).isin("", "nan"), F.trim(F.col(c).cast("string"))).alias(c) for c in rows.columns]
    out = rows.select(*cleaned).dropna(how="all")
    return out.withColumns({"_page_index": F.lit(page_index), "_page": F.lit(page_index + 1), "_page_grade": F.lit(page_grade), "_source": F.lit(source)})


def page_states(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """doc, page_index, state of every expected page: missing, duplicate (the first is kept), empty, table, prose.

    docs: doc, page_count. pages: doc, page_index, markdown, tables, avg_conf, min_conf, arrival.
    Pages beyond the count are of state invalid.
    """
    w = Window.partitionBy("doc", "page_index").orderBy("arrival")
    first = pages.withColumns({"__n": F.row_number().over(w), "__c": F.count("*").over(Window.partitionBy("doc", "page_index"))}).where("__n = 1").drop("__n")
    expected = docs.where("page_count > 0").select("doc", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1)).alias("page_index")).withColumn("__want", F.lit(True))
    both = expected.join(first.withColumn("__got", F.lit(True)), ["doc", "page_index"], "full_outer")
    text = F.trim(F.coalesce("markdown", F.lit("")))
    evidence = table_evidence("markdown", "tables")
    state = (
        F.when(F.col("__want").isNull(), "invalid")
        .when(F.col("__got").isNull(), "missing")
        .when(F.col("__c") > 1, "duplicate")
        .when((text == "") & ~evidence, "empty")
        .when(evidence, "table")
        .otherwise("prose")
    )
    return both.withColumn("state", state).drop("__want", "__got", "__c")


def page_audit(states: DataFrame) -> DataFrame:
    """doc, page_index, page (from 1), chars, table_rows, grade, needs_review, reason of each page."""
    text = F.coalesce("markdown", F.lit(""))
    g, rows = grade(F.col("avg_conf"), F.col("min_conf")), apparent_rows(text)
    failure = F.when(F.col("state").isin("missing", "duplicate", "empty", "invalid"), F.concat(F.col("state"), F.lit("_page")))
    out = states.select("doc", "page_index", (F.col("page_index") + 1).alias("page"), F.length(text).alias("chars"), rows.alias("table_rows"), g.alias("grade"), failure.alias("__f"))
    out = out.withColumn("reason", review_reason(F.col("__f"), F.col("grade"), F.col("table_rows"))).drop("__f")
    # prose without a table is an answer, not a fault, if it is read well
    return out.withColumn("needs_review", F.coalesce(F.col("reason") != "no_apparent_table", F.lit(False)))


def document_text(pages: DataFrame, doc: str = "doc", index: str = "page_index", text: str = "markdown") -> DataFrame:
    """doc, text: pages in order under headers."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return pages.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: F.concat(F.lit("## Page "), (p["i"] + 1).cast("string"), F.lit("\n\n"), p["t"])), "\n\n").alias("text"))


def rows_or_markers(states: DataFrame, rows: DataFrame) -> DataFrame:
    """Every page's rows, or one marker row: unresolved for a page that failed, page_audit for one without rows."""
    n = rows.groupBy("doc", "page_index").agg(F.count("*").alias("__n"))
    failed = F.col("state").isin("missing", "duplicate", "empty", "invalid")
    marks = states.join(n, ["doc", "page_index"], "left").where("__n is null").select("doc", "page_index", F.when(failed, "unresolved").otherwise("page_audit").alias("kind"))
    return rows.withColumn("kind", F.lit("row")).unionByName(marks, allowMissingColumns=True)


def preferred_rows(structured: DataFrame, inline: DataFrame, keys: list[str]) -> DataFrame:
    """A page's structured rows; those in its text only where it has none."""
    return structured.unionByName(inline.join(structured.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def probe(docs: DataFrame, text: str = "text", pages: str | Column | None = None, sample: int = 600) -> DataFrame:
    """docs with chars, chars_per_page, likely_scanned (fewer than 200 a page), suspect, sample."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    per = n / F.greatest(pages if isinstance(pages, Column) else F.lit(1), F.lit(1))
    head = F.substring(F.coalesce(F.col(text), F.lit("")), 1, sample)
    return docs.withColumns({"chars": n, "chars_per_page": per, "likely_scanned": per < 200, "sample": head, "suspect": suspect_text(head)})


def batch_progress(results: DataFrame) -> DataFrame:
    """total, completed, failed, cache_hits of a batch's results (result, error, cached)."""
    return results.groupBy("batch").agg(F.count("*").alias("total"), F.count_if(F.col("error").isNull()).alias("completed"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.count_if(F.col("cached")).alias("cache_hits"))


def rows_from_result(results: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """The row objects of a JSON list, or of {"rows": [...]}, typed by nullable fields; others dropped."""
    listed = F.coalesce(F.when(F.trim(F.col(column)).startswith("["), F.col(column)), F.get_json_object(column, "$.rows"))
    parsed = F.from_json(listed, "array<variant>")
    each = results.select(*[c for c in results.columns if c != column], F.posexplode(parsed).alias("row", "__v"))
    objects = each.where(F.schema_of_variant("__v").startswith("OBJECT"))
    return objects.select(*[c for c in objects.columns if c != "__v"], *(F.try_variant_get("__v", f"$.{k}", t).alias(k) for k, t in fields.items()))
