"""Queries of record quality and document operators, on rows derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import documents as D
from tidemark.operators import quality as Q

from .common import r, register, rounded, table

def K() -> Column:
    return F.col("event_id")




def events(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events")


def _e(name: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    register(name, lambda s, d: build(events(s, d)), sql)


# -- row contracts and provenance -------------------------------------------------------------------


def _rows(e: DataFrame) -> DataFrame:
    day = F.to_date("ts").cast("string")
    return e.select("event_id", F.when(K() % 7 == 0, F.concat(day, F.lit("T00"))).when(K() % 11 == 0, F.lit(None)).otherwise(day).alias("timestamp"), F.when(K() % 13 == 0, F.lit(float("nan"))).when(K() % 17 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"), F.when(K() % 5 == 0, F.lit(None)).when(K() % 19 == 0, F.lit("  ")).otherwise(F.col("event_type")).alias("ticker"))


_e("pf16_validate_row", lambda e: Q.validated(_rows(e)).select("event_id", F.col("reason").isNull().alias("valid"), "reason"), "SELECT event_id, reason IS NULL AS valid, reason FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'timestamp' WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR value IS NULL OR isnan(value) THEN 'value' WHEN event_id % 5 <> 0 AND event_id % 19 = 0 THEN 'ticker' END AS reason FROM events)")
_e(
    "pf17_domain_violations",
    lambda e: Q.domain_violations(e.select("event_id", F.when(K() % 3 == 0, F.concat(F.lit(" "), F.upper("event_type"))).when(K() % 29 == 0, F.lit("")).otherwise(F.col("event_type")).alias("kind")), {"kind": ["view", "click", "error"]}).select("event_id", "needs_review", "reason"),
    "SELECT event_id, bad AS needs_review, CASE WHEN bad THEN 'value_outside_declared_domain:kind' END AS reason FROM (SELECT event_id, NOT (event_id % 3 <> 0 AND event_id % 29 = 0) AND event_type NOT IN ('view', 'click', 'error') AS bad FROM events)",
)
def _IDS() -> Column:
    return F.array(F.concat(F.lit(" d"), (K() % 4).cast("string")), F.lit(""), F.concat(F.lit("d"), (K() % 2).cast("string")), F.lit(None))


def _none() -> Column:
    return F.array().cast("array<string>")


_e("se2_dedupe", lambda e: e.select("event_id", F.array_join(Q.deduped(F.array((K() % 3).cast("string"), (K() % 2).cast("string"), (K() % 3).cast("string"))), ",").alias("ids")), "SELECT event_id, CASE WHEN event_id % 3 = event_id % 2 THEN CAST(event_id % 3 AS VARCHAR) ELSE concat(event_id % 3, ',', event_id % 2) END AS ids FROM events")
_e(
    "tx23_source_ids",
    lambda e: e.select("event_id", F.array_join(Q.direct_source_ids([F.when(K() % 2 == 0, _IDS())], [F.when(K() % 3 == 0, F.array(F.lit(" "))).otherwise(_none()), F.array(F.concat(F.lit("f"), K().cast("string")))]), ",").alias("ids")),
    "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 4 = 0 THEN 'd0' ELSE concat('d', event_id % 4, ',d0') END ELSE concat('f', event_id) END AS ids FROM events",
)
_e("tx24_row_identity", lambda e: e.select("event_id", F.when(K() % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" r"), K().cast("string"))).alias("a"), F.when(K() % 2 == 0, F.concat(F.lit("s"), K().cast("string"))).alias("b")).select("event_id", Q.row_identity("a", "b").alias("identity")), "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN concat('r', event_id) WHEN event_id % 2 = 0 THEN concat('s', event_id) END AS identity FROM events")


def _lines(e: DataFrame, repeat: int) -> DataFrame:
    """Lineage lines of a user's events; every repeat-th line repeats an id (0: none)."""
    key = K() if not repeat else F.when(K() % repeat == 1, K() - 1).otherwise(K())
    return e.where("event_type = 'view'").select(key.cast("string").alias("output_row_id"), F.when(K() % 5 != 0, F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")))).otherwise(_none()).alias("source_ids"), F.lit(False).alias("malformed"))


def _provenance(e: DataFrame, repeat: int) -> DataFrame:
    rows = e.select(K().cast("string").alias("row_id"), F.when(K() % 10 == 3, F.array(F.lit("x"))).otherwise(_none()).alias("sources"))
    return Q.attributed(rows, Q.lineage_map(_lines(e, repeat)), "row_id", "sources")


_e("ag9_lineage_map", lambda e: Q.lineage_map(_lines(e, 0)).select("output_row_id", F.array_join("source_ids", ",").alias("sources"), "void"), "SELECT CAST(event_id AS VARCHAR) AS output_row_id, concat('u', user_id) AS sources, false AS void FROM events WHERE event_type = 'view' AND event_id % 5 <> 0")
_e(
    "ag9_lineage_map_void",
    lambda e: Q.lineage_map(_lines(e, 6)).agg(F.count("*").alias("ids"), F.bool_and("void").alias("void")),
    "WITH l AS (SELECT CASE WHEN event_id % 6 = 1 THEN event_id - 1 ELSE event_id END AS k FROM events WHERE event_type = 'view' AND event_id % 5 <> 0) SELECT count(DISTINCT k) AS ids, count(*) > count(DISTINCT k) AS void FROM l",
)
_e("jn8_has_provenance", lambda e: _provenance(e, 0).select("row_id", "attributed"), "SELECT CAST(event_id AS VARCHAR) AS row_id, (event_id % 10 = 3) OR (event_type = 'view' AND event_id % 5 <> 0) AS attributed FROM events")
_e(
    "jn9_document_provenance",
    lambda e: Q.unattributed_count(_provenance(e, 0), e.where("event_type = 'click'")),
    "SELECT count(*) FILTER (NOT ((event_id % 10 = 3) OR (event_type = 'view' AND event_id % 5 <> 0))) AS missing, count(*) AS total, (SELECT count(*) > 0 FROM events WHERE event_type = 'click') AS enforced FROM events",
)


def _fetched(e: DataFrame) -> DataFrame:
    return e.select(
        K().cast("string").alias("id"), (F.col("event_type") != "error").alias("ok"), F.when(K() % 4 == 0, F.concat(K().cast("string"), F.lit(".PDF"))).when(K() % 4 == 1, F.lit(" ")).otherwise(F.concat(K().cast("string"), F.lit(".bin"))).alias("object_key"),
        F.when(K() % 3 == 0, F.lit("text/html; charset=utf-8")).when(K() % 3 == 1, F.lit("Application/PDF ;q=1")).alias("content_type"), F.lit(False).alias("malformed"),
    )


_e("tx25_fetched_documents", lambda e: Q.fetched_documents(_fetched(e)), "SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE event_type <> 'error' AND event_id % 4 <> 1 AND (event_id % 3 <> 0 OR event_id % 4 = 0)")
_e("tx26_last_line_wins", lambda e: Q.last_by_key(e.select(F.col("user_id").alias("id"), K().alias("line"), "event_type")).select("id", "line", "event_type"), "SELECT user_id AS id, max(event_id) AS line, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
_e(
    "tx27_ledger_conflicts",
    lambda e: Q.ledger_conflicts(e.select(K().alias("id"), F.concat(F.lit("http://x/"), (K() % 9).cast("string")).alias("url")), e.where("event_id % 2 = 0").select(K().alias("id"), F.when(K() % 6 != 0, F.concat(F.lit("http://x/"), (K() % 7).cast("string"))).alias("url"))).select("id", "recorded"),
    "SELECT event_id AS id, CASE WHEN event_id % 6 <> 0 THEN concat('http://x/', event_id % 7) END AS recorded FROM events WHERE event_id % 2 = 0 AND (event_id % 6 = 0 OR event_id % 9 <> event_id % 7)",
)
def _HEX() -> Column:
    return F.sha2(K().cast("string"), 256)




def _parts(e: DataFrame) -> DataFrame:
    """A manifest for each user, of its events: some with a gap, a repeat, a bad digest or a negative size."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    u = F.col("user_id")
    p = e.withColumn("n", n)
    part = F.when((u % 6 == 1) & (F.col("n") == 2), 1).when((u % 6 == 2) & (F.col("n") >= 3), F.col("n") + 1).otherwise(F.col("n"))
    return p.select(u.alias("manifest"), part.alias("part"), F.when((u % 6 == 3) & (F.col("n") == 1), F.lit("abc")).otherwise(_HEX()).alias("sha256"), F.when((u % 6 == 4) & (F.col("n") == 0), -1).otherwise(10).alias("byte_size"))


_e(
    "sc22_manifest_audit",
    lambda e: Q.manifest_audit(_parts(e)).select("manifest", "n", "valid"),
    """WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events), q AS (SELECT user_id AS manifest, CASE WHEN user_id % 6 = 1 AND n = 2 THEN 1 WHEN user_id % 6 = 2 AND n >= 3 THEN n + 1 ELSE n END AS part, (user_id % 6 = 3 AND n = 1) OR (user_id % 6 = 4 AND n = 0) AS bad FROM p)
    SELECT manifest, count(*) AS n, NOT bool_or(bad) AND count(DISTINCT part) = count(*) AND max(part) = count(*) - 1 AS valid FROM q GROUP BY 1""",
)

# -- keys, feeds, replay -------------------------------------------------------------------------------
_e(
    "se3_absorb_feed",
    lambda e: Q.absorbed(e.select(K().alias("seq"), F.col("user_id").alias("id"), F.col("event_type").alias("digest"))).select("seq", "supersedes"),
    "SELECT seq, n > 1 AS supersedes FROM (SELECT event_id AS seq, event_type, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE before IS NULL OR before <> event_type",
)
_e("st2_resume_from_cursor", lambda e: e.where(K() > 5000).select(K().alias("seq")), "SELECT event_id AS seq FROM events WHERE event_id > 5000")
_e("se4_collapse_specs", lambda e: Q.collapsed(e.select(K(), "user_id", "event_type"), ["user_id", "event_type"], "event_id").select("event_id", "first"), "SELECT event_id, min(event_id) OVER (PARTITION BY user_id, event_type) AS first FROM events")


def _replay(e: DataFrame, which: int) -> DataFrame:
    ledger = e.where("event_id % 3 = 0").select("user_id", "event_type").distinct().withColumn("key", Q.content_key("user_id", "event_type")).select("key", F.concat_ws("/", "user_id", "event_type").alias("result"))
    return Q.replay(e.select(K(), "user_id", "event_type"), ledger, ["user_id", "event_type"])[which]


_e("se6_replay_hits", lambda e: _replay(e, 0).select("event_id", "result"), "SELECT event_id, concat(user_id, '/', event_type) AS result FROM events a WHERE EXISTS (SELECT 1 FROM events b WHERE b.event_id % 3 = 0 AND a.user_id = b.user_id AND a.event_type = b.event_type)")
_e("se6_replay_work", lambda e: _replay(e, 1).select("event_id"), "SELECT event_id FROM events a WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.event_id % 3 = 0 AND a.user_id = b.user_id AND a.event_type = b.event_type)")
_PT = ["user_id", "event_type"]
_e("se7_append_points", lambda e: Q.new_points(e.where("event_id % 2 = 0").select(*_PT), e.where("event_id % 5 = 0").select(*_PT), _PT), "SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 2 = 0 EXCEPT SELECT user_id, event_type FROM events WHERE event_id % 5 = 0")
_e("se8_replace_series", lambda e: Q.replaced(e.select(F.col("event_type").alias("series"), "value"), e.where("event_type in ('view', 'click')").select("value"), "click").groupBy("series").agg(F.count("*").alias("n")), "SELECT CASE WHEN event_type = 'view' THEN 'view' ELSE event_type END AS series, CASE WHEN event_type = 'click' THEN (SELECT count(*) FROM events WHERE event_type IN ('view', 'click')) ELSE count(*) END AS n FROM events GROUP BY event_type")
_e(
    "se9_one_to_one",
    lambda e: Q.one_to_one(e.where("event_type <> 'error'").select(K().alias("idx")), e.where("event_id % 10 <> 3").select(F.when(K() % 10 == 7, K() - 1).otherwise(K()).alias("idx"))),
    "WITH x AS (SELECT event_id AS idx FROM events WHERE event_type <> 'error'), y AS (SELECT CASE WHEN event_id % 10 = 7 THEN event_id - 1 ELSE event_id END AS idx, count(*) AS n FROM events WHERE event_id % 10 <> 3 GROUP BY 1) SELECT coalesce(x.idx, y.idx) AS idx, CASE WHEN x.idx IS NULL THEN 'out of range' WHEN n IS NULL THEN 'missing' ELSE 'duplicate' END AS error FROM x FULL JOIN y ON x.idx = y.idx WHERE x.idx IS NULL OR n IS NULL OR n > 1",
)
_e(
    "jn12_upsert",
    lambda e: Q.upserted(e.where("event_id % 2 = 0").select(K().alias("id"), F.col("event_type").alias("a"), F.col("user_id").alias("b")), e.where("event_id % 3 = 0").select(K().alias("id"), F.when(K() % 9 != 0, F.lit("new")).alias("a"), (F.col("user_id") + 1).alias("b"))),
    "SELECT event_id AS id, CASE WHEN event_id % 3 = 0 AND event_id % 9 <> 0 THEN 'new' WHEN event_id % 2 = 0 THEN event_type END AS a, CASE WHEN event_id % 3 = 0 THEN user_id + 1 ELSE user_id END AS b FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0",
)
def _J() -> Column:
    return F.when(K() % 5 == 0, F.lit("false")).when(K() % 5 == 1, F.lit("[]")).when(K() % 5 == 2, F.lit("null")).when(K() % 5 == 3, F.lit('" "')).otherwise(F.lit("7"))


def _RULE() -> Column:
    return F.when(K() % 4 == 0, "always").when(K() % 4 == 1, "truthy").when(K() % 4 == 2, "falsey").otherwise("nonempty")


_e(
    "tx19_requires_evidence",
    lambda e: e.select("event_id", Q.requires_evidence(_J(), _RULE()).alias("required")),
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN event_id % 5 IN (3, 4) WHEN 2 THEN event_id % 5 IN (0, 1, 2) ELSE event_id % 5 IN (0, 4) END AS required FROM events",
)
_e("tx20_inclusion_audit", lambda e: e.select("event_id", F.when(K() % 7 != 0, K() % 2 == 0).alias("contradicted"), (K() % 3 == 0).alias("excluded")).select("event_id", Q.inclusion_supported().alias("supported")), "SELECT event_id, NOT (CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END OR event_id % 3 = 0) AS supported FROM events")
_e(
    "tx21_verdicts",
    lambda e: Q.one_to_one(e.where("event_type = 'view'").select(K().alias("idx")), e.where("event_type = 'view' and event_id % 8 <> 0").select(K().alias("idx"))),
    "SELECT event_id AS idx, 'missing' AS error FROM events WHERE event_type = 'view' AND event_id % 8 = 0",
)
def _PTR() -> Column:
    return F.when(K() % 3 == 0, "/k").when(K() % 3 == 1, "/raw/k").otherwise("/nope")


_e("tx15_pointer_deep", lambda e: Q.resolved_pointers(e.select("event_id", F.col("props").alias("raw"), _PTR().alias("path"))).select("event_id", "value", "error"), "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN json_extract_string(props, '$.k') END AS value, CASE WHEN event_id % 3 = 2 THEN 'not found' END AS error FROM events")
_e("tx15_pointer_flat", lambda e: e.select("event_id", F.expr("1").alias("x"), "props", F.lit("/k").alias("path")).select("event_id", F.get_json_object("props", "$.k").alias("value")), "SELECT event_id, json_extract_string(props, '$.k') AS value FROM events")
_e(
    "jn11_evidence_references",
    lambda e: Q.uncited(e.select(K().alias("record"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("predicate")), e.select(K().alias("record"), F.when(K() % 2 == 0, "a").otherwise("b").alias("predicate")), ["record", "predicate"]),
    "SELECT event_id AS record, CASE WHEN event_id % 2 = 0 THEN 'b' ELSE 'a' END AS predicate FROM events",
)
_e("ag11_batch_progress", lambda e: D.batch_progress(e.select((F.col("user_id") % 10).alias("batch"), F.when(F.col("event_type") == "error", F.lit("bad")).alias("error"), (K() % 4 == 0).alias("cached"))), "SELECT user_id % 10 AS batch, count(*) AS total, count(*) FILTER (event_type <> 'error') AS completed, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_id % 4 = 0) AS cache_hits FROM events GROUP BY 1")
_e("tx11_batch_shape", lambda e: e.select("event_id", F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k")).alias("result"), F.when(F.col("event_type") == "error", "failed").alias("error")), "SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS result, CASE WHEN event_type = 'error' THEN 'failed' END AS error FROM events")
_e(
    "tx14_rows_from_result",
    lambda e: D.rows_from_result(e.select("event_id", F.when(K() % 2 == 0, F.concat(F.lit("["), F.col("props"), F.lit(", 5]"))).otherwise(F.concat(F.lit('{"rows": ['), F.col("props"), F.lit("]}"))).alias("j")), "j", {"k": "int"}).select("event_id", "row", "k"),
    "SELECT event_id, 0 AS row, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)

# -- tables in text -------------------------------------------------------------------------------------


def _sheet(s: SparkSession, d: str) -> DataFrame:
    """A text for each customer: prose, a pipe table of two rows (one half empty), and for some a broken one."""
    c = table(s, d, "customer")
    row = F.concat(F.lit("| "), F.col("c_name"), F.lit(" | "), F.col("c_mktsegment"), F.lit(" | "), F.col("c_nationkey").cast("string"), F.lit(" |"))
    sheet = F.concat(F.lit("Some words.\n\n| Customer Name | Mkt-Segment | N. |\n|---|:---:|---|\n"), row, F.lit("\n|  | "), F.col("c_mktsegment"), F.lit(" |\n|  |  |  |"))
    more = F.when(F.col("c_custkey") % 3 == 0, F.lit("\n\nname | no pipe first\n<TR><td>x</td></tr>")).otherwise(F.lit(""))
    return c.select("c_custkey", F.concat(sheet, more).alias("text"))


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select("c_custkey", "row", *(F.try_element_at("cells", F.lit(k)).alias(k) for k in ("customer_name", "mkt_segment", "n")))


_ROWS = "SELECT c_custkey, 0 AS row, c_name AS customer_name, c_mktsegment AS mkt_segment, CAST(c_nationkey AS VARCHAR) AS n FROM customer UNION ALL SELECT c_custkey, 1, NULL, c_mktsegment, NULL FROM customer"
register("tx1_parse_markdown_table", lambda s, d: _flat(_sheet(s, d).select("c_custkey", F.posexplode(D.table_rows(F.element_at(F.split("text", "\n\n"), 2))).alias("row", "r")).withColumn("cells", F.map_from_entries("r"))), _ROWS)
register("tx2_tables_in_text", lambda s, d: _flat(D.tables_in_text(_sheet(s, d))), _ROWS)
register("tx3_apparent_rows", lambda s, d: _sheet(s, d).select("c_custkey", D.apparent_rows("text").alias("n")), "SELECT c_custkey, 2 + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS n FROM customer")
register("tx3_apparent_rows_of_pages", lambda s, d: table(s, d, "pages").select("page_id", D.apparent_rows("html").alias("n")), "SELECT page_id, len(regexp_extract_all(lower(html), '<tr\\b')) AS n FROM pages")


def _doc_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages of conversations: a turn is a page; some are lost, doubled, empty, or hold a table."""
    c, t = table(s, d, "conversations"), F.col("turn")
    own = F.when((F.col("conv_id") + t) % 9 == 4, F.lit(" ")).when((F.col("conv_id") + t) % 9 == 5, F.lit("| A |\n|---|\n| 1 |")).otherwise(F.col("text"))
    tables = F.when((F.col("conv_id") + t) % 9 == 6, F.array(F.struct(F.lit(" | B |\n| 2 | ").alias("content"), F.lit("markdown").alias("format")))).otherwise(F.array().cast("array<struct<content:string,format:string>>"))
    p = c.select(F.col("conv_id").alias("doc"), t.cast("int").alias("page_index"), own.alias("markdown"), tables.alias("tables"), ((F.col("conv_id") * 7 + t) % 50 / 100 + 0.5).alias("avg_conf"), F.lit(0.1).alias("min_conf"), F.lit(0).alias("arrival"))
    p = p.where((F.col("doc") + F.col("page_index")) % 9 != 7)
    return p.unionByName(p.where((F.col("doc") + F.col("page_index")) % 9 == 8).withColumn("arrival", F.lit(1)))


def _doc_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "conversations").groupBy(F.col("conv_id").alias("doc")).agg((F.max("turn") + 1).cast("int").alias("page_count"))


def _states(s: SparkSession, d: str) -> DataFrame:
    return D.page_states(_doc_counts(s, d), _doc_pages(s, d))


_ST = """c AS (SELECT conv_id AS doc, CAST(turn AS INT) AS page_index, CASE (conv_id + turn) % 9 WHEN 4 THEN ' ' WHEN 5 THEN '| A |' || chr(10) || '|---|' || chr(10) || '| 1 |' ELSE text END AS md, (conv_id + turn) % 9 AS k, (conv_id * 7 + turn) % 50 / 100.0 + 0.5 AS conf FROM conversations),
    e AS (SELECT doc, unnest(range(0, max(page_index) + 1)) AS page_index FROM c GROUP BY doc),
    s AS (SELECT e.doc, e.page_index, CASE WHEN c.doc IS NULL OR k = 7 THEN NULL ELSE md END AS md, CASE WHEN c.doc IS NULL OR k = 7 THEN 'missing' WHEN k = 8 THEN 'duplicate' WHEN k = 4 THEN 'empty' WHEN k IN (5, 6) THEN 'table' ELSE 'prose' END AS state, CASE WHEN k <> 7 THEN conf END AS conf,
        CASE WHEN k = 5 THEN 1 ELSE 0 END AS table_rows FROM e LEFT JOIN c ON c.doc = e.doc AND c.page_index = e.page_index),
    g AS (SELECT *, CASE WHEN conf < 0.7 THEN 'POOR' WHEN conf < 0.85 THEN 'FAIR' WHEN conf IS NOT NULL THEN 'GOOD' END AS grade FROM s),
    a AS (SELECT *, CASE WHEN state IN ('missing', 'duplicate', 'empty') THEN state || '_page' WHEN table_rows <= 0 THEN CASE WHEN grade IN ('POOR', 'FAIR') THEN 'no_apparent_table_low_confidence' ELSE 'no_apparent_table' END WHEN grade IN ('POOR', 'FAIR') THEN 'low_confidence' END AS reason FROM g)"""
register("jn10_page_states", lambda s, d: _states(s, d).select("doc", "page_index", "state"), f"WITH {_ST} SELECT doc, page_index, state FROM s")
register("ag10_page_audit", lambda s, d: D.page_audit(_states(s, d)).select("doc", "page_index", "page", "chars", "table_rows", "grade", "reason", "needs_review"), f"WITH {_ST} SELECT doc, page_index, page_index + 1 AS page, length(coalesce(md, '')) AS chars, table_rows, grade, reason, coalesce(reason IS NOT NULL AND reason <> 'no_apparent_table', false) AS needs_review FROM a")
register("ag10_document_text", lambda s, d: D.document_text(_states(s, d)).select("doc", F.sha2("text", 256).alias("digest")), f"WITH {_ST} SELECT doc, sha256(string_agg('## Page ' || (page_index + 1) || chr(10) || chr(10) || coalesce(md, ''), chr(10) || chr(10) ORDER BY page_index)) AS digest FROM s GROUP BY 1")


def _markers(s: SparkSession, d: str) -> DataFrame:
    st = _states(s, d)
    rows = D.tables_in_text(st.select("doc", "page_index", F.col("markdown").alias("text"))).select("doc", "page_index", "row", "cells")
    return D.rows_or_markers(st, rows).select("doc", "page_index", "kind")


register("tx9_rows_or_markers", _markers, f"WITH {_ST} SELECT doc, page_index, CASE WHEN table_rows > 0 THEN 'row' WHEN state IN ('missing', 'duplicate', 'empty') THEN 'unresolved' ELSE 'page_audit' END AS kind FROM s")
register("tx4_page_text", lambda s, d: _doc_pages(s, d).where("arrival = 0").select("doc", "page_index", F.sha2(D.page_text("markdown", "tables"), 256).alias("digest")), f"WITH {_ST} SELECT doc, page_index, sha256(md || CASE WHEN k = 6 THEN chr(10) || chr(10) || '| B |' || chr(10) || '| 2 |' ELSE '' END) AS digest FROM c WHERE k <> 7")
register("tx5_table_evidence", lambda s, d: _doc_pages(s, d).where("arrival = 0").select("doc", "page_index", D.table_evidence("markdown", "tables").alias("evidence")), f"WITH {_ST} SELECT doc, page_index, k IN (5, 6) AS evidence FROM c WHERE k <> 7")


def _pref(s: SparkSession, d: str) -> DataFrame:
    p = _doc_pages(s, d).where("arrival = 0")
    structured = p.select("doc", "page_index", F.explode("tables").alias("t")).select("doc", "page_index", F.explode(D.table_rows(F.trim("t.content"))).alias("r")).withColumn("source", F.lit("structured"))
    inline = D.tables_in_text(p.select("doc", "page_index", F.col("markdown").alias("text"))).select("doc", "page_index", F.map_entries("cells").alias("r")).withColumn("source", F.lit("text"))
    return D.preferred_rows(structured.select("doc", "page_index", "source"), inline.select("doc", "page_index", "source"), ["doc", "page_index"])


register("tx29_preferred_rows", _pref, f"WITH {_ST} SELECT doc, page_index, CASE k WHEN 6 THEN 'structured' ELSE 'text' END AS source FROM c WHERE k IN (5, 6)")
register("pf19_review_reason", lambda s, d: D.page_audit(_states(s, d)).select("doc", "page_index", D.needs_review(F.col("grade"), F.col("table_rows")).alias("review")), f"WITH {_ST} SELECT doc, page_index, table_rows <= 0 OR coalesce(grade IN ('POOR', 'FAIR'), false) AS review FROM g")
register("pf20_confidence_grade", lambda s, d: _doc_pages(s, d).select("doc", "page_index", "arrival", D.grade(F.when(F.col("page_index") % 2 == 0, F.col("avg_conf")), F.col("min_conf")).alias("grade")), f"WITH {_ST}, p AS (SELECT *, 0 AS arrival FROM c WHERE k <> 7 UNION ALL SELECT *, 1 FROM c WHERE k = 8) SELECT doc, page_index, arrival, CASE WHEN page_index % 2 = 1 THEN 'POOR' WHEN conf < 0.7 THEN 'POOR' WHEN conf < 0.85 THEN 'FAIR' ELSE 'GOOD' END AS grade FROM p")
def _SUS() -> Column:
    return F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("aB cD eF "), F.col("text"))).when(F.col("doc_id") % 50 == 1, F.concat(F.lit("�"), F.col("text"))).otherwise(F.col("text"))


_SUS_SQL = "CASE WHEN doc_id % 50 = 0 THEN 'aB cD eF ' || text WHEN doc_id % 50 = 1 THEN chr(65533) || chr(57345) || chr(63743) || text ELSE text END"
_SUSPECT = "(len(regexp_extract_all({0}, '[\\x{{FFFD}}\\x{{E000}}-\\x{{F8FF}}]')) >= 3 OR len(regexp_extract_all({0}, '(?:^|[^\\p{{L}}\\p{{N}}_])[a-z]+[A-Z]')) >= 3)"
register("pf18_suspect_text", lambda s, d: table(s, d, "documents").select("doc_id", D.suspect_text(_SUS()).alias("suspect")), f"SELECT doc_id, {_SUSPECT.format(_SUS_SQL)} AS suspect FROM documents")
register("tx12_probe", lambda s, d: D.probe(table(s, d, "documents").withColumn("text", _SUS())).select("doc_id", "chars", "likely_scanned", "suspect", F.length("sample").alias("sampled")), f"SELECT doc_id, length(t) AS chars, length(t) < 200 AS likely_scanned, {_SUSPECT.format('left(t, 600)')} AS suspect, length(left(t, 600)) AS sampled FROM (SELECT doc_id, {_SUS_SQL} AS t FROM documents)")
register("fn26_snake_case", lambda s, d: table(s, d, "customer").select("c_custkey", D.snake_case(F.concat(F.lit(" #"), F.col("c_name"), F.lit(" (Seg.) "), F.col("c_mktsegment"), F.lit("! "))).alias("name")), "SELECT c_custkey, regexp_replace(regexp_replace(lower(trim(' #' || c_name || ' (Seg.) ' || c_mktsegment || '! ')), '[^0-9a-zA-Z]+', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM customer")


def _tx7(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "customer")
    pairs = {"Mkt Seg": F.col("c_mktsegment"), "Nation #": F.col("c_nationkey").cast("string"), "_page": F.lit("1"), "segment": F.when(F.col("c_custkey") % 2 == 0, "later")}
    cells = F.map_from_entries(F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs.items())))
    out = D.with_constants(D.row_schema(cells, {"mkt_seg": "segment"}, ["segment", "amount"]), {"Amount": F.lit("9"), "source url": F.col("c_name"), "none": F.lit(None)})
    return c.select("c_custkey", out.alias("m")).select("c_custkey", F.array_join(F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit("null"))))), ";").alias("row"))


register("tx7_tx8_row_schema_and_constants", _tx7, "SELECT c_custkey, '_page=1;amount=null;nation=' || c_nationkey || ';segment=' || CASE WHEN c_custkey % 2 = 0 THEN 'later' ELSE 'null' END || ';source_url=' || c_name AS row FROM customer")


def _tx10(s: SparkSession, d: str) -> DataFrame:
    c, k = table(s, d, "customer"), F.col("c_custkey")
    rows = c.select(F.when(k % 4 == 0, F.lit(" NaN ")).otherwise(F.col("c_name")).alias("name"), F.when(k % 2 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("seg"))
    return D.table_frame_rows(rows, 2, "FAIR", "parser")


register("tx10_table_frame_rows", _tx10, "SELECT name, seg, 2 AS _page_index, 3 AS _page, 'FAIR' AS _page_grade, 'parser' AS _source FROM (SELECT CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 2 <> 0 THEN c_mktsegment END AS seg FROM customer) WHERE name IS NOT NULL OR seg IS NOT NULL")
