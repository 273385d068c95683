"""Contracts, pointers, manifests, tables and availability on small rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import availability as A
from tidemark.operators import documents as D
from tidemark.operators import quality as Q
from tidemark.sources import catalog as C


def test_pointers(spark):
    raw = '{"source": {"description": "Purchased", "a/b": ["first", "second"], "blank": " "}}'
    paths = ["/source/description", "/source/a~1b/1", "/source/a~1b/2", "/source", "", "/source/x~2", "/raw/source/description", "/source/blank", "/nope"]
    got = {r["path"]: (r["value"], r["error"]) for r in Q.resolved_pointers(spark.createDataFrame([(raw, p) for p in paths], "raw string, path string")).collect()}
    assert got["/source/description"] == got["/raw/source/description"] == ("Purchased", None)
    assert got["/source/a~1b/1"] == ("second", None)
    assert [got[p][1] for p in paths[2:6]] == ["not found", "container", "root", "bad escape"]
    assert got["/source/blank"][1] == "blank" and got["/nope"][1] == "not found"


def test_pointers_to_any_value(spark):
    raw = '{"a": {"0": "key", "it\'s \\"so\\"": 1, "~": "tilde", "": "empty key"}, "l": [10, null, true, {"x": 2.5}, []], "n": 12345678901234567890}'
    paths = {"/a/0": ("key", None), "/a/it's \"so\"": ("1", None), "/a/~0": ("tilde", None), "/a/": ("empty key", None), "/l/0": ("10", None), "/l/1": (None, "blank"), "/l/2": ("true", None), "/l/3/x": ("2.5", None), "/l/4": (None, "container"), "/l/00": (None, "not found"), "/l/-1": (None, "not found"), "/n": ("12345678901234567890", None), "a": (None, "not a pointer"), "/nope/~2": (None, "not found")}
    got = Q.resolved_pointers(spark.createDataFrame([(raw, p, 1) for p in paths] + [("{", "/a", 1), (None, "/a", 1), ("{}", None, 1)], "raw string, path string, value0 int")).collect()
    assert {r["path"]: (r["value"], r["error"]) for r in got[:-3]} == paths
    assert [r["error"] for r in got[-3:]] == ["unreadable"] * 3


def test_manifest(spark):
    good = "a" * 64
    rows = [("ok", 1, good, 1), ("ok", 0, good, 1), ("twice", 0, good, 1), ("twice", 0, good, 1), ("gap", 0, good, 1), ("gap", 2, good, 1), ("digest", 0, "abc", 1), ("negative", 0, good, -1), ("missing", None, good, 1)]
    got = {r["manifest"]: r["reason"] for r in Q.manifest_audit(spark.createDataFrame(rows, "manifest string, part int, sha256 string, byte_size long")).collect()}
    assert got == {"ok": None, "twice": "repeated", "gap": "gap", "digest": "digest", "negative": "negative", "missing": "missing"}


def test_feed(spark):
    feed = spark.createDataFrame([(1, "a", "d1"), (2, "a", "d1"), (3, "b", "x"), (4, "a", "d2"), (5, "a", "d1")], "seq long, id string, digest string")
    assert [(r["seq"], r["supersedes"]) for r in Q.absorbed(feed).orderBy("seq").collect()] == [(1, False), (3, False), (4, True), (5, True)]


def test_pipe_tables(spark):
    text = "words | more\n\n| Name | Value | Name |\n|---|---|---|\n| a | 1 | z |\n| b |  |\n|  |  |  |\n\n| X |\n| 1 |"
    got = D.tables_in_text(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc long, text string")).orderBy("block", "row").collect()
    assert [r["cells"] for r in got] == [{"value": "1", "name": "z"}, {"name": "b", "value": None}, {"x": "1"}]


def test_suspect_text(spark):
    d = spark.createDataFrame([("aB cD eF",), ("plain words",), ("�",), ("�x",)], "t string")
    assert [r[0] for r in d.select(D.suspect_text("t")).collect()] == [True, False, True, False]


def test_availability(spark):
    rows = [("2024-04-05", "2024-04-05"), ("2024-04-05", None), ("2024-04-05", "2024-04-06"), ("2024-04-05T10:00:00Z", None)]
    p = spark.createDataFrame(rows, "timestamp string, available_at string")
    seen = lambda kind, period=None: [(str(r["available"]) if r["available"] else None, r["error"] is None) for r in A.availability(p, kind, period).collect()]
    assert seen("observation") == [("2024-04-05 00:00:00", True)] * 2 + [(None, False), ("2024-04-05 10:00:00", True)]
    assert [x[1] for x in seen("disclosed")] == [True, False, True, False]
    quarter = spark.createDataFrame([("2024-10-01", None), ("2024-11-01", None), ("2024-12-01", None)], "timestamp string, available_at string")
    assert [str(r["available"]) for r in A.availability(quarter, "period_aggregate", "1q").collect()] == ["2025-01-01 00:00:00", "None", "None"]
    with pytest.raises(ValueError, match="period"):
        A.availability(p, "observation", "1d")


def test_types():
    assert C.spark_type("DECIMAL(10, 2)[]") == "array<decimal(10,2)>" and C.spark_type("VARCHAR(5)") == "string"
    for bad in ("DECIMAL(40,2)", "STRUCT(a INT)", "INT); DROP"):
        with pytest.raises(ValueError, match="not a type"):
            C.spark_type(bad)


def test_cap_fails_instead_of_cutting(spark):
    for use in (lambda d: d.collect(), lambda d: d.count()):
        with pytest.raises(Exception, match="more than 3"):
            use(C.capped(spark.range(4), 3, "the read"))
    assert C.capped(spark.range(3), 3, "the read").count() == 3


def test_row_contract(spark):
    d = spark.createDataFrame([("2024-01-01", 1.0, "A"), ("2024-1-1", 1.0, None), ("2024-01-01", float("nan"), None), ("2024-01-01", 1.0, " ")], "timestamp string, value double, ticker string")
    assert [r["reason"] for r in Q.validated(d).select(F.col("reason")).collect()] == [None, "timestamp", "value", "ticker"]


def test_point_fields(spark):
    p = spark.createDataFrame([("2024-01-01", 1.0, "A", "Stock", None)], "timestamp string, value double, ticker string, assetType string, availableAt string")
    assert A.normalized_points(p).columns == ["timestamp", "value", "ticker", "asset_type", "available_at"]
    assert A.normalized_points(A.normalized_points(p)).columns == ["timestamp", "value", "ticker", "asset_type", "available_at"]
    for bad in (p.withColumn("colour", F.lit(1)), p.drop("value"), p.drop("timestamp")):
        with pytest.raises(ValueError, match="unknown|required"):
            A.normalized_points(bad)


def test_symbols(spark):
    from tidemark.operators import select as K

    d = spark.createDataFrame([("btc",), (" Eth-usd ",), ("BITCOIN",), (" ",), (None,)], "s string")
    assert [tuple(r) for r in d.select(K.stock_asset("s"), K.crypto_asset("s")).collect()] == [("BTC", "BTC-USD"), ("ETH-USD", "ETH-USD"), ("BITCOIN", "BITCOIN-USD"), (None, None), (None, None)]


def test_inspect_and_contents(spark, tmp_path):
    spark.createDataFrame([(y, f"t{i}", i) for y in (2020, 2021) for i in range(y - 2015)], "year int, ticker string, val int").write.partitionBy("year").parquet(f"{tmp_path}/facts")
    spark.range(7).withColumnRenamed("id", "key").write.parquet(f"{tmp_path}/names/current")
    lake = C.Lake(spark, str(tmp_path), {d.name: d for d in (C.Dataset("facts", "year", "ticker", None), C.Dataset("names", "snapshot", "key", None), C.Dataset("absent", "day", "key", None))})
    types, head = lake.inspect("facts", 2021, 50)
    assert dict(types) == {"ticker": "string", "val": "int", "year": "int"} and head.count() == 6
    assert lake.inspect("names", rows=3)[1].count() == 3
    for name, year in (("facts", None), ("absent", 2020)):
        with pytest.raises(ValueError, match="state a year|partition"):
            lake.inspect(name, year)
    got = {(r["dataset"], r["part"]): (r["rows"], r["columns"]) for r in lake.contents().collect()}
    assert got == {("facts", "year=2020"): (5, ["ticker", "val", "year"]), ("facts", "year=2021"): (6, ["ticker", "val", "year"]), ("names", None): (7, ["key"])}


def test_a_feed_forgets_old_ids(spark, tmp_path):
    import datetime as dt
    import os
    import time

    from tidemark.streaming import feeds

    days = [("a", 1), ("b", 20), ("c", 21), ("a", 22), ("a", 23)]
    for k, (i, day) in enumerate(days):
        spark.createDataFrame([(i, k, "same", dt.datetime(2024, 1, day, 12))], "id string, seq long, digest string, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    os.mkdir(f"{tmp_path}/in")
    for k in range(len(days)):
        part = next(f for f in os.listdir(f"{tmp_path}/in{k}") if f.endswith(".parquet"))
        os.rename(f"{tmp_path}/in{k}/{part}", f"{tmp_path}/in/{k}.parquet")
        os.utime(f"{tmp_path}/in/{k}.parquet", (time.time() + k - 100,) * 2)
    for forget, want in (("7 days", [(0, False), (1, False), (2, False), (3, False)]), ("60 days", [(0, False), (1, False), (2, False)])):
        feed = spark.readStream.schema("id string, seq long, digest string, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        out = feeds.absorbed(feed, time="at", forget_after=forget)
        at = f"{tmp_path}/{forget[:2].strip()}"
        out.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start(f"{at}/out").awaitTermination()
        assert sorted((r["seq"], r["supersedes"]) for r in spark.read.parquet(f"{at}/out").collect()) == want


def test_shared_folder(spark):
    from tidemark.sources import storage

    own = storage.shared_dir(spark)
    assert own == storage.shared_dir(spark) and storage.new_path(spark, "x") != storage.new_path(spark, "x")
    spark.range(3).write.parquet(storage.new_path(spark, "x"))

    def session(master, conf=None, context=None):
        names = {"master": master, "applicationId": "app-1", "getCheckpointDir": staticmethod(lambda: context)}
        return type("S", (), {"conf": type("C", (), {"get": staticmethod(lambda k, d=None: conf or d)}), "sparkContext": type("X", (), names)})

    assert storage.shared_dir(session("spark://host", "hdfs://a")) == "hdfs://a"
    assert storage.shared_dir(session("spark://host", None, "hdfs://b")) == "hdfs://b"
    assert storage.new_path(session("local[2]", "hdfs://a"), "x").startswith("hdfs://a/tidemark-app-1/x-")
    with pytest.raises(ValueError, match="share"):
        storage.shared_dir(session("spark://host"))


def test_a_series_may_not_shrink(spark):
    series = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "series string, value double")
    new = spark.createDataFrame([(9.0,)], "value double")
    with pytest.raises(Exception, match="shrink"):
        Q.replaced(series, new, "a").collect()
    assert sorted(map(tuple, Q.replaced(series, new, "a", True).collect())) == [("a", 9.0), ("b", 3.0)]
    assert sorted(map(tuple, Q.replaced(series, new, "b").collect())) == [("a", 1.0), ("a", 2.0), ("b", 9.0)]


@pytest.mark.parametrize("forward", [False, True])
def test_asof_by_spans_equals_asof(spark, forward):
    import datetime as dt
    import random

    from tidemark.operators.asof import asof

    rnd = random.Random(5)
    when = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 400)) if rnd.random() < 0.97 else None
    left = spark.createDataFrame([(rnd.choice([1, 2, None]), when(), i) for i in range(300)], "k int, ts timestamp_ntz, i int")
    right = spark.createDataFrame([(rnd.choice([1, 2, None]), when(), float(rnd.randrange(9))) for i in range(40)] * 2, "k int, at timestamp_ntz, v double")
    got = [sorted(map(tuple, asof(left, right, ["k"], "ts", "at", {"v": F.col("v")}, "found", forward, span).collect()), key=str) for span in (None, "month", "day")]
    assert got[0] == got[1] == got[2] and len(got[0]) == 300


def test_points_of_fields(spark):
    from tidemark.operators import availability as A

    rows = [
        (0, {"timestamp": "2024-01-02", "value": "1.5", "assetType": "Stock", "availableAt": "2024-01-03"}),
        (1, {"timestamp": "2024-01-02", "value": "1.5", "asset_type": "a", "assetType": "b", "ticker": "T"}),
        (2, {"timestamp": "2024-01-02", "value": "1", "zeta": "1", "Value": "2"}),
        (3, {"value": "1"}), (4, {"timestamp": "2024-01-02", "value": None}), (5, None), (6, {}),
    ]
    got = A.points_of(spark.createDataFrame(rows, "id int, fields map<string,string>"), "fields").orderBy("id").drop("id", "fields").collect()
    assert [tuple(r) for r in got[:2]] == [("2024-01-02", "1.5", None, "Stock", "2024-01-03", None), ("2024-01-02", "1.5", "T", "a", None, None)]
    assert [r["error"] for r in got[2:]] == ["unknown field Value", "no timestamp", "no value", "no timestamp", "no timestamp"]


def test_a_row_schema_computes_each_key_once(spark):
    rows = spark.createDataFrame([({"A b": "1", "a_b": "2", "_k": "3", "Alias": None},), ({},), (None,)], "m map<string,string>")
    out = rows.select(D.with_constants(D.row_schema("m", {"alias": "field"}, ["field", "more"]), {"A b": F.lit("9"), "New one": F.lit("8")}).alias("m"))
    assert [r["m"] for r in out.collect()] == [{"a_b": "2", "_k": "3", "field": None, "more": None, "new_one": "8"}, {"field": None, "more": None, "a_b": "9", "new_one": "8"}, None]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the entries' keys are made in one place, whose expression nullif() and the alias may repeat
    assert plan.count("map_entries(") == 1 and plan.count("regexp_replace(") <= 4
