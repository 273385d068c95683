"""Read-only SQL with limits, and results of parts."""

from __future__ import annotations

import time

import pytest
from pyspark.errors import PySparkException

from tidemark.sources import catalog as C
from tidemark.sources.statements import NotReadOnly, OverLimit, read_only
from tidemark.sources.storage import new_path, shared_dir


@pytest.fixture(scope="module")
def lake(spark):
    root = new_path(spark, "lake")
    spark.range(1000).selectExpr("id AS ticker", "id % 7 AS val", "2020 + id % 3 AS year").write.partitionBy("year").parquet(f"{root}/facts")
    k = C.Lake(spark, root, {"facts": C.Dataset("facts", "year", "ticker", ("ticker", "val"))})
    assert k.register() == ["facts"]
    return k


@pytest.mark.parametrize(
    "statement",
    [
        "DROP VIEW facts", "DROP VIEW IF EXISTS facts", "CREATE TEMP VIEW other AS SELECT 1", "CREATE TABLE other USING parquet AS SELECT 1 AS a", "INSERT INTO facts SELECT 1, 2, 3",
        "INSERT OVERWRITE DIRECTORY '/tmp/tidemark-never' USING parquet SELECT 1", "FROM facts INSERT INTO facts SELECT *", "WITH a AS (SELECT 1) INSERT INTO facts SELECT 1, 2, 3",
        "SET spark.sql.shuffle.partitions = 3", "RESET", "CLEAR CACHE", "CACHE TABLE facts", "REFRESH facts", "USE other", "TRUNCATE TABLE facts", "EXPLAIN SELECT 1", "ADD JAR 'x.jar'", "DECLARE v = 1",
        "BEGIN DROP VIEW facts; END", "SELECT 1; DROP VIEW facts", "SELECT 1) AS q; DROP VIEW facts --", "SELECT 1 AS a) UNION ALL (SELECT 2", "", "/* SELECT 1 */", "SELECT 1 /*",
        "SELECT TRANSFORM(ticker) USING 'cat' AS (a) FROM facts", "SELECT TRANSFORM(ticker) USING /* x */ r'cat' AS (a) FROM facts", "SELECT reflect('java.lang.System', 'exit', 1)", "SELECT java_method('java.util.UUID', 'randomUUID')",
        "SELECT `java_method`('java.util.UUID', 'randomUUID')", "SELECT * FROM parquet.`/etc`", "SELECT * FROM parquet . -- x\n`/etc`", "SELECT * FROM IDENTIFIER('parquet.`/etc`')",
    ],
)
def test_only_queries_run(spark, lake, statement):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises((NotReadOnly, PySparkException)):
        lake.sql(statement)
    assert spark.catalog.tableExists("facts") and not spark.catalog.tableExists("other")
    assert spark.table("facts").count() == 1000 and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_text_that_only_looks_like_a_command(lake):
    query = r"""SELECT ')' AS a, "reflect(" AS b, r'\' AS c, 'it\'s ) USING ''x''' AS d /* ) DROP VIEW facts */, -- )
        `val` AS `a (b` FROM facts WHERE ticker = ? ;  """
    row = lake.sql(query, [8]).first()
    assert tuple(row) == (")", "reflect(", "\\", "it's ) USING 'x'", 1)
    assert read_only("VALUES (1), (2)").startswith("SELECT * FROM")
    assert [r[0] for r in lake.sql("VALUES (2), (1)").orderBy("col1").collect()] == [1, 2]
    assert [r["ticker"] for r in lake.sql("SELECT ticker FROM facts ORDER BY val DESC, ticker DESC LIMIT 3").collect()] == [993, 986, 979]
    assert lake.sql("WITH a AS (SELECT * FROM facts) SELECT count(*) AS n FROM a JOIN facts USING (ticker)").first()["n"] == 1000


def test_results_within_limits(lake):
    query = "SELECT ticker, val FROM facts WHERE array_contains(?, val) ORDER BY ticker"
    got = lake.sql(query, [[1, 2]], max_rows=286, max_bytes=1 << 20, seconds=120)
    assert sorted(r["ticker"] for r in got.collect()) == [i for i in range(1000) if i % 7 in (1, 2)]
    assert got.schema == lake.sql(query, [[1, 2]]).schema
    assert lake.sql("SELECT 1 AS a WHERE false", seconds=60, max_rows=0).count() == 0


def _kept(spark):
    fs = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}/result-*"))
    return len(found)


def test_results_over_a_limit_are_not_kept(spark, lake):
    before = _kept(spark)
    for limits, limit in (({"max_rows": 285, "seconds": 60}, "max_rows"), ({"max_bytes": 100}, "max_bytes")):
        with pytest.raises(OverLimit) as e:
            lake.sql("SELECT * FROM facts WHERE val IN (1, 2)", **limits)
        assert e.value.limit == limit
    assert _kept(spark) == before
    with pytest.raises(PySparkException, match="more than 285 rows"):
        lake.sql("SELECT * FROM facts WHERE val IN (1, 2)", max_rows=285).collect()


def test_a_slow_query_is_cancelled(spark, lake):
    began = time.monotonic()
    with pytest.raises(OverLimit, match="more than 2 seconds") as e:
        lake.sql("SELECT id % 10 AS k, sum(id * 31 % 7) AS s FROM range(0, 100000000000000, 1, 4) GROUP BY id % 10", seconds=2)
    assert e.value.limit == "seconds" and time.monotonic() - began < 30
    assert len(spark.sparkContext.getJobTags()) == 0
    assert lake.sql("SELECT count(*) AS n FROM facts", seconds=60).first()["n"] == 1000


def test_a_growing_result_is_cancelled_by_its_bytes(lake):
    began = time.monotonic()
    with pytest.raises(OverLimit) as e:
        lake.sql("SELECT uuid() AS a, uuid() AS b FROM range(0, 2000000000, 1, 4)", max_bytes=1 << 22)
    assert e.value.limit == "max_bytes" and time.monotonic() - began < 60


def test_manifest_of_a_file_above_two_gigabytes(spark, tmp_path):
    """Files are streamed; what an earlier manifest has is not read again."""
    import hashlib

    from tidemark.operators import quality as Q

    small, large = tmp_path / "a b%.parquet", tmp_path / "b.parquet"
    small.write_bytes(b"abc")
    with large.open("wb") as f:
        f.truncate(3 << 30)  # no blocks on disk
    zeros, want = bytes(8 << 20), hashlib.sha256()
    for _ in range(3 << 7):
        want.update(zeros)
    first = Q.written_manifest(spark, str(tmp_path))
    rows = [r.asDict() for r in first.collect()]
    assert [(r["part"], r["sha256"], r["byte_size"]) for r in rows] == [(0, hashlib.sha256(b"abc").hexdigest(), 3), (1, want.hexdigest(), 3 << 30)]
    told = [{**r, "sha256": "f" * 64} for r in rows]
    small.write_bytes(b"abcd")
    again = Q.written_manifest(spark, str(tmp_path), spark.createDataFrame(told, first.schema)).orderBy("part").collect()
    assert [r["sha256"] for r in again] == [hashlib.sha256(b"abcd").hexdigest(), "f" * 64]
    assert Q.manifest_audit(first.withColumn("manifest", first.path.substr(1, 1))).first()["valid"]
