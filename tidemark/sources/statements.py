"""Statements that only read, and results that are written within limits of time, bytes and rows."""

from __future__ import annotations

import re
import threading
import time
import uuid

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .storage import delete, new_path, size_of

#: Seconds between two looks at a running query.
LOOK_EVERY = 0.2
#: Seconds that an interrupted query has to end.
PATIENCE = 10

#: What can hold any text without being part of the statement: comments, string literals (raw ones have no escapes), quoted names.
_QUOTED = re.compile(r"--[^\n]*|/\*.*?\*/|(?i:\br)(?:'[^']*'|\"[^\"]*\")|'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\"|`(?:``|[^`])*`", re.DOTALL)
#: Queries that do more than read the registered views, once quoted text is left out.
_REFUSED = {
    "runs a program": re.compile(r"\busing\s+''", re.IGNORECASE),
    "calls Java methods": re.compile(r"\b(?:(?:try_)?reflect|java_method)\b(?:``)?\s*\(", re.IGNORECASE),
    "reads files by path": re.compile(r"\b(?:parquet|orc|csv|json|text|xml|avro|binaryfile|jdbc)\s*\.\s*``", re.IGNORECASE),
    "calls Java methods by a quoted name": re.compile(r"``\s*\("),
    "names things by text": re.compile(r"\bidentifier\s*\(", re.IGNORECASE),
}


class NotReadOnly(ValueError):
    """The statement isn't a query, or one that reaches beyond the registered views."""


class OverLimit(RuntimeError):
    """A result went over a limit; `limit` is seconds, max_bytes or max_rows. Nothing of it is kept."""

    def __init__(self, limit: str, message: str) -> None:
        super().__init__(message)
        self.limit = limit


def _bare(m: re.Match[str]) -> str:
    return " " if m[0].startswith(("--", "/*")) else "``" if m[0][0] == "`" else " ''"


def read_only(statement: str) -> str:
    """The statement as a subquery, which the grammar lets be a query only: what is not one can't be parsed,
    so DROP, INSERT, CREATE, SET and the like never run. Order, names and markers for values are kept."""
    text = statement.strip().rstrip(";").rstrip()
    bare = _QUOTED.sub(_bare, text)
    depth = 0
    for c in bare:
        depth += (c == "(") - (c == ")")
        if depth < 0:
            raise NotReadOnly("brackets close before they open")
    for what, pattern in _REFUSED.items():
        if pattern.search(bare):
            raise NotReadOnly(f"the query {what}")
    return f"SELECT * FROM (\n{text}\n)"


def written_within(df: DataFrame, label: str, seconds: float | None = None, max_bytes: int | None = None, max_rows: int | None = None) -> DataFrame:
    """df's rows as a written table, or OverLimit.

    The jobs run in a thread and under a tag of their own; the caller looks at the clock and at the bytes
    written so far, and cancels the tag's jobs once either is over. The rows are counted as they are written,
    of which no more than max_rows + 1 are made. Spark stops a task between rows that it reads, so one
    that makes very many rows of a few in one loop goes on for a while; the caller waits PATIENCE for
    that, and what is left then deletes its files when it ends.
    """
    spark, path, tag = df.sparkSession, new_path(df.sparkSession, "result"), f"lake-{uuid.uuid4().hex}"
    counted, failed, done, left = Observation(), [], threading.Event(), threading.Event()
    rows = (df if max_rows is None else df.limit(max_rows + 1)).observe(counted, F.count(F.lit(1)).alias("n"))

    def write() -> None:
        spark.sparkContext.addJobTag(tag)
        try:
            rows.write.parquet(path)
        except Exception as e:  # noqa: BLE001  (the caller raises it)
            failed.append(e)
        finally:
            spark.sparkContext.removeJobTag(tag)
            done.set()
        if left.is_set():
            delete(spark, path)

    def too_big() -> bool:
        return max_bytes is not None and size_of(spark, path) > max_bytes

    began, over, since = time.monotonic(), None, 0.0
    InheritableThread(target=write, daemon=True).start()
    while not done.wait(LOOK_EVERY):
        if over is None and seconds is not None and time.monotonic() - began > seconds:
            over, since = OverLimit("seconds", f"{label} took more than {seconds} seconds"), time.monotonic()
        if over is None and too_big():
            over, since = OverLimit("max_bytes", f"{label} has more than {max_bytes} bytes"), time.monotonic()
        if over is not None:
            spark.sparkContext.cancelJobsWithTag(tag)  # again at each look: a job may start after it
            if time.monotonic() - since > PATIENCE:
                left.set()
                break
    if over is None and failed:
        raise failed[0]
    if over is None and max_rows is not None and counted.get["n"] > max_rows:
        over = OverLimit("max_rows", f"{label} has more than {max_rows} rows")
    if over is None and too_big():
        over = OverLimit("max_bytes", f"{label} has more than {max_bytes} bytes")
    if over is not None:
        if done.is_set():
            delete(spark, path)
        raise over
    return spark.read.schema(df.schema).parquet(path)
