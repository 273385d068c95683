"""Folders for intermediate tables, streams' state and written datasets."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


#: Folders of local applications for which none is set.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir, else the context's.

    Where neither is set, a folder of this machine will do for local[...] only, as in tests: one for
    each application, which goes when the process ends. On a cluster that raises.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return f"file://{_OWN[app]}"


def new_path(spark: SparkSession, stem: str) -> str:
    """A path in the shared folder that no other call is given."""
    return f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}/{stem}-{uuid.uuid4().hex}"


def written(df: DataFrame, stem: str = "part") -> DataFrame:
    """df as a Parquet table in the shared folder: made once, whatever reads it, and lost executors don't matter."""
    spark = df.sparkSession
    path = new_path(spark, stem)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under path so far, those still being written included; 0 where it isn't there."""
    fs, at = _file_system(spark, path)
    try:
        return fs.getContentSummary(at).getLength() if fs.exists(at) else 0
    except Py4JJavaError:  # files move while a job commits; the next look sees them
        return 0


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def clean_up(spark: SparkSession) -> None:
    """Deletes what this application has written there; call it once the results have been read."""
    delete(spark, f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}")
