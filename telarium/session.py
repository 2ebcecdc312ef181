"""Session factory and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "telarium", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster, use the session that is there."""
    b = SparkSession.builder.appName(app).master(f"local[{cpus or '*'}]")
    for k, v in {**DEFAULTS, "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8", **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: spark.checkpoint.dir, or one of our own where that is unset (tests); a cluster must name it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="telarium-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def local_path(url: str) -> str:
    return url[len("file://"):] if url.startswith("file://") else url[len("file:"):] if url.startswith("file:") else url


#: Tables of each session, by its identity, that nothing has removed yet.
_settled: dict[str, list[str]] = {}


def _session(spark: SparkSession) -> str:
    return f"{spark.sparkContext.applicationId}/{spark._jsparkSession.hashCode()}"


def settle(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back.

    Cuts the lineage and keeps the rows through the loss of an executor; columnar and
    compressed, so cheaper on disk than checkpoint(). release() or the end of scope() removes the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    _settled.setdefault(_session(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove the tables that settle() wrote in this session so far; call it when all results built on them are written. The number removed."""
    return _remove(spark, _settled.pop(_session(spark), []))


def _remove(spark: SparkSession, paths: list[str]) -> int:
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    n = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside are removed at the end, others stay; write what is built on them before."""
    key = _session(spark)
    before = _settled.pop(key, [])
    try:
        yield
    finally:
        _remove(spark, _settled.pop(key, []))
        _settled[key] = before


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
