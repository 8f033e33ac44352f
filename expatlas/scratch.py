"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, a folder of our own, on a local master only."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    if not found:
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}")
        found = sc.getCheckpointDir()
    return found.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, as they may not have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)


#: Spark's setting to delete the shuffle files of a query at its end.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage: a lost executor costs one stage and not the whole history, and the table can
    be read several times without computing it again. What was shuffled for it goes as soon as it is written.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing to come reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
