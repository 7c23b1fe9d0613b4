"""Cutting the lineage of long plans in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = getattr(spark, "_spanloom_scratch", None) or tempfile.mkdtemp(prefix="spanloom-")
        spark._spanloom_scratch = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Later steps then start from a plain scan that survives lost executors. Where a local session
    names no folder (tests on one machine), a temporary one is used.
    """
    path = folder(spark, "settled")
    df.write.parquet(path)
    made(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def made(spark: SparkSession) -> list[str]:
    """Paths of the tables that :func:`settled` wrote in this session."""
    if not hasattr(spark, "_spanloom_made"):
        spark._spanloom_made = []
    return spark._spanloom_made


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`settled` that no later plan reads."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/settled-" in name:
            _delete(spark, name)


def released(spark: SparkSession, since: int, result: DataFrame) -> DataFrame:
    """A settled ``result``, after all other tables that :func:`made` has from place ``since`` on are deleted."""
    kept = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in result.inputFiles()}
    for path in made(spark)[since:]:
        if path.rsplit("/", 1)[-1] not in kept:
            _delete(spark, path)
    return result
