"""Intermediate tables in a folder that all nodes share.

The root is the setting ``spark.ledgerstar.scratch``, or else ``spark.checkpoint.dir``. Only a local
session may leave both unset; it then gets the machine's temporary folder. Folders are removed
when the driver's JVM ends.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = ("spark.ledgerstar.scratch", "spark.checkpoint.dir")


def root(spark: SparkSession) -> str:
    for key in SETTINGS:
        value = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
        if value:
            return value.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTINGS[0]} or {SETTINGS[1]} to a folder all nodes share")
    return tempfile.gettempdir()


def located(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop objects."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def folder(spark: SparkSession, label: str = "run") -> str:
    """A fresh, empty folder below the root."""
    path, system = located(spark, f"{root(spark)}/ledgerstar-{label}-{uuid.uuid4().hex}")
    system.mkdirs(path)
    system.deleteOnExit(path)
    return path.toString()


class Tables:
    """Parquet tables of one run of an operator."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, folder(spark, label)

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        """Write ``frame`` and return it as read back; this cuts its lineage."""
        frame.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        for name in names:
            path, system = located(self.spark, f"{self.base}/{name}")
            system.delete(path, True)
