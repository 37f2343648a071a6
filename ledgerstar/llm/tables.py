"""Intermediate tables of corpus operators, in sessions that hand texts to Python in small parts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerstar import scratch

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST = "8m"  # Spark's own bound is 10,000 rows, which may be long texts


class Tables(scratch.Tables):
    """Tables of one run. A session that sets no bound on the bytes of an Arrow batch gets one."""

    def __init__(self, spark: SparkSession, label: str):
        super().__init__(spark, label)
        if BATCH_BYTES not in spark.conf.getAll:
            spark.conf.set(BATCH_BYTES, MOST)
