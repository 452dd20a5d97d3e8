"""What Python workers need: the package, and batches that fit beside each other in memory."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Rows of one Arrow batch: of texts of a hundred thousand characters, this many still fit a worker's share.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Let workers import the package from where the driver did (on a cluster ship it with ``--py-files``),
    and hand them texts in batches of at most BATCH_ROWS unless the session asks for fewer."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
