"""Tables cut from their lineage, written to the folder that the whole cluster shares, and the session's Arrow batches."""

from pyspark.sql import SparkSession

from skein.sources.stage import discard, fresh_path, shared_dir, spread, staged

__all__ = ["discard", "fresh_path", "shared_dir", "small_batches", "spread", "staged"]

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch. Spark counts batches in rows, and whole texts are long ones.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, whose Arrow batches are made smaller where they have Spark's own size."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return spark
