"""Tables cut from their lineage, written to the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes below which Spark makes no smaller splits of files.
SMALL_SPLIT = 4 << 20

_LOCAL: dict[str, str] = {}
#: Paths of this driver's staged tables.
_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, a temporary folder for a local master, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        if "dir" not in _LOCAL:
            _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="skein-")
        return _LOCAL["dir"]
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_skein_stage"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: later work starts from files that outlive executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Deletes all that `staged` has written so far and returns how many tables that were. Frames built on them can't be read any more: call it when results are written."""
    n = len(_STAGED)
    discard(spark, *_STAGED)
    _STAGED.clear()
    return n


def spread(df: DataFrame) -> DataFrame:
    """A small table dealt out to all cores. Files of one row group give one task however small the splits are; a table with so much for each core as Spark opens
    a file for stays as it is, and nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if cores > 1 and size < cores * SMALL_SPLIT else df


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes written folders that no later plan reads."""
    jvm = spark._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
