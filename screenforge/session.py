"""Session helpers."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver found it.

    On a cluster whose nodes have it elsewhere, ship it as usual (--py-files); the extra path does no harm there.
    """
    places = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*places, _ROOT])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application's in spark.checkpoint.dir, which driver and executors share; it goes when the driver ends.

    Without that setting, it is in the warehouse if Spark runs in this process alone; on a cluster that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_shared")
    folder = f"{folder.rstrip('/')}/tables-{context.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return folder


def isolated(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of the same application with settings of its own; names with `__` for `.`."""
    own = prepare(spark.newSession())
    for name, value in settings.items():
        own.conf.set(name.replace("__", "."), value)
    return own


def spread(df: DataFrame) -> DataFrame:
    """df, dealt to all cores if it is read in fewer pieces than there are; rows are few then."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def small_batches(df: DataFrame, most_bytes: int = 4 << 20) -> DataFrame:
    """df; from now on its session passes rows to Python workers in batches of at most about so many bytes (one row at least).

    By Spark's own limits a batch of texts takes up to 64 MB, beside the heap and again in the worker.  A lower limit stays.
    """
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > most_bytes:
        spark.conf.set(name, str(most_bytes))
    return df


def prepare(spark: SparkSession) -> SparkSession:
    """Of keys that repeat within a JSON object the last counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return importable(spark)
