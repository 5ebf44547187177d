"""Files that an earlier run has finished."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finished(files: DataFrame, earlier: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """Files (path, key, size) that the earlier manifest lists with the same key and size, and complete outputs.

    earlier: path, key, input_size_bytes, basename and row counts of an equally configured run.
    written: basename, bucket, lines of its outputs, if they are to be checked.
    """
    old = earlier.select("path", F.col("key").alias("__key"), F.col("input_size_bytes").alias("__size"), "basename", "kept_rows", "rejected_rows", "unknown_rows")
    same = files.join(old, "path").where(F.col("key").eqNullSafe(F.col("__key")) & (F.col("size") == F.col("__size")))
    if written is not None:
        wide = written.groupBy("basename").agg(*[F.sum(F.when(F.col("bucket") == b, F.col("lines")).otherwise(0)).alias(f"lines_{b}") for b in ("en", "non_selected", "unknown")])
        same = same.join(wide, "basename", "left").na.fill(0, ["lines_en", "lines_non_selected", "lines_unknown"]).where("lines_en = kept_rows and lines_non_selected = rejected_rows and lines_unknown = unknown_rows")
    return same.select("path", "basename")


def remaining(files: DataFrame, done: DataFrame) -> DataFrame:
    return files.join(done.select("path"), "path", "left_anti")
