"""Screening of arriving JSON lines as a stream: every micro-batch is routed and its counters are appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScreenConfig
from ..functions.text import output_basename
from ..operators import stats
from ..plans.screen import facts
from ..session import prepare
from ..sources import sinks


def start(spark: SparkSession, folder: str, output: str, checkpoint: str, key: str, config: ScreenConfig, detector=None, **trigger):
    """Starts a query over the .jsonl files that arrive in a folder.

    Lines go to output/lines by basename and bucket, counters to output/stats by batch; a batch that is run again
    after a failure replaces its own part.  trigger: as of DataStreamWriter.trigger, for instance availableNow=True.
    """
    prepare(spark)
    lines = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", "*.jsonl").text(folder)
    lines = lines.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:(//)?", "").alias("path"), "value")
    scored = facts(lines, key, config, detector).withColumn("basename", output_basename(F.col("path")))

    def settle(batch: DataFrame, number: int) -> None:
        # Scored once, staged where a lost executor loses nothing, and read from there.
        staged = f"{output}/_staged/batch={number}"
        batch.drop("v", "text", "line", "found").write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged)
        routed = rows.where("bucket is not null").select("value", "basename", "bucket")
        routed.write.mode("overwrite").option("lineSep", "\n").partitionBy("basename", "bucket").text(f"{output}/lines/batch={number}")
        stats.by_file(rows).write.mode("overwrite").parquet(f"{output}/stats/batch={number}")
        sinks.delete(spark, staged)

    return scored.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
