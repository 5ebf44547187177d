"""Checks of a run, each a DataFrame of findings (empty: passed)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .extract import parsed


def accounting(files: DataFrame) -> DataFrame:
    """Files whose kept, rejected and unknown rows don't add up to all, or whose counters contradict each other."""
    wrong = (
        (F.col("kept_rows") + F.col("rejected_rows") + F.col("unknown_rows") != F.col("total_rows"))
        | (F.col("unknown_rows") != F.col("key_missing"))
        | (F.col("content_empty") > F.col("key_missing"))
        | (F.col("chunked_rows") + F.col("single_call_rows") + F.col("code_rows") + F.col("key_missing") + F.col("json_errors") != F.col("total_rows"))
    )
    return files.where(wrong).select("path", F.lit("rows do not add up").alias("finding"))


def line_counts(files: DataFrame, written: DataFrame) -> DataFrame:
    """Files whose outputs (basename, bucket, one row a line) have other line counts than the statistics."""
    counts = written.groupBy("basename").agg(*[F.count_if(F.col("bucket") == b).alias(f"lines_{b}") for b in ("en", "non_selected", "unknown")])
    joined = files.join(counts, "basename", "left").na.fill(0, ["lines_en", "lines_non_selected", "lines_unknown"])
    wrong = (F.col("lines_en") != F.col("kept_rows")) | (F.col("lines_non_selected") != F.col("rejected_rows")) | (F.col("lines_unknown") != F.col("unknown_rows"))
    return joined.where(wrong).select("path", F.lit("output lines differ from counted rows").alias("finding"))


def json_sample(lines: DataFrame, share: float = 0.001, seed: int = 17) -> DataFrame:
    """Sampled kept lines that don't parse."""
    sampled = lines if share >= 1 else lines.sample(share, seed)
    return parsed(sampled).where("json_error").select(*lines.columns, F.lit("not valid JSON").alias("finding"))


def by_block(lines: DataFrame) -> DataFrame:
    """path, start, length, size, lines, bytes: what was read of each block of a file; a line counts with its line feed."""
    return lines.groupBy("path", "start", "length", "size").agg(F.count("*").alias("lines"), F.sum("bytes").cast("long").alias("bytes"))


def coverage(blocks: DataFrame) -> DataFrame:
    """Files whose lines, over all blocks (by_block), don't have the file's bytes; the last line feed may be missing."""
    sums = blocks.groupBy("path").agg(F.sum("bytes").alias("read"), F.max("size").alias("size"))
    return sums.where("read <> size and read <> size + 1").select("path", F.lit("bytes read differ from file size").alias("finding"))


def boundaries(blocks: DataFrame) -> DataFrame:
    """Files with a block (by_block) whose first line doesn't start in it: lines were read twice or lost at its edge.

    A block has the lines that start after its first byte (the first block: at it) and up to the first byte of the next.
    """
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("first", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)))
    wrong = placed.where("start > 0 and (first <= start or first > start + length)")
    return wrong.select("path", F.lit("a block's first line starts outside of it").alias("finding")).distinct()


def keys_found(files: DataFrame, presence: DataFrame) -> DataFrame:
    """Files (path, key) whose key is in none of the objects that were sampled of them (jsonl.key_presence), and why."""
    joined = files.join(presence, "path", "left").where("coalesce(with_key, 0) = 0")
    why = F.when(F.coalesce("objects", F.lit(0)) == 0, F.lit("no valid JSON object in the sampled lines")).otherwise(
        F.concat(F.lit("key '"), "key", F.lit("' is in none of the sampled lines; keys there: "), F.array_join("keys", ", "))
    )
    return joined.select("path", why.alias("finding"))


def size_ratio(files: DataFrame, written: DataFrame, low: float = 0.90, high: float = 1.05) -> DataFrame:
    """Files whose outputs' bytes are out of proportion to the input's; files of blank lines alone have no outputs."""
    sums = written.groupBy("basename").agg(F.sum(F.octet_length("value") + 1).alias("out"))
    ratio = F.coalesce("out", F.lit(0)) / F.col("input_size_bytes")
    joined = files.where("input_size_bytes > 0 and kept_rows + rejected_rows + unknown_rows > 0").join(sums, "basename", "left")
    return joined.where((ratio < low) | (ratio > high)).select("path", F.lit("output size out of proportion").alias("finding"))


def duplicate_paths(files: DataFrame) -> DataFrame:
    return files.groupBy("path").agg(F.count("*").alias("times")).where("times > 1")


def basename_collisions(files: DataFrame) -> DataFrame:
    """Output names that several paths would share."""
    return files.select("path", "basename").distinct().groupBy("basename").agg(F.sort_array(F.collect_set("path")).alias("paths")).where(F.size("paths") > 1)


def disk_space(folder: str, input_bytes: int, factor: float = 1.1) -> bool:
    """Whether a local folder's disk has room for the outputs; folders that aren't local pass."""
    if "://" in folder:
        return True
    while folder and not os.path.isdir(folder):
        folder = os.path.dirname(folder)
    stat = os.statvfs(folder or "/")
    return stat.f_bavail * stat.f_frsize >= factor * input_bytes


def report(*findings: DataFrame, folder: str) -> tuple[list[tuple[str, str]], int]:
    """The first findings of checks by file, and the count of all; all are written to folder as JSON lines."""
    out = None
    for df in findings:
        part = df.select(F.col(df.columns[0]).cast("string").alias("subject"), "finding")
        out = part if out is None else out.unionByName(part)
    out.write.mode("errorifexists").json(folder)
    found = out.sparkSession.read.schema("subject string, finding string").json(folder)
    return [(r["subject"], r["finding"]) for r in found.limit(100).collect()], found.count()
