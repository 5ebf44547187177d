"""Outputs: routed lines and manifests."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = ("en", "non_selected", "unknown")


def write_routed(facts: DataFrame, folder: str) -> None:
    """The raw line of every row (value, basename, bucket, start, place), under basename=.../bucket=.../.

    The parts of an output, one after the other by name, hold its lines in the order of the input file; outputs are dealt
    by ranges of a file, so that none is written by one task for its size.  An existing folder is an error.
    """
    rows = facts.where("bucket is not null").select("value", "basename", "bucket", "start", "place")
    dealt = rows.repartitionByRange("basename", "bucket", "start", "place").sortWithinPartitions("basename", "bucket", "start", "place")
    dealt.drop("start", "place").write.mode("errorifexists").option("lineSep", "\n").partitionBy("basename", "bucket").text(folder)


def read_routed(spark: SparkSession, folder: str) -> DataFrame:
    """value, basename, bucket of what write_routed wrote; no rows if there is nothing."""
    schema = "value string, basename string, bucket string"
    if not any(s.isDirectory() for s in _listed(spark, folder)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("lineSep", "\n").text(folder)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    place, fs = _place(spark, folder)
    return fs.exists(place)


def delete(spark: SparkSession, folder: str) -> None:
    place, fs = _place(spark, folder)
    fs.delete(place, True)


def _listed(spark: SparkSession, folder: str) -> list:
    place, fs = _place(spark, folder)
    return list(fs.listStatus(place)) if fs.exists(place) else []


def carry(spark: SparkSession, source: str, target: str, names: list[str]) -> None:
    """Copies the outputs of the named files from an earlier run's folder, as they are, to another's."""
    conf, util = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.FileUtil
    place, fs = _place(spark, target)
    fs.mkdirs(place)
    wanted = {f"basename={name}" for name in names}
    for status in _listed(spark, source):
        if spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(status.getPath().getName()) in wanted:
            util.copy(fs, status.getPath(), fs, place, False, False, conf)


def merge(spark: SparkSession, lines: str, folder: str, names: list[str]) -> list[str]:
    """For each name the files <name>_<bucket>.jsonl in folder: its parts one after the other, empty where there are none.

    The bytes pass through the driver; for very large outputs use the parts as they are.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    parts: dict[tuple[str, str], list] = {}
    for of_file in _listed(spark, lines):
        for of_bucket in _listed(spark, of_file.getPath().toString()) if of_file.isDirectory() else ():
            key = tuple(unescape(s.getPath().getName()).partition("=")[2] for s in (of_file, of_bucket))
            parts[key] = sorted((s.getPath().getName(), s.getPath()) for s in _listed(spark, of_bucket.getPath().toString()) if s.getPath().getName().startswith("part-"))
    out = []
    for name in names:
        for bucket in BUCKETS:
            place, fs = _place(spark, f"{folder}/{name}_{bucket}.jsonl")
            stream = fs.create(place, False)
            try:
                for _, part in parts.get((name, bucket), ()):
                    source = fs.open(part)
                    try:
                        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, conf, False)
                    finally:
                        source.close()
            finally:
                stream.close()
            out.append(place.toString())
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, on any file system that Spark reaches."""
    place, fs = _place(spark, path)
    stream = fs.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


# Names and order of the manifest's columns.  Fixed values.
MANIFEST_COLUMNS = [
    "filename", "input_size_mb", "total_parts", "key",
    "total_rows", "kept_rows", "rejected_rows", "kept_pct", "rejection_rate",
    "unknown_rows", "code_rows", "mixed_lang_rows", "contaminated_rows",
    "json_errors", "key_missing", "content_empty", "empty_lines",
    "kept_word_count", "rejected_word_count", "kept_est_tokens", "rejected_est_tokens",
    "kept_row_size_avg", "kept_row_size_min", "kept_row_size_max",
    "rejected_row_size_avg", "rejected_row_size_min", "rejected_row_size_max",
    "conf_kept_avg", "conf_kept_min", "conf_kept_max", "conf_rejected_avg",
    "processing_time_sec", "rows_per_sec", "mb_per_sec",
]
TOTAL_NAME = "=== TOTAL ==="


def manifest_csv(files: list[dict], total: dict, langs: list[str], schemas: list[str]) -> str:
    """One row per input file, worst rejection rate first, and the total."""
    names = MANIFEST_COLUMNS + [f"schema_{s}" for s in schemas] + [f"lang_{x}" for x in langs]
    out = io.StringIO()
    writer = csv.DictWriter(out, names, restval="", extrasaction="ignore", lineterminator="\n")
    writer.writeheader()
    for row in files:
        writer.writerow(row)
    writer.writerow({**total, "filename": TOTAL_NAME, "key": "", "total_parts": "", "rejection_rate": "", "rows_per_sec": "", "mb_per_sec": ""})
    return out.getvalue()


def provenance(files: list[dict], merged: bool) -> dict[str, dict]:
    """Where each output comes from, and where it is in the run's folder: ordered parts, and one file if they are merged."""
    return {
        f["basename"]: {"input_file": f["path"], "input_size_bytes": f["input_size_bytes"], "input_mtime_iso": f["input_mtime_iso"], "key": f["key"]}
        | {f"parts_{b}": f"lines/basename={f['basename']}/bucket={b}" for b in BUCKETS}
        | ({f"output_{b}": f"{f['basename']}_{b}.jsonl" for b in BUCKETS} if merged else {})
        for f in files
    }


def manifest_json(run: dict, total: dict, files: list[dict], merged: bool = False) -> str:
    return json.dumps({"run_info": run, "global_summary": total, "per_file": files, "provenance": provenance(files, merged)}, indent=2, ensure_ascii=False, default=str)


def basenames(files: DataFrame) -> DataFrame:
    from ..functions.text import output_basename

    return files.withColumn("basename", output_basename(F.col("path")))
