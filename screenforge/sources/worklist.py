"""Worklists: which files to read, and under which key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, key string"


def hadoop_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time in ms) of a file, or of the .jsonl files of a folder, sorted; empty if there is none."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    status = fs.getFileStatus(place)
    plain = (lambda s: s.getPath().toUri().getPath()) if "://" not in path and not path.startswith("file:") else (lambda s: s.getPath().toString())
    if not status.isDirectory():
        return [(plain(status), status.getLen(), status.getModificationTime())]
    found = [s for s in fs.listStatus(place) if s.isFile() and s.getPath().getName().endswith(".jsonl")]
    return sorted((plain(s), s.getLen(), s.getModificationTime()) for s in found)


def ends_of_file(spark: SparkSession, path: str, lines: int = 10, tail_bytes: int = 1 << 20) -> list[str]:
    """The first lines of a file, and the last ones that aren't blank; of either end at most tail_bytes are read."""
    jvm, place = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getFileStatus(place).getLen()
    stream = fs.open(place)
    try:
        count = int(min(size, tail_bytes))
        head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, count)) if count else b""
        stream.seek(size - count)
        tail = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, count)) if count else b""
    finally:
        stream.close()
    first = head.split(b"\n")[:lines]
    last = [x for x in tail.split(b"\n") if x.strip()][-lines:]
    return [x.decode(errors="replace") for x in first + last]


def sampled(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """path, key, value: lines from either end of each file (path, key), read by the driver, a few files at a time."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda f: ends_of_file(spark, f[0]), files))
    rows = [(path, key, line) for (path, key), lines in zip(files, found, strict=True) for line in lines]
    return spark.createDataFrame(rows, f"{SCHEMA}, value string")


def read_worklist(spark: SparkSession, csv_path: str, default_key: str | None = None) -> list[tuple[str, str]]:
    """(path, key) of a CSV worklist.

    Header names are trimmed and lower-cased; the paths are in the column `path`, or else in the first one.  Rows
    with a blank path are skipped.  A row without a key takes the default; without a default, that is an error.
    """
    rows = spark.read.csv(csv_path, header=True, inferSchema=False)
    names = [c.strip().lower() for c in rows.columns]
    rows = rows.toDF(*[f"c{k}" for k in range(len(names))])
    at = names.index("path") if "path" in names else 0
    key = F.col(f"c{names.index('key')}") if "key" in names else F.lit(None).cast("string")
    rows = rows.select(F.trim(f"c{at}").alias("path"), F.coalesce(F.nullif(F.trim(key), F.lit("")), F.lit(default_key)).alias("key"))
    out = [(r["path"], r["key"]) for r in rows.where("path is not null and path <> ''").collect()]
    missing = [p for p, k in out if k is None]
    if missing:
        raise ValueError(f"no key for {missing[0]} and no default key")
    return out


def expanded(spark: SparkSession, entries: list[tuple[str, str]]) -> tuple[DataFrame, list[str]]:
    """(files with path, key, size, mtime; paths without any file)."""
    rows, missing = [], []
    for path, key in entries:
        found = hadoop_files(spark, path)
        rows += [(p, key, size, mtime) for p, size, mtime in found]
        if not found:
            missing.append(path)
    return spark.createDataFrame(rows, f"{SCHEMA}, size long, mtime long"), missing


def plan(files: DataFrame, split_mb: int, workers: int) -> DataFrame:
    """What a run would do: files, bytes, work units, estimated rows and seconds."""
    units = F.sum(F.greatest(F.lit(1), F.ceil(F.col("size") / (split_mb << 20))))
    rows = (F.sum("size") / 73000).cast("long")
    return files.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), units.cast("long").alias("units"), rows.alias("rows"), (rows / max(45 * workers, 1)).alias("seconds"))
