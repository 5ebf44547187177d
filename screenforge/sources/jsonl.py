"""JSON lines, read as raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import parsed


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, value, start, length, size, place: every line, unchanged, with the block of its file that it was read in and its
    place among the lines of that block.

    Lines end at line feeds only; a carriage return stays in the value.  Files are split as the session says.
    """
    rows = spark.read.option("lineSep", "\n").text(paths)
    meta = F.col("_metadata")
    plain = not any("://" in p for p in paths)
    path = F.regexp_replace(meta["file_path"], "^file:(//)?", "") if plain else meta["file_path"]
    return rows.select(
        F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))).alias("path"),
        "value",
        meta["file_block_start"].alias("start"),
        meta["file_block_length"].alias("length"),
        meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("place"),
    )


def key_presence(lines: DataFrame, key: str = "key") -> DataFrame:
    """path, objects, with_key, keys: of sampled lines (path, value, and in a column the key that is looked for)."""
    some = parsed(lines.where("value <> ''")).where("v is not null")
    names = some.withColumn("__names", F.expr("map_keys(cast(v as map<string, variant>))"))
    return names.groupBy("path").agg(
        F.count("*").alias("objects"),
        F.count_if(F.array_contains("__names", F.col(key))).alias("with_key"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("__names")))).alias("keys"),
    )


def from_texts(df: DataFrame, path: str, text: str = "text", key: str = "text") -> DataFrame:
    """Rows of a table as JSON lines: path, value."""
    return df.select(F.col(path).alias("path"), F.to_json(F.struct(F.col(text).alias(key)), {"ignoreNullFields": "false"}).alias("value"))
