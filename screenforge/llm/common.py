"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .textscan import slices

_LIBC = ctypes.CDLL("libc.so.6") if sys.platform == "linux" and ctypes.util.find_library("c") else None


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def durable(df: DataFrame) -> DataFrame:
    """df, written as a table to the shared folder and read from there: its lineage is cut, and lost executors lose nothing.

    What isn't discarded before goes when the driver ends.
    """
    spark = df.sparkSession
    name = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "none").parquet(name)  # codecs hold native memory beside the heap
    out = spark.read.schema(df.schema).parquet(name)
    out._durable_at = name
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes durable tables that nothing will read any more."""
    for df in tables:
        path, fs = _path(df.sparkSession, df._durable_at)
        fs.delete(path, True)


def small(table: DataFrame, row_bytes: int, most: int = 8 << 20) -> DataFrame:
    """A durable table, to be broadcast if its rows, of at most so many bytes each when hashed, are few enough; joined by a
    shuffle otherwise."""
    return F.broadcast(table) if table.count() * row_bytes <= most else table


def input_bytes(df: DataFrame, text: str = "text") -> int:
    """Catalyst's size estimate of df, which is the size of its files for a scan; where it has none, half its text's bytes."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 60:
        return known
    return int(df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]) // 2


def bucket_bits(df: DataFrame, bytes_each: int, least: int = 3, most: int = 24) -> int:
    """Number of hash bits so that a share of df of about bytes_each falls to each bucket."""
    want = max(1, input_bytes(df) // bytes_each)
    return int(min(max(least, int(want).bit_length()), most))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like the given one that df doesn't have."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def whole_text(df: DataFrame, column: str = "text") -> DataFrame:
    """df with its text made valid UTF-8 and never null."""
    return df.withColumn(column, F.coalesce(F.make_valid_utf8(F.col(column)), F.lit("")))


def tidy() -> None:
    """Hands memory that a Python worker no longer uses back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def batches(function: Callable[[pa.RecordBatch], dict], schema: pa.Schema, text: int, most_bytes: int = 4 << 20):
    """A mapInArrow function from one that turns rows into columns; it gets so many bytes of the text column at a time."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for a, b in slices(batch.column(text), most_bytes):
                yield record(function(batch.slice(a, b - a)), schema)
                tidy()

    return run


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, schema.field(k).type) for k, x in ((f.name, columns[f.name]) for f in schema)],
        schema=schema,
    )


def bloom(keys: DataFrame, column: str, most_keys: int = 20_000_000) -> np.ndarray | None:
    """A filter of at most 32 MB over a long column, or None when there are more keys than it could tell apart.

    It only spares rows from a shuffle whose join decides exactly; None means that nothing is spared.
    """
    count = keys.count()
    if count > most_keys:
        return None
    bits = max(16, int(count * 12).bit_length())
    cut = 1 << max(0, bits - 3 - 20)

    def partial(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros((1 << bits) // 8, np.uint8)
        for batch in stream:
            for at in _bloom_places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                np.bitwise_or.at(field, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        for k, part in enumerate(np.split(field, cut)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["part", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        out = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in table.column("bits")])
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([out.tobytes()], pa.binary())})

    parts = keys.select(column).where(F.col(column).isNotNull()).mapInArrow(partial, "part int, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts.groupBy("part").applyInArrow(merge, "part int, bits binary").collect():
        size = out.size // cut
        out[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def _bloom_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return [(x >> np.uint64(64 - bits)).astype(np.int64), ((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - bits)).astype(np.int64)]


def bloom_has(field: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = int(field.size * 8).bit_length() - 1
    out = np.ones(len(keys), bool)
    for at in _bloom_places(keys, bits):
        out &= (field[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out


def fits(table: DataFrame, most: int = 4 << 20) -> bool:
    """Whether a durable table's files are small enough to broadcast it; they aren't compressed."""
    return input_bytes(table) <= most


def only_keys(df: DataFrame, column: str, field: np.ndarray | None) -> DataFrame:
    """Rows of df that the filter may hold; the caller's join settles which."""
    return df if field is None else _filtered(df, column, field, True)


def split_by_keys(df: DataFrame, column: str, field: np.ndarray | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of df that the filter may hold, rows that it surely doesn't hold: None if there is no filter)."""
    return (df, None) if field is None else (_filtered(df, column, field, True), _filtered(df, column, field, False))


def _filtered(df: DataFrame, column: str, field: np.ndarray, wanted: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(field)
    return df.mapInArrow(lambda stream: held_rows(stream, column, shared.value, wanted), df.schema)


def held_rows(stream: Iterator[pa.RecordBatch], column: str, field: np.ndarray, wanted: bool) -> Iterator[pa.RecordBatch]:
    """The rows whose key the filter may hold, or those whose key it surely doesn't hold; null keys count as held."""
    for batch in stream:
        ids = batch.column(batch.schema.get_field_index(column))
        mask = bloom_has(field, ids.fill_null(0).to_numpy(zero_copy_only=False))
        if ids.null_count:
            mask |= ids.is_null().to_numpy(zero_copy_only=False)
        mask = mask == wanted
        if mask.any():
            yield batch.filter(pa.array(mask))
        tidy()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges; a durable table.

    Alternates large-star and small-star rounds, so that paths shrink fast and no group is held in one place;
    each round is written to the shared folder.
    """
    now = durable(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = lambda x: x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        step = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        last, now = now, durable(step)
        discard(last)
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    out = durable(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct())
    discard(now)
    return out
