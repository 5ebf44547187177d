"""Chunk votes and geometry."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from screenforge.config import ScreenConfig
from screenforge.functions import text as T
from screenforge.operators import chunking, decide

U = ("en", 0.3)
EN, ZH = ("en", 0.9), ("zh", 0.95)
VOTES = [
    ([EN] * 4, ("en", True, False)),
    ([EN, EN, EN, ZH], ("en", False, True)),
    ([EN, ZH, EN, ZH], ("en", False, True)),
    ([ZH, EN, ZH, EN], ("zh", False, True)),
    ([U] * 4, ("unknown", False, False)),
    ([U, U, U, EN], ("uncertain", False, False)),
    ([EN, EN, EN, U], ("en", False, False)),
    ([EN] * 18 + [ZH] * 2, ("en", True, True)),
    ([EN] * 17 + [ZH] * 3, ("en", False, True)),
]


@pytest.mark.parametrize("chunks,expected", VOTES, ids=range(len(VOTES)))
def test_vote(chunks, expected, spark):
    df = spark.createDataFrame([([{"lang": a, "conf": b} for a, b in chunks],)], "c array<struct<lang:string,conf:double>>")
    r = df.select(F.expr(decide.vote_sql("c", ScreenConfig())).alias("r")).first().r
    assert (r.lang, r.keep, r.mixed) == expected


GEOMETRY = [(10_001, 2_500, 4, 2_500), (20_000, 5_000, 4, 5_000), (399_999, 99_999, 4, 99_999), (450_000, 100_000, 4, 112_500), (600_000, 100_000, 6, 100_000), (2_500_000, 100_000, 20, 125_000), (10_000_000, 100_000, 20, 500_000)]


def test_geometry(spark):
    df = chunking.geometry(spark.createDataFrame([(g[0],) for g in GEOMETRY], "len long"), ScreenConfig())
    assert [tuple(r) for r in df.orderBy("len").collect()] == GEOMETRY


def test_chunks_cover_in_order(spark):
    text = "".join(chr(97 + k % 26) for k in range(12_345))
    got = spark.createDataFrame([(text,)], "t string").select(chunking.chunks("t", ScreenConfig()).alias("c")).first().c
    assert got == [text[k * 3086 : k * 3086 + 3086] for k in range(4)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 20_000_000), min_size=1, max_size=20))
def test_size_buckets_are_ordered(spark, sizes):
    rows = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", T.size_bucket(F.col("s")).alias("b")).collect()
    for r in rows:
        assert T.SIZE_BUCKETS.index(r.b) == sum(r.s >= b for b in T.SIZE_BOUNDS)


def test_basenames(spark):
    paths = ["/data/folder1/sub/train.jsonl", "/data/folder1/train.jsonl", "/folder1/train.jsonl", "/train.jsonl", "/a/b/.hidden", "/a/b/x.tar.gz"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(T.output_basename(F.col("p"))).collect()
    assert [r[0] for r in got] == ["folder1_sub_train", "data_folder1_train", "folder1_train", "train", "a_b_.hidden", "a_b_x.tar"]


@pytest.mark.parametrize("bad", [{"confidence": 1.5}, {"chunk_size": 0}, {"max_chunks": 0}, {"allowed": ()}, {"min_en_ratio": -1}])
def test_config_is_checked(bad):
    with pytest.raises(ValueError):
        ScreenConfig(**bad)


def test_model_detector_batches(spark):
    from screenforge.functions.detect import ModelDetector

    detector = ModelDetector(lambda: lambda texts: [("zh" if "xx" in t else "en", 0.9) for t in texts])
    df = spark.createDataFrame([("some text\nwith a line",), ("xx and more text",), ("short",), (None,)], "text string")
    got = df.select(detector.one("text").alias("r")).collect()
    assert [r.r.lang for r in got] == ["en", "zh", "unknown", "unknown"]
    long = spark.createDataFrame([("abc def ghi " * 1000,)], "text string")
    r = decide.detected(long, ScreenConfig(), detector).first().found
    assert (r.lang, r.keep, r.total) == ("en", True, 4)
