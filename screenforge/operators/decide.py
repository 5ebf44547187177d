"""From detections to decisions: single calls, chunk votes, and the bucket of every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ScreenConfig
from ..functions import text as T
from . import chunking

RESULT_SQL = "struct<lang:string,conf:double,keep:boolean,mixed:boolean,chunked:boolean,en:int,total:int>"


def single_sql(found: str, config: ScreenConfig) -> str:
    """Decision on a text detected in one call."""
    allowed = ", ".join(f"'{x}'" for x in config.allowed)
    keep = f"coalesce({found}.lang in ({allowed}) and {found}.conf >= {config.confidence}D, false)"
    return f"named_struct('lang', {found}.lang, 'conf', {found}.conf, 'keep', {keep}, 'mixed', false, 'chunked', false, 'en', cast(null as int), 'total', cast(null as int))"


def vote_sql(found: str, config: ScreenConfig) -> str:
    """Decision on an array of chunk detections.

    Chunks below the confidence are uncertain.  The most frequent label dominates, the first seen among ties.
    """
    labels = f"transform({found}, c -> if(c.conf < {config.confidence}D, 'uncertain', c.lang))"
    dominant = "array_max(transform(array_distinct(l), x -> named_struct('n', size(filter(l, y -> y = x)), 'at', -array_position(l, x), 'lang', x))).lang"
    real = "size(filter(array_distinct(l), x -> x not in ('unknown', 'uncertain')))"
    mean = f"aggregate(zip_with(l, {found}, (x, c) -> if(x = d, c.conf, 0D)), 0D, (a, x) -> a + x) / size(filter(l, x -> x = d))"
    en = "size(filter(l, x -> x = 'en'))"
    base = f"'mixed', {real} > 1, 'chunked', true, 'en', {en}, 'total', size(l))"
    none = f"named_struct('lang', 'unknown', 'conf', 0D, 'keep', false, {base}"
    kept = f"named_struct('lang', 'en', 'conf', {mean}, 'keep', true, {base}"
    rejected = f"named_struct('lang', d, 'conf', {mean}, 'keep', false, {base}"
    body = f"case when {real} = 0 then {none} when {en} / cast(size(l) as double) >= {config.min_en_ratio}D then {kept} else {rejected} end"
    return T.let("l", labels, T.let("d", dominant, body))


def detected(df: DataFrame, config: ScreenConfig, detector, text: str = "text") -> DataFrame:
    """df with `found`: the decision on its text.  Only texts that need a way of detection take it."""
    long_text = F.length(text) > config.short_limit
    df = df.withColumns({"__short": F.when(~long_text, F.col(text)), "__chunks": F.when(long_text, chunking.chunks(text, config))})
    df = df.withColumns({"__one": detector.one("__short"), "__many": detector.many("__chunks")})
    found = F.when(F.col("__chunks").isNotNull(), F.expr(vote_sql("__many", config))).otherwise(F.expr(single_sql("__one", config)))
    # Exploding one element keeps the optimizer from working the decision out anew wherever one of its fields is used.
    return df.select("*", F.explode(F.array(F.when(F.col(text).isNotNull(), found))).alias("found")).drop("__short", "__chunks", "__one", "__many")


def outcomes(rows: DataFrame, config: ScreenConfig, detector) -> DataFrame:
    """Facts of every line, from parsed rows with schema, has_key and text.

    First match wins: empty line (no bucket), JSON error (non_selected), no text (unknown), code (en), kept (en),
    rejected (non_selected).
    """
    no_text = ~F.col("empty_line") & ~F.col("json_error") & (F.col("text") == "")
    code = T.is_code(F.col("text")) if config.code_detection else F.lit(False)
    rows = rows.withColumns({"no_text": no_text, "has_text": ~F.col("empty_line") & ~F.col("json_error") & (F.col("text") != "")})
    rows = rows.withColumn("code", F.col("has_text") & code)
    rows = rows.withColumn("__scored", F.when(F.col("has_text") & ~F.col("code"), F.col("text")))
    rows = detected(rows, config, detector, "__scored").drop("__scored")
    words = F.when(F.col("has_text"), T.word_count(F.col("text")))
    size = T.raw_bytes(F.col("value"))
    kept = F.col("code") | F.coalesce(F.col("found.keep"), F.lit(False))
    bucket = F.when(F.col("empty_line"), None).when(F.col("json_error"), "non_selected").when(F.col("no_text"), "unknown").when(kept, "en").otherwise("non_selected")
    lang = F.when(F.col("empty_line") | F.col("json_error"), None).when(F.col("no_text"), "no_text").when(F.col("code"), "code").otherwise(F.col("found.lang"))
    rows = rows.withColumns({"bucket": bucket, "lang": lang, "words": words, "bytes": size})
    found = F.col("found")
    return rows.withColumns(
        {
            "tokens": T.token_estimate(F.col("words")),
            "conf": F.when(found["conf"] > 0, found["conf"]),
            "chunked": F.coalesce(found["chunked"], F.lit(False)),
            "single": F.coalesce(~found["chunked"], F.lit(False)),
            "mixed": F.coalesce(found["mixed"], F.lit(False)),
            "contaminated": F.coalesce(found["chunked"] & (F.col("bucket") == "non_selected") & (found["lang"] == "en"), F.lit(False)),
            "key_missing": F.col("no_text"),
            "content_empty": F.col("no_text") & F.col("has_key"),
            "schema": F.when(F.col("empty_line") | F.col("json_error"), None).otherwise(F.col("schema")),
            "ratio_bucket": F.when(found["chunked"], T.ratio_bucket(found["en"], found["total"])),
        }
    )
