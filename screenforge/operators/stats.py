"""Statistics over row facts: counters, histograms, frequencies, rankings, manifest rows.

Facts are summed up once, by file, language and schema (`cube`); the sums, counts, least and greatest values of which
everything else is made merge from there (`by_file`, `total`, `pivoted`, ...), so that totals never come from rounded parts.
All functions take facts or a cube.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: What facts are grouped by in a cube.
KEYS = ["path", "lang", "schema"]


def _count(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


# Names of the counters.  Fixed values.
COUNTERS = [
    "total_rows", "kept_rows", "rejected_rows", "unknown_rows", "code_rows", "json_errors", "key_missing", "empty_lines",
    "content_empty", "mixed_lang_rows", "contaminated_rows", "kept_word_count", "rejected_word_count", "kept_est_tokens",
    "rejected_est_tokens", "chunked_rows", "single_call_rows",
]
# Names of the spreads, each with avg, min, max and sum.  Fixed values.
SPREADS = ["kept_row_size", "rejected_row_size", "conf_kept", "conf_rejected"]
#: Histograms: labels and sides.
HISTOGRAMS = {"size": (T.SIZE_BUCKETS, ["kept", "rejected"]), "conf": (T.CONF_BUCKETS, ["kept", "rejected"]), "en_ratio": (T.RATIO_BUCKETS, ["chunked"])}


def _counters() -> dict[str, Column]:
    """The additive counters of a group of facts."""
    row, kept, rejected = ~F.col("empty_line"), F.col("bucket") == "en", F.col("bucket") == "non_selected"
    sum_of = lambda c, where: F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0)).cast("long")
    values = [
        _count(row), _count(kept), _count(rejected), _count(F.col("bucket") == "unknown"), _count(F.col("code")), _count(F.col("json_error")),
        _count(F.col("key_missing")), _count(F.col("empty_line")), _count(F.col("content_empty")), _count(F.col("mixed")), _count(F.col("contaminated")),
        sum_of("words", kept), sum_of("words", rejected), sum_of("tokens", kept), sum_of("tokens", rejected), _count(F.col("chunked")), _count(F.col("single")),
    ]
    return dict(zip(COUNTERS, values, strict=True))


def _sides() -> dict[str, tuple[Column, Column]]:
    """The value of each spread and the rows that it is over; rows without text count with the kept sizes."""
    kept, rejected = F.col("bucket") == "en", F.col("bucket") == "non_selected"
    sides = (("bytes", kept | (F.col("bucket") == "unknown")), ("bytes", rejected), ("conf", kept), ("conf", rejected))
    return {name: (F.col(c), where) for name, (c, where) in zip(SPREADS, sides, strict=True)}


def _histogram_counts() -> dict[str, Column]:
    bucket = F.col("bucket")
    kept, rejected = bucket.isin("en", "unknown"), bucket == "non_selected"
    parts = {
        ("size", "kept"): (T.size_bucket(F.col("bytes")), kept), ("size", "rejected"): (T.size_bucket(F.col("bytes")), rejected),
        ("conf", "kept"): (F.when(F.col("conf").isNotNull(), T.conf_bucket(F.col("conf"))), bucket == "en"),
        ("conf", "rejected"): (F.when(F.col("conf").isNotNull(), T.conf_bucket(F.col("conf"))), rejected),
        ("en_ratio", "chunked"): (F.col("ratio_bucket"), F.col("chunked")),
    }
    return {f"{name}|{side}|{label}": _count((found == label) & where) for (name, side), (found, where) in parts.items() for label in HISTOGRAMS[name][0]}


def cube(facts: DataFrame) -> DataFrame:
    """What statistics are made of, by file, language and schema: one grouping, with map-side combine."""
    spreads = []
    for name, (value, where) in _sides().items():
        v = F.when(where, value)
        spreads += [F.sum(v).cast("double").alias(f"{name}+sum"), F.count(v).alias(f"{name}+n"), F.min(v).cast("double").alias(f"{name}+min"), F.max(v).cast("double").alias(f"{name}+max")]
    counts = [c.alias(k) for k, c in (_counters() | _histogram_counts()).items()]
    return facts.groupBy(*KEYS).agg(*counts, *spreads)


def _cube(df: DataFrame) -> DataFrame:
    return df if f"{SPREADS[0]}+n" in df.columns else cube(df)


def _sums(names) -> list[Column]:
    return [F.coalesce(F.sum(f"`{c}`"), F.lit(0)).cast("long").alias(c) for c in names]


def _merged() -> list[Column]:
    """Counters and spreads of a group of a cube's rows; 0 where a spread is over no rows."""
    out, zero = _sums(COUNTERS), F.lit(0.0)
    for name in SPREADS:
        total = F.sum(f"`{name}+sum`")
        out += [
            F.coalesce(F.round(total / F.sum(f"`{name}+n`"), 2), zero).alias(f"{name}_avg"),
            F.coalesce(F.min(f"`{name}+min`"), zero).alias(f"{name}_min"),
            F.coalesce(F.max(f"`{name}+max`"), zero).alias(f"{name}_max"),
            F.coalesce(F.round(total, 2), zero).alias(f"{name}_sum"),
        ]
    return out


def rates(df: DataFrame) -> DataFrame:
    """df with kept_pct and rejection_rate from its counters."""
    share = lambda c: F.col(c) / F.col("total_rows") * 100
    some = F.col("total_rows") > 0
    return df.withColumns(
        {
            "kept_pct": F.when(some, F.format_string("%.1f%%", share("kept_rows"))).otherwise("N/A"),
            "rejection_rate": F.when(some, F.round(share("rejected_rows"), 1)).otherwise(0.0),
        }
    )


def by_file(facts: DataFrame) -> DataFrame:
    """One row per file."""
    return rates(_cube(facts).groupBy("path").agg(*_merged()))


def total(facts: DataFrame) -> DataFrame:
    """One row over everything, with retention ratios."""
    return rates(_cube(facts).agg(F.countDistinct("path").alias("total_files"), *_merged())).withColumns(retention())


def retention() -> dict[str, Column]:
    """What is kept, in percent of all rows and of the words and tokens decided on."""

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.round(part / whole * 100, 1)).otherwise(0.0)

    out = {"retention_ratio_rows": ratio(F.col("kept_rows"), F.col("total_rows"))}
    for unit, name in (("word_count", "words"), ("est_tokens", "est_tokens")):
        out[f"retention_ratio_{name}"] = ratio(F.col(f"kept_{unit}"), F.col(f"kept_{unit}") + F.col(f"rejected_{unit}"))
    return out


def rollup(facts: DataFrame) -> DataFrame:
    """Counters by file and, with a null path and is_total, over all."""
    return _cube(facts).rollup("path").agg(F.grouping("path").cast("int").alias("is_total"), *_sums(COUNTERS))


def _rows(facts: DataFrame, *keys: str) -> DataFrame:
    """Rows, empty lines included, by some of a cube's keys."""
    return _cube(facts).groupBy(*keys).agg(F.sum(F.col("total_rows") + F.col("empty_lines")).alias("count"))


def frequencies(facts: DataFrame, column: str) -> DataFrame:
    """(path, value, count) of a label column."""
    return _rows(_cube(facts).where(F.col(column).isNotNull()), "path", column)


def histogram(facts: DataFrame, name: str) -> DataFrame:
    """(side, bucket, rows) with a row for every label of every side, empty or not."""
    labels, sides = HISTOGRAMS[name]
    wide = _cube(facts).agg(*_sums(f"{name}|{s}|{x}" for s in sides for x in labels))
    cells = [F.struct(F.lit(s).alias("side"), F.lit(x).alias("bucket"), F.col(f"`{name}|{s}|{x}`").alias("rows")) for s in sides for x in labels]
    return wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def size_histogram(facts: DataFrame) -> DataFrame:
    return histogram(facts, "size")


def conf_histogram(facts: DataFrame) -> DataFrame:
    return histogram(facts, "conf")


def ratio_histogram(facts: DataFrame) -> DataFrame:
    return histogram(facts, "en_ratio")


def pivoted(facts: DataFrame, column: str, labels: list[str] | None = None) -> DataFrame:
    """One column per label, by file; 0 where a label doesn't occur.  labels: those of the facts unless given."""
    facts = _cube(facts)
    labels = labels_of(facts, column) if labels is None else labels
    held = facts.where(F.col(column).isNotNull()).groupBy("path")
    counts = [F.coalesce(F.sum(F.when(F.col(column) == x, F.col("total_rows") + F.col("empty_lines"))), F.lit(0)).alias(f"{column}_{x}") for x in labels]
    return held.agg(F.count("*").alias("rows"), *counts).drop("rows")


def labels_of(facts: DataFrame, column: str) -> list[str]:
    """The labels of a column in order: a few names of languages or schemas."""
    return sorted(r[0] for r in facts.where(F.col(column).isNotNull()).select(column).distinct().collect())


def top_rejected(facts: DataFrame, allowed: tuple[str, ...] = ("en",), limit: int | None = None) -> DataFrame:
    """Languages that aren't allowed, the most frequent first; uncertain is one."""
    out = _rows(_cube(facts).where(F.col("lang").isNotNull() & ~F.col("lang").isin(*allowed, "unknown", "no_text", "code")), "lang")
    out = out.orderBy(F.desc("count"), "lang")
    return out.limit(limit) if limit else out


def ranking(files: DataFrame, path: str = "path") -> DataFrame:
    """Files by rejection rate, the worst first."""
    return files.orderBy(F.desc("rejection_rate"), path)
