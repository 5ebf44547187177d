"""Document fingerprints by Order MinHash, in SQL functions only.

A text becomes tokens: words of up to 24 code points; single characters of longer runs, of scripts that don't separate
words, and of texts of up to SHORT code points, so that an insertion shifts nothing.
Its k-mers are the runs of K tokens; equal ones are told apart by occurrence number.  The hash of a numbered k-mer
names one of BUCKETS buckets (one-permutation hashing, so that each is hashed once).  In every bucket the PER_BUCKET
smallest are selected and, in their text order, hashed to one tuple.  Moving, inserting or replacing text changes
k-mers or their order, so the share of equal tuples falls with edit distance, not just with the sets' overlap.

Everything happens within a row, in time n log n of its tokens.  The only shuffle is by blocks of doc_id ranges, to
bring neighbours together; a block also gets the document before it.

Defined results: null text counts as empty; a text without tokens has an empty fingerprint, like 1 to another empty
one and 0 to others; a text shorter than K tokens has one k-mer; rows with equal doc_id follow each other by content
hash; null doc_ids come last in descending order; with a single row, the next document is the row itself; repeated rows
have a row each; an empty table gives no rows; other columns are ignored, whatever their names; very long texts are taken
whole (of more than 2**26 tokens, the order within each 2**26 counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import input_bytes

K = 3
BUCKETS = 64
PER_BUCKET = 2
_POSITION_BITS = 26
_HASH_BITS = 37
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
#: The first alternative is the third one for words of the lower code points, where no script is unspaced: it is faster.
_TOKEN = (
    r"[\x21-\u0DFF\x00-\x08\x0E-\x1F]{1,24}+(?=[\x20\x09-\x0D]|\z)"
    rf"|[{_UNSPACED}]|[^\x20\x09-\x0D{_UNSPACED}]{{1,24}}+(?=[\x20\x09-\x0D{_UNSPACED}]|\z)|[^\x20\x09-\x0D{_UNSPACED}]"
)
_CHARACTER = r"[^\x20\x09-\x0D]"
SHORT = 64
_LONGS = "array<bigint>"


def _let(name: str, value: str, body: str) -> str:
    """body with name bound to value, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _packed(value: str, position: str) -> str:
    """The upper bits of a hash, then a position: numbers that sort by hash."""
    return f"(shiftleft(shiftrightunsigned({value}, {64 - _HASH_BITS}), {_POSITION_BITS}) | {position})"


def _new(array: str, shift: int) -> str:
    """Whether array's element i differs from the one before it in the bits from shift on."""
    return f"(i = 0 or shiftright(get({array}, i), {shift}) <> shiftright(get({array}, i - 1), {shift}))"


def fingerprint_sql(text: str) -> str:
    """SQL for the fingerprint of a text: one number per bucket in use, the bucket above 32 bits of the tuple's hash."""
    last = (1 << _POSITION_BITS) - 1
    tokens = f"if(length({text}) <= {SHORT}, regexp_extract_all({text}, r'{_CHARACTER}', 0), regexp_extract_all({text}, r'{_TOKEN}', 0))"
    hashes = f"transform({tokens}, w -> xxhash64(w))"
    run = ", ".join(f"get(h, i + {k})" for k in range(K))
    kmers = _let(
        "h",
        hashes,
        f"if(size(h) = 0, cast(array() as {_LONGS}), transform(sequence(0, greatest(size(h) - {K}, 0)), i -> {_packed(f'xxhash64({run})', f'cast(i as bigint) & {last}')}))",
    )
    again = _packed(f"xxhash64(shiftright(get(s, i), {_POSITION_BITS}), i - b)", f"(get(s, i) & {last})")
    repeats = _let(
        "f",
        f"filter(sequence(0, size(s) - 1), i -> {_new('s', _POSITION_BITS)})",
        f"""if(size(f) = size(s), s, concat(transform(f, i -> get(s, i)), flatten(transform(f, (b, j) ->
            if(coalesce(get(f, j + 1), size(s)) - b = 1, cast(array() as {_LONGS}), transform(sequence(b + 1, coalesce(get(f, j + 1), size(s)) - 1), i -> {again}))))))""",
    )
    numbered = _let("s", f"sort_array({kmers})", f"if(size(s) = 0, s, {repeats})")
    bits = BUCKETS.bit_length() - 1
    top = _POSITION_BITS + _HASH_BITS - bits
    chosen = f"filter(slice(t, b + 1, {PER_BUCKET}), x -> shiftright(x, {top}) = shiftright(get(t, b), {top}))"
    in_order = f"sort_array(transform({chosen}, x -> shiftleft(x & {last}, {_HASH_BITS}) | shiftright(x, {_POSITION_BITS})))"
    tuple_hash = f"xxhash64(transform({in_order}, x -> x & {(1 << _HASH_BITS) - 1}))"
    tuples = f"transform(filter(sequence(0, size(t) - 1), i -> {_new('t', top)}), b -> shiftleft(shiftright(get(t, b), {top}), 32) | ({tuple_hash} & 4294967295))"
    return _let("t", f"sort_array({numbered})", f"if(size(t) = 0, t, {tuples})")


def written_sql(fingerprint: str) -> str:
    """A fingerprint as text: ten hexadecimal digits a bucket."""
    return f"array_join(transform({fingerprint}, x -> lpad(lower(hex(x)), 10, '0')), '')"


def likeness_sql(a: str, b: str) -> str:
    """Share of the buckets in use by either in which both have the same tuple."""
    used = f"size(array_union(transform({a}, x -> shiftright(x, 32)), transform({b}, x -> shiftright(x, 32))))"
    return f"if({used} = 0, 1D, size(array_intersect({a}, {b})) / cast({used} as double))"


def with_next(docs: DataFrame, columns: list[str], block_bytes: int = 4 << 20, most_blocks: int = 40_000) -> DataFrame:
    """docs with a column `next`: those columns of the next document, by descending doc_id; after the last, of the first.

    Blocks are ranges of doc_id with about equal counts.  Their bounds and largest ids, at most most_blocks numbers,
    are all that leaves the executors.
    """
    blocks = max(1, min(most_blocks, input_bytes(docs) // block_bytes))
    bounds: list[int] = []
    if blocks > 1:
        shares = [k / blocks for k in range(1, blocks)]
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * blocks))).first()[0] or []))
    step = max(1, int(len(bounds) ** 0.5))
    # The block of an id is the number of bounds up to it, counted in two steps.
    fine = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    coarse = "array(" + ", ".join(f"{part[0]}L" for part in fine) + ")"
    parts = "array(" + ", ".join("array(" + ", ".join(f"{b}L" for b in part) + ")" for part in fine) + ")"
    count = _let("c", f"size(filter({coarse}, b -> b <= doc_id))", f"if(c = 0, 0, (c - 1) * {step} + size(filter(element_at({parts}, c), b -> b <= doc_id)))")
    block = f"coalesce({count}, 0)" if bounds else "0"
    tops = sorted(
        (r["block"], r["top"])
        for r in docs.select("doc_id", F.expr(block).alias("block")).groupBy("block").agg(F.max("doc_id").alias("top")).collect()
        if r["top"] is not None
    )
    spark = docs.sparkSession
    guests = spark.createDataFrame([(tops[k - 1][1], b) for k, (b, _) in enumerate(tops)], "__top long, __guest int")
    placed = docs.join(F.broadcast(guests), F.col("doc_id") == F.col("__top"), "left").withColumn(
        "__at", F.explode(F.expr(f"filter(array(struct({block} as block, true as own), struct(__guest as block, false as own)), p -> p.block is not null)"))
    )
    order = Window.partitionBy("__at.block").orderBy("__at.own", F.col("doc_id").asc_nulls_first(), "__tie")
    placed = placed.withColumn("__tie", F.xxhash64(*columns))
    ahead = F.struct(*columns)
    return (
        placed.withColumn("next", F.coalesce(F.lag(ahead).over(order), ahead))
        .where("__at.own")
        .drop("__top", "__guest", "__at", "__tie")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row per document."""
    texts = docs.select("doc_id", F.coalesce(F.make_valid_utf8("text"), F.lit("")).alias("text"))
    marked = texts.withColumn("marks", F.expr(fingerprint_sql("text")))
    edited = with_next(marked, ["text", "marks"]).select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.expr("concat(substring(text, 1, length(text) - length(text) div 2), substring(next.text, 1, cast(length(text) div 2 as int)))").alias("edited"),
        "marks",
        F.expr("next.marks").alias("next_marks"),
    )
    both = edited.withColumn("edited_marks", F.expr(fingerprint_sql("edited")))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(written_sql("marks")).alias("fingerprint"),
        F.expr(written_sql("edited_marks")).alias("edited_fingerprint"),
        F.expr(likeness_sql("marks", "edited_marks")).alias("near_edited"),
        F.expr(likeness_sql("marks", "next_marks")).alias("near_next"),
    )
