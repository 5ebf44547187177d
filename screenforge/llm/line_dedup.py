"""Line dedup by a segment-partition edit join, in SQL functions only.

Two lines are alike if their edit distance is at most `edits` and both have at least `least` code points; shorter
lines are alike only if equal.  Of each class (lines connected by likeness) the first occurrence, by doc_id and line
number, stays; blank lines always stay.

A line within `edits` of another keeps at least one of the other's edits + 1 segments intact, shifted by no more than the
edits before it allow.  Every line sends the hashes of its substrings that could be a segment of a line no longer; its own
segments are among them and make up the index.  Lines that meet at a key are told apart by length and letter counts, and
verified by a banded bit-parallel edit distance.  Of a line with more than FREQUENT copies only one document's sends keys.

In the first rounds the lines of a key are compared with a few of them only: the most frequent one and those of best
priority, where a line's priority is the same at all keys.  What is alike is contracted.  The last round compares what is
still in different components, leaving out pairs within the largest one of a key: a large group of lines that are alike
never becomes all its pairs, and none that may be alike are skipped.

Defined results: null text counts as empty and has no lines; rows with a null doc_id are neither changed nor compared;
rows with equal doc_id and text are one document, rows with equal doc_id and other texts are documents of their own, in
order of their texts' hashes; an empty table gives no rows; lines of any length and documents of any number of lines take
part whole; columns named like those added are replaced, others kept.  Lines are known by 63-bit hashes: two different
lines are taken for equal with a probability of 2**-63 a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, durable, fresh, small
from .order_minhash import _let

EDITS = 2
LEAST = 20
_ALPHABET = "abcdefghijklmnopqrstuvwxyz"
#: A line with more occurrences sends its keys from the first document alone.
FREQUENT = 100
#: Lines of a key that all others are compared with, by round.
LEADERS = (2, 2)
_BLANK = " \t\n\x0b\f\r"


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the other line is, segment of it, shift) of every substring that may be a segment of a line no longer."""
    return [
        (short, k, shift)
        for short in range(edits + 1)
        for k in range(edits + 1)
        for shift in range(max(-k, short - (edits - k)), min(k, short + (edits - k)) + 1)
    ]


def with_keys(lines: DataFrame, edits: int) -> DataFrame:
    """key, tagged: a row for each probe of lines (line, text); tagged: the line, and 1 more if the substring is a segment of
    the line itself.

    A segment of a line of m code points is one of edits + 1 even parts, the longer ones last.  A key covers m, the
    segment's number and its content.
    """
    parts = edits + 1
    listed = ", ".join(f"named_struct('short', {a}, 'k', {k}, 'shift', {x})" for a, k, x in probes(edits))
    # Exploding one element keeps the optimizer from working the length out anew wherever it is used.
    sized = lines.select("line", "text", F.explode(F.array(F.length("text"))).alias("size"))
    rows = sized.select("line", "text", "size", F.explode(F.expr(f"array({listed})")).alias("p"))
    rows = rows.withColumn("m", F.expr("size - p.short")).withColumn("each", F.expr(f"cast(m div {parts} as int)")).withColumn("longer", F.expr(f"m % {parts}"))
    rows = rows.withColumn("start", F.expr(f"p.k * each + greatest(p.k - {parts} + longer, 0) + p.shift")).withColumn("many", F.expr(f"each + if(p.k >= {parts} - longer, 1, 0)"))
    rows = rows.where("start >= 0 and start + many <= size and each > 0")
    # Where code points are bytes, the substring is found without counting; its hash is the same.
    part = "if(octet_length(text) = size, xxhash64(m, p.k, substring(cast(text as binary), start + 1, many)), xxhash64(m, p.k, substring(text, start + 1, many)))"
    return rows.select(F.expr(part).alias("key"), F.expr("line | if(p.short = 0 and p.shift = 0, 1L, 0L)").alias("tagged"))


def distance_sql(a: str, b: str, edits: int) -> str:
    """SQL for the edit distance of b and a line a that is no shorter, by edits at most; greater ones come out as greater than edits.

    One number holds the vertical differences of the 2 * edits + 1 cells of a column around the diagonal.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    same = " | ".join(f"if(get(x, i + {k - edits - 1}) = get(y, i - 1), {1 << k}L, 0L)" for k in range(width))
    step = _let(
        "p",
        f"named_struct('vp', shiftright(s.vp, 1) | {1 << width - 1}L, 'vn', shiftright(s.vn, 1), 'eq', {same})",
        _let(
            "q",
            f"named_struct('d0', ((((p.eq & p.vp) + p.vp) ^ p.vp) | p.eq | p.vn) & {full}L)",
            _let(
                "r",
                f"named_struct('hp', shiftleft((p.vn | ~(q.d0 | p.vp)) & {full}L, 1) | 1L, 'hn', shiftleft(q.d0 & p.vp, 1))",
                f"named_struct('vp', (r.hn | ~(q.d0 | r.hp)) & {full}L, 'vn', q.d0 & r.hp & {full}L, 'd', s.d + if((q.d0 & {1 << edits}L) = 0, 1, 0))",
            ),
        ),
    )
    start = f"named_struct('vp', {((1 << edits) - 1) << (edits + 1) & full}L, 'vn', 0L, 'd', 0)"
    down = " + ".join(f"if(size(x) - size(y) >= {k}, cast((shiftright(s.vp, {edits + k}) & 1) - (shiftright(s.vn, {edits + k}) & 1) as int), 0)" for k in range(1, edits + 1)) or "0"
    # What is beyond twice the edits on the diagonal stays beyond the edits at the end.
    step = f"if(s.d > {2 * edits}, s, {step})"
    walked = f"aggregate(if(size(y) = 0, cast(array() as array<int>), sequence(1, size(y))), {start}, (s, i) -> {step}, s -> if(s.d > {2 * edits}, s.d, s.d + {down}))"
    letters = lambda t: f"regexp_extract_all({t}, '(?s).', 0)"
    return _let("x", letters(a), _let("y", letters(b), f"if(size(x) - size(y) > {edits}, {edits + 1}, {walked})"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, mark (of the document's text), no, line (hash, an even number) and text: the lines of all documents that aren't
    blank."""
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce(F.make_valid_utf8("text"), F.lit("")).alias("t"))
    rows = texts.select("doc_id", F.xxhash64("t").alias("mark"), F.posexplode(F.split("t", "\n")).alias("no", "text"))
    return rows.where(F.btrim("text", F.lit(_BLANK)) != "").withColumn("line", F.expr("xxhash64(text) & -2L"))


def _letters_sql(line: str) -> str:
    """SQL for how often each of the letters a to z stands in a line, modulo four, in Gray code: an edit changes two bits at most."""
    count = lambda c: f"((length({line}) - length(replace({line}, '{c}', ''))) & 3)"
    return " | ".join(f"shiftleft(cast({count(c)} ^ shiftright({count(c)}, 1) as bigint), {2 * k})" for k, c in enumerate(_ALPHABET))


def _differ(x: str, y: str, edits: int) -> str:
    """SQL for whether two entries of a key may be alike and are in different components."""
    return f"{x}.comp <> {y}.comp and abs({x}.size - {y}.size) <= {edits} and bit_count({x}.letters ^ {y}.letters) <= {2 * edits} and ({x}.own or {y}.own)"


_ENTRY = ["line", "size", "letters", "comp", "own"]


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.line", "y.line").alias("a"), F.greatest("x.line", "y.line").alias("b")).distinct()


def _stars(entries: DataFrame, edits: int, around: int, leaders: int) -> DataFrame:
    """(a, b): lines of each key with its leaders of other components; around: the round.  A durable table."""

    def priority(k: int) -> Column:
        often = F.least(F.col("n"), F.lit((1 << 20) - 1)) if around == k == 0 else F.lit(0)
        return F.lit((1 << 62) - 1) - F.shiftleft(often.cast("long"), 40) - F.shiftrightunsigned(F.xxhash64("line", F.lit(100 * around + k)), 24)

    names = [f"p{k}" for k in range(leaders)]
    ranked = entries.withColumns({f"p{k}": F.when(F.col("own"), priority(k)) for k in range(leaders)})
    several = ranked.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *[F.min(p).alias(f"least_{p}") for p in names])
    here = ranked.join(several.where("low <> high and least_p0 is not null"), "key")
    first = here.where(" or ".join(f"{p} = least_{p}" for p in names)).select("key", F.struct(*_ENTRY).alias("y"))
    return durable(_pairs(here.select("key", F.struct(*_ENTRY).alias("x")).join(first, "key").where(_differ("x", "y", edits))))


def _rest(entries: DataFrame, edits: int) -> DataFrame:
    """(a, b): all lines of each key that are in different components and may be alike; a durable table."""
    sizes = entries.groupBy("key", "comp").count().groupBy("key").agg(F.max(F.struct("count", "comp")).alias("top"))
    sizes = durable(sizes.select("key", F.col("top.comp").alias("main")))
    here = durable(entries.join(sizes, "key").select("key", "main", F.struct(*_ENTRY).alias("x")))
    fewer = here.where("x.comp <> main").select("key", "main", F.col("x").alias("y"))
    out = durable(_pairs(here.drop("main").join(fewer, "key").where(f"{_differ('x', 'y', edits)} and (x.comp = main or x.line < y.line)")))
    discard(sizes, here)
    return out


def _mixed(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Entries of keys with lines of several components, with these; a durable table."""
    held = entries.join(small(groups, 64), "line", "left").withColumn("comp", F.coalesce("component", "line")).drop("component")
    keys = held.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("own").alias("indexed")).where("low <> high and indexed").select("key")
    keys = durable(keys)
    out = durable(held.join(small(keys, 64), "key"))
    discard(keys)
    return out


def verified(texts: DataFrame, pairs: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of lines within the edit distance; texts: line, text."""
    x, y = (texts.select(F.col("line").alias(k), F.col("text").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    near = pairs.join(x, "a").join(y, "b")
    ordered = near.select("a", "b", F.expr("if(length(x) >= length(y), x, y)").alias("x"), F.expr("if(length(x) >= length(y), y, x)").alias("y"))
    return ordered.where(F.expr(distance_sql("x", "y", edits)) <= edits).select("a", "b")


def classes(docs: DataFrame, counts: DataFrame, edits: int, least: int) -> DataFrame:
    """(line, component): lines that are alike with others; counts: line, n, low (smallest doc_id).  A durable table."""
    lines = _lines(docs).where(F.length("text") >= least)
    frequent = durable(counts.where(F.col("n") > FREQUENT).select("line", "low"))
    sending = lines.join(small(frequent, 64), "line", "left").where("low is null or low = doc_id")
    keys = with_keys(sending, edits).repartition("key")
    # Only keys that bring different lines together go on.
    several = keys.groupBy("key").agg(F.min("tagged").alias("first"), F.max("tagged").alias("last"), F.max(F.col("tagged").bitwiseAND(1)).alias("indexed"))
    several = several.where("first & -2L <> last & -2L and indexed = 1").select("key")
    met = durable(keys.join(several.hint("shuffle_hash"), "key").select("key", F.expr("tagged & -2L").alias("line"), F.expr("tagged & 1 = 1").alias("own")))
    held = durable(met.select("line").distinct())
    texts = lines.join(small(held, 64), "line").groupBy("line").agg(F.min("text").alias("text")).join(counts, "line")
    texts = durable(texts.select("line", "n", "text", F.length("text").alias("size"), F.expr(_letters_sql("text")).alias("letters")))
    entries = durable(met.distinct().join(texts.drop("text"), "line").withColumn("comp", F.col("line")))
    discard(frequent, met, held)

    near = found = None
    done = [texts]
    for around, leaders in enumerate((*LEADERS, 0)):
        pairs = _stars(entries, edits, around, leaders) if leaders else _rest(entries, edits)
        links = durable(verified(texts, pairs, edits))
        near = links if near is None else near.union(links)
        last, found = found, components(near)
        done += [links, entries] if last is None else [links, entries, last]
        discard(pairs)
        if leaders:
            entries = _mixed(entries.drop("comp"), found.select(F.col("node").alias("line"), "component"))
            if entries.isEmpty():
                done.append(entries)
                break
    discard(*done)
    return found.select(F.col("node").alias("line"), "component")


def gone(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """doc_id, mark, gone: numbers of the lines that go, of documents that have any."""
    occurrences = durable(_lines(docs).select("doc_id", "mark", "no", "line"))
    counts = durable(occurrences.groupBy("line").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")))
    alike = classes(docs, counts, edits, least)
    known = counts.join(small(alike, 64), "line", "left").where("n > 1 or component is not null")
    known = durable(known.select("line", F.coalesce("component", "line").alias("class")))
    hits = durable(occurrences.join(small(known, 64), "line").select("class", F.struct("doc_id", "mark", "no").alias("at")))
    stays = durable(hits.groupBy("class").agg(F.min("at").alias("stays")))
    late = hits.join(small(stays, 100), "class").where("at <> stays").groupBy("at.doc_id", "at.mark").agg(F.collect_set("at.no").alias("gone"))
    out = durable(late)
    discard(occurrences, counts, known, hits, stays)
    return out


def dedup_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """docs with the lines that stay as `kept`, and the counts n_lines (not blank) and n_removed; columns so named are replaced."""
    mark, lost, lines = (fresh(docs, x) for x in ("mark", "gone", "lines"))
    late = gone(docs, edits, least).select("doc_id", F.col("mark").alias(mark), F.col("gone").alias(lost))
    text = F.coalesce(F.make_valid_utf8("text"), F.lit(""))
    joined = docs.withColumn(mark, F.xxhash64(text)).join(late, ["doc_id", mark], "left")
    kept = _let("l", lines, f"transform(array_except(sequence(0, size(l) - 1), {lost}), i -> get(l, i))")
    out = (
        joined.withColumn(lines, F.split(text, "\n"))
        .withColumn("n_lines", F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(_BLANK)) != "")).cast("bigint"))
        .withColumn("n_removed", F.coalesce(F.size(lost), F.lit(0)).cast("bigint"))
        .withColumn("kept", F.expr(f"if({lost} is null, array_join({lines}, '\n'), array_join({kept}, '\n'))"))
    )
    return out.select(*docs.columns, *[c for c in ("kept", "n_lines", "n_removed") if c not in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256: one row per document."""
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
