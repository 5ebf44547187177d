"""Registered queries of the engine, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .config import ScreenConfig
from .functions import text as T
from .functions.detect import StopwordDetector
from .operators import chunking, decide, extract, resume, stats, verify
from .plans import screen
from .session import prepare, shared_folder, spread
from .sources import jsonl

DEFAULT = ScreenConfig()
#: Small chunks and a low limit, so that most documents are long and chunks leave gaps.
SMALL = ScreenConfig(short_limit=1500, chunk_size=400, max_chunks=5, min_en_ratio=0.6, confidence=0.6)
CODE = ScreenConfig(code_detection=True)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def _register(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


def _facts(spark: SparkSession, sf_dir: str, config: ScreenConfig = DEFAULT) -> DataFrame:
    """Documents as JSON lines, a file per source."""
    return screen.facts(jsonl.from_texts(_table(spark, sf_dir, "documents"), "source"), "text", config)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", T.strip(F.coalesce("text", F.lit(""))).alias("text"))


def _with(body: str, config: ScreenConfig = DEFAULT) -> str:
    return f"WITH {O.facts(config)} {body}"


@_register(_with("SELECT bucket, lang, count(*) AS rows FROM f GROUP BY bucket, lang"))
def bucket_by_language(spark, sf_dir):
    return _facts(spark, sf_dir).groupBy("bucket", "lang").agg(F.count("*").alias("rows"))


@_register(_with("SELECT p.doc_id, p.lang, round(p.conf, 9) AS conf FROM p WHERE i = 0", ScreenConfig(short_limit=1 << 30)))
def lang_detect_single(spark, sf_dir):
    found = StopwordDetector().one("text")
    return _texts(spark, sf_dir).where("text <> ''").withColumn("r", found).select("doc_id", "r.lang", F.round("r.conf", 9).alias("conf"))


def _geometry_sql(c: ScreenConfig) -> str:
    return f"WITH {O.geometry(c)} SELECT doc_id, len, eff, n, stride FROM g WHERE len > {c.short_limit}"


def _geometry(spark, sf_dir, c: ScreenConfig) -> DataFrame:
    texts = _texts(spark, sf_dir).withColumn("len", F.length("text").cast("long")).where(F.col("len") > c.short_limit)
    return chunking.geometry(texts, c).select("doc_id", "len", "eff", "n", "stride")


@_register(_geometry_sql(DEFAULT))
def chunk_geometry(spark, sf_dir):
    return _geometry(spark, sf_dir, DEFAULT)


@_register(_geometry_sql(SMALL))
def chunk_geometry_small(spark, sf_dir):
    return _geometry(spark, sf_dir, SMALL)


@_register(f"WITH {O.geometry(SMALL)} SELECT doc_id, i, length(c) AS chars, md5(c) AS digest FROM (SELECT doc_id, i, substring(t, i * stride + 1, eff) AS c FROM (SELECT *, unnest(range(0, n)) AS i FROM g WHERE len > {SMALL.short_limit}))")
def chunk_explode(spark, sf_dir):
    long = _texts(spark, sf_dir).where(F.length("text") > SMALL.short_limit)
    parts = long.select("doc_id", F.posexplode(chunking.chunks("text", SMALL)).alias("i", "c"))
    return parts.select("doc_id", F.col("i").cast("long").alias("i"), F.length("c").cast("long").alias("chars"), F.md5("c").alias("digest"))


def _vote_sql(c: ScreenConfig) -> str:
    return _with("SELECT doc_id, bucket, lang, round(coalesce(conf, 0), 9) AS conf, mixed, contaminated, en::BIGINT AS en, total::BIGINT AS total FROM f WHERE chunked", c)


def _vote(spark, sf_dir, c: ScreenConfig) -> DataFrame:
    long = _texts(spark, sf_dir).where(F.length("text") > c.short_limit)
    r = decide.detected(long, c, StopwordDetector(min_chars=c.min_chars)).select("doc_id", "found.*")
    bucket = F.when(F.col("keep"), "en").otherwise("non_selected")
    conf = F.round("conf", 9)
    foul = ~F.col("keep") & (F.col("lang") == "en")
    return r.select("doc_id", bucket.alias("bucket"), "lang", conf.alias("conf"), "mixed", foul.alias("contaminated"), F.col("en").cast("long"), F.col("total").cast("long"))


@_register(_vote_sql(DEFAULT))
def chunk_vote(spark, sf_dir):
    return _vote(spark, sf_dir, DEFAULT)


@_register(_vote_sql(SMALL))
def chunk_vote_small(spark, sf_dir):
    return _vote(spark, sf_dir, SMALL)


def _route_sql(c: ScreenConfig) -> str:
    return _with("SELECT path, bucket, lang, chunked, mixed, contaminated, code, count(*) AS rows, sum(words)::BIGINT AS words FROM f GROUP BY ALL", c)


def _route(spark, sf_dir, c: ScreenConfig) -> DataFrame:
    keys = ["path", "bucket", "lang", "chunked", "mixed", "contaminated", "code"]
    return _facts(spark, sf_dir, c).groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("words").alias("words"))


@_register(_route_sql(DEFAULT))
def route_documents(spark, sf_dir):
    return _route(spark, sf_dir, DEFAULT)


@_register(_route_sql(SMALL))
def route_documents_small(spark, sf_dir):
    return _route(spark, sf_dir, SMALL)


@_register(_route_sql(CODE))
def route_documents_code(spark, sf_dir):
    return _route(spark, sf_dir, CODE)


_SIGNS = ", ".join(f"{v} AS {k}" for k, v in O.code_signs_sql("substring(x, 1, 3000)").items())
_CODE_OF = "SELECT {id} AS id, {signs}, ({code}) AS is_code FROM (SELECT {id}, coalesce({x}, '') AS x FROM {table})"


def _code(df: DataFrame, key: str, x: str) -> DataFrame:
    df = df.select(F.col(key).alias("id"), F.coalesce(x, F.lit("")).alias("x"))
    return df.select("id", *[v.alias(k) for k, v in T.code_signs(F.col("x")).items()], T.is_code(F.col("x")).alias("is_code"))


@_register(_CODE_OF.format(id="doc_id", x="text", table="documents", signs=_SIGNS, code=O.code_sql("substring(x, 1, 3000)")))
def code_heuristic(spark, sf_dir):
    return _code(_table(spark, sf_dir, "documents"), "doc_id", "text")


@_register(_CODE_OF.format(id="page_id", x="html", table="pages", signs=_SIGNS, code=O.code_sql("substring(x, 1, 3000)")))
def code_heuristic_pages(spark, sf_dir):
    return _code(_table(spark, sf_dir, "pages"), "page_id", "html")


@_register(f"WITH {O.geometry(DEFAULT)}, w AS (SELECT doc_id, length(t) - length(replace(t, ' ', '')) + 1 AS words FROM g) SELECT doc_id, words, (words * 13) // 10 AS tokens FROM w")
def word_token_counts(spark, sf_dir):
    words = T.word_count(F.col("text"))
    return _texts(spark, sf_dir).select("doc_id", words.alias("words"), T.token_estimate(words).alias("tokens"))


def _hist_sql(value: str, labels: list[str], sides: dict[str, str], c: ScreenConfig = DEFAULT) -> str:
    marked = " UNION ALL ".join(f"SELECT '{s}' AS side, {value} AS b FROM f WHERE {w}" for s, w in sides.items())
    every = f"SELECT side, b FROM (SELECT unnest({O.quoted(list(sides))}) AS side) CROSS JOIN (SELECT unnest({O.quoted(labels)}) AS b)"
    return _with(f"SELECT e.side, e.b AS bucket, count(m.b) AS rows FROM ({every}) e LEFT JOIN ({marked}) m ON m.side = e.side AND m.b = e.b GROUP BY e.side, e.b", c)


@_register(_hist_sql(O.case("bytes", T.SIZE_BUCKETS, T.SIZE_BOUNDS), T.SIZE_BUCKETS, {"kept": "bucket <> 'non_selected'", "rejected": "bucket = 'non_selected'"}))
def size_hist(spark, sf_dir):
    return stats.size_histogram(_facts(spark, sf_dir))


@_register(_hist_sql(f"CASE WHEN conf IS NOT NULL THEN {O.case('conf', T.CONF_BUCKETS, T.CONF_BOUNDS)} END", T.CONF_BUCKETS, {"kept": "bucket = 'en'", "rejected": "bucket = 'non_selected'"}))
def conf_hist(spark, sf_dir):
    return stats.conf_histogram(_facts(spark, sf_dir))


@_register(_hist_sql(f"{O.quoted(T.RATIO_BUCKETS)}[(least(9, en * 10 // total) + 1)::BIGINT]", T.RATIO_BUCKETS, {"chunked": "chunked"}, SMALL))
def en_ratio_hist(spark, sf_dir):
    return stats.ratio_histogram(_facts(spark, sf_dir, SMALL))


_RATES = "CASE WHEN total_rows > 0 THEN printf('%.1f%%', kept_rows / total_rows::DOUBLE * 100) ELSE 'N/A' END AS kept_pct, CASE WHEN total_rows > 0 THEN round(rejected_rows / total_rows::DOUBLE * 100, 1) ELSE 0 END AS rejection_rate"


@_register(_with(f", a AS (SELECT path, {O.counters()}, {O.spreads()} FROM f GROUP BY path) SELECT *, {_RATES} FROM a"))
def file_stats(spark, sf_dir):
    return stats.by_file(_facts(spark, sf_dir))


_RATIOS = ", ".join(
    f"CASE WHEN {whole} > 0 THEN round({part} / ({whole})::DOUBLE * 100, 1) ELSE 0 END AS retention_ratio_{name}"
    for name, part, whole in (
        ("rows", "kept_rows", "total_rows"),
        ("words", "kept_word_count", "kept_word_count + rejected_word_count"),
        ("est_tokens", "kept_est_tokens", "kept_est_tokens + rejected_est_tokens"),
    )
)


@_register(_with(f", a AS (SELECT count(DISTINCT path) AS total_files, {O.counters()}, {O.spreads()} FROM f) SELECT *, {_RATES}, {_RATIOS} FROM a", SMALL))
def global_stats(spark, sf_dir):
    return stats.total(_facts(spark, sf_dir, SMALL))


@_register(_with(f"SELECT path, grouping(path)::INT AS is_total, {O.counters()} FROM f GROUP BY ROLLUP (path)"))
def stats_rollup(spark, sf_dir):
    return stats.rollup(_facts(spark, sf_dir))


_LANGS = ["code", "de", "en", "es", "fr", "no_text", "uncertain", "unknown"]


@_register(_with("SELECT path, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS lang_{x}" for x in _LANGS) + " FROM f GROUP BY path", SMALL))
def lang_pivot(spark, sf_dir):
    return stats.pivoted(_facts(spark, sf_dir, SMALL), "lang", _LANGS)


@_register(_with("SELECT path, " + ", ".join(f"count(*) FILTER (schema = '{x}') AS schema_{x}" for x in ("flat", "other")) + " FROM f GROUP BY path"))
def schema_pivot(spark, sf_dir):
    return stats.pivoted(_facts(spark, sf_dir), "schema", ["flat", "other"])


@_register(_with("SELECT path, lang, count(*) AS count FROM f GROUP BY path, lang"))
def language_frequencies(spark, sf_dir):
    return stats.frequencies(_facts(spark, sf_dir), "lang")


@_register(_with("SELECT lang, count(*) AS count FROM f WHERE lang NOT IN ('en', 'unknown', 'no_text', 'code') GROUP BY lang ORDER BY count DESC, lang LIMIT 5", SMALL))
def top_rejected_langs(spark, sf_dir):
    return stats.top_rejected(_facts(spark, sf_dir, SMALL), limit=5)


@_register(_with(f", a AS (SELECT path, {O.counters()} FROM f GROUP BY path), b AS (SELECT path, {_RATES} FROM a) SELECT path, rejection_rate, row_number() OVER (ORDER BY rejection_rate DESC, path)::INT AS place FROM b"))
def quality_ranking(spark, sf_dir):
    from pyspark.sql import Window

    files = stats.by_file(_facts(spark, sf_dir)).select("path", "rejection_rate")
    return files.withColumn("place", F.row_number().over(Window.orderBy(F.desc("rejection_rate"), "path")))


@_register(_with(f", a AS (SELECT {O.counters()} FROM f) SELECT {_RATIOS} FROM a"))
def retention(spark, sf_dir):
    return stats.total(_facts(spark, sf_dir)).select(*stats.retention())


_PLANTED = "substring(path, 4)::INT % 3 = 0 OR substring(path, 4)::INT % 5 = 0"


@_register(_with(f"SELECT DISTINCT path, 'rows do not add up' AS finding FROM f WHERE {_PLANTED}"))
def row_accounting(spark, sf_dir):
    """Files of every third source lost a kept row, those of every fifth counted an unknown row too many."""
    number = F.substring("path", 4, 10).cast("int")
    files = stats.by_file(_facts(spark, sf_dir)).withColumns({"kept_rows": F.col("kept_rows") - F.when(number % 3 == 0, 1).otherwise(0), "unknown_rows": F.col("unknown_rows") + F.when(number % 5 == 0, 1).otherwise(0)})
    return verify.accounting(files)


@_register("SELECT source AS path, 'output lines differ from counted rows' AS finding FROM documents GROUP BY source HAVING substring(source, 4)::INT % 4 = 0")
def output_line_counts(spark, sf_dir):
    """Of the outputs of every fourth source a line is missing."""
    files = _table(spark, sf_dir, "documents").groupBy(F.col("source").alias("path")).agg(F.count("*").alias("kept_rows"))
    files = files.select("path", F.col("path").alias("basename"), "kept_rows", F.lit(0).alias("rejected_rows"), F.lit(0).alias("unknown_rows"))
    first = _table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    lost = first.where(F.substring("source", 4, 10).cast("int") % 4 == 0)
    written = _table(spark, sf_dir, "documents").join(lost, ["source", "doc_id"], "left_anti").select(F.col("source").alias("basename"), F.lit("en").alias("bucket"))
    return verify.line_counts(files, written)


_BLOCKS = """l AS (SELECT source, doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS b, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
    s AS (SELECT source, sum(b) AS size, count(*) AS n FROM l GROUP BY source)"""


def _blocks(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Lines of documents, a file a source, as if read in two blocks; and the files' numbers."""
    from pyspark.sql import Window

    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("path"), "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("bytes"))
    order = Window.partitionBy("path").orderBy("doc_id")
    lines = docs.withColumns({"i": F.row_number().over(order), "upto": F.sum("bytes").over(order), "size": F.sum("bytes").over(Window.partitionBy("path"))})
    # The second block starts at the last byte of the first line; the first line belongs to the first block.
    edge = F.min(F.when(F.col("i") == 1, F.col("bytes") - 1)).over(Window.partitionBy("path"))
    lines = lines.withColumns({"start": F.when(F.col("i") == 1, 0).otherwise(edge).cast("long"), "length": F.when(F.col("i") == 1, edge).otherwise(F.col("size") - edge)})
    return lines, F.substring("path", 4, 10).cast("int")


@_register(f"WITH {_BLOCKS} SELECT source AS path, 'bytes read differ from file size' AS finding FROM s WHERE substring(source, 4)::INT % 3 = 0 AND n > 2")
def byte_coverage(spark, sf_dir):
    """Of every third source's file the third line is lost."""
    lines, number = _blocks(spark, sf_dir)
    return verify.coverage(verify.by_block(lines.where(~((number % 3 == 0) & (F.col("i") == 3)))))


@_register(f"WITH {_BLOCKS} SELECT source AS path, 'a block''s first line starts outside of it' AS finding FROM s WHERE substring(source, 4)::INT % 4 = 0 AND n > 1")
def block_boundaries(spark, sf_dir):
    """The first line of every fourth source's file is read as part of the second block: nothing comes before it."""
    lines, number = _blocks(spark, sf_dir)
    moved = (number % 4 == 0) & (F.col("i") == 1)
    edge = F.col("bytes") - 1
    lines = lines.withColumns({"start": F.when(moved, edge).otherwise(F.col("start")), "length": F.when(moved, F.col("size") - edge).otherwise(F.col("length"))})
    return verify.boundaries(verify.by_block(lines))


@_register("""SELECT source AS path, CASE WHEN substring(source, 4)::INT % 3 = 1 THEN 'key ''body'' is in none of the sampled lines; keys there: text'
    ELSE 'no valid JSON object in the sampled lines' END AS finding FROM documents GROUP BY source HAVING substring(source, 4)::INT % 3 > 0""")
def key_validation(spark, sf_dir):
    """Every third source's file has its key, the next ones are listed under another key, the others hold no objects."""
    docs = _table(spark, sf_dir, "documents")
    number = F.substring("source", 4, 10).cast("int") % 3
    key = F.when(number == 1, "body").otherwise("text")
    value = F.when(number == 2, F.lit("[1]")).otherwise(F.to_json(F.struct("text"), {"ignoreNullFields": "false"}))
    lines = docs.select(F.col("source").alias("path"), key.alias("key"), value.alias("value"))
    return verify.keys_found(lines.select("path", "key").distinct(), jsonl.key_presence(lines))


@_register("WITH p AS (SELECT url FROM pages UNION ALL SELECT url FROM pages WHERE page_id % 10 = 0) SELECT url AS path, count(*) AS times FROM p GROUP BY url HAVING count(*) > 1")
def dup_paths(spark, sf_dir):
    """Every tenth page is listed twice."""
    pages = _table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return verify.duplicate_paths(pages.union(pages.where("page_id % 10 = 0")).select("path"))


@_register(
    "WITH p AS (SELECT DISTINCT '/p' || (doc_id % 3) || '/' || coalesce(lang, 'x') || '/a/' || source || '.v1.jsonl' AS path, coalesce(lang, 'x') || '_a_' || source || '.v1' AS basename FROM documents) "
    "SELECT basename, count(*) AS paths, min(path) AS first_path FROM p GROUP BY basename HAVING count(*) > 1"
)
def basename_collision(spark, sf_dir):
    """Files of like names in three folders of like names."""
    parts = ("/p", (F.col("doc_id") % 3).cast("string"), "/", F.coalesce("lang", F.lit("x")), "/a/", F.col("source"), ".v1.jsonl")
    named = _table(spark, sf_dir, "documents").select(F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("path"))
    found = verify.basename_collisions(named.withColumn("basename", T.output_basename(F.col("path"))))
    return found.select("basename", F.size("paths").cast("long").alias("paths"), F.element_at("paths", 1).alias("first_path"))


@_register("SELECT source AS path, count(*) AS size FROM documents GROUP BY source HAVING NOT (substring(source, 4)::INT % 3 = 0 AND count(*) % 2 = 0)")
def resume_skip(spark, sf_dir):
    files = _table(spark, sf_dir, "documents").groupBy(F.col("source").alias("path")).agg(F.count("*").alias("size")).withColumn("key", F.lit("text"))
    number = F.substring("path", 4, 10).cast("int")
    # The earlier run saw every third file, but recorded an odd size as even, or lost a line of its output.
    earlier = files.where(number % 3 == 0).select(
        "path", "key", (F.col("size") - F.when(number % 2 == 0, F.col("size") % 2).otherwise(0)).alias("input_size_bytes"), F.col("path").alias("basename"), F.col("size").alias("kept_rows"), *[F.lit(0).alias(f"{b}_rows") for b in ("rejected", "unknown")]
    )
    written = files.select(F.col("path").alias("basename"), F.lit("en").alias("bucket"), (F.col("size") - F.col("size") % 2).alias("lines"))
    return resume.remaining(files, resume.finished(files, earlier, written)).select("path", "size")


def _chats(spark, sf_dir, role: str, content: str, key: str) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias(role), F.col("text").alias(content))))
    chats = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    return chats.select("conv_id", F.to_json(F.struct(F.transform("turns", lambda t: t.dropFields("turn")).alias(key)), {"ignoreNullFields": "false"}).alias("value"))


_CHAT_SQL = f"SELECT conv_id, '{{label}}' AS schema, md5(coalesce(string_agg({O.strip('text')}, chr(10) ORDER BY turn) FILTER ({O.strip('text')} <> ''), '')) AS digest FROM conversations GROUP BY conv_id"


def _extracted(rows: DataFrame, key: str, *names: str) -> DataFrame:
    return extract.with_text(extract.parsed(rows), key).select(*names, "schema", F.md5("text").alias("digest"))


@_register(_CHAT_SQL.format(label="chatml"))
def extract_messages(spark, sf_dir):
    return _extracted(_chats(spark, sf_dir, "role", "content", "messages"), "messages", "conv_id")


@_register(_CHAT_SQL.format(label="sharegpt"))
def extract_sharegpt(spark, sf_dir):
    return _extracted(_chats(spark, sf_dir, "from", "value", "conversations"), "conversations", "conv_id")


@_register(f"SELECT doc_id, CASE WHEN text IS NULL THEN 'other' ELSE 'flat' END AS schema, md5({O.strip(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')')}) AS digest FROM documents")
def extract_flat(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return _extracted(docs.select("doc_id", F.to_json(F.struct("text"), {"ignoreNullFields": "false"}).alias("value")), "text", "doc_id")


@_register(
    f"SELECT conv_id, 'flat' AS schema, md5(coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER ({O.strip('text')} <> ''), '')) AS digest FROM conversations GROUP BY conv_id"
)
def extract_list(spark, sf_dir):
    turns = F.sort_array(F.collect_list(F.struct("turn", "text")))
    chats = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    return _extracted(chats.select("conv_id", F.to_json(F.struct(F.col("turns.text").alias("lines"))).alias("value")), "lines", "conv_id")


@_register("SELECT 'chatml' AS schema, count(DISTINCT conv_id) AS rows FROM conversations UNION ALL SELECT 'sharegpt', count(DISTINCT conv_id) FROM conversations UNION ALL SELECT CASE WHEN text IS NULL THEN 'other' ELSE 'flat' END, count(*) FROM documents GROUP BY 1")
def schema_label(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.to_json(F.struct("text"), {"ignoreNullFields": "false"}).alias("value"))
    chats = [_chats(spark, sf_dir, a, b, k).select("value") for a, b, k in (("role", "content", "messages"), ("from", "value", "conversations"))]
    rows = extract.parsed(docs.union(chats[0]).union(chats[1]))
    return rows.select(extract.schema_label("text").alias("schema")).groupBy("schema").agg(F.count("*").alias("rows"))


@_register(_with("SELECT label, CASE WHEN bucket = 'en' THEN 'en' ELSE lang END AS lang, count(*) AS rows FROM f GROUP BY ALL"))
def detector_confusion(spark, sf_dir):
    texts = _texts(spark, sf_dir)
    r = decide.detected(texts.withColumn("text", F.when(F.col("text") != "", F.col("text"))), DEFAULT, StopwordDetector())
    lang = F.when(F.col("text").isNull(), "no_text").when(F.col("found.keep"), "en").otherwise(F.col("found.lang"))
    return r.groupBy(F.col("lang").alias("label"), lang.alias("lang")).agg(F.count("*").alias("rows"))


@_register("SELECT doc_id % 7 AS part, count(*) AS lines, sum(octet_length(encode(to_json({'text': text})::VARCHAR)) + 1)::BIGINT AS bytes FROM documents GROUP BY 1")
def jsonl_round_trip(spark, sf_dir):
    """Documents written as JSON lines and read back: lines and bytes by part."""
    prepare(spark)
    folder = f"{shared_folder(spark)}/round_trip_{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    rows = docs.select((F.col("doc_id") % 7).alias("part"), F.to_json(F.struct("text"), {"ignoreNullFields": "false"}).alias("value"))
    rows.write.mode("overwrite").option("lineSep", "\n").partitionBy("part").text(folder)
    back = spark.read.schema("value string, part long").option("lineSep", "\n").text(folder)
    return back.groupBy("part").agg(F.count("*").alias("lines"), F.sum(T.raw_bytes(F.col("value"))).alias("bytes"))


@_register("SELECT doc_id, 'not valid JSON' AS finding FROM documents WHERE doc_id % 7 < 2 AND doc_id % 3 = 0")
def json_sample(spark, sf_dir):
    """Kept lines, of which some were cut or have something behind the object; the sample is every third line."""
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct("text"), {"ignoreNullFields": "false"}).alias("value")).where("doc_id % 3 = 0")
    wrong = F.when(F.col("doc_id") % 7 == 0, F.expr("left(value, length(value) - 1)")).when(F.col("doc_id") % 7 == 1, F.concat("value", F.lit("]"))).otherwise(F.col("value"))
    return verify.json_sample(lines.withColumn("value", wrong), 1.0).select("doc_id", "finding")


_EDGES = ["", "\r", " ", "{", "[{}]", "null", '{"text":"x"} y', '{"text":"x"},{}', '{"other":"x"}', '{"text":null}', '{"text":5}', '{"text":" "}', '{"text":[]}', '{"text":["a", 1, " "]}', '{"text":"a","text":"b"}', ' {"text":"x"} ', '{"text":"x"]', '{"a":NaN}']
_EDGE_FACTS = "0empty 0empty 3error 3error 3error 3error 3error 3error 2missing 2blank 2blank 2blank 2blank 1text 1text 1text 3error 3error".split()


@_register(
    f"""WITH e AS (SELECT doc_id, [{', '.join(f"'{x}'" for x in _EDGE_FACTS)}][(doc_id % {len(_EDGES)} + 1)::BIGINT] AS e FROM documents)
    SELECT doc_id, e = '0empty' AS empty_line, e = '3error' AS json_error, e[1] = '2' AS key_missing, e = '2blank' AS content_empty,
        CASE e[1] WHEN '2' THEN 'unknown' WHEN '0' THEN NULL ELSE 'non_selected' END AS bucket FROM e"""
)
def json_edge_rows(spark, sf_dir):
    """Blank, broken, repeated and empty values: what comes of each."""
    listed = F.array(*[F.lit(x) for x in _EDGES])
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.element_at(listed, (F.col("doc_id") % len(_EDGES)).cast("int") + 1).alias("value"))
    return screen.facts(lines, "text", DEFAULT).select("doc_id", "empty_line", "json_error", "key_missing", "content_empty", "bucket")
