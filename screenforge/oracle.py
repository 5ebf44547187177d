"""The engine's semantics once more, as DuckDB SQL written on its own, for comparison."""

from __future__ import annotations

from .config import ScreenConfig
from .functions import text as T
from .functions.detect import STOPWORDS

_WS = "concat(" + ", ".join(f"chr({ord(c)})" for c in T.WHITE_SPACE) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def quoted(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def case(value: str, labels: list[str], bounds: list) -> str:
    return "CASE " + " ".join(f"WHEN {value} < {b} THEN '{x}'" for x, b in zip(labels, bounds, strict=False)) + f" ELSE '{labels[-1]}' END"


def geometry(c: ScreenConfig) -> str:
    """CTE g: texts with length, eff, n, stride."""
    return f"""t AS (SELECT doc_id, source AS path, lang AS label, {strip("coalesce(text, '')")} AS t, text IS NULL AS missing,
            octet_length(encode(to_json({{'text': text}})::VARCHAR)) + 1 AS bytes FROM documents),
        g0 AS (SELECT *, length(t) AS len, least({c.chunk_size}, greatest(1000, length(t) // 4)) AS eff FROM t),
        g1 AS (SELECT *, least({c.max_chunks}, greatest(2, len // eff)) AS n FROM g0),
        g AS (SELECT *, len // n AS stride FROM g1)"""


def facts(c: ScreenConfig) -> str:
    """CTE f: facts of every document as a row of JSON lines whose file is its source."""
    hits = ", ".join(f"CASE WHEN length({strip('c')}) < {c.min_chars} THEN 0 ELSE len(list_filter(w, lambda x: list_contains({quoted(v.split())}, x))) END AS h_{k}" for k, v in STOPWORDS.items())
    names = list(STOPWORDS)
    best = " ".join(f"WHEN h_{k} = m THEN '{k}'" for k in names)
    code = "false"
    if c.code_detection:
        code = f"({code_sql()})"
    return f"""{geometry(c)},
        ch AS (SELECT doc_id, i, substring(t, i * stride + 1, eff) AS c FROM (SELECT *, unnest(range(0, n)) AS i FROM g WHERE len > {c.short_limit})
            UNION ALL SELECT doc_id, 0, t FROM g WHERE len BETWEEN 1 AND {c.short_limit}),
        w AS (SELECT doc_id, i, c, string_split(regexp_replace(lower(c), '[^\\p{{L}}]+', ' ', 'g'), ' ') AS w FROM ch),
        s AS (SELECT doc_id, i, {hits} FROM w),
        m AS (SELECT *, greatest({", ".join(f"h_{k}" for k in names)}) AS m, {" + ".join(f"h_{k}" for k in names)} AS total FROM s),
        p AS (SELECT doc_id, i, CASE WHEN m = 0 THEN 'unknown' {best} END AS lang, CASE WHEN m = 0 THEN 0.0::DOUBLE ELSE m::DOUBLE / total END AS conf FROM m),
        l AS (SELECT *, CASE WHEN conf < {c.confidence}::DOUBLE THEN 'uncertain' ELSE lang END AS lab FROM p),
        r AS (SELECT doc_id, lab, count(*) AS k, min(i) AS at, avg(conf) AS mean, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(i)) AS place
            FROM l GROUP BY doc_id, lab),
        v AS (SELECT doc_id, max(lab) FILTER (place = 1) AS dominant, max(mean) FILTER (place = 1) AS mean, coalesce(sum(k) FILTER (lab = 'en'), 0) AS en, sum(k) AS total,
            count(*) FILTER (lab NOT IN ('unknown', 'uncertain')) AS real FROM r GROUP BY doc_id),
        x AS (SELECT g.*, v.*, p.lang AS one_lang, p.conf AS one_conf, len > {c.short_limit} AS long, g.t <> '' AS has, g.t <> '' AND {code} AS code
            FROM g LEFT JOIN v USING (doc_id) LEFT JOIN p ON p.doc_id = g.doc_id AND p.i = 0),
        y AS (SELECT *, has AND NOT code AND long AS chunked, has AND NOT code AND NOT long AS single,
            CASE WHEN NOT long THEN one_lang WHEN real = 0 THEN 'unknown' WHEN en::DOUBLE / total >= {c.min_en_ratio}::DOUBLE THEN 'en' ELSE dominant END AS found,
            CASE WHEN NOT long THEN one_conf WHEN real = 0 THEN 0.0 ELSE mean END AS found_conf,
            CASE WHEN NOT long THEN coalesce(one_lang = 'en' AND one_conf >= {c.confidence}::DOUBLE, false) ELSE real > 0 AND en::DOUBLE / total >= {c.min_en_ratio}::DOUBLE END AS keep FROM x),
        f AS (SELECT doc_id, path, label, len, bytes, code, chunked, single, NOT has AS no_text, NOT has AS content_empty,
            CASE WHEN NOT has THEN 'unknown' WHEN code OR keep THEN 'en' ELSE 'non_selected' END AS bucket,
            CASE WHEN NOT has THEN 'no_text' WHEN code THEN 'code' ELSE found END AS lang,
            CASE WHEN has AND NOT code AND found_conf > 0 THEN found_conf END AS conf,
            chunked AND real > 1 AS mixed, chunked AND found = 'en' AND NOT keep AS contaminated,
            CASE WHEN chunked THEN en END AS en, CASE WHEN chunked THEN total END AS total,
            CASE WHEN has THEN length(t) - length(replace(t, ' ', '')) + 1 END AS words,
            CASE WHEN has THEN ((length(t) - length(replace(t, ' ', '')) + 1) * 13) // 10 END AS tokens,
            CASE WHEN missing THEN 'other' ELSE 'flat' END AS schema FROM y)"""


def code_signs_sql(x: str = "sample") -> dict[str, str]:
    held = lambda marks: " + ".join(f"contains({x}, '{m.replace(chr(39), chr(39) * 2)}')::INT" for m in marks)
    return {
        "fence": f"contains({x}, '```')",
        "single": f"({held(T.CODE_SINGLE)}) > 0",
        "keywords": held(T.CODE_KEYWORDS),
        "structural": held(T.CODE_STRUCTURAL),
        "letters": f"length(regexp_replace({x}, '[^\\p{{L}}]+', '', 'g'))",
        "braces": f"length(regexp_replace({x}, '[^{{}}()\\[\\];]+', '', 'g'))",
    }


def code_sql(x: str = "substring(t, 1, 3000)") -> str:
    s = code_signs_sql(x)
    return f"{s['fence']} OR {s['single']} OR ({s['keywords']}) >= 2 OR ({s['structural']}) >= 3 OR ({s['letters']} > 0 AND {s['braces']}::DOUBLE / greatest({s['letters']}, 1) > 0.08)"


def counters() -> str:
    kept, rejected = "bucket = 'en'", "bucket = 'non_selected'"
    count = lambda x: f"count(*) FILTER ({x})"
    total = lambda x, where: f"coalesce(sum({x}) FILTER ({where}), 0)::BIGINT"
    columns = {
        "total_rows": "count(*)", "kept_rows": count(kept), "rejected_rows": count(rejected), "unknown_rows": count("bucket = 'unknown'"),
        "code_rows": count("code"), "json_errors": "0::BIGINT", "key_missing": count("no_text"), "empty_lines": "0::BIGINT", "content_empty": count("content_empty"),
        "mixed_lang_rows": count("mixed"), "contaminated_rows": count("contaminated"),
        "kept_word_count": total("words", kept), "rejected_word_count": total("words", rejected), "kept_est_tokens": total("tokens", kept), "rejected_est_tokens": total("tokens", rejected),
        "chunked_rows": count("chunked"), "single_call_rows": count("single"),
    }
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


def spreads() -> str:
    out = []
    sides = {"kept_row_size": ("bytes", "bucket <> 'non_selected'"), "rejected_row_size": ("bytes", "bucket = 'non_selected'"), "conf_kept": ("conf", "bucket = 'en'"), "conf_rejected": ("conf", "bucket = 'non_selected'")}
    for name, (x, where) in sides.items():
        for f, body in (("avg", "round(avg({x}) FILTER ({w}), 2)"), ("min", "min({x}) FILTER ({w})"), ("max", "max({x}) FILTER ({w})"), ("sum", "round(sum({x}) FILTER ({w}), 2)")):
            out.append(f"coalesce({body.format(x=x, w=where)}, 0)::DOUBLE AS {name}_{f}")
    return ", ".join(out)
