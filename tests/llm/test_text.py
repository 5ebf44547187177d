"""Order MinHash, language ID, HTML extraction, the pipeline and the SQL of the registered queries."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from screenforge.llm import html_extract, language_id, order_minhash, queries
from screenforge.session import isolated

from ..conftest import DATA, rows_of
from . import brute


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(name, spark, duck):
    found = queries.QUERIES[name](spark, DATA).toPandas()
    wanted = duck.execute(queries.ORACLE_SQL[name]).df()
    assert rows_of(found) == rows_of(wanted)


def test_fingerprints_and_edited_texts(spark):
    rows = brute.documents()
    got = {r.doc_id: r for r in order_minhash.fingerprints(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    marks = {}
    for k, (i, text, *_) in enumerate(ordered):
        t, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == brute.sha(edited)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert marks.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        if edited == t:
            assert got[i].near_edited == 1
    long = [r for i, t, *_ in rows if len(t or "") > 300 for r in [got[i]]]
    assert sum(r.near_edited for r in long) > sum(r.near_next for r in long)


def test_fingerprints_match_brute_force(spark):
    rows = brute.documents() + [(20_000, "ab" * 400, None, None, 0), (20_001, "日本語のテキスト、" * 12 + "words between" + "x" * 30, None, None, 0), (20_002, "short one", None, None, 0)]
    clash = spark.createDataFrame(rows, brute.SCHEMA).withColumns({c: F.lit("clash") for c in ("marks", "next", "block", "__at", "fingerprint")})
    got = {r.doc_id: r for r in order_minhash.fingerprints(clash).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    written = lambda marks: "".join(f"{b << 32 | x:010x}" for b, x in sorted(marks.items()))
    for k, (i, text, *_) in enumerate(ordered):
        t, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        a, b, c = (brute.order_minhash(x) for x in (t, edited, following))
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (written(a), written(b))
        assert (got[i].near_edited, got[i].near_next) == (brute.likeness(a, b), brute.likeness(a, c))


def test_fingerprints_of_unspaced_and_short_texts_feel_edits(spark):
    near = F.expr(order_minhash.likeness_sql("a", "b"))
    pairs = [("abcdefghij" * 7 + "".join(random.Random(k).choice("acgt") for _ in range(400)), k) for k in range(3)] + [("a sentence of a few words only", 9)]
    df = spark.createDataFrame([(x, "z" + x) for x, _ in pairs], "x string, y string")
    df = df.select(F.expr(order_minhash.fingerprint_sql("x")).alias("a"), F.expr(order_minhash.fingerprint_sql("y")).alias("b"))
    assert min(r.n for r in df.select(near.alias("n")).collect()) > 0.6


def test_fingerprints_feel_order_and_edits(spark):
    r = random.Random(5)
    words = [f"w{r.randrange(10_000)}" for _ in range(1000)]
    moved = words[500:] + words[:500]
    light = list(words)
    light[300] = "new"
    near = F.expr(order_minhash.likeness_sql("a", "b"))

    def like(x, y):
        df = spark.createDataFrame([(" ".join(x), " ".join(y))], "x string, y string")
        return df.select(F.expr(order_minhash.fingerprint_sql("x")).alias("a"), F.expr(order_minhash.fingerprint_sql("y")).alias("b")).select(near.alias("n")).first().n

    assert like(words, words) == 1
    assert like(words, light) > 0.8
    assert like(words, moved) < 0.75  # the same words in another order
    assert like(["a"] * 50, ["a"] * 5) < 1  # occurrences are told apart


def test_neighbours_over_many_blocks(spark):
    ids = random.Random(2).sample(range(-(10**12), 10**12), 500)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.next.text for r in order_minhash.with_next(df, ["text"], block_bytes=100).collect()}
    ordered = sorted(ids, reverse=True)
    assert got == {i: f"t{ordered[(k + 1) % 500]}" for k, i in enumerate(ordered)}
    assert order_minhash.fingerprints(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (3, "b")], "doc_id long, text string")
    assert order_minhash.fingerprints(twice).count() == 4


def test_language_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    odd = spark.createDataFrame([(9_000_001, None), (9_000_002, ""), (9_000_003, "123 --- !!"), (None, "the of and that is for the")], "doc_id long, text string")
    odd = docs.unionByName(odd.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("long")})).withColumn("score", F.lit("clash"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.languages(odd).where("doc_id is null or doc_id > 9000000").collect()}
    assert [found[k] for k in (9_000_001, 9_000_002, 9_000_003)] == [("und", 0.0)] * 3 and found[None][0] == "en"
    kept = language_id.drop_unknown(odd)
    assert kept.columns == odd.columns and kept.count() == docs.count() + 1
    assert language_id.languages(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language_id.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.parametrize("cells", [language_id.MOST_CELLS, 50])
def test_predictions_match_brute_force(cells, spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_CELLS", cells)
    rows = [r for r in brute.documents() if len(r[1] or "") < 2000]
    rows += [(30_000 + k, f"{a} number {k} of {a}", lang, None, 0) for k in range(40) for a, lang in ((("the cat sat", "en"), ("le chat assis", "fr"))[k % 2],)]
    clash = spark.createDataFrame(rows + [rows[0]], brute.SCHEMA).withColumns({c: F.lit("clash") for c in ("lang_pred", "bits_per_byte", "held_out")})
    got = language_id.languages(clash).collect()
    want = brute.language(rows + [rows[0]])
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r.held_out, r.lang_pred) == want[r.doc_id][:2] and abs(r.score - want[r.doc_id][2]) < 1e-3


def test_code_lengths_are_exact():
    """The table's lengths are those of coding byte by byte, and every context's lengths are those of a code."""
    import numpy as np

    text = b"the then there that abc abd"
    raw = np.frombuffer(text, np.uint8)
    grams, n = np.unique(language_id._grams(raw, np.array([0, len(raw)])), return_counts=True)
    trees = language_id.Trees(["x"], [grams], [n.astype(float)])

    def plain(context: bytes, symbol: int) -> float:
        seen: dict[bytes, dict[int, int]] = {}
        padded = b"\n\n\n" + text
        for k in range(3, len(padded)):
            for order in range(4):
                d = seen.setdefault(padded[k - order : k], {})
                d[padded[k]] = d.get(padded[k], 0) + 1
        bits = 0.0
        for order in range(3, -1, -1):
            d = seen.get(context[3 - order :])
            if d:
                total = sum(d.values()) + len(d)
                if symbol in d:
                    return bits + np.log2(total / d[symbol])
                bits += np.log2(total / len(d))
        return bits + 8

    for context in (b"\n\n\n", b"the", b"zzz", b"he ", b"zab"):
        every = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint32)
        lengths = trees.lengths(every)[0]
        assert np.allclose(lengths, [plain(context, s) for s in range(256)])
        assert (2.0**-lengths).sum() <= 1 + 1e-9


PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
    "<header>Site</header><nav><ul><li><a href='/'>Home</a><li>More</ul></nav><div class=\"cookie-notice\">We use cookies</div>"
    "<div><h2>Always here</h2></div><{main}><h1>Title {k}</h1><p>First <b>bold {k}<br>line &eacute; &#233; a&nbsp;b<p>Second {k}"
    "<div class='advert box'>Buy</div><form><p>Mail</p><input name=x></form></{main}><aside>Side {k}</aside>"
    "<section id='comments'><p>Nice {k}</p></section><footer>&copy; x</footer></body></html>"
)


def test_html_extraction(spark):
    rows = [(k, f"http://Host.example/{k}", PAGE.format(k=k, main="article")) for k in range(8)]
    rows += [(100 + k, f"http://other.example/{k}", PAGE.format(k=k, main="div")) for k in range(8)]
    rows += [(200, None, None), (201, "x", ""), (202, "http://p.example/", "plain &lt;text&gt;\n and\tmore"), (203, "http://p.example/cut", "<article><p>Cut off <a hre"), (204, "http://d.example/", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in html_extract.main_texts(df).collect()}
    assert len(got) == len(rows)
    for k in range(8):
        want = f"Title {k}\nFirst bold {k} line é é a b\nSecond {k}"
        assert got[k].text == want and got[k].n_chars == len(want)
        assert got[100 + k].text == want  # "Always here" is constant in this host
    assert [got[k].text for k in (200, 201, 202, 203, 204)] == ["", "", "plain <text> and more", "Cut off", "deep"]
    assert html_extract.main_texts(df.limit(0)).collect() == []


def _texts(spark, pages):
    rows = [(k, f"http://h.example/{k}", p) for k, p in enumerate(pages)]
    return [r.text for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_html_slots_decide_inside_and_beside_articles(spark):
    notice = "<p>Read every day, a notice that stands in each article.</p>"
    got = _texts(spark, [f"<body><article><p>Own text of this page, longer than the notice that stands below it {k}</p>{notice}<p>Last {k}</p></article><div>About {k % 2}</div></body>" for k in range(16)])
    assert got == [f"Own text of this page, longer than the notice that stands below it {k}\nLast {k}" for k in range(16)]
    got = _texts(spark, [f"<body><div><p>A long body of page {k}</p><p>and more of {k}</p></div><article><p>Teaser</p></article></body>" for k in range(8)])
    assert got == [f"A long body of page {k}\nand more of {k}" for k in range(8)]
    assert _texts(spark, ["<body><div><p>A long body of the only page</p></div><article><p>Teaser</p></article></body>"]) == ["A long body of the only page\nTeaser"]


def test_html_pages_with_one_longest_block_all_count(spark):
    footer = "<p class=x>This licence text is longer than any paragraph of any of the pages here.</p>"
    got = _texts(spark, [f"<body><div><p>Own {k}</p></div>{footer}</body>" for k in range(8)])
    assert got == [f"Own {k}" for k in range(8)]


def test_html_rare_layouts_have_slots(spark):
    names = [f"x{a}{b}" for a in "bcdfghjk" for b in "bcdfghjk"]  # more than are merged in one go
    got = _texts(spark, [f"<body><div class='{n}'><p>Own {n} of page {k}</p><div>Notice of layout {n}</div></div></body>" for n in names for k in range(6)])
    assert got == [f"Own {n} of page {k}" for n in names for k in range(6)]
    got = _texts(spark, [f"<body><div class='{n}'><p>Own {n}</p><div>Notice of all</div></div></body>" for n in names])
    assert got == [f"Own {n}" for n in names]


def test_html_labels_keep_real_content(spark):
    wraps = ["<div style='overflow:hidden'>", "<div aria-hidden='false'>", "<div title='hidden valley'>", "<div class='layout has-sidebar'>", "<div id=page class='comments-open'>"]
    for kind in ("article", "div"):
        got = _texts(spark, [f"<body>{w}<{kind}><h1>Title {k}</h1><p>Own {k}</p></{kind}><div hidden>Gone {k}</div><aside>Side {k}</aside></div></body>" for k, w in enumerate(wraps)])
        assert got == [f"Title {k}\nOwn {k}" for k in range(5)]
    page = "<body><div class=has-sidebar><article>A long real article</article><div class=related><article>Teaser</article></div></div><div class=sidebar>Links</div></body>"
    assert _texts(spark, [page]) == ["A long real article"]


def test_html_labels_count_at_any_depth(spark):
    pages = ["<body>" + "<div>" * 250 + f"<nav>Menu</nav><p>Own {k}</p>" + "</div>" * 250 + "</body>" for k in range(3)]
    pages.append("<body><p>a</p>" + "</x>" * 2000 + "<div>" * 2000 + "<p>deep</p><aside>gone</aside>" + "</section>" * 2000)
    assert _texts(spark, pages) == ["Own 0", "Own 1", "Own 2", "a\ndeep"]


def test_html_wrapper_finds_a_notice_put_into_the_pages_table(spark, monkeypatch):
    """A host's notice within its articles goes by the template alone, and nothing else changes."""
    import os

    pages = spark.read.parquet(f"{os.path.dirname(DATA)}/sf0.01/pages.parquet")
    host = F.regexp_extract("url", "//([^/]*)", 1)
    noted = pages.withColumn("html", F.expr("replace(html, '</article>', concat('<p>Read all of ', regexp_extract(url, '//([^/]*)', 1), '</p></article>'))"))
    many = {r[0] for r in pages.groupBy(host.alias("host")).count().where("count >= 6").select("host").collect()}
    plain, found = ({r.page_id: r for r in html_extract.main_texts(x).collect()} for x in (pages, noted))
    mine = [k for k, r in plain.items() if r.url.split("/")[2] in many]
    assert len(mine) > 50 and all(found[k].text == plain[k].text for k in mine)
    schema = html_extract.wrappers(pages).schema
    monkeypatch.setattr(html_extract, "wrappers", lambda pages: spark.createDataFrame([], schema))
    without = {r.page_id: r.text for r in html_extract.main_texts(noted).collect()}
    assert all(f"Read all of {plain[k].url.split('/')[2]}" in without[k] for k in mine)


def test_html_repeated_rows_null_ids_and_clashing_names(spark):
    rows = [(None, "http://a.example/1", "<p>One</p>"), (7, None, "<p>Two</p>"), (7, None, "<p>Two</p>"), (8, "http://a.example/2", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = df.withColumns({c: F.lit("clash") for c in ("text", "template", "wrapper", "tree", "slot", "copy", "n_chars")})
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html_extract.main_texts(clash).collect()), key=str)
    assert got == sorted([(None, "One", 3), (7, "Two", 3), (7, "Two", 3), (8, "", 0)], key=str)


def test_tree_matching_is_best():
    """Simple tree matching against all order- and ancestry-keeping maps of small trees."""
    r = random.Random(9)

    def tree(depth):
        node = html_extract.Node(r.choice("ab"), None)
        node.children = [tree(depth - 1) for _ in range(r.randrange(4))] if depth else []
        return node

    def best(x, y):
        if x.label != y.label:
            return 0

        def rows(i, j):
            if i == len(x.children) or j == len(y.children):
                return 0
            return max(rows(i + 1, j), rows(i, j + 1), best(x.children[i], y.children[j]) + rows(i + 1, j + 1))

        return 1 + rows(0, 0)

    for _ in range(60):
        a, b = tree(2), tree(2)
        x, y = html_extract.number(a), html_extract.number(b)
        at = html_extract.matched(a, b)
        assert len(at) == best(a, b) and all(x[i].label == y[j].label for i, j in at.items())
        assert sorted(at.values()) == [at[k] for k in sorted(at)] and len(set(at.values())) == len(at)


def test_tree_matching():
    a, b = html_extract.read("0 r\n1 a\n2 x\n1 b\n1 c"), html_extract.read("0 r\n1 b\n1 a\n2 x\n2 y\n1 c")
    x, y = html_extract.number(a), html_extract.number(b)
    at = html_extract.matched(a, b)
    assert {(x[i].label, y[j].label) for i, j in at.items()} == {("r", "r"), ("a", "a"), ("x", "x"), ("c", "c")}
    assert html_extract.merged([html_extract.written(b), html_extract.written(a)]).count("\n") == 6


def test_pipeline(spark, tmp_path):
    """Stage by stage against brute force, each on what the one before has kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        rows = [(i, r.text, r.lang, r.source, r.n_chars) for i, r in before.items()]
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
            kept = {r.doc_id for r in docs.collect()}
        if name == "language ID":
            assert kept == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "exact dedup":
            assert kept == {i for i, x in brute.exact(rows).items() if x[2]}
        elif name == "n-gram Jaccard join":
            assert kept == {i for i, x in brute.similar(rows).items() if x[1] == i}
        elif name == "substring dedup":
            want = brute.repeats(rows)
            assert kept == {i for i, x in want.items() if x[1] < x[0] or not x[0]}
            for r in docs.collect():
                assert brute.sha(" ".join(brute.WORD.findall(r.text))) == want[r.doc_id][2]
        else:
            assert {r.doc_id for r in docs.collect()} == set(before)
    again = corpus_pipeline.run(spark, DATA)
    order = sorted(docs.columns)
    assert sorted(map(tuple, again.select(order).collect())) == sorted(map(tuple, docs.select(order).collect()))


def test_pipeline_on_odd_rows_and_empty_tables(spark, tmp_path):
    """Repeated and null ids, null columns, clashing names: every stage keeps the columns and what its operator says."""
    near = " ".join(f"word{k} of the text" for k in range(40))
    rows = [r for r in brute.documents() if r[1] is None or len(r[1]) < 5000]
    rows += [(30_001, near, "en", "s", 0), (30_002, near + " tail", "en", "s", 0), (30_002, "another text under the same number", None, None, 0)]
    rows += [(30_003, "twice the same row", "en", "s", 0)] * 2 + [(None, "a text without a number", None, None, None)]
    names = ("mark", "key", "gone", "at", "whole", "comp", "salt", "sha", "queue", "lang_pred", "kept")
    docs = spark.createDataFrame(rows, brute.SCHEMA).withColumns({c: F.concat(F.lit("own "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in names})
    columns, empty = docs.columns, docs.limit(0)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs, empty = stage(spark, docs, DATA), stage(spark, empty, DATA)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert empty.collect() == []
        if k < 4:
            kept = docs.collect()
            assert docs.columns == empty.columns == columns
            assert all(r[c] == f"own {'none' if r.doc_id is None else r.doc_id}" for r in kept for c in names)
            texts = sorted(r.text for r in kept if r.doc_id in (30_001, 30_002, 30_003, None) and r.text)
            left = ["a text without a number", "another text under the same number", "twice the same row", near]
            assert texts == sorted(left + (["twice the same row"] if k < 1 else []) + ([near + " tail"] if k < 2 else [])), name
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in kept}


def test_pipeline_passes_long_texts_in_small_batches(spark):
    """Texts of 40 MB in all: no stage hands a worker a batch of more than some megabytes; a lower limit of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    sizes = lambda stream: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in stream)
    for _, stage in corpus_pipeline.STAGES:
        own = isolated(spark)
        docs = own.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('ab c', 1 << 18)").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1 << 20).alias("n_chars"))
        stage(own, docs.limit(0), DATA)
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) >= 40 << 20 and max(found) <= 8 << 20
        own.conf.set(name, "1m")
        stage(own, docs.limit(0), DATA)
        assert own.conf.get(name) == "1m"
