"""Exact dedup, n-gram Jaccard join, substring dedup and line dedup against brute force."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from screenforge.llm import exact_dedup, line_dedup, ngram_join, substring_dedup
from screenforge.llm.common import components

from . import brute


@pytest.fixture(scope="module")
def rows():
    return brute.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(3).cache()


def by_id(df, *names):
    out = {}
    for r in df.collect():
        assert r["doc_id"] not in out
        out[r["doc_id"]] = tuple(r[n] for n in names)
    return out


CASES = {
    "exact": (exact_dedup.exact_duplicates, brute.exact, ("keep_id", "group_size", "kept", "text_sha256")),
    "near": (ngram_join.similar, brute.similar, ("n_shingles", "component_id")),
    "repeats": (substring_dedup.repeated_words, brute.repeats, ("n_words", "n_removed", "kept_sha256")),
    "lines": (line_dedup.line_report, brute.lines, ("n_lines", "n_removed", "kept_sha256")),
}


@pytest.mark.parametrize("name", CASES)
def test_matches_brute_force(name, docs, rows):
    query, plain, names = CASES[name]
    assert by_id(query(docs), *names) == plain(rows)


@pytest.mark.parametrize("name", CASES)
def test_empty_table_and_clashing_columns(name, spark, docs, rows):
    query, plain, names = CASES[name]
    assert query(spark.createDataFrame([], brute.SCHEMA)).collect() == []
    clash = docs.withColumns({n: F.lit("x") for n in ("n", "key", "digest", "kept", "gone", "block", "node", "component", "bucket", "line", "__id", "at")})
    few = clash.where("doc_id < 5000")
    assert by_id(query(few), *names) == plain([r for r in rows if r[0] < 5000])


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text), (None, None)], "doc_id long, text string")
    got = sorted(exact_dedup.exact_duplicates(df).collect(), key=str)
    assert [r.kept for r in got].count(True) == 2  # one of the texts, one of the empty ones
    assert {r.keep_id for r in got} == {9, None}
    twice = exact_dedup.exact_duplicates(df.where("doc_id is null or doc_id < 9")).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in twice) == [(0, False), (0, True), (5, False), (5, True)]
    near = ngram_join.similar(df).collect()
    assert len(near) == 5 and {r.component_id for r in near if r.doc_id is not None} == {5}
    words = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.repeated_words(df).collect()}
    assert words == {(None, 40): 0, (None, 0): 0, (5, 40): 0, (9, 40): 40}
    assert line_dedup.line_report(df).count() == 5


def test_rows_that_share_a_doc_id_keep_their_own_text(spark):
    """What is removed from one text is not removed from another under the same doc_id."""
    p, u = " ".join(f"p{k}" for k in range(30)), " ".join(f"u{k}" for k in range(40))
    df = spark.createDataFrame([(1, p), (2, p + " tail"), (2, u)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.repeated_words(df).collect())
    assert got == [(1, 30, 0), (2, 31, 30), (2, 40, 0)]
    assert sorted(r.text for r in substring_dedup.drop_repeats(df).collect()) == [p, "tail", u]
    line = "a line that stands in two documents"
    df = spark.createDataFrame([(1, line), (2, line), (2, "an unrelated unique line of another row")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in line_dedup.line_report(df).collect())
    assert got == sorted([(1, 0, brute.sha(line)), (2, 1, brute.sha("")), (2, 0, brute.sha("an unrelated unique line of another row"))])
    near = " ".join(f"p{k}" for k in range(60))
    df = spark.createDataFrame([(1, near), (2, near + " tail"), (2, u), (1, near + " x y"), (3, u + " v")], "doc_id long, text string")
    kept = ngram_join.drop_near_duplicates(df).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2] and u in [r.text for r in kept]


def test_words_of_two_letters_are_told_apart(spark):
    """Long words that a hash of sums of powers takes for equal."""
    a, b = "ab", "ba"
    for _ in range(9):
        a, b = a + b, b + a
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.similar(df).collect()} == {1: 1, 2: 2}
    same = " ".join(f"w{k}" for k in range(19))
    df = spark.createDataFrame([(1, f"{same} {a}"), (2, f"{same} {b}")], "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.repeated_words(df).collect()} == {0}


def test_large_tables_of_removals_are_joined(docs, rows, monkeypatch):
    """The way beyond the broadcast: documents that surely lose nothing pass by, the others meet their removals in a shuffle."""
    monkeypatch.setattr(substring_dedup, "fits", lambda table: False)
    want = brute.repeats(rows)
    assert by_id(substring_dedup.repeated_words(docs), "n_words", "n_removed", "kept_sha256") == want
    got = {r.doc_id: brute.sha(" ".join(brute.WORD.findall(r.text))) for r in substring_dedup.drop_repeats(docs).collect()}
    assert got == {i: x[2] for i, x in want.items() if x[1] < x[0] or x[0] == 0}


def test_frequent_anchors_go_by_window(spark, docs, rows, monkeypatch):
    """Windows of the most frequent anchors are dealt by their own words, with the same result."""
    emit = substring_dedup.recurring_anchors
    monkeypatch.setattr(substring_dedup, "recurring_anchors", lambda text, bits: emit(text, bits).union(_anchors_of(text)))

    def _anchors_of(text):
        def run(stream):
            for batch in stream:
                for *_, grams, _, best in substring_dedup._anchor_of_windows(batch.column(1)):
                    some = sorted(set(grams[best].view("int64").tolist()))[::2]
                    none = pa.nulls(len(some), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(some), pa.binary()), pa.array(some, pa.int64()), pa.array([1] * len(some))], schema=substring_dedup._AT)

        return text.mapInArrow(run, substring_dedup._AT_SQL).dropDuplicates(["hot"])

    assert by_id(substring_dedup.repeated_words(docs), "n_words", "n_removed", "kept_sha256") == brute.repeats(rows)


def test_filters_keep_columns_and_take_effect(docs, rows):
    columns = docs.columns
    one = exact_dedup.drop_exact_duplicates(docs)
    want = brute.exact(rows)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {i for i, x in want.items() if x[2]}
    two = ngram_join.drop_near_duplicates(docs)
    want = brute.similar(rows)
    assert two.columns == columns and {r.doc_id for r in two.collect()} == {i for i, x in want.items() if x[1] == i}
    three = substring_dedup.drop_repeats(docs)
    want = brute.repeats(rows)
    got = {r.doc_id: r for r in three.collect()}
    assert three.columns == columns
    assert set(got) == {i for i, x in want.items() if x[1] < x[0] or x[0] == 0}
    for i, r in got.items():
        assert brute.sha(" ".join(brute.WORD.findall(r.text or ""))) == want[i][2]
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("seed", range(3))
def test_large_near_copy_groups(seed, spark):
    """Chains and clouds of near copies: components by links between different texts."""
    r = random.Random(seed)
    base = [f"w{r.randrange(300)}" for _ in range(120)]
    rows, words = [], list(base)
    for i in range(60):
        if i % 2:
            words[r.randrange(120)] = f"c{i}"
            mine = words
        else:
            mine = list(base)
            for _ in range(r.randrange(4)):
                mine[r.randrange(120)] = f"d{r.randrange(50)}"
        rows.append((i, " ".join(mine), None, None, 0))
    df = spark.createDataFrame(rows, brute.SCHEMA)
    assert by_id(ngram_join.similar(df), "n_shingles", "component_id") == brute.similar(rows)


def test_long_lists_are_cut(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_ENTRIES", 4)
    assert by_id(ngram_join.similar(docs), "n_shingles", "component_id") == brute.similar(rows)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(edits, spark):
    r = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abé😀") for _ in range(r.randrange(18)))
        b = list(a)
        for _ in range(r.randrange(5)):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randrange(2)] = [r.choice("abé😀")] * r.randrange(2)
        pairs.append(sorted((a, "".join(b)), key=len, reverse=True))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.expr(line_dedup.distance_sql("a", "b", edits)).alias("d"))
    for x in df.collect():
        assert min(x.d, edits + 1) == min(brute.distance(x.a, x.b), edits + 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6), min_size=1, max_size=40), st.booleans())
def test_trie_merges_equal_keys(keys, spill):
    """With or without handing over what lies before the last key; keys in order, as owners get them."""
    trie, found = exact_dedup.RadixTrie(), []
    for k, key in sorted(enumerate(keys), key=lambda x: x[1]):
        if spill:
            found += trie.before(key)
        trie.insert(key, (key, k % 3, k, 1, 1), exact_dedup._merge)
    found += trie.values()
    want = {key: ((max(k for k, x in enumerate(keys) if x == key), 1, keys.count(key)), {k % 3 for k, x in enumerate(keys) if x == key}) for key in keys}
    assert len(found) == len(want) and {v[0]: (v[1], v[2]) for v in found} == want
    assert trie.held == -exact_dedup._NODE_BYTES  # all but the root were counted and freed


def test_owners_spill(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 2000)
    batch = exact_dedup._parts(pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "salt": [0] * len(rows)}))
    order = sorted(range(len(batch["bytes"])), key=lambda k: batch["bytes"][k])
    names = ["bytes", "digest", "salt", "doc_id", "same", "n"]
    table = pa.RecordBatch.from_arrays([pa.array([batch[x][k] for k in order], exact_dedup._PARTS.field(x).type) for x in names], names=names)
    out = list(exact_dedup._owners(iter([table])))
    want = {x[3]: x[:2] for x in brute.exact(rows).values()}
    assert len(out) > 3 and {r["digest"].hex(): (r["keep_id"], r["group_size"]) for b in out for r in b.to_pylist()} == want


def test_components(spark):
    r = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(50)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near: dict[int, set] = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want: dict[int, int] = {}
    for n in sorted(near):
        stack = [n] if n not in want else []
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = n
                stack += near[x]
    assert got == want
