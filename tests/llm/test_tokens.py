"""Token counts, packing and SentencePiece against their libraries."""

from __future__ import annotations

import base64
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from screenforge.llm import packing, sentence_pieces, token_counts
from screenforge.llm.queries import BYTE_PATTERN, tokenizer_path
from screenforge.llm.tokens import ChunkCache, encoded, huggingface_encoder, plain_parts

from . import brute

ODD = ["", " ", "  a", " x  y ", "é" * 300, "日本語テキスト", "a\n\nb \n c", "▁▁x ▁", "\t tab", "<s> </s>", "x" * 500, "👍🏽 ok", "ab" * 200 + " " + "ion" * 90, "é", "\x00a", "ÀÉÎ, Été. ×a a÷ ß?! ÿÞ. a.b ...x ,a Ãx\xc3 Ö,Ö;", "L" * 90 + ".", "It's WE'RE 12,5 <|endoftext|>b İstanbul ΑΣ ª º ×"]
LETTERS = ["a", "bc", " ", "  ", "\n", "'s", "é", " ", "1", " x", "\t", "日", "!", "\x1c", " "]


@pytest.fixture(scope="module")
def texts():
    return [t or "" for _, t, *_ in brute.documents()] + ODD


def test_word_encoding(texts):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    for a, ids, first in encoded(pa.array(texts), ChunkCache(huggingface_encoder(path)), plain_parts):
        for k in range(len(first) - 1):
            assert ids[first[k] : first[k + 1]].tolist() == plain.encode(texts[a + k], add_special_tokens=False).ids


def test_word_encoding_holds_little():
    """Packing encodes 8 MB of text in slices, which don't change the ids; meanwhile a worker holds less than 60 MB more."""
    words = [" ".join(f"Word{k % 997}, of" for k in range(n, n + 500)) for n in range(0, 800_000, 500)]
    column, cache = pa.array(words), ChunkCache(huggingface_encoder(tokenizer_path("word_bpe_49k.json")))
    assert column.nbytes > 8 << 20
    whole = np.concatenate([ids for _, ids, _ in encoded(column, cache, plain_parts)])
    tracemalloc.start()
    sums, at = 0, 0
    for _, ids, _ in encoded(column, cache, plain_parts, packing.MOST_TEXT):
        assert (ids == whole[at : at + len(ids)]).all()
        at += len(ids)
        sums = max(sums, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert at == len(whole) and sums < 60 << 20


def test_piece_encoding(texts):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    plain, model = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.Pieces(path)
    for a, ids, first in sentence_pieces.encoded_column(pa.array(texts), ChunkCache(model.packed)):
        for k in range(len(first) - 1):
            mine = ids[first[k] : first[k + 1]]
            assert mine.tolist() == plain.encode(texts[a + k])
            assert model.decode(mine).decode(errors="replace") == plain.decode(mine.tolist())


def plain_bpe(text: str, scores: dict[str, float]) -> list[str]:
    parts = list(text)
    while True:
        found = [(-scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
        if not found:
            return parts
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@pytest.mark.parametrize("seed", range(8))
def test_forward_pass_is_bpe(seed, monkeypatch):
    """Made-up pieces, some of them equally preferred or never formed, and code points without a piece."""
    r = random.Random(seed)
    made = {"".join(r.choice("ab日") for _ in range(r.randrange(1, 6))) for _ in range(25)} | {"a", "b"}
    scores = {p: -float(len(p) if seed % 2 else k) for k, p in enumerate(sorted(made, key=lambda p: (len(p), r.random())))}
    model = sentence_pieces.Pieces.of([(b"<unk>", 0.0, 2)] + [(p.encode(), s, 1) for p, s in scores.items()], 2)
    words = ["".join(r.choice("aab日c") for _ in range(r.randrange(1, 14))) for _ in range(300)]
    names = [None, *scores]
    want = [[names.index(p) if p in scores else 0 for p in plain_bpe(w, scores)] for w in words]
    want = [[k for j, k in enumerate(x) if k or j == 0 or x[j - 1]] for x in want]
    assert [x.tolist() for x in model.encode([w.encode() for w in words])] == want
    monkeypatch.setattr(sentence_pieces, "_LONG", 0)
    assert [x.tolist() for x in model.encode([w.encode() for w in words])] == want


def test_other_bpe_models_are_refused():
    with pytest.raises(ValueError):  # a part is preferred less than what it forms
        sentence_pieces.Pieces.of([(b"<unk>", 0.0, 2), (b"a", -9.0, 1), (b"ab", -3.0, 1), (b"aba", -2.0, 1)], 2)


def test_long_chunks_encode_alike(monkeypatch):
    model = sentence_pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))
    chunk = (" " + "".join(random.Random(2).choice("theingaorst") for _ in range(150))).encode()
    short = model.packed([chunk])
    monkeypatch.setattr(sentence_pieces, "_LONG", 10)
    assert model.packed([chunk]) == short


def test_equal_chunks_are_told_by_bytes(monkeypatch):
    """Chunks whose hashes collide keep their own ids."""
    from tokenizers import Tokenizer

    from screenforge.llm import textscan

    path, words = tokenizer_path("word_bpe_49k.json"), ["one", "two", "three", "two", "x" * 700, "x" * 699 + "y", "one"]
    monkeypatch.setattr(textscan, "mix", lambda x: x * 0)
    for _, ids, first in encoded(pa.array([" ".join(words)]), ChunkCache(huggingface_encoder(path)), plain_parts):
        assert ids.tolist() == Tokenizer.from_file(path).encode(" ".join(words), add_special_tokens=False).ids
    monkeypatch.undo()
    a, b = "ab", "ba"
    for _ in range(9):
        a, b = a + b, b + a
    raw = np.frombuffer((a + b).encode(), np.uint8)
    assert len(set(textscan.span_hashes(raw, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2


def test_viterbi_on_unigram_pieces():
    r = random.Random(4)
    made = {"a": -2.0, "b": -2.5, "ab": -3.9, "ba": -3.0, "aab": -5.1, " ": -1.0, " a": -2.2, " ab": -4.0, "bb": -4.1}
    model = sentence_pieces.Pieces.of([(b"<unk>", 0.0, 2)] + [(p.replace(" ", "▁").encode(), s, 1) for p, s in made.items()], 1)
    words = [" " + "".join(r.choice("abc") for _ in range(r.randrange(9))) for _ in range(200)]

    def best(word: str) -> float:
        score = [0.0] + [float("-inf")] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                part = made.get(word[s:e], min(made.values()) - 10 if e - s == 1 else float("-inf"))
                score[e] = max(score[e], score[s] + part)
        return score[-1]

    for word, ids in zip(words, model.encode([w.encode() for w in words]), strict=True):
        if "c" not in word:
            assert model.decode(np.append(ids, [])[:].astype(int)).decode() == word[1:]
            assert sum(list(made.values())[i - 1] for i in ids) == pytest.approx(best(word))


def test_edited_counts_equal_full_encoding(texts):
    import tiktoken

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encode = tiktoken.Encoding("plain", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    count, r = token_counts.tiktoken_counter(path, BYTE_PATTERN), random.Random(3)
    for text in texts + ["".join(r.choice(LETTERS) for _ in range(r.randrange(400))) for _ in range(400)]:
        tree = token_counts.SegmentTree(text, count)
        assert tree.tokens == len(encode(text))
        for _ in range(4):
            at, cut, put = r.randrange(len(text) + 2), r.choice([0, 1, 5, 40]), "".join(r.choice(LETTERS) for _ in range(r.choice([0, 1, 3, 200])))
            tree.edit(at, cut, put)
            at = min(at, len(text))
            text = text[:at] + put + text[at + cut :]
            assert (tree.text(), tree.tokens, tree.length) == (text, len(encode(text)), len(text))


def test_edits_touch_little():
    count, calls = token_counts.tiktoken_counter(tokenizer_path("byte_bpe_50k.tiktoken"), BYTE_PATTERN), []

    def counted(segment):
        calls.append(segment)
        return count(segment)

    tree = token_counts.SegmentTree("some words of text " * 5000, counted)
    for at, cut, put in ((40_000, 5, "new"), (50_000, 0, " word" * 200), (50_100, 0, " more" * 3000), (10, 60_000, "")):
        calls.clear()
        before, tree.encoded = tree.segments(), 0
        tree.edit(at, cut, put)
        assert tree.encoded == len(calls) <= put.count(" ") + 6  # what is reported is what was encoded
        assert tree.segments() >= before - 16_000 and tree.tokens == sum(count(x) for block in tree.blocks for x in block)


def test_token_count_query(spark):
    import tiktoken

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encode = tiktoken.Encoding("plain", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    rows = brute.documents() + [(None, "no id here", None, None, 0), (20_000, "twice", None, None, 0), (20_000, "twice", None, None, 0)]
    df = spark.createDataFrame(rows, brute.SCHEMA).withColumns({"edits": F.lit("clash"), "n_tokens": F.lit("clash")})
    query = lambda docs: token_counts.edited_counts(docs, token_counts.sample_edits(), path, BYTE_PATTERN)
    want = []
    for i, text, *_ in rows:
        t = text or ""
        tree = token_counts.SegmentTree(t, lambda x: 0)
        whole, third, half, last, start = t, len(t) // 3, len(t) // 2, max(len(t) - 8, 0), t[:8]
        for at, cut, put in ((third, 0, " edited"), (half, 16, ""), (last, 8, start)):
            tree.edit(at, cut, put)
            at = min(at, len(t))
            t = t[:at] + put + t[at + cut :]
        want.append((i, len(encode(whole)), len(encode(t)), len(t), tree.encoded, brute.sha(t)))
    got = [(r.doc_id, r.n_tokens, r.edited_tokens, r.edited_chars, r.n_reencoded, r.edited_sha256) for r in query(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert query(df.limit(0)).collect() == []


@pytest.mark.parametrize("weights", [None, {"s0": 3, "s1": 1, "s2": 1}, {"s1": 1}])
def test_packing_places_every_id_once(weights, spark):
    from tokenizers import Tokenizer

    rows = brute.documents()
    df = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    path = tokenizer_path("word_bpe_49k.json")
    plain, size = Tokenizer.from_file(path), 256
    ids = {i: plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t, *_ in rows}
    got = packing.packed(df, path, size=size, weights=weights).collect()
    by_doc: dict[int, list] = {}
    by_sequence: dict[int, list] = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i]) and r.ids_crc32 == brute.crc(ids[i][at : at + r.length])
            at += r.length
        assert at == len(ids[i])
    lengths = {}
    for s, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths[s] = at
    short = [n for n in lengths.values() if n != size]
    assert sorted(lengths) == list(range(len(lengths))) and all(n & (n - 1) == 0 and n < size for n in short) and len(set(short)) == len(short)
    if weights is None:  # every full sequence has its share of each source, but for a few ids
        source = {i: s for i, _, _, s, _ in rows}
        total = sum(map(len, ids.values()))
        for s, pieces in by_sequence.items():
            if lengths[s] == size:
                for name in set(source.values()):
                    share = sum(len(x) for i, x in ids.items() if source[i] == name) / total
                    assert abs(sum(r.length for r in pieces if source[r.doc_id] == name) - share * size) <= 8


def test_packing_keeps_a_queue_for_each_of_many_sources(spark):
    path, size = tokenizer_path("word_bpe_49k.json"), 64
    rows = [(k, "the cat " * 20, None, f"s{k % 1500}" if k % 1500 else None, 0) for k in range(3000)]
    rows += [(3000 + k, "the cat " * 200, None, "named", 0) for k in range(100)]
    got = packing.packed(spark.createDataFrame(rows, brute.SCHEMA).repartition(3), path, size=size, weights={"named": 3, "s1": 1}).collect()
    by_doc, first = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        first[r.sequence_id] = first.get(r.sequence_id, 0) + (r.doc_id >= 3000) * r.length
    assert set(by_doc) == {r[0] for r in rows} and all(sum(x.length for x in p) == p[0].doc_tokens for p in by_doc.values())
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert all(b[1] == a[1] + a[2] if a[0] == b[0] else b[1] == 0 for a, b in zip(places, places[1:]))
    assert abs(first[0] - 48) <= 4  # three parts named, one part s1, nothing of others yet
    assert all(r.doc_id >= 3000 or r.doc_id % 1500 == 1 for r in got if r.sequence_id < 4)
    natural = packing.packed(spark.createDataFrame(rows, brute.SCHEMA).repartition(3), path, size=size).collect()
    share = sum(p[0].doc_tokens for i, p in by_doc.items() if i >= 3000) / sum(p[0].doc_tokens for p in by_doc.values())
    named = {}
    for r in natural:
        named[r.sequence_id] = named.get(r.sequence_id, 0) + (r.doc_id >= 3000) * r.length
    assert all(abs(n - share * size) <= 8 for s, n in named.items() if s < len(named) - 8)


def test_packing_edge_tables(spark):
    path = tokenizer_path("word_bpe_49k.json")
    assert packing.packed(spark.createDataFrame([], brute.SCHEMA), path).collect() == []
    one = packing.packed(spark.createDataFrame([(1, None, None, None, 0)], brute.SCHEMA).withColumn("block", F.lit(3)), path).collect()
    assert [(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in one] == [(1, 0, 1, 0, 0)]


def test_pieces_query(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = brute.documents() + [(None, "no id here", None, None, 0), (20_000, "twice", None, None, 0), (20_000, "twice", None, None, 0)]
    df = spark.createDataFrame(rows, brute.SCHEMA).withColumns({"ids": F.lit("clash"), "same": F.lit("clash")})
    got = sentence_pieces.pieces(df, path).collect()
    want = [(i, len(ids), brute.crc(ids), brute.sha(t or ""), True, ids) for i, t, *_ in rows for ids in [plain.encode(t or "")]]
    assert sorted(((r.doc_id, r.n_pieces, r.ids_crc32, r.decoded_sha256, r.same, r.ids) for r in got), key=str) == sorted(want, key=str)
    assert sentence_pieces.pieces(df.limit(0), path).collect() == []


def test_packing_repeats_null_ids_and_long_texts(spark):
    from tokenizers import Tokenizer

    path, long = tokenizer_path("word_bpe_49k.json"), "a long text " * 30_000
    rows = [(None, "no id", None, "s", 0), (5, "twice", None, "s", 0), (5, "twice", None, "s", 0), (7, long, None, None, 0)]
    df = spark.createDataFrame(rows, brute.SCHEMA).withColumns({c: F.lit("clash") for c in ("queue", "before", "base", "__queue", "start")})
    got = packing.packed(df, path).collect()
    n = {t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) + 1 for t in ("no id", "twice", long)}
    held = {}
    for r in got:
        held[r.doc_id] = held.get(r.doc_id, 0) + r.length
    assert held == {None: n["no id"], 5: 2 * n["twice"], 7: n[long]}
