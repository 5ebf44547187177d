"""Substring dedup by repeated-phrase automata.

A window is WINDOW consecutive words.  Each word that a window covers is removed if the window's word sequence also
starts earlier: in a document with a smaller doc_id, or earlier in the same one.

1. Anchors.  Every window has one anchor: its smallest-hashed 8-word phrase, leftmost among ties.  Equal windows have
   equal anchors.  Each task merges its own anchors, so an anchor goes once per task to the owner of its hash range;
   anchors seen twice within a task are known to recur.  The most frequent anchors (at most MOST_HOT) are broadcast.
2. Contexts.  Documents with recurring anchors (found through a bounded filter and a join) send, for each of them,
   the words of the windows that it anchors, to the anchor's shard.  Of the most frequent anchors each window goes by
   itself, to the shard of its own words, so that no shard gathers all contexts of a common passage.  Equal contexts of a
   batch merge into their first occurrence.
3. Automata.  Each shard confirms which windows recur, compiles them into an Aho-Corasick automaton over word numbers
   (words are told apart by their bytes), and streams its contexts through it, which locates every occurrence of every
   confirmed window; all but the first are removed.
4. Documents without removals pass straight through; the others meet their removals in a join.

Exact copies of a whole text are settled first: in all but the first, every window started earlier.

Defined results: null text has no words; rows with a null doc_id are neither changed nor compared; rows with equal doc_id
and text are one document, rows with equal doc_id and other texts are documents of their own, in order of their texts'
hashes; an empty table gives no rows; very long texts take part whole, in slices; other columns are ignored or kept,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom, bucket_bits, discard, durable, fits, fresh, held_rows, only_keys, record, small, tidy, whole_text
from .textscan import column_bytes, distinct_spans, gram_hashes, slices, word_hashes, word_spans

WINDOW = 20
PHRASE = 8
_REACH = WINDOW - PHRASE + 1  # phrases in a window
_FLUSH = 300_000
#: An anchor with so many occurrences may be among the most frequent; so many are held by the driver and each worker.
HOT_FROM, MOST_HOT = 1000, 1 << 16

_ANCHORS = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("h", pa.binary()), ("row", pa.binary()), ("pos", pa.binary()), ("many", pa.binary()), ("times", pa.binary()), ("ids", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))])
_ANCHORS_SQL = "bucket int, kind byte, h binary, row binary, pos binary, many binary, times binary, ids array<long>, marks array<long>"
_AT = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("at", pa.binary()), ("hot", pa.int64()), ("times", pa.int64())])
_AT_SQL = "doc_id long, mark long, at binary, hot long, times long"
_CONTEXTS = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("words", pa.binary()), ("at", pa.binary())])
_CONTEXTS_SQL = "shard int, doc_id long, mark long, start long, words binary, at binary"
_GONE = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("at", pa.binary())])


def _anchor_of_windows(column: pa.Array) -> Iterator[tuple]:
    """For slices of the column: (row of its start, bytes, word starts, word ends, word hashes, first words, rows of words,
    phrase hashes, window starts, anchors)."""
    for a, b in slices(column, 1 << 20):
        raw, offsets = column_bytes(column.slice(a, b - a))
        starts, ends, first = word_spans(raw, offsets)
        size = len(starts) - WINDOW + 1
        if size <= 0:
            continue
        words = word_hashes(raw, starts, ends, False)
        grams = gram_hashes(words, PHRASE)
        best, width = np.arange(len(grams)), 1
        while 2 * width <= _REACH:  # best[i]: leftmost smallest of grams[i : i + width]
            left, right = best[:-width], best[width:]
            best, width = np.where(grams[right] < grams[left], right, left), 2 * width
        left, right = best[:size], best[_REACH - width : _REACH - width + size]
        best = np.where(grams[right] < grams[left], right, left)
        row = np.repeat(np.arange(b - a), np.diff(first))
        windows = np.flatnonzero(row[:size] == row[WINDOW - 1 : WINDOW - 1 + size])
        yield a, raw, starts, ends, words, first, row, grams, windows, best[windows]


def _by_document(doc: np.ndarray, mark: np.ndarray, at: np.ndarray) -> tuple[list, list, list]:
    """(doc_ids, marks, packed positions), a row a document."""
    order = np.lexsort((mark, doc))
    doc, mark, at = doc[order], mark[order], at[order].astype("<u4")
    edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]), True]) if len(doc) else np.zeros(1, np.int64)
    parts = [at[s:e].tobytes() for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return doc[edges[:-1]].tolist(), mark[edges[:-1]].tolist(), parts


def recurring_anchors(docs: DataFrame, bits: int) -> DataFrame:
    """Rows of _AT: word positions, as packed 32-bit numbers, of anchors that occur twice or more, several rows a document;
    and the hashes of anchors with HOT_FROM occurrences or more.  docs: doc_id, text, mark."""

    def emit(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, rows, places, ids, marks = [], [], [], [], []
        turn = TaskContext.get().partitionId() << 3  # what needs no owner is dealt to all buckets in turn

        def flush() -> pa.RecordBatch:
            nonlocal turn
            h, row, place = (np.concatenate(x) for x in (hs, rows, places))
            doc, mark = np.concatenate(ids), np.concatenate(marks)
            order = np.argsort(h, kind="stable")
            h, row, place = h[order], row[order], place[order]
            lead = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            times = np.diff(np.append(lead, len(h)))
            out: dict[str, list] = {f.name: [] for f in _ANCHORS}

            def add(bucket: int, kind: int, h, part, many, times) -> None:
                used, index = np.unique(row[part], return_inverse=True)
                values = bucket, kind, h.tobytes(), index.astype("<u4").tobytes(), place[part].astype("<u4").tobytes(), many.tobytes(), times.astype("<u4").tobytes(), doc[used], mark[used]
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)

            bucket = (h[lead] >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                once = times[s:e] == 1
                single = lead[s:e][once]
                add(int(bucket[s]), 0, h[single], single, h[lead[s:e][~once]], times[s:e][~once])
            many = np.flatnonzero(np.repeat(times > 1, times))
            none, parts = np.zeros(0, np.uint64), 1 << min(bits, 3)
            for k, part in enumerate(np.array_split(many, parts)):
                if len(part):
                    add(k + turn & (1 << bits) - 1, 1, none, part, none, none)
            turn += parts
            for held in (hs, rows, places, ids, marks):
                held.clear()
            return record(out, _ANCHORS)

        count, seen = 0, 0
        for batch in stream:
            for a, _, _, _, _, first, row, grams, _, best in _anchor_of_windows(batch.column(1)):
                chosen = np.flatnonzero(np.bincount(best, minlength=1))
                hs.append(grams[chosen])
                rows.append(row[chosen] + (a + seen))
                places.append(chosen - first[row[chosen]])
                count += len(chosen)
            ids.append(batch.column(0).to_numpy())
            marks.append(batch.column(2).to_numpy())
            seen += batch.num_rows
            if count >= _FLUSH:
                yield flush()
                count = seen = 0
            tidy()
        if count:
            yield flush()
        tidy()

    def owner(table: pa.Table) -> pa.Table:
        blob = lambda row, name, kind: np.frombuffer(table.column(name)[row].as_buffer(), kind)
        hs, found, many, times, known = [], [], [], [], []
        for k, kind in enumerate(table.column("kind").to_pylist()):
            row = blob(k, "row", "<u4")
            here = tuple(table.column(c)[k].values.to_numpy()[row] for c in ("ids", "marks")) + (blob(k, "pos", "<u4"),)
            if kind:
                known.append(here)
            else:
                hs.append(blob(k, "h", "<u8"))
                found.append(here)
                many.append(blob(k, "many", "<u8"))
                times.append(blob(k, "times", "<u4"))
        hot, often = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if hs:
            h = np.concatenate(hs)
            values, place = np.unique(np.concatenate([h, *many]), return_inverse=True)
            total = np.bincount(place, np.concatenate([np.ones(len(h)), *times]), len(values)).astype(np.int64)
            again = total[place[: len(h)]] > 1
            known.append(tuple(np.concatenate(x)[again] for x in zip(*found, strict=True)))
            hot, often = values[total >= HOT_FROM].view(np.int64), total[total >= HOT_FROM]
            del h, values, place, total, again
        hs.clear(), found.clear(), many.clear(), times.clear()
        docs_, marks, ats = _by_document(*(np.concatenate(x) for x in zip(*known, strict=True)))
        del known
        tidy()
        none, nothing = [None] * len(docs_), [None] * len(hot)
        return pa.table({"doc_id": docs_ + nothing, "mark": marks + nothing, "at": ats + nothing, "hot": none + hot.tolist(), "times": none + often.tolist()}, _AT)

    return docs.mapInArrow(emit, _ANCHORS_SQL).groupBy("bucket").applyInArrow(owner, _AT_SQL)


def _contexts(shards: int, frequent):
    """The contexts of recurring anchors; equal ones of a batch leave their first occurrence and, as removals, the others.
    Columns: doc_id, text, mark, at.  frequent: broadcast hashes of the most frequent anchors, sorted."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value
        for batch in stream:
            doc, mark = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            blobs = batch.column(3)
            first_of: dict[bytes, tuple] = {}
            late: list[tuple] = []
            for a, raw, starts, ends, words, first, row, grams, windows, best in _anchor_of_windows(batch.column(1)):
                hit = np.zeros(len(grams), bool)
                for k in range(len(first) - 1):
                    if first[k + 1] > first[k]:
                        at = np.concatenate([np.frombuffer(x, "<u4") for x in blobs[a + k].as_py()]).astype(np.int64) + first[k]
                        hit[at[at < min(first[k + 1], len(hit))]] = True
                mine = hit[best]
                windows, best = windows[mine], best[mine]
                if not len(windows):
                    continue
                anchor = grams[best]
                alone = np.zeros(len(anchor), bool)
                if len(hot):
                    alone = hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor
                # A run of windows with one anchor goes together, unless the anchor is among the most frequent.
                lead = np.flatnonzero(np.r_[True, (best[1:] != best[:-1]) | alone[1:]])
                to = anchor[lead]
                if alone.any():
                    to[alone[lead]] = gram_hashes(words, WINDOW)[windows[lead][alone[lead]]]
                whole = raw.tobytes()
                low, high = windows[lead], windows[np.append(lead[1:], len(windows)) - 1]
                for s, e, x, y, r, h in zip(low.tolist(), high.tolist(), starts[low].tolist(), ends[high + WINDOW - 1].tolist(), row[low].tolist(), to.tolist(), strict=True):
                    text = whole[x:y]
                    here = (int(doc[a + r]), int(mark[a + r]), int(s - first[r]), e - s + 1, h)
                    there = first_of.get(text)
                    if there is None or here < there:
                        first_of[text] = here
                        here = there
                    if here is not None and here[:3] != first_of[text][:3]:
                        late.append(here)
            if first_of:
                columns = list(zip(*first_of.values(), strict=True))
                yield record(
                    {"shard": [h % shards for h in columns[4]], "doc_id": columns[0], "mark": columns[1], "start": columns[2], "words": list(first_of), "at": pa.nulls(len(first_of), pa.binary())},
                    _CONTEXTS,
                )
            if late:
                doc, mark, start, size, _ = (np.array(x, np.int64) for x in zip(*((*x[:4], 0) for x in late), strict=True))
                at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
                docs_, marks, ats = _by_document(np.repeat(doc, size), np.repeat(mark, size), at)
                none = pa.nulls(len(docs_), pa.int64())
                yield record({"shard": [x % shards for x in docs_], "doc_id": docs_, "mark": marks, "start": none, "words": pa.nulls(len(docs_), pa.binary()), "at": ats}, _CONTEXTS)
            del first_of, late
            tidy()

    return run


def _locate(table: pa.Table) -> pa.Table:
    """The starts, by document, of windows that are not the first of their kind; one shard."""
    passed = table.filter(table.column("at").is_valid())
    table = table.filter(table.column("words").is_valid())
    index: dict[bytes, int] = {}
    which = np.array([index.setdefault(words, len(index)) for words in table.column("words").to_pylist()], np.int64)
    times = np.bincount(which, minlength=len(index))
    # Windows of distinct contexts; those that come twice or more are compiled.
    raw, offsets = column_bytes(pa.array(list(index), pa.binary()))
    starts, ends, first = word_spans(raw, offsets)
    numbers = distinct_spans(raw, starts, ends)[1] if len(starts) else np.zeros(0, np.int64)
    size = max(0, len(starts) - WINDOW + 1)
    row = np.repeat(np.arange(len(index)), np.diff(first))
    windows = np.flatnonzero(row[:size] == row[WINDOW - 1 : WINDOW - 1 + size])
    _, lead, kind = np.unique(gram_hashes(numbers.astype(np.uint64), WINDOW)[windows], return_index=True, return_inverse=True)
    again = np.bincount(kind, times[row[windows]], minlength=len(lead)) > 1
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, at in zip(np.flatnonzero(again).tolist(), windows[lead[again]].tolist(), strict=True):
        automaton.add_word(tuple(numbers[at : at + WINDOW].tolist()), k)
    streamed = np.unique(row[windows[again[kind]]]).tolist()
    docs_, marks, ats = (passed.column(c).to_pylist() for c in ("doc_id", "mark", "at"))
    if len(automaton):
        automaton.make_automaton()
        pattern, context_of, offset = [], [], []
        for k in streamed:
            for end, value in automaton.iter(tuple(numbers[first[k] : first[k + 1]].tolist())):
                pattern.append(value)
                context_of.append(k)
                offset.append(end - WINDOW + 1)
        pattern, context_of, offset = (np.array(x, np.int64) for x in (pattern, context_of, offset))
        order = np.argsort(which, kind="stable")
        begin = np.searchsorted(which[order], np.arange(len(index)))
        count = times[context_of]
        row = order[np.repeat(begin[context_of] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        doc, mark = (table.column(c).to_numpy()[row] for c in ("doc_id", "mark"))
        start = table.column("start").to_numpy()[row] + np.repeat(offset, count)
        pattern = np.repeat(pattern, count)
        order = np.lexsort((start, mark, doc, pattern))
        pattern, doc, mark, start = pattern[order], doc[order], mark[order], start[order]
        lead = np.flatnonzero(np.r_[True, pattern[1:] != pattern[:-1]])
        lead = np.repeat(lead, np.diff(np.append(lead, len(pattern))))
        late = (doc != doc[lead]) | (mark != mark[lead]) | (start != start[lead])
        found = _by_document(doc[late], mark[late], start[late])
        docs_, marks, ats = docs_ + found[0], marks + found[1], ats + found[2]
        del pattern, doc, mark, start, order, row, count, late, lead, found
    del automaton, index, raw, numbers, kind
    tidy()
    return pa.table({"doc_id": docs_, "mark": marks, "at": ats}, _GONE)


def _covered(size: int, blobs: list[bytes] | None, whole: bool | None) -> np.ndarray:
    """Which of a document's words are removed."""
    if whole and size >= WINDOW:
        return np.ones(size, bool)
    steps = np.zeros(size + WINDOW + 1, np.int64)
    for blob in blobs or ():
        at = np.frombuffer(blob, "<u4").astype(np.int64)
        at = at[at + WINDOW <= size]
        np.add.at(steps, at, 1)
        np.add.at(steps, at + WINDOW, -1)
    return np.cumsum(steps)[:size] > 0


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, mark (of the text), at (lists of packed window starts), whole (all windows): documents of which something is removed."""
    bits = bucket_bits(docs, 6 << 20)
    shards = 1 << bucket_bits(docs, 2 << 20, most=26)
    text = whole_text(docs.select("doc_id", "text")).where("doc_id is not null").withColumn("mark", F.xxhash64("text"))
    digest = text.select("doc_id", "mark", F.md5("text").alias("digest"), F.length("text").alias("size"))
    leads = durable(digest.groupBy("digest", "size").agg(F.min("doc_id").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n"))
    copies = durable(digest.join(small(leads, 150), ["digest", "size"]).where("doc_id > lead").select("doc_id", "mark").distinct())

    found = durable(recurring_anchors(text, bits))
    hot = found.where("hot is not null").orderBy(F.desc("times"), "hot").limit(MOST_HOT).select("hot").toArrow().column(0).to_numpy()
    hot = docs.sparkSession.sparkContext.broadcast(np.sort(hot.astype(np.int64).view(np.uint64)))
    anchors = found.where("doc_id is not null").join(copies, ["doc_id", "mark"], "left_anti")
    anchors = durable(anchors.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("at")))
    # A join with a shuffle parts the filter's Python workers from those of the next step; else an executor holds twice as many.
    some = text.join(F.broadcast(anchors), ["doc_id", "mark"]) if fits(anchors) else only_keys(text, "doc_id", bloom(anchors, "doc_id")).join(anchors.hint("merge"), ["doc_id", "mark"])
    some = some.select("doc_id", "text", "mark", "at")
    contexts = some.mapInArrow(_contexts(shards, hot), _CONTEXTS_SQL)
    gone = contexts.groupBy("shard").applyInArrow(_locate, "doc_id long, mark long, at binary")
    gone = gone.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("at")).withColumn("whole", F.lit(False))
    out = durable(gone.unionByName(copies.select("doc_id", "mark", F.expr("cast(null as array<binary>)").alias("at"), F.lit(True).alias("whole"))))
    discard(leads, copies, found, anchors)
    return out


def _joined(docs: DataFrame, function, schema: str) -> DataFrame:
    """function over docs with the removals of each document as its last two columns."""
    mark, at, whole = (fresh(docs, x) for x in ("mark", "at", "whole"))
    gone = removals(docs)
    few, field = fits(gone), None
    if not few:
        field = bloom(gone, "doc_id")
    gone = gone.select("doc_id", F.col("mark").alias(mark), F.col("at").alias(at), F.col("whole").alias(whole))
    maybe = only_keys(docs, "doc_id", field).withColumn(mark, F.xxhash64("text"))
    joined = maybe.join(F.broadcast(gone) if few else gone.hint("merge"), ["doc_id", mark], "left")
    out = joined.select(*docs.columns, at, whole).mapInArrow(function, schema)
    if field is None:
        return out
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def untouched(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """function over rows that surely lose nothing."""

        def marked() -> Iterator[pa.RecordBatch]:
            for batch in held_rows(stream, "doc_id", shared.value, False):
                n = batch.num_rows
                names = [*batch.schema.names, at, whole]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(n, pa.list_(pa.binary())), pa.array(np.zeros(n, bool))], names=names)

        return function(marked())

    return out.union(docs.mapInArrow(untouched, schema))


def repeated_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def finish(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text, at, whole in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), strict=True):
                words = text.as_buffer().to_pybytes().split()
                size, at, whole = len(words), at.as_py(), whole.as_py()
                if at or whole:
                    gone = _covered(size, at, whole)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out["doc_id"].append(doc_id)
                out["n_words"].append(size)
                out["n_removed"].append(size - len(words))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield record(out, schema)
            tidy()

    return _joined(whole_text(docs.select("doc_id", "text")), finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated words cut out of their texts (what stays keeps its white space); documents left without a word go.

    Columns are unchanged; n_chars, where there is one, is set anew.
    """
    columns = docs.columns
    place = columns.index("text")

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = []
            for text, at, whole in zip(batch.column(place), batch.column(len(columns)), batch.column(len(columns) + 1), strict=True):
                at, whole = at.as_py(), whole.as_py()
                if not at and not whole:
                    texts.append(text.as_py())
                    continue
                raw = text.as_buffer().to_pybytes()
                starts, ends, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                gone = _covered(len(starts), at, whole)
                if not gone.any():
                    texts.append(text.as_py())
                    continue
                if gone.all():
                    texts.append(None)
                    continue
                edges = np.flatnonzero(np.diff(np.r_[False, ~gone, False].astype(np.int8)))
                texts.append("\n".join(raw[starts[s] : ends[e - 1]].decode() for s, e in zip(edges[::2], edges[1::2], strict=True)))
            arrays = list(batch.columns[: len(columns)])
            arrays[place] = pa.array(texts, batch.schema.field(place).type)
            kept = pa.RecordBatch.from_arrays(arrays, schema=pa.schema([batch.schema.field(k) for k in range(len(columns))]))
            yield kept.filter(kept.column(place).is_valid())
            del texts, arrays, kept
            tidy()

    out = _joined(whole_text(docs), cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
