"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. Frequencies.  Every task merges the n-gram hashes of its documents and sends them, packed, to the owner of
   their hash range, which adds them up over all documents.  The most frequent ones (at most HOT_MOST, a bounded
   table) are broadcast with their rank; all others count as rare.
2. Prefixes.  A document's n-grams are ordered rare first: rare ones by hash, then frequent ones by frequency.
   Any two documents that link share one of their first n - ceil(t n) + 1.  Only those are sent out; lists of rare
   n-grams with one set end at their owner, lists of frequent ones are never gathered in one place.  Equal sets share one
   key, so copies collapse into one entry.
3. Candidates.  Length and positional filter discard pairs within a list.  In the first rounds a list is compared with a
   few of its members only: the one with the fewest rarer n-grams (in a cloud of near copies, the one they come from),
   and those of best priority, where a set's priority is the same in all lists, so that the same pairs come from all of
   them.  What links is contracted.  The last round compares all that is still in different components of a list, leaving
   out pairs within the list's largest one, and asks the suffix filter (a lower bound of the Hamming distance from counts
   modulo four in SUFFIX_PARTS partitions) before it writes a pair; so no possible link is skipped.
4. Verification.  Each remaining pair is verified once on the full sets.

Defined results: null or wordless texts have no n-grams and link with nothing; equal sets always link; rows with a null
doc_id link with nothing and have no component; rows that share a doc_id are texts of their own, each with its links (of
equal smallest ids in a component, the text with the smallest hash is the one that stays); an empty table gives no rows;
very long texts take part whole; other columns are ignored or kept, whatever their names.  Hashes have 64 bits: two
different n-grams, or two different sets of the same size, are taken for equal with a probability of 2**-64 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom, bucket_bits, components, discard, durable, fresh, only_keys, record, small, split_by_keys, tidy, whole_text
from .textscan import shingle_sets

#: An n-gram in at least so many documents may enter the table of frequent ones.
HOT_FROM = 8
#: Size of that table (12 bytes an entry).
HOT_MOST = 1 << 20
#: Partitions of the hash space that the suffix filter counts.
SUFFIX_PARTS = 512
_WORDS = SUFFIX_PARTS // 32  # 64-bit words of two bits a partition
#: Members of each list that all others are compared with, by round.
LEADERS = (2, 3)
#: A list with more entries is cut into parts of about so many, each with leaders of its own.
MOST_ENTRIES = 100_000
_FLUSH = 300_000

_FREQ = pa.schema([("bucket", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])
_PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()), ("ids", pa.list_(pa.int64()))])
_ROWS = pa.schema([("kind", pa.int8()), ("h", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("sig", pa.list_(pa.int64()))])
_ROWS_SQL = "kind byte, h long, key long, n long, pos int, doc_id long, mark long, sig array<long>"
_ENTRY, _DOCUMENT, _HOT_ENTRY = 0, 1, 2
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text's mark, by which rows that share a doc_id are told apart."""
    return whole_text(docs.select("doc_id", "text")).withColumn("mark", F.xxhash64("text"))


def _by_bucket(values: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Ranges of the sorted values that fall to each bucket."""
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, np.int64)
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(bucket[s]), slice(s, e)


def _signature(one: np.ndarray) -> np.ndarray:
    """Counts by partition modulo four, in Gray code: the bits in which two differ are at most the elements in which the sets do."""
    count = np.bincount((one & np.uint64(SUFFIX_PARTS - 1)).astype(np.int64), minlength=SUFFIX_PARTS)
    return np.packbits(np.concatenate([(count >> 1) & 1, ((count + 1) >> 1) & 1]).astype(bool)).view("<i8")


def _identity(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket bits and the 32 bits below them."""
    return (hashes >> np.uint64(32 - bits)).astype(np.int64)


def frequent(docs: DataFrame, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(identities sorted, ranks from 1) of the most frequent n-grams."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            rows = [(k, values[s], counts[s]) for k, s in _by_bucket(values, bits)]
            return record(
                {
                    "bucket": [r[0] for r in rows],
                    "ids": [(_identity(r[1], bits) & 0xFFFFFFFF).astype("<u4").tobytes() for r in rows],
                    "counts": [r[2].astype("<u4").tobytes() for r in rows],
                },
                _FREQ,
            )

        size = 0
        for batch in stream:
            for one in shingle_sets(batch.column(1), n):
                if one.size:
                    held.append(one)
                    size += one.size
                if size >= _FLUSH:
                    yield flush()
                    size = 0
            tidy()
        if held:
            yield flush()
        tidy()

    def total(table: pa.Table) -> pa.Table:
        ids = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("ids")])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("counts")])
        order = np.argsort(ids, kind="stable")
        ids, counts = ids[order], counts[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        sums = np.add.reduceat(counts, starts)
        hot = sums >= HOT_FROM
        bucket = table.column("bucket")[0].as_py()
        del order, counts
        tidy()
        return pa.table({"id": ids[starts][hot].astype(np.int64) | (bucket << 32), "df": sums[hot]})

    counts = _texts(docs).select("doc_id", "text").mapInArrow(count, "bucket int, ids binary, counts binary").groupBy("bucket").applyInArrow(total, "id long, df long")
    top = counts.orderBy(F.desc("df"), "id").limit(HOT_MOST).toArrow()
    ids, df = top.column("id").to_numpy(), top.column("df").to_numpy()
    order = np.lexsort((ids, df))
    rank = np.empty(len(ids), np.int32)
    rank[order] = np.arange(1, len(ids) + 1)
    by_id = np.argsort(ids)
    return ids[by_id], rank[by_id]


def _least(percent: int, n):
    """Least overlap that a set of n needs."""
    return -(-percent * n // 100)


def prefix_rows(docs: DataFrame, n: int, percent: int, bits: int) -> DataFrame:
    """Entries of lists of rare n-grams with two sets or more, all entries of lists of frequent ones (with repeats), and every
    document with its key, size and signature; by kind."""
    ids, rank = frequent(docs, n, bits)
    hot = docs.sparkSession.sparkContext.broadcast((ids, rank))

    def emit(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_ids, hot_rank = hot.value
        turn = TaskContext.get().partitionId() << 4  # what needs no owner is dealt to all buckets in turn
        hs, owners, places, often, keys, sizes, marks, sigs, docs_ = [], [], [], [], [], [], [], [], []
        def flush() -> pa.RecordBatch:
            nonlocal turn
            key, size = np.array(keys, np.int64), np.array(sizes, np.int64)
            h, owner, place, known = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hs, np.uint64), (owners, np.int64), (places, np.int32), (often, bool)))
            order = np.lexsort((key[owner], h))
            h, owner, place, known = h[order], owner[order], place[order], known[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (key[owner[1:]] != key[owner[:-1]])
            out: dict[str, list] = {f.name: [] for f in _PACKED}

            def add(*values) -> None:
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)

            def entries(bucket: int, kind: int, h: np.ndarray, owner: np.ndarray, place: np.ndarray) -> None:
                used, index = np.unique(owner, return_inverse=True)
                add(bucket, kind, h.tobytes(), index.astype("<u4").tobytes(), place.astype("<u4").tobytes(), np.stack([key[used], size[used]]).tobytes(), None)

            rare = np.flatnonzero(new & ~known)
            for k, s in _by_bucket(h[rare], bits):
                entries(k, _ENTRY, h[rare[s]], owner[rare[s]], place[rare[s]])
            frequent_ones = np.flatnonzero(new & known)
            parts, mask = 1 << min(bits, 4), (1 << bits) - 1
            for k, part in enumerate(np.array_split(frequent_ones, parts)):
                if len(part):
                    entries((k + turn) & mask, _HOT_ENTRY, h[part], owner[part], place[part])
            step = max(1, len(keys) // parts)
            for k, s in enumerate(range(0, len(keys), step)):
                t = slice(s, s + step)
                add((k + turn) & mask, _DOCUMENT, key[t].tobytes(), size[t].tobytes(), b"".join(sigs[t]), np.array(marks[t], np.int64).tobytes(), docs_[t])
            turn += parts
            for held in (hs, owners, places, often, keys, sizes, marks, sigs, docs_):
                held.clear()
            return record(out, _PACKED)

        entries_held = 0
        for batch in stream:
            for doc_id, mark, one in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), shingle_sets(batch.column(1), n), strict=True):
                size = one.size
                if size and doc_id is not None:
                    upto = size - _least(percent, size) + 1
                    at = np.searchsorted(hot_ids, identity := _identity(one, bits))
                    at[at == len(hot_ids)] = 0
                    known = hot_ids[at] == identity if len(hot_ids) else np.zeros(size, bool)
                    chosen = np.argsort(np.where(known, hot_rank[at], 0), kind="stable")[:upto] if known.any() else np.arange(upto)
                    hs.append(one[chosen])
                    often.append(known[chosen])
                    owners.append(np.full(upto, len(keys)))
                    places.append(np.arange(upto, dtype=np.int32))
                    entries_held += upto
                keys.append(int.from_bytes(hashlib.blake2b(one.tobytes(), digest_size=8).digest(), "little", signed=True))
                sizes.append(size)
                marks.append(mark)
                docs_.append(doc_id)
                sigs.append(_signature(one).tobytes())
                if entries_held >= _FLUSH or len(keys) >= 50_000:
                    yield flush()
                    entries_held = 0
            tidy()
        if keys:
            yield flush()
        tidy()

    def lists(table: pa.Table) -> pa.Table:
        out = []
        kinds = table.column("kind").to_numpy()
        blob = lambda row, name, kind: np.frombuffer(table.column(name)[row].as_buffer(), kind)

        def entries(kind: int, h: np.ndarray, key: np.ndarray, size: np.ndarray, place: np.ndarray) -> None:
            none = pa.nulls(len(h), pa.int64())
            out.append(record({"kind": np.full(len(h), kind, np.int8), "h": h.view(np.int64), "key": key, "n": size, "pos": place.astype(np.int32), "doc_id": none, "mark": none, "sig": pa.nulls(len(h), pa.list_(pa.int64()))}, _ROWS))

        def unpacked(row: int) -> tuple:
            owner, pair = blob(row, "b", "<u4"), blob(row, "d", "<i8").reshape(2, -1)
            return blob(row, "a", "<u8"), pair[0][owner], pair[1][owner], blob(row, "c", "<u4")

        rare = [unpacked(row) for row in np.flatnonzero(kinds == _ENTRY)]
        if rare:
            h, key, size, place = (np.concatenate(x) for x in zip(*rare, strict=True))
            order = np.lexsort((key, h))
            h, key, size, place = h[order], key[order], size[order], place[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
            h, key, size, place = h[new], key[new], size[new], place[new]
            same = h[1:] == h[:-1]
            shared = np.r_[False, same] | np.r_[same, False]
            entries(_ENTRY, h[shared], key[shared], size[shared], place[shared])
            del rare, h, key, size, place, order, new, same, shared
        for row in np.flatnonzero(kinds == _HOT_ENTRY):
            entries(_HOT_ENTRY, *unpacked(row))
        for row in np.flatnonzero(kinds == _DOCUMENT):
            key = blob(row, "a", "<i8")
            none = pa.nulls(len(key), pa.int64())
            sig = pa.ListArray.from_arrays(np.arange(0, _WORDS * len(key) + 1, _WORDS, dtype=np.int32), blob(row, "c", "<i8"))
            out.append(record({"kind": np.full(len(key), _DOCUMENT, np.int8), "h": none, "key": key, "n": blob(row, "b", "<i8"), "pos": pa.nulls(len(key), pa.int32()), "doc_id": table.column("ids")[row].as_py(), "mark": blob(row, "d", "<i8"), "sig": sig}, _ROWS))
        tidy()
        return pa.Table.from_batches(out, _ROWS)

    packed = _texts(docs).select("doc_id", "text", "mark").mapInArrow(emit, "bucket int, kind byte, a binary, b binary, c binary, d binary, ids array<long>")
    return packed.groupBy("bucket").applyInArrow(lists, _ROWS_SQL)


def _apart(x: str, y: str) -> str:
    """SQL for the bits in which two signatures differ."""
    return " + ".join(f"bit_count(get({x}, {k}) ^ get({y}, {k}))" for k in range(_WORDS))


def _least_sql(n: str, m: str, percent: int) -> str:
    """SQL for the least overlap that sets of n and m need."""
    return f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"


def _stars(entries: DataFrame, percent: int, around: int, leaders: int) -> DataFrame:
    """(a, b): sets of each list (h, key, n, pos, comp) with its leaders of other components; around: the round.

    A list comes in one piece, its leaders first, and passes by row after row: nothing of it is held but the leaders.
    Long lists are cut into parts by hashes of their sets; the first leaders of the parts make up a list in turn.
    """
    entries = entries.select("h", "key", "n", "pos", "comp")
    first = [F.col("pos").cast("long") if around == 0 else F.lit(0).cast("long"), F.xxhash64("key", F.lit(around)), F.col("key")]
    long = durable(entries.groupBy("h").agg(F.ceil(F.count("*") / MOST_ENTRIES).alias("parts")).where("parts > 1"))
    if long.isEmpty():
        discard(long)
        return _around_leaders(entries, first, percent, leaders).distinct()
    cut = entries.join(small(long, 64), "h", "left").withColumn("part", F.pmod(F.xxhash64("key", F.lit(-1 - around)), F.coalesce("parts", F.lit(1))))
    tops = cut.where("parts is not null").groupBy("h", "part").agg(F.min(F.struct(*[x.alias(f"o{k}") for k, x in enumerate(first)], "n", "pos", "comp")).alias("t"))
    tops = durable(tops.select("h", F.col("t.o2").alias("key"), "t.n", "t.pos", "t.comp"))
    pairs = _around_leaders(cut.withColumn("h", F.when(F.col("parts").isNull(), F.col("h")).otherwise(F.xxhash64("h", "part"))), first, percent, leaders)
    return pairs.union(_stars(tops, percent, around, leaders)).distinct()


def _around_leaders(entries: DataFrame, first: list, percent: int, leaders: int) -> DataFrame:
    """Pairs of the entries of each list with its leaders, which come first in the given order; some repeat."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5
        last = (None, None)
        for batch in stream:
            rows = [batch.column(k).to_numpy().astype(np.int64) for k in range(5)]
            h, key = rows[:2]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
            new[0] = (int(h[0]), int(key[0])) != last
            last = (int(h[-1]), int(key[-1]))
            done = len(held[0])
            h, key, n, pos, comp = (np.concatenate([x, y[new]]) for x, y in zip(held, rows, strict=True))
            if not len(h):
                continue
            start = np.maximum.accumulate(np.where(np.r_[True, h[1:] != h[:-1]], np.arange(len(h)), 0))
            found = []
            for k in range(leaders):
                i = np.flatnonzero((np.arange(len(h)) - start > k) & (np.arange(len(h)) >= done))
                j = start[i] + k
                least = -(-percent * (n[i] + n[j]) // (100 + percent))
                ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= least)
                found.append(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])], 1)[ok])
            pairs = np.unique(np.concatenate(found), axis=0)
            s = int(start[-1])
            held = [x[s : s + leaders] for x in (h, key, n, pos, comp)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_PAIRS)
            tidy()

    dealt = entries.select("h", "key", "n", "pos", "comp").repartition("h").sortWithinPartitions("h", *first)
    return dealt.mapInArrow(run, "a long, b long")


def _mixed(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Entries (h, key, n, pos) of lists with sets of several components, with these; a durable table."""
    held = entries.join(small(groups, 64), "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component")
    lists = held.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("h")
    lists = durable(lists)
    out = durable(held.join(small(lists, 64), "h").distinct())
    discard(lists)
    return out


def _rest(entries: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): all sets of each list that are in different components and pass the filters; a durable table."""
    sizes = entries.groupBy("h", "comp").count().groupBy("h").agg(F.max(F.struct("count", "comp")).alias("top"))
    sizes = durable(sizes.select("h", F.col("top.comp").alias("main")))
    signed = durable(entries.join(sizes, "h").join(nodes.select("key", "sig"), "key").select("h", "main", F.struct("key", "n", "pos", "comp", "sig").alias("x")))
    fewer = signed.where("x.comp <> main").select("h", "main", F.col("x").alias("y"))
    # Of two sets outside the largest component, the one with the larger key looks for the other.
    least = _least_sql("x.n", "y.n", percent)
    fits = f"""100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and least(x.n - x.pos, y.n - y.pos) >= {least}
        and {_apart('x.sig', 'y.sig')} <= x.n + y.n - 2 * {least}"""
    met = signed.drop("main").join(fewer, "h").where(F.expr(f"x.comp <> y.comp and (x.comp = main or x.key < y.key) and {fits}"))
    out = durable(met.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct())
    discard(sizes, signed)
    return out


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the suffix filter; a durable table."""
    sides = [nodes.select(F.col("key").alias(k), F.struct("n", "sig").alias(v)) for k, v in (("a", "x"), ("b", "y"))]
    held = durable(small(pairs, 64).join(sides[0], "a"))
    out = durable(small(held, 400).join(sides[1], "b").where(f"{_apart('x.sig', 'y.sig')} <= x.n + y.n - 2 * {_least_sql('x.n', 'y.n', percent)}").select("a", "b"))
    discard(held)
    return out


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """key, hashes: the sets of wanted nodes (key, doc_id, mark), packed and sorted; a durable table."""

    def sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                found = [s.tobytes() for s in shingle_sets(part.column(1), n)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["key", "hashes"])
            del found
            tidy()

    texts = _texts(docs)
    if wanted.count() * 100 <= 8 << 20:
        # The marks aren't compared as keys, so that the table is hashed by a single number.
        other = wanted.select(F.col("doc_id").alias("other_id"), F.col("mark").alias("other_mark"), "key")
        some = texts.join(F.broadcast(other), F.expr("doc_id = other_id and (mark ^ other_mark) = 0"))
    else:
        some = only_keys(texts, "doc_id", bloom(wanted, "doc_id")).join(wanted.hint("merge"), ["doc_id", "mark"])
    return durable(some.select("key", "text").mapInArrow(sets, "key long, hashes binary").dropDuplicates(["key"]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose full sets (key, hashes) link; a durable table."""

    def check(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            mask = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                mask.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))
            tidy()

    left, right = (sets.select(F.col("key").alias(k), F.col("hashes").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return durable(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long"))


def linked(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, mark, n and first: the (doc_id, mark) that comes first in the row's component; one row per document."""
    bits = bucket_bits(docs, 6 << 20)
    rows = durable(prefix_rows(docs, n, percent, bits))
    every = rows.where(F.col("kind") == _DOCUMENT).select("doc_id", "mark", "key", "n")
    able = F.expr("n > 0 and doc_id is not null")
    nodes = rows.where((F.col("kind") == _DOCUMENT) & able).groupBy("key").agg(F.min(F.struct("doc_id", "mark")).alias("own"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = durable(nodes.select("key", "own.doc_id", "own.mark", "n", "sig"))

    entries = rows.where(F.col("kind") != _DOCUMENT).select("h", "key", "n", "pos", F.col("key").alias("comp"))
    sets = near = groups = None
    done: list[DataFrame] = []
    for around, leaders in enumerate((*LEADERS, 0)):
        pairs = durable(_stars(entries, percent, around, leaders)) if leaders else _rest(entries, nodes, percent)
        some = _close(pairs, nodes, percent)
        wanted = some.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        wanted = durable((wanted if sets is None else wanted.join(sets.select("key"), "key", "left_anti")).join(nodes.select("key", "doc_id", "mark"), "key"))
        if sets is None or not wanted.isEmpty():
            new = sets_of(docs, wanted, n)
            done.append(new)
            sets = new if sets is None else sets.union(new)
        links = verified(some, sets, percent)
        done.append(links)
        near = links if near is None else near.union(links)
        found = components(near)
        done.append(found)
        groups = found.select(F.col("node").alias("key"), "component")
        discard(pairs, some, wanted)
        if leaders:
            mixed = _mixed(entries.drop("comp"), groups)
            entries = mixed
            done.append(mixed)
            if mixed.isEmpty():
                break

    firsts = nodes.select("key", F.struct("doc_id", "mark").alias("own"))
    named = durable(groups.join(firsts, "key"))
    names = named.groupBy("component").agg(F.min("own").alias("first"))
    names = durable(named.join(names, "component").select("key", "first"))
    discard(named, *done)
    names = firsts.join(small(names, 100), "key", "left").select("key", F.coalesce("first", "own").alias("first"))
    alone = every.where(~able).select("doc_id", "mark", "n", F.struct("doc_id", "mark").alias("first"))
    return every.where(able).join(names, "key").select("doc_id", "mark", "n", "first").union(alone)


def similar(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document; a component's id is its smallest doc_id."""
    return linked(docs, n, percent).select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document, the one with the smallest doc_id, of each component; rows without doc_id stay, rows that
    repeat the doc_id and text of the one that stays do too."""
    gone = linked(docs, n, percent).where("doc_id is not null and not first <=> struct(doc_id, mark)").select("doc_id", "mark").distinct()
    name = fresh(docs, "mark")
    gone = durable(gone.withColumnRenamed("mark", name))
    maybe, sure = split_by_keys(docs, "doc_id", bloom(gone, "doc_id"))
    mark = F.xxhash64(F.coalesce(F.make_valid_utf8("text"), F.lit("")))
    out = maybe.withColumn(name, mark).join(gone, ["doc_id", name], "left_anti").select(*docs.columns)
    return out if sure is None else out.unionByName(sure)
