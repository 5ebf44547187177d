"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of tokens.  Every window of one sequence's size takes from each queue its target share; the
fraction that a queue is owed stays as its deficit and is paid in a later window, whichever partition holds the
tokens.  Because deficits follow from the queue's total alone, the share that a queue has had before window w is
known in closed form (its owed amount rounded down), so every partition places its own documents without waiting for
others.  When a queue runs dry, the others share its part, in a new phase.  Windows are laid end to end and cut into
sequences of exactly the given size; the last tokens go to sequences whose sizes are powers of two, so that nothing
is padded.

Defined results: null text counts as empty (the document is its end token alone); null source is a queue of its own;
every source has a queue, however many there are (the schedule, a few numbers a source and phase, is held by the driver
and each worker); an empty table gives no pieces; rows with a null doc_id and repeated rows are packed each; very long
texts are encoded and packed whole, in as many pieces as they need; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, record, tidy, whole_text
from .tokens import ChunkCache, encoded, huggingface_encoder, plain_parts

#: Tokens that are placed at a time, and cells (windows by queues) that are summed at a time.
MOST_TOKENS, MOST_CELLS = 500_000, 1 << 20
#: Bytes of text that are encoded at a time.
MOST_TEXT = 1 << 20
#: The table of queue starts by block is broadcast up to so many bytes, and joined beyond.
MOST_BROADCAST = 8 << 20

_TOKENS = pa.schema([("doc_id", pa.int64()), ("queue", pa.string()), ("block", pa.int64()), ("before", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Every document's ids, its block (task) and the tokens of its queue before it in that block."""
    queue = F.col("source").cast("string")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, before, block = ChunkCache(huggingface_encoder(tokenizer_path)), {}, TaskContext.get().partitionId()
        for batch in stream:
            ids, names, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            for a, values, first in encoded(texts, cache, plain_parts, MOST_TEXT):
                out: dict[str, list] = {f.name: [] for f in _TOKENS}
                values = values.astype("<u4")
                for k in range(len(first) - 1):
                    mine = np.append(values[first[k] : first[k + 1]], np.uint32(end_id))
                    name = names[a + k]
                    out["doc_id"].append(ids[a + k].as_py())
                    out["queue"].append(name)
                    out["block"].append(block)
                    out["before"].append(before.get(name, 0))
                    out["doc_tokens"].append(len(mine))
                    out["ids"].append((mine if mine.max() > 65535 else mine.astype("<u2")).tobytes())
                    before[name] = before.get(name, 0) + len(mine)
                yield record(out, _TOKENS)
                del out, values
            tidy()
        del cache
        tidy()

    rows = whole_text(docs.select("doc_id", queue.alias("queue"), "text"))
    return rows.mapInArrow(run, "doc_id long, queue string, block long, before long, doc_tokens long, ids binary")


class Schedule:
    """Places of every queue's tokens in the sequence of all tokens."""

    BITS = 30

    def __init__(self, totals: dict, size: int, weights: dict | None = None) -> None:
        self.size, self.names = size, sorted(totals, key=lambda x: (x is not None, x))
        left = np.array([totals[n] for n in self.names], np.int64)
        share = left.astype(float) if weights is None else np.array([float(weights.get(n, 0)) for n in self.names])
        self.phases, base = [], 0  # (base, windows, taken so far by queue, takes by queue)
        had = np.zeros(len(left), np.int64)
        #: What each queue is owed from the start, spread evenly, so that like queues don't take their tokens all at once.
        self.owed = (np.arange(len(left)) * 0.6180339887498949 % 1 * (1 << self.BITS)).astype(np.int64)
        while left.sum():
            live = (left > 0) & (share > 0)
            if not live.any():  # only queues without a share are left: they take their natural parts
                share, live = left.astype(float), left > 0
            rounds = (left[live] / share[live]).min()
            take = np.where(live, np.minimum(left, np.floor(share * rounds + 1e-6).astype(np.int64)), 0)
            dry = live & (left / np.where(share > 0, share, 1) <= rounds * (1 + 1e-12))
            take = np.where(dry, left, take)
            windows = int(-(-take.sum() // size))
            self.phases.append((base, windows, had.copy(), take))
            base += int(take.sum())
            had, left = had + take, left - take
        self.total = base
        tail = base % size
        edges = [base - tail]
        while tail:
            edges.append(edges[-1] + (1 << tail.bit_length() - 1))
            tail -= 1 << tail.bit_length() - 1
        self.tail = np.array(edges, np.int64)  # starts of the last, short sequences, and the end

    def _had(self, take: np.ndarray, owed: np.ndarray, windows: int, w: np.ndarray) -> np.ndarray:
        """Tokens that each queue has had before window w: what it is owed, rounded down."""
        whole, rest = take // windows, take % windows
        part = (rest << self.BITS) // windows if windows < 1 << 32 else (rest.astype(float) / windows * (1 << self.BITS)).astype(np.int64)
        return np.where(w >= windows, take, whole * w + (part * w + owed >> self.BITS))

    def place(self, queue: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, offset in queue, length, place among all tokens) of the runs that documents are cut into; queue: numbers."""
        out = []
        for base, windows, had, takes in self.phases:
            low, high = np.maximum(start - had[queue], 0), np.minimum(start + length - had[queue], takes[queue])
            row = np.flatnonzero(low < high)
            if not len(row):
                continue
            low, high, take, owed = low[row], high[row], takes[queue[row]], self.owed[queue[row]]
            first, last = (self._window(take, owed, windows, x) for x in (low, high - 1))
            # A queue that gives less than a token a window is followed by tokens, others by windows.
            by_token = take < windows
            n = np.where(by_token, high - low, last - first + 1)
            index = np.repeat(np.arange(len(row)), n)
            w = np.repeat(np.where(by_token, low, first) - np.cumsum(n) + n, n) + np.arange(n.sum())
            single = by_token[index]
            w[single] = self._window(take[index[single]], owed[index[single]], windows, w[single])
            here = self._had(take[index], owed[index], windows, w)
            a, b = np.maximum(here, low[index]), np.minimum(self._had(take[index], owed[index], windows, w + 1), high[index])
            full = a < b
            full[1:] &= (index[1:] != index[:-1]) | (w[1:] != w[:-1])
            index, w, here, a, b = index[full], w[full], here[full], a[full], b[full]
            q = queue[row][index]
            out.append((row[index], a + had[q], b - a, base + a - here + self._before(takes, windows, q, w)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4

    def _before(self, takes: np.ndarray, windows: int, q: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Tokens of all queues before the part of queue q in window w."""
        found, at = np.unique(w, return_inverse=True)
        out, order = np.empty(len(w), np.int64), np.argsort(at, kind="stable")
        step = max(1, MOST_CELLS // len(takes))
        edges = np.searchsorted(at[order], np.arange(0, len(found) + step, step))
        for k, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            some, mine = found[k * step : (k + 1) * step, None], order[i:j]
            now, after = (np.cumsum(self._had(takes, self.owed, windows, x), axis=1) for x in (some, some + 1))
            r, before = at[mine] - k * step, q[mine] - 1
            out[mine] = now[r, -1] + np.where(before < 0, 0, after[r, before] - now[r, before])
        return out

    def _window(self, take: np.ndarray, owed: np.ndarray, windows: int, x: np.ndarray) -> np.ndarray:
        w = np.clip((x / take * windows).astype(np.int64), 0, windows - 1)
        while (late := (self._had(take, owed, windows, w) > x)).any():
            w = w - late
        while (early := (self._had(take, owed, windows, w + 1) <= x)).any():
            w = w + early
        return w

    def cut(self, row: np.ndarray, offset: np.ndarray, length: np.ndarray, g: np.ndarray):
        """Runs cut at sequence edges: (row, offset in queue, length, sequence, offset in sequence)."""
        parts = []
        while len(row):
            tail = np.searchsorted(self.tail, g, side="right")
            begin = np.where(tail > 0, self.tail[np.maximum(tail - 1, 0)], g // self.size * self.size)
            edge = np.where(tail > 0, self.tail[np.minimum(tail, len(self.tail) - 1)], begin + self.size)
            sequence = np.where(tail > 0, self.tail[0] // self.size + tail - 1, g // self.size)
            now = np.minimum(length, edge - g)
            parts.append((row, offset, now, sequence, g - begin))
            more = now < length
            row, offset, length, g = row[more], (offset + now)[more], (length - now)[more], (g + now)[more]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 5


def packed(docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 2, weights: dict | None = None) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (packed 32-bit).

    weights: target token proportions by source; None: those of the whole input, so that all queues end together.
    """
    rows = durable(tokenised(docs, tokenizer_path, end_id))
    sums = rows.groupBy("queue", "block").agg(F.sum("doc_tokens").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(sums.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    totals = {r["queue"]: r["n"] for r in starts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    schedule = docs.sparkSession.sparkContext.broadcast(Schedule(totals, size, weights))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = schedule.value
        number = {name: k for k, name in enumerate(plan.names)}
        for batch in stream:
            queues = np.array([number[x] for x in batch.column("queue").to_pylist()], np.int64)
            start = batch.column("start").to_numpy()
            tokens = batch.column("doc_tokens").to_numpy()
            ids, doc_ids = batch.column("ids"), batch.column("doc_id")
            part = np.cumsum(tokens) // MOST_TOKENS
            for p in np.unique(part):
                mine = np.flatnonzero(part == p)
                row, offset, length, sequence, place = plan.cut(*plan.place(queues[mine], start[mine], tokens[mine]))
                order = np.lexsort((offset, row))
                row, offset, length, sequence, place = mine[row[order]], offset[order], length[order], sequence[order], place[order]
                offset -= start[row]
                words = {k: _wide(ids[k].as_buffer(), int(tokens[k])) for k in np.unique(row).tolist()}
                bodies = [words[r][4 * o : 4 * (o + n)] for r, o, n in zip(row.tolist(), offset.tolist(), length.tolist(), strict=True)]
                yield record(
                    {"doc_id": doc_ids.take(pa.array(row)), "start": offset, "length": length, "ids_crc32": [zlib.crc32(b) for b in bodies], "doc_tokens": tokens[row], "sequence_id": sequence, "offset": place, "ids": bodies},
                    _PIECES,
                )
                del words, bodies
            tidy()

    table = starts.select(F.col("queue").alias("__queue"), F.col("block").alias("__block"), "base")
    few = starts.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("queue"), F.lit(0)) + 100), F.lit(0))).first()[0] <= MOST_BROADCAST
    joined = rows.join(F.broadcast(table) if few else table, rows["queue"].eqNullSafe(table["__queue"]) & (rows["block"] == table["__block"]))
    if not few:  # documents of one block fall into much the same windows
        joined = joined.sortWithinPartitions("block", "before")
    return joined.select("doc_id", "queue", (F.col("base") + F.col("before")).alias("start"), "doc_tokens", "ids").mapInArrow(run, _PIECES_SQL)


def _wide(blob, count: int) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers, from two or four bytes each."""
    return np.frombuffer(blob, "<u2" if len(blob) == 2 * count else "<u4").astype("<u4").tobytes()
