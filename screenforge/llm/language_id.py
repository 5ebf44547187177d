"""Language ID by prediction by partial matching.

For each language, byte contexts of up to ORDER bytes form a tree with the counts of the bytes that followed.  A byte
is coded in the longest context known; a context that hasn't seen it costs an escape (method C: as likely as its
number of different followers) and hands over to the next shorter one, down to 8 plain bits.  The statistics are
frozen, so the code length of a byte depends on itself and ORDER bytes before it: code lengths of all such runs that
training saw are laid out in one table, and the others are worked out from the tree.  A text is in the language that
codes it shortest; nothing else is an input.

The trees learn from a bounded sample: up to SAMPLE_PER_LANGUAGE documents of each language, whole texts, chosen by
hash among those that may be learnt from, and of at most MOST_LANGUAGES labels.

Defined results: null text and text without a letter give `und` and score 0; ties go to the first label in order;
without anything to learn from, every prediction is `und`; a null doc_id is not held out and never learnt from; every
row is predicted by itself, repeated rows too (they are learnt from as often as they stand there); an empty table gives
no rows; very long texts are scored whole, in slices of rows; other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record, tidy, whole_text
from .textscan import column_bytes, slices

ORDER = 3
SAMPLE_PER_LANGUAGE = 2000
#: So many labels, the most frequent ones, are learnt at most.
MOST_LANGUAGES = 64
#: Code lengths that are laid out in a table (those of the most frequent runs); others are worked out when they are needed.
MOST_CELLS = 1 << 23
#: Neighbouring bytes aren't independent evidence; so many bits count as one for the score.
BITS_PER_EVIDENCE = 8.0
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, as one number; a text starts after line feeds."""
    x = _LOWER[raw]
    out = x.copy()
    for back in (1, 2, 3):
        moved = np.full(len(x), 10, np.uint32)
        moved[back:] = x[:-back]
        for k in range(back):
            at = offsets[:-1] + k
            moved[at[at < offsets[1:]]] = 10
        out |= moved << np.uint32(8 * back)
    return out


class Trees:
    """Context trees of several languages with frozen counts."""

    def __init__(self, labels: list[str], grams: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.labels = labels
        self.levels = []  # by language, from the longest contexts on: (runs, code lengths, contexts, escape lengths)
        for keys, numbers in zip(grams, counts, strict=True):
            levels = []
            for order in range(ORDER, -1, -1):
                runs, inverse = np.unique(keys & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
                n = np.bincount(inverse, numbers)
                contexts, inverse, followers = np.unique(runs >> np.uint32(8), return_inverse=True, return_counts=True)
                total = np.bincount(inverse, n) + followers
                levels.append((runs, np.log2(total[inverse] / n), contexts, np.log2(total / followers)))
            self.levels.append(levels)
        self.known = np.zeros(0, np.uint32)
        if grams:
            self.known, inverse = np.unique(np.concatenate(grams), return_inverse=True)
            most = MOST_CELLS // len(labels)
            if len(self.known) > most:
                often = np.argsort(-np.bincount(inverse, np.concatenate(counts)), kind="stable")[:most]
                self.known = self.known[np.sort(often)]
        self.table = self.lengths(self.known).astype(np.float32)

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each run's last byte, by language."""
        out = np.zeros((len(self.labels), len(grams)))
        for bits, levels in zip(out, self.levels, strict=True):
            open_ = np.arange(len(grams))
            for order, (runs, length, contexts, escape) in zip(range(ORDER, -1, -1), levels, strict=True):
                run = grams[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
                at = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
                seen = runs[at] == run
                bits[open_[seen]] += length[at[seen]]
                open_, run = open_[~seen], run[~seen]
                at = np.minimum(np.searchsorted(contexts, run >> np.uint32(8)), len(contexts) - 1)
                bits[open_] += np.where(contexts[at] == run >> np.uint32(8), escape[at], 0.0)
            bits[open_] += 8.0
        return out

    def score(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of a column: (code lengths by row and language in bits, bytes by row)."""
        for a, b in slices(column, 1 << 19):
            raw, offsets = column_bytes(column.slice(a, b - a))
            grams = _grams(raw, offsets)
            at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
            new = np.flatnonzero(self.known[at] != grams)
            others, where = np.unique(grams[new], return_inverse=True)
            lengths = self.lengths(others)
            out = np.zeros((b - a, len(self.labels)))
            for k, table in enumerate(self.table):
                bits = table[at].astype(np.float64)
                bits[new] = lengths[k][where]
                upto = np.r_[0.0, np.cumsum(bits)]
                out[:, k] = upto[offsets[1:]] - upto[offsets[:-1]]
            yield out, np.diff(offsets)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame) -> Trees:
    """Trees of every language of docs, from a bounded sample of the rows that may be learnt from."""
    may = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["count"] for r in may.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()}
    labels = sorted(sizes)
    if not labels:
        return Trees([], [], [])
    part = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000))
    limit = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1_000_000, -(-1_000_000 * SAMPLE_PER_LANGUAGE // sizes[k])))])
    sample = may.where(part < limit[F.col("lang")]).select("lang", F.make_valid_utf8("text").alias("text"))
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in dict.fromkeys(langs.tolist()):
                mine = batch.column(1).filter(pa.array(langs == lang))
                for a, b in slices(mine, 1 << 19):
                    grams, n = np.unique(_grams(*column_bytes(mine.slice(a, b - a))), return_counts=True)
                    yield record({"lang": [lang] * len(n), "gram": grams.astype(np.int64), "n": n}, schema)
            tidy()

    rows = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, grams, n = (rows.column(c).to_numpy() for c in ("lang", "gram", "n"))
    order = np.argsort(grams, kind="stable")
    langs, grams, n = langs[order], grams[order].astype(np.uint32), n[order].astype(np.float64)
    labels = [x for x in labels if (langs == x).any()]
    return Trees(labels, [grams[langs == x] for x in labels], [n[langs == x] for x in labels])


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def predicted(docs: DataFrame, trees: Trees, prefix: str = "") -> DataFrame:
    """docs with lang_pred, score and bits_per_byte (of the language chosen) added at the end, under a prefix if names would clash."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    columns, place = docs.columns, docs.columns.index("text")
    added = [pa.field(f"{prefix}lang_pred", pa.string()), pa.field(f"{prefix}score", pa.float64()), pa.field(f"{prefix}bits_per_byte", pa.float64())]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in stream:
            labels: list[str] = []
            scores: list[np.ndarray] = []
            rates: list[np.ndarray] = []
            texts = batch.column(place)
            if trees.labels:
                for bits, size in trees.score(texts):
                    best = bits.argmin(1)
                    low = bits[np.arange(len(bits)), best]
                    scores.append(1 / np.exp2((low[:, None] - bits) / BITS_PER_EVIDENCE).sum(1))
                    rates.append(low / np.maximum(size, 1))
                    labels += [trees.labels[k] for k in best.tolist()]
            score = np.concatenate(scores) if scores else np.zeros(batch.num_rows)
            rate = np.concatenate(rates) if rates else np.zeros(batch.num_rows)
            labels = labels or ["und"] * batch.num_rows
            for k, text in enumerate(texts):
                if labels[k] != "und" and (not text.is_valid or not _has_letter(text.as_py())):
                    labels[k], score[k] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(score), pa.array(rate)],
                schema=pa.schema([*(batch.schema.field(k) for k in range(len(columns))), *added]),
            )
            tidy()

    schema = docs.schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("bits_per_byte", "double")):
        schema = type(schema)(list(schema.fields)).add(prefix + name, kind)
    return docs.mapInArrow(run, schema)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per document."""
    texts = whole_text(docs.select("doc_id", held_out().alias("held_out"), "text"))
    return predicted(texts, trained(docs)).select("doc_id", "held_out", "lang_pred", "score")


def drop_unknown(docs: DataFrame) -> DataFrame:
    """docs without those that are in no known language: no letter, or no shorter in any language than as plain bytes."""
    texts = whole_text(docs)
    found = predicted(texts, trained(docs), "__")
    return found.where((F.col("__lang_pred") != "und") & (F.col("__bits_per_byte") < 8)).select(*docs.columns)
