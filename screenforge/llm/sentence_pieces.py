"""SentencePiece encoding and decoding by a batched Viterbi pass in numpy.

Words of equal length in code points advance together, one code point at a time.  Hashes of the substrings that end
there probe the sorted keys of all pieces, a vectorised maximum picks one of the pieces found, and its start is stored
as backpointer.

* Unigram models: the maximum is that of the summed scores.
* BPE models: a sum of scores isn't what BPE maximises.  But the encoding of a prefix is that of a shorter prefix and one
  more piece, and there is exactly one piece for which this holds: the one that, after the last piece of the shorter
  prefix, is what BPE makes of the two pieces' text.  That condition takes the place of the score; it is read off the
  merges that form the two pieces (see `compatible`), for all words and starts at once.

Texts are cut where no piece can cross: before white space that follows something else, and around line feeds.  Only
chunks that a bounded cache doesn't hold are encoded.  Chunks of more than _LONG code points take the same steps one by
one, with the probes still in bulk.

Defined results: null text counts as empty, which has no pieces; code points that no piece covers become byte pieces,
or the unknown piece in models without them; every row is encoded, also rows with null or repeated doc_id; an empty
table gives no rows; very long texts are encoded whole, in time proportional to their length; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import record, tidy, whole_text
from .textscan import mix, span_hashes
from .tokens import ChunkCache, encoded

_MARK = "▁".encode()
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
#: Longer chunks are encoded one by one.
_LONG = 160
_NEVER = 1 << 62


class Slots:
    """Where each of some different 64-bit numbers stands; most lookups take one step."""

    BITS = 18

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, bits = np.append(keys, np.uint64(0)), self.BITS
        left = np.arange(len(keys))
        self.tables = []
        while len(left):
            place = self._place(keys[left], len(self.tables), bits)
            table = np.full(1 << bits, -1, np.int32)
            table[place] = left
            self.tables.append((bits, table))
            left = left[table[place] != left]

    @staticmethod
    def _place(keys: np.ndarray, step: int, bits: int) -> np.ndarray:
        return (keys * np.uint64(2 * step * 0x9E3779B9 + 1) >> np.uint64(64 - bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that aren't there."""
        out = np.full(len(keys), -1)
        left = None  # all
        for step, (bits, table) in enumerate(self.tables):
            some = keys if left is None else keys[left]
            at = table[self._place(some, step, bits)]
            right = self.keys[at] == some
            right &= at >= 0
            if left is None:
                out = np.where(right, at, -1).astype(np.int64)
                left = np.flatnonzero(~right & (at >= 0))
            else:
                out[left[right]] = at[right]
                left = left[~right & (at >= 0)]
            if not len(left):
                break
        return out


class Pieces:
    """A model's pieces, ready to be probed by hash."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self._take([(p.piece.encode(), p.score, p.type) for p in proto.pieces], proto.trainer_spec.model_type)

    @classmethod
    def of(cls, pieces: list[tuple[bytes, float, int]], kind: int) -> Pieces:
        self = cls.__new__(cls)
        self._take(pieces, kind)
        return self

    def _take(self, pieces: list[tuple[bytes, float, int]], kind: int) -> None:
        if kind not in (_UNIGRAM, _BPE):
            raise ValueError(f"model type {kind} is neither unigram nor BPE")
        self.kind = kind
        texts = [p.replace(_MARK, b" ") for p, _, _ in pieces]
        usable = [k for k, p in enumerate(pieces) if p[2] in (_NORMAL, _USER)]
        for k in usable:
            if b" " in texts[k].lstrip(b" ") or b"\n" in texts[k] and texts[k] != b"\n":
                raise ValueError("a piece crosses a place where texts are cut")
        scores = np.array([p[1] for p in pieces])
        raw = np.frombuffer(b"".join(texts[k] for k in usable), np.uint8)
        ends = np.cumsum([len(texts[k]) for k in usable])
        keys = span_hashes(raw, np.r_[0, ends[:-1]], ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable)[order]
        self.slots = Slots(self.keys)
        self.scores = scores[self.ids]
        self.longest = max((len(texts[k].decode()) for k in usable), default=1)
        self.lowest = float(self.scores.min()) if len(usable) else 0.0
        if kind == _BPE:
            self._merges(texts)
        self.unknown = next((k for k, p in enumerate(pieces) if p[2] == _UNKNOWN), 0)
        self.bytes = np.full(256, -1)
        self.output = texts
        for k, p in enumerate(pieces):
            if p[2] == _BYTE:
                value = int(p[0][1:-1], 16)
                self.bytes[value] = k
                self.output[k] = bytes([value])
            elif p[2] not in (_NORMAL, _USER):
                self.output[k] = b"" if p[2] != _UNKNOWN else " ⁇ ".encode()
        self.sizes = np.array([len(x) for x in self.output])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.output), np.uint8)

    def probe(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each span is a piece, its place in keys)."""
        at = self.slots(span_hashes(raw, starts, ends))
        return at >= 0, at

    def _merges(self, texts: list[bytes]) -> None:
        """Lays out how BPE forms each piece.

        Symbols are the places of pieces in keys and, after them, single code points that are no pieces.  rank: the order
        in which merges to a piece are preferred, equal scores alike.  when: the rank by which the piece has been formed (-1 for a code point,
        _NEVER if BPE never forms it).  left, right: what it was merged from.  pairs: all pairs of symbols that are a piece
        together, sorted, with its rank.  Models come from merges in order, so that no piece is preferred to its parts; others
        are refused.
        """
        _, rank = np.unique(-self.scores, return_inverse=True)
        lengths = [len(texts[k].decode()) for k in self.ids.tolist()]
        letters = sorted({c for k in self.ids.tolist() for c in texts[k].decode()})
        raw = np.frombuffer(b"".join(texts[k] for k in self.ids.tolist()) + "".join(letters).encode(), np.uint8)
        ends = np.cumsum([len(texts[k]) for k in self.ids.tolist()] + [len(c.encode()) for c in letters])
        starts = np.r_[0, ends[:-1]]
        count = len(self.ids)
        single, at = self.probe(raw, starts[count:], ends[count:])
        extra = np.flatnonzero(~single)
        size = count + len(extra)
        order = np.argsort(span_hashes(raw, starts[count:][extra], ends[count:][extra]))
        extra = extra[order]
        self.extra = span_hashes(raw, starts[count:][extra], ends[count:][extra])
        self.when = np.full(size, _NEVER)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.when[count:] = -1
        self.when[at[single]] = -1
        self.longest = max(lengths, default=1)
        keys, ranks = [], []
        lengths = np.array(lengths, np.int64)
        first = np.flatnonzero((raw & 0xC0) != 0x80)
        begin = np.searchsorted(first, starts[:count])
        first = np.append(first, len(raw))
        for n in np.unique(lengths[lengths > 1]).tolist():
            which = np.flatnonzero(lengths == n)
            places = first[begin[which][:, None] + np.arange(n + 1)]
            for k in range(1, n):
                a, b = self.symbols(raw, places[:, 0], places[:, k]), self.symbols(raw, places[:, k], places[:, n])
                good = (a >= 0) & (b >= 0)
                keys.append(a[good] * size + b[good])
                ranks.append(rank[which[good]])
            whole, cut = self._last_merge(raw, places)
            a, b = self.symbols(raw, places[:, 0], cut), self.symbols(raw, cut, places[:, n])
            which, a, b = which[whole], a[whole], b[whole]
            self.left[which], self.right[which] = a, b
            if (np.maximum(self.when[a], self.when[b]) > rank[which]).any():
                raise ValueError("a BPE model's piece is preferred to the pieces that it is merged from")
            self.when[which] = rank[which]
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.pairs, self.pair_rank = Slots(mix(keys.view(np.uint64))), np.concatenate(ranks) if ranks else np.zeros(0, np.int64)
        self.held: dict[int, bool] = {}

    def symbols(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The symbol of each span; -1 if it is none."""
        key = span_hashes(raw, starts, ends)
        out = self.slots(key)
        if len(self.extra):
            at = np.minimum(np.searchsorted(self.extra, key), len(self.extra) - 1)
            out = np.where((out < 0) & (self.extra[at] == key), at + len(self.keys), out)
        return out

    def _last_merge(self, raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BPE on each row's text by itself: (whether it ends as one piece, the edge that its last merge takes away)."""
        edges, cut = places.copy(), places[:, 0].copy()
        whole = np.zeros(len(places), bool)
        rows = np.arange(len(places))
        while len(rows):
            if edges.shape[1] == 2:
                whole[rows] = True
                break
            known, at = self.probe(raw, edges[:, :-2].ravel(), edges[:, 2:].ravel())
            score = np.where(known, self.scores[at], -np.inf).reshape(len(edges), -1)
            pick = score.argmax(1)
            going = ~np.isneginf(score[np.arange(len(rows)), pick])
            rows, edges, pick = rows[going], edges[going], pick[going] + 1
            cut[rows] = edges[np.arange(len(rows)), pick]
            stay = np.arange(edges.shape[1]) != pick[:, None]
            edges = edges[stay].reshape(len(rows), edges.shape[1] - 1)
        return whole, cut

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE makes of two symbols' text these two symbols; -1 stands for a code point that no piece holds.

        The boundary stays unless the symbols at it merge at some moment.  Those moments are gone through backwards: of
        the two symbols at the boundary the one formed later (of equally late ones the right one, as merges go from left
        to right) is taken back to its part at the boundary, and the pair that was there until then merges first if it
        is preferred to the merge taken back.
        """
        out = np.ones(len(a), bool)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        x, y, limit = a[at], b[at], np.full(len(at), 2 * _NEVER)
        size = len(self.when)
        while len(at):
            place = self.pairs(mix((x * size + y).view(np.uint64)))
            bad = place >= 0
            bad[bad] = 2 * self.pair_rank[place[bad]] < limit[bad]
            out[at[bad]] = False
            when_x, when_y = self.when[x], self.when[y]
            back = when_x > when_y
            limit = np.where(back, 2 * when_x, 2 * when_y + 1)
            x, y = np.where(back, self.right[x], x), np.where(back, y, self.left[y])
            more = ~bad & (limit > 0)
            at, x, y, limit = at[more], x[more], y[more], limit[more]
        return out

    def encode(self, chunks: list[bytes]) -> list[np.ndarray]:
        """Ids of chunks in which a space stands for the mark."""
        return [np.frombuffer(ids, "<i4").astype(np.int64) for ids in self.packed(chunks)]

    def packed(self, chunks: list[bytes]) -> list[bytes]:
        """encode, with each chunk's ids as packed 32-bit numbers."""
        if not chunks:
            return []
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        letters = np.flatnonzero((raw & 0xC0) != 0x80)
        begin = np.cumsum([0, *map(len, chunks)])
        first = np.searchsorted(letters, begin)
        letters = np.append(letters, len(raw))
        size = np.diff(first)
        found = []  # (chunks, pieces of each, edges of these chunks' pieces one after the other)
        for n in np.unique(size).tolist():
            which = np.flatnonzero(size == n)
            if n == 0:
                found.append((which, np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)))
                continue
            for part in np.array_split(which, max(1, len(which) * n // 200_000)):
                places = letters[first[part][:, None] + np.arange(n + 1)]  # byte edges of each word's code points
                if self.kind == _BPE and n > _LONG:
                    edges = [self._long(raw, row) for row in places]
                    found.append((part, np.array([len(x) - 1 for x in edges]), np.concatenate(edges)))
                else:
                    back = self._viterbi(raw, places)
                    edge, at, row = np.zeros(places.shape, bool), np.full(len(part), n), np.arange(len(part))
                    edge[:, 0] = True
                    while at.any():
                        edge[row, at] = True
                        at = back[row, at]
                    found.append((part, edge.sum(1) - 1, places[edge]))
        return self._written(raw, *(np.concatenate(x) for x in zip(*found, strict=True)))

    def _written(self, raw: np.ndarray, which: np.ndarray, count: np.ndarray, flat: np.ndarray) -> list[bytes]:
        """The ids of chunks, which have so many pieces each, with the given edges."""
        out = [b""] * len(which)
        upto = np.cumsum(count)
        inside = np.ones(len(flat), bool)
        inside[np.cumsum(count + 1) - 1] = False  # the last edge of a chunk starts nothing
        starts = np.flatnonzero(inside)
        known, at = self.probe(raw, flat[starts], flat[starts + 1] if len(starts) else flat[starts])
        whole = self.ids[at].astype("<i4").tobytes()
        for k, a, b in zip(which.tolist(), (upto - count).tolist(), upto.tolist(), strict=True):
            out[k] = whole[4 * a : 4 * b]
        for k in np.unique(np.searchsorted(upto, np.flatnonzero(~known), side="right")).tolist():
            low = upto[k] - count[k]
            edges = flat[low + k : upto[k] + k + 1]
            out[which[k]] = np.array(self._with_unknown(raw, edges, known[low : upto[k]], at[low : upto[k]]), "<i4").tobytes()
        return out

    def _with_unknown(self, raw: np.ndarray, edges: np.ndarray, known: np.ndarray, at: np.ndarray) -> list[int]:
        out: list[int] = []
        for good, k, s, e in zip(known.tolist(), self.ids[at].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if good:
                out.append(k)
            elif self.bytes[0] >= 0:
                # A space stands for the mark, whose own bytes are what has no piece.
                out += self.bytes[np.frombuffer(raw[s:e].tobytes().replace(b" ", _MARK), np.uint8)].tolist()
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _viterbi(self, raw: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Of each word, where the last piece of every prefix starts."""
        words, n = places.shape[0], places.shape[1] - 1
        row = np.arange(words)
        back = np.zeros((words, n + 1), np.int64)
        best = np.full((words, n + 1), -np.inf)
        best[:, 0] = 0
        last = np.full((words, n + 1), -1)
        for end in range(1, n + 1):
            starts = np.arange(max(0, end - self.longest), end)
            begin, finish = places[:, starts].ravel(), np.repeat(places[:, end], len(starts))
            if self.kind == _UNIGRAM:
                known, at = self.probe(raw, begin, finish)
                score = np.where(known, self.scores[at], -np.inf).reshape(words, -1)
                single = score[:, -1]
                score[:, -1] = np.where(np.isneginf(single), self.lowest - 10.0, single)  # an unknown code point
                score = score + best[:, starts]
                pick = score.argmax(1)
                best[:, end] = score[row, pick]
            else:
                found = self.symbols(raw, begin, finish).reshape(words, -1)
                fits = (found >= 0) & (self.when[found] < _NEVER)
                fits[:, -1] = True
                i, j = np.nonzero(fits & (starts > 0))
                fits[i, j] = self.compatible(last[i, starts[j]], found[i, j])
                pick = fits.argmax(1)
                last[:, end] = found[row, pick]
            back[:, end] = starts[pick]
        return back

    def _long(self, raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The same pass over one long chunk of a BPE model."""
        n = len(edges) - 1
        last, back = [-1] * (n + 1), [0] * (n + 1)
        for low in range(1, n + 1, 20_000):
            ends = np.arange(low, min(low + 20_000, n + 1))
            starts = np.maximum(ends[:, None] - np.arange(self.longest, 0, -1), 0)
            found = self.symbols(raw, edges[starts].ravel(), np.repeat(edges[ends], self.longest)).reshape(starts.shape)
            fits = (found >= 0) & (self.when[found] < _NEVER) & (ends[:, None] >= np.arange(self.longest, 0, -1))
            fits[:, -1] = True
            i, j = np.nonzero(fits)
            done = low - 1
            for end, start, symbol in zip(ends[i].tolist(), starts[i, j].tolist(), found[i, j].tolist(), strict=True):
                if end > done and (start == 0 or self._fits(last[start], symbol)):
                    last[end], back[end], done = symbol, start, end
        path = [n]
        while path[-1]:
            path.append(back[path[-1]])
        return edges[path[::-1]]

    def _fits(self, a: int, b: int) -> bool:
        """compatible, for one pair; what is found is kept, in bounds."""
        if a < 0 or b < 0:
            return True
        key = a * len(self.when) + b
        if key not in self.held:
            if len(self.held) > 500_000:
                self.held.clear()
            self.held[key] = bool(self.compatible(np.array([a]), np.array([b]))[0])
        return self.held[key]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a text, without the space that encoding put before it."""
        size = self.sizes[ids]
        upto = np.cumsum(size)
        if not len(ids):
            return b""
        out = self.flat[np.repeat(self.begins[ids] - upto + size, size) + np.arange(upto[-1])].tobytes()
        return out[1:] if out.startswith(b" ") else out


def chunk_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, and byte spans of the chunks of all rows: cut before a space that follows something else, and around line feeds."""
    if raw.size == 0:
        none = np.zeros(0, np.int64)
        return raw, none, none, np.zeros(len(offsets), np.int64)
    space, feed = raw == 0x20, raw == 0x0A
    cut = feed.copy()
    cut[1:] |= (space[1:] & ~space[:-1]) | feed[:-1]
    cut[offsets[:-1][offsets[:-1] < raw.size]] = True
    starts = np.flatnonzero(cut)
    return raw, starts, np.append(starts[1:], raw.size), np.searchsorted(starts, offsets)


def encoded_column(texts: pa.Array, cache: ChunkCache) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of a text column: (row of its start, ids, per row the index of its first id)."""
    texts = pc.replace_substring(texts, "▁", " ")
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    yield from encoded(texts, cache, chunk_spans)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("same", pa.bool_()), ("ids", pa.list_(pa.int32()))])


def pieces(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit), decoded_sha256, same (decoding gives the text back), ids."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces(model_path)
        cache = ChunkCache(model.packed)
        for batch in stream:
            for a, values, first in encoded_column(batch.column(1), cache):
                out: dict[str, list] = {f.name: [] for f in _OUT}
                for k in range(len(first) - 1):
                    ids = values[first[k] : first[k + 1]]
                    decoded = model.decode(ids)
                    out["doc_id"].append(batch.column(0)[a + k].as_py())
                    out["n_pieces"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                    out["same"].append(decoded == batch.column(1)[a + k].as_buffer().to_pybytes())
                    out["ids"].append(ids.astype(np.int32) if with_ids else None)
                yield record(out, _OUT)
            tidy()
        del model, cache
        tidy()

    rows = whole_text(docs.select("doc_id", "text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, same boolean, ids array<int>")
