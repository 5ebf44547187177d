"""Word-wise tokenisation of whole Arrow columns.

All tokenizers here cut texts at white space before anything else, so that each chunk between cuts encodes alike
wherever it stands.  A slice of the column is cut at once, equal chunks are found (by hash, and compared byte by byte),
and only chunks that a bounded cache doesn't hold reach the tokenizer.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .textscan import column_bytes, distinct_spans, slices, word_spans

#: Entries of the younger and of the older half of a cache.
_CACHE_MOST = 150_000


class ChunkCache:
    """Ids of chunks (packed 32-bit numbers), computed in groups by encode.

    What is kept is bounded: when the younger half is full, it takes the older one's place; what is used again lives on.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]) -> None:
        self.encode, self.young, self.old = encode, {}, {}

    def values(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of different chunks."""
        out: list = list(map(self.young.get, chunks))
        new = [k for k, x in enumerate(out) if x is None]
        for k in new:
            out[k] = self.old.get(chunks[k])
        missing = [k for k in new if out[k] is None]
        for k, x in zip(missing, self.encode([chunks[k] for k in missing]), strict=True):
            out[k] = x
        for k in new:
            if len(self.young) >= _CACHE_MOST:
                self.old, self.young = self.young, {}
            self.young[chunks[k]] = out[k]
        return out


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """word_spans, with the bytes before them."""
    return raw, *word_spans(raw, offsets)


def encoded(column: pa.Array, cache: ChunkCache, spans=words, most_bytes: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of the column: (row of its start, values of all chunks in order, per row the index of its first value).

    spans: cuts the bytes of rows into chunks; the bytes may be changed where that changes no chunk's ids.
    most_bytes: of a slice (one row at least); beside its result, some fifty times that is held meanwhile.
    """
    for a, b in slices(column, most_bytes):
        raw, starts, ends, first = spans(*column_bytes(column.slice(a, b - a)))
        if not len(starts):
            yield a, np.zeros(0, np.int64), np.zeros(b - a + 1, np.int64)
            continue
        where, inverse = distinct_spans(raw, starts, ends)
        whole = raw.tobytes()
        values = cache.values([whole[x:y] for x, y in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat = np.frombuffer(b"".join(values), "<i4").astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        count = sizes[inverse]
        upto = np.cumsum(count)
        out = flat[np.repeat(begin[inverse] - upto + count, count) + np.arange(upto[-1])]
        yield a, out, np.r_[0, upto][first]


_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?")] = True


def plain_parts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, with plain ones (Latin letters up to U+00FF and final punctuation) lower-cased and cut before the punctuation.

    Such letters lower-case one by one, are composed already, and part from the punctuation before anything else.
    """
    starts, ends, first = word_spans(raw, offsets)
    if not len(starts):
        return raw, starts, ends, first
    latin = np.zeros(len(raw), bool)  # second bytes of letters from U+00C0 on
    latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    letter = _LETTER[raw] | latin
    letter[:-1] |= latin[1:]
    mark = _MARK[raw]
    others, marks = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (~letter & ~mark, mark))
    stop = np.maximum.accumulate(np.where(letter, np.arange(1, len(raw) + 1, dtype=np.int32), 0))[ends - 1].astype(np.int64)
    plain = (others[ends] == others[starts]) & (stop > starts)
    plain &= marks[np.where(plain, stop, starts)] == marks[starts]
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts[plain]] += 1
    inside[ends[plain]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    raw = raw.copy()
    raw[inside & ((raw >= 65) & (raw <= 90) | latin & (raw <= 0x9E))] += 32
    two = plain & (stop < ends)
    count = 1 + two.astype(np.int64)
    upto = np.cumsum(count)
    starts, ends = np.repeat(starts, count), np.repeat(ends, count)
    ends[(upto - 2)[two]] = stop[two]
    starts[(upto - 1)[two]] = stop[two]
    return raw, starts, ends, np.concatenate([[0], upto])[first]


#: What plain words are cut to; byte-level models write them by this table.
_PLAIN = re.compile("[a-zà-öø-ÿ]+|[.,;:!?]+")
_BYTE_LETTERS = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
_BYTE_LETTERS |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _BYTE_LETTERS)}
_LETTERS = {c: "".join(_BYTE_LETTERS[b] for b in chr(c).encode()) for c in range(128, 256)}


def huggingface_encoder(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes plain_parts by a file of a lower-casing, byte-level BPE that drops white space.

    Plain parts go to the model directly; all others take the whole way through the tokenizer.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenize, packers = tokenizer.model.tokenize, [struct.Struct(f"<{n}i").pack for n in range(64)]

    def encode(chunks: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(chunks)
        others = []
        for k, chunk in enumerate(chunks):
            text = chunk.decode()
            if len(text) < 64 and _PLAIN.fullmatch(text):
                ids = [t.id for t in tokenize(text if text.isascii() else text.translate(_LETTERS))]
                out[k] = packers[len(ids)](*ids)
            else:
                others.append((k, text))
        for s in range(0, len(others), 500):
            some = others[s : s + 500]
            found = tokenizer.encode(" ".join(text for _, text in some), add_special_tokens=False)
            ids = np.array(found.ids, "<i4")
            edges = np.cumsum([0, *(len(text) + 1 for _, text in some)])
            at = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
            for (k, _), one in zip(some, np.split(ids, np.searchsorted(at, edges[1:-1])), strict=True):
                out[k] = one.tobytes()
        return out

    return encode
