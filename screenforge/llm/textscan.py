"""Vectorised byte-level scanning of Arrow string columns, shared by the word and shingle operators.

Words are maximal runs of code points other than U+0020 and U+0009-U+000D.  In UTF-8 those separators are
single bytes that never occur inside another code point, so words can be found on the raw bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Longer spans are hashed one by one.
_LONG = 256
#: The lowest bytes of a lane that belong to a span with so many bytes left.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    dtype = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, dtype, len(column) + 1, column.offset * np.dtype(dtype).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and per row the index of its first word (n + 1 values)."""
    if raw.size == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SEP[raw]
    first = np.zeros(raw.size, bool)
    first[offsets[:-1][offsets[:-1] < raw.size]] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:]
    last = np.zeros(raw.size, bool)
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    end = inside
    end[:-1] &= ~inside[1:] | last[:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; beyond the end there are zeros."""
    held = np.zeros(raw.size + 8, np.uint8)
    held[: raw.size] = raw
    return np.ndarray(raw.size + 1, "<u8", held, strides=(1,))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, the same wherever the span stands.

    Eight bytes at a time enter a mixer with full avalanche, as in block hashes; spans of up to eight bytes and equal
    length never collide.  Long spans take BLAKE2b.
    """
    lanes, size = _lanes(raw), ends - starts
    value = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    left = np.arange(len(starts))
    for k in range(0, _LONG, 8):
        left = left[size[left] > k]
        if not len(left):
            break
        value[left] = mix(value[left] ^ (lanes[starts[left] + k] & _MASK[np.minimum(size[left] - k, 8)]))
    for i in left[size[left] > _LONG].tolist():
        value[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return value


def same_spans(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes from a on and from b on are the same, byte for byte, for each pair of starts."""
    lanes, same = _lanes(raw), np.ones(len(a), bool)
    left = np.flatnonzero(a != b)
    for k in range(0, _LONG, 8):
        left = left[size[left] > k]
        if not len(left):
            break
        same[left] &= (lanes[a[left] + k] ^ lanes[b[left] + k]) & _MASK[np.minimum(size[left] - k, 8)] == 0
    for i in left[size[left] > _LONG].tolist():
        same[i] = raw[a[i] : a[i] + size[i]].tobytes() == raw[b[i] : b[i] + size[i]].tobytes()
    return same


def distinct_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, number): a span of each content, and for every span the place of its content there; bytes decide, not hashes."""
    found = pa.array(span_hashes(raw, starts, ends)).dictionary_encode()
    number = found.indices.to_numpy().astype(np.int64)
    first = np.zeros(len(found.dictionary), np.int64)
    first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
    size, lead = ends - starts, first[number]
    wrong = np.flatnonzero((size != size[lead]) | ~same_spans(raw, starts, starts[lead], np.minimum(size, size[lead])))
    if len(wrong):
        held: dict[bytes, int] = {}
        for i in wrong.tolist():
            number[i] = held.setdefault(raw[starts[i] : ends[i]].tobytes(), len(first) + len(held))
        lead = np.full(len(held), len(starts))
        np.minimum.at(lead, number[wrong] - len(first), wrong)
        first = np.append(first, lead)
    return first, number


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """span_hashes of words, with A-Z lower-cased if wanted."""
    return span_hashes(_LOWER[raw] if lower else raw, starts, ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words; the caller drops runs that cross a row's end."""
    size = words.size - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(size, np.uint64)
    for k in range(n):
        value = mix(value * np.uint64(0x2545F4914F6CDD1D) + words[k : k + size])
    return value


def slices(column: pa.Array, most_bytes: int = 2 << 20):
    """Cuts a column into row ranges of about most_bytes each (one row at least), to bound memory."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    _, offsets = column_bytes(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def shingle_sets(column: pa.Array, n: int = 5, lower: bool = True) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes of its n-word shingles; fewer words: the sequence as one; none: empty."""
    out: list[np.ndarray] = []
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    for a, b in slices(column):
        raw, offsets = column_bytes(column.slice(a, b - a))
        starts, ends, first = word_spans(raw, offsets)
        words = word_hashes(raw, starts, ends, lower)
        grams = gram_hashes(words, n)
        for i in range(b - a):
            s, e = first[i], first[i + 1]
            if e - s >= n:
                part = np.sort(grams[s : e - n + 1])
                out.append(part[np.r_[True, part[1:] != part[:-1]]] if part.size > 1 else part)
            elif e > s:
                value = np.full(1, int(e - s), np.uint64)
                for k in range(s, e):
                    value = mix(value * np.uint64(0x2545F4914F6CDD1D) + words[k : k + 1] + np.uint64(1))
                out.append(value)
            else:
                out.append(np.zeros(0, np.uint64))
    return out
