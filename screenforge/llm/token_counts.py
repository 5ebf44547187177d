"""Edit-aware token counts.

A text is kept as segments: white space and the word after it, the longest stretches that a byte-level tokenizer
encodes alike wherever they stand.  Blocks of segments, with the tokens of each segment, are the leaves of a binary tree
in which every node holds the code points and tokens below it.  An edit finds its place by descending the tree, re-encodes
the segments it touches and one more on either side (new white space may join or part neighbours), and updates the sums on
the paths upward.  A leaf that grows too large is split; the nodes above are then summed up from the leaves' sums, without
a look at any segment.

Defined results: null text counts as empty (no tokens); edits apply in order, each to the text the ones before it
left; places and lengths beyond the end count up to the end; null edits change nothing; every row is counted by itself,
with a null or repeated doc_id too; an empty table gives no rows; very long texts are kept and counted whole; other columns
are ignored, whatever their names (an edit expression may use them).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import record, tidy, whole_text

#: The white space of the tokenizer's own pattern.
_SPACE = "\t-\r \x85\xa0  -     　"
_SEGMENT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_BLOCK = 16
_CACHE_MOST = 400_000


def tiktoken_counter(path: str, pattern: str) -> Callable[[str], int]:
    """Tokens of a segment by a vocabulary of ranks; equal segments are encoded once while a bounded cache holds them."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    held: dict[str, int] = {}

    def count(segment: str) -> int:
        n = held.get(segment)
        if n is None:
            if len(held) >= _CACHE_MOST:
                held.clear()
            n = held[segment] = len(encode(segment))
        return n

    return count


class SegmentTree:
    """A text's segments with sums of code points and tokens; edits re-encode only what they touch."""

    def __init__(self, text: str, count: Callable[[str], int]) -> None:
        self.count, self.encoded = count, 0
        segments = _SEGMENT.findall(text)
        self._lay(*self._cut(segments, list(map(count, segments))))

    @staticmethod
    def _cut(segments: list[str], counts: list[int]) -> tuple[list[list[str]], list[list[int]]]:
        """Blocks of segments and of their tokens; one at least."""
        places = range(0, max(len(segments), 1), _BLOCK)
        return [segments[k : k + _BLOCK] for k in places], [counts[k : k + _BLOCK] for k in places]

    def _lay(self, blocks: list[list[str]], counts: list[list[int]], sums: list[tuple[int, int]] | None = None) -> None:
        """The tree over blocks; sums: code points and tokens of each, if they are known."""
        self.blocks, self.counts = blocks, counts
        sums = sums or [(len("".join(x)), sum(y)) for x, y in zip(blocks, counts, strict=True)]
        self.size = 1 << (len(blocks) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.size), [0] * (2 * self.size)
        self.chars[self.size : self.size + len(sums)] = [x for x, _ in sums]
        self.sums[self.size : self.size + len(sums)] = [y for _, y in sums]
        for k in range(self.size - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def segments(self) -> int:
        return sum(map(len, self.blocks))

    def text(self) -> str:
        return "".join(x for block in self.blocks for x in block)

    def _find(self, at: int) -> tuple[int, int, int]:
        """(block, segment in it, code points before that segment) of the segment that holds code point `at`, or of the last one."""
        k, before = 1, 0
        while k < self.size:
            k *= 2
            if at - before >= self.chars[k] and self.chars[k + 1]:
                before += self.chars[k]
                k += 1
        block = k - self.size
        held = self.blocks[block] if block < len(self.blocks) else []
        for j, segment in enumerate(held):
            if at - before < len(segment) or j == len(held) - 1:
                return block, j, before
            before += len(segment)
        return block, 0, before

    def _step(self, block: int, j: int, by: int) -> tuple[int, int]:
        """The segment one further on, or the same at either end."""
        if 0 <= j + by < len(self.blocks[block]):
            return block, j + by
        where = block + by
        while 0 <= where < len(self.blocks):
            if self.blocks[where]:
                return where, 0 if by > 0 else len(self.blocks[where]) - 1
            where += by
        return block, j

    def edit(self, at: int, cut: int, put: str) -> None:
        """Replaces `cut` code points from `at` on by `put`."""
        at = max(0, min(at, self.length))
        cut = max(0, min(cut, self.length - at))
        if not self.length:
            new = _SEGMENT.findall(put)
            self.encoded += len(new)
            self._lay(*self._cut(new, list(map(self.count, new))))
            return
        b1, j1, _ = self._find(max(at - 1, 0))
        b2, j2, _ = self._find(min(at + cut, self.length - 1))
        (b1, j1), (b2, j2) = self._step(b1, j1, -1), self._step(b2, j2, 1)
        before = self._before(b1) + sum(map(len, self.blocks[b1][:j1]))
        if b1 == b2:
            old = self.blocks[b1][j1 : j2 + 1]
        else:
            old = self.blocks[b1][j1:] + [x for k in range(b1 + 1, b2) for x in self.blocks[k]] + self.blocks[b2][: j2 + 1]
        region = "".join(old)
        new = _SEGMENT.findall(region[: at - before] + put + region[at - before + cut :])
        self.encoded += len(new)
        for held, fresh in ((self.blocks, new), (self.counts, list(map(self.count, new)))):
            tail = held[b2][j2 + 1 :]
            if b1 == b2:
                held[b1] = held[b1][:j1] + fresh + tail
            else:
                held[b1] = held[b1][:j1] + fresh
                for k in range(b1 + 1, b2):
                    held[k] = []
                held[b2] = tail
        if len(self.blocks[b1]) > 8 * _BLOCK:
            self._split(b1, b2)
            return
        for k in range(b1, b2 + 1):
            self._sum(k)

    def _split(self, first: int, last: int) -> None:
        """Cuts block `first` into several and takes up the changes of the blocks up to `last`."""
        sums = list(zip(self.chars[self.size :], self.sums[self.size :]))[: len(self.blocks)]
        for k in range(first, last + 1):
            sums[k] = (len("".join(self.blocks[k])), sum(self.counts[k]))
        blocks, counts = self._cut(self.blocks[first], self.counts[first])
        parts = [(len("".join(x)), sum(y)) for x, y in zip(blocks, counts, strict=True)]
        self._lay(self.blocks[:first] + blocks + self.blocks[first + 1 :], self.counts[:first] + counts + self.counts[first + 1 :], sums[:first] + parts + sums[first + 1 :])

    def _before(self, block: int) -> int:
        k, total = block + self.size, 0
        while k > 1:
            if k & 1:
                total += self.chars[k - 1]
            k >>= 1
        return total

    def _sum(self, block: int) -> None:
        k = block + self.size
        self.chars[k], self.sums[k] = len("".join(self.blocks[block])), sum(self.counts[block])
        k >>= 1
        while k:
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]
            k >>= 1


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_segments", pa.int64()), ("edited_tokens", pa.int64()), ("edited_chars", pa.int64()), ("n_reencoded", pa.int64()), ("edited_sha256", pa.string())]
)


def edited_counts(docs: DataFrame, edits: Column, path: str, pattern: str) -> DataFrame:
    """Tokens of every document before and after its edits, an array of structs (at, cut, put).

    doc_id, n_tokens, n_segments, edited_tokens, edited_chars, n_reencoded (segments encoded anew), edited_sha256.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tiktoken_counter(path, pattern)
        for batch in stream:
            out: dict[str, list] = {f.name: [] for f in _OUT}
            for doc_id, text, changes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                tree = SegmentTree(text.as_py(), count)
                out["doc_id"].append(doc_id)
                out["n_tokens"].append(tree.tokens)
                out["n_segments"].append(tree.segments())
                for change in changes.as_py() or ():
                    if change and change["at"] is not None:
                        tree.edit(change["at"], change["cut"] or 0, change["put"] or "")
                out["edited_tokens"].append(tree.tokens)
                out["edited_chars"].append(tree.length)
                out["n_reencoded"].append(tree.encoded)
                out["edited_sha256"].append(hashlib.sha256(tree.text().encode()).hexdigest())
            yield record(out, _OUT)
            tidy()

    rows = whole_text(docs).select("doc_id", "text", edits.alias("edits"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_segments long, edited_tokens long, edited_chars long, n_reencoded long, edited_sha256 string")


def sample_edits(text: str = "text") -> Column:
    """Three edits of a text: a word put in at a third, 16 code points cut at the middle, the last 8 replaced by the first 8."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    third, half, last = F.floor(n / 3), F.floor(n / 2), F.greatest(n - 8, F.lit(0))
    edit = lambda at, cut, put: F.struct(at.cast("long").alias("at"), F.lit(cut).cast("long").alias("cut"), put.alias("put"))
    return F.array(edit(third, 0, F.lit(" edited")), edit(half, 16, F.lit("")), edit(last, 8, F.substring(F.coalesce(F.col(text), F.lit("")), 1, 8)))
