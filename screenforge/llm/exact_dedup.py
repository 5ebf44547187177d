"""Exact dedup by Patricia-trie owners.

Every task first merges equal texts of its own batch, by salt (a hash of the doc_id), so that a text with very many
copies goes once a batch and salt.  The survivors go, with their full bytes, to the owner of their length and content
hash.  Owners receive them in the order of their bytes, from Spark's external sort, and insert them into a compressed
radix trie, whose terminal nodes store the identifier that stays.  When the trie outgrows its budget, the subtrees that
lie before the last key, which nothing can enter any more, are handed over and freed.  An owner answers every salt that
it has seen of a text; rows meet their answer by content hash and salt, so that no text's copies meet in one place.

Defined results: null text counts as empty and all empty texts are equal; a null doc_id never wins unless all of
its group are null; of repeated rows with the winning doc_id exactly one is kept; an empty table gives no rows; very long
texts are compared whole; other columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, bloom, bucket_bits, durable, fresh, split_by_keys, tidy, whole_text

#: Bytes of keys and nodes that an owner's trie may hold before it hands over its finished subtrees.
TRIE_BYTES = 32 << 20
_NODE_BYTES = 200
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class RadixTrie:
    """Compressed radix trie over byte strings; each terminal node merges the values of equal keys."""

    __slots__ = ("root", "held")

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]  # label, children by first byte, value
        self.held = 0

    def insert(self, key: bytes, value, merge) -> None:
        """Adds a key with its value, or merges the value into the key's own: merge(own, value) gives the new one."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, merge(None, value)]
                self.held += len(key) - at + _NODE_BYTES
                return
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            common = _common(label, key, at)
            fork = [label[:common], {label[common]: child}, None]
            child[0] = label[common:]
            node[1][key[at]] = fork
            self.held += _NODE_BYTES
            node, at = fork, at + common
        node[2] = merge(node[2], value)

    def values(self) -> Iterator:
        yield from self._taken(self.root)

    def before(self, key: bytes) -> Iterator:
        """The values of all keys that sort before this one; their nodes are freed."""
        node, at = self.root, 0
        while at < len(key):
            if node[2] is not None:
                yield node[2]
                node[2] = None
            for first in [b for b in node[1] if b < key[at]]:
                yield from self._taken(node[1].pop(first))
            child = node[1].get(key[at])
            if child is None:
                return
            if not key.startswith(child[0], at):
                if child[0] < key[at : at + len(child[0])]:
                    yield from self._taken(node[1].pop(key[at]))
                return
            node, at = child, at + len(child[0])

    def _taken(self, node: list) -> Iterator:
        stack = [node]
        while stack:
            node = stack.pop()
            self.held -= len(node[0]) + _NODE_BYTES
            if node[2] is not None:
                yield node[2]
            stack.extend(node[1].values())


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of label and key[at:], by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[:mid] == key[at : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _larger(a: tuple, b: tuple) -> tuple:
    """(largest id, rows that have it, rows) of two parts of a class; a null id is less than all others."""
    n = a[2] + b[2]
    if a[0] == b[0]:
        return a[0], a[1] + b[1], n
    return (*(a if b[0] is None or a[0] is not None and a[0] > b[0] else b)[:2], n)


def _merge(own: list | None, new: tuple) -> list:
    """A terminal's value: digest, (largest id, rows that have it, rows), salts; new: digest, salt, and the three numbers."""
    if own is None:
        return [new[0], tuple(new[2:]), {new[1]}]
    own[1] = _larger(own[1], new[2:])
    own[2].add(new[1])
    return own


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("salt", pa.int64()), ("digest", pa.binary())])
_PARTS = pa.schema([("size", pa.int64()), ("mark", pa.int64()), ("bytes", pa.binary()), ("digest", pa.binary()), ("salt", pa.int64()), ("doc_id", pa.int64()), ("same", pa.int64()), ("n", pa.int64())])
_PARTS_SQL = "size long, mark long, bytes binary, digest binary, salt long, doc_id long, same long, n long"
_CLASSES = pa.schema([("digest", pa.binary()), ("salt", pa.int64()), ("keep_id", pa.int64()), ("same", pa.int64()), ("group_size", pa.int64())])


def _normalised(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, bytes]]:
    for doc_id, text, salt in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
        yield doc_id, salt, (text.as_buffer().to_pybytes() if text.is_valid else b"").lower()  # bytes.lower: A-Z only


def _digests(batch: pa.RecordBatch) -> dict:
    rows = [(i, s, hashlib.sha256(t).digest()) for i, s, t in _normalised(batch)]
    return {"doc_id": [r[0] for r in rows], "salt": [r[1] for r in rows], "digest": [r[2] for r in rows]}


def _parts(batch: pa.RecordBatch) -> dict:
    digests: dict[bytes, bytes] = {}
    seen: dict[tuple, tuple] = {}
    for doc_id, salt, text in _normalised(batch):
        if text not in digests:
            digests[text] = hashlib.sha256(text).digest()
        value, key = (doc_id, 1, 1), (text, salt)
        seen[key] = _larger(seen[key], value) if key in seen else value
    out = {
        "size": [len(t) for t, _ in seen],
        "mark": [int.from_bytes(digests[t][:8], "big", signed=True) for t, _ in seen],
        "bytes": [t for t, _ in seen],
        "digest": [digests[t] for t, _ in seen],
        "salt": [s for _, s in seen],
    }
    return out | {name: [v[k] for v in seen.values()] for k, name in enumerate(("doc_id", "same", "n"))}


def _owners(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = RadixTrie()

    def out(values: Iterator) -> pa.RecordBatch:
        rows = [(digest, salt, *numbers) for digest, numbers, salts in values for salt in salts]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_CLASSES)], schema=_CLASSES)

    for batch in stream:
        for text, digest, *numbers in zip(batch.column(0), *(c.to_pylist() for c in batch.columns[1:]), strict=True):
            key = text.as_buffer().to_pybytes()
            if trie.held > TRIE_BYTES:
                yield out(trie.before(key))
            trie.insert(key, (digest, *numbers), _merge)
        tidy()
    yield out(trie.values())
    tidy()


def _salted(docs: DataFrame) -> DataFrame:
    """doc_id, text, salt: a share of the rows of about 64 MB has the same salt."""
    salts = 1 << bucket_bits(docs, 64 << 20)
    return whole_text(docs.select("doc_id", "text")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))


def exact_classes(docs: DataFrame) -> DataFrame:
    """(digest, salt, keep_id, same, group_size): a row for each distinct normalised text and salt; same: rows that have keep_id."""
    parts = _salted(docs).mapInArrow(batches(_parts, _PARTS, 1), _PARTS_SQL)
    owned = parts.repartition("size", "mark").sortWithinPartitions("bytes").select("bytes", "digest", "salt", "doc_id", "same", "n")
    return owned.mapInArrow(_owners, "digest binary, salt long, keep_id long, same long, group_size long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document."""
    classes = durable(exact_classes(docs))
    digests = _salted(docs).mapInArrow(batches(_digests, _DIGESTS, 1), "doc_id long, salt long, digest binary")
    joined = digests.join(classes, ["digest", "salt"]).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not classes.where("same > 1").isEmpty():  # rows that repeat the doc_id and text that stay
        alike = Window.partitionBy("doc_id", "digest").orderBy(F.lit(1))
        joined = joined.withColumn("kept", F.col("kept") & (F.row_number().over(alike) == 1))
    return joined.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one row of each class; columns unchanged.

    Only rows that may share a doc_id with a dropped row take part in the join; the others pass straight through.
    """
    flagged = durable(exact_duplicates(docs))
    maybe, sure = split_by_keys(docs, "doc_id", bloom(flagged.where("not kept"), "doc_id"))
    own, digest = fresh(docs, "kept_id"), fresh(docs, "kept_digest")
    kept = flagged.where("kept").select(F.col("doc_id").alias(own), F.col("text_sha256").alias(digest))
    name = fresh(docs, "sha")
    text = F.coalesce(F.make_valid_utf8("text"), F.lit(""))
    maybe = maybe.withColumn(name, F.sha2(F.translate(text, _UPPER, _UPPER.lower()), 256))
    out = maybe.join(kept, maybe["doc_id"].eqNullSafe(kept[own]) & (maybe[name] == kept[digest]), "left_semi")
    out = out.dropDuplicates(["doc_id", name]).drop(name)
    return out if sure is None else out.unionByName(sure)
