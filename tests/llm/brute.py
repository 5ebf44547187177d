"""Plain versions of the operators, and awkward documents to run both on."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def documents(seed: int = 7) -> list[tuple]:
    """Nulls, empty and long texts, copies, near copies, shared passages, ties of case and white space."""
    r = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa straße été año 日本 l'eau x1 -- Ünder".split()
    prose = lambda n: " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(n))
    passage, base = prose(60), prose(150)
    texts = [None, "", "   \n\t", "one", "two words", "a b c d e", "A B C D E", "x" * 5000, "!!! 123 ---", prose(3000)]
    texts += [base, base.upper(), base, base + " tail", base.replace("alpha", "ALPHA")]
    for k in range(12):  # near copies that differ from one another
        near = base.split()
        near[10 * k + 5] = f"changed{k}"
        texts.append(" ".join(near))
    texts += [prose(30) + "\n" + passage + "\n" + prose(40) for _ in range(6)]
    texts += [prose(25) + " " + " ".join(passage.split()[15:45]) + " " + prose(10), passage + " " + passage]
    texts += [("the same line of text\n" * 30).strip(), "line one is here today\nline one is here todey\nsomething else entirely", "line one is hers today\n\nshort\nshort\nshorts"]
    texts += [prose(r.randrange(1, 120)) for _ in range(30)]
    ids = r.sample(range(10_000), len(texts))
    langs = ["en", "fr", None, "de"]
    return [(i, t, langs[k % 4], f"s{k % 3}" if k % 5 else None, len(t or "")) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def exact(rows: list[tuple]) -> dict[int, tuple]:
    groups: dict[str, list[int]] = {}
    for i, t, *_ in rows:
        groups.setdefault(lower(t or ""), []).append(i)
    return {i: (max(g), len(g), i == max(g), sha(t)) for t, g in groups.items() for i in g}


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    w = WORD.findall(lower(text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def similar(rows: list[tuple]) -> dict[int, tuple]:
    sets = {i: shingles(t) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeats(rows: list[tuple], n: int = 20) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda x: x[0]):
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            if key in seen:
                gone.update(range(k, k + n))
            seen.add(key)
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), sha(" ".join(kept)))
    return out


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines(rows: list[tuple], edits: int = 2, least: int = 20) -> dict[int, tuple]:
    first: dict[str, tuple] = {}
    for i, t, *_ in sorted(rows, key=lambda x: x[0]):
        for k, line in enumerate((t or "").split("\n")):
            if re.search(r"[^ \t\n\x0b\f\r]", line):
                first.setdefault(line, (i, k))
    names = list(first)
    parent = {x: x for x in names}

    def root(x: str) -> str:
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[root(a)] = root(b)
    stays: dict[str, tuple] = {}
    for x in names:
        stays[root(x)] = min(first[x], stays.get(root(x), first[x]))
    out = {}
    for i, t, *_ in rows:
        kept, n, gone = [], 0, 0
        for k, line in enumerate((t or "").split("\n")):
            counted = line in first
            n += counted
            if counted and stays[root(line)] != (i, k):
                gone += 1
            else:
                kept.append(line)
        out[i] = (n, gone, sha("\n".join(kept)))
    return out


def crc(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def hash64(*values) -> int:
    """Spark's xxhash64 of texts, long and (given as a tuple of one) int numbers, as an unsigned number."""
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def order_minhash(text: str, k: int = 3, buckets: int = 64, each: int = 2, bits: int = 37) -> dict[int, int]:
    """For each bucket in use the hash of its tuple."""
    if len(text) <= 64:
        tokens = [c for c in text if c not in " \t\n\x0b\x0c\r"]
    else:
        tokens = []
        for run in re.findall("[\u3040-\u30ff\u4e00-\u9fff]|[^ \t-\r\u3040-\u30ff\u4e00-\u9fff]+", text):
            while len(run) > 24:
                tokens.append(run[0])
                run = run[1:]
            tokens.append(run)
    if not tokens:
        return {}
    h = [hash64(t) for t in tokens]
    signed = [x - (1 << 64) if x >> 63 else x for x in h]
    kmers = [hash64(*signed[i : i + k]) >> 64 - bits for i in range(max(len(h) - k, 0) + 1)]
    seen: dict[int, int] = {}
    numbered = []
    for at, x in enumerate(kmers):
        n = seen[x] = seen.get(x, -1) + 1
        numbered.append((hash64(x, (n,)) >> 64 - bits if n else x, at))
    chosen: dict[int, list] = {}
    for x, at in sorted(numbered):
        mine = chosen.setdefault(x >> bits - buckets.bit_length() + 1, [])
        if len(mine) < each:
            mine.append((at, x))
    return {b: hash64(*[x for _, x in sorted(mine)]) & 0xFFFFFFFF for b, mine in chosen.items()}


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    used = set(a) | set(b)
    return sum(x in a and x in b and a[x] == b[x] for x in used) / len(used) if used else 1.0


def language(rows: list[tuple], order: int = 3, evidence: float = 8.0) -> dict[int, tuple]:
    """(held out, label, score) by prediction by partial matching, byte after byte."""

    def lower_bytes(text: str) -> bytes:
        return text.encode().lower()

    def held(i) -> bool:
        return i is not None and zlib.crc32(str(i).encode()) % 3 == 1

    trees: dict[str, dict] = {}
    for i, t, lang, *_ in rows:
        if t is not None and lang is not None and i is not None and not held(i):
            tree, raw = trees.setdefault(lang, {}), b"\n" * order + lower_bytes(t)
            for at in range(order, len(raw)):
                for n in range(order + 1):
                    d = tree.setdefault(raw[at - n : at], {})
                    d[raw[at]] = d.get(raw[at], 0) + 1

    def bits(tree: dict, raw: bytes) -> float:
        out, raw = 0.0, b"\n" * order + raw
        for at in range(order, len(raw)):
            for n in range(order, -1, -1):
                d = tree.get(raw[at - n : at])
                if d:
                    total = sum(d.values()) + len(d)
                    if raw[at] in d:
                        out += math.log2(total / d[raw[at]])
                        break
                    out += math.log2(total / len(d))
            else:
                out += 8.0
        return out

    found = {}
    for i, t, *_ in rows:
        if not trees or not any(c.isalpha() for c in t or ""):
            found[i] = (held(i), "und", 0.0)
            continue
        lengths = {lang: bits(tree, lower_bytes(t)) for lang, tree in sorted(trees.items())}
        best = min(lengths, key=lengths.get)
        found[i] = (held(i), best, 1 / sum(2 ** ((lengths[best] - x) / evidence) for x in lengths.values()))
    return found
