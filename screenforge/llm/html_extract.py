"""HTML extraction by wrapper induction.

1. Every page becomes a tree of its block elements; runs of like siblings (paragraphs, list items) fold into one node.
2. For each host, all different trees are aligned by simple tree matching and merged into one template tree.
   Every page of the host, whatever its tree, is then aligned with that template, so that its blocks fall into slots.
3. Over all pages of the host (true copies, of the same tree and texts, count once), a slot whose texts mostly repeat is
   constant: it is part of the template.  So is a text that stands on half the pages that fill its slot, whatever else
   the slot holds (a notice among paragraphs).  Varying blocks are content.
4. A page's text is what stands in varying blocks, inside an article or main element or not, and not under an element
   that says by its tag, class or id that it is something else (menu, footer, advert, form, ...).
   An article or main element is evidence on top: a slot inside is constant only if each of its texts stands there
   LEAST_TEXTS times on average, as articles may quote one another; and on a page most of whose text it holds, blocks
   outside whose slots have too few texts to tell are not content.
   Words of a class or id (not tags, roles and the hidden attribute) are ignored on an element that holds most of the
   page's longest article or, without any article, all blocks that vary, and where nothing else would be left.

A host's trees may be many: about MOST_TREES at a time are merged to partial templates, and these likewise, until one is
left, in which every node of every tree has its slot.  Where layouts differ so much that a slot has few texts, a text on
half the host's pages is still part of the template.

Defined results: null or blank html gives an empty text; text outside any element is a block; pages cut short end
there; null url is a host of its own; a page with no block left by step 3 keeps what the other steps leave, of its
article or main element if that holds any; elements count at any depth; every row gives one row, with a null or repeated
page_id too (true copies count once for the template); an empty table gives no rows; very long pages are read whole; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, record, tidy

#: Trees of a host that are merged in one go, on average.
MOST_TREES = 48
#: A slot needs so many texts before it can be called constant.
LEAST_TEXTS = 6
#: It is constant if its different texts are at most this share of its texts; a text is if it stands on that share of pages.
CONSTANT = 0.5
#: Stands for all slots of a host.
ANYWHERE = -1
#: The table of templates is broadcast up to so many bytes, and joined beyond.
MOST_BROADCAST = 32 << 20

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)>?""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: What a start tag closes when it is open in the same scope.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"), "body": ("head",),
}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}
_KEEPS_P = _INLINE | {"br", "img", "input", "wbr", "button", "select", "option", "optgroup", "svg", "object", "video", "audio", "canvas", "map", "area"}
_NOT_CONTENT = frozenset("head nav footer aside form menu dialog button select option optgroup datalist fieldset svg object canvas audio video applet map".split())
_NOT_CONTENT_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
    breadcrumb breadcrumbs sidebar footer masthead comment comments disqus respond cookie cookies consent gdpr notice popup modal
    overlay newsletter subscribe subscription signup share sharing social related recommended widget pagination pager toolbar""".split()
)
_ROOT_WORDS = frozenset(["header"])


class Node:
    """An element of a folded tree."""

    __slots__ = ("label", "parent", "children", "cursor", "id")

    def __init__(self, label: str, parent: Node | None) -> None:
        self.label, self.parent, self.children, self.cursor, self.id = label, parent, [], 0, -1

    def child(self, label: str) -> Node:
        """The child for the next element so labelled: that of the run it continues, a later one, or a new one."""
        kids = self.children
        if self.cursor and kids[self.cursor - 1].label == label:
            found = kids[self.cursor - 1]
        else:
            for k in range(self.cursor, len(kids)):
                if kids[k].label == label:
                    self.cursor, found = k + 1, kids[k]
                    break
            else:
                found = Node(label, self)
                kids.insert(self.cursor, found)
                self.cursor += 1
        found.cursor = 0
        return found


def _walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed(node.children))


def number(root: Node) -> list[Node]:
    nodes = list(_walk(root))
    for k, node in enumerate(nodes):
        node.id = k
    return nodes


def written(root: Node) -> str:
    """A tree as text: each node in preorder as its depth and label."""
    out, stack = [], [(root, 0)]
    while stack:
        node, depth = stack.pop()
        out.append(f"{depth} {node.label}")
        stack.extend((c, depth + 1) for c in reversed(node.children))
    return "\n".join(out)


def read(text: str) -> Node:
    path: list[Node] = []
    for line in text.split("\n"):
        depth, _, label = line.partition(" ")
        del path[int(depth) :]
        node = Node(label, path[-1] if path else None)
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]


def matched(a: Node, b: Node) -> dict[int, int]:
    """Simple tree matching: the largest order- and ancestry-keeping map of numbered nodes of a to those of b."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}  # matched nodes, and matched pairs of children
    if a.label != b.label:
        return {}
    # Pairs of nodes with the same label, each after all pairs of their children.
    order, stack, known = [], [(a, b)], {(a.id, b.id)}
    while stack:
        x, y = stack.pop()
        order.append((x, y))
        places = _by_label(y.children)
        for child in x.children:
            for j in places.get(child.label, ()):
                pair = (child, y.children[j])
                if (child.id, pair[1].id) not in known:
                    known.add((child.id, pair[1].id))
                    stack.append(pair)
    for x, y in reversed(order):
        m, n = len(x.children), len(y.children)
        best = np.zeros((m + 1, n + 1), np.int32)
        places = _by_label(y.children)
        for i, child in enumerate(x.children):
            best[i + 1] = best[i]
            for j in places.get(child.label, ()):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i, j] + memo[child.id, y.children[j].id][0])
            np.maximum.accumulate(best[i + 1], out=best[i + 1])
        pairs, i, j = [], m, n
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((x.children[i], y.children[j]))
        memo[x.id, y.id] = (1 + int(best[m, n]), pairs)

    out: dict[int, int] = {}
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        out[x.id] = y.id
        stack.extend(memo[x.id, y.id][1])
    return out


def _by_label(nodes: list[Node]) -> dict[str, list[int]]:
    places: dict[str, list[int]] = {}
    for k, node in enumerate(nodes):
        places.setdefault(node.label, []).append(k)
    return places


def merged(trees: list[str]) -> str:
    """One template tree from several, each aligned with what the ones before have built."""
    template = read(trees[0])
    for text in trees[1:]:
        tree = read(text)
        nodes, mine = number(template), number(tree)
        at = matched(tree, template)

        def graft(node: Node, parent: Node, place: int) -> None:
            top = Node(node.label, parent)
            parent.children.insert(place, top)
            stack = [(node, top)]
            while stack:
                node, new = stack.pop()
                new.children = [Node(kid.label, new) for kid in node.children]
                stack.extend(zip(node.children, new.children, strict=True))

        for node in mine:
            if node.id in at:
                here, place = nodes[at[node.id]], 0
                for kid in node.children:
                    if kid.id in at:
                        place = here.children.index(nodes[at[kid.id]]) + 1
                    else:
                        graft(kid, here, place)
                        place += 1
    return written(template)


def _label(tag: str, attributes: str) -> str:
    if not attributes:
        return tag
    names: list[str] = []
    for m in _ATTRIBUTE.finditer(attributes):
        kind = m[1].lower()
        if kind == "hidden":
            names.append("!hidden")
        elif kind in ("class", "id", "role"):
            value = m[2] or m[3] or m[4] or ""
            names += [("@" if kind == "role" else "") + w.lower() for w in _WORD.findall(value)]
    return f"{tag}.{'.'.join(names)}" if names else tag


_COMMENT_WORDS = frozenset(["comment", "comments"])
_OTHER_ROLES = frozenset("@navigation @banner @complementary @contentinfo @search @form @dialog @alert".split())


def _is_article(label: str) -> bool:
    return label.split(".")[0] in ("article", "main") or ".@main" in label


def _says_other(label: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is something else than content by its tag, role or hidden attribute, and by the words of its class
    and id; inside: of an article or main element."""
    tag, *words = label.split(".")
    if tag in _NOT_CONTENT or tag == "header" and not inside:
        return True, False
    if tag in ("html", "body", "article", "main") and not set(words) & _COMMENT_WORDS:
        return False, False
    return any(w == "!hidden" or w in _OTHER_ROLES for w in words), any(w in _NOT_CONTENT_WORDS or not inside and w in _ROOT_WORDS for w in words)


class Page:
    """Blocks of a page, in order: texts, the folded node of each, and the number of its article or main element (0: none)."""

    __slots__ = ("root", "blocks", "articles")

    def __init__(self, html: str) -> None:
        self.root = Node("", None)
        self.blocks: list[tuple[Node, str]] = []
        self.articles: list[int] = []
        open_: list[tuple[str, Node, int]] = [("", self.root, 0)]  # block elements only
        held: Counter = Counter()  # open elements by tag
        seen = 0
        pieces: list[str] = []

        def flush() -> None:
            if pieces:
                text = "".join(pieces)
                pieces.clear()
                text = " ".join((unescape(text) if "&" in text else text).split())
                if text:
                    self.blocks.append((open_[-1][1], text))
                    self.articles.append(open_[-1][2])

        def close(k: int) -> None:
            flush()
            for tag, _, _ in open_[k:]:
                held[tag] -= 1
            del open_[k:]

        at, end = 0, len(html)
        while at < end:
            m = _TAG.search(html, at)
            if m is None:
                pieces.append(html[at:])
                break
            if m.start() > at:
                pieces.append(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in _INLINE:
                    continue
                k = len(open_) - 1 if held[tag] else 0
                while k and open_[k][0] != tag:
                    k -= 1
                if k:
                    close(k)
                continue
            if tag in _RAW:
                finish = re.compile(f"</{tag}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(html, at)
                at = finish.end() if finish else end
                if tag not in ("script", "style"):
                    flush()
                continue
            if tag == "br":
                pieces.append(" ")
                continue
            if tag in _INLINE or tag in _VOID and tag != "hr":
                continue
            flush()
            if tag not in _KEEPS_P and open_[-1][0] == "p":
                close(len(open_) - 1)
            closes, scope = _CLOSES.get(tag, ()), _SCOPES.get(tag, ())
            for k in range(len(open_) - 1, 0, -1) if any(held[x] for x in closes) else ():
                if open_[k][0] in scope:
                    break
                if open_[k][0] in closes:
                    close(k)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
            if tag == "hr":
                continue
            node = open_[-1][1].child(_label(tag, m[3]))
            if tag not in _VOID and not m[3].endswith("/"):
                article = open_[-1][2]
                if _is_article(node.label) and not _COMMENT_WORDS.intersection(node.label.split(".")):
                    article = seen = seen + 1
                open_.append((tag, node, article))
                held[tag] += 1
        flush()


class Wrapper:
    """What a host's slots are: constant ones, firm ones (constant inside an article too), known ones, and constant texts."""

    __slots__ = ("constant", "firm", "known", "texts")

    def __init__(self, text: str | None = None) -> None:
        held = json.loads(text) if text else {}
        self.constant, self.firm, self.known = (set(held.get(k) or ()) for k in ("constant", "firm", "known"))
        self.texts = {(x["slot"], x["text"]) for x in held.get("texts") or ()}

    def repeats(self, slot: int | None, text: str, inside: bool) -> bool:
        """Whether a block is part of the template; inside: of an article or main element."""
        if slot in (self.firm if inside else self.constant):
            return True
        mark = _mark(text) if self.texts else 0
        return (slot, mark) in self.texts or (ANYWHERE, mark) in self.texts


def _misnamed(blocks: list[tuple], of) -> set[int]:
    """Elements whose words say that they are something else, but which hold most of the page's longest article or, without
    any article, all blocks.  blocks: (node, slot, text, inside, article), those of the template left out."""
    size: Counter = Counter()
    for *_, text, _, article in blocks:
        size[article] += len(text)
    del size[0]
    longest = min(size, key=lambda k: (-size[k], k), default=0)
    held: Counter = Counter()
    for node, _, text, _, article in blocks:
        if article == longest:
            for k in of(node)[2]:
                held[k] += len(text)
    whole = sum(len(b[2]) for b in blocks)
    return {k for k, n in held.items() if (2 * n > size[longest] if longest else n == whole)}


def _content(page: Page, slot_of: dict[int, int], wrapper: Wrapper) -> list[str]:
    """The texts of a numbered page's content blocks."""
    state: dict[int, tuple[bool, bool, tuple]] = {}  # (something else, inside an article or main element, elements that words call something else)

    for node in _walk(page.root):  # parents come first
        if node.parent is None:
            state[node.id] = (False, False, ())
        else:
            other, inside, named = state[node.parent.id]
            mine, words = _says_other(node.label, inside)
            state[node.id] = (other or mine, inside or _is_article(node.label), (*named, node.id) if words else named)

    def of(node: Node) -> tuple[bool, bool, tuple]:
        return state[node.id]

    blocks = [(node, slot_of.get(node.id), text, of(node)[1], article) for (node, text), article in zip(page.blocks, page.articles, strict=True) if not of(node)[0]]
    fit = blocks
    if any(of(b[0])[2] for b in blocks):
        own = [b for b in blocks if not wrapper.repeats(*b[1:4])] or blocks
        misnamed = _misnamed(own, of)
        fit = [b for b in blocks if misnamed.issuperset(of(b[0])[2])] or own
    varying = [b for b in fit if not wrapper.repeats(*b[1:4])]
    if not varying:
        varying = [b for b in fit if b[3]] or fit
    inside = sum(len(b[2]) for b in varying if b[3])
    if 2 * inside >= sum(len(b[2]) for b in varying) > 0:
        varying = [b for b in varying if b[3] or b[1] in wrapper.known]
    return [b[2] for b in varying]


_PARSED = pa.schema([("host", pa.string()), ("tree", pa.string()), ("copy", pa.int64()), ("nodes", pa.list_(pa.int32())), ("texts", pa.list_(pa.int64()))])
_SLOTS = pa.schema([("host", pa.string()), ("slot", pa.int32()), ("text", pa.int64()), ("times", pa.int64())])


def _mark(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _parse(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        out: dict[str, list] = {f.name: [] for f in _PARSED}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            page = Page(html.as_py())
            number(page.root)
            out["host"].append(host)
            out["tree"].append(written(page.root))
            out["nodes"].append([n.id for n, _ in page.blocks])
            out["texts"].append([_mark(t) for _, t in page.blocks])
            out["copy"].append(_mark(repr([out[x][-1] for x in ("tree", "nodes", "texts")])))
        yield record(out, _PARSED)
        tidy()


class Aligner:
    """Slots of trees in templates, remembered."""

    def __init__(self) -> None:
        self.held: dict[tuple[str, str], dict[int, int]] = {}

    def slots(self, tree: str, template: str) -> dict[int, int]:
        key = (tree, template)
        if key not in self.held:
            if len(self.held) > 5000:
                self.held.clear()
            a, b = read(tree), read(template)
            number(a), number(b)
            self.held[key] = matched(a, b)
        return self.held[key]


def _slots(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner = Aligner()
    for batch in stream:
        out: dict[str, list] = {f.name: [] for f in _SLOTS}
        for host, tree, nodes, texts, template in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            slot = aligner.slots(tree, template)
            here = Counter((slot[node], text) for node, text in zip(nodes, texts, strict=True) if node in slot)
            here.update((ANYWHERE, text) for text in texts)
            for (k, text), times in [*here.items(), *(((k, None), 0) for k in {k for k, _ in here})]:  # null: the page itself
                out["host"].append(host)
                out["slot"].append(k)
                out["text"].append(text)
                out["times"].append(times)
        yield record(out, _SLOTS)


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", F.coalesce(F.make_valid_utf8("html"), F.lit("")).alias("html"), host.alias("host"))


def _small(table: DataFrame, text: str) -> DataFrame:
    """table, to be broadcast if its measured size allows it."""
    size = table.agg(F.coalesce(F.sum(F.octet_length(text) + 100), F.lit(0))).first()[0]
    return F.broadcast(table) if size <= MOST_BROADCAST else table


def _templates(trees: DataFrame) -> DataFrame:
    """host, template: all trees (host, tree, count) of each host merged, batch by batch and then the batches' templates."""

    def induce(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("count").to_pylist(), table.column("tree").to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
        return pa.table({"host": table.column("host")[:1], "tree": pa.array([merged([r[1] for r in rows])]), "count": pa.array([sum(r[0] for r in rows)])})

    trees, most = durable(trees), MOST_TREES + 1
    while most > MOST_TREES:
        sizes = durable(trees.groupBy("host").agg(F.count("*").alias("trees")))
        most = sizes.agg(F.coalesce(F.max("trees"), F.lit(0))).first()[0]
        dealt = trees.join(sizes, "host").withColumn("batch", F.pmod(F.xxhash64("tree"), F.ceil(F.col("trees") / MOST_TREES)))
        trees = durable(dealt.groupBy("host", "batch").applyInArrow(induce, "host string, tree string, count long"))
    return trees.select("host", F.col("tree").alias("template"))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, template, wrapper: each host's template tree and, as JSON, what its slots are."""
    parsed = durable(_with_host(pages).select("host", "html").mapInArrow(_parse, "host string, tree string, copy long, nodes array<int>, texts array<long>").dropDuplicates(["host", "copy"]))
    templates = _templates(parsed.groupBy("host", "tree").count())
    slots = parsed.join(_small(templates, "template"), "host").select("host", "tree", "nodes", "texts", "template")
    texts = slots.mapInArrow(_slots, "host string, slot int, text long, times long").groupBy("host", "slot", "text")
    texts = durable(texts.agg(F.sum("times").alias("n"), F.count("*").alias("pages")))
    known = texts.groupBy("host", "slot").agg(F.sum("n").alias("n"), F.count("text").alias("different"), F.max(F.when(F.col("text").isNull(), F.col("pages"))).alias("all"))
    known = durable(known.where(F.col("n") >= LEAST_TEXTS))
    common = texts.where(F.col("text").isNotNull() & (F.col("pages") >= LEAST_TEXTS)).select("host", "slot", "text", "pages")
    common = common.join(known, ["host", "slot"]).where(F.col("pages") >= CONSTANT * F.col("all"))
    common = common.groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("texts"))
    kinds = known.groupBy("host").agg(
        F.collect_list(F.when(F.col("different") <= CONSTANT * F.col("n"), F.col("slot"))).alias("constant"),
        F.collect_list(F.when(F.col("different") * LEAST_TEXTS <= F.col("n"), F.col("slot"))).alias("firm"),
        F.collect_list("slot").alias("known"),
    )
    kinds = kinds.join(common, "host", "left").select("host", F.to_json(F.struct("constant", "firm", "known", "texts")).alias("wrapper"))
    return durable(templates.join(kinds, "host", "left"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def extract(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, wrappers_of = Aligner(), {None: Wrapper()}
        for batch in stream:
            out: dict[str, list] = {f.name: [] for f in schema}
            for page_id, url, html, template, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = Page(html)
                number(page.root)
                slot = aligner.slots(written(page.root), template) if wrapper else {}
                if wrapper not in wrappers_of:
                    if len(wrappers_of) > 1000:
                        wrappers_of = {}
                    wrappers_of[wrapper] = Wrapper(wrapper)
                text = "\n".join(_content(page, slot, wrappers_of[wrapper]))
                out["page_id"].append(page_id)
                out["url"].append(url)
                out["text"].append(text)
                out["n_chars"].append(len(text))
            yield record(out, schema)
            tidy()

    joined = _with_host(pages).join(_small(wrappers(pages), "template"), "host", "left")
    return joined.select("page_id", "url", "html", "template", "wrapper").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
