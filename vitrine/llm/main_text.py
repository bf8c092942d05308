"""Main text of web pages by wrapper induction.

The pages of a host are aligned, tree against tree, by slot path: the kinds of
element from the root down to a node.  Nodes whose text is the same at the same
path on nearly all pages are the host's template, what varies is their content.
A page's main text is what its varying nodes hold, less those that are named as
menus, adverts and the like.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import stored

EVIDENCE_PAGES = 3
CONSTANT_SHARE = 0.9
PAGE = 0  # the key that stands for the page itself

# Elements and names that HTML itself or common usage gives to what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = set(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article "
    "main aside nav header footer form fieldset blockquote pre figure figcaption hr address details summary "
    "dialog menu center option select".split()
)
HIDDEN = set(
    "head script style title noscript iframe noembed noframes template textarea nav aside footer form button "
    "select input svg canvas object embed audio video map dialog menu math".split()
)
HIDDEN_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
HIDDEN_NAMES = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar sidenav footer masthead comment comments respond disqus cookie cookies "
    "consent gdpr notice popup modal overlay newsletter subscribe share sharing social related recommended "
    "pagination pager widget login signup search skip".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "thead": {"tr", "td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = set("table ul ol dl select article section div body html".split())
_P_STOPS = SCOPES | {"li", "td", "th"}
_STOPS = {tag: SCOPES - {tag} for tag in CLOSES}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Node:
    """An element; children are elements and strings."""

    tag: str
    names: str = ""
    role: str = ""
    children: list = field(default_factory=list)


def parse(text: str) -> Node:
    """A tree of any input, of any depth: missing end tags are implied, stray ones ignored."""
    root = Node("html")
    stack = [root]
    open_tags: Counter[str] = Counter()
    at, size = 0, len(text)
    while at < size:
        token = _TOKEN.search(text, at)
        if token is None:
            stack[-1].children.append(html.unescape(text[at:]))
            break
        if token.start() > at:
            stack[-1].children.append(html.unescape(text[at : token.start()]))
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if token[1]:
            _close(stack, open_tags, {tag}, set())
            continue
        if tag in ("html", "body") and open_tags[tag]:
            continue
        if tag in BLOCKS:
            _close(stack, open_tags, {"p"}, _P_STOPS)
        if tag in CLOSES:
            _close(stack, open_tags, CLOSES[tag], _STOPS[tag])
        if tag in BLOCKS and stack[-1].tag == "head":
            open_tags[stack.pop().tag] -= 1
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(token[3])} if token[3] else {}
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip().lower()
        node = Node(tag, names, attributes.get("role", "").lower())
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(text, at)
            at = end.end() if end else size
        elif tag not in VOID:
            stack.append(node)
            open_tags[tag] += 1
    return root


def _close(stack: list[Node], open_tags: Counter[str], tags: set[str], stop: set[str]) -> None:
    """Ends the nearest open element of ``tags``, unless one of ``stop`` is in between."""
    if not any(open_tags[tag] for tag in tags):
        return
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            for node in stack[depth:]:
                open_tags[node.tag] -= 1
            del stack[depth:]
            return
        if stack[depth].tag in stop:
            return


def is_hidden(node: Node, in_article: bool) -> bool:
    """Whether an element is by its kind or name no part of an article."""
    key = node.tag, node.names, node.role, in_article
    if key not in _JUDGED:
        if len(_JUDGED) >= 4096:
            _JUDGED.clear()
        _JUDGED[key] = _is_hidden(*key)
    return _JUDGED[key]


_JUDGED: dict[tuple, bool] = {}  # no lru_cache: a function in one doesn't travel to executors by value


def _is_hidden(tag: str, names: str, role: str, in_article: bool) -> bool:
    if tag in HIDDEN or role in HIDDEN_ROLES or (tag == "header" and not in_article):
        return True
    if names and tag not in ("html", "body", "main"):
        named = _NAME_PARTS.split(names)
        return not HIDDEN_NAMES.isdisjoint(named) or ("header" in named and not in_article)
    return False


# --- trees for matching: runs of siblings of one kind become one slot --------------------


@dataclass
class Slot:
    """Consecutive siblings of one kind; ``inner`` are the slots within a single sibling."""

    kind: str
    nodes: list[Node]
    prints: list[int]
    inner: list[Slot]


def prints_of(root: Node) -> dict[int, int]:
    """By id() of each element, a fingerprint of its text with white space collapsed, 0 if there is none.

    All are differences of one running polynomial hash modulo 2^64 of the
    page's text, so that the depth of a page does not count.
    """
    pieces: list[str] = []
    at, ids, starts, ends = 0, [], [], []
    stack = [(iter(root.children), -1)]
    while stack:
        children, number = stack[-1]
        for child in children:
            if isinstance(child, str):
                pieces.append(child)
                at += len(child)
                continue
            if child.tag in RAW:
                continue
            if child.tag in BLOCKS or child.tag == "br":
                pieces.append(" ")
                at += 1
            ids.append(id(child))
            starts.append(at)
            ends.append(at)
            if child.children:
                stack.append((iter(child.children), len(ids) - 1))
                break
        else:
            stack.pop()
            if number >= 0:
                ends[number] = at
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "replace"), np.uint32)
    blank = _BLANK[np.minimum(codes, len(_BLANK) - 1)]
    black = np.flatnonzero(~blank)
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # of a run of blanks the first one
    place = np.concatenate(([0], np.cumsum(kept)))
    values = np.where(blank, 32, codes)[kept].astype(np.uint64) * _FACTOR
    values ^= values >> np.uint64(29)
    powers, inverse = _powers(len(values))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers[: len(values)], dtype=np.uint64)))
    first, last = np.searchsorted(black, starts), np.searchsorted(black, ends) - 1
    some = np.flatnonzero(first <= last)
    a, b = place[black[first[some]]], place[black[last[some]]] + 1
    found = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
    found = (found ^ found >> np.uint64(32)) * _FACTOR
    out = np.zeros(len(ids), np.uint64)
    out[some] = found ^ found >> np.uint64(29) | np.uint64(1)
    return dict(zip(ids, out.tolist(), strict=True))


_BLANK = np.array([chr(c).isspace() for c in range(0x3002)])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_HELD_POWERS = 1 << 16
_HELD: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``count`` of each."""
    if count > _HELD_POWERS:
        return _powers_made(count)
    if not _HELD:
        _HELD.append(_powers_made(_HELD_POWERS))
    return _HELD[0]


def _powers_made(count: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(count, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def slots_of(node: Node) -> list[Slot]:
    prints = prints_of(node)
    out: list[Slot] = []
    todo = [(node, out)]
    while todo:
        parent, slots = todo.pop()
        for child in parent.children:
            if isinstance(child, str) or child.tag in RAW or child.tag in VOID:
                continue
            kind = f"{child.tag}|{child.names}"
            if not slots or slots[-1].kind != kind:
                slots.append(Slot(kind, [], [], []))
            slots[-1].nodes.append(child)
            slots[-1].prints.append(prints[id(child)])
        todo.extend((slot.nodes[0], slot.inner) for slot in slots if len(slot.nodes) == 1)
    return out


def keyed(root: Node) -> Iterator[tuple[int, Node]]:
    """Elements that have text and aren't hidden, each with a 64-bit key of its slot path and text.

    Inside a slot of several siblings only the siblings themselves are looked at.
    """
    todo = [(slots_of(root), 0)]
    while todo:
        slots, above = todo.pop()
        for slot in slots:
            path = (above ^ zlib.crc32(slot.kind.encode("utf-8", "replace"))) * 0x9E3779B97F4A7C15 + 1 & _ALL
            path ^= path >> 29
            for node, own in zip(slot.nodes, slot.prints, strict=True):
                if own and not is_hidden(node, True):
                    key = (path ^ own) * _BASE & _ALL
                    yield (key ^ key >> 32) - (1 << 63), node
                    if slot.inner:
                        todo.append((slot.inner, path))


_ALL = (1 << 64) - 1


def match(page: list[Slot], reference: list[Slot]) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: the largest order-keeping matching of two forests.

    Slots match if their kinds are equal; a match counts one, and the matching
    of what is inside them.  Matched slots have the same path, so that ``keyed``
    finds all that this finds; it recurses and is for two pages of usual depth.
    """
    rows, columns = len(page), len(reference)
    if not rows or not columns:
        return 0, []
    inner: dict[tuple[int, int], tuple[int, list]] = {}
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i in range(1, rows + 1):
        for j in range(1, columns + 1):
            score = max(best[i - 1][j], best[i][j - 1])
            if page[i - 1].kind == reference[j - 1].kind:
                found = match(page[i - 1].inner, reference[j - 1].inner)
                inner[i, j] = found
                score = max(score, best[i - 1][j - 1] + 1 + found[0])
            best[i][j] = score
    pairs, i, j = [], rows, columns
    while i and j:
        if (i, j) in inner and best[i][j] == best[i - 1][j - 1] + 1 + inner[i, j][0]:
            pairs.append((page[i - 1], reference[j - 1]))
            pairs.extend(inner[i, j][1])
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[rows][columns], pairs


# --- text --------------------------------------------------------------------------------


def main_blocks(root: Node, template: set[int]) -> list[str]:
    """Blocks of text in page order, without hidden and template elements (``template`` holds their id())."""
    bodies = _articles(root) or [root]
    out: list[str] = []
    for body in bodies:
        _collect(body, body is not root, template, out)
    return out


def _articles(node: Node) -> list[Node]:
    """The outermost article elements, or the main element if there are none."""
    return list(_outermost(node, {"article"})) or list(_outermost(node, {"main"}))


def _outermost(node: Node, tags: set[str]) -> Iterator[Node]:
    stack = [iter(node.children)]
    while stack:
        for child in stack[-1]:
            if isinstance(child, str) or is_hidden(child, True):
                continue
            if child.tag in tags or (child.role == "main" and "main" in tags):
                yield child
            else:
                stack.append(iter(child.children))
                break
        else:
            stack.pop()


def _flush(parts: list[str], out: list[str]) -> None:
    text = " ".join("".join(parts).split())
    parts.clear()
    if text:
        out.append(text)


def _collect(body: Node, in_article: bool, template: set[int], out: list[str]) -> None:
    parts: list[str] = []
    chars: dict[int, tuple[int, int]] = {}
    stack = [(iter(body.children), in_article, True)]
    while stack:
        children, within, ends_block = stack[-1]
        for child in children:
            if isinstance(child, str):
                parts.append(child)
                continue
            if child.tag == "br":
                parts.append(" ")
                continue
            block = child.tag in BLOCKS
            if block:
                _flush(parts, out)
            if id(child) in template or is_hidden(child, within) or (not within and _is_link_list(child, chars)):
                continue
            stack.append((iter(child.children), within or child.tag in ("article", "main"), block))
            break
        else:
            stack.pop()
            if ends_block:
                _flush(parts, out)


def _is_link_list(node: Node, chars: dict[int, tuple[int, int]]) -> bool:
    """A list most of whose text is links: a menu without a name.  ``chars`` keeps the counts of lists inside."""
    if node.tag not in ("ul", "ol", "table"):
        return False
    if id(node) not in chars:
        _link_chars(node, chars)
    links, total = chars[id(node)]
    return total > 0 and links >= 0.8 * total


def _link_chars(node: Node, chars: dict[int, tuple[int, int]]) -> None:
    """Characters in links and in all, of an element and each in it."""
    stack = [(node, iter(node.children), [0, 0])]
    while stack:
        own, children, counts = stack[-1]
        for child in children:
            if isinstance(child, str):
                counts[1] += len("".join(child.split()))
            elif child.tag not in RAW:
                stack.append((child, iter(child.children), [0, 0]))
                break
        else:
            stack.pop()
            links, total = counts
            if own.tag in ("ul", "ol", "table"):
                chars[id(own)] = links, total
            if stack:
                stack[-1][2][0] += total if own.tag == "a" else links
                stack[-1][2][1] += total


# --- jobs --------------------------------------------------------------------------------


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html; other columns are not read).

    Blocks are joined by one \\n, white space inside a block is one blank,
    character references are decoded.  A null or empty html gives "".  Pages
    without a url or host form a host of their own.  All pages of a host are
    evidence for its template, whichever layout each has: an element counts once
    for each page that has its text at its slot path, and is template if
    CONSTANT_SHARE of the pages have it.  Pages whose open text (the text without
    any template) is the same in whole are copies and count as one.  A host with
    no more than EVIDENCE_PAGES different pages has no template, so that only
    kinds and names tell its article.  Repeated rows are extracted alike; an
    empty table gives an empty result.

    Evidence travels as one 64-bit key an element, added up before and after the
    shuffle.  Templates are one small row per host.  Spark joins them by
    broadcast while they are below its threshold and otherwise by a shuffle,
    where it can split a host that holds many pages.
    """
    pages = pages.select("page_id", "url", "html", _host().alias("host"))
    different = (
        pages.select("host", "html")
        .mapInArrow(_evidence, "host string, open long, keys array<long>")
        .groupBy("host", "open")
        .agg(F.min("keys").alias("keys"))
    )
    evidence = (
        different.select("host", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") > EVIDENCE_PAGES)  # less is no template of any host
    )
    evidence = stored(evidence, "evidence")
    counted = evidence.filter(F.col("key") == PAGE).select("host", F.col("pages").alias("all_pages"))
    templates = (
        evidence.filter(F.col("key") != PAGE)
        .join(counted, "host")
        .filter(F.col("pages") >= CONSTANT_SHARE * F.col("all_pages"))
        .groupBy("host")
        .agg(F.collect_list("key").alias("template"))
    )
    templates = stored(templates, "templates")
    return (
        pages.join(templates, "host", "left")
        .select("page_id", "url", "html", "host", "template")
        .mapInArrow(_extraction, "page_id long, url string, text string, n_chars long")
    )


def _host():
    found = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page a hash of its open text and the distinct keys of its elements; PAGE counts the page."""
    for batch in batches:
        opens, keys = [], []
        for page in batch.column(1).to_pylist():
            root = parse(page or "")
            text = "\n".join(main_blocks(root, set())).encode("utf-8", "replace")
            opens.append(int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True))
            keys.append(sorted({key for key, _ in keyed(root)} | {PAGE}))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.string()), pa.array(opens, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            ["host", "open", "keys"],
        )


def _extraction(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[int]] = {}
    for batch in batches:
        texts = []
        for page, host, keys in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
            root = parse(page or "")
            template: set[int] = set()
            if keys:
                if host not in known:
                    known.clear()
                    known[host] = set(keys)
                template = {id(node) for key, node in keyed(root) if key in known[host]}
            texts.append("\n".join(main_blocks(root, template)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                batch.column(1).cast(pa.string()),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )
