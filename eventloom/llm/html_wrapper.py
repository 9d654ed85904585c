"""Main text of web pages with per-host wrappers by union-free inference.

Every page is parsed into a tree of elements with text slots. Same-host pages
are aligned level by level: equal neighbours fold into repeated groups, elements
that only some pages have become optional, differing text leaves a slot. The
result is one wrapper per host, an expression of sequences, options and
repetitions without unions. A host with many pages is folded in up to 64 parts;
a wrapper keeps its ``WRAPPER_NODES`` elements that most pages have, so that it
stays small however many layouts a host uses. Text at a place it does not keep
stays in the page.

A slot's place in the wrapper says what it holds: a text that most of the pages
with the slot have there is page furniture; a slot of differing texts is content,
however many pages have it; without an article, slots of nearly only link text
are furniture. Inside the article a repeated text must also stand outside the
run of paragraphs, headings, items and cells, or be the one link of such an
element, on at least ``ARTICLE_PAGES`` pages; headings and bylines stay. Text in
navigation, adverts and the like also goes by element and name, unless the
element holds the article or most of the page's text; a name of other words too
(sharing-economy) and unsure names count only where the place behaves like
furniture. Pages are then read against their host's wrapper. Pages
that share the two longest texts are copies and count as one, so that a copied text
is not taken for furniture. Where an element repeats within a page (paragraphs
in a row), its texts differ and the slot is content.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import keep, sized, small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
DROPPED = frozenset("head script style title noscript template nav footer aside form button select option textarea input menu dialog "
                    "iframe object embed svg canvas audio video map datalist noembed noframes xmp math applet".split())
BLOCKS = frozenset("html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th pre "
                   "blockquote figure figcaption address header footer aside nav form fieldset details summary hr center hgroup menu dir "
                   "dialog legend optgroup option".split())
CLOSES_P = BLOCKS - frozenset("html body td th tr thead tbody tfoot caption legend option optgroup li dt dd".split())
#: Start tags that end an open element of the same kind, up to the scope.
SAME = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|side-?bar|menu\w*|nav|navbar|navigation|bread-?crumbs?|cookies?|consent|"
    r"gdpr|notices?|newsletter|subscri\w*|comments?|commentlist|disqus|respond|shar(?:e|ing)|social|related|recommend\w*|announce\w*|notifications?|disclaimer|copyright|responses|replies|discussion|reactions|cta|topbar|footer|header|masthead|"
    r"pop-?up|modal|overlay|toolbar|pagination|pager|widgets?|log-?in|sign-?up|search\w*|skip|alerts?)(?=$|[\s_-])", re.I)
#: Names that text bears too (a notice, related work): these go only if their place behaves like furniture on the host's pages.
WEAK = re.compile(
    r"(?:^|[\s_-])(?:notices?|related|recommend\w*|announce\w*|notifications?|disclaimer|copyright|respond|responses|replies|discussion|reactions|"
    r"search\w*|skip|alerts?|banner|menu\w*|promo\w*|social|overlay|widgets?)(?=$|[\s_-])", re.I)
#: Words of layout: a name of furniture words and these says furniture.
LAYOUT = frozenset("site page main top bottom left right center box bar list item items link links wrap wrapper container block section area button "
                   "buttons icon icons group form post posts article articles inner outer global primary secondary content text title body col row "
                   "column fixed sticky mobile desktop slot unit zone panel pane card cards tool tools count thread media network networks email "
                   "mail inline small large hidden visible open active wide full web home story stories news more tag tags first last default "
                   "module region frame layer bubble strip wall rail pop box tab tabs and the".split())
_BYLINE = re.compile(r"(?:^|[.\s_-])(?:by|by-?line|author|writer|date|date-?line|published|time)(?=$|[.\s_-])", re.I)
STRONG, UNSURE, HEADER = 1, 2, 3
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: A text is furniture if this share of the pages that have its slot, at least
#: two, have it there. A slot keeps the ``SLOT_TEXTS`` most frequent texts
#: (Misra-Gries), which counts a text too low by at most one in
#: ``SLOT_TEXTS + 1`` of the others.
SAME_SHARE = 0.8
LEAST_PAGES = 2
ARTICLE_PAGES = 3
SLOT_TEXTS = 4
LINK_SHARE = 0.9
DEPTH = 48
#: Elements of a wrapper; with keys of at most ``KEY_CHARS`` it has some 200 KB of JSON at most.
WRAPPER_NODES = 1000
KEY_CHARS = 64
#: The run of an article's own text.
RUN = frozenset("p li dt dd blockquote pre td th caption figcaption h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""<!--(?:(?!-->).)*(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HEADLINE = re.compile("h1")
_HEADING = re.compile(r"h[1-6]")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@lru_cache(100_000)
def _element(tag: str, attributes: str) -> tuple[str, bool, bool, int]:
    """``(key, dropped, dropped outside an article, kind of name)`` of an
    element. A dropped element with a kind of name may be taken back."""
    a = {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip(" /") else {}
    names = [a.get("class", ""), a.get("id", ""), a.get("role", "")]
    key = tag + "".join(f".{_DIGITS.sub('0', x)}" if x else "" for x in names)
    if len(key) > KEY_CHARS:
        key = f"{key[: KEY_CHARS - 9]}~{_text_hash(key)}"
    if tag in ("html", "body", "main"):
        return key, False, False, 0
    hidden = "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDDEN.search(a.get("style", "")))
    if hidden or (tag in DROPPED and tag != "form"):
        return key, True, True, 0
    if _HEADING.fullmatch(tag):
        names[1] = ""  # an anchor made of the heading's words
    if tag == "article":
        kind = STRONG if re.search(r"(?:^|[\s_-])(?:comments?|related|promo\w*|ads?)(?=$|[\s_-])", f"{names[0]} {names[1]}", re.I) else 0
    elif tag == "header" or re.search(r"(?:^|[\s_-])(?:header|masthead)(?=$|[\s_-])", f"{names[0]} {names[1]}", re.I):
        kind = HEADER
    elif tag == "form" or names[2].lower() in ROLES:
        kind = STRONG
    else:
        kinds = {_name_kind(x) for x in f"{names[0]} {names[1]}".split()}
        kind = STRONG if STRONG in kinds else UNSURE if UNSURE in kinds and not _HEADING.fullmatch(tag) else 0
    return key, kind == STRONG, kind != 0, kind


def _name_kind(name: str) -> int:
    """What one name of a class list or id says."""
    if not FURNITURE.search(WEAK.sub(" ", name)):
        return UNSURE if WEAK.search(name) else 0
    others = re.findall(r"[^\W\d_]{3,}", FURNITURE.sub(" ", name).lower())
    return STRONG if LAYOUT.issuperset(others) else UNSURE


class Node:
    __slots__ = ("tag", "key", "dropped", "outer", "kind", "children", "block")

    def __init__(self, tag: str, key: str, dropped: bool, outer: bool, kind: int = 0):
        self.tag, self.key, self.dropped, self.outer, self.kind, self.children, self.block = tag, key, dropped, outer, kind, [], tag in BLOCKS

    def unname(self) -> None:
        self.dropped, self.outer, self.kind = False, False, 0


def parse(page: str | None) -> Node:
    """Tree of a page; ``children`` hold nodes and strings. Unclosed and
    crossing tags are mended as browsers do for paragraphs, lists and tables."""
    root = Node("", "", False, False)
    stack, text, at = [root], page or "", 0

    def close(to: int) -> None:
        del stack[to:]

    while True:
        m = _TOKEN.search(text, at)
        chunk = text[at : m.start() if m else len(text)]
        if chunk:
            stack[-1].children.append(html.unescape(chunk) if "&" in chunk else chunk)
        if not m:
            return root
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in VOID:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in BLOCKS and stack[i].block:
                    break
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].block or stack[i].tag in ("button", "object"):
                    break
        if tag in SAME:
            kinds, scope = SAME[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in kinds:
                    close(i)
                    if tag != "tr":
                        break
                elif stack[i].tag in scope:
                    break
        node = Node(tag, *_element(tag, m[3]))
        if node.kind and not node.block and any(x.tag in ("pre", "code") for x in stack):
            node.unname()  # highlighted code
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
            at = end.end() if end else len(text)
        elif tag not in VOID and len(stack) < 4096:
            stack.append(node)


def _take_back(root: Node) -> None:
    """Names do not count on elements that hold the page's longest article or
    main, or more than half of its text."""
    order: list[tuple[Node, int]] = [(root, -1)]
    for at, (n, _) in enumerate(order):  # grows as it is read
        order.extend((c, at) for c in n.children if not isinstance(c, str) and (c.kind or not c.dropped))
    chars = [sum(len(c.strip()) for c in n.children if isinstance(c, str)) for n, _ in order]
    for at in range(len(order) - 1, 0, -1):
        chars[order[at][1]] += chars[at]
    for tag in ("article", "main"):
        found = [at for at, (n, _) in enumerate(order) if n.tag == tag]
        if found:
            at = max(found, key=lambda i: (not order[i][0].kind, chars[i], -i))
            at = at if order[at][0].kind else order[at][1]
            while at > 0:
                if order[at][0].tag != "article":
                    order[at][0].unname()
                at = order[at][1]
    for (n, _), c in zip(order, chars, strict=True):
        if n.kind and 2 * c > chars[0]:
            n.unname()


# A wrapper node: [key, flags, children, slot, pages]; flags 1 optional, 2 repeated;
# slot: [pages, {hash of the text: pages with it}, characters, linked ones]; a
# text is not counted where one page has several in a folded slot.
Wrapper = list


def shape(root: Node) -> Wrapper:
    """Normal form of a page's tree, without the text itself."""

    def build(node: Node, depth: int, linked: bool) -> Wrapper:
        kids, own = [], []
        linked = linked or node.tag == "a"
        todo = list(reversed(node.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                if not c.isspace():
                    own.append(c)
            elif depth >= DEPTH:
                todo.extend(reversed(c.children))
            else:
                kids.append(build(c, depth + 1, linked))
        text = " ".join(" ".join(own).split())
        return [node.key, 0, squash(kids), [1, {_text_hash(text): 1}, len(text), len(text) * linked] if text else None, 1]

    return build(root, 0, False)


def bounded(w: Wrapper, nodes: int = WRAPPER_NODES) -> Wrapper:
    """The wrapper if it has at most ``nodes`` elements, else three quarters as
    many: those that most pages have, of equal ones the first of the page. An
    element has no more pages than the one around it, so none loses its place."""
    order: list[tuple[int, int, Wrapper]] = []
    todo = [w]
    while todo:
        n = todo.pop()
        order.append((-n[4], len(order), n))
        todo.extend(reversed(n[2]))
    if len(order) <= nodes:
        return w
    order.sort(key=lambda x: x[:2])
    kept = {id(n) for _, _, n in order[: nodes * 3 // 4]}

    def copy(n: Wrapper) -> Wrapper:
        return [n[0], n[1], [copy(c) for c in n[2] if id(c) in kept], n[3], n[4]]

    return copy(w)


def own_text(node: Node) -> str:
    return " ".join(" ".join(c for c in node.children if isinstance(c, str) and not c.isspace()).split())


def _text_hash(text: str) -> str:
    return format(zlib.crc32(text.encode("utf-8", "surrogatepass")), "x")  # keys of a JSON object


def page_key(root: Node) -> int:
    """Hash of the two longest texts of a page's article (main), or of all text
    without one: pages that share it are copies, whose common text says nothing
    about the host."""
    texts: dict[str, list[str]] = {"article": [], "main": [], "": []}
    todo: list[tuple[Node, str]] = [(root, "")]
    while todo:
        n, place = todo.pop()
        if n.tag == "article" or (n.tag == "main" and not place):
            place = n.tag
        for c in n.children:
            if not isinstance(c, str):
                if not c.dropped:
                    todo.append((c, place))
            elif not c.isspace():
                texts[place].append(" ".join(c.split()))
    place = next((x for x in texts if texts[x]), "")
    told = sorted(texts[place], key=lambda x: (-len(x), x))[: 2 if place else None]
    return int.from_bytes(hashlib.blake2b("\n".join(told).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def squash(kids: list[Wrapper]) -> list[Wrapper]:
    """Neighbouring equal groups of one to three elements folded into one
    repeated group."""
    for period in (1, 2, 3):
        out: list[Wrapper] = []
        i = 0
        while i < len(kids):
            group = kids[i : i + period]
            if len(out) >= period and [k[0] for k in out[-period:]] == [k[0] for k in group]:
                out[-period:] = [_merged(a, b, 2, same_page=True) for a, b in zip(out[-period:], group, strict=True)]
                i += period
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def _merged(a: Wrapper, b: Wrapper, flags: int = 0, same_page: bool = False) -> Wrapper:
    x, y = a[3], b[3]
    slot = x or y
    if x and y:
        slot = [max(x[0], y[0]) if same_page else x[0] + y[0], _texts(x[1], y[1], same_page), x[2] + y[2], x[3] + y[3]]
    return [a[0], a[1] | b[1] | flags, merge(a[2], b[2], same_page), slot, max(a[4], b[4]) if same_page else a[4] + b[4]]


def _texts(a: dict[str, int], b: dict[str, int], same_page: bool) -> dict[str, int]:
    if same_page:
        return {t: max(a[t], b[t]) for t in a if t in b} if len(a) == len(b) == 1 else {}
    out = dict(a)
    for t, n in b.items():
        out[t] = out.get(t, 0) + n
    if len(out) > SLOT_TEXTS:
        less = sorted(out.values(), reverse=True)[SLOT_TEXTS]
        out = {t: n - less for t, n in out.items() if n > less}
    return out


def merge(a: list[Wrapper], b: list[Wrapper], same_page: bool = False) -> list[Wrapper]:
    """Two sequences aligned; what only one has becomes optional."""
    if not a or not b:
        return [[k, f | 1, *x] for k, f, *x in a or b]
    ka, kb = [x[0] for x in a], [x[0] for x in b]
    if ka == kb:
        return [_merged(x, y, 0, same_page) for x, y in zip(a, b, strict=True)]
    out: list[Wrapper] = []
    for op, i1, i2, j1, j2 in SequenceMatcher(None, ka, kb, autojunk=False).get_opcodes():
        if op == "equal":
            out += [_merged(x, y, 0, same_page) for x, y in zip(a[i1:i2], b[j1:j2], strict=True)]
        else:
            out += [[k, f | 1, *x] for k, f, *x in [*a[i1:i2], *b[j1:j2]]]
    return squash(out)


def expression(w: Wrapper) -> str:
    """The wrapper as a regular expression over tags, ``#`` for a text slot."""
    inner = ("#" if w[3] else "") + " ".join(expression(c) for c in w[2])
    return f"({w[0]}[{inner}])" + ("", "?", "+", "*")[w[1]]


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, n_pages, wrapper`` (JSON, compressed by zlib) of all ``pages(host,
    html)``. Copies of a page count as one page; pages without text are left out."""
    salts = 64

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                root = parse(page)
                w = shape(root)
                if _has_text(w):
                    key = page_key(root)
                    rows.append((host, key % salts, key, json.dumps(bounded(w))))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                             ["host", "salt", "key", "wrapper"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by host, salt and key: ``page`` merges copies, ``total`` pages.
        at, page, total, n = None, None, None, 0
        done: list[tuple[str, int, Wrapper]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = json.loads(row[3])
                if at == row[:3]:
                    page = bounded(_merged(page, w, same_page=True))
                    continue
                if at is not None:
                    total, n = page if total is None else bounded(_merged(total, page)), n + 1
                    if at[:2] != row[:2]:
                        done.append((at[0], n, total))
                        total, n = None, 0
                at, page = row[:3], w
            if len(done) > 500:
                yield _wrapper_rows(done)
                done = []
        if at is not None:
            done.append((at[0], n + 1, page if total is None else bounded(_merged(total, page))))
        yield _wrapper_rows(done)

    def combine(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        total, w = 0, None
        for n, text in sorted(zip(f["n_pages"], f["wrapper"], strict=True)):
            total, w = total + n, json.loads(text) if w is None else bounded(_merged(w, json.loads(text)))
        return pd.DataFrame({"host": [key[0]], "n_pages": [total], "wrapper": [zlib.compress(json.dumps(w).encode())]})

    order = ["host", "salt", "key", "wrapper"]
    parts = (pages.select("host", "html").mapInArrow(shapes, "host string, salt long, key long, wrapper string")
             .repartition("host", "salt").sortWithinPartitions(*order).select(*order))
    return parts.mapInArrow(fold, "host string, n_pages long, wrapper string").groupBy("host").applyInPandas(
        combine, "host string, n_pages long, wrapper binary")


def _has_text(w: Wrapper) -> bool:
    return w[3] is not None or any(map(_has_text, w[2]))


def _wrapper_rows(rows: list[tuple[str, int, Wrapper]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([h for h, _, _ in rows], pa.string()), pa.array([n for _, n, _ in rows], pa.int64()),
         pa.array([json.dumps(w) for _, _, w in rows], pa.string())], ["host", "n_pages", "wrapper"])


@lru_cache(256)
def _unpacked_places(packed: bytes, n_pages: int) -> Wrapper:
    return _furniture_places(zlib.decompress(packed).decode(), n_pages)


def _furniture_places(text: str, n_pages: int) -> Wrapper:
    """The wrapper with slots replaced by the texts that are furniture there,
    whether links are, where no article holds them, and whether the pages are
    enough for a place inside one; last, whether an element
    behaves like furniture: most of its text is linked, or is furniture."""

    def mark(w: Wrapper) -> tuple[Wrapper, int, int]:
        s = w[3]
        same = frozenset(t for t, n in s[1].items() if n >= LEAST_PAGES and n >= SAME_SHARE * s[0]) if s else frozenset()
        links = bool(s) and n_pages >= LEAST_PAGES and s[3] >= LINK_SHARE * s[2]
        kids = [mark(c) for c in w[2]]
        chars = (s[2] if s else 0) + sum(k[1] for k in kids)
        telling = (0 if not s else s[2] if same else s[3]) + sum(k[2] for k in kids)
        return [w[0], w[1], [k[0] for k in kids], (same, links, bool(s) and s[0] >= ARTICLE_PAGES), 2 * telling > chars], chars, telling

    return mark(json.loads(text))[0]


def main_text(page: str | None, wrapper: Wrapper | None = None) -> str:
    """Blocks of the main text, joined by newlines."""
    root = parse(page)
    _take_back(root)

    def holds(name: str) -> bool:
        todo = [root]
        while todo:
            n = todo.pop()
            if n.tag == name and not n.dropped:
                return True
            todo.extend(c for c in n.children if not isinstance(c, str) and not c.dropped)
        return False

    within = "article" if holds("article") else "main" if holds("main") else ""
    texts: dict[int, str] = {}

    def is_furniture(node: Node, place: tuple[frozenset[str], bool, bool], run: Node | None) -> bool:
        same, links, enough = place
        if links and not within:
            return True
        if within and (not enough or _BYLINE.search(node.key)):
            return False
        if within and run is not None and (node.tag != "a" or _HEADING.fullmatch(run.tag) or own_text(run)):
            return False
        if same and id(node) not in texts:
            texts[id(node)] = _text_hash(own_text(node))
        return bool(same) and texts[id(node)] in same

    blocks: list[str] = []
    current: list[str] = []

    def flush() -> None:
        if current:
            line = " ".join("".join(current).split())
            if line:
                blocks.append(line)
            current.clear()

    # (node, next child, its wrapper, place in it, inside the article, its element of the text's run)
    todo = [[root, 0, wrapper, 0, not within, None]]
    while todo:
        frame = todo[-1]
        node, i, w, place, inside, run = frame
        if i >= len(node.children):
            todo.pop()
            if node.block:
                flush()
            continue
        frame[1] += 1
        c = node.children[i]
        if isinstance(c, str):
            if inside and not (w is not None and not _HEADLINE.fullmatch(node.tag) and is_furniture(node, w[3], run)):
                current.append(c)
            continue
        if c.block:
            flush()
        elif c.tag == "br":
            current.append(" ")
        unsure = c.kind == UNSURE and (inside or not within)
        if c.dropped or (c.outer and not unsure and not (within and inside)):
            continue
        below = None
        if w is not None:
            kids = w[2]
            at = next((j for j in range(place, len(kids)) if kids[j][0] == c.key), None)
            if at is None:
                at = next((j for j, k in enumerate(kids) if k[0] == c.key), None)
            if at is not None:
                below, frame[3] = kids[at], at
        if unsure and below is not None and below[4]:
            continue
        todo.append([c, 0, below, 0, inside or c.tag == within, c if c.tag in RUN else run])
    flush()
    return "\n".join(blocks)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url,
    html, ...)``. A null or empty html, and a page without main text, has an
    empty text; pages with a null url share the host ''. Repeated rows each get
    their row; other columns are not used. An empty table gives no rows."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))
    rows = small_batches(pages).select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    wrappers = keep(infer_wrappers(rows), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[2:]]
            texts = [main_text(page, _unpacked_places(w, n) if w else None) for page, n, w in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return (rows.join(sized(wrappers), "host", "left").select("page_id", "url", "html", "n_pages", "wrapper")
            .mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"))
