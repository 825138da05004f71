"""Main text of web pages by composite text density.

The page is read into a tree of block elements (inline markup only contributes
its text; links are counted).  Elements that are page furniture by their tag,
role, or the words of their class and id are left out first; inside an
``article`` or ``main`` element only a whole name of class or role counts, or an
id that no section of a text would have.  For every node

    density = C / T * ln(C / C_links * T / T_links) / b   with
    b = ln(C / (C - C_links) * C_links + C_links(body) / C(body) * C + e)

where C counts characters and T tags of its subtree: characters per tag,
adjusted for links (an absent link counts as one).  A node's density sum adds
its children's densities; text between them counts as one child.  The subtree with the largest sum is the main text;
the smallest density on the path from the body to it is the threshold below
which no side branch is considered.  If the subtree lies in an ``article`` or
``main`` element, or in the ``div`` or ``section`` that names itself so, that
element is taken whole, lists of links included; elsewhere lists that are
nearly all links are left out.

White space inside a block becomes one space, blocks are joined by newlines,
character references are decoded; nothing else is dropped or cut.

Defined cases: null, empty or text-free html gives an empty text; unclosed and
stray tags follow the usual repairs (a block ends an open ``p``); a quote opens a
value only after ``=`` and when it is closed further on, else the tag ends at the
next ``>``; a tag after which the page has no ``>`` is dropped; columns named like the results are
replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML element names by role.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
FURNITURE = frozenset("head nav aside footer form button select option input dialog menu template svg canvas object audio video "
                      "map applet fieldset".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
                     "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
              "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = frozenset("ul ol dl table td th div section article main aside body html".split())
# Words of class, id and role that name page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice popup modal overlay newsletter subscribe signup sidebar sidenav menu nav navbar navigation topbar breadcrumb breadcrumbs "
    "footer masthead comment comments commentlist disqus respond replies discussion share sharing social related recommended "
    "recommendations widget widgets toolbar login search pagination pager copyright contentinfo complementary form alert skip".split())
FURNITURE_IDS = frozenset("ad ads advert adverts advertisement sidebar sidenav navbar breadcrumb breadcrumbs pagination pager comments commentlist "
                          "disqus respond newsletter cookie cookies masthead toolbar".split())
HEADER_WORDS = frozenset("header pageheader siteheader".split())
FURNITURE_STEMS = ("cookie", "advert", "sidebar", "breadcrumb", "newsletter", "sponsor", "popup", "navbar", "disqus", "recommend", "subscri")
MAIN_WORDS = frozenset("article post entry content main story articlebody".split())

_TAG = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+)>|!--(?:>|->|(?s:.)*?(?:--!?>|\Z))|[!?/][^>]*+(?:>|\Z))""")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))?)?""")
_WORDS = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "parts", "drop", "main", "chars", "tags", "link_chars", "links", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", drop: bool = False, main: bool = False):
        self.tag, self.parent, self.drop, self.main = tag, parent, drop, main
        self.parts: list = []  # nodes and (text, in a link) in page order
        self.chars = self.link_chars = self.links = 0
        self.tags, self.density, self.total = 1, 0.0, 0.0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _furniture_name(name: str) -> bool:
    """A whole name that says furniture: one such word, or several of nothing else."""
    parts = _WORDS.findall(name)
    return len(parts) == 1 and parts[0].startswith(FURNITURE_STEMS) or bool(parts) and FURNITURE_WORDS.issuperset(parts)


def _in_main(node: Node | None) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def _role(tag: str, raw: str, in_main: bool) -> tuple[bool, bool]:
    """(page furniture, names itself the main text)."""
    if tag in FURNITURE or tag == "header" and not in_main:
        return True, False
    if tag in ("article", "main"):
        words = frozenset(_WORDS.findall(_attributes(raw).get("class", "").lower())) if raw else frozenset()
        return tag == "article" and bool(words & {"comment", "ad", "advert", "related", "promo"}), True
    if not raw or tag in ("html", "body"):
        return False, False
    found = _attributes(raw)
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True, False
    words = frozenset(_WORDS.findall(" ".join(found.get(k, "") for k in ("class", "id", "role")).lower()))
    if in_main:
        names = f"{found.get('class', '')} {found.get('role', '')}".lower().split()
        if found.get("id", "").lower() in FURNITURE_IDS or any(map(_furniture_name, names)):
            return True, False
    elif words & FURNITURE_WORDS or words & HEADER_WORDS and tag not in INLINE or any(w.startswith(FURNITURE_STEMS) for w in words):
        return True, False
    return False, tag in ("div", "section", "td") and bool(
        words & MAIN_WORDS or "articlebody" in found.get("itemprop", "").lower())


def parse(page: str) -> Node:
    """Tree of the page's block elements below a ``body`` node."""
    root = Node("body", None)
    at, links, position, size = root, 0, 0, len(page)
    while position < size:
        open_at = page.find("<", position)
        if open_at < 0:
            at.parts.append((page[position:], links > 0))
            break
        if open_at > position:
            at.parts.append((page[position:open_at], links > 0))
        found = _TAG.match(page, open_at)
        if found is None:
            if open_at + 1 < size and page[open_at + 1].isascii() and page[open_at + 1].isalpha() or page.startswith("</", open_at):
                break  # an unfinished tag
            at.parts.append(("<", links > 0))
            position = open_at + 1
            continue
        position = found.end()
        if found[2] is None:
            continue
        tag, raw = found[2].lower(), found[3].strip()
        if tag in INLINE and tag not in VOID:
            if at.drop and at.tag in INLINE:  # inside furniture that is set in a line of text
                if tag == at.tag:
                    at.links += -1 if found[1] else 1
                    if at.links < 0:
                        at = at.parent
                continue
            if raw and not found[1] and _role(tag, raw, _in_main(at))[0]:
                at.parts.append(Node(tag, at, drop=True))
                at = at.parts[-1]
                continue
        elif tag not in INLINE and at.drop and at.tag in INLINE:
            at = at.parent  # a block ends it
        if tag == "a":
            if found[1]:
                links = 0
            else:
                links, at.links = 1, at.links + 1
            continue
        if tag in INLINE:
            if tag == "br":
                at.parts.append((" ", False))
            continue
        if found[1]:
            step = at
            while step is not None and step.tag != tag:
                step = step.parent if step.tag not in ("td", "th") or tag in ("table", "tr", "tbody", "body", "html") else None
            if step is not None and step.parent is not None:
                at, links = step.parent, 0
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, position)
            position = end.end() if end else size
            continue
        if tag in ("html", "body"):
            continue
        closes = ("p",) if tag in CLOSES_P else SAME_LEVEL.get(tag, ())
        step = at
        while closes and step is not None and step.parent is not None:
            if step.tag in closes:
                at, links = step.parent, 0
                if tag in CLOSES_P:
                    break
            elif step.tag in SCOPE:
                break
            step = step.parent
        if at.tag == "head" and tag not in ("base", "link", "meta"):
            at = at.parent
        drop, main = _role(tag, raw, _in_main(at))
        node = Node(tag, at, drop, main)
        at.parts.append(node)
        if tag not in VOID and not raw.endswith("/"):
            at = node
    return root


def _nodes(root: Node) -> list[Node]:
    """Nodes that stay, parents before children."""
    out = [root]
    for node in out:
        out.extend(p for p in node.parts if isinstance(p, Node) and not p.drop)
    return out


def _measure(nodes: list[Node]) -> None:
    body = nodes[0]
    for node in reversed(nodes):
        own = 0
        for part in node.parts:
            if isinstance(part, tuple):
                n = len("".join(part[0].split()))
                own += n
                node.link_chars += n if part[1] else 0
            elif not part.drop:
                node.chars += part.chars
                node.tags += part.tags
                node.link_chars += part.link_chars
                node.links += part.links
        node.chars += own
        node.total = own
    share = body.link_chars / body.chars if body.chars else 0.0

    def density(chars: int, tags: int, link_chars: int, links: int) -> float:
        if not chars:
            return 0.0
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
        return chars / tags * math.log(max(chars / max(link_chars, 1) * tags / max(links, 1), 1.0)) / max(base, 1.0)

    for node in nodes:
        node.density = density(node.chars, node.tags + node.links, node.link_chars, node.links)
        parts = any(isinstance(p, Node) and not p.drop for p in node.parts)
        # text between blocks counts as a child; a block without blocks inside just
        # misses its own density, so a parent with anything else wins over it
        node.total = density(node.total, 1, 0, 0) if parts else 0.99 * node.density
    for node in nodes[1:]:
        node.parent.total += node.density


def _path(node: Node) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def main_node(root: Node) -> Node | None:
    nodes = _nodes(root)
    _measure(nodes)
    if not root.chars:
        return None
    best = max(nodes, key=lambda n: n.total)  # the first of equals
    threshold = min(n.density for n in _path(best))
    open_nodes, best = [root], root
    for node in open_nodes:  # branches that reach the threshold, from the body down
        if node.total > best.total or best is root and node is not root and node.total == best.total:
            best = node
        open_nodes.extend(p for p in node.parts if isinstance(p, Node) and not p.drop and p.density >= threshold)
    named = [n for n in _path(best) if n.main]
    semantic = [n for n in named if n.tag in ("article", "main")]
    return (semantic or named or [best])[0]


def blocks(node: Node) -> Iterator[str]:
    """Texts of the subtree's blocks in page order."""
    whole = _in_main(node) or node.main
    held: list[str] = []
    stack = [iter(node.parts)]

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        return [text] if text else []

    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            yield from flush()
        elif isinstance(part, tuple):
            held.append(part[0])
        elif not (part.drop and part.tag in INLINE):
            yield from flush()
            if not part.drop and (whole or not _link_list(part)):
                stack.append(iter(part.parts))


def _link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "dl") and node.links > 1 and node.link_chars >= 0.8 * node.chars


def extract(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    best = main_node(parse(page))
    return "\n".join(blocks(best)) if best is not None else ""


def main_texts(pages: DataFrame) -> DataFrame:
    """Every row of ``pages(html, ...)`` with ``text`` and ``n_chars`` (its code
    points) instead of the html."""
    names = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*names).schema.fields) + "text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(batch.schema.get_field_index("html"))
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [extract(x.as_py()) for x in source.slice(a, 256)]
                yield pa.record_batch([*(part.column(part.schema.get_field_index(n)) for n in names), pa.array(texts, pa.string()),
                                       pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return pages.select("html", *names).mapInArrow(run, schema)
