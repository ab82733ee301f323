"""HTML pages as flat DOM trees, and features of their nodes.

``parse`` makes the nodes of a page in document order: parent, depth, tag,
attribute groups and text.  It follows what browsers do with the usual slips
(paragraphs and list items without end tags, stray end tags, raw-text elements,
unclosed inline elements).  Text between block children gets a node of its own,
so that it can be judged apart from them.
"""

from __future__ import annotations

import re

import numpy as np

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?][^>]*+>""", re.S
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([a-zA-Z][\w:-]*)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title select".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html li dd dt td th tr tbody thead tfoot option button legend summary".split())
#: An opening tag ends open elements of the first set, up to any of the second.
IMPLIED_END = {
    **{x: (frozenset([x]), frozenset(["ul", "ol", "menu"])) for x in ["li"]},
    **{x: (frozenset(["dt", "dd"]), frozenset(["dl"])) for x in ["dt", "dd"]},
    **{x: (frozenset(["td", "th"]), frozenset(["table", "tr"])) for x in ["td", "th"]},
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "option": (frozenset(["option"]), frozenset(["datalist"])),
}
P_SCOPE = frozenset("article aside body button div dd details dt fieldset figure footer form header li main nav object section table td th".split())

#: Groups of tags, and of words in class, id, role and the like.
TAG_GROUPS = {
    "paragraph": "p", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl menu dir", "item": "li dt dd", "link": "a", "plain": "div section center",
    "article": "article main", "nav": "nav", "header": "header hgroup", "footer": "footer", "aside": "aside dialog", "form": "form input button label fieldset legend option",
    "table": "table thead tbody tfoot tr td th", "quote": "blockquote pre code", "figure": "figure figcaption img", "text": "#text", "small": "small time address cite",
}
WORD_GROUPS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs tabs toolbar pagination pager skip toc links sitemap",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner doubleclick commercial affiliate outbrain taboola",
    "side": "side sidebar aside complementary related recommended recommendations widget widgets rail more popular trending teaser tags tag",
    "share": "share sharing social follow facebook twitter newsletter subscribe subscription signup",
    "comment": "comment comments commentlist reply replies respond discussion disqus reader readers feedback review reviews thread",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay disclaimer legal message toast paywall copyright privacy",
    "edge": "header masthead topbar top logo brand head footer foot bottom contentinfo colophon",
    "form": "form search login register contact input button field",
    "content": "article content main body post entry story text page blog hentry articlebody prose single",
}
_TAG_GROUP = {t: i for i, names in enumerate(TAG_GROUPS.values()) for t in names.split()}
_WORD_GROUP = {w: i for i, words in enumerate(WORD_GROUPS.values()) for w in words.split()}
N_TAGS, N_WORDS = len(TAG_GROUPS), len(WORD_GROUPS)
OTHER_TAG = N_TAGS
_NOSCRIPT_END = re.compile(r"</noscript\s*>", re.I)


class Page:
    """Nodes in document order; texts as (node, block, raw text)."""

    __slots__ = ("depths", "flags", "marks", "parents", "tags", "texts")

    def __init__(self):
        self.parents, self.depths, self.tags, self.flags, self.marks = [], [], [], [], []
        self.texts: list[tuple[int, int, str]] = []


def attribute_groups(raw: str, marked: bool) -> tuple[int, int]:
    """Bits of the word groups in the attributes, and the training mark (-1:
    none; read only where pages are ``marked``)."""
    bits, mark = 0, -1
    for m in _ATTRIBUTE.finditer(raw):
        name = (m[1] or m[5]).lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "itemprop") or name.startswith("aria-label"):
            for word in _WORD.findall(value):
                group = _WORD_GROUP.get(word.lower())
                if group is not None:
                    bits |= 1 << group
        elif marked and name == "data-keep":
            mark = int(value)
    return bits, mark


def parse(html: str, marked: bool = True) -> Page:
    """``marked``: a page made for training, whose marks are read; of any other
    page, ``data-keep`` is an attribute without a meaning."""
    page = Page()
    parents, depths, tags, flags, marks, texts = page.parents, page.depths, page.tags, page.flags, page.marks, page.texts
    stack: list[tuple[str, int]] = []  # open elements: tag, node
    block = 0
    has_block: set[int] = set()  # nodes with block children
    at, n = 0, len(html)
    hidden = 0  # depth of an open <head>

    def add(tag: str, raw: str) -> int:
        parent = stack[-1][1] if stack else -1
        parents.append(parent)
        depths.append(len(stack))
        tags.append(_TAG_GROUP.get(tag, OTHER_TAG))
        bits, mark = attribute_groups(raw, marked) if raw and "=" in raw else (0, -1)
        flags.append(bits)
        marks.append(mark)
        return len(parents) - 1

    def put(text: str) -> None:
        nonlocal hidden
        if hidden and text and not text.isspace():
            hidden = 0  # text that is no title ends the head, as in a browser
        if not text or hidden or text.isspace() and not texts:
            return
        if not stack:
            stack.append(("body", add("body", "")))
        texts.append((stack[-1][1], block, text))

    def close(index: int) -> None:
        nonlocal block
        if any(t in BLOCK for t, _ in stack[index:]):
            block += 1
        del stack[index:]

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            put(html[at:])
            break
        if m.start() > at:
            put(html[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, ending, raw = name.lower(), m[1] or m[4], m[3] if m[2] else m[6]
        if ending:
            if tag == "head":
                hidden = 0
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if tag not in BLOCK and stack[i][0] in P_SCOPE:  # a stray inline end tag
                    break
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if not raw.endswith("/"):
                at = end.end() if end else n if tag in ("script", "style", "textarea", "title") else at
            continue
        if tag == "head":
            hidden = 1
            continue
        if tag == "body":
            hidden = 0
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            continue
        if hidden:
            if tag in VOID:
                continue
            if tag == "noscript":
                end = _NOSCRIPT_END.search(html, at)
                at = end.end() if end else at
                continue
            hidden = 0  # a body element ends the head
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in P_SCOPE:
                    break
        elif tag in IMPLIED_END:
            ends, scope = IMPLIED_END[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in scope:
                    break
        if tag in BLOCK:
            block += 1
            if stack:
                has_block.add(stack[-1][1])
        node = add(tag, raw)
        if tag not in VOID and not raw.endswith("/"):
            stack.append((tag, node))
    _split_bare_text(page, has_block)
    return page


def _split_bare_text(page: Page, has_block: set[int]) -> None:
    """Gives texts whose node has block children a node of their own, at the
    end of the node list; ``flatten`` puts nodes back into document order."""
    held: dict[tuple[int, int], int] = {}
    for i, (node, block, text) in enumerate(page.texts):
        if node in has_block and not text.isspace():
            key = (node, block)
            if key not in held:
                held[key] = len(page.parents)
                page.parents.append(node)
                page.depths.append(page.depths[node] + 1)
                page.tags.append(_TAG_GROUP["#text"])
                page.flags.append(0)
                page.marks.append(-1)
            page.texts[i] = (held[key], block, text)


class Forest:
    """The nodes of many pages as arrays, parents before children."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.parents) for p in pages]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        shift = np.repeat(self.first[:-1], sizes)
        flat = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), dtype=np.int64, count=int(self.first[-1]))
        self.parent = flat("parents")
        self.root = self.parent < 0
        self.parent = np.where(self.root, np.arange(len(self.parent)), self.parent + shift)
        self.depth, self.tag, self.flag, self.mark = flat("depths"), flat("tags"), flat("flags"), flat("marks")
        self.page = np.repeat(np.arange(len(pages)), sizes)
        texts = [(self.first[k] + node, len(t), t.count(" ") + 1, t.count(".") + t.count(",")) for k, p in enumerate(pages) for node, _, t in p.texts if not t.isspace()]
        own = np.array(texts, dtype=np.int64).reshape(-1, 4)
        total = lambda j: np.bincount(own[:, 0], weights=own[:, j] if j else None, minlength=len(self.parent)).astype(float)
        self.own_chars, self.own_words, self.own_marks, self.own_pieces = total(1), total(2), total(3), total(0)
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=-1)) + 1)]

    def up(self, own: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = own.astype(float)
        for level in reversed(self.levels[1:]):
            np.add.at(out, self.parent[level], out[level])
        return out

    def down(self, bits: np.ndarray) -> np.ndarray:
        """Bits of all proper ancestors together."""
        out = np.zeros_like(bits)
        for level in self.levels[1:]:
            out[level] = out[self.parent[level]] | bits[self.parent[level]]
        return out


def features(f: Forest) -> np.ndarray:
    """One row of numbers for each node."""
    n = len(f.parent)
    if not n:
        return np.zeros((0, len(NAMES)), dtype=np.float32)
    chars, words, marks, pieces = f.up(f.own_chars), f.up(f.own_words), f.up(f.own_marks), f.up(f.own_pieces)
    nodes = f.up(np.ones(n))
    is_tag = lambda name: f.tag == list(TAG_GROUPS).index(name)
    link_bits = f.down(is_tag("link").astype(np.int64)).astype(bool) | is_tag("link")
    in_links = f.up(np.where(link_bits, f.own_chars, 0.0))
    children = np.bincount(f.parent[~f.root], minlength=n)
    whole = chars[f.first[:-1][f.page]] if len(f.first) > 1 else chars
    page_chars = np.bincount(f.page, weights=f.own_chars)[f.page] + 1
    # siblings, in document order: place, neighbours, means
    sib = np.lexsort((np.arange(n), f.parent))
    sib = sib[~f.root[sib]]
    new = np.concatenate([[True], f.parent[sib][1:] != f.parent[sib][:-1]]) if len(sib) else np.zeros(0, dtype=bool)
    start = np.flatnonzero(new)
    rank = np.zeros(n)
    prev, following = np.zeros(n), np.zeros(n)
    if len(sib):
        rank[sib] = np.arange(len(sib)) - np.repeat(start, np.diff(np.append(start, len(sib))))
        prev[sib[1:]] = np.where(new[1:], 0, chars[sib[:-1]])
        following[sib[:-1]] = np.where(new[1:], 0, chars[sib[1:]])
    siblings = children[f.parent].astype(float)
    tag_bits = np.where(f.tag < N_TAGS, 1 << np.minimum(f.tag, N_TAGS - 1), 0)
    above = f.down(tag_bits | f.flag << N_TAGS)
    columns = [
        f.depth, np.log1p(chars), np.log1p(f.own_chars), in_links / (chars + 1), chars / (nodes + 1), words / (pieces + 1), marks / (words + 1),
        chars / (whole + 1), chars / (chars[f.parent] + 1), children, siblings, rank, rank / (siblings + 1),
        np.log1p(prev), np.log1p(following), np.log1p(chars[f.parent] / np.maximum(siblings, 1)), np.log1p(page_chars),
        f.up(is_tag("item")), f.up(is_tag("paragraph")), f.up(is_tag("form")), f.up(is_tag("link")), f.up(is_tag("heading")),
    ]
    columns += [f.tag == k for k in range(N_TAGS)]
    columns += [f.flag >> k & 1 for k in range(N_WORDS)]
    columns += [above >> k & 1 for k in range(N_TAGS + N_WORDS)]
    return np.column_stack([np.asarray(c, dtype=np.float32) for c in columns])


NAMES = [
    "depth", "chars", "own_chars", "link_share", "density", "words_per_piece", "marks_per_word", "share_of_page", "share_of_parent", "children", "siblings",
    "rank", "rank_share", "previous", "following", "parent_mean", "page_chars", "items", "paragraphs", "controls", "links", "headings",
    *(f"tag_{x}" for x in TAG_GROUPS), *(f"attr_{x}" for x in WORD_GROUPS), *(f"above_{x}" for x in (*TAG_GROUPS, *WORD_GROUPS)),
]
