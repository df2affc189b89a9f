"""Main text of web pages by tree scoring.

A page becomes a tree of elements.  Paragraphs pass points for their length
and commas to their ancestors, less with every level; a container's points
are discounted by the share of its text that is inside links.  The best
container is kept, or the article or main part that it is in, with those
siblings that read like prose by their own size.  Parts that are no article by
element, role or a sure name are left out; a name that may mean anything
("search-tips", "legal") costs points, and the part only if it is no prose.

The tree is a small per-page helper; pages are independent rows.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
DROPPED = frozenset(
    "head script style noscript template textarea title iframe noembed noframes object svg math canvas audio video map form button "
    "select option input label fieldset nav footer aside dialog menu".split())
CLOSES_P = BLOCK - {"br", "body", "html", "option", "optgroup", "caption", "legend", "tbody", "thead", "tfoot", "tr", "td", "th", "summary"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element that opens one of these ends the open one of the second set, up to the third.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset("select optgroup".split())),
}
# Names that page parts other than the article go by, and those the article goes by.
_OTHER = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|aside|rail|widget\w*|"
    r"footer|foot|header|masthead|topbar|toolbar|comments?|comment\w*|disqus|respond|replies|reply|discuss\w*|feedback|reviews?|cookies?\w*|consent|gdpr|"
    r"notice\w*|alert\w*|disclaimer|popup|modal|overlay|subscri\w*|newsletter|signup|login|register|share\w*|sharing|social\w*|"
    r"related\w*|recommend\w*|popular|trending|tags?|tagcloud|pagination|pager|print|search\w*|copyright|legal|hidden|skip\w*)(?:$|[\s_-])", re.I)
_OWN = re.compile(r"(?:^|[\s_-])(?:article\w*|body|content|entry\w*|hentry|main|page|post\w*|story\w*|text|blog)(?:$|[\s_-])", re.I)
_SURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|comments?|commentlist|disqus|replies|reply|respond|sidebar|footer|nav|navigation|menu|share|"
    r"sharing|social|related|notice|cookies?|consent|gdpr|banner|newsletter|subscribe|signup|login|register|breadcrumbs?|promo|popup|modal|overlay|"
    r"pagination|pager|tagcloud|trending|popular|hidden)(?:$|[\s_-])", re.I)
_MODIFIER = re.compile(r"(?:^|(?<=\s))(?:has|with|no|without|not)[_-][^\s]*", re.I)  # "has-sidebar" says what stands elsewhere
_PHRASE = frozenset("p a b i em strong span h1 h2 h3 h4 h5 h6 pre blockquote td li".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())

_MARK = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_OPEN_QUOTE = re.compile(r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>[^>]*)>")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TAG_START = re.compile(r"<(?=[A-Za-z/!?])")


class Node:
    __slots__ = ("name", "attrs", "kids", "up", "points", "size", "linked", "commas", "order", "weak")

    def __init__(self, name: str, up: Node | None, attrs: str = ""):
        self.name, self.up, self.attrs, self.kids = name, up, attrs, []
        self.points, self.weak = 0.0, False
        self.size = self.linked = self.commas = 0

    def named(self) -> dict[str, str]:
        return {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(self.attrs)} if self.attrs.strip(" /") else {}


def parse(page: str) -> Node:
    """The element tree; text is held as strings among the children."""
    root = here = Node("html", None)
    at, n = 0, len(page)

    def text(part: str) -> None:
        if part:
            here.kids.append(_html.unescape(part))

    while at < n:
        lt = _TAG_START.search(page, at)
        if lt is None:
            text(page[at:])
            break
        text(page[at:lt.start()])
        m = _MARK.match(page, lt.start()) or _OPEN_QUOTE.match(page, lt.start())
        if m is None:
            if page.startswith("</", lt.start()):  # an end tag without a name is no text
                close = page.find(">", lt.start())
                at = n if close < 0 else close + 1
                continue
            if page[lt.start() + 1:lt.start() + 2].isalpha():  # a tag cut off by the page's end
                break
            text("<")
            at = lt.start() + 1
            continue
        at = m.end()
        if m["name"] is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3])
            continue
        name = m["name"].lower()
        if m["end"]:
            node = here
            while node is not None and node.name != name:
                # An end tag reaches through a block only if it ends a block itself.
                node = None if node.name in BLOCK and name not in BLOCK else node.up
            if node is not None and node.up is not None:
                here = node.up
            continue
        if name == "html":
            continue
        if name in CLOSES_P:
            node = here
            while node is not None and node.name != "p" and (node.name not in BLOCK):
                node = node.up
            if node is not None and node.name == "p" and node.up is not None:
                here = node.up
        if name in IMPLIED:
            ends, within = IMPLIED[name]
            node, top = here, None
            while node is not None and node.name not in within:
                if node.name in ends:
                    top = node
                node = node.up
            if top is not None and top.up is not None:
                here = top.up
        if name == "body" and here.name == "head":
            here = here.up or here
        node = Node(name, here, m["attrs"])
        here.kids.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and not m["attrs"].rstrip().endswith("/"):
            here = node
        elif name not in VOID and name in BLOCK | {"a", "b", "i", "em", "strong", "span"}:
            here = node  # a slash does not close these
    return root


def _within(node: Node, names: tuple[str, ...]) -> bool:
    up = node.up
    while up is not None and up.name not in names:
        up = up.up
    return up is not None


def _within(node: Node, names: tuple[str, ...]) -> bool:
    up = node.up
    while up is not None and up.name not in names:
        up = up.up
    return up is not None


def _dropped(node: Node) -> bool:
    """Parts that are no article, by element, role or sure name; a node with
    an unsure name is marked ``weak``."""
    if node.name in DROPPED:
        return True
    if node.name in ("body", "html", "main"):
        return False
    named = node.named()
    if named.get("role", "").lower() in _ROLES or "hidden" in named or named.get("aria-hidden", "").lower() == "true":
        return True
    style = named.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True
    if node.name == "header":
        return not _within(node, ("article", "main"))  # the page's header; an article's own one holds its headline
    names = _MODIFIER.sub(" ", f"{named.get('class', '')} {named.get('id', '')}")
    if not names.strip():
        return False
    if _SURE.search(names):
        return not _holds(node, ("article", "main"))  # a wrapper of the article is none of these
    node.weak = node.name not in _PHRASE and node.name != "article" and not _OWN.search(names) and bool(_OTHER.search(names))
    return False


def _holds(node: Node, names: tuple[str, ...]) -> bool:
    stack = [k for k in node.kids if not isinstance(k, str)]
    while stack:
        cur = stack.pop()
        if cur.name in names:
            return True
        stack += [k for k in cur.kids if not isinstance(k, str)]
    return False


def _prune(node: Node) -> None:
    stack, weak = [node], []
    while stack:
        cur = stack.pop()
        cur.kids = [k for k in cur.kids if isinstance(k, str) or k.name in ("br", "hr") or not _dropped(k)]
        stack += [k for k in cur.kids if not isinstance(k, str)]
        weak += [k for k in cur.kids if not isinstance(k, str) and k.weak]
    for cur in weak:  # an unsure name goes with a part that does not read like one of the article
        order = _measure(cur)
        long_, size = _prose(cur)
        inside = _within(cur, ("article", "main"))
        if cur.up is not None and (_link_share(cur) >= 0.3 or size < 100 or not (inside or long_ >= 2 or size >= 400)):
            cur.up.kids = [k for k in cur.up.kids if k is not cur]
        for n in order:
            n.size = n.linked = n.commas = 0  # measured again with the page


def _prose(node: Node) -> tuple[int, int]:
    """Text blocks of 80 characters or more with few links below (and at) a
    measured node: how many, and their size together."""
    many = size = 0
    stack = [node]
    while stack:
        cur = stack.pop()
        if cur.name in BLOCK and cur.name not in HEADINGS and _own_text(cur):
            own = sum(len("".join(k.split())) if isinstance(k, str) else k.size for k in cur.kids if isinstance(k, str) or k.name not in BLOCK)
            if own >= 80 and _link_share(cur) < 0.3:
                many, size = many + 1, size + own
        stack += [k for k in cur.kids if not isinstance(k, str)]
    return many, size


def _measure(root: Node) -> list[Node]:
    """Text and link sizes of all elements, bottom up; elements in page order."""
    order, stack = [], [root]
    while stack:
        cur = stack.pop()
        cur.order = len(order)
        order.append(cur)
        stack += [k for k in reversed(cur.kids) if not isinstance(k, str)]
    for cur in reversed(order):
        for k in cur.kids:
            if isinstance(k, str):
                cur.size += len("".join(k.split()))
                cur.commas += k.count(",") + k.count("，") + k.count("、") + k.count("،")
            else:
                cur.size, cur.linked, cur.commas = cur.size + k.size, cur.linked + k.linked, cur.commas + k.commas
        if cur.name == "a":
            cur.linked = cur.size
    return order


def _link_share(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _own_text(node: Node) -> bool:
    """Whether an element holds text of its own, not only inside blocks."""
    return any(k.strip() if isinstance(k, str) else k.name not in BLOCK and k.size for k in node.kids)


def _score(order: list[Node]) -> Node | None:
    """Points for every container, from the paragraphs in it; the best one."""
    holders = set()
    for node in order:
        if node.name in HEADINGS or node.name not in BLOCK or not node.size or not _own_text(node):
            continue
        points = 1 + node.commas + min(node.size / 100, 3.0)
        points *= 1 - _link_share(node)
        up, level = (node.up if node.name in ("p", "pre", "li", "td", "dd", "dt", "blockquote") else node), 0
        while up is not None and level < 5:
            if up.name in ("li", "ul", "ol", "tr", "tbody", "table", "blockquote", "dl", "figure"):
                up = up.up  # these hold parts of a text, not a text
                continue
            up.points += points / (1 if level == 0 else 2 if level == 1 else level * 3)
            holders.add(up)
            up, level = up.up, level + 1
    best, most = None, 0.0
    for node in sorted(holders, key=lambda h: h.order):
        base = {"article": 10.0, "main": 8.0, "section": 2.0, "div": 1.0}.get(node.name, 0.0)
        named = node.named()
        if _OWN.search(f"{named.get('class', '')} {named.get('id', '')} {named.get('itemprop', '')}") or named.get("role") in ("main", "article"):
            base += 5.0
        if node.weak:
            base -= 5.0
        total = (node.points + base) * (1 - _link_share(node))
        node.points = total
        if total > most:
            best, most = node, total
    return best


def _kept(best: Node) -> list[Node | str]:
    """The article or main part around the best container, with its headline;
    without one, the container and all beside it, level by level, that reads
    like the article by its own size."""
    up = [best]
    while up[-1].up is not None and up[-1].up.name not in ("body", "html"):
        up.append(up[-1].up)
    whole = next((u for u in up if u.name == "article"), None) or next((u for u in up if u.name == "main"), None)
    if whole is not None and _link_share(whole) < 0.3:
        before = whole.up.kids[:whole.up.kids.index(whole)] if whole.up is not None and whole.name == "article" else []
        more = [k for k in (whole.up.kids if before or whole.name == "article" else []) if k is not whole and not isinstance(k, str)]
        heads = [k for k in more if k in before and k.name in ("h1", "h2", "hgroup") and _link_share(k) < 0.3]
        parts = [k for k in more if k.name in ("article", "section") and not k.weak and _reads(k)]
        return [k for k in (whole.up.kids if whole.up is not None else [whole]) if k is whole or k in heads or k in parts]
    kept: list[Node | str] = [best]
    for u in up:
        if u.up is None:
            break
        at = u.up.kids.index(u)
        left = [k for k in u.up.kids[:at] if _beside(k)]
        right = [k for k in u.up.kids[at + 1:] if _beside(k)]
        kept = [*left, *kept, *right]
        if u.up.name in ("body", "html"):
            break
    return kept


def _reads(node: Node) -> bool:
    """Whether most of a part is prose, in two paragraphs or a long one."""
    many, size = _prose(node)
    return _link_share(node) < 0.3 and (many >= 2 or size >= 200) and 2 * size >= node.size


def _beside(k: Node | str) -> bool:
    """Whether what stands beside the best container belongs to the article."""
    if isinstance(k, str):
        return bool(k.strip())
    if not k.size or k.weak or _link_share(k) >= 0.3:
        return False
    if k.name in HEADINGS or k.name in ("hgroup", "p", "pre", "blockquote", "figure", "table", "ul", "ol", "dl") or k.name not in BLOCK:
        return True
    return _reads(k)


def _text(nodes: list[Node | str]) -> str:
    """Blocks in page order, white space inside each turned into one space."""
    pieces: list[str] = []
    stack: list[Node | str] = list(reversed(nodes))
    while stack:
        cur = stack.pop()
        if isinstance(cur, str):
            pieces.append(cur)
        elif cur.name in BLOCK:
            lists = cur.name in ("ul", "ol", "table", "tr", "td", "div", "section") and cur.size and _link_share(cur) > 0.6
            if not lists or _sources(cur):  # lists of links are menus
                stack += ["\n", *reversed(cur.kids), "\n"]
        else:
            stack += reversed(cur.kids)
    return " ".join("".join(pieces).split())


def _sources(node: Node) -> bool:
    """Links of an article that are named at length: its sources, not a menu."""
    if not _within(node, ("article", "main")):
        return False
    links, stack = [], [node]
    while stack:
        cur = stack.pop()
        if cur.name == "a":
            links.append(cur.size)
        else:
            stack += [k for k in cur.kids if not isinstance(k, str)]
    return bool(links) and sum(links) >= 18 * len(links)


def _sources(node: Node) -> bool:
    """Links of an article that are named at length: its sources, not a menu."""
    if not _within(node, ("article", "main")):
        return False
    links, stack = [], [node]
    while stack:
        cur = stack.pop()
        if cur.name == "a":
            links.append(cur.size)
        else:
            stack += [k for k in cur.kids if not isinstance(k, str)]
    return bool(links) and sum(links) >= 18 * len(links)


def main_text(page: str | None) -> str:
    """The article of a page; empty for null and empty pages, and for those
    without any text outside menus and the like."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    best = _score(_measure(root))
    return _text(_kept(best)) if best is not None else _text([root])


def extracted(page: Column) -> Column:
    """Main text of a column of pages; never null."""

    @F.pandas_udf(T.StringType())
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p if isinstance(p, str) else None) for p in pages], dtype=object)

    return extract(page)


def report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.  A null or empty page has an empty
    text; repeated rows are each returned; other columns, also of these names,
    are left alone; an empty table gives an empty result."""
    out = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
