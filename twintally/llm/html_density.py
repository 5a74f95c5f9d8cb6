r"""HTML main text by composite text density.

The page becomes a small tree. Menus, adverts, forms, comments and the like are
cut by tag and role first, and by class name where the block is small, mostly
links, without prose, or beside an article. Every remaining node then has a composite
density, its characters per tag adjusted for link text, and a density sum over
its children. The node of greatest sum chooses the article: the outermost
<article> around it, else the nearest <main>, else the block that holds it and
its sibling paragraphs, headings, lists and sections. All that is left of that
block is content, however thin a part of it. The node also sets a threshold, the
least density on its path up to the body: from the body down, every node at or
above it marks the node of greatest sum in its subtree as content too. The text
of marked subtrees is joined block by block in page order.

Inside a block white space becomes one space (a <br> is white space); blocks are
joined by one \n. Defined cases: NULL, empty and text-free pages give an empty
text; unclosed or stray tags, truncated pages and plain text without tags are
read as a browser would, never an error; repeated rows are each extracted;
an empty table gives no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes xmp template textarea title".split())
#: a block that starts in one of these ends it, closed or not
ENDED_BY_BLOCKS = frozenset("svg math select".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul").split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
          "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: an implied end tag does not reach past these
SCOPE = frozenset("table ul ol dl html body div article section main".split())
#: parts that are no article, by tag, by role, and by a word of class or id
CUT_TAGS = frozenset("nav aside footer form button input label dialog menu head svg select".split()) | RAW
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CUT_WORDS = frozenset(("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion "
                       "banner cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe "
                       "signup login share sharing social sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination "
                       "pager comment comments commentlist disqus reply replies respond related recommended footer masthead "
                       "toolbar widget skip search copyright").split())
#: a listed word after one of these says what the block is not
NEGATIONS = frozenset("has no not non with without".split())
#: readers' words may outweigh the article they follow
REPLY_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|([^\s=/\"'<>]+)")
_HEADING = re.compile(r"h[1-6]\Z")


class Node:
    __slots__ = ("tag", "attrs", "up", "kids", "chars", "tags", "link_chars", "link_tags", "density", "sum", "best", "marked",
                 "has_body", "has_prose")

    def __init__(self, tag: str, attrs: str = "", up: Node | None = None):
        self.tag, self.attrs, self.up, self.kids, self.marked = tag, attrs, up, [], False


def parse(html: str) -> Node:
    """The element tree; text pieces stand between the child nodes as strings."""
    root = here = Node("html")
    at = 0
    n = len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            here.kids.append(unescape(html[at:]))
            break
        if m.start() > at:
            here.kids.append(unescape(html[at:m.start()]))
        at = m.end()
        tag = m[2]
        if tag is None or (not m[4] and at == n):      # comment, declaration, or a tag cut off by the end
            continue
        tag = tag.lower()
        if m[1]:
            node = here
            while node is not None and node.tag != tag:
                # a stray inline end tag does not close blocks around it
                node = None if tag not in BLOCK and node.tag in BLOCK else node.up
            if node is not None and node.up is not None:
                here = node.up
            elif tag == "p":
                here.kids.append(Node("p", "", here))
            continue
        if tag in ("html", "body"):
            if tag == "body" and not any(isinstance(k, Node) and k.tag == "body" for k in root.kids):
                here = Node("body", m[3], root)
                root.kids.append(here)
            continue
        if tag in BLOCK:                               # a block ends the paragraph that is open
            node = here
            while node is not None and node.tag not in BLOCK and node.tag not in ENDED_BY_BLOCKS and node.tag != "foreignobject":
                node = node.up
            if node is not None and node.tag in ENDED_BY_BLOCKS:
                here = node.up
            node = here
            while node is not None and node.tag != "p" and node.tag not in BLOCK:
                node = node.up
            if node is not None and node.tag == "p":
                here = node.up
        if tag in CLOSES:
            node = here
            while node is not None and node.tag not in SCOPE:
                if node.tag in CLOSES[tag]:
                    here = node.up
                node = node.up
        node = Node(tag, m[3], here)
        here.kids.append(node)
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            at = n if end is None else end.start()
            if end is not None:
                here = node
        elif tag not in VOID and not (m[3].endswith("/") and tag not in BLOCK):
            here = node
    return root


def _attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[3]).lower(): unescape((m[2] or "").strip("\"'")) for m in _ATTR.finditer(raw)}


_BODY_TAGS = frozenset(("article", "main", "h1"))
_PROSE = frozenset(("p", "blockquote", "pre", "section", "table"))


def is_cut(node: Node, inside: bool, keep_forms: bool = False) -> bool:
    """Whether tag, role or style say that the node is no part of an article; ``inside``: it stands in one."""
    tag = node.tag
    if tag in CUT_TAGS and not (keep_forms and tag in ("form", "label")) and not (inside and tag == "label"):
        return True
    if tag == "header":
        return not (inside and any(isinstance(k, Node) and _HEADING.match(k.tag) for k in node.kids))
    if not node.attrs or tag in ("html", "body", "article", "main"):
        return False
    a = _attributes(node.attrs)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or \
            re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    return a.get("role", "").lower() in CUT_ROLES


def listed_words(node: Node) -> set[str]:
    """The listed words of class and id, without those that are negated."""
    if not node.attrs or node.tag in ("html", "body", "article", "main"):
        return set()
    a = _attributes(node.attrs)
    found, before = set(), ""
    for name in f"{a.get('class', '')} {a.get('id', '')}".split():
        for word in re.split(r"[_\-:]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()):
            if word in CUT_WORDS and before not in NEGATIONS:
                found.add(word)
            before = word
        before = ""
    return found


def _sizes(root: Node) -> None:
    """chars and link_chars of every node, without what its tag cuts, and whether an article's body or prose lies below it."""
    for x in _postorder(root):
        below = [k for k in x.kids if isinstance(k, Node)]
        x.has_body = any(k.has_body or k.tag in _BODY_TAGS for k in below)
        x.has_prose = any(k.has_prose or k.tag in _PROSE for k in below)
        kids = [k for k in x.kids if isinstance(k, Node) and k.tag not in CUT_TAGS]
        x.chars = sum(k.chars for k in kids) + sum(len(k.strip()) for k in x.kids if isinstance(k, str))
        x.link_chars = x.chars if x.tag == "a" else sum(k.link_chars for k in kids)


def _by_words(node: Node, words: set[str], around: Node, in_article: bool, has_article: bool) -> bool:
    """Whether the listed words of a block make it go. They do in a block that is small against the article or page
    ``around`` it, mostly links, or without prose; a larger one goes beside an article, or as readers' replies in one."""
    if node.has_body:
        return False
    if 2 * node.chars <= around.chars or 2 * node.link_chars > node.chars or not node.has_prose:
        return True
    if in_article:
        return not words.isdisjoint(REPLY_WORDS)
    return has_article


def _prune(root: Node, keep_forms: bool, by_words: bool = True) -> tuple[int, int]:
    """Cuts what is no article; gives the characters that class words cut, and of how many (0: an article holds the text)."""
    _sizes(root)
    whole = root.chars
    has_article = any(x.tag in ("article", "main") and x.chars for x in _postorder(root))
    cut = 0
    todo = [(root, root, False)]
    while todo:
        node, around, inside = todo.pop()
        if node.tag in ("article", "main"):
            around, inside = node, True
        kids = []
        for k in node.kids:
            if isinstance(k, Node):
                if is_cut(k, inside, keep_forms):
                    continue
                words = listed_words(k)
                if words and (by_words or 2 * k.link_chars > k.chars or not k.has_prose) and \
                        _by_words(k, words, around, inside, has_article):
                    cut += k.chars
                    continue
                todo.append((k, around, inside))
            kids.append(k)
        node.kids = kids
    return cut, 0 if has_article else whole


def _postorder(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [k for k in node.kids if isinstance(k, Node)]
    return order[::-1]


def measure(body: Node) -> None:
    """Counts, composite densities, density sums, and the best sum of each subtree.

    Nodes are blocks; inline elements belong to the block around them, and of
    these only links count as tags, for the link adjustment.
    """
    nodes = _postorder(body)
    for x in nodes:
        kids = [k for k in x.kids if isinstance(k, Node)]
        x.chars = sum(len(k.strip()) if isinstance(k, str) else k.chars for k in x.kids)
        x.tags = sum(k.tags + (k.tag in BLOCK or k.tag == "a") for k in kids)
        link = x.tag == "a"
        x.link_chars = x.chars if link else sum(k.link_chars for k in kids)
        x.link_tags = x.tags if link else sum(k.link_tags + (k.tag == "a") for k in kids)
    ratio = body.link_chars / max(body.chars, 1)
    for x in nodes:
        if x.chars:
            odds = x.chars / max(x.link_chars, 1) * max(x.tags, 1) / max(x.link_tags, 1)
            base = x.chars / max(x.chars - x.link_chars, 1) * x.link_chars + ratio * x.chars + math.e
            x.density = x.chars / max(x.tags, 1) * math.log(max(odds, 1)) / math.log(math.log(base) + math.e - 1)
        else:
            x.density = 0.0
        kids = [k for k in x.kids if isinstance(k, Node)]
        x.sum = sum(k.density if k.tag in BLOCK else k.sum for k in kids)
        x.best = x if x.tag in BLOCK or x is body else None
        for k in kids:
            if k.best is not None and (x.best is None or k.best.sum > x.best.sum):
                x.best = k.best


def _link_list(node: Node) -> bool:
    """A list that is mostly links: a menu, unless it stands in an article (references, contents)."""
    return node.tag in ("ul", "ol", "dl") and node.link_tags >= 2 and node.link_chars > 0.8 * node.chars


#: blocks that are parts of an article when they stand beside its densest part
PARTS = frozenset("p section blockquote h1 h2 h3 h4 h5 h6 ul ol dl table pre figure details".split())


def _part(node: Node) -> bool:
    return node.tag in PARTS and 2 * node.link_chars <= node.chars and node.chars > 0


def _article(top: Node, body: Node) -> list[Node]:
    """The nodes that make up the article whose densest part is ``top``."""
    around, main = None, None
    node = top
    while node is not None:
        if node.tag == "article":
            around = node
        elif node.tag == "main" and main is None:
            main = node
        node = None if node is body else node.up
    if around is not None or main is not None:
        return [around or main]
    held = node = top
    while node is not body:
        beside = [k for k in node.up.kids if k is not node and (k.strip() if isinstance(k, str) else k.chars)]
        parts = [k for k in beside if isinstance(k, Node) and _part(k)]
        if node.up is body:
            return [held, *parts]
        if parts:
            held = node.up
        elif beside:
            break
        node = node.up
    return [held]


def _text(root: Node) -> str:
    """Text of the marked subtrees: white space in a block is one space, blocks joined by one \\n."""
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        line = " ".join("".join(held).split())
        held.clear()
        if line:
            blocks.append(line)

    todo: list = [(root, root.marked, root.tag in ("article", "main"))]
    while todo:
        node, marked, inside = todo.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            if marked:
                held.append(node)
        elif node.tag == "br":
            held.append(" ")
        elif inside or not _link_list(node):
            marked = marked or node.marked
            inside = inside or node.tag in ("article", "main")
            block = node.tag in BLOCK
            if block:
                flush()
                todo.append((None, False, False))
            todo += [(k, marked, inside) for k in reversed(node.kids)]
    flush()
    return "\n".join(blocks)


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    for keep_forms in (False, True):
        root = parse(html)
        body = next((k for k in root.kids if isinstance(k, Node) and k.tag == "body"), root)
        cut, whole = _prune(body, keep_forms)
        if 2 * cut > whole > 0:                        # class words took most of the page: only menus and bare blocks go by them
            root = parse(html)
            body = next((k for k in root.kids if isinstance(k, Node) and k.tag == "body"), root)
            _prune(body, keep_forms, by_words=False)
        measure(body)
        if body.chars:
            break
    else:
        return ""
    top = body.best
    for x in _article(top, body):
        x.marked = True
    path, least = top, math.inf
    while path is not None:
        if path.tag in BLOCK or path is body:
            least = min(least, path.density)
        if path.tag in ("article", "main"):            # the headings of the article around the text are its own
            for x in _postorder(path):
                x.marked = x.marked or bool(_HEADING.match(x.tag))
        path = None if path is body else path.up
    for x in _postorder(body):
        if x.density >= least and x.chars and (x.tag in BLOCK or x is body):
            x.best.marked = True
    return _text(body)


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                rows = batch.slice(begin, 500)
                texts = [extract(x) for x in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
