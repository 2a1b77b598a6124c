"""HTML extraction (operator 3): main text by tree scoring.

A page becomes a tree. Subtrees that never are article text go first: scripts,
styles, forms and the like, navigation, headers, footers, asides, hidden
parts, and those whose class, id or role names a menu, advert, notice, comment
list and so on. An article or main element never goes for its name, nor does
what lies around one, nor a form around one; inside another article or main (a
comment list) it stays out unless it holds more text than is left there. Where
no article lies inside, a form stays if it holds more than what is left of the
page or the article, and a part where the name is but part of a longer one
("share-enabled") if it holds more than ten times that. Each remaining paragraph passes points to its ancestors, one
and one more for every comma and every hundred characters up to three, half as
many to each further level, discounted by the share of its text that stands in
links. The container with most points is the best one, grown to the article
or main element it lies in. Of its siblings every article or main element is
kept, and whatever isn't mostly links and holds a paragraph or has a fifth of
the best one's points, however short. A page without any paragraph points yields its article or main
element, else its body.

The text is that of the kept containers in page order: white space inside a
block becomes one space, blocks are joined by one space, ``br`` counts as white
space. Character references are decoded. Nothing is dropped or cut beyond that.
Null, empty or blank html gives an empty text; unclosed and stray tags are
borne. Repeated rows each give a row; other columns pass through, one whose
name equals an output's is replaced.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from pmflow.llm.common import append_columns, column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without article text, with all they hold.
DROP = frozenset("""script style noscript template head title nav header footer aside button select textarea
    input label fieldset iframe object embed svg math canvas audio video dialog menu datalist option""".split())
BLOCK = frozenset("""address article blockquote body caption center dd details div dl dt fieldset figcaption figure
    h1 h2 h3 h4 h5 h6 hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul
    nav header footer aside form dialog menu""".split())
#: Elements whose start closes an open paragraph.
ENDS_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: An element's start closes an open one of these, up to a container of `UNTIL`.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
UNTIL = frozenset(("ul", "ol", "dl", "table"))
MAIN_ROLES = frozenset(("main", "article"))
DROP_ROLES = frozenset("""navigation banner contentinfo complementary search menu menubar toolbar dialog
    alertdialog alert status tablist""".split())
#: Names in a class or id that mark a part as no article text, as whole words.
_NAMES = r"(?:^|[\s_-])(?:%s)(?:$|[\s_-])"
_OUT = r"""ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|breadcrumbs?|comments?|comment-?list|
    disqus|replies|respond|discussion|notice|notification|newsletter|subscri\w+|sign-?up|login|share|sharing|related|
    recommend\w*|pagination|pager|skip-?link|visually-hidden|sr-only|disclaimer|outbrain|taboola|toc"""
DROP_NAMES = re.compile(_NAMES % _OUT, re.X | re.I)
#: The same, also undone by an article or main element inside that lies in another one.
_AROUND = r"""banner|nav\w*|menu\w*|side-?bar\w*|foot(?:er)?|header|masthead|cookies?|consent|
    gdpr|alert|popup|modal|overlay|social|toolbar|widget\w*|hidden"""
DROP_AROUND = re.compile(_NAMES % _AROUND, re.X | re.I)
WHOLE_NAME = re.compile(f"(?:^|\\s)(?:{_OUT}|{_AROUND})(?:$|\\s)", re.X | re.I)
#: A part that may stay does so if less than this share of its text is left without it.
FORM_LEFT, PART_LEFT = 1.0, 0.1
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements with text of their own that scores.
PARAGRAPH = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
SIBLING_SHARE = 0.2
#: From this share of its text in links on, a sibling is a list of links.
LINKED = 0.5


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "loose", "around", "left", "main", "points", "text_len", "link_len",
                 "whole", "rest")

    def __init__(self, tag: str, parent, drop: bool = False, loose: bool = False, around: bool = False,
                 left: float = 0.0, main: bool = False):
        self.tag, self.parent, self.around, self.left, self.main = tag, parent, around, left, main
        self.loose = loose and not drop  # dropped for now
        self.drop = drop or loose
        self.children: list = []  # nodes and strings
        self.points, self.text_len, self.link_len = 0.0, 0, 0


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.loose = False

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body", "head") and any(tag == n.tag for n in self._open()):
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self.at.children.append(Node(tag, self.at))
            return
        if tag in ENDS_P:
            self._close({"p"}, frozenset(("table", "td", "th", "button")))
        if tag in CLOSES:
            self._close(CLOSES[tag], UNTIL)
        node = Node(tag, self.at, *_kind(tag, attrs))
        self.loose |= node.loose
        if node.main and not node.drop:
            within = False
            for n in reversed([*self._open()]):
                if n.loose and (n.around or not within):
                    n.drop = n.loose = False
                elif n.loose:
                    n.left = FORM_LEFT
                within |= n.main
        self.at.children.append(node)
        self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # "/>" means nothing on other than void elements

    def handle_endtag(self, tag):
        if tag == "br":
            self.at.children.append(Node("br", self.at))
        for n in self._open():
            if n.tag == tag:
                self.at = n.parent or n
                return
            if n.tag in BLOCK and tag not in BLOCK:  # a stray end doesn't close a block
                return

    def handle_data(self, data):
        self.at.children.append(data)

    def unknown_decl(self, data):  # <![CDATA[...]]> in html is a comment
        pass

    def _open(self):
        n = self.at
        while n is not None:
            yield n
            n = n.parent

    def _close(self, tags, until):
        target = None
        for n in self._open():
            if n.tag in until:
                break
            if n.tag in tags:
                target = n
        if target is not None:
            self.at = target.parent


def _kind(tag, attrs) -> tuple[bool, bool, bool, float, bool]:
    """Whether an element is dropped; whether it is so unless something speaks
    against it, whether an article inside always does, and the share of its
    text that must be left without it (0: any); whether it is an article or
    main."""
    main, drop, form, named, around, whole = tag in ("article", "main"), tag in DROP, tag == "form", False, False, False
    for k, v in attrs:
        v = v or ""
        if k == "role":
            role = v.strip().lower()
            main, form, drop = main or role in MAIN_ROLES, form or role == "form", drop or role in DROP_ROLES
        elif k in ("class", "id"):
            if tag not in ("body", "html"):
                names, arounds = bool(DROP_NAMES.search(v)), bool(DROP_AROUND.search(v))
                named, around = named or names, around or arounds
                whole = whole or (names or arounds) and bool(WHOLE_NAME.search(v))
        elif k == "hidden" or k == "aria-hidden" and v.strip().lower() == "true":
            drop = True
        elif k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v, re.I):
            drop = True
    left = 0.0 if whole else PART_LEFT if named or around else FORM_LEFT
    return drop, (form or named or around) and not main, around and not named and not form, left, main


def _settle(root: Node) -> None:
    """Takes back the loose drops that would leave too little."""
    nodes = [root]
    for n in nodes:  # grows
        nodes.extend(c for c in n.children if isinstance(c, Node) and (c.loose or not c.drop))
    for n in reversed(nodes):
        n.whole = n.rest = 0
        for c in () if n.tag in HEADINGS else n.children:
            if isinstance(c, str):
                n.whole += len(c.strip())
                n.rest += len(c.strip())
            elif c.loose or not c.drop:
                n.whole += c.whole
                n.rest += 0 if c.drop else c.rest
    todo = [(root, root.rest)]
    while todo:
        n, rest = todo.pop()
        for c in n.children:
            if isinstance(c, str) or c.drop and not (c.loose and rest < c.left * c.whole):
                continue
            inner = rest + c.rest if c.drop else rest
            c.drop = c.loose = False
            todo.append((c, c.rest if c.main else inner))


def _walk(root: Node) -> list[Node]:
    """The nodes that aren't dropped, parents before children."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(c for c in reversed(n.children) if isinstance(c, Node) and not c.drop)
    return out


def _score(nodes: list[Node]) -> None:
    links = {}
    for n in nodes:
        links[n] = n.tag == "a" or (n.parent in links and links[n.parent])
    commas = dict.fromkeys(nodes, 0)
    for n in reversed(nodes):  # children before parents
        for c in n.children:
            if isinstance(c, str):
                k = len(" ".join(c.split()))
                n.text_len += k
                n.link_len += k if links[n] else 0
                commas[n] += c.count(",") + c.count("،") + c.count("、") + c.count("，")
            elif not c.drop:
                n.text_len += c.text_len
                n.link_len += c.link_len
                if c.tag not in BLOCK:
                    commas[n] += commas[c]
    for n in nodes:
        bare = n.tag in ("div", "section", "article", "main", "body") and any(
            isinstance(c, str) and c.strip() for c in n.children)
        if n.text_len and (n.tag in PARAGRAPH or bare):
            points = 1 + commas[n] + min(n.text_len / 100, 3.0)
            up = n if bare else n.parent
            while up is not None and points >= 0.05:
                up.points += points
                up, points = up.parent, points / 2
    for n in nodes:
        if n.text_len:
            n.points *= 1 - n.link_len / n.text_len


def _kept(root: Node) -> list[Node]:
    """The containers whose text is the page's."""
    nodes = _walk(root)
    _score(nodes)
    containers = [n for n in nodes if n.tag in BLOCK and n.tag not in PARAGRAPH and n.text_len]
    mains = [n for n in containers if n.main]
    best = max(mains or containers or [root], key=lambda n: n.points)  # of equal ones the outermost, first one
    up = best.parent
    while up is not None:
        if up.main:
            best = up
        up = up.parent
    if best.parent is None:
        return [best]
    least = SIBLING_SHARE * best.points
    paragraphs = set()  # nodes that are or hold one
    for n in reversed(nodes):
        if n.text_len and n.tag in PARAGRAPH or n in paragraphs:
            paragraphs.update((n, n.parent))
    out = []
    for c in best.parent.children:
        if c is best:
            out.append(c)
        elif isinstance(c, Node) and not c.drop and c.text_len:
            if c.main or c.link_len < LINKED * c.text_len and (c in paragraphs or c.points >= least):
                out.append(c)
    return out


def _text(kept: list[Node]) -> str:
    """Blocks in page order, each with single spaces."""
    parts: list[str] = []
    todo: list = [*reversed(kept)]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            parts.append(n)
        elif n.tag == "br":
            parts.append(" ")
        elif not n.drop:
            if n.tag in BLOCK:
                parts.append(" ")
                todo.append(" ")
            todo.extend(reversed(n.children))
    return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    if not html or html.isspace():
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    if tree.loose:
        _settle(tree.root)
    return _text(_kept(tree.root))


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in ``out``; ``html`` goes."""
    return append_columns(pages, {"html": column(html).cast("string")}, f"{out} string",
                          lambda: lambda html: [[main_text(h) for h in html]], [html])
