"""Main text of web pages by tree scoring.

Paragraph-like elements earn points for their length and their commas, discounted by the share of their text that is
in links, and pass them to their ancestors, the farther the less. The ancestor with the highest score, itself
discounted by its link density, is the best container. Where it lies in an article, the outermost one is taken whole; else
the main it lies in; else it widens to a parent below the body as long as most of that parent's points are its own and
nothing beside it is mostly links. What stands beside the way from there to the best container stays but for lists and
groups that are mostly links. Siblings of the container are kept too where they score well beside it or hold a real
paragraph. Elements that never belong to an article (menus, page headers and footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments) are cut before scoring, by tag, role, or the words of class and id. A name
that also has words of neither kind nor place ("social-security") is a weak reason: what bears it goes only where it is
mostly links or, outside articles and mains, short.
Of what a role, a word or a form alone would cut, an element is spared, and what is within it judged anew, when it is
round the article itself: when it holds more than two thirds of the page's points, the page's only main, or articles
with more points than all that is left beside what is cut.
Reader comments are spared only where no point is left beside what is cut. A spared form loses its controls.

The text is the kept elements' blocks in page order. Inside a block white space becomes one space and ends are
trimmed; blocks are joined by two line ends. Character references are decoded. Nothing else is dropped or capped.

Defined results: a null or empty page, or one without any text outside what is cut, gives the empty text; unclosed,
cut-off and crossed markup is read as browsers do, as far as it bears on blocks (what a head cannot hold ends it); pages are read one by one, so
repeated rows, ties and extra columns change nothing. Of containers with equal scores the first in the page is taken.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.common import map_slices

# Elements of the HTML standard by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CUT = set("aside button canvas datalist dialog footer head iframe input map menu nav noscript object option script select style svg template textarea title".split())
PARAGRAPH = set("p pre blockquote td li dd h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCK - {"html", "body"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = set("base link meta noscript script style template title".split())
#: A start tag of the key closes an open element of the values, unless one of the third stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words of class and id, and roles, of what is not the article.
CUT_WORDS = set(
    "ad ads adslot adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted recommended related remark replies respond "
    "share sharing shoutbox sidebar sidenav signup skyscraper social sponsor sponsored subscribe toolbar topbar widget".split()
)
#: Words of kind and place that make a name no less of a reason.
PLAIN_WORDS = set(
    "a an and area article articles bar big block blog body bottom box btn button buttons by card center cell col column columns container content cover desktop dropdown element fixed float floating frame "
    "global grid group header head holder hover icon icons id in inline inner item items js layout left lg link links list lower main md media mobile mod module more news of overlay outer page panel "
    "part pane primary post posts right row rt rail section secondary shell side site slot sm small sticky story stories strip tab tablet teaser text the title top unit upper user view wide wrap wrapper x xl xs".split()
)
COMMENT_WORDS = set("comment comments commentlist disqus remark replies respond shoutbox".split())
CUT_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

POINT_CHARS, MOST_LENGTH_POINTS = 100, 3.0
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0
SPARED_SHARE = 2 / 3
REAL_CHARS, REAL_LINKS = 80, 0.25
#: Below an element are mostly links; an element with a weak reason to be cut is short; most of a parent's points.
MOSTLY_LINKS, SHORT_POINTS, MOST_POINTS = 0.5, 3.0, 0.5
WORD, RUN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])"), re.compile("[A-Za-z]+")


UNFINISHED = re.compile(r"<[A-Za-z/!?]")


class Node:
    __slots__ = ("tag", "parent", "children", "score", "chars", "link_chars", "order", "doubt")

    def __init__(self, tag: str, parent: Node | None, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.children: list[Node | str] = []
        self.score, self.chars, self.link_chars = 0.0, 0, 0
        self.doubt = ""  # why it may be cut: "named", "weak", "comments" or nothing

    @property
    def link_density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0


class Tree(HTMLParser):
    """The page's elements without those that are cut for certain."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None, 0)
        self.nodes = [self.root]
        self.stack = [self.root]
        self.cut = 0  # depth of the stack at which a cut element began
        self.open: defaultdict[str, list[int]] = defaultdict(list)  # depths of the stack by tag

    def handle_starttag(self, tag, attrs):
        if self.open["head"] and tag not in IN_HEAD and (tag == "body" or self.stack[-1].tag == "head"):
            self._pop_to(self.open["head"][0])
        self._close_implied(tag)
        if tag in VOID:
            if not self.cut:
                self.stack[-1].children.append(Node(tag, self.stack[-1], -1))
            return
        if tag in ("html", "body"):
            return
        node = Node(tag, self.stack[-1], len(self.nodes))
        self.open[tag].append(len(self.stack))
        self.stack.append(node)
        if self.cut:
            return
        if self._is_cut(tag, attrs):
            self.cut = len(self.stack) - 1
            return
        node.doubt = self._doubt(tag, attrs)
        node.parent.children.append(node)
        self.nodes.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML has no self-closing elements but the void ones

    def handle_endtag(self, tag):
        if self.open[tag]:
            self._pop_to(self.open[tag][-1])

    def handle_data(self, data):
        if self.stack[-1].tag == "head" and data.strip():
            self._pop_to(len(self.stack) - 1)
        if not self.cut:
            self.stack[-1].children.append(data)

    def parse_comment(self, i, report=1):
        """As browsers do: to the first end, or to the end of the page, which is then reached at once."""
        end = self.rawdata.find("-->", i + 2)
        return end + 3 if end >= 0 else len(self.rawdata)

    def _pop_to(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.open[node.tag].pop()
        del self.stack[depth:]
        if self.cut and depth <= self.cut:
            self.cut = 0

    def _close_implied(self, tag: str) -> None:
        if tag in CLOSES:
            closed, stops = CLOSES[tag]
            stop = max((self.open[t][-1] for t in stops if self.open[t]), default=0)
            after = [self.open[t][bisect_right(self.open[t], stop)] for t in closed if self.open[t] and self.open[t][-1] > stop]
            if after:
                self._pop_to(min(after))
        if tag in ENDS_P and self.open["p"]:  # nothing but inline elements can be open within it
            self._pop_to(self.open["p"][-1])

    def _is_cut(self, tag: str, attrs) -> bool:
        if tag in CUT:
            return True
        if tag == "header":  # an article's own header has its heading
            return not (self.open["article"] or self.open["main"])
        return tag not in ("article", "main") and any(name == "hidden" for name, _ in attrs)

    def _doubt(self, tag: str, attrs) -> str:
        if tag in ("article", "main"):
            return ""
        values = dict(attrs)
        names = f"{values.get('class') or ''} {values.get('id') or ''}".split()
        words = [_words(n) for n in names]
        if any(not (runs | parts).isdisjoint(COMMENT_WORDS) for runs, parts in words):
            return "comments"
        if tag == "form" or (values.get("role") or "").lower() in CUT_ROLES:
            return "named"
        listed = [(runs, parts) for runs, parts in words if not (runs | parts).isdisjoint(CUT_WORDS)]
        known = CUT_WORDS | PLAIN_WORDS
        return "" if not listed else "named" if any(runs <= known or parts <= known for runs, parts in listed) else "weak"


def _words(name: str) -> tuple[set[str], set[str]]:
    """The runs of letters of a name, and its words, which capitals begin too."""
    return {w.lower() for w in RUN.findall(name)}, {w.lower() for w in WORD.findall(name)}


def _measure(tree: Tree) -> None:
    """Text and link text below every element; later nodes are never ancestors of earlier ones."""
    for node in reversed(tree.nodes):
        node.chars = node.link_chars = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(" ".join(child.split()))
            elif child.order >= 0:
                node.chars += child.chars
                node.link_chars += child.chars if child.tag == "a" else child.link_chars


def _direct_text(node: Node) -> str:
    """The text of an element outside blocks within it."""
    out, todo = [], [iter(node.children)]
    while todo:
        for child in todo[-1]:
            if isinstance(child, str):
                out.append(child)
            elif child.tag not in BLOCK:
                todo.append(iter(child.children))
                break
        else:
            todo.pop()
    return " ".join("".join(out).split())


def _points(node: Node) -> float:
    if node.tag not in PARAGRAPH and node.tag not in BLOCK:
        return 0.0
    text = _direct_text(node)
    return (1 + text.count(",") + min(len(text) / POINT_CHARS, MOST_LENGTH_POINTS)) * (1 - node.link_density) if text else 0.0


def _cut_doubtful(tree: Tree) -> None:
    """Cut the elements in doubt but for those that are spared."""
    if not any(n.doubt for n in tree.nodes):
        return
    within = [_points(n) for n in tree.nodes]  # below each element
    named, mains = [0.0] * len(within), [0.0] * len(within)  # of these, in articles and mains, and in mains
    clear = [not n.doubt for n in tree.nodes]  # nothing round it is in doubt
    inside = [n.tag in ("article", "main") for n in tree.nodes]
    for n in tree.nodes[1:]:
        clear[n.order] &= clear[n.parent.order]
        inside[n.order] |= inside[n.parent.order]
    left = sum(x for x, c in zip(within, clear, strict=True) if c)
    for n in reversed(tree.nodes):
        if n.tag in ("article", "main"):
            named[n.order] = within[n.order]
        if n.tag == "main":
            mains[n.order] = within[n.order]
        if n.parent is not None:
            for sums in (within, named, mains):
                sums[n.parent.order] += sums[n.order]
    main_left = any(n.tag == "main" and clear[n.order] and within[n.order] for n in tree.nodes)

    def spared(n: Node) -> bool:
        if n.doubt == "comments" and left > 0:
            return False
        if n.doubt == "weak" and n.link_density < MOSTLY_LINKS and (inside[n.order] or within[n.order] >= SHORT_POINTS):
            return True
        return within[n.order] > SPARED_SHARE * within[0] or named[n.order] > left or (mains[n.order] > 0 and not main_left)

    kept = [True] * len(within)
    for n in tree.nodes[1:]:
        kept[n.order] = kept[n.parent.order] and (not n.doubt or spared(n))
    for n in tree.nodes:
        n.children = [c for c in n.children if isinstance(c, str) or c.order < 0 or kept[c.order]]
    tree.nodes = [n for n in tree.nodes if kept[n.order]]
    _measure(tree)


def _score(tree: Tree) -> None:
    for node in tree.nodes:
        points = _points(node)
        if not points:
            continue
        # A block with text of its own, paragraph or not, speaks for those around it; a bare one for itself too.
        above, depth = (node.parent, 1) if node.tag in PARAGRAPH else (node, 1)
        while above is not None and depth <= 5:
            above.score += points / (1, 1, 2, 6, 9, 12)[depth]
            above, depth = above.parent, depth + 1


def _is_links(n: Node | str) -> bool:
    """A list or a group of mostly links; a heading or a paragraph that is a link may belong to the text."""
    return not isinstance(n, str) and n.tag in BLOCK and n.tag not in PARAGRAPH and n.link_density > MOSTLY_LINKS


def _widened(tree: Tree, best: Node) -> Node:
    """The article or main that a container lies in, or a parent that it is most of; what is mostly links beside it goes."""
    way = [best]
    while way[-1].parent is not None:
        way.append(way[-1].parent)
    named = [i for tag in ("article", "main") for i, n in enumerate(way) if n.tag == tag]
    if named:
        articles = [i for i in named if way[i].tag == "article"]
        top = max(articles or named)
    else:
        points = {}
        for n in reversed(tree.nodes):
            points[n.order] = points.get(n.order, 0.0) + _points(n)
            if n.parent is not None:
                points[n.parent.order] = points.get(n.parent.order, 0.0) + points[n.order]
        top = 0
        while way[top].parent is not None and way[top + 1].parent is not None:
            beside = [c for c in way[top + 1].children if c is not way[top]]
            if points[way[top].order] <= MOST_POINTS * points[way[top + 1].order] or any(map(_is_links, beside)):
                break
            top += 1
    for i in range(1, top + 1):
        way[i].children = [c for c in way[i].children if c is way[i - 1] or not _is_links(c)]
    return way[top]


def _kept(tree: Tree) -> list[Node]:
    """The main container and the siblings kept with it, in page order."""
    scored = [n for n in tree.nodes if n.score > 0]
    if not scored:
        return [tree.root]
    value = {n.order: n.score * (1 - n.link_density) for n in scored}
    best = max(scored, key=lambda n: (value[n.order], -n.order))
    if best.parent is None:
        return [best]
    main = _widened(tree, best)
    least = max(SIBLING_LEAST, SIBLING_SHARE * value[best.order])
    kept = []
    for n in main.parent.children:
        if isinstance(n, str) or n.order < 0:
            continue
        real = n.tag == "p" and n.chars > REAL_CHARS and n.link_density < REAL_LINKS
        heading = n.tag in HEADINGS and n.order < main.order and n.link_density < REAL_LINKS
        if n is main or value.get(n.order, 0.0) >= least or real or heading:
            kept.append(n)
    return kept


def _blocks(node: Node) -> list[str]:
    out, inline, todo = [], [], [(node, iter(node.children))]

    def close() -> None:
        if text := " ".join("".join(inline).split()):
            out.append(text)
        inline.clear()

    while todo:
        owner, rest = todo[-1]
        for child in rest:
            if isinstance(child, str):
                inline.append(child)
            elif child.tag in VOID:
                if child.tag == "br":
                    inline.append(" ")
                elif child.tag == "hr":
                    close()
            else:
                if child.tag in BLOCK:
                    close()
                todo.append((child, iter(child.children)))
                break
        else:
            if owner.tag in BLOCK:
                close()
            todo.pop()
    close()
    return out


def extract(page: str | None) -> str:
    """The main text of one whole page."""
    if not page:
        return ""
    tree = Tree()
    ended = page.rfind(">") + 1
    unfinished = UNFINISHED.search(page, ended)  # a tag that the page's end cuts off is none
    tree.feed(page[: unfinished.start()] if unfinished else page)
    tree.close()
    _measure(tree)
    _cut_doubtful(tree)
    _score(tree)
    return "\n\n".join(b for n in _kept(tree) for b in _blocks(n))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page. One pass, no shuffle."""
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [source.schema[c].dataType for c in ("page_id", "url")]
    schema = pa.schema([("page_id", to_arrow_type(kinds[0])), ("url", to_arrow_type(kinds[1])), ("text", pa.string()), ("n_chars", pa.int64())])

    def make():
        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [extract(x) for x in batch.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

        return kernel

    return map_slices(source, schema, f"page_id {kinds[0].simpleString()}, url {kinds[1].simpleString()}, text string, n_chars long", make)
