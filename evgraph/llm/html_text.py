"""Main text of HTML pages by tree scoring.

A page is parsed into a tree, with the end tags that HTML lets authors omit supplied. Elements that are never article text (scripts,
styles, menus, asides, forms, page headers and footers, what is hidden or bears such a role) go first. Then those whose class or id
names no part of an article (an advert, a menu, a sidebar, reader comments), whatever their size, if the page has an article
outside of them: some prose under no such name. Where it has none, the largest of them is taken for a wrapper of the page, its
comments last, until there is. Inside an article, a section of prose with a heading is one of its parts, whatever its id, unless it
is an advert, comments or the like for certain. Words that articles use of their own parts, too (discussion, related, legal), count
only where the element is built like what they name: of links, controls or repeated replies. Every paragraph then gives points (one,
one for each comma, one for each hundred characters up to three) to its parent in full, to its grandparent by half and to further
ancestors by ever less; a container's points count by the share of its text that is outside links. The best container is kept (of
equal ones the first), or the article or main element that holds it, and those siblings of it that score near it, are articles or
dense prose. Several articles of one main element are all kept.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by two line
feeds in page order. Nothing else is dropped or capped.

Null and empty pages, and pages without a text, give an empty string; an empty table gives an empty result. Broken markup is read as
browsers do in the cases above; what is open at the end is closed. Very long pages are read whole. Repeated rows are read each; other
columns pass through, but for those named `text` or `n_chars`, which the results replace.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template", "svg", "math"}
RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Start tags that end an open element: of each, the open elements it ends, up to the nearest of the elements that hold it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}), "body": ({"head"}, set()),
}
PARAGRAPH_ENDS = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
DROPPED = {"nav", "aside", "form", "button", "select", "option", "input", "label", "fieldset", "menu", "dialog", "object", "embed", "canvas", "audio", "video", "map", "head", "datalist", "footer"} | RAW
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "form", "status", "note"}
def _words(said: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{said})(?=$|[\s_-])", re.I)


#: Words of class and id that name no part of an article.
UNLIKELY = _words(
    "ads?|adverts?|advertisements?|advertorial|banners?|sponsor(?:ed|s)?|promos?|promotions?|outbrain|taboola|nav|navbar|navigation|menus?|breadcrumbs?|crumbs?|pagination|pager|sidebars?|aside|widgets?|"
    "footer|footers|masthead|topbar|toolbar|headers?|cookies?|consent|gdpr|popups?|pop-up|modals?|overlay|newsletter|subscribe|subscription|signup|sign-up|login|share|sharing|social|"
    "comments?|commentlist|comment-list|disqus|respond|related-(?:posts?|articles?|stories|links|content|news|items?)|recommended|read-more|more-stories|trending|tagcloud|"
    "cookie-notice|searchbox|skip|sr-only|visually-hidden|author-bio|shoutbox"
)
#: Those of them that name no section of an article either.
CERTAIN = _words(
    "ads?|adverts?|advertisements?|advertorial|sponsor(?:ed|s)?|promos?|outbrain|taboola|breadcrumbs?|crumbs?|pagination|pager|sidebars?|footers?|masthead|topbar|toolbar|cookies?|cookie-notice|consent|gdpr|popups?|pop-up|modals?|"
    "newsletter|subscribe|signup|sign-up|share|sharing|comments?|commentlist|comment-list|disqus|respond|related-(?:posts?|articles?|stories|links|content|news|items?)|recommended|read-more|more-stories|tagcloud|searchbox|skip|sr-only|visually-hidden|author-bio|shoutbox"
)
#: Characters of prose that an article has at least.
LEAST = 40
#: Words that may name a part of an article.
AMBIGUOUS = _words("side|foot|notices?|alerts?|register|replies|reply|responses?|discussion|forum|related|recommendations?|popular|tags|disclaimer|copyright|legal|search|print|hidden|ratings?|remarks?")
COMMENTS = _words("comments?|commentlist|comment-list|disqus|replies|reply|respond|responses?|discussion|forum|shoutbox|remarks?")
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "attributes", "parent", "children", "points", "size", "linked", "commas", "alive")

    def __init__(self, name: str, attributes: str = "", parent: "Node | None" = None):
        self.name, self.attributes, self.parent, self.children = name, attributes, parent, []
        self.points, self.size, self.linked, self.commas, self.alive = 0.0, 0, 0, 0, True


def parse(html: str) -> Node:
    root = Node("#root")
    top, at, stack = root, 0, [root]

    def text(a: int, b: int) -> None:
        if b > a:
            stack[-1].children.append(unescape(html[a:b]))

    def close(k: int) -> None:
        del stack[k:]

    while (m := TOKEN.search(html, at)) is not None:
        text(at, m.start())
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>"))
            continue
        name = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    close(k)
                    break
                if name not in BLOCK and stack[k].name in BLOCK:
                    break  # an inline end tag doesn't reach out of its block
                if name == "p" or name == "li" and stack[k].name in ("ul", "ol"):
                    break
            continue
        if name in PARAGRAPH_ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    close(k)
                    break
                if stack[k].name in BLOCK or stack[k].name == "button":
                    break
        if name in ENDS:
            ended, within = ENDS[name]
            low = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in within:
                    break
                if stack[k].name in ended:
                    low = k
            if low is not None:
                close(low)
        node = Node(name, m[3] or "", stack[-1])
        stack[-1].children.append(node)
        if name in VOID or (m[3] and m[3].endswith("/") and name not in BLOCK and name not in RAW):
            continue
        if name in RAW:
            end = RAW_END[name].search(html, at)
            if name in ("textarea", "title"):
                node.children.append(unescape(html[at : end.start() if end else len(html)]))
            at = end.end() if end else len(html)
            continue
        stack.append(node)
    rest = html[at:]
    # a tag that the page's end cuts off is no text
    if (cut := re.search(r"<[/!a-zA-Z][^>]*\Z", rest)) is not None:
        rest = rest[: cut.start()]
    if rest:
        stack[-1].children.append(unescape(rest))
    return top


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(node.attributes)} if node.attributes.strip() else {}


#: Titles of articles, whose class may speak of a header.
TITLE = re.compile(r"(?:article|entry|post|story|content|page)[\s_-]*(?:headers?|head|title|heading)", re.I)
SMALL = {"p", "h1", "h2", "h3", "b", "i", "em", "strong", "span", "a"}


def never(node: Node, inside_article: bool) -> bool:
    """Whether a node is no part of an article by its element, or by what its attributes say for certain."""
    name = node.name
    if name in DROPPED:
        return True
    if name == "header" and not inside_article:
        return True
    if not node.attributes or name in ("html", "body"):
        return False
    of = attributes(node)
    return of.get("role", "").lower() in ROLES or of.get("aria-hidden", "").lower() == "true" or "hidden" in of or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", of.get("style", ""), re.I) is not None


def named(node: Node) -> str:
    """Class and id of a node, words in camel case apart; nothing where they don't matter."""
    if not node.attributes or node.name in ("html", "body", "main"):
        return ""
    of = attributes(node)
    return TITLE.sub(" ", re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{of.get('class', '')} {of.get('id', '')}".strip()))


def replies(node: Node, said: str) -> bool:
    """Whether a node is built like reader comments: a form to reply by, or items with a name or time of their own, or of replies."""
    if not COMMENTS.search(said):
        return False
    items = 0
    for x in order(node)[1:]:
        if x.name in ("form", "textarea", "input"):
            return True
        if x.name in ("li", "article", "div", "section") and (COMMENTS.search(named(x)) or any(isinstance(y, Node) and y.name in ("time", "cite", "address") for y in x.children)):
            items += 1
    return items >= 2


def controls(node: Node) -> bool:
    return any(x.name in ("form", "input", "button", "select", "textarea") for x in order(node)[1:])


def section(node: Node) -> bool:
    """Whether a node is built like a section of an article: headed prose, without controls and with few links."""
    if density(node) >= 0.25 or controls(node):
        return False
    inner = order(node)[1:]
    return any(x.name == "p" and x.size >= LEAST for x in inner) and (node.name == "section" or any(x.name in ("h1", "h2", "h3", "h4", "h5", "h6") for x in inner))


def own(node: Node) -> int:
    return node.size - node.linked


def unlike(nodes: list[Node], gone: set[int], beside, inside: dict[int, bool]) -> set[int]:
    """The nodes that go because their class or id names no part of an article."""
    named_so: dict[int, bool] = {}  # and whether they are comments
    for node in nodes if own(nodes[0]) >= LEAST else ():
        if id(node) in gone or node.name in SMALL or not (said := named(node)) or not UNLIKELY.search(said):
            continue
        if inside[id(node)] and not CERTAIN.search(said) and not replies(node, said) and section(node):
            continue
        named_so[id(node)] = COMMENTS.search(said) is not None
    out = {id(x) for x in nodes if id(x) in named_so and (beside(x) or named_so[id(x)] and replies(x, named(x)))}
    doubted = {x for x in named_so if x not in out}
    while doubted:
        # the topmost of them, and the page's prose outside all
        tops, rest, stack = [], own(nodes[0]), [nodes[0]]
        while stack:
            at = stack.pop()
            for x in at.children:
                if isinstance(x, Node) and id(x) not in gone:
                    if id(x) in doubted or id(x) in out:
                        rest -= own(x)
                        if id(x) in doubted:
                            tops.append(x)
                    else:
                        stack.append(x)
        if rest >= LEAST or not tops:
            return out | doubted
        wrapper = max(tops, key=lambda x: (not named_so[id(x)], own(x)))
        doubted.discard(id(wrapper))
    return out


def doubtful(node: Node, prose: int) -> bool:
    """Whether a node goes for words that parts of an article bear as well, by how it is built."""
    said = named(node)
    if not said:
        return False
    if node.name in SMALL:
        return re.search(r"(?:^|[\s_-])(?:ads?|adverts?|hidden|sr-only|notice|copyright)(?=$|[\s_-])", said, re.I) is not None and 2 * own(node) <= prose
    if AMBIGUOUS.search(said):
        return replies(node, said) or (density(node) >= 0.3 or controls(node)) and own(node) <= 0.5 * prose
    return False


def prune(root: Node) -> None:
    def walk(goes) -> None:
        stack = [(root, False)]
        while stack:
            at, inside = stack.pop()
            kept = []
            for x in at.children:
                if isinstance(x, Node):
                    if goes(x, inside):
                        continue
                    stack.append((x, inside or x.name in ("article", "main")))
                kept.append(x)
            at.children = kept

    # first by class and id, while controls and forms still tell what an element is; sizes leave out what goes anyway
    sizes = order(root)
    inside = {id(root): False}
    gone = set()
    for node in sizes:
        for x in node.children:
            if isinstance(x, Node):
                inside[id(x)] = inside[id(node)] or node.name in ("article", "main")
                if id(node) in gone or never(x, inside[id(x)]):
                    gone.add(id(x))
    measure(sizes, gone)
    prose = root.size - root.linked
    marked: set[int] = set()  # what is said to be the article, and all that holds it
    for node in sizes:
        if node.size >= 25 and (node.name in ("article", "main") or node.attributes and attributes(node).get("role", "").lower() == "main"):
            inside[id(node)] = True
            while node is not None and id(node) not in marked:
                marked.add(id(node))
                node = node.parent
    for node in sizes:
        for x in node.children:
            if isinstance(x, Node):
                inside[id(x)] = inside[id(x)] or inside[id(node)]
    beside = lambda x: bool(marked) and not inside[id(x)] and id(x) not in marked
    gone |= unlike(sizes, gone, beside, inside)
    walk(lambda x, within: id(x) in gone or doubtful(x, prose))


def order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [x for x in reversed(node.children) if isinstance(x, Node)]
    return out


def measure(nodes: list[Node], gone: set[int] = frozenset()) -> None:
    """Sizes, commas and text in links of nodes, without those that are gone."""
    for node in reversed(nodes):
        node.size = node.linked = node.commas = 0
        if id(node) in gone:
            continue
        for x in node.children:
            if isinstance(x, str):
                n = len(SPACES.sub(" ", x).strip())
                node.size += n
                node.commas += x.count(",") + x.count("，") + x.count("、")
            else:
                node.size += x.size
                node.linked += x.linked
                node.commas += x.commas
        if node.name == "a":
            node.linked = node.size


def density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


PARAGRAPHS = {"p", "pre", "blockquote", "td", "li", "dd", "div", "section", "article", "body", "#root", "main"}


def own_text(node: Node) -> tuple[int, int]:
    """Length and commas of a node's text outside blocks that it holds."""
    size = commas = 0
    stack = list(node.children)
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            size += len(x.strip())
            commas += x.count(",") + x.count("，") + x.count("、")
        elif x.name not in BLOCK:
            stack += x.children
    return size, commas


def score(nodes: list[Node]) -> None:
    for node in nodes:
        if node.name not in PARAGRAPHS:
            continue
        size, commas = own_text(node)
        if not size or size < 25 and node.name != "p":
            continue
        points = 1 + commas + min(size // 100, 3)
        points *= 1 - density(node)
        holder, share = (node.parent if node.name in ("p", "pre", "blockquote", "td", "li", "dd") else node), 1.0
        while holder is not None and share > 0.05:
            holder.points += points * share
            holder, share = holder.parent, share / 2 if share == 1.0 else share / 1.5


def choose(root: Node, nodes: list[Node]) -> list[Node]:
    """The kept nodes in page order: the best container and siblings of it that belong to it."""
    best = max((n for n in nodes if n.points > 0), key=lambda n: n.points * (1 - density(n)), default=None)
    if best is None:
        return [root] if root.size else []
    # lists, quotes and tables are parts of an article, and so is a container inside the one article or main element
    while best.parent is not None and best.name in ("ul", "ol", "dl", "li", "table", "tbody", "tr", "td", "blockquote", "p", "figure"):
        best = best.parent
    holder = best
    while holder is not None and holder.name not in ("article", "main"):
        holder = holder.parent
    if holder is not None and density(holder) < 0.5:
        best = holder
        while holder is not None and holder.name != "main":
            holder = holder.parent
        if holder is not None and density(holder) < 0.5 and sum(x.name == "article" and x.points > 0 for x in order(holder)) > 1:
            best = holder
    if best.parent is None:
        return [best]
    value, kept = best.points * (1 - density(best)), []
    for x in best.parent.children:
        if not isinstance(x, Node):
            continue
        d = density(x)
        if x is best or x.points * (1 - d) >= max(10.0, 0.2 * value) or x.name == "article" == best.name and x.points > 0 and d < 0.25:
            kept.append(x)
        elif x.name in ("p", "h1", "h2", "h3", "h4", "blockquote", "pre", "ul", "ol", "div", "section") and (x.size > 80 and d < 0.25 or 0 < x.size <= 80 and d == 0 and x.name == "p" or d < 0.5 and any(n.name == "h1" for n in order(x))):
            kept.append(x)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    out, run = [], []

    def end() -> None:
        if run and (said := SPACES.sub(" ", "".join(run)).strip()):
            out.append(said)
        run.clear()

    for top in nodes:
        end()
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                run.append(x)
            elif x.name == "br":
                run.append(" ")
            else:
                if x.name in BLOCK:
                    end()
                    stack.append(None)
                stack += reversed(x.children)
        end()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    prune(root)
    nodes = order(root)
    measure(nodes)
    score(nodes)
    return "\n\n".join(blocks(choose(root, nodes)))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds `text` and `n_chars`; the html goes."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html)]
    schema = pages.select(*kept).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, html):
                texts = [main_text(h) for h in batch.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"])

    return pages.select(*kept, html).mapInArrow(run, schema)
