"""Main text of web pages by tree scoring.

A page becomes a tree, without elements that by their tag or role hold menus, headers, footers, sidebars, forms or
code. Class and id are judged by what they name and what the element holds. A name that is all noise ("sidebar",
"cookie-notice") leaves the element out if a third of its text is links or no paragraph in it is long; adverts, notices
and reader comments so named are left out with long paragraphs as well. Noise beside other words ("main-nav") leaves it
out if half of its text is links, and only takes points else; a state of the page ("has-sidebar", "comments-open") and the
id of a section made from its heading name nothing. An element with most of the page's points stays, unless other
content is named beside or around it, or, if it is named as someone else's text, any paragraph stands outside. Every paragraph passes points for its
length and commas to its ancestors, all to the nearest and less to each next one; an element's points are then
discounted by the share of its text inside links. The element with the most points is the container, or the nearest
article or main element around it. Siblings of the container stay by their own text: headings; blocks of prose and
tables, lists, quotes and preformatted text with few links; others that hold a fifth of the container's prose; loose text of a
paragraph's length; and what has few links between two that stay. Within articles and main elements the same is done
for the siblings of every element up to the outermost one; beside that one, only headings and other articles stay. Nothing
outside a main element that holds a paragraph is the container, nor outside an article unless it has `MUCH_MORE` text.

The text of the container is put out block by block, in page order. A block is what stands between the
borders of block elements, references decoded, white space made one blank and trimmed; a line break is white
space.

Defined cases. Null or empty html, and a page without text outside what is left out, give the empty text. A page
in which nothing scores gives all that is left of its body. Unclosed and stray tags are taken as browsers
do in plain cases: blocks end paragraphs, items end items, strays are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ship, whole

# Element names of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
LEFT_OUT = frozenset(
    "script style noscript template nav footer aside form button select option textarea input label iframe svg math "
    "canvas object embed applet audio video map head title dialog menu".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE_ARTICLES = frozenset(["article", "main"])
# A start tag ends open elements of these names, unless one of the borders is met first.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
}
PARAGRAPH_SCOPE = {"table", "td", "th", "caption", "button", "object", "li"}
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
# Words in a class or id. The first kind always tells; the second not beside a word of the third.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs footer sidebar sidebars cookie cookies consent gdpr popup modal "
    "overlay newsletter subscribe subscription signup comment comments commentlist disqus respond replies discussion "
    "login share sharing social paywall pagination pager skip masthead banner".split()
)
MAYBE_NOISE = frozenset(
    "header topbar toolbar side widget widgets related recommended recommendations popular trending notice notices "
    "alert outbrain taboola hidden tags tools search rail promo reply teaser byline".split()
)
CONTENT = frozenset("article main content body post entry story text column page container wrapper".split())
FRAMES = frozenset("column page container wrapper".split())  # of these, words that noise has as well
# Prose in elements of these names is still not the page's own.
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement adsense adslot cookie cookies consent gdpr popup modal newsletter comment "
    "comments commentlist discussion disqus respond replies login paywall notice notices".split()
)
STATES = frozenset(
    "has have no not with without is are open opened closed enabled disabled show shows layout free".split()
)
PLACES = frozenset(
    "left right top bottom first last primary secondary site global mobile desktop inner outer area block box wrap row "
    "list item items section group holder slot unit bar panel".split()
) | FRAMES
HINTED, NAMED, NOT_OWN = 1, 2, 3  # what a class or id says: noise among others, noise, someone else's text
HINT_DISCOUNT = 0.5  # of the points of an element that may be noise
LONG_TEXT = 140  # characters of a paragraph that makes an element prose
LEVELS = 6  # ancestors that a paragraph passes points to
LEAST_TEXT = 25  # characters of a paragraph that passes points
LEAST_SHARE = 0.2  # of the container's prose, for a sibling with links or a doubtful name to stay
PARAGRAPH = 4.0  # points of one that is long or has commas
MUCH_MORE = 6  # times the text of an article that text outside must have to be the main text
FEW_LINKS = 0.25  # share of a sibling's text
TEXTS = frozenset("pre blockquote table ul ol dl figure figcaption details".split())  # siblings that stay at any length
TAG = re.compile(r"<[a-zA-Z/!?]")
TOKENS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "hint", "section", "chars", "linked", "points", "total", "prose", "place")

    def __init__(self, tag: str, parent: Node | None, noise: bool, hint: int = 0, section: str | None = None):
        self.tag, self.parent, self.noise, self.hint, self.section = tag, parent, noise, hint, section
        self.children: list[Node | str] = []
        self.clear()

    def clear(self) -> None:
        self.chars = self.linked = 0
        self.points = self.total = 0.0  # passed on by paragraphs; of all paragraphs inside
        self.prose = False
        self.place = (0, 0)


def _is_noise(tag: str, attributes: list[tuple[str, str | None]], inside_article: bool) -> bool:
    if tag in LEFT_OUT:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    if tag == "header" and not inside_article:
        return True
    for name, value in attributes:
        if name == "role" and (value or "").strip().lower() in LEFT_OUT_ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _words(name: str) -> list[str]:
    return [word.lower() for word in TOKENS.findall(name)]


def _hint(tag: str, attributes: list[tuple[str, str | None]], inside_article: bool) -> tuple[int, str | None]:
    """What class and id say, and the id if it alone says so."""
    if tag in ("html", "body", "main", "article") or tag in HEADINGS:
        return 0, None
    names = [(kind, _words(name)) for kind, value in attributes if kind in ("class", "id") for name in (value or "").split()]
    every = {word for _, words in names for word in words}
    if every.isdisjoint(NOISE) and every.isdisjoint(MAYBE_NOISE):
        return 0, None
    beside_content = bool(every & CONTENT - FRAMES)
    maybe = not every & CONTENT and not (inside_article and "header" in every)
    hint, kinds, identity = 0, set(), None
    for kind, words in names:
        noise = {word for word in words if word in NOISE or maybe and word in MAYBE_NOISE}
        if not noise or not STATES.isdisjoint(words):
            continue
        if noise & FOREIGN and (words[-1] in noise or not {words[-1]}.isdisjoint(CONTENT)):
            # "post-comments", "comment-body": one name that says whose text it is. Of several names one may mean the whole.
            level = HINTED if beside_content and not set(words) & CONTENT and len(words) == 1 else NOT_OWN
        elif beside_content:
            level = HINTED
        elif all(word in noise or word in MAYBE_NOISE or word in PLACES for word in words):
            level = NOT_OWN if noise & FOREIGN else NAMED
        else:
            level = NAMED if words[-1] in noise else HINTED
        hint = max(hint, level)
        kinds.add(kind)
        identity = " ".join(words)
    return hint, identity if kinds == {"id"} else None


def _names_content(node: Node, attributes: list[tuple[str, str | None]]) -> bool:
    return node.tag in WHOLE_ARTICLES or any(
        word in CONTENT and word not in FRAMES
        for kind, value in attributes if kind in ("class", "id") and value for word in _words(value)
    )


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None, False)
        self.noise_depth = 0  # open elements that are left out
        self.articles = 0
        self.open: dict[str, int] = {}
        self.hints: list[Node] = []  # elements that may be noise by their names, in page order
        self.contents: list[Node] = []  # elements named as content, outside of those
        self.hint_depth = 0

    def _pop(self) -> None:
        node = self.at
        self.noise_depth -= node.noise
        self.hint_depth -= node.hint > 0
        self.articles -= node.tag in WHOLE_ARTICLES
        self.open[node.tag] -= 1
        self.at = node.parent

    def _end(self, names: set[str], borders: set[str]) -> None:
        """Ends the nearest open element of these names, if no border lies before it."""
        if not any(self.open.get(name) for name in names):
            return
        node = self.at
        while node is not self.root and node.tag not in names and node.tag not in borders:
            node = node.parent
        if node.tag in names:
            while self.at is not node.parent:
                self._pop()

    def handle_starttag(self, tag, attributes):
        if tag in BLOCK:
            self._end({"p"}, PARAGRAPH_SCOPE)
        if tag in ENDS:
            while (before := self.at) and self._end(*ENDS[tag]) is None and self.at is not before:
                pass
        noise = _is_noise(tag, attributes, self.articles > 0)
        # Code is coloured by classes such as "comment".
        named = attributes and not noise and not self.noise_depth and not self.open.get("pre")
        hint, identity = _hint(tag, attributes, self.articles > 0) if named else (0, None)
        node = Node(tag, self.at, noise, hint, identity if self.articles else None)
        if not self.noise_depth:
            self.at.children.append(node)
            if hint:
                self.hints.append(node)
            elif not noise and not self.hint_depth and _names_content(node, attributes):
                self.contents.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1
            self.noise_depth += node.noise
            self.hint_depth += node.hint > 0
            self.articles += tag in WHOLE_ARTICLES

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in VOID and tag not in BLOCK:
            self._end({tag}, set())

    def handle_endtag(self, tag):
        if tag == "p" and not self.open.get("p") and not self.noise_depth:
            self.at.children.append(Node("p", self.at, False))  # as browsers do: it parts what it stands between
        # An end tag of running text reaches no further than its block.
        self._end({tag}, {"td", "th"} - {tag} if tag in BLOCK else BLOCK - {tag})

    def handle_data(self, data):
        if not self.noise_depth:
            self.at.children.append(data)


def _walk(node: Node | str):
    """The tree below a node in page order: (node, True) on entry, (node, False) on leaving, (text, None)."""
    stack: list[tuple[Node | str, bool]] = [(node, True)]
    while stack:
        item, entering = stack.pop()
        if isinstance(item, str):
            yield item, None
        elif item.noise:
            continue
        elif entering:
            yield item, True
            stack.append((item, False))
            stack.extend((child, True) for child in reversed(item.children))
        else:
            yield item, False


def _blocks(nodes: list[Node]) -> list[str]:
    found: list[str] = []
    run: list[str] = []

    def close():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            found.append(text)

    for top in nodes:
        for item, entering in _walk(top):
            if entering is None:
                run.append(item)
            elif item.tag in BLOCK:
                close()
            elif item.tag == "br":
                run.append(" ")
        close()
    return found


def _score(root: Node) -> None:
    """Points, characters and linked characters of every element."""
    inside_links = steps = 0
    root.clear()
    blocks: list[tuple[Node, list[str]]] = [(root, [])]

    def close():
        owner, run = blocks[-1]
        text = " ".join("".join(run).split())
        run.clear()
        if len(text) < LEAST_TEXT:
            return
        points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        owner.total += points
        owner.prose = owner.prose or len(text) >= LONG_TEXT
        # A paragraph's points go to what it stands in; loose text stands in its own element.
        node = owner.parent if owner.tag in ("p", "pre", "li", "blockquote") or owner.tag in HEADINGS else owner
        for level in range(LEVELS):
            if node is None:
                break
            node.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            node = node.parent

    for item, entering in _walk(root):
        if entering is None:
            blocks[-1][1].append(item)
            size = len(item) - item.count(" ")
            blocks[-1][0].chars += size
            if inside_links:
                blocks[-1][0].linked += size
            continue
        if item.tag == "a":
            inside_links += 1 if entering else -1
        if item.tag in BLOCK or item.hint:
            close()
            steps += 1
            if entering:
                if item is not root:
                    item.clear()
                item.place = (steps, steps)
                blocks.append((item, []))
            else:
                item.place = (item.place[0], steps)
                blocks.pop()
                if blocks:
                    outer = blocks[-1][0]
                    outer.chars += item.chars
                    outer.linked += item.linked
                    outer.total += item.total
                    outer.prose = outer.prose or item.prose
        elif item.tag == "br" and entering:
            blocks[-1][1].append(" ")
    close()


def _heads_section(node: Node) -> bool:
    """Whether the id is that of a section of the text: by its tag, or made from its heading."""
    if node.tag == "section":
        return True
    heading = next((item for item, entering in _walk(node) if entering and item.tag in HEADINGS), None)
    return heading is not None and _words(" ".join(_blocks([heading])).lower()) == node.section.split()


def _other_text(content: Node, node: Node) -> bool:
    """Whether an element named as content has text of its own beside a node, or around it."""
    if content.place[0] < node.place[0] and content.place[1] > node.place[1]:
        return content.total > node.total
    apart = content.place[1] < node.place[0] or content.place[0] > node.place[1]
    return apart and bool(content.total or content.chars and content.tag in WHOLE_ARTICLES)


def _leave_out(builder: TreeBuilder) -> None:
    """Marks elements as noise whose names say so and whose text does not speak against it. Follows `_score`."""
    total, until = builder.root.total, 0
    for node in builder.hints:
        if node.place[0] < until:  # inside of one that is left out
            continue
        if node.section and _heads_section(node):
            node.hint = HINTED
        links = 2 if node.hint == HINTED else 3
        linked = links * node.linked >= node.chars
        out = linked or node.hint == NOT_OWN or node.hint == NAMED and not node.prose
        if out and not linked and 2 * node.total > total:
            out = any(_other_text(c, node) for c in builder.contents)
            out = out or node.hint == NOT_OWN and total - node.total >= PARAGRAPH
            node.hint = node.hint if out else 0
        if out:
            node.noise, until = True, node.place[1]


def _worth(node: Node) -> float:
    if not node.chars:
        return 0.0
    return node.points * (1 - node.linked / node.chars) * (HINT_DISCOUNT if node.hint else 1)


def _own(node: Node) -> float:
    """The points of the paragraphs inside, wherever they were passed to."""
    if not node.chars:
        return 0.0
    return node.total * (1 - node.linked / node.chars) * (HINT_DISCOUNT if node.hint else 1)


def _siblings(container: Node, least: float) -> Iterator[tuple[list[Node | str], bool | None]]:
    """The container's siblings and itself as blocks and runs of loose text: True stays, None stays between such."""
    run: list[Node | str] = []

    def loose():
        size = linked = inside_links = 0
        for top in run:
            for item, entering in _walk(top):
                if entering is None:
                    item = "".join(item.split())
                    size += len(item)
                    linked += len(item) if inside_links else 0
                elif item.tag == "a":
                    inside_links += 1 if entering else -1
        few = linked < FEW_LINKS * size
        return few and (True if size >= LEAST_TEXT else None)

    for node in container.parent.children:
        if node is not container and (isinstance(node, str) or node.noise or not (node.tag in BLOCK or node.hint)):
            run.append(node)
            continue
        if run:
            yield run, loose()
            run = []
        if node is container or node.tag in HEADINGS:
            stays = True
        elif container.tag in WHOLE_ARTICLES and node.tag not in WHOLE_ARTICLES and not _inside_article(node):
            stays = False  # what a page sets beside its article is not the article
        elif node.hint or node.linked >= FEW_LINKS * node.chars:
            stays = node.chars > 0 and _own(node) >= least
        else:
            stays = True if node.total or node.tag == "p" or node.tag in TEXTS else None
        yield [node], stays
    if run:
        yield run, loose()


def _inside_article(node: Node) -> bool:
    while (node := node.parent) is not None:
        if node.tag in WHOLE_ARTICLES:
            return True
    return False


def _beside(container: Node, kept: Node, least: float) -> Node:
    """What is kept of the container together with those of its siblings that stay."""
    parts = list(_siblings(container, least))
    ends = [n for n, (_, stays) in enumerate(parts) if stays]
    together = Node("div", None, False)
    for n, (nodes, stays) in enumerate(parts):
        if nodes[0] is container:
            together.children.append(kept)
        elif stays or stays is None and ends[0] < n < ends[-1]:
            together.children += nodes
        else:
            together.children.append(Node("hr", None, False))  # parts what it stood between
    return together


def _ancestry(node: Node) -> Iterator[Node]:
    """The node and what it stands in, outwards."""
    while node is not None:
        yield node
        node = node.parent


def _in_article(node: Node) -> bool:
    return any(outer.tag in WHOLE_ARTICLES for outer in _ancestry(node))


def _outermost(node: Node) -> Node:
    return [outer for outer in _ancestry(node) if outer.tag in WHOLE_ARTICLES][-1]


def _within(best: Node, own: Node) -> float:
    """What of the best element's paragraphs is the article's, if that lies inside."""
    return _outermost(own).total if any(outer is best for outer in _ancestry(own)) else 0.0


def _chosen(root: Node) -> Node:
    elements = [node for node, entering in _walk(root) if entering and node.tag in BLOCK]
    body = next((node for node in elements if node.tag == "body"), root)
    best = max(elements, key=_worth, default=None)  # the first of equals, in page order
    if best is None or not _worth(best):
        return body
    if not _in_article(best):
        # Marked as the main part, and holding a paragraph: that decides, unless far more stands beside an article.
        marked = [node for node in elements if node.prose and _in_article(node) and _worth(node)]
        own = max(marked, key=_worth, default=None)
        if own is not None and (
            any(node.tag == "main" for node in _ancestry(own)) or MUCH_MORE * _outermost(own).total >= best.total - _within(best, own)
        ):
            best = own
    around, node = [], best
    while node is not None:
        if node.tag in WHOLE_ARTICLES:
            around.append(node)
        node = node.parent
    container, outermost = (around[0], around[-1]) if around else (best, best)
    least = LEAST_SHARE * _own(container)
    kept = at = container
    while at.parent is not None and at.tag not in ("body", "html"):
        kept = _beside(at, kept, least)
        if at is outermost:
            break
        at = at.parent
    return kept


def main_text(html: str) -> str:
    """The main text of one page."""
    builder = TreeBuilder()
    # A tag that the page's end cuts off is no text, and the parser would look for its end at every one. Any other `<`
    # is text.
    unfinished = TAG.search(html, html.rfind(">") + 1)
    builder.feed(html[: unfinished.start()] if unfinished else html)
    builder.close()
    _score(builder.root)
    if builder.hints:
        _leave_out(builder)
        _score(builder.root)
    return "\n".join(_blocks([_chosen(builder.root)]))


def extracted(html: Column) -> Column:
    """The main text as a column."""

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        pages = (value.as_buffer().to_pybytes().decode("utf-8", "replace") for value in column.cast(pa.binary()))
        return pa.array([main_text(page).encode("utf-8", "replace").decode() for page in pages], pa.string())

    return texts(whole(html))


def with_main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """`pages` with the main text under `name`; a column of that name is replaced."""
    ship(pages.sparkSession)
    return pages.withColumn(name, extracted(F.col(html_col)))
