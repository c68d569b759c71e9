"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks: stretches of text between the tags that begin or end a paragraph, heading,
list item, cell or section. A classifier over a block's surroundings, links and wording gives a score
for being content, which becomes the block's capacity to source or sink. Edges keep together
blocks that follow each other, and blocks with the element that holds them, elements with the one
around them. The minimum cut separates content from boilerplate; the content blocks make the text.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed,
empty ones left out, and the others joined in page order by one line feed. A line break inside a block is
white space. Text of scripts, styles, the page head and form controls is no block at all; formulas are text,
without their annotations, and so is what noscript and object elements hold. A null
page counts as empty; a page without content gives an empty text; pages may repeat, each row gets its
result; an empty table gives an empty result. Pages are read whole, in time that grows with their length,
however deep their elements are. Broken markup is read as browsers do in the usual cases: unclosed paragraphs, items and cells end where the next one begins, an unclosed head where something
begins that cannot stand in it, unmatched end tags are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: elements by what they do to the text
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT = frozenset(
    "annotation annotation-xml applet audio button canvas datalist head iframe map optgroup option "
    "script select style svg template textarea title video".split()
)
#: elements that leave an open head open, and those of them whose contents do, too
IN_HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
HEAD_TEXT = frozenset("noframes script style template title".split())
#: elements whose text stands in for what a browser may show instead
FALLBACK = frozenset("noscript object".split())
#: an element that ends where one of its like begins, up to the element that holds them
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: fixed values: elements and words in class, id or role that tell what an element holds
ASIDE = frozenset("nav footer aside form menu dialog search".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs captcha comment comments "
    "complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer "
    "gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice "
    "notification overlay pager pagination popup promo promoted promotion recommended related replies "
    "reply search share sharing sidebar signin signup skip social sponsor sponsored subscribe "
    "subscription tags teaser toc toolbar topbar tracking warning widget".split()
)
MAIN = frozenset("article main".split())
MAIN_WORDS = frozenset("article content entry main post story".split())
COMMENT_WORDS = frozenset("comment comments discussion disqus replies reply".split())
#: aside words that long text alone does not outweigh
UNWANTED_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert advertisement adverts banner consent contentinfo cookie cookies footer gdpr newsletter "
    "notice notification popup promo promoted promotion sidebar signup sponsor sponsored subscribe "
    "subscription".split()
)
MENU_WORDS = frozenset("menu nav navbar navigation pager pagination".split())
#: words by which a name tells what is beside or in a state, not what the element holds
MODIFIERS = frozenset(
    "active allow allowed can close closed collapsed disabled enabled fixed full has hide is loaded "
    "no not off on open opened show sticky toggled visible with without".split()
)
#: words after an aside word that leave its meaning as it is
FILLERS = frozenset(
    "area bar block body bottom box button buttons column container group holder icon icons inner item "
    "items left link links list panel posts primary region right secondary section slot small top unit "
    "wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: weights of the classifier, in log-odds; COMMENTS, UNWANTED and NAMED are for elements that only a
#: name sets aside, MINOR is added to the last where they hold less than half of the page's text, HINTED
#: where a name has an aside word beside others
IN_ASIDE, IN_MAIN, ELSEWHERE = -9.0, 4.0, -0.5
COMMENTS, UNWANTED, NAMED, MINOR, HINTED = -8.75, -8.5, -4.5, -2.0, -2.0
#: the share of a page's text from which on names of UNWANTED say no more than those of NAMED: without
#: it the page would be all but empty
NEARLY_ALL = 5 / 6
LINKED, LONG, SENTENCE, PARAGRAPH, ITEM = -4.0, 1.5, 0.75, 0.5, -0.5
#: instead of LINKED in main text that has begun, where a list of links may be what it tells
LINKED_IN_MAIN = -3.0
#: for the characters from 200 to 600 of a block
LONGER = 3.0
#: smoothness: neighbours in the page, a block and its element, an element and the one around it
NEXT, HELD, AROUND = 0.75, 0.75, 0.5
#: capacities are whole numbers, so that a cut is the same everywhere
SCALE = 1000

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    #: number and tag of the nearest element that is a block, itself included
    number: int
    holder: str
    standing: float
    #: whether it is in a main element, in one that is aside by its tag, in one named for comments
    in_main: bool = False
    in_aside: bool = False
    commented: bool = False


@dataclass
class Block:
    text: str
    element: int
    tag: str
    standing: float
    linked: int
    #: whether it is in a main element that has begun with a block of its own words
    begun: bool = False


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    #: the element around each element, by number
    around: list[int] = field(default_factory=list)


def meanings(names: list[str]) -> set[str]:
    """What names of an element say it holds: "main", "aside", "unwanted", "comment", or "hint".

    The last word that is no filler decides: related-work is about work, site-footer is a footer. An
    aside word before others, or beside a word for main text (entry-header, but not main-menu), is a
    hint only.
    """
    found = set()
    for name in names:
        words = [w.lower() for w in _WORDS.findall(name)]
        if not MODIFIERS.isdisjoint(words):
            continue
        if ASIDE_WORDS.isdisjoint(words):
            found |= {"main"} if not MAIN_WORDS.isdisjoint(words) else set()
            continue
        while words[-1] in FILLERS and words[-1] not in ASIDE_WORDS:
            words.pop()
        if words[-1] in COMMENT_WORDS:
            found.add("comment")
        elif words[-1] in UNWANTED_WORDS and MAIN_WORDS.isdisjoint(words):
            found.add("unwanted")
        elif words[-1] in MENU_WORDS or (words[-1] in ASIDE_WORDS and MAIN_WORDS.isdisjoint(words)):
            found.add("aside")
        else:
            found.add("hint")
    return found


class PageReader(HTMLParser):
    """Blocks of a page with the elements that hold them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page = Page(around=[-1])
        self.open = [Element("", 0, "", ELSEWHERE)]
        #: where in ``open`` the elements of each tag are
        self.places: dict[str, list[int]] = {}
        self.begun = False
        self.silent = 0
        self.links = 0
        self.words: list[str] = []
        self.linked = 0

    def standing(self, tag: str, attrs: list[tuple[str, str | None]]) -> float:
        """What a block in this element may be, as far as the elements around it tell.

        An article ends what words around it said, but not what elements such as nav said. Names set no
        article, main element or element named for main text aside, but an article named a comment or among
        comments; elsewhere they are a weight, which long text outweighs unless the name is that of
        comments, adverts, notices, sidebars or footers (but for comments, if they are nearly the whole page).
        """
        held = self.open[-1]
        outer = held.standing
        if tag in ("html", "body") or (outer == IN_ASIDE and tag not in MAIN):
            return outer
        names: list[str] = []
        concealed = False
        for name, value in attrs:
            if name in ("class", "role") and value:
                names += value.split()
            elif name == "id" and value and tag in BLOCKS and tag not in HEADINGS:
                names += value.split()  # those of headings and inside text are places to link to
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                concealed = True
            elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
                concealed = True
        meant = meanings(names) if names else set()
        if concealed or tag in ASIDE or (tag == "header" and not held.in_main):
            return IN_ASIDE
        if tag in MAIN:
            if tag == "article" and ("comment" in meant or held.commented):
                return IN_ASIDE
            return outer if held.in_aside else IN_MAIN
        if outer in (COMMENTS, UNWANTED):
            return outer
        if "main" in meant:
            return outer if outer == NAMED else IN_MAIN
        if "comment" in meant:
            return COMMENTS
        if "unwanted" in meant:
            return UNWANTED
        if outer == NAMED or "aside" in meant:
            return NAMED
        hinted = "hint" in meant or tag in FALLBACK
        return outer + HINTED if hinted and outer in (IN_MAIN, ELSEWHERE) else outer

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            held = self.open[-1]
            begun = self.begun and held.in_main
            self.page.blocks.append(
                Block(text, held.number, held.holder, held.standing, self.linked, begun)
            )
            self.begun |= held.in_main and 2 * self.linked < len(text)
        self.words, self.linked = [], 0

    def last(self, tags: frozenset[str] | set[str]) -> int:
        """Where the innermost open element with one of ``tags`` is, 0 without one."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def close_from(self, place: int) -> None:
        for element in self.open[place:]:
            self.silent -= element.tag in SILENT
            self.links -= element.tag == "a"
            self.places[element.tag].pop()
        del self.open[place:]

    def end_like(self, tags: set[str], within: set[str]) -> None:
        place = self.last(tags)
        if place and place > self.last(within):
            self.close_from(place)

    def end_head(self) -> None:
        """Closes an open head, as what begins cannot stand in it, unless within a title or the like."""
        place = self.last({"head"})
        if place and place > self.last(HEAD_TEXT):
            self.close_from(place)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "head" and len(self.open) - 1 > len(self.places.get("html", ())):
            return  # a head begins before all else
        if tag not in IN_HEAD:
            self.end_head()
        if tag == "br":
            self.words.append(" ")
        if tag in BLOCKS:
            self.flush()
            self.end_like({"p"}, {"td", "th", "li", "div", "article", "section", "table"})
        if tag in ENDS:
            self.end_like(*ENDS[tag])
        if tag in VOID:
            return
        standing = self.standing(tag, attrs)
        held = self.open[-1]
        number, holder = held.number, held.holder
        if tag in BLOCKS:
            self.page.around.append(number)
            number, holder = len(self.page.around) - 1, tag
        elif standing != held.standing:
            self.flush()  # an inline element that is set apart, such as a hidden one
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(
            Element(
                tag,
                number,
                holder,
                standing,
                held.in_main or tag in MAIN,
                held.in_aside or tag in ASIDE,
                tag != "main" and (held.commented or standing == COMMENTS),
            )
        )
        if tag in MAIN:
            self.begun = False
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        place = self.last({tag})
        if place:
            if self.open[place].standing != self.open[place - 1].standing:
                self.flush()
            self.close_from(place)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.end_head()
        if not self.silent:
            self.words.append(data)
            if self.links:
                self.linked += len(data)

    def read(self, html: str) -> Page:
        self.feed(html)
        self.close()
        self.flush()
        return self.page


def scores(blocks: list[Block]) -> list[float]:
    """Log-odds that each block is content, some of them by what the page's other blocks hold."""
    texts = dict.fromkeys((NAMED, UNWANTED, COMMENTS, IN_ASIDE), 0)
    whole = 0
    for block in blocks:
        size = len(block.text) - min(len(block.text), block.linked)
        if block.standing in texts:
            texts[block.standing] += size
        whole += size
    whole -= texts[COMMENTS] + texts[IN_ASIDE]
    costs = {}
    if texts[UNWANTED] > NEARLY_ALL * whole:
        costs[UNWANTED] = NAMED
    if 2 * texts[NAMED] < whole:
        costs[NAMED] = NAMED + MINOR
    found = []
    for block in blocks:
        size = len(block.text)
        value = costs.get(block.standing, block.standing)
        linked = LINKED_IN_MAIN if block.begun and block.standing == IN_MAIN else LINKED
        value += linked * min(1.0, block.linked / size)
        value += LONG * min(1.0, size / 200) + LONGER * min(1.0, max(0, size - 200) / 400)
        value += SENTENCE * (block.text[-1] in ".!?…。")
        value += PARAGRAPH * (block.tag in ("p", "pre", "blockquote")) + ITEM * (block.tag == "li")
        found.append(value)
    return found


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source: scores are capacities to it, negative ones to the sink.

    Nodes whose score outweighs all their edges are settled first; that changes no minimum, and
    mostly leaves little for the maximum flow.
    """
    near: list[dict[int, int]] = [{} for _ in scores]
    for a, b, weight in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0) + weight
            near[b][a] = near[b].get(a, 0) + weight
    left, label = list(scores), [None] * len(scores)
    waiting = list(range(len(scores)))
    while waiting:
        node = waiting.pop()
        if label[node] is not None or abs(left[node]) < sum(near[node].values()):
            continue
        label[node] = left[node] > 0
        for other, weight in near[node].items():
            left[other] += weight if label[node] else -weight
            del near[other][node]
            waiting.append(other)
        near[node] = {}
    rest = [n for n, known in enumerate(label) if known is None]
    if rest:
        for node, side in zip(rest, _flow_sides(rest, left, near), strict=True):
            label[node] = side
    return label


def _flow_sides(rest: list[int], scores: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Maximum flow by blocking flows along shortest paths; what the source still reaches."""
    place = {node: i for i, node in enumerate(rest)}
    source, sink = len(rest), len(rest) + 1
    room: list[dict[int, int]] = [{} for _ in range(len(rest) + 2)]
    for node, i in place.items():
        for other, weight in near[node].items():
            room[i][place[other]] = weight
        if scores[node] > 0:
            room[source][i], room[i][source] = scores[node], 0
        elif scores[node] < 0:
            room[i][sink], room[sink][i] = -scores[node], 0

    def distances() -> list[int]:
        far, line = [-1] * len(room), [source]
        far[source] = 0
        for node in line:
            for other, free in room[node].items():
                if free > 0 and far[other] < 0:
                    far[other] = far[node] + 1
                    line.append(other)
        return far

    while (far := distances())[sink] >= 0:
        ways = [iter(list(r)) for r in room]
        path = [source]
        while path:
            node = path[-1]
            if node == sink:
                pairs = list(zip(path, path[1:], strict=False))
                least = min(room[a][b] for a, b in pairs)
                for a, b in pairs:
                    room[a][b] -= least
                    room[b][a] += least
                path = [source]
                ways = [iter(list(r)) for r in room] if len(room) < 64 else ways
                continue
            for other in ways[node]:
                if room[node][other] > 0 and far[other] == far[node] + 1:
                    path.append(other)
                    break
            else:
                path.pop()
    return [far[i] >= 0 for i in range(len(rest))]


def labels(page: Page) -> tuple[list[int], list[tuple[int, int, int]]]:
    """The scores of a page's blocks and then its elements, and the edges between them."""
    blocks, base = page.blocks, len(page.blocks)
    found = [round(value * SCALE) for value in scores(blocks)] + [0] * len(page.around)
    edges = [(i, i + 1, round(NEXT * SCALE)) for i in range(base - 1)]
    edges += [(i, base + b.element, round(HELD * SCALE)) for i, b in enumerate(blocks)]
    holding = {b.element for b in blocks}
    for number in range(len(page.around) - 1, 0, -1):  # an element without blocks would have none to keep
        if number in holding:
            outer = page.around[number]
            holding.add(outer)
            edges.append((base + number, base + outer, round(AROUND * SCALE)))
    return found, edges


def main_text(html: str | None) -> str:
    """The content blocks of a page."""
    page = PageReader().read(html or "")
    if not page.blocks:
        return ""
    label = minimum_cut(*labels(page))
    return "\n".join(b.text for b, kept in zip(page.blocks, label, strict=False) if kept)


def extracted(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per page: its id and url, its text and the number of its characters."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch["html"]]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string()), sizes],
                names=["id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id).cast("long").alias("id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).alias("html"),
    )
    return rows.mapInArrow(extract, "id long, url string, text string, n_chars long").toDF(
        id, url, "text", "n_chars"
    )
