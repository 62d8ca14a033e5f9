"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks of text. Each block costs something to call content and something to
call boilerplate, by its own classifier; those are the capacities from the source and to the sink.
Neighbours in page order, and blocks close in the document tree, are joined by edges that cost if
their labels differ. The minimum cut of that graph, found as a maximum flow, is the cheapest
labelling of the page.
"""

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML by their role, and words of class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style noscript template title head svg iframe object canvas select option "
    "textarea button datalist audio video map".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption summary legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog search fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs bottom "
    "bottombar comment comments consent cookie cookies copyright disclaimer disqus feedback footer "
    "gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup privacy promo promoted promotion related reply replies "
    "recommend recommended respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar topbar tags widget widgets".split()
)
#: Named so, a part is boilerplate with the articles in it.
FIRM_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising comment comments disqus promo promoted "
    "recommend recommended related reply replies respond sponsor sponsored widget widgets".split()
)
#: With these, a class says how the page is laid out, not what the element is.
LAYOUT_WORDS = frozenset("has no with without".split())
WRAPPER_WORDS = frozenset("container inner layout outer wrap wrapper".split())
#: Beside these a boilerplate word still says what the element is; beside any other word of a name,
#: such as in social-history, it may be what the text is about.
STRUCTURE_WORDS = frozenset(
    "area articles block body box btn button cell col column container content form group head "
    "heading icon icons inner item items layout left link links list main module news outer page "
    "panel post posts right row section site stories text title top unit wrap wrapper zone".split()
)
CONTENT_WORDS = frozenset("article body content entry main post story text".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

IN_HEAD = frozenset("title meta link base basefont bgsound style script noscript noframes template head".split())

_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Weights:
    """Costs of the classifier, in the unit of one smoothness edge."""

    boilerplate_region = 12.0
    #: Only hinted at by a name: less than a content region and its long text weigh together.
    hinted_region = 4.0
    content_region = 6.0
    unmarked_region = 1.0
    link = 3.0
    heading = 0.5
    long_text = 2.0
    short_text = 0.6
    adjacency = 1.0
    same_parent = 1.0
    same_grandparent = 0.4


def _names(value):
    """(words, hints) of a class list or id, without those of names that describe the layout. Hints
    are the boilerplate words of names that have a word of another kind as well."""
    words, hints = set(), set()
    for name in value.split():
        parts = set(_WORDS.findall(_CAMEL.sub(" ", name).lower()))
        flagged = parts & BOILERPLATE_WORDS
        if parts & LAYOUT_WORDS or parts & WRAPPER_WORDS and parts & CONTENT_WORDS:
            parts -= BOILERPLATE_WORDS
        elif flagged and parts - BOILERPLATE_WORDS - STRUCTURE_WORDS:
            parts -= BOILERPLATE_WORDS
            hints |= flagged
        words |= parts
    return words, hints


class _Element:
    __slots__ = (
        "tag", "parent", "block", "boilerplate", "content", "firm", "hinted", "own", "own_firm", "own_hint",
        "resets", "flagged", "form",
    )

    def __init__(self, tag, parent, attrs):
        self.tag, self.parent = tag, parent
        #: The nearest block element, itself included.
        self.block = self if parent is None or tag in BLOCK else parent.block
        names, hints, role = set(), set(), ""
        for key, value in attrs:
            if value and key in ("class", "id"):
                more, hinted = _names(value)
                names |= more
                hints |= hinted
            elif value and key == "role":
                role = value.strip().lower()
        in_content = bool(parent and parent.content)
        page_header = tag == "header" and not in_content
        marked = tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or page_header
        free = tag in ("html", "body", "article", "main") or tag in HEADINGS or tag == "header" and in_content
        named = bool(names & BOILERPLATE_WORDS) and not free
        self.content = in_content or tag in CONTENT_TAGS or role == "main" or bool(names & CONTENT_WORDS) and not named
        main = tag == "main" or role == "main"
        self.resets = "all" if main else "loose" if tag == "article" else ""
        self.own = marked or named and not main
        self.own_hint = bool(hints) and not free and not main
        # a form may hold a whole page, so an article in it counts
        self.own_firm = marked and tag != "form" or named and bool(names & FIRM_WORDS)
        self.inherit()

    def inherit(self):
        """Boilerplate holds for all below, but for a main part, and for articles unless firm. A hint
        ends at either."""
        above = self.parent
        self.firm = bool(above and above.firm) and self.resets != "all" or self.own and self.own_firm
        kept = above and above.boilerplate and (not self.resets or self.resets == "loose" and above.firm)
        self.boilerplate = bool(kept) or self.own
        self.hinted = self.own_hint or bool(above and above.hinted and not self.resets)

    def find_form(self):
        """The form around the element, up to the first part that is main or boilerplate for another
        reason, and whether there is such boilerplate. What is above must know its own."""
        above = self.parent
        is_form = self.own and self.tag == "form"
        self.flagged, self.form = self.own and not is_form, self if is_form else None
        if above and not self.flagged and not self.resets:
            self.flagged, self.form = above.flagged, self.form or above.form


class Block:
    __slots__ = ("parts", "linked", "element")

    def __init__(self, element):
        self.parts, self.linked, self.element = [], 0, element


class _Reader(HTMLParser):
    """Blocks of a page. Elements that are left open end where an outer one does."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("", None, ())]
        self.elements = list(self.stack)
        #: Depths at which each tag is open, so that no search walks up the stack.
        self.open = {}
        self.blocks, self.current, self.hidden, self.links = [], None, 0, 0

    def updatepos(self, i, j):
        """Line numbers aren't needed."""
        return j

    def _end_block(self):
        self.current = None

    def _end_head(self):
        """What may not stand in the head ends it, though its end tag is left out."""
        if self.stack[-1].tag == "head":
            self._pop_to(len(self.stack) - 1)

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self._end_head()
        if tag == "form" and self._depth("form") > 0:
            return  # forms don't nest; the first end tag ends the outer one
        if tag in VOID:
            if tag in BLOCK:
                self._end_block()
            elif tag == "br" and self.current:
                self.current.parts.append(" ")
            return
        if tag == "body":
            self._close("head")
        if tag in CLOSES_P:
            self._close("p")
        if tag == "li":
            self._close("li", within=("ul", "ol", "menu"))
        if tag in ("dt", "dd"):
            self._close("dt", within=("dl",))
            self._close("dd", within=("dl",))
        if tag in BLOCK:
            self._end_block()
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Element(tag, self.stack[-1], attrs))
        self.elements.append(self.stack[-1])
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _depth(self, tag):
        """Where the innermost open element of this kind is, -1 if there is none."""
        depths = self.open.get(tag)
        return depths[-1] if depths else -1

    def _close(self, tag, within=()):
        depth = self._depth(tag)
        if not within and tag == "p":
            within = ("td", "th", "div", "article", "body", "section", "li", "blockquote")
        if depth > 0 and all(self._depth(outer) < depth for outer in within):
            self._pop_to(depth)

    def _pop_to(self, depth):
        for element in self.stack[depth:]:
            self.open[element.tag].pop()
            self.hidden -= element.tag in HIDDEN
            self.links -= element.tag == "a"
            if element.tag in BLOCK:
                self._end_block()
        del self.stack[depth:]

    def handle_endtag(self, tag):
        if tag == "p" or tag in BLOCK:
            self._end_block()
        depth = self._depth(tag)
        if depth > 0:
            self._pop_to(depth)

    def handle_data(self, data):
        if self.stack[-1].tag == "head" and not data.isspace():
            self._end_head()
        if self.hidden:
            return
        if self.current is None:
            if data.isspace():
                return
            self.current = Block(self.stack[-1].block)
            self.blocks.append(self.current)
        self.current.parts.append(data)
        if self.links:
            self.current.linked += len(data)


def read_blocks(html):
    """(text, share of it in links, enclosing block element) of a page, in page order."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    found = []
    for block in reader.blocks:
        raw = "".join(block.parts)
        text = " ".join(raw.split())
        if text:
            found.append((text, min(1.0, block.linked / max(1, len(raw.strip()))), block.element))
    _free_page_forms(found, reader.elements)
    return found


def _free_page_forms(found, elements):
    """A form with most of the words of the page's long text is the page's frame, not a form."""
    while True:
        for element in elements:
            element.find_form()
        words, in_form = 0, {}
        for text, linked, element in found:
            n = text.count(" ") + 1
            if n < 10 or linked > 0.5 or element.flagged:
                continue
            words += n
            if element.form:
                in_form[element.form] = in_form.get(element.form, 0) + n
        frames = [form for form, n in in_form.items() if 2 * n > words]
        if not frames:
            return
        for form in frames:
            form.own = False
        for element in elements:
            element.inherit()


def costs(text, linked, element):
    """(cost of calling the block boilerplate, cost of calling it content)."""
    content = boilerplate = 0.0
    if element.boilerplate:
        boilerplate += Weights.boilerplate_region
    else:
        content += Weights.content_region if element.content else Weights.unmarked_region
        if element.hinted:
            boilerplate += Weights.hinted_region
    boilerplate += Weights.link * linked
    words = text.count(" ") + 1
    if element.tag in HEADINGS:
        content += Weights.heading
    elif words >= 10:
        content += Weights.long_text * (1 - linked)
    else:
        boilerplate += Weights.short_text
    return content, boilerplate


def smoothness(blocks):
    """Edges (i, j, capacity): neighbours in page order, more so the closer in the tree."""
    edges = []
    for at in range(1, len(blocks)):
        one, two = blocks[at - 1][2], blocks[at][2]
        capacity = Weights.adjacency
        if one.parent is two.parent:
            capacity += Weights.same_parent
        elif one.parent and two.parent and one.parent.parent is two.parent.parent:
            capacity += Weights.same_grandparent
        edges.append((at - 1, at, capacity))
    last = {}
    for at, (_, _, element) in enumerate(blocks):
        holder = id(element.parent)
        before = last.get(holder)
        if before is not None and before < at - 1:  # siblings with something else between them
            edges.append((before, at, Weights.same_parent))
        last[holder] = at
    return edges


TINY = 1e-9


class _Network:
    """What still fits through each edge and out of or into each node."""

    def __init__(self, excess, edges):
        self.excess = excess
        self.near = [[] for _ in excess]  # edges out of each node; edge e's reverse is e ^ 1
        self.head, self.room = [], []
        for i, j, capacity in edges:
            self.near[i].append(len(self.head))
            self.near[j].append(len(self.head) + 1)
            self.head += [j, i]
            self.room += [capacity, capacity]

    def levels(self):
        """Distance of each node from the nearest source with something left, -1 if out of reach, and
        whether a sink with room is in reach. Nodes behind the nearest sinks need no distance."""
        excess, head, room = self.excess, self.head, self.room
        level = [0 if x > TINY else -1 for x in excess]
        layer, reached = [i for i, at in enumerate(level) if at == 0], False
        while layer and not reached:
            following = []
            for at in layer:
                for e in self.near[at]:
                    to = head[e]
                    if level[to] < 0 and room[e] > TINY:
                        level[to] = level[at] + 1
                        following.append(to)
                        reached = reached or excess[to] < -TINY
            layer = following
        return level, reached

    def fill(self, level):
        """A flow along shortest paths to which no further such path can be added."""
        excess, head, room, near = self.excess, self.head, self.room, self.near
        arc = [0] * len(near)
        for source in [i for i, at in enumerate(level) if at == 0]:
            path, at = [], source
            while excess[source] > TINY:
                if path and excess[at] < -TINY:
                    flow = min(excess[source], -excess[at], *[room[e] for e in path])
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    excess[source] -= flow
                    excess[at] += flow
                    path, at = [], source
                    continue
                edges = near[at]
                while arc[at] < len(edges):
                    e = edges[arc[at]]
                    if room[e] > TINY and level[head[e]] == level[at] + 1:
                        break
                    arc[at] += 1
                if arc[at] < len(edges):
                    path.append(e)
                    at = head[e]
                elif path:
                    e = path.pop()
                    at = head[e ^ 1]
                    arc[at] += 1
                else:
                    break


def minimum_cut(content, boilerplate, edges):
    """Which nodes are on the source's side: content, by a maximum flow.

    Rounds of blocking flows along shortest paths. Edges join blocks that are near each other and
    carry little against what blocks take in themselves, so paths are short and rounds few, and each
    is one pass over the page."""
    # what flows straight from source over a node to sink needs no search
    network = _Network([c - b for c, b in zip(content, boilerplate)], edges)
    while True:
        level, reached = network.levels()
        if not reached:
            return [at >= 0 for at in level]
        network.fill(level)


def main_text(html):
    """The content blocks of a page, one a line."""
    blocks = read_blocks(html)
    if not blocks:
        return ""
    content, boilerplate = zip(*(costs(*block) for block in blocks))
    chosen = minimum_cut(content, boilerplate, smoothness(blocks))
    return "\n".join(text for (text, _, _), keep in zip(blocks, chosen) if keep)


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def extract_main_text(pages, html_col="html", text_col="text"):
    """The pages with their main text in `text_col`, empty if there is none.

    Null and empty html give empty text; repeated pages are extracted each. White space inside a
    block is one space, character references are decoded, blocks are joined by line feeds in page
    order. Nothing is cut off, and other columns stay as they are.
    """
    return pages.withColumn(text_col, _main_text(F.coalesce(F.col(html_col), F.lit(""))))
