"""Main text of web pages: blocks labelled by a minimum cut."""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset("head template noscript object select datalist button canvas audio video map".split())
#: What may stand in a head; any other start tag, or text, ends an open one.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt msub msup msubsup semantics".split()
)
CLOSED_BY_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What ends an open element of CLOSED_BY_SIBLING from outside.
SCOPE = frozenset("ul ol dl table tbody thead tfoot body html article section div".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
#: Words of class, id and role names, cut at anything but letters and digits.
BOILERPLATE_NAMES = frozenset(
    "boilerplate ad ads advert advertisement advertising adsense breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter pager pagination popup "
    "promo replies sidebar signup sponsor sponsored subscribe subscription tagcloud toolbar widget widgets".split()
)
#: Words that name boilerplate or a subject: they count in full only in a name of which
#: every word is one of these, of the above or of the next set.
AMBIGUOUS_NAMES = frozenset(
    "banner copyright notice promoted recommended related reply respond search share sharing skip social trending".split()
)
PART_NAMES = frozenset(
    "area aside bar block bottom box btn button buttons column container content footer form group header icon icons inner "
    "item items left link links list main module more outer panel post posts right row section site top wrap wrapper".split()
)
CONTENT_NAMES = frozenset("article body content entry main post story text".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: An attribute: its whole name, then its value, quoted or bare, if it has one.
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
#: Elements of other languages: a slash before the bracket closes them.
FOREIGN = frozenset("svg math path circle rect line polygon polyline ellipse use g mi mn mo mrow mspace".split())
#: Elements around a block that are looked at; deeper ones count as their parent, as in
#: browsers, but for hidden ones.
DEPTH = 512


@dataclass
class Element:
    tag: str
    number: int
    names: frozenset[str] = frozenset()
    hidden: bool = False
    doubtful: bool = False


@dataclass
class Block:
    """A run of text without a block boundary in it, and the elements around it."""

    path: tuple[Element, ...]
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _names(attributes: str) -> tuple[frozenset[str], bool, bool]:
    """Words of an element's names, whether it is hidden, and whether its names hold an
    ambiguous word beside one that says nothing of the page's build: such words are left
    out of the names."""
    names, hidden, doubtful, seen = set(), False, False, set()
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key in seen:  # the first one counts
            continue
        seen.add(key)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key in ("class", "id", "role"):
            for name in value.split():
                words = {w.lower() for w in _NAME.findall(name)}
                unclear = words & AMBIGUOUS_NAMES
                if unclear and any(not w.isdigit() for w in words - AMBIGUOUS_NAMES - BOILERPLATE_NAMES - PART_NAMES):
                    doubtful = True
                    words -= unclear
                elif unclear:
                    words = {*words, "boilerplate"}
                names.update(words)
    return frozenset(names), hidden, doubtful


def blocks(page: str) -> list[Block]:
    """Blocks of visible text in page order. Reads the page once; tags that never
    close, close twice or break off are taken as browsers do, roughly."""
    found: list[Block] = []
    stack: list[Element] = []
    current: Block | None = None
    at, n, number, hidden, links = 0, len(page), 0, 0, 0

    def end_head() -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag == "template":
                break
            if stack[k].tag == "head":
                pop_to(k)
                break

    def text(piece: str) -> None:
        nonlocal current
        if hidden and stack[-1].tag == "head" and piece and not piece.isspace():
            end_head()
        if hidden or not piece:
            return
        if current is None:
            if piece.isspace():
                return
            current = Block(tuple(e for e in stack if e.tag not in INLINE))
            found.append(current)
        piece = html.unescape(piece)
        current.parts.append(piece)
        if links:
            current.linked += len(piece)

    def pop_to(depth: int) -> None:
        nonlocal hidden, links
        while len(stack) > depth:
            gone = stack.pop()
            hidden -= gone.hidden
            links -= gone.tag == "a"

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, lt)
        if tag is None:
            follows = page[lt + 1 : lt + 2]
            if follows.isascii() and (follows.isalpha() or follows == "/"):  # a tag that breaks off
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                text("<")
                at = lt + 1
            continue
        at, closing, name = tag.end(), bool(tag[1]), tag[2].lower()
        if name not in INLINE:
            current = None
        elif name == "br" and current is not None:
            text(" ")
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == name), None)
            if depth is not None:
                pop_to(depth)
            continue
        if hidden and name not in IN_HEAD:
            end_head()
        if name == "head" and any(e.tag != "html" for e in stack):  # browsers skip it
            continue
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
            at = n if end is None else end.start()
            if end is not None:
                close = page.find(">", at)
                at = n if close < 0 else close + 1
            continue
        if name not in INLINE and stack:
            # A block ends an open paragraph; list items and cells end their like.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if name in CLOSED_BY_SIBLING:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in CLOSED_BY_SIBLING[name]:
                    pop_to(k)
                    break
                if stack[k].tag in SCOPE:
                    break
        number += 1
        names, unseen, doubtful = _names(tag[3]) if tag[3] else (frozenset(), False, False)
        gone = unseen or name in HIDDEN
        # Nothing below a hidden element becomes a block, so these may lie at any depth.
        if (len(stack) < DEPTH or gone or hidden) and not (tag[3].endswith("/") and name in FOREIGN):
            stack.append(Element(name, number, names, gone, doubtful))
            hidden += stack[-1].hidden
            links += name == "a"
    return [b for b in found if b.text]


def wrappers(found: list[Block]) -> frozenset[int]:
    """Numbers of the elements around the page's main part, whose names tell nothing.

    The main part is the element of most text among those named or tagged as content
    and not as boilerplate. Around it are its ancestors, if it holds a third of the text
    or the ancestor half. Without such an element, all that hold more than half count,
    but for an article or main that is named as boilerplate.
    """
    size: dict[int, int] = {}
    first: dict[int, tuple[Block, int]] = {}
    total = 0
    for b in found:
        length = len(b.text)
        total += length
        for depth, e in enumerate(b.path):
            if e.number not in size:
                first[e.number] = b, depth
            size[e.number] = size.get(e.number, 0) + length

    def content(block: Block, depth: int) -> bool:
        e = block.path[depth]
        named = e.tag in CONTENT_TAGS or e.names & CONTENT_NAMES and e.tag not in ("html", "body")
        return bool(named) and not e.names & BOILERPLATE_NAMES and not any(x.tag in BOILERPLATE_TAGS for x in block.path[:depth])

    main = max((n for n, at in first.items() if content(*at)), key=lambda n: (size[n], -n), default=None)
    if main is None:
        return frozenset(n for n, (b, k) in first.items() if 2 * size[n] > total and b.path[k].tag not in CONTENT_TAGS)
    enough = 3 * size[main] >= total
    block, depth = first[main]
    return frozenset(e.number for e in block.path[:depth] if enough or 2 * size[e.number] > total)


#: What a name that may or may not mean boilerplate costs: about as much as an edge bears.
DOUBT = 1.2


def evidence(block: Block, around: frozenset[int] = frozenset()) -> float:
    """Log odds that a block is content, by what stands around it and its own text.
    Names of the elements ``around`` the main part cost nothing."""
    score, names_count = 0.0, True
    inside = False
    for e in reversed(block.path):
        if e.tag in BOILERPLATE_TAGS and not (e.tag == "form" and inside):
            score -= 10.0
        elif e.tag == "header" and not any(x.tag in CONTENT_TAGS for x in block.path):
            score -= 10.0
        # Names above an article, such as those of a page with a sidebar, tell nothing.
        if names_count and e.names and e.tag not in ("html", "body"):
            bad = e.names & BOILERPLATE_NAMES
            if bad:
                score -= 0.0 if e.number in around else 10.0
            elif e.names & CONTENT_NAMES:
                score += 1.0
        if names_count and e.doubtful and e.number not in around:
            score -= DOUBT
        if e.tag in CONTENT_TAGS and not e.names & BOILERPLATE_NAMES:
            score += 0.0 if inside else 5.0
            inside, names_count = True, False
    text, words = block.text, len(block.text.split())
    score += min(words, 40) / 20.0 - 0.6
    score -= 3.0 * block.linked / max(len("".join(block.parts)), 1)
    if text.rstrip("\"'”»)").endswith((".", "!", "?", "…", "。")):
        score += 0.4
    if block.path and block.path[-1].tag in ("p", "blockquote", "pre"):
        score += 0.8
    if "©" in text:
        score -= 3.0
    return score


#: Capacities are whole thousandths. Blocks that follow each other are joined by an
#: edge, the stronger the more of their elements they share, and so is each block to
#: the one before it in the same element.
SCALE = 1_000
ADJACENT, SHARED, SIBLING = 0.3, 0.7, 0.5


def edges(found: list[Block]) -> dict[tuple[int, int], int]:
    joined: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            before = found[i - 1].path
            common = sum(x is y for x, y in zip(before, b.path))
            share = common / max(len(before), len(b.path), 1)
            joined[i - 1, i] = round(SCALE * (ADJACENT + SHARED * share))
        parent = b.path[-1].number if b.path and b.path[-1].tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li") else (
            b.path[-2].number if len(b.path) > 1 else 0
        )
        if parent in last:
            key = (last[parent], i)
            joined[key] = joined.get(key, 0) + round(SCALE * SIBLING)
        last[parent] = i
    return joined


def minimum_cut(scores: list[int], joined: dict[tuple[int, int], int]) -> list[bool]:
    """Labels (True: content) of least total cost.

    A block labelled against its score pays the score, an edge between unlike labels
    its capacity. Scores are capacities from a source or to a sink; the flow is raised
    along shortest paths until none is left (Dinic), and content is what the source
    still reaches. A block whose score outweighs all its edges keeps its own label in
    any case, so it becomes part of its terminal first.
    """
    n = len(scores)
    around: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for (i, j), c in joined.items():
        around[i].append((j, c))
        around[j].append((i, c))
    score = list(scores)
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(score[i]) > sum(c for j, c in around[i] if label[j] is None):
            label[i] = score[i] > 0
            for j, c in around[i]:
                if label[j] is None:
                    score[j] += c if label[i] else -c
                    queue.append(j)
    if None not in label:
        return label

    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def edge(a: int, b: int, forth: int, back: int) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(forth)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        if label[i] is None:
            if score[i] > 0:
                edge(source, i, score[i], 0)
            elif score[i] < 0:
                edge(i, sink, -score[i], 0)
            for j, c in around[i]:
                if j > i and label[j] is None:
                    edge(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 if known is None else known for i, known in enumerate(label)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                pushed = min(room[e] for e in path)
                for e in path:
                    room[e] -= pushed
                    room[e ^ 1] += pushed
                a, path = source, []
                continue
            while at[a] < len(heads[a]):
                e = heads[a][at[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(heads[a]):
                path.append(heads[a][at[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                at[a] += 1
            else:
                break


def main_text(page: str | None) -> str:
    """Content blocks in page order, joined by spaces; empty where there is none."""
    found = blocks(page or "")
    around = wrappers(found)
    labels = minimum_cut([round(SCALE * evidence(b, around)) for b in found], edges(found))
    return " ".join(b.text for b, content in zip(found, labels) if content)


def extract(df: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """Adds ``name``, the main text of each page, worked out page by page inside tasks.

    Null, empty and text-free pages give an empty text; repeated rows are rows of their
    own, and a column of the new name is replaced. Nothing shuffles.
    """

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text, na_action=None)

    return df.withColumn(name, extracted(F.coalesce(F.col(f"`{html_col}`"), F.lit(""))))
