"""Main text of web pages by composite text density.

Every block of the page's tree gets its characters per tag, adjusted by the share of
characters in links; inline mark-up belongs to the text of its block. The node whose children's densities have the largest sum holds the
article. The least density on the way from it up to the body is the threshold by which
other subtrees are taken too. Elements that say what they are (navigation, adverts, comments
and the like) are left out beforehand. Two kinds are judged by their text: a form is left out
unless it wraps the article, and a part of an article whose name may be a title as well (related,
discussion) is left out only if it is short or mostly links.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, released, texts

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr td th label".split()
)
SKIPPED = set(
    "script style noscript template head title nav footer aside button select option "
    "input textarea iframe object embed svg canvas audio video map dialog menu fieldset "
    "noembed noframes xmp datalist".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul "
    "li dd dt tr td th tbody thead tfoot".split()
)
#: Start tags that end an open element, and the elements at which the search for it stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Words of class, id and role that name what is not the article.
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsbygoogle adsense banner sponsor "
    "sponsored promo promoted cookie cookies consent gdpr notice notification alert "
    "popup modal overlay newsletter subscribe subscription signup login sidebar sidenav "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer masthead toolbar "
    "share sharing pagination pager skip search "
    "copyright disclaimer contentinfo complementary widget widgets outbrain taboola "
    "comment comments commentlist disqus".split()
)
#: Words that may also be the title of a part of the article.
TITLE_WORDS = set("discussion replies respond related recommended recommendations social rail promotion".split())
#: Words that may stand beside those in one name, as in related-posts; with any other, as in
#: related-work, a name does not say what an element is.
PLAIN_WORDS = set(
    "area articles bar block body bottom box button buttons card center column container content "
    "footer form group header holder home icon icons inner item items layout left link links list "
    "main media message module more network news outer page panel placeholder post posts "
    "primary region reply right row secondary section site slot stories story strip text thread "
    "title top unit user wrap wrapper zone".split()
)
COMMENT_WORDS = set("comment comments commentlist disqus replies respond".split())
LEAST_PART = 80  # characters of a part of an article that is more than a pointer elsewhere
LEAST_FORM = 250  # characters of a form that wraps an article without saying so
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORDS = re.compile(r"[A-Za-z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "parts", "noise", "doubtful", "block", "chars", "tags", "link_chars", "links", "own", "density")

    def __init__(self, tag: str, parent: Node | None, noise: bool = False, doubtful: bool = False) -> None:
        self.tag, self.parent, self.noise, self.doubtful = tag, parent, noise, doubtful
        self.block = tag not in INLINE
        self.parts: list[Node | str] = []


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends the tag beginning at ``at``, outside quotes."""
    end = page.find(">", at)
    quote = page.find("=", at, end) if end >= 0 else -1
    while 0 <= quote < end:
        after = quote + 1
        while after < len(page) and page[after] in " \t\r\n\f":
            after += 1
        if page[after : after + 1] in ('"', "'"):
            close = page.find(page[after], after + 1)
            if close < 0:
                return -1
            after = close + 1
            if close > end:
                end = page.find(">", close)
        quote = page.find("=", after, end)
    return end


def _named(names: str, words: set[str]) -> bool:
    """Whether one of some names says what an element is: it has one of ``words``, and no word
    that could mean something else."""
    for name in names.split():
        parts = {x.lower() for x in WORDS.findall(name)}
        if parts & words and parts <= NOISE_WORDS | TITLE_WORDS | PLAIN_WORDS | words:
            return True
    return False


def _kind(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is noise, and whether it may be, which its text decides."""
    if tag in SKIPPED:
        return True, False
    if tag == "header":
        return not inside_article, False
    if not attributes:
        return False, tag == "form"
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, False
    if tag in ("html", "body", "main", "h1"):
        return False, False
    names = " ".join(found.get(x, "") for x in ("class", "id", "role"))
    if tag == "article":
        return _named(names, COMMENT_WORDS), False
    if _named(names, NOISE_WORDS) or (not inside_article and _named(names, TITLE_WORDS | {"header"})):
        return True, False
    return False, tag == "form" or _named(names, TITLE_WORDS)


def parse(page: str) -> Node:
    """The tree of a page; as browsers do, missing end tags are made up for."""
    root = Node("#root", None)
    stack = [root]
    at, size = 0, len(page)
    places: dict[str, list[int]] = {}  # of open elements in the stack, by name
    blocks = [0]  # of those that are no inline mark-up
    folded: str | None = None

    def pop() -> None:
        places[stack.pop().tag].pop()
        if blocks[-1] == len(stack):
            blocks.pop()

    def last(tags: Iterable[str]) -> int:
        return max((places[x][-1] for x in tags if places.get(x)), default=-1)

    while at < size:
        left = page.find("<", at)
        if left < 0:
            left = size
        if left > at:
            stack[-1].parts.append(html.unescape(page[at:left]))
        if left >= size:
            break
        following = page[left + 1 : left + 2]
        if following in ("!", "?"):
            if page.startswith("<!--", left):
                end = page.find("-->", left + 4)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", left)
                at = size if end < 0 else end + 1
            continue
        closing = following == "/"
        name = NAME.match(page, left + 1 + closing)
        if not name:
            if closing:
                end = page.find(">", left)
                at = size if end < 0 else end + 1
            else:
                stack[-1].parts.append("<")
                at = left + 1
            continue
        end = _tag_end(page, name.end())
        if end < 0:
            break  # a tag that never ends is dropped, as in browsers
        at, tag = end + 1, name[0].lower()
        if closing:
            if places.get(tag):
                # An inline end tag does not close a block around it.
                if tag in INLINE and tag not in ("td", "th") and places[tag][-1] < blocks[-1]:
                    continue
                while stack[-1].tag != tag:
                    pop()
                pop()
            elif tag == "br":
                stack[-1].parts.append(" ")
            continue
        if tag in CLOSES_P and places.get("p"):
            while stack[-1].tag != "p":
                pop()
            pop()
        if tag in ENDS:
            ended, stops = ENDS[tag]
            if (place := last(ended)) > last(stops):
                while len(stack) > place:
                    pop()
        attributes = page[name.end() : end]
        inside = bool(places.get("article") or places.get("main"))
        node = Node(tag, stack[-1], *_kind(tag, attributes.rstrip("/"), inside))
        stack[-1].parts.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            if folded is None:
                folded = page.lower()
                if len(folded) != size:  # a few letters change their length
                    folded = re.sub("[A-Z]", lambda m: m[0].lower(), page)
            close = folded.find(f"</{tag}", at)
            if close < 0:
                at = size
            else:
                end = page.find(">", close)
                at = size if end < 0 else end + 1
            continue
        places.setdefault(tag, []).append(len(stack))
        if node.block:
            blocks.append(len(stack))
        stack.append(node)
    return root


def _density(chars: int, tags: int, link_chars: int, links: int, link_share: float) -> float:
    if not chars:
        return 0.0
    plain, linked = max(chars - link_chars, 1), max(link_chars, 1)
    tags = max(tags, 1)
    base = log(chars / plain * link_chars + link_share * chars + e)
    if base <= 1.0 + 1e-12:
        base = 1.0 + 1e-12
    return chars / tags * log(max(chars / linked * tags / max(links, 1), 1.0) * e) / log(base * e)


def _inner_sum(node: Node) -> float:
    """Sum of the densities of the blocks in a block, also those inside inline mark-up."""
    total, todo = 0.0, [node]
    while todo:
        for part in todo.pop().parts:
            if isinstance(part, Node) and not part.noise:
                if part.block:
                    total += part.density
                else:
                    todo.append(part)
    return total


def _measured(root: Node) -> tuple[list[Node], Node]:
    """The elements that are no noise, in page order, with what is counted of each; the body."""
    order: list[Node] = []
    todo = [root]
    body = root
    while todo:
        node = todo.pop()
        if node.noise:
            continue
        order.append(node)
        if node.tag == "body" and body is root:
            body = node
        todo.extend(x for x in reversed(node.parts) if isinstance(x, Node))
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.links = 0
        own = [0, 0, 0]  # characters, those in links, and links, of the block's own text
        for part in node.parts:
            if isinstance(part, str):
                own[0] += len(part.strip())
                continue
            if part.noise:
                continue
            node.chars += part.chars
            node.tags += part.tags + part.block
            node.link_chars += part.link_chars
            node.links += part.links
            if not part.block:
                own = [a + b for a, b in zip(own, part.own)]
        node.chars += sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        if node.tag == "a":
            own[1], own[2] = own[0], own[2] + 1
            node.link_chars, node.links = node.chars, node.links + 1
        node.own = own
        if node.doubtful and node.tag != "form":
            node.noise = node.chars < LEAST_PART or 3 * node.link_chars >= node.chars
    return [node for node in order if not node.noise], body


def _forms(order: list[Node], body: Node) -> bool:
    """Mark the forms that wrap no article as noise; whether there are any.

    One that does holds half of the text, and either the elements of an article or more text than
    forms have.
    """
    forms = [node for node in order if node.doubtful and node.tag == "form"]
    if not forms:
        return False
    holding = set()
    for node in order:
        if node.tag in ("article", "main", "h1"):
            while node is not None and id(node) not in holding:
                holding.add(id(node))
                node = node.parent
    found = False
    for form in forms:
        wraps = 2 * form.chars >= body.chars and (id(form) in holding or form.chars >= LEAST_FORM)
        form.noise = not wraps
        found = found or not wraps
    return found


def main_text(page: str) -> str:
    """Blocks of the article, in page order, one a line; empty if there is none."""
    root = parse(page)
    order, body = _measured(root)
    if _forms(order, body):
        order, body = _measured(root)
    if not body.chars:
        body = root
    share = body.link_chars / max(body.chars, 1)
    best, most = body, -1.0
    for node in order:
        node.density = _density(node.chars, node.tags, node.link_chars, node.links, share)
    for node in order:
        if node.block:
            total = _density(node.own[0], 1, node.own[1], node.own[2], share)
            total += _inner_sum(node)
            if total > most * (1 + 1e-9):  # in page order: of equal sums the outermost stays
                best, most = node, total
    threshold, node = best.density, best
    path = {id(best)}
    while node.parent is not None and node is not body:
        node = node.parent
        path.add(id(node))
        threshold = min(threshold, node.density)
    # Whole subtrees: the best, and others beside the way to it that are as dense.
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    steps: list[tuple[Node | str | None, bool]] = [(body if id(body) in path else root, False)]
    while steps:
        part, taken = steps.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            if taken:
                line.append(part)
        elif not part.noise:
            if part.tag == "br":
                line.append(" ")
                continue
            taken = taken or part is best or (
                part.block
                and id(part) not in path
                and part.density >= threshold
                and part.link_chars * 2 < part.chars
            )
            if part.block:
                flush()
                steps.append((None, taken))
            elif part.tag in ("td", "th"):
                line.append(" ")
            steps.extend((x, taken) for x in reversed(part.parts))
    flush()
    return "\n".join(blocks)


def extract(
    pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """Columns ``keep``, ``text`` and ``n_chars`` (code points) for every row of ``pages``.

    A NULL or empty page, or one without text, gives the empty text and 0. Text outside any
    element counts as the body's. Repeated rows and NULL keys stay as they are. Other
    columns are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__page"):
            found = [main_text(x) if x else "" for x in texts(batch, "__page")]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(found, pa.string()),
                    pa.array([len(x) for x in found], pa.int64()),
                ],
                [*keep, "text", "n_chars"],
            )

    source = pages.select(*keep, F.col(page).alias("__page"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(released(run), f"{fields}, text string, n_chars bigint")
