"""HTML extraction by two passes of block rules.

A page becomes blocks: text between tags that start or end a block (or two line breaks), character
references decoded, white space folded. Some elements mark a block's place: article and main
elements, and boilerplate, by its tag (menus, asides, footers, headers outside articles, forms), by
being hidden, or by a class, id or role whose last word (but for words like `wrapper` or `list`)
names menus, adverts, notices, comments and the like: `site-header` is a header, `with-sidebar`,
`page--has-header` and `comments-open` name none. Whatever stands in boilerplate is boilerplate,
articles too; but a form, a header or an element with such a name is none if it holds the page's
main element, or its first-level heading and half of its prose (a form outside articles: or one of them).
Prose is text in blocks of SHORT characters or more that are not mostly links.

The first pass decides blocks by place, link density, length and stop-word density (the highest of
the lists'; length and links alone where no list fits the page's prose, or the block's script).
Where articles hold less prose than the rest of the page, density decides the rest, and articles
without prose are cards of other pages; else the rest is boilerplate. Blocks that are short or of
middling density stay open; so do blocks of an article that have few stop words. The second pass
gives open blocks the label of their nearest decided neighbours: where the two sides differ the
nearer one counts, and the earlier of equals; an open heading goes with the next decided block, as it
heads it; open blocks of an article look at that article's blocks only, and are text if none is
decided; others are if there is no article.

Defined results: a null or empty page has an empty text; unclosed comments, scripts and tags end
with the page; text without any tag is one block; repeated rows get equal rows; an unknown tag is
inline. Time is linear in the page however deep its elements nest.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantarium.llm import arrow_text
from quantarium.session import ship_package

#: Common function words by language, most of them shared by any stop-word list.
STOP_WORDS = {
    "en": "a about after all also an and any are as at be because been but by can could did do for from had has have he her his how if in into is it its more most my no not of on one only or other our out over she so some than that the their them then there these they this to up was we were what when where which who will with would you your",
    "fr": "à au aux avec ce ces cette comme dans de des du elle elles en est et été être eux fait il ils je la le les leur leurs lui mais me même mes mon ne nos notre nous on ont ou où par pas plus pour qu que qui sa sans se sera ses son sont sur ta tes ton tous tout tu un une vos votre vous y",
    "de": "aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer eines er es für hat haben hatte ich ihr ihre im in ist ja kann mehr mit nach nicht noch nur oder ohne sein sich sie sind so über um und uns unter vom von vor war was wenn werden wie wir wird zu zum zur",
    "es": "a al algo ante antes como con contra cual cuando de del desde donde durante e el ella ellas ellos en entre era es esa ese eso esta este esto fue ha hay la las le les lo los más me mi mucho muy nada ni no nos o os otra otro para pero poco por porque que quien se ser si sin sobre son su sus también te tiene todo tu un una y ya yo",
}
_SETS = {k: frozenset(v.split()) for k, v in STOP_WORDS.items()}

#: A block below this many characters is short; a longer one with enough stop words is text.
SHORT = 70
#: Short links in a row from which they are a menu, even inside an article.
MENU_BLOCKS = 3
LOW_DENSITY, HIGH_DENSITY = 0.20, 0.30
LINK_DENSITY = 0.35
#: A list of stop words fits if so many of the words are in it.
FIT_DENSITY = 0.10

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their whole content is no text.
SKIPPED = "script style noscript template iframe svg canvas object video audio title select textarea button datalist"
#: Elements that are boilerplate whatever they hold, but for the page's main element.
FIRM_TAGS = frozenset("nav aside footer dialog menu search".split())
#: Words that name boilerplate, as the last word of a class, id or role.
BOILERPLATE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising advertorial alert alertdialog alerts banner banners breadcrumb breadcrumbs captcha comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus dropdown feedback flash footer footers gdpr infobar login menu menubar menus modal nav navbar navigation newsletter notice notices notification notifications outbrain overlay paywall popup promo promos promotion promoted recommended related remark remarks replies reply respond search share sharing sidebar sidebars sidenav signin signup skip social sponsor sponsored subscribe subscription taboola tagcloud toc toolbar tooltip tracker warning widget widgets".split()
)
#: These name boilerplate outside articles only.
OUTER_WORDS = frozenset("byline header headers masthead teaser teasers".split())
#: Words for shapes and places, which say nothing behind a name: `comment-list`, `sidebar-left`.
SHAPE_WORDS = frozenset(
    "area article articles bar block blocks body bottom box boxes btn button buttons card cards center col column component container content contents desktop element feed field fields form group heading holder icon icons info inner input item items label large left link links list lists main message messages meta mobile module outer pane panel post posts primary region right row secondary section sections sm lg md xl slot small sticky stories story strip text thread title top tree unit view wrap wrapper zone".split()
)
#: First words of names that tell what a page has or lacks.
STATE_WORDS = frozenset("with without has have had no not hide show js layout using supports".split())
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(SKIPPED.split())})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_UNSEEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPLIT = re.compile(r"[a-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN = 1, -1, 0
#: What an element says of its place.
PLAIN, HOME, HEADER, FORM, NAMED, FIRM, HIDDEN = range(7)


class Block:
    __slots__ = ("text", "links", "node", "heading", "place", "region", "label")

    def __init__(self, text: str, links: int, node: int, heading: bool):
        self.text, self.links, self.node, self.heading = text, links, node, heading
        self.place, self.region, self.label = OPEN, 0, OPEN

    def prose(self) -> int:
        return len(self.text) if len(self.text) >= SHORT and self.linked() <= LINK_DENSITY else 0

    def linked(self) -> float:
        return self.links / max(1, len("".join(self.text.split()))) if self.links else 0.0


class Node:
    """An element that marks a place, with what it holds."""

    __slots__ = ("parent", "kind", "prose", "titled", "main", "place", "region")

    def __init__(self, parent: int, kind: int, main: bool):
        self.parent, self.kind, self.main = parent, kind, main
        self.prose, self.titled, self.place, self.region = 0, False, OPEN, 0


def name_kind(name: str) -> int:
    """NAMED or HEADER if the class, id or role names boilerplate, else PLAIN."""
    words = _SPLIT.findall(_CAMEL.sub(" ", name.split("--")[0]).lower())
    while words and words[-1] in SHAPE_WORDS:
        words.pop()
    if not words or (len(words) > 1 and words[0] in STATE_WORDS):
        return PLAIN
    return NAMED if words[-1] in BOILERPLATE_WORDS else HEADER if words[-1] in OUTER_WORDS else PLAIN


def element_kind(tag: str, attributes: str) -> int:
    kind = FIRM if tag in FIRM_TAGS else FORM if tag == "form" else HEADER if tag == "header" else HOME if tag in ("article", "main") else PLAIN
    if not attributes or tag in ("html", "body"):
        return kind
    if _UNSEEN.search(attributes) or _HIDDEN.search(_QUOTED.sub("", attributes)):
        return HIDDEN
    if kind == FIRM:
        return kind
    for attribute, *values in _NAMES.findall(attributes):
        for name in "".join(values).split():
            if attribute.lower() == "role" and name in ("main", "article"):
                kind = max(kind, HOME)
            elif tag != "main":
                kind = max(kind, name_kind(name))
    return kind


def blocks_of(html: str) -> tuple[list[Block], list[Node]]:
    out: list[Block] = []
    nodes = [Node(0, PLAIN, False)]
    parts: list[str] = []
    links, linked, breaks = 0, False, 0
    stack: list[tuple[str, int]] = []  # open elements that matter, and the node around them
    depths: dict[str, list[int]] = {}  # where each tag stands in the stack
    node, own, heading = 0, 0, False

    def close() -> None:
        nonlocal links, own, breaks
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, links, own or node, heading))
            parts.clear()
        links, breaks, own = 0, 0, 0

    at = 0
    for m in _TAG.finditer(html):
        if m.start() > at:
            text = html[at : m.start()]
            if "&" in text:
                text = unescape(text)
            parts.append(text)
            if linked:
                links += len("".join(text.split()))
            if breaks and not text.isspace():
                breaks = 0
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            if tag == "a":
                linked = False
            if tag in BLOCK_TAGS:
                close()
                heading = False
            if depths.get(tag):
                close()
                place = depths[tag][-1]
                node = stack[place][1]
                while len(stack) > place:
                    depths[stack.pop()[0]].pop()
            continue
        if tag == "br":
            parts.append(" ")
            breaks += 1
            if breaks > 1:
                close()
            continue
        if tag == "a":
            linked = True
        if tag in BLOCK_TAGS:
            close()
            heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            if tag == "li":
                linked = False
        if tag in VOID:
            continue
        kind = element_kind(tag, m[4])
        if kind != PLAIN:
            nodes.append(Node(node, kind, tag == "main"))
        if tag == "h1":
            nodes[node].titled = True
        if tag == "p":  # closed by the next block, whether or not it says so
            own = len(nodes) - 1 if kind != PLAIN else 0
        elif kind != PLAIN or depths.get(tag):
            if tag not in BLOCK_TAGS:
                close()
            depths.setdefault(tag, []).append(len(stack))
            stack.append((tag, node))
            if kind != PLAIN:
                node = len(nodes) - 1
    rest = html[at:]
    if rest:
        parts.append(unescape(rest))
    close()
    return out, nodes


def place_blocks(blocks: list[Block], nodes: list[Node]) -> set[int]:
    """Sets place and region of each node and block, and returns the regions of untitled articles without prose.

    Children stand behind their parents in nodes.
    """
    cards: set[int] = set()
    any_prose = any(b.prose() for b in blocks)
    for b in blocks:  # a page of short blocks alone is weighed by them
        nodes[b.node].prose += b.prose() if any_prose else len(b.text)
    for n in reversed(nodes[1:]):
        up = nodes[n.parent]
        up.main |= n.main and n.kind != HIDDEN
        if n.kind not in (FIRM, HIDDEN):
            up.prose += n.prose
            up.titled |= n.titled
    half, regions = nodes[0].prose / 2, 0
    for i, n in enumerate(nodes):
        up = nodes[n.parent]
        n.place, n.region = (up.place, up.region) if i else (OPEN, 0)
        bulk = n.prose > 0 and n.prose >= half
        if n.kind == HIDDEN or (n.kind == FIRM and not n.main):
            n.place, n.region = BAD, 0
        elif n.place == BAD and not (n.kind == HOME and n.main) or n.kind == HEADER and n.place == GOOD:
            continue
        elif n.kind in (HEADER, NAMED) and not n.main and not (n.titled and bulk) or n.kind == FORM and not (n.main or n.place == OPEN and (n.titled or bulk)):
            n.place, n.region = BAD, 0
        elif n.kind == HOME and n.place != GOOD:
            regions += 1
            n.place, n.region = GOOD, regions
            if any_prose and not (n.prose or n.titled or n.main):
                cards.add(regions)
    for b in blocks:
        b.place, b.region = nodes[b.node].place, nodes[b.node].region
    return cards


def _density(words: list[str]) -> float:
    return max(sum(w in s for w in words) for s in _SETS.values()) / max(1, len(words))


def _menus(blocks: list[Block]) -> set[int]:
    """Blocks of articles that lie in runs of short links, MENU_BLOCKS at least, without a heading right before them: menus, not lists of references."""
    out: set[int] = set()
    i = 0
    while i < len(blocks):
        j = i
        while j < len(blocks) and blocks[j].region == blocks[i].region and blocks[j].place == GOOD and not blocks[j].heading and len(blocks[j].text) < SHORT and blocks[j].linked() > 0.9:
            j += 1
        headed = i > 0 and blocks[i - 1].heading and blocks[i - 1].region == blocks[i].region
        if j - i >= MENU_BLOCKS and not headed:
            out.update(range(i, j))
        i = max(j, i + 1)
    return out


def classify(blocks: list[Block], cards: set[int]) -> None:
    """Both passes over placed blocks; sets each block's label to GOOD or BAD."""
    words = [[w.lower() for w in _LETTERS.findall(b.text)] for b in blocks]
    density = [_density(ws) for ws in words]
    held: dict[int, int] = {}
    for b in blocks:
        if b.place != BAD:
            held[b.region] = held.get(b.region, 0) + b.prose()
    inside = sum(n for region, n in held.items() if region)
    article = any(held) and inside >= held.get(0, 0)
    prose = [(len(ws), x * len(ws)) for b, ws, x in zip(blocks, words, density) if b.place != BAD and b.prose()]
    fits = sum(x for _, x in prose) >= FIT_DENSITY * sum(n for n, _ in prose)
    menus = _menus(blocks)
    for i, (b, ws, x) in enumerate(zip(blocks, words, density)):
        linked, long = b.linked(), len(b.text) >= SHORT
        if b.place == BAD or (not article and b.region in cards) or (b.place == OPEN and article) or i in menus:
            b.label = BAD
        elif b.place == GOOD:
            if x >= LOW_DENSITY or b.heading or linked > 0.9:
                b.label = GOOD
        elif linked > LINK_DENSITY or (not long and b.links) or "©" in b.text:
            b.label = BAD
        elif long and (x >= HIGH_DENSITY or not fits or 2 * sum(w > "\u0250" for w in ws) > len(ws)):
            b.label = GOOD
        elif long and x < LOW_DENSITY:
            b.label = BAD
    # second pass: labels of the nearest decided blocks on both sides
    before, after = _nearest(blocks, range(len(blocks))), _nearest(blocks, range(len(blocks) - 1, -1, -1))
    whole = not any(b.label == GOOD for b in blocks)
    for i, b in enumerate(blocks):
        if b.label == OPEN:
            sides = [(abs(i - j), j, label) for j, label in filter(None, (before[i], after[i]))]
            if b.place == GOOD and not b.links:  # a menu beside it is no reason to drop an article's short line
                b.label = GOOD if not sides or any(label == GOOD for _, _, label in sides) else BAD
            elif b.place == GOOD:
                b.label = min(sides)[2] if sides else GOOD
            elif b.heading and after[i]:  # a heading goes with what it heads
                b.label = after[i][1]
            elif sides:
                b.label = min(sides)[2] if not (whole and len(b.text) >= SHORT) else GOOD
            else:
                b.label = GOOD


def _nearest(blocks: list[Block], order: range) -> list[tuple[int, int] | None]:
    """For each block the decided block met last in that order, in the same region: (number, label)."""
    out: list[tuple[int, int] | None] = [None] * len(blocks)
    last: dict[int, tuple[int, int]] = {}
    for i in order:
        b = blocks[i]
        out[i] = last.get(b.region)
        if b.label != OPEN:
            last[b.region] = (i, b.label)
    return out


def main_text(html: str | None) -> tuple[str, int, int]:
    """(text, blocks, kept blocks)."""
    blocks, nodes = blocks_of(html or "")
    classify(blocks, place_blocks(blocks, nodes))
    kept = [b.text for b in blocks if b.label == GOOD]
    return "\n\n".join(kept), len(blocks), len(kept)


def extract(pages: DataFrame, carry: list[str] | None = None, html_col: str = "html") -> DataFrame:
    """row (a struct of the carried columns), text, n_chars, n_blocks, n_kept of each page."""
    ship_package(pages.sparkSession)
    carry = pages.columns if carry is None else carry
    df = pages.select(F.struct(*(pages[f"`{c}`"] for c in carry)).alias("row"), pages[html_col].alias("html"))

    def run(batches):
        for batch in batches:
            found = [main_text(x) for x in batch.column(1).to_pylist()]
            texts, n, kept = ([x[i] for x in found] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.int64())],
                ["row", "text", "n_chars", "n_blocks", "n_kept"],
            )

    return df.mapInArrow(arrow_text.tidied(run), f"row {df.schema['row'].dataType.simpleString()}, text string, n_chars long, n_blocks long, n_kept long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), carry=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", "n_chars")
