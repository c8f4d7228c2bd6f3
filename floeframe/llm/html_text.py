"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of tags and runs of text. A run scores for each of its words what its containers weigh, a tag
scores below zero; the contiguous part with the highest sum is the content, found in one linear scan. Weights come
from labelled pages, of which a bounded sample (linear.SAMPLE) is read: pages that mark their article. For a
container (an element such as nav, aside or div with its first class) the weight is the log of its words inside to
those outside of articles, for a tag likewise its places. Containers never seen take a prior from their names.
Inside the content, what lies in containers below zero is left out, so are scripts, styles and comments, and what
lies in DROPPED elements (svg, button and the like) as far as these are closed. A container's name is not the last
word: `article` and `main` are content whatever their class, but for reader comments, and so is what holds the article
and most of the page's words, or nearly all words.

Null html counts as empty and gives the empty text; repeated rows give equal rows; an empty table gives an empty
one; other columns play no part. Broken markup, unclosed elements and text without tags are read as far as they go.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from floeframe.llm.common import arrow_map
from floeframe.llm.linear import sampled

#: Attributes of a tag, without going back: a `<` that could begin a tag ends an unclosed one, so all takes linear time.
ATTRIBUTES = r"(?:[^<>\"']|<(?![A-Za-z/!?])|\"[^\"]*\"|'[^']*')*+"
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(script|style|textarea)(?=[\s/>]){ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)({ATTRIBUTES})>",
    re.S | re.I,
)
CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CONTAINERS = frozenset("nav header footer aside form article main section div ul ol dl table menu dialog fieldset figure blockquote details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption pre address hr body html option figcaption summary center".split())
#: Elements whose inside is no text of the page, those of them that don't nest, and what a head can hold.
DROPPED = frozenset("noscript template svg iframe select title head math object canvas button".split())
FLAT = frozenset("iframe select title head button".split())
HEADS = frozenset("base basefont bgsound link meta noscript script style template title head html".split())
CLOSING = re.compile(rf"</({'|'.join(sorted(DROPPED))})(?=[\s/>])", re.I)
#: Elements that are no content by their name, and words of classes that say so (fixed values).
ASIDE_NAMES = frozenset("nav footer aside form menu dialog fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies copyright discussion disqus foot footer legal login masthead menu modal nav navbar navigation newsletter"
    " notice pager pagination popup promo promoted promotion recommend recommendation recommendations recommended related"
    " replies respond search share sharing side sidebar signup skip skiplink social sponsor sponsored subscribe"
    " subscription tag tags toolbar widget".split()
)
#: Words that say nothing of their own beside one of those (fixed values).
PLAIN_WORDS = frozenset(
    "a action actions area articles bar block body bottom box btn button buttons card container content cta desktop"
    " entry fixed footer form global group header holder icons inner item items l label large left lg line link links"
    " list main mobile more msg m of page pane panel part post posts primary r rail right row s section site slot sm"
    " small stories sticky text the title top unit user v wrap wrapper x xl zone".split()
)
#: Of a class, what says that something is elsewhere on the page, or not there.
OTHERS = re.compile(r"(?:has|with|no|not|without|is)[-_]")
#: Words of classes that say so whatever stands beside them (fixed values).
COMMENT_WORDS = frozenset("comment comments disqus replies".split())
STRONG, WEAK = 3.0, 0.2


@functools.lru_cache(100_000)
def aside_mark(mark: str) -> bool:
    """Whether a class, id or role is made of words that mark what is no content: side-bar is, side-effects isn't."""
    if OTHERS.match(mark):
        return False
    words = [w for w in re.split(r"[^a-z]+", mark) if w]
    return any(w in ASIDE_WORDS for w in words) and all(w in ASIDE_WORDS or w in PLAIN_WORDS for w in words)


@functools.lru_cache(100_000)
def comment_mark(mark: str) -> bool:
    """Whether a class, id or role tells of reader comments, or of an advert of them."""
    return not OTHERS.match(mark) and not COMMENT_WORDS.isdisjoint(re.split(r"[^a-z]+", mark))


class Box:
    """An open container: its key, whether it or one around it is an aside or the article, and what weight follows."""

    __slots__ = ("name", "key", "own", "comments", "holds", "aside", "inner", "article", "weight", "around", "words")

    def __init__(self, name: str, attributes: str, around: Box | None, fresh):
        marks = " ".join(a or b or c for a, b, c in CLASS.findall(attributes)).lower().split() if attributes else []
        main = name in ("article", "main")
        self.comments = any(map(comment_mark, marks))
        # a name of a class doesn't outdo the element that stands for content
        self.own = own = name in ASIDE_NAMES or self.comments or not main and any(map(aside_mark, marks))
        self.name, self.around, self.holds = name, around, False
        if main and not own and around is not None and not around.holds:
            box = around
            while box is not None and not box.holds:
                box.holds, box = True, box.around
        self.key = name if name not in CONTAINERS else ".".join([name, *(re.sub(r"\d+", "", m) for m in marks[:2])])
        self.aside = own or around is not None and around.aside
        was_inner = around is not None and around.inner
        self.inner = was_inner or main
        self.article = name == "article" or around is not None and around.article
        self.weight = fresh(self, own, was_inner)
        self.words = [0, 0]


def parsed(page: str, fresh=lambda box, own, was_inner: 0.0):
    """("tag", name, box, is_close) and ("text", text, box, in_link) in page order, outside of DROPPED.

    box is the innermost open container, or None. fresh gives a new one its weight. A DROPPED element ends at its
    closing tag, at <body>, with its parent, and where HTML ends it: a head at what it can't hold, svg and math at a
    block, one that doesn't nest at the next. Never closed, it drops nothing.
    """
    stack: list[Box] = []
    depths: Counter = Counter()  # open elements of each name
    link, at = 0, 0
    ends = {m[1].lower(): m.start() for m in CLOSING.finditer(page)}
    dropped: int | None = None  # place in the stack of the outermost DROPPED
    inside: Counter = Counter()  # blocks opened in it

    def cut(depth: int) -> None:
        while len(stack) > depth:
            depths[stack.pop().name] -= 1

    def box() -> Box | None:
        return stack[-1] if stack else None

    for m in MARKUP.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            if dropped is not None and stack[-1].name == "head" and not text.isspace():
                cut(dropped)
                dropped = None
            if dropped is None:
                yield "text", text, box(), link > 0
        at = m.end()
        if m[3] is None:
            continue
        name, close = m[3].lower(), bool(m[2])
        if dropped is not None:
            if close:
                ended = name in BLOCKS and not inside[name]
                inside[name] -= inside[name] > 0
            else:
                top = stack[-1].name
                ended = name == "body" or top == "head" and name not in HEADS
                ended = ended or top in ("svg", "math") and name in BLOCKS or top == name and name in FLAT
                inside[name] += name in BLOCKS and not ended
            if ended:
                cut(dropped)
                dropped = None
        if name == "a" and (dropped is None or close):
            link = 0 if close else 1
        if dropped is None and name not in DROPPED:
            yield "tag", name, box(), close
        if (name in CONTAINERS or name in DROPPED) and not m[4].endswith("/"):
            if not close:
                if name in CONTAINERS or name == "head" or ends.get(name, -1) > at:
                    stack.append(Box(name, m[4], box(), fresh))
                    depths[name] += 1
                    if name in DROPPED and dropped is None:
                        dropped, inside = len(stack) - 1, Counter()
            elif depths[name]:
                depth = len(stack) - 1
                while stack[depth].name != name:
                    depth -= 1
                cut(depth)
                if dropped is not None and len(stack) <= dropped:
                    dropped = None
    if at < len(page) and (dropped is None or stack[-1].name == "head"):
        if dropped is not None:
            cut(dropped)
        yield "text", page[at:], box(), link > 0


def counted(page: str) -> list[tuple[str, int, int]]:
    """(key, places inside, places outside the article) of a labelled page; nothing of others."""
    if page.lower().count("<article") != 1:
        return []
    inside, outside, boxes = Counter(), Counter(), []

    def fresh(box: Box, own: bool, was_inner: bool) -> float:
        boxes.append(box)
        return 0.0

    for kind, x, box, z in parsed(page, fresh):
        marked = box is not None and box.article
        if not marked and box is not None and box.aside:
            continue  # its container's name says enough: a list in a menu tells nothing of lists
        if kind == "tag":
            (inside if marked else outside)[f"<{x}"] += 1
        else:
            n = len(x.split())
            (inside if marked else outside)["a" if z else "text"] += n
            if box is not None:
                box.words[not marked] += n
    for box in reversed(boxes):  # a container has the words of those within it
        inside[box.key] += box.words[0]
        outside[box.key] += box.words[1]
        if box.around is not None:
            box.around.words[0] += box.words[0]
            box.around.words[1] += box.words[1]
    return [(k, inside[k], outside[k]) for k in {*inside, *outside} if inside[k] + outside[k]]


COUNTS = StructType([StructField("key", StringType()), StructField("inside", LongType()), StructField("outside", LongType())])


def learnt(pages: DataFrame) -> dict[str, float]:
    """key -> log of places inside to outside, from about linear.SAMPLE labelled pages."""
    few = sampled(pages.select(F.col("page_id").alias("doc_id"), "html"), pages.count()).select(F.coalesce("html", F.lit("")).alias("html"))

    def columns(batch):
        total: dict[str, list[int]] = {}
        for page in batch.column(0).to_pylist():
            for k, i, o in counted(page):
                t = total.setdefault(k, [0, 0])
                t[0] += i
                t[1] += o
        return [list(total), [t[0] for t in total.values()], [t[1] for t in total.values()]]

    rows = arrow_map(few, columns, COUNTS).groupBy("key").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).where("i + o >= 20").collect()
    return {r["key"]: math.log((r["i"] + 1) / (r["o"] + 1)) for r in rows}


def best_part(scores: list[float]) -> tuple[int, int]:
    """(first, end) of the contiguous part with the highest sum, the first of equal ones; (0, 0) if none is above 0."""
    best, first, end = 0.0, 0, 0
    total, begin = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, first, end = total, begin, i + 1
    return first, end


def content_after_all(boxes: list[Box], total: int) -> set[int]:
    """Numbers of boxes that are no asides though their names say so: those that hold the article and most of the
    page's words, or nearly all words. Comments, menus and the like never are."""
    made = set()
    for k, box in enumerate(boxes):
        if box.own and not box.comments and (box.name not in ASIDE_NAMES or box.name == "form"):
            words = box.words[0]
            if box.holds and 2 * words > total or 10 * words >= 9 * total > 0:
                made.add(k)
    return made


def main_text(page: str, weights: dict[str, float]) -> str:
    """The text of a page's content. Where a container turns out to be content against its name, it is read again so."""
    text, boxes, total = read(page, weights, frozenset())
    if any(box.own for box in boxes) and (content := content_after_all(boxes, total)):
        return read(page, weights, content)[0]
    return text


def read(page: str, weights: dict[str, float], content: set[int] | frozenset[int]) -> tuple[str, list[Box], int]:
    """(text, containers in page order, words); content: numbers of containers that are no asides."""
    boxes: list[Box] = []

    def clipped(key: str) -> float:
        return max(-STRONG, min(STRONG, weights.get(key, 1.0)))

    def fresh(box: Box, own: bool, was_inner: bool) -> float:
        """What the box's words weigh: the least of the containers around them. A header in an article is its own."""
        boxes.append(box)
        if len(boxes) - 1 in content:
            weight = max(WEAK, clipped(box.key))
        elif own or box.name == "header" and not was_inner:
            weight = -STRONG
        else:
            weight = STRONG if box.name in ("article", "main") else clipped(box.key)
        return min(weight, box.around.weight) if box.around is not None else weight

    plain, total = clipped("text"), 0
    scores: list[float] = []
    blocks: list[list] = [[]]  # of (token number, text, good)
    for kind, x, box, z in parsed(page, fresh):
        number = len(scores)
        if kind == "tag":
            scores.append(-max(0.05, min(0.5, -weights.get(f"<{x}", -0.1))))
            if x in BLOCKS and blocks[-1]:
                blocks.append([])
            elif x == "br":
                blocks[-1].append((number, " ", False))
        else:
            weight = box.weight if box is not None else plain
            n = len(x.split())
            total += n
            if box is not None:
                box.words[0] += n
            # words that are left out anyway need not cut the content in two: an advert within costs little
            good = weight > -1 and not (z and weight < 1)
            scores.append(n * max(WEAK, weight) if good else -min(STRONG, WEAK * n))
            blocks[-1].append((number, x, weight > -1))
    for box in reversed(boxes):  # a container has the words of those within it
        if box.around is not None:
            box.around.words[0] += box.words[0]
    first, end = best_part(scores)
    kept = ("".join(x for n, x, good in block if first <= n < end and (good or x == " ")) for block in blocks)
    shown = (" ".join(html.unescape(x).split()) for x in kept)
    return "\n\n".join(x for x in shown if x), boxes, total


SCHEMA = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("text", StringType()), StructField("n_chars", LongType())])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages."""
    weights = learnt(pages)

    def columns(batch):
        texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), texts, [len(t) for t in texts]]

    return arrow_map(pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")), columns, SCHEMA)
