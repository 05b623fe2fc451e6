"""Main text of web pages: flat text blocks and a trained decision tree.

Method.  A page is cut into flat text blocks at every tag that is not
inline.  A block's features are its word count and link density, those of
the block before and after it, whether it stands in a main container
(``article``, ``main`` or a like-named one) or in a boilerplate one (menus,
footers, sidebars, forms, notices, adverts, comments ...), and whether the
page has a main container at all.  A decision tree, grown from the small
labelled table below by Gini impurity, says which blocks are main text.
Their texts are joined in page order by one blank.

Character references are decoded; white space inside a block becomes one
blank; scripts, styles, comments, form controls and the head are no text.

Edge cases.  A NULL or empty page, and one without a main block, has the
empty text.  Broken markup is read to the end: missing end tags, stray ends
and signs that start no tag.  Rows with NULL or repeated ids stay as they
are; columns other than those named are ignored.

Scale.  One narrow pass, page by page, no shuffle; the tree is grown once on
the driver from the labelled table and is a few numbers.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import ship_package, table

# fixed values: elements by their role
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
NO_TEXT = frozenset("head select option optgroup button object svg math canvas audio video datalist".split())
MAIN = frozenset("article main".split())
BOILER = frozenset("nav header footer aside form menu dialog".split())
MAIN_ROLE = re.compile(
    r"(?:^|[\s_-])(article|main|content|post|entry|story|body)(?:[\s_-]?(?:content|body|text|article|main))?(?=$|\s)", re.I
)
BOILER_ROLE = re.compile(
    r"(?:^|[\s_-])(ads?|ads(?:by|ense|lot)\w*|adv|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notices?|"
    r"alerts?|popup|modal|newsletter|subscri\w*|signup|login|sidebar|side|rail|menu|nav|nav(?:bar|links?|list|menu|items?|"
    r"igation)|breadcrumbs?|topbar|masthead|header|footer|foot|share|sharing|"
    r"social(?=$|\s|[_-](?:links?|shar\w+|media|icons?|buttons?|bar|nav|widgets?|follow|list|menu|feed|wrap\w*))|"
    r"related|recommend\w*|further[_-]reading|read[_-](?:more|next)|more|trending|"
    r"comments?|comment(?:list|area|box|form|thread|section|wrap\w*|container)|comment-\w+|reviews|"
    r"(?:user|customer|reader)[_-]reviews?|disqus|replies|responses|respond|widget|toolbar|pager|pagination|search|"
    r"copyright|legal|disclaimer|complementary|contentinfo|skip|tags?)(?=$|[\s_-])",
    re.I,
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>|<[a-zA-Z][^>]*\Z",
    re.S,
)
#: A whole class or id that names a main container, and words that beside it tell its topic.
STRONG_ROLE = re.compile(r"(?:^|\s)(article|main|post|entry|story)(?=$|\s)", re.I)
TOPIC = re.compile(r"(?:^|[\s_-])(legal|more|search|tags?|social|trending|copyright)(?=$|[\s_-])", re.I)
_CASE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: A slash that closes an element; one at the end of an unquoted value is part of the value.
_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)


def attributes_of(raw: str) -> dict[str, str]:
    """Names (lower case; the first of a name counts) and values of a tag's attributes."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def is_hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or bool(_NOT_SHOWN.search(attributes.get("style", "")))
        or attributes.get("aria-hidden", "").strip().lower() == "true"
    )


def spelled(roles: str) -> str:
    """Class names with their words parted: ``CommentSection`` is ``Comment-Section``."""
    return _CASE.sub("-", roles)


def names_boiler(roles: str) -> bool:
    """Whether class, id and role name a boilerplate container; a main one's topic does not."""
    return bool(BOILER_ROLE.search(TOPIC.sub(" ", roles) if STRONG_ROLE.search(roles) else roles))


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "main", "boiler", "page_main")
# fixed values: labelled kinds of blocks: words, link density in percent, stands in main, in boilerplate, page has
# main, and whether it is main text: yes, no, unless both neighbours are links, or only beside (between) sentences
LABELLED = """
  1   0  1 0 1  yes
  3   0  1 0 1  yes
  8   0  1 0 1  yes
 30   0  1 0 1  yes
150   0  1 0 1  yes
 20  40  1 0 1  yes
 60  90  1 0 1  yes
  1 100  1 0 1  unlinked
  4 100  1 0 1  unlinked
 12 100  1 0 1  unlinked
 30 100  1 0 1  unlinked
  1   0  1 1 1  no
  9   0  1 1 1  no
 60   0  1 1 1  no
  3 100  1 1 1  no
  1   0  0 1 1  no
 12   0  0 1 1  no
 80   0  0 1 1  no
  2 100  0 1 1  no
  4   0  0 1 0  no
 25   0  0 1 0  no
 90   0  0 1 0  no
  2 100  0 1 0  no
  3   0  0 0 1  no
 20   0  0 0 1  no
 90   0  0 0 1  no
  2 100  0 0 1  no
 30  60  0 0 1  no
  2   0  0 0 0  between
  6   0  0 0 0  beside
 10   0  0 0 0  beside
 12  10  0 0 0  beside
 15   0  0 0 0  unlinked
 17  20  0 0 0  unlinked
 22   0  0 0 0  yes
 45   5  0 0 0  yes
120   0  0 0 0  yes
 30  30  0 0 0  yes
  1 100  0 0 0  no
  5  80  0 0 0  no
 30  85  0 0 0  no
 60  90  0 0 0  no
"""
#: Neighbours (words, link density) that every kind is met with, before and after.
NEIGHBOURS = ((0, 0), (1, 100), (5, 100), (40, 90), (3, 0), (12, 0), (25, 0), (90, 5))


def labelled_rows() -> list[tuple]:
    """The labelled table: every kind of block between all pairs of neighbours; FEATURES, then the label."""
    rows = []
    for line in LABELLED.strip().splitlines():
        *numbers, rule = line.split()
        words, links, main, boiler, page_main = map(int, numbers)
        for before in NEIGHBOURS:
            for after in NEIGHBOURS:
                label = {
                    "yes": True,
                    "no": False,
                    "unlinked": min(before[1], after[1]) < 75,
                    "beside": any(w >= 10 and k < 50 for w, k in (before, after)),
                    "between": all(w >= 10 and k < 50 for w, k in (before, after)),
                }[rule]
                rows.append((words, links, *before, *after, main, boiler, page_main, label))
    return rows


def grow(rows: list[tuple], depth: int = 12):
    """Decision tree of rows (features..., label): a label, or (feature, limit, tree at most, tree above)."""
    labels = Counter(r[-1] for r in rows)
    if len(labels) == 1 or not depth:
        return labels.most_common(1)[0][0]

    def impurity(part: list[tuple]) -> float:
        n = len(part)
        return n - sum(c * c for c in Counter(r[-1] for r in part).values()) / n

    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            limit = (a + b) / 2
            low, high = [r for r in rows if r[f] <= limit], [r for r in rows if r[f] > limit]
            score = impurity(low) + impurity(high)
            if best is None or score < best[0] - 1e-12:
                best = (score, f, limit, low, high)
    if best is None:
        return labels.most_common(1)[0][0]
    _, f, limit, low, high = best
    return (f, limit, grow(low, depth - 1), grow(high, depth - 1))


def trained_tree():
    return grow(labelled_rows())


def decide(tree, features: tuple) -> bool:
    while isinstance(tree, tuple):
        f, limit, low, high = tree
        tree = low if features[f] <= limit else high
    return bool(tree)


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, link words, in main, in boilerplate) of every flat text block, in page order."""
    out: list[tuple[str, int, int, bool, bool]] = []
    # open elements: (name, main, boilerplate, hidden, link); what holds inside is the last one's
    stack = [("", False, False, False, False)]
    parts: list[tuple[str, bool]] = []

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = sum(len(html.unescape(t).split()) for t, link in parts if link)
                words = text.count(" ") + 1
                out.append((text, words, min(linked, words), stack[-1][1], stack[-1][2]))
            parts.clear()

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        end = m.start() if m else size
        if end > at and not stack[-1][3]:
            parts.append((page[at:end], stack[-1][4]))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            close_block()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break  # an inline end does not close a block
            continue
        attributes = m[3] or m[6] or ""
        if name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else size
            continue
        if name in VOID or _CLOSED.search(attributes):
            continue
        if name not in INLINE:
            for i in range(len(stack) - 1, 0, -1):  # an open paragraph (or list item) ends here
                if stack[i][0] == "p" or stack[i][0] == name == "li":
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
        _, main, boiler, hidden, link = stack[-1]
        if name not in INLINE:
            own = attributes_of(attributes.rstrip("/")) if attributes else {}
            roles = spelled(" ".join(own[k] for k in ("class", "id", "role") if own.get(k)))
            named_boiler = bool(roles) and names_boiler(roles)
            whole = name in ("html", "body")  # names of the whole page say nothing about its parts
            plain = not named_boiler and not whole and name not in BOILER
            own_main = name in MAIN or (bool(roles) and plain and bool(MAIN_ROLE.search(roles)))
            # the header of an article holds its title; that of a page does not
            own_boiler = named_boiler and not whole and name not in MAIN or (
                name in BOILER and not (name == "header" and main)
            )
            hidden = hidden or name in NO_TEXT or is_hidden(own)
            main, boiler = main or own_main, boiler or own_boiler
        stack.append((name, main, boiler, hidden, link or name == "a"))
    close_block()
    return out


def main_text(page: str | None, tree) -> str:
    """The main text of a page (NULL: empty)."""
    found = blocks(page or "")
    has_main = any(b[3] and not b[4] for b in found)
    around = [(0, 0.0), *((w, 100 * k / w) for _, w, k, _, _ in found), (0, 0.0)]
    kept = []
    for i, (text, _, _, main, boiler) in enumerate(found, 1):
        if decide(tree, (*around[i], *around[i - 1], *around[i + 1], main, boiler, has_main)):
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), column: str = "html") -> DataFrame:
    """(keys..., text) of every page."""
    tree = trained_tree()
    ship_package(pages.sparkSession)
    names = [*keys, "text"]

    def run(batches):
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(texts, pa.string())], names=names
            )

    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.select(*keys, column).mapInArrow(run, f"{kinds}, text string")


def op6_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; see the module."""
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
