"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one looks at each block's
own words: blocks in page furniture (menus, headers, footers, asides, forms,
adverts, notices, comments) and blocks made of links are boilerplate, long
blocks with the stop-word density of prose are content, long ones without it
are not, and short ones stay undecided. Stop words judge only where the page's
prose is in a language that has a list here, and only Latin script; other long
blocks are content. Length counts words, and characters in scripts that put no
space between words. Where that finds no content at all, every block of few
links that is not furniture is content. Pass two gives undecided blocks the
label of their nearest decided neighbours. Where a page marks its article,
every block inside is content but furniture and runs of list items that are
all link, and no block outside is. Inside, furniture is told by element names,
roles, whole class names and a few whole ids, as other ids are made from headings
there. An article that is marked as a comment, advert or teaser is furniture itself.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_WORDS = 12
STOP_DENSITY = 0.2
LINK_DENSITY = 0.4

# Common function words of English, German, French and Spanish.
STOP_LISTS = tuple(
    frozenset(words.split())
    for words in (
        """
        a about after all also an and are as at be been but by can for from had has have he her his if in into is it its
        more no not of on one or our out she so than that the their them then there they this to up was we were what when
        which who will with would you
        """,
        """
        aber als am an auch auf aus bei bin das dass dem den der des die du ein eine einem einen einer er es für haben hat
        ich im in ist kann mit nach nicht noch nur oder sich sie sind so um und uns von war wie wir wird zu zum zur über
        """,
        """
        au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou où par pas plus
        pour qu que qui sa se ses son sont sur un une vous
        """,
        """
        al como con de del el ella en es esta este fue ha hay la las lo los más me no o para pero por que se si sin sobre su
        sus un una y ya
        """,
    )
)
STOP_WORDS = frozenset().union(*STOP_LISTS)
#: Part of one list's words in the prose of a page that is in its language.
LANGUAGE_DENSITY = 0.3

# Element names.
#: What stands inside is no markup up to the end tag.
RAW = ("script", "style", "iframe", "textarea", "title")
FOREIGN = frozenset("svg math".split())
SKIPPED = FOREIGN | frozenset("noscript template object select".split())
#: Elements that end an unclosed svg or math, and those inside of which they don't.
BREAKOUT = frozenset(
    """article aside blockquote body center dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre
    section table ul""".split()
)
HTML_INSIDE = frozenset("foreignobject annotation-xml desc".split())
FURNITURE = frozenset("nav footer aside form menu dialog button fieldset head".split())
MAIN = frozenset("article main".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q ruby rt rp s
    samp small span strike strong sub sup time tt u var wbr input link meta""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new block of the same kind closes.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

# Parts of class, id and role names that mark furniture.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alerts?|popup|modal"
    r"|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|nav\w*|menu\w*|breadcrumbs?|pagination|pager"
    r"|side-?bar\w*|aside|widgets?|related|recommend\w*|more-?from|trending|comments?|commentlist|respond|reply|replies"
    r"|disqus\w*|footer\w*|masthead|site-?header|page-?header|top-?bar|copyright|legal|disclaimer|toolbar|skip-?link"
    r"|complementary|contentinfo|navigation|search)(?=$|[\s_-])",
    re.I,
)
#: Class names that mark furniture inside an article, as a whole.
_MARK = (
    r"(?:ads?|adv|advert(?:s|isements?|ising)?|sponsor(?:s|ed)?|promos?|banners?|cookies?|consent|gdpr|notices?|alerts?"
    r"|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|nav|navbar|navigation|menus?"
    r"|menubar|breadcrumbs?|pagination|pager|side-?bars?|aside|widgets?|related|recommended|recommendations|more-?from"
    r"|trending|comments?|commentlist|respond|reply|replies|disqus|footer|masthead|site-?header|page-?header|top-?bar"
    r"|copyright|legal|disclaimer|toolbar|skip-?link|search)"
)
_PART = (
    r"(?:list|box|bar|links?|buttons?|icons?|wrap|wrapper|container|section|area|form|block|items?|inner|posts|articles"
    r"|stories|thread|site|main|top|bottom|post|article|entry|page|body|content|text|meta|author|units?|slots?|google"
    r"|user|reader|children|depth|\d+)"
)
WHOLE_MARK = re.compile(rf"(?:{_PART}[_-]+)*{_MARK}(?:[_-]+(?:{_MARK}|{_PART}))*", re.I)
#: Marks of an article that is none.
ARTICLE_MARK = re.compile(
    rf"(?:{_PART}[_-]+)*(?:comments?|reply|replies|ads?|advert(?:isement)?|promo|sponsored|related|recommended)(?:[_-]+{_PART})*",
    re.I,
)
#: Ids that mark furniture inside an article too; headings do not make them.
MARK_ID = re.compile(
    r"(?:(?:post|reader|user|article)[_-]?)?comments?(?:[_-]?(?:list|section|area|form|wrapper|container|\d+))?|respond"
    r"|reply[_-]?form|disqus[_-]thread|side-?bar|footer|related-?posts|share-?buttons|social-?share|newsletter-signup"
    r"|cookie-(?:banner|notice|consent)",
    re.I,
)
#: Where a name in camel case is taken apart.
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: So many list items in a row that are all link are a menu inside an article too.
LINK_RUN = 3
ALL_LINK = 0.9
ATTRIBUTE = re.compile(r"\b(class|id|role|style|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Class names of wrappers that only say what a page has, or has not.
LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|layout)-\S+", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|/|$)", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>\"']*)((?>[^<>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*(?:>|\Z)",
    re.S | re.I,
)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
WORD = re.compile(r"[^\W\d_]+")


#: Scripts without spaces between words: Thai to Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = re.compile(
    r"[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)
UNSPACED_WORD = 2  # characters
LATIN = re.compile(r"[a-z\u00df-\u024f\u1e00-\u1eff]")


@dataclass
class Block:
    text: str
    link_chars: int
    furniture: bool
    main: int  # number of the article that holds it, 0 for none
    item: bool = False  # stands in a list item
    label: bool | None = None
    words: int = 0
    latin: bool = True
    by_list: tuple[int, ...] = ()  # words that stand in each stop list
    stop_density: float = 0.0
    link_density: float = 0.0


def _is_furniture(name: str, attributes: str, in_main: bool) -> bool:
    if name in FURNITURE or (name == "header" and not in_main):
        return True
    if not attributes:
        return False
    if HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)):
        return True
    for key, *values in ATTRIBUTE.findall(attributes):
        value, key = "".join(values), key.lower()
        if key == "style":
            marked = UNSEEN.search(value)
        elif key == "aria-hidden":
            marked = value.lower() == "true"
        elif in_main and key != "role":
            marked = name not in HEADINGS and name not in MAIN and _marked_inside(key, value)
        else:
            marked = name not in ("html", "body") and name not in MAIN and MARKS.search(LAYOUT.sub("", value))
        if name == "article" and key in ("class", "id"):
            marked = any(ARTICLE_MARK.fullmatch(CAMEL.sub("-", t)) for t in value.split())
        if marked:
            return True
    return False


def _marked_inside(key: str, value: str) -> bool:
    """Whether a class or id marks furniture inside an article."""
    if key == "id":
        return bool(MARK_ID.fullmatch(value.strip()))
    return any(WHOLE_MARK.fullmatch(CAMEL.sub("-", t)) for t in LAYOUT.sub("", value).split())


def _is_main(name: str, attributes: str) -> bool:
    if name in MAIN:
        return True
    return "role" in attributes.lower() and any(
        key.lower() == "role" and "".join(values).strip().lower() == "main" for key, *values in ATTRIBUTE.findall(attributes)
    )


def blocks_of(page: str) -> list[Block]:
    """The page's blocks that have text, in page order."""
    out: list[Block] = []
    open_tags: list[tuple[str, bool, bool]] = []  # name, furniture, main
    named: Counter[str] = Counter()  # open_tags by name
    parts: list[str] = []
    inline: Counter[str] = Counter()  # open inline elements of the block
    within: Counter[str] = Counter()  # open elements from the outermost skipped one on
    links = furniture = mains = items = in_link = articles = at = 0
    skipped = 0  # length of open_tags up to the outermost skipped element, 0 outside of one

    def text(raw: str) -> None:
        nonlocal links
        if raw and not skipped:
            parts.append(raw)
            if in_link:
                links += len(raw.strip())

    def flush() -> None:
        nonlocal links
        joined = " ".join(html.unescape("".join(parts)).split())
        if joined:
            out.append(Block(joined, links, furniture > 0, articles if mains else 0, items > 0))
        parts.clear()
        inline.clear()
        links = 0

    def enter(name: str, bad: bool = False, body: bool = False) -> None:
        open_tags.append((name, bad, body))
        named[name] += 1

    def pop() -> tuple[str, bool, bool]:
        last = open_tags.pop()
        named[last[0]] -= 1
        return last

    def close() -> None:
        nonlocal furniture, mains, items
        name, f, m = pop()
        items -= name == "li"
        furniture -= f
        mains -= m

    def skipped_tag(name: str, end: str, attributes: str) -> bool:
        """Takes a tag inside a skipped element; false if it ends that element and counts itself."""
        opens = not end and name not in VOID and not attributes.endswith("/")
        if name in INLINE:
            if opens:
                within[name] += 1
            elif end and not within[name] and inline[name]:
                leave()
                return False
            elif end and within[name]:
                within[name] -= 1
            return True
        if end and within[name]:
            while (last := pop()[0]) != name:
                within[last] -= 1
            within[name] -= 1
            if len(open_tags) < skipped:
                leave()
            return True
        if end:
            stays = not named[name]
        else:
            stays = not (
                open_tags[skipped - 1][0] in FOREIGN and name in BREAKOUT and not any(within[x] for x in HTML_INSIDE)
            )
        if not stays:
            leave()
        elif opens:
            enter(name)
            within[name] += 1
        return stays

    def leave() -> None:
        nonlocal skipped
        while len(open_tags) >= skipped:
            pop()
        skipped = 0
        within.clear()

    while found := TOKEN.search(page, at):
        text(page[at : found.start()])
        at = found.end()
        name, attributes = (found[2] or "").lower(), found[3] or ""
        if not name:
            continue
        if name in RAW:
            if not found[1] and not (attributes.endswith("/") and any(named[x] for x in FOREIGN)):
                over = RAW_END[name].search(page, at)
                at = over.end() if over else len(page)
            continue
        if skipped and skipped_tag(name, found[1], attributes):
            continue
        if name in SKIPPED:
            if not found[1] and not (name in FOREIGN and attributes.endswith("/")):
                enter(name)
                within[name] += 1
                skipped = len(open_tags)
            continue
        if name == "a":
            in_link = 0 if found[1] else 1
        if name in INLINE:
            if not found[1]:
                inline[name] += name not in VOID
            elif inline[name]:
                inline[name] -= 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if found[1]:
            if named[name]:
                while True:
                    last = open_tags[-1][0]
                    close()
                    if last == name:
                        break
            continue
        if name in SELF_CLOSING and open_tags and open_tags[-1][0] == name:
            close()
        in_link = 0
        if attributes.endswith("/") and name not in MAIN:
            continue
        bad = _is_furniture(name, attributes, mains > 0)
        body = _is_main(name, attributes) and not furniture and not bad
        if body and not mains:
            articles += 1
        enter(name, bad, body)
        furniture += bad
        mains += body
        items += name == "li"
    text(page[at:])
    flush()
    return out


def label_blocks(blocks: list[Block]) -> list[Block]:
    """Pass one by the blocks' own words, pass two by neighbours."""
    marked = any(b.main and not b.furniture for b in blocks)
    long: list[Block] = []
    for b in blocks:
        lower = b.text.lower()
        words = WORD.findall(lower)
        b.words = len(words)
        b.stop_density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if not lower.isascii():
            unspaced = len(UNSPACED.findall(lower))
            if unspaced:
                b.words = len(WORD.findall(UNSPACED.sub(" ", lower))) + unspaced // UNSPACED_WORD
            b.latin = 2 * len(LATIN.findall(lower)) >= sum(len(w) for w in words)
        if not marked and b.words >= LONG_WORDS and b.stop_density >= STOP_DENSITY:
            b.by_list = tuple(sum(w in words_of for w in words) for words_of in STOP_LISTS)
        b.link_density = min(1.0, b.link_chars / max(1, len(b.text)))
        if b.furniture or (marked and not b.main):
            b.label = False
        elif b.main:
            b.label = True
        elif b.link_density > LINK_DENSITY:
            b.label = False
        elif b.words >= LONG_WORDS:
            long.append(b)
    prose = [b for b in long if b.by_list]
    hits = max((sum(n) for n in zip(*(b.by_list for b in prose), strict=True)), default=0)
    listed = hits > 0 and hits >= LANGUAGE_DENSITY * sum(b.words for b in prose)
    for b in long:
        b.label = b.stop_density >= STOP_DENSITY or not b.latin or not listed
    if not marked and not any(b.label for b in blocks):
        for b in blocks:
            b.label = not b.furniture and b.link_density <= LINK_DENSITY
    for _, run in groupby(blocks, lambda b: (b.main, b.label and b.item and b.link_density >= ALL_LINK)):
        run = list(run)
        if run[0].main and run[0].label and run[0].item and run[0].link_density >= ALL_LINK and len(run) >= LINK_RUN:
            for b in run:
                b.label = False
    inherited: list[list[tuple[int, bool]]] = [[] for _ in blocks]
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        # distance to, and label of, the last decided block
        away, near = 0, None
        for i in order:
            b = blocks[i]
            away += 1
            if b.label is not None:
                away, near = 0, b.label
            elif near is not None:
                inherited[i].append((away, not near))
    for b, sides in zip(blocks, inherited, strict=True):
        if b.label is None:
            b.label = not min(sides)[1] if sides else False
    return blocks


def main_text(page: str | None) -> tuple[str, int, int]:
    """The kept blocks joined by one space, the number of blocks, of kept ones."""
    blocks = label_blocks(blocks_of(page or ""))
    kept = [b.text for b in blocks if b.label]
    return " ".join(kept), len(blocks), len(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(p.as_py()) for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array([t for t, _, _ in found], pa.string()),
                pa.array([len(t) for t, _, _ in found], pa.int64()),
                pa.array([n for _, n, _ in found], pa.int32()),
                pa.array([k for _, _, k in found], pa.int32()),
            ],
            names=["row", "text", "n_chars", "n_blocks", "n_kept"],
        )


def extract_main_text(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """``row`` (the page's other columns), ``text``, ``n_chars``, ``n_blocks``, ``n_kept``.

    Null or empty html, and pages without content blocks, have an empty text.
    Character references are decoded, white space inside a block becomes one space.
    Nothing is cut, however long a page is. Repeated rows get equal texts, an empty
    table an empty result; columns of any name ride along in ``row``.
    """
    others = [F.col(f"`{c}`") for c in pages.columns if c != html_col]
    packed = pages.select(F.struct(*others).alias("row"), F.col(html_col).cast("string").alias("html"))
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(_extract, f"row {kind}, text string, n_chars bigint, n_blocks int, n_kept int")


def op2_query(spark: SparkSession, root: str) -> DataFrame:
    pages = spark.read.parquet(f"{root}/pages.parquet").select("page_id", "url", "html")
    return extract_main_text(pages).select("row.page_id", "row.url", "text", "n_chars")
