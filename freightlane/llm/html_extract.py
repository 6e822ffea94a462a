"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block of the page; regions that are boilerplate by their element, role, class or
id are stripped with it. The text lengths of the lines are summed over sliding windows. A surge is where the sums rise
from nothing over a threshold, a dive is where they fall back to nothing; the text between a surge and its dive is kept.

A line's length is that of its text without linked text, which is what menus and lists of links consist of; links of headings
count, and so does a line of links that has no other beside it. Where a page marks articles, only lines inside them have a length,
any surge there is one, so short paragraphs and headings stay, and of several articles those stay that have at
least half the length of the longest; what stands in <main> but in no article counts as one more. Elsewhere a surge
must reach SURGE characters; a page without any keeps its longest run.

A class, id or role names a region if it consists of words for boilerplate and of words for parts of pages only. A region that holds most of the page's text is a wrapper and stays,
unless the page marks its article outside of it; where nothing is left of a page without an article, its regions count as text.

Defined cases: NULL and empty pages have the empty text; tags, quotes and elements that never close are read as
browsers do, as far as their text is concerned; repeated rows have the same result each; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import text_of

WINDOW = 3
SURGE = 80

# Element names by what they do to the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup or no text of the page.
RAW = frozenset("script style title textarea noscript template iframe svg math object select button canvas audio video".split())
#: These go on to the end of the page if they are never closed; the others are no elements then.
ENDLESS = frozenset("script style title textarea".split())
BOILERPLATE = frozenset("nav menu header head dialog".split())
#: Not even an article inside them is the page's article.
ASIDE = frozenset("aside footer form".split())
# Words in classes, ids and roles.
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs consent contentinfo cookie"
    " cookies copyright gdpr header hidden login masthead menu menubar modal nav navbar navigation notice notices"
    " bio notification pager pagination paywall popup promo promotion search share sharing skip social sponsor sponsored"
    " subscribe newsletter toolbar topbar widget".split()
)
ASIDE_WORDS = frozenset(
    "comment comments commentlist complementary disqus discussion footer related recommended replies reply respond"
    " sidebar".split()
)
#: Parts of pages: these name a region together with a word of the others, never alone.
PART_WORDS = frozenset(
    "area author bar block bottom box button buttons column container content footer group inline item items left link links list panel"
    " post posts reader right row section signup site slot thread top unit user wrap wrapper zone".split()
)
#: Where a header is one of the page and not of its article.
PAGE_WORDS = frozenset("global page site top".split())
ARTICLE_WORDS = frozenset("article articlebody main".split())
MARKS = {"main": 1, "article": 2}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S,
)
NAMED = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
CLOSES_PARAGRAPH = BLOCKS - {"br", "body", "html"}
#: A start tag of the first kind ends an open element of the second.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}


def named(value: str) -> list[str]:
    """The words for boilerplate in a class, id or role if all of its words are such or name parts of pages."""
    words = [w.lower() for w in WORDS.findall(value)]
    found = [w for w in words if w in BOILERPLATE_WORDS or w in ASIDE_WORDS]
    rest = set(words).difference(found)
    if set(found) == {"header"} and not rest <= PAGE_WORDS:
        return []
    return found if rest <= PART_WORDS | PAGE_WORDS else []


def region(name: str, attributes: str, inside: int) -> tuple[int, int]:
    """What an element is: 0 text, 1 boilerplate, 2 boilerplate that no article can be in; and 1 for a main part, 2 for an article."""
    kind = 2 if name in ASIDE else 1 if name in BOILERPLATE and not (inside and name == "header") else 0
    article = MARKS.get(name, 0)
    if attributes and name not in ("html", "body"):
        words: set[str] = set()
        for key, *values in NAMED.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id", "role", "itemprop"):
                words.update(w for n in value.split() for w in named(n))
                if key in ("role", "itemprop", "id") and value.lower() in ARTICLE_WORDS:
                    article = max(article, MARKS.get(value.lower(), 2))
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                kind = max(kind, 1)
            elif key == "style" and "display:none" in value.replace(" ", "").lower():
                kind = max(kind, 1)
        if inside:
            words -= {"header"}
        if words & ASIDE_WORDS:
            kind = 2
        elif words & BOILERPLATE_WORDS:
            kind = max(kind, 1)
    return kind, 0 if kind else article


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """(text, characters within links but for spaces, article) of every block, without boilerplate.

    Articles have numbers from 2 on; 1 is a main part outside of them, 0 the rest of the page.
    """
    lines, wrappers, marked = _lines(page, frozenset())
    if wrappers:
        lines, _, marked = _lines(page, wrappers)
    return lines if lines or marked else _lines(page, None)[0]


def _lines(page: str, wrappers: frozenset[int] | None) -> tuple[list[tuple[str, int, int]], frozenset[int], bool]:
    """The lines, where the regions begin that hold most of the text, and whether the page marks an article.

    Elements that begin at `wrappers` are no regions; none is if that is None.
    """
    lines: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked = 0
    # Open elements with the state outside them: boilerplate kind, in an article, in a link.
    stack: list[tuple[str, int, int, int]] = []
    # In a link: 1, in a heading: 0 whatever is linked there.
    kind, inside, link, articles = 0, 0, 0, 1
    # Regions as [begin, characters in it (before it, while it is open), whether in the article]; open ones with their place in the stack.
    regions: list[list[int]] = []
    opened: list[tuple[int, list[int]]] = []
    total, marked = 0, False
    unclosed: set[str] = set()

    def text(raw: str) -> None:
        nonlocal linked, total
        total += sum(map(len, raw.split()))
        if raw and not kind:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            linked += sum(map(len, raw.split())) if link > 0 else 0

    def flush() -> None:
        nonlocal linked
        if parts:
            line = " ".join("".join(parts).split())
            if line:
                lines.append((line, linked, inside))
            parts.clear()
        linked = 0

    def close(index: int) -> None:
        nonlocal kind, inside, link
        _, kind, inside, link = stack[index]
        del stack[index:]
        while opened and opened[-1][0] >= index:
            last = opened.pop()[1]
            last[1] = total - last[1]

    at, end = 0, len(page)
    while at < end:
        tag = TAG.search(page, at)
        if not tag:
            text(page[at:])
            break
        text(page[at : tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            if tag[0].startswith("<![CDATA["):
                text(tag[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        block = name in BLOCKS
        if block:
            flush()
        if tag["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if not block and stack[i][0] in BLOCKS:
                    break
            continue
        if name in RAW:
            if (not tag["attributes"].endswith("/") or name in ENDLESS) and name not in unclosed:
                over = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = over.end() if over else end if name in ENDLESS else at
                unclosed |= set() if over else {name}
            continue
        if name in VOID:
            continue
        for closed in ("p",) if name in CLOSES_PARAGRAPH else ():
            _close_open(stack, closed, close)
        if name in SIBLINGS:
            for closed in SIBLINGS[name]:
                _close_open(stack, closed, close)
        own, article = region(name, tag["attributes"], inside)
        if own and (wrappers is None or tag.start() in wrappers):
            own, article = 0, MARKS.get(name, 0)
        if own:
            regions.append([tag.start(), total, inside])
            opened.append((len(stack), regions[-1]))
        stack.append((name, kind, inside, link))
        if article and kind < 2:
            if article > 1 and inside < 2:
                articles += 1
                inside = articles
            kind, inside, marked = 0, max(inside, 1), True
        kind = max(kind, own)
        link = -1 if name in HEADINGS else link or int(name == "a")
    flush()
    if stack:
        close(0)
    return lines, frozenset(at for at, n, within in regions if 2 * n > total and (within > 0 or not marked)), marked


def _close_open(stack: list, name: str, close) -> None:
    """Ends an open element that no block has been opened in since."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            close(i)
            return
        if stack[i][0] in BLOCKS:
            return


def runs(lengths: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """[first, stop) of the lines between each surge and its dive, judged by the sums over windows of lines."""
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    found, start, risen = [], None, False
    for i, s in enumerate([*sums, 0]):
        if start is None and i < len(lengths) and lengths[i]:
            start, risen = i, False
        if start is not None:
            risen = risen or s >= surge
            if not s:
                if risen:
                    found.append((start, i))
                start = None
    return found


def weights(lines: list[tuple[str, int, int]]) -> list[int]:
    """The length of every line for the windows. Lines are lists of links if most of them is linked and a line beside them is such too."""
    plain = [len(t) - t.count(" ") for t, *_ in lines]
    links = [2 * linked > n for (_, linked, _), n in zip(lines, plain, strict=True)]
    listed = [x and (i > 0 and links[i - 1] or i + 1 < len(links) and links[i + 1]) for i, x in enumerate(links)]
    own = [n - linked if link and in_list else n for (_, linked, _), n, link, in_list in zip(lines, plain, links, listed, strict=True)]
    if not any(article for *_, article in lines):
        return [max(0, n - linked) for (_, linked, _), n in zip(lines, plain, strict=True)]
    sums: dict[int, int] = {}
    for (*_, article), n in zip(lines, own, strict=True):
        sums[article] = sums.get(article, 0) + n * (article > 0)
    largest = max(sums.values())
    return [n if article and 2 * sums[article] >= largest else 0 for (*_, article), n in zip(lines, own, strict=True)]


def main_text(page: str | None) -> str:
    """The text of the page's article, its blocks joined by one space."""
    lines = lines_of(page or "")
    marked = any(article for *_, article in lines)
    lengths = weights(lines)
    chosen = {article for (*_, article), n in zip(lines, lengths, strict=True) if n}
    kept = runs(lengths, 1 if marked else SURGE)
    if not kept and any(lengths):
        kept = [max(runs(lengths, 1), key=lambda r: sum(lengths[r[0] : r[1]]))]
    return " ".join(t for a, b in kept for (t, _, article) in lines[a:b] if article in chosen or not marked)


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points) of every page."""
    rows = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url}`").alias("url"), text_of(markup).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch["text"]]
            made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["url"], *made], ["id", "url", "text", "n_chars"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema]
    out = rows.mapInArrow(read, ", ".join([*kinds, "n_chars long"]))
    return out.select(F.col("id").alias(id_column), F.col("url").alias(url), "text", "n_chars")
