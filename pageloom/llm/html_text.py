"""Main text of a web page by the distribution of text over its lines.

Markup is stripped so that each block element gives one line.  A line weighs the length of its text; what stands in
menus, headers, footers, sidebars, notices, adverts, forms and comments, and what is mostly links outside an article
element, weighs nothing.  Weights are summed over sliding windows of LINES lines.  The text surges where the sum rises to
SURGE, and dives where a window sums to zero; the lines between a surge and its dive are the main text.  A title up to
TITLE lines before a surge belongs to it, with what stands between.

Article and main elements add to the weight: a line of one that is believed weighs WEIGHT more, so that no line of an article dives.
Where surges lie both in such an element and outside, the heavier side says what is trimmed: text outside that surges to
DOUBT times SURGE, and is more than DOUBT times as long as the largest article, makes the element a teaser, and main or
else the whole page is judged in its place; otherwise lines outside go, but for headings of main before its article.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

LINES, SURGE = 3, 120
#: What each line of an article or main element weighs beside its text.
WEIGHT = 2 * SURGE
#: Lines before a surge among which its title (an h1) is looked for.
TITLE = 5
#: How much higher, and how much longer, the text outside an article element is where the element is not the article.
DOUBT = 2
#: A line whose text is links to this part or more counts for nothing outside an article element.
LINK_SHARE = 0.5

# Element names of HTML, and words in class, id and role that tell what is not the article.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FORMS = frozenset("button datalist form label optgroup option select".split())
NEVER = FORMS | frozenset("aside dialog footer menu nav search".split())
OUTSIDE_ARTICLE = frozenset(["header"])
NOISE = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising alert announcement banner breadcrumb breadcrumbs bylinks captcha comment comments consent cookie cookies copyright disclaimer discussion disqus dropdown footer form forms gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion reaction reactions recommended recommendations related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription survey toolbar topbar widget widgets".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NOT_NOISE = frozenset("has with without no".split())
#: Words that say how an element is laid out and nothing of what it holds.  In an article a name makes an element noise
#: only if it has no other words (a section "related-work" is the article's own, a box "related-posts" is not).
LAYOUT = frozenset("area articles bar block body bottom box button buttons center col column container content el element footer group header holder icon icons inline inner item items js large left link links list main middle module page panel post posts right row section site slot small stories sub text the title top unit view wrap wrapper".split())
#: Words that begin or end with these are noise as well (commentlist, sitefooter).
NOISE_BEGINS, NOISE_ENDS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar"), ("banner", "comments", "footer", "menu", "nav", "sidebar")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A page's own header, where it is not an article's.
HEADERS, ARTICLES = frozenset("header pageheader siteheader topheader".split()), frozenset("article content entry post story title".split())
#: A line that says so is the page's, not the article's.
_RIGHTS = re.compile(r"^(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.I)

#: Elements whose content is not text, whole.
RAW = frozenset("script style noscript template iframe object svg math canvas textarea title audio video noframes noembed xmp".split())
#: A tag whose quoted values may hold >; one that ends at the first >, for pages whose quotes don't match.  Neither turns
#: back over what it has read, so that a broken page takes time in proportion to its length.
_QUOTED = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)>""")
#: What may begin a tag; any other < is text.
_BEGIN = re.compile(r"<(?=[a-zA-Z/!?])")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*+>", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: A paragraph ends where one of these begins.
_CLOSES_P = BLOCKS - {"li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}


def is_noise(name: str, attributes: str, in_article: bool, forms: bool = False) -> bool:
    """Whether an element holds something other than the article.  forms: those of the page hold its text."""
    if (name in NEVER and not (forms and name in FORMS)) or (name in OUTSIDE_ARTICLE and not in_article):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and name not in HEADINGS and name != "article":
            for part in value.split():
                tokens = {t.lower() for t in _TOKEN.findall(part)}
                if tokens & NOT_NOISE:
                    continue
                bad = {t for t in tokens if t in NOISE or t.startswith(NOISE_BEGINS) or t.endswith(NOISE_ENDS)}
                if bad and (not in_article or not tokens - bad - LAYOUT):
                    return True
                if tokens & HEADERS and not tokens & ARTICLES and not in_article and name[0] != "h":
                    return True
    return False


def tags(page: str) -> Iterator[tuple[str, str, str, str]]:
    """The text before each tag, whether it closes (/), its name and its attributes; at the end the rest, no name.

    Comments, declarations and elements whose content is no text count as white space.
    """
    at, text, pattern, n = 0, [], _QUOTED, len(page)
    while True:
        begin = _BEGIN.search(page, at)
        to = begin.start() if begin else n
        if not begin:
            yield "".join(text) + page[at:], "", "", ""
            return
        text.append(page[at:to])
        if page.startswith("<!--", to):
            end = page.find("-->", to + 4)
            at = n if end < 0 else end + 3
            text.append(" ")
        elif page.startswith("<![CDATA[", to):
            end = page.find("]]>", to)
            at = n if end < 0 else end + 3
            text.append(" ")
        elif page.startswith(("<!", "<?"), to):
            end = page.find(">", to)
            at = n if end < 0 else end + 1
            text.append(" ")
        elif (m := pattern.match(page, to)) or (pattern is _QUOTED and (m := _PLAIN.match(page, to))):
            if pattern is _QUOTED and m.re is _PLAIN:
                pattern = _PLAIN  # no tag from here on can be read with its quotes
            at, name = m.end(), m[2].lower()
            if name in RAW:
                if not m[1] and not m[3].endswith("/"):
                    end = _ENDS[name].search(page, at)
                    at = end.end() if end else n
                text.append(" ")
                continue
            yield "".join(text), m[1], name, m[3]
            text = []
        elif page.find(">", to) < 0:
            yield "".join(text), "", "", ""  # a tag that never ends
            return
        else:
            at = to + 1
            text.append("<")


def lines_of(page: str, forms: bool = False) -> list[tuple[str | None, int, int, int, str]]:
    """Of each line: its text; the length that counts; 2 in an article element, 1 in a main one, 3 in both, else 0; the
    number of the innermost of them; the name of the heading it is.  A line that is not the article's (noise) has the text None in place of its
    own."""
    out: list[tuple[str | None, int, int, int, str]] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, int, int]] = []  # element, noise, article, its number
    noise, article, number, elements, in_link = False, 0, 0, 0, False

    def flush() -> None:
        nonlocal linked
        if text:
            line = " ".join(references.unescape("".join(text)).split())
            text.clear()
            if line:
                heading = next((name for name, *_ in reversed(stack) if name in HEADINGS), "")
                out.append((None, 0, article, number, "") if noise or (not article and _RIGHTS.search(line)) else (line, 0 if linked >= LINK_SHARE * len(line) and not article & 2 else len(line), article, number, heading))
        linked = 0

    def pop(to: int) -> None:
        nonlocal noise, article, number
        del stack[to:]
        noise, article, number = stack[-1][1:] if stack else (False, 0, 0)

    for piece, closing, name, attributes in tags(page):
        if piece:
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not name:
            break
        if name == "a":
            in_link = not closing
            continue
        block = name in BLOCKS
        if name == "br":
            text.append(" ")
            continue
        if block:
            flush()
            in_link = False
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if not block and stack[k][1]:
                        flush()
                    pop(k)
                    break
            continue
        if name in VOID:
            continue
        if name in _CLOSES_P or name in ("li", "dd", "dt", "tr", "td", "th"):
            ends = ("p",) if name in _CLOSES_P else ("p", name, *{"dd": ("dt",), "dt": ("dd",), "tr": ("td", "th"), "td": ("th",), "th": ("td",)}.get(name, ()))
            while stack and stack[-1][0] in ends:
                pop(len(stack) - 1)
        bad = is_noise(name, attributes, bool(article), forms)
        if not block and not bad:
            continue  # bold and the like change nothing
        if bad and not noise:
            flush()
        rank = {"article": 2, "main": 1}.get(name, 0)
        new = bool(rank & ~article)
        elements += new
        stack.append((name, noise or bad, article | rank, elements if new else number))
        noise, article, number = stack[-1][1:]
        if name in ("article", "main") and not bad:
            out.append((None, 0, article, number, ""))
    flush()
    return out


def distribution(lengths: np.ndarray, lines: int = LINES) -> np.ndarray:
    """Sums over the windows that begin at each line; beyond the last line there is nothing."""
    sums = np.concatenate(([0], np.cumsum(lengths), np.full(lines, lengths.sum())))
    return sums[lines : lines + len(lengths)] - sums[: len(lengths)]


def surges_and_dives(lengths: np.ndarray, surge: float, lines: int = LINES) -> list[tuple[int, int]]:
    """Ranges of lines from where a window reaches surge (less the empty lines before) to where the windows dive to 0."""
    found, blocks, at = [], distribution(lengths, lines), 0
    while at < len(lengths):
        up = np.flatnonzero(blocks[at:] >= surge)
        if not len(up):
            break
        start = at + int(up[0])
        while start > at and lengths[start - 1]:
            start -= 1
        down = np.flatnonzero(blocks[start + 1 :] == 0)
        stop = start + 1 + int(down[0]) if len(down) else len(lengths)
        found.append((start, stop))
        at = stop + 1
    return found


def believed(counts: np.ndarray, ranks: np.ndarray, numbers: np.ndarray) -> int:
    """2 if the article elements hold the main text, 1 if the main ones do, 0 if the whole page does."""
    for level in (2, 1):
        inside = (ranks & level) > 0
        if not counts[inside].any():
            continue
        largest = np.bincount(numbers[inside], weights=counts[inside]).max() if level == 2 else counts[inside].sum()
        outside = np.where(inside, 0, counts)
        if sum(int(outside[a:b].sum()) for a, b in surges_and_dives(outside, DOUBT * SURGE)) <= DOUBT * largest:
            return level
    return 0


def titles_before(lines: list[tuple[str | None, int, int, int, str]]) -> list[int]:
    """Headings of the main element before its first article: all h1, and of the others those right before it."""
    first = next(i for i, (_, n, rank, *_) in enumerate(lines) if n and rank & 2)
    found, beside = [], True
    for i in range(first - 1, -1, -1):
        _, n, rank, _, heading = lines[i]
        if n and rank == 1 and (heading == "h1" or (heading and beside)):
            found.append(i)
        elif n:
            beside = False
    return found[::-1]


def with_title(start: int, least: int, lines: list[tuple[str | None, int, int, int, str]]) -> int:
    """Where a surge begins once an h1 a few lines before it is counted in."""
    for i in range(start - 1, max(least, start - 1 - TITLE) - 1, -1):
        if lines[i][4] == "h1" and lines[i][0]:
            return i
    return start


def extract(page: str | None) -> str:
    """The main text: lines joined by an empty one."""
    if not page:
        return ""
    lines = lines_of(page)
    if not any(line[1] for line in lines):
        lines = lines_of(page, forms=True)  # a page that is one form
    counts, ranks, numbers = (np.array([line[k] for line in lines], np.int64) for k in (1, 2, 3))
    if not counts.any():
        return ""
    level = believed(counts, ranks, numbers)
    weights = np.where((counts > 0) & (ranks & level > 0), counts + WEIGHT, counts)
    ranges = surges_and_dives(weights, SURGE) or surges_and_dives(weights, distribution(weights).max())
    kept = [lines[i][0] for i in titles_before(lines)] if level == 2 else []
    least = 0
    for a, b in ranges:
        a = a if level else with_title(a, least, lines)
        kept += [t for t, _, rank, *_ in lines[a:b] if t and (not level or rank & level)]
        least = b
    return "\n\n".join(kept)


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """row struct (pages' columns, or those in keep), text: the main text of each whole page, row by row, no shuffle.

    Null, empty and text-less pages give the empty text.  Unclosed elements end where their parents do, and a tag that
    never ends takes the rest of the page; a page of any length takes time in proportion to it.  Repeated rows give
    repeated results; an empty table none.  Other columns stand inside row, so that no name clashes.
    """
    keep = pages.columns if keep is None else keep
    picked = bounded_batches(pages).select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([extract(x) for x in part.column(1).to_pylist()], pa.string())], ["row", "text"])

    return picked.mapInArrow(run, f"row {picked.schema['row'].dataType.simpleString()}, text string")
