"""Main text of web pages by line-block distribution (operator 2).

Markup is stripped: scripts, styles, comments and elements that are no article by their name, role or
class go with all they hold, block elements end a line, and the boundary of a container leaves an empty
line. Each line counts its characters outside links. Sums over sliding windows of WINDOW lines are then
searched for surges (the sum reaches SURGE, or the page's largest sum where that is less) and dives (it
falls to zero); the lines from a surge to the next dive are kept. Where the page marks an article that holds
half of the characters outside links or more, the surge begins and ends with the mark.

Defined cases: null or empty html, and pages without text, give an empty text of 0 characters; elements left
open end with the element around them; unknown or broken character references stay as they are; repeated
rows each give a row; extra columns are left out unless named in `keep`; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame, SparkSession

from valuekit.llm.shared import map_batches, table

#: Lines of a sliding window, and the characters in it at which text begins.
WINDOW = 3
SURGE = 60
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|title|iframe|svg|object|canvas|select)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<]*\"|'[^'<]*'|[^>\"'])*+|[^>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
_HINTED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORDS = re.compile(r"[a-z]+")
CONTAINERS = frozenset("html body div section article main aside nav header footer form ul ol dl table tbody thead tfoot figure fieldset details dialog menu center".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote address figcaption caption hr legend summary hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("nav aside footer form button menu dialog head fieldset audio video".split())
ARTICLES = frozenset("article main".split())
#: Words of a class, id or role that mark what is not the article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar complementary "
    "footer contentinfo comment comments reply replies disqus respond cookie cookies consent gdpr newsletter subscribe signup login "
    "share sharing related recommended popup modal overlay pagination pager".split()
)
#: Words that do so unless a word of KEPT stands beside them, as in `post-header`.
WEAK_HINTS = frozenset("banner side header masthead notice notices notification alert search social dialog widget widgets skip".split())
KEPT = frozenset("article main content post entry story body".split())
#: Beginnings of layout classes that name a part which lies elsewhere, as in `with-sidebar`.
LAYOUT = frozenset("with has no without".split())


def _hinted(attributes: str) -> bool:
    for m in _HINTED.finditer(attributes):
        names = [_WORDS.findall(token) for token in (m[1] or m[2] or m[3] or "").lower().split()]
        words = {w for name in names if name and name[0] not in LAYOUT for w in name}
        if not words.isdisjoint(HINTS) or (not words.isdisjoint(WEAK_HINTS) and words.isdisjoint(KEPT)):
            return True
    return False


_BY_HINT = 2


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """Lines of a page: text, characters in links, and whether it lies in an article. Empty lines are gaps."""
    lines: list[tuple[str, int, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # name, skipped (by its name, by a hint), in an article
    skipped, inside, linked, link_from = 0, False, 0, None

    def flush() -> None:
        nonlocal linked, link_from
        text = " ".join(html.unescape("".join(held)).split())
        if link_from is not None:
            linked += sum(map(len, held[link_from:]))
            link_from = 0
        if text:
            lines.append((text, min(linked, len(text)), inside))
        held.clear()
        linked = 0

    at = 0
    for m in _TAG.finditer(page):
        if not skipped and m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name == "br":
            held.append(" ")
            continue
        if name == "a" and not skipped:
            if m[2]:
                if link_from is not None:
                    linked += sum(map(len, held[link_from:]))
                link_from = None
            else:
                link_from = len(held)
            continue
        if name in BLOCKS and not skipped:
            flush()
        if m[2]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
                skipped, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
                link_from = None if name in CONTAINERS else link_from
        elif name not in VOID and not m[4].endswith("/"):
            hinted = name not in ("html", "body") and bool(m[4]) and _hinted(m[4])
            if name in ARTICLES and not inside and skipped < _BY_HINT and all(n != "aside" for n, _, _ in stack):
                # An article ends a menu or the like that was left open.
                stack.append((name, _BY_HINT if hinted else 0, not hinted))
            elif name in CONTAINERS or name in SKIPPED or hinted:
                by_name = name in SKIPPED or (name == "header" and not inside)
                stack.append((name, max(skipped, _BY_HINT if hinted else int(by_name)), inside))
            else:
                continue
            skipped, inside = stack[-1][1], stack[-1][2]
        if name in CONTAINERS and lines and lines[-1][0]:
            lines.append(("", 0, inside))
    if not skipped:
        held.append(page[at:])
    flush()
    return lines


def kept_lines(lengths: list[int]) -> list[bool]:
    """Whether each line lies between a surge and the dive after it."""
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    least = min(SURGE, max(sums, default=0))
    kept = [False] * len(lengths)
    open_ = False
    for i, total in enumerate(sums):
        open_ = (total > 0 if open_ else total >= least) and least > 0
        kept[i] = open_
    return kept


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by line ends."""
    lines = page_lines(page or "")
    mass = [len(text) - linked for text, linked, _ in lines]
    # A mark counts where the page's text is; cards that carry it beside the story do not.
    if any(inside for _, _, inside in lines) and 2 * sum(n for n, line in zip(mass, lines) if line[2]) >= sum(mass):
        # All between the marks is one surge: short lines and links belong to it.
        lines = [line for line in lines if line[2]]
        kept = [True] * len(lines)
    else:
        kept = kept_lines(mass)
    return "\n".join(text for (text, _, _), k in zip(lines, kept) if k and text)


def extract_text(pages: DataFrame, markup: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per row of `pages`: the columns in `keep`, `text` and `n_chars`."""
    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep) + "text string, n_chars bigint"

    def extract(batch: dict[str, list]) -> dict[str, list]:
        texts = [main_text(page) for page in batch[markup]]
        return {c: batch[c] for c in keep} | {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select(*dict.fromkeys([*keep, markup])), extract, schema)


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html_blocks": op2_html_blocks}
ORACLE: dict[str, str] = {}
