"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element, in page order.  A line's
length is its text length; lines that markup already marks as something else
(menus, page headers and footers, sidebars, forms, scripts, adverts, notices,
reader comments, by element or by class, id and role words; lists made of
links; and, on a page with an article or main element, everything outside it)
count as empty, and what is marked leaves no gap.  A word that only tells a state
(``has-sidebar``, ``comments-open``, ``alert-free``) marks nothing, and a word that is part of
a longer name (``layout-sidebar``) does not mark an element that holds more running text than all
that is left of a page without an article element (nested ones: ``NESTED`` deep).  Lengths are summed over windows of ``WINDOW`` lines: the text
surges where a window reaches ``SURGE`` characters and dives where a window
holds none.  Of the runs between a surge and its dive the one with most text is
the article; all of its lines are kept, whatever their length, also paragraphs
that are mostly links where text of the run stands before and after them.

Defined results: a null, empty or text-free page gives an empty string;
unclosed elements end with the page, or with the article they would swallow;
repeated rows are separate pages; an empty table gives no rows; other columns
are kept whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh_name, parts

WINDOW = 3
SURGE = 60
NESTED = 8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_BLOCKS = frozenset("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section
select summary table tbody tfoot thead tr ul""".split())
_SPACES = frozenset("br td th wbr".split()) - {"wbr"}
_SKIPPED = frozenset("nav footer aside form head menu dialog button select object".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CORE = frozenset(("article", "main"))
_LISTS = frozenset("ul ol dl".split())
_HINTS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disqus footer masthead menu modal nav navbar navigation newsletter notice pagination
popup promo promoted related respond share sharing sidebar social sponsor sponsored subscribe toolbar topbar widget
complementary contentinfo search alert""".split())
#: Beside a hint in one name, these tell a state of the page or article and not what an element is.
_STATES = frozenset("has no not with without free open opened closed off enabled disabled".split())


def _marks(tag: str, attrs: str, in_core: bool) -> int:
    """How an element is marked as something other than the article's text: 2 by its element or a name of its
    own, 1 by part of a name, 0 not at all."""
    if tag in _SKIPPED or (tag == "header" and not in_core):
        return 2
    if not attrs or tag in ("html", "body") or tag in _CORE:
        return 0
    found = 0
    for m in _NAMED.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = {w for w in re.split(r"[^a-z0-9]+", name) if w}
            if not words.isdisjoint(_HINTS) and words.isdisjoint(_STATES):
                found = max(found, 1 if len(words - _HINTS) else 2)
    return found


def _running(markup: str) -> int:
    """Characters of text outside links."""
    size = at = in_link = 0
    for m in _TOKEN.finditer(markup):
        if not in_link:
            size += len(html.unescape(markup[at:m.start()]).strip())
        at = m.end()
        if (m[3] or "").lower() == "a":
            in_link = m[2] != "/"
    return size + (0 if in_link else len(html.unescape(markup[at:]).strip()))


def page_lines(page: str, kept: frozenset[int] = frozenset()) -> tuple[list[tuple[str, int, bool, bool]], list[tuple[int, int]]]:
    """``(text, characters of it inside links, inside article or main, inside a list)`` per block, with an
    empty line in the place of every skipped element; and where the elements start and end that were skipped for
    part of a name.  ``kept``: starts of elements that are not skipped for that."""
    doubtful: list[tuple[int, int]] = []
    doubt = -1
    lines: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    linked = in_link = core = listed = 0
    skip_tag, skip_depth = "", 0

    def end_line() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append((text, min(linked, len(text)), core > 0, listed > 0))
            parts.clear()
        linked = 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not skip_depth:
            raw = page[at:m.start()]
            parts.append(raw)
            if in_link:
                linked += len(html.unescape(raw).strip())
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing, attrs = m[2] == "/", m[4]
        if skip_depth and not (tag in _CORE and not closing and not core):
            if tag == skip_tag and not attrs.endswith("/"):
                skip_depth += -1 if closing else 1
                if not skip_depth and doubt >= 0:
                    doubtful.append((doubt, m.start()))
            continue
        skip_depth = 0
        if tag in _BLOCKS or tag in _SKIPPED:
            end_line()
        elif tag in _SPACES:
            parts.append(" ")
        if tag in _CORE:
            core = max(0, core + (-1 if closing else 1))
        elif tag in _LISTS:
            listed = max(0, listed + (-1 if closing else 1))
        elif tag == "a":
            in_link = 0 if closing else 1
        mark = 0 if closing or tag in _VOID or attrs.endswith("/") else _marks(tag, attrs, core > 0)
        if mark == 2 or (mark and m.start() not in kept):
            end_line()
            lines.append(("", 0, core > 0, listed > 0))
            skip_tag, skip_depth = tag, 1
            doubt = m.start() if mark == 1 else -1
    if at < len(page) and not skip_depth:
        parts.append(re.sub(r"<[^>]*\Z", "", page[at:]))
    elif skip_depth and doubt >= 0:
        doubtful.append((doubt, len(page)))
    end_line()
    return lines, doubtful


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines, doubtful = page_lines(page)
    kept: set[int] = set()
    while doubtful and len(kept) < NESTED and not any(core for _, _, core, _ in lines):
        left = sum(len(text) - linked for text, linked, _, _ in lines)
        size, start = max((_running(page[a:b]), a) for a, b in doubtful)
        if size <= left:
            break
        kept.add(start)
        lines, doubtful = page_lines(page, frozenset(kept))
    has_core = any(core for _, _, core, _ in lines)
    # an article's own lines stand together; what is marked inside it leaves no gap
    lines = [x for x in lines if x[0] or (has_core and not x[2])]
    if has_core:
        size = [len(text) if core else 0 for text, _, core, _ in lines]
        surge = 1
    else:
        size = [0 if 2 * linked > len(text) else len(text) for text, linked, _, _ in lines]
        surge = SURGE
    n = len(lines)
    total = [0]
    for s in size:
        total.append(total[-1] + s)
    windows = [total[min(n, i + WINDOW)] - total[i] for i in range(n)]
    if surge > 1 and windows and max(windows) < surge:
        surge = 1           # a short page: its text is all there is
    best, best_size, start = (0, 0), 0, None
    for i in range(n + 1):
        if start is None:
            if i < n and windows[i] >= surge:
                start = i
                while start > 0 and size[start - 1]:
                    start -= 1
        elif i == n or windows[i] == 0:
            if total[i] - total[start] > best_size:
                best, best_size = (start, i), total[i] - total[start]
            start = None
    own = [i for i in range(*best) if size[i]]
    # between two lines of the text, a paragraph of links is its own; a list of links is not
    return "\n".join(lines[i][0] for i in (range(own[0], own[-1] + 1) if own else ())
                     if size[i] or not (has_core or lines[i][3]))


def extract(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` plus ``out``, the main text of every page."""
    out = fresh_name(pages, out)
    at = [c.lower() for c in pages.columns].index(html_column.lower())
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, at):
            texts = [main_text(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return pages.mapInArrow(run, schema)
