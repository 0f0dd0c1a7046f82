"""Main text of web pages by line-block distribution.

Markup is stripped first: block-level tags and line breaks cut the page into lines, inline
tags vanish, and elements that say what they are (navigation, headers, footers, asides,
forms, adverts, notices, comments, scripts, styles, hidden parts) count as lines without
text. Then the lengths of the lines are summed over windows of ``WINDOW`` lines. The
distribution surges where it comes out of zero and reaches ``SURGE`` characters (or its own
maximum, on pages with less) and dives where it is back at zero; the lines between are kept.
If the page marks its article (``article``, ``main``), lines outside of it have no weight.

End tags that HTML lets a page omit are put where HTML puts them, so a dropped element without
one ends at the start tag that closes it (the next paragraph, item, cell, the body) or at the
end tag of an element around it.

Pages are independent, so this is one map over the table. Each page is read whole.

Defined results: a null or empty page, or one without text, gives an empty text; broken or
cut-off markup is read as far as it goes; repeated rows give repeated results; an empty table
gives no rows; other columns pass through, but for ``text`` and ``n_chars``.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame

from .common import prepare

WINDOW = 3
SURGE = 86

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("head nav footer aside form button select label dialog template svg canvas audio video object menu "
                    "datalist option fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
# Class and id names, by their words.
NOISE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                  "notice popup modal overlay newsletter subscribe signup login menu nav navbar navigation breadcrumb breadcrumbs "
                  "sidebar widget widgets related recommended share sharing social footer header masthead toolbar comment comments "
                  "disqus reply replies respond pagination pager copyright".split())
PLACES = frozenset("site page main global top bottom left right primary secondary user reader cookie privacy social reading view "
                   "article post blog".split())
# What ends an open paragraph, what a head may hold, and how far out an end is looked for.
ENDS_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul xmp".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
SCOPE = ("html", "table", "td", "th", "caption", "object", "template", "applet", "marquee")
ITEM_SCOPE = (*SCOPE, *(ENDS_P - {"address", "dd", "div", "dt", "hr", "li", "p"}), "body", "button", "select", "datalist", "tr", "tbody", "thead", "tfoot")
TABLE_SCOPE = ("html", "table", "template")
TABLE_PARTS = frozenset("caption colgroup tbody thead tfoot tr td th".split())
_OWN_SLASH = re.compile(r"=\s*[^\s\"'][^\s]*/\Z")             # of an unquoted value: closes nothing
_COMMENT = frozenset("comment comments disqus reply replies respond".split())


def _attributes(text: str) -> dict:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)}


def _noisy(name: str) -> str | None:
    """The word that marks a class or id name as no part of the article."""
    words = [w for w in _WORD.split(_CAMEL.sub("-", name).lower()) if w]
    if not words:
        return None
    if words[0] in NOISE and words[0] not in ("header", "banner", "article", "main") or len(words) == 1 and words[0] in NOISE:
        return words[0]
    if words[-1] in NOISE and words[-2] in PLACES:
        return words[-1]
    return None


def _dropped(name: str, attrs: str, inside: bool) -> str | None:
    """Why an element is no part of the article, if it is not."""
    if name in DROPPED:
        return name
    if name == "header" and not inside:
        return name
    if not attrs.strip() or name in ("html", "body", "main"):
        return None
    a = _attributes(attrs)
    words = {w for key in ("class", "id") for n in a.get(key, "").split() if (w := _noisy(n))}
    if name == "article" or re.fullmatch("h[1-6]", name):
        words &= _COMMENT
    if words:
        return "comment" if words & _COMMENT else words.pop()
    if a.get("role", "").lower() in ROLES:
        return "role"
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "").lower()):
        return "hidden"
    return None


class _Open:
    """The elements that are open, each a list of its name, outermost first. Elements whose end
    tag is left out end where HTML ends them."""

    def __init__(self):
        self.stack: list = []
        self.at = defaultdict(list)                           # places of each name
        self.blocks: list[int] = []                           # places of elements that are not inline

    def last(self, names) -> int:
        return max((self.at[n][-1] for n in names if n in self.at and self.at[n]), default=-1)

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            if (element := self.stack.pop()) is not None:
                self.at[element[0]].pop()
                if element[0] not in INLINE:
                    self.blocks.pop()

    def _end_last(self, names, scope) -> None:
        place = self.last(names)
        if place >= 0 and place > self.last([n for n in scope if n not in names]):
            self.cut(place)

    def on_top(self, name: str) -> bool:
        return bool(self.stack) and self.stack[-1] is not None and self.stack[-1][0] == name

    def before(self, name: str) -> None:
        """End what a start tag ends."""
        if self.on_top("head") and name not in IN_HEAD:
            self.cut(len(self.stack) - 1)
        if name in ENDS_P and self.at["p"]:
            self._end_last(("p",), (*SCOPE, "button"))
        if name == "li":
            self._end_last(("li",), ITEM_SCOPE)
        elif name in ("dd", "dt"):
            self._end_last(("dd", "dt"), ITEM_SCOPE)
        elif name in ("option", "optgroup"):
            self._end_last(("option",), ITEM_SCOPE)
            if name == "optgroup":
                self._end_last(("optgroup",), ITEM_SCOPE)
        elif name in ("tr", "td", "th"):
            self._end_last(("caption", "colgroup"), TABLE_SCOPE)
            self._end_last(("tr",) if name == "tr" else ("td", "th"), TABLE_SCOPE if name == "tr" else (*TABLE_SCOPE, "tr"))
        elif name in TABLE_PARTS:
            table = self.last(("table",))
            if table > self.last(("template",)):
                self.cut(table + 1)
        elif name in HEADINGS and any(map(self.on_top, HEADINGS)):
            self.cut(len(self.stack) - 1)
        elif name == "button":
            self._end_last(("button",), SCOPE)
        elif name == "a":
            self.end("a")

    def start(self, name: str) -> list:
        element = [name]
        if not (name in ("html", "body", "form") and self.at[name]):   # a second one opens nothing
            self.at[name].append(len(self.stack))
            if name not in INLINE:
                self.blocks.append(len(self.stack))
            self.stack.append(element)
        return element

    def end(self, name: str) -> list | None:
        """End what an end tag ends; the element it belongs to, if any is open."""
        if name in ("body", "html") and self.on_top("head"):
            self.cut(len(self.stack) - 1)
        names = HEADINGS if name in HEADINGS else (name,)
        place = self.last(names)
        scope = TABLE_SCOPE if name in TABLE_PARTS or name == "table" else (*SCOPE, "button") if name == "p" else \
            (*SCOPE, "ul", "ol") if name == "li" else () if name in ("html", "body") else SCOPE
        if place < 0 or place < self.last([n for n in scope if n not in names]):
            return None
        element = self.stack[place]
        if name in INLINE and self.blocks and self.blocks[-1] > place:  # ends, but not the blocks inside
            self.at[name].pop()
            self.stack[place] = None
        else:
            self.cut(place)
        return element

    def holds(self, element: list, place: int) -> bool:
        return place < len(self.stack) and self.stack[place] is element


def lines_of(page: str) -> tuple[list[str], list[bool], bool]:
    """The page's lines of text, whether each lies in a marked article, and whether the page
    marks one. Dropped elements are empty lines."""
    lines: list[str] = []
    inside: list[bool] = []
    now: list[str] = []
    depth, marked = 0, False
    skip, why, place = None, None, 0
    opened = _Open()
    at = 0

    def flush(also_empty=False):
        text = " ".join(_html.unescape("".join(now)).split())
        now.clear()
        if text or also_empty:
            lines.append(text)
            inside.append(depth > 0)

    while True:
        m = _TOKEN.search(page, at)
        if opened.on_top("head") and page[at: m.start() if m else len(page)].strip():
            opened.cut(len(opened.stack) - 1)                 # text is no part of a head
            skip = None if skip is not None and not opened.holds(skip, place) else skip
        if skip is None:
            now.append(page[at: m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, closes = name.lower(), bool(m["close"] or m["close2"])
        if closes and name in ("script", "style"):
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        alone = name in VOID or attrs.endswith("/") and not _OWN_SLASH.search(attrs)
        element = None
        if closes:
            element = opened.end(name)
        else:
            opened.before(name)
            if not alone and name not in RAW:
                element = opened.start(name)
        if skip is not None and not opened.holds(skip, place):
            own, skip = element is skip, None                 # by its end tag, or by what ends it without one
            if own:
                continue
        if skip is not None and not closes and name in ("article", "main") and why not in ("comment", "aside", "hidden") and name != skip[0] \
                and not _dropped(name, attrs, False):
            skip = None                                       # an unclosed element ends where the article begins
        if name in RAW and not closes:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
            if name not in ("script", "style") and skip is None:
                flush()
            continue
        if skip is not None:
            continue
        if closes and name in ("article", "main"):
            flush()
            depth = max(0, depth - 1)
        elif not closes and not alone and (reason := _dropped(name, attrs, depth > 0)):
            flush()
            flush(also_empty=True)
            if opened.stack and opened.stack[-1] is element:
                skip, why, place = element, reason, len(opened.stack) - 1
        elif name not in INLINE:
            flush()
            if not closes and name in ("article", "main"):
                depth, marked = depth + 1, True
    flush()
    return lines, inside, marked and any(line and i for line, i in zip(lines, inside))


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    if not page:
        return ""
    lines, inside, marked = lines_of(page)
    if marked:                                                # what is dropped inside an article does not cut it
        keep = [bool(line) or not i for line, i in zip(lines, inside)]
        lines, inside = ([x for x, k in zip(v, keep) if k] for v in (lines, inside))
    length = np.array([len(line) if i or not marked else 0 for line, i in zip(lines, inside)] + [0] * (window - 1), np.int64)
    if not length.any():
        return ""
    block = np.convolve(length, np.ones(window, np.int64), "valid")
    wanted = min(surge, int(block.max()))
    edge = np.diff(np.concatenate([[0], (block > 0).astype(np.int8), [0]]))
    kept = []
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):   # out of zero, back at zero
        if block[a:b].max() >= wanted:
            kept += [lines[i] for i in range(a, b) if length[i]]
    return " ".join(kept)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without ``column``, with ``text`` and ``n_chars`` (its code points) added."""
    prepare(pages.sparkSession)
    kept = [f for f in pages.schema.fields if f.name not in (column, "text", "n_chars")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "text string, n_chars long"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(p) for p in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[f.name for f in kept] + ["text", "n_chars"])

    return pages.select(*[f.name for f in kept], column).mapInArrow(run, schema)
