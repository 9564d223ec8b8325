"""Main text of a page by line-block distribution.

Markup is stripped into lines (one per block element).  A line weighs its text
outside links; lines inside menus, headers, footers, sidebars, notices,
adverts, forms and reader comments weigh nothing and never enter the result.
The weights are summed over sliding windows of lines; the text body is the
stretch between a surge (a window sum rises above zero) and the next dive (it
falls back to zero) that holds most text.  Elements that hold nothing but media
(figures) are no lines, so they end nothing.  Where that stretch lies inside an ``article`` or ``main`` element, surge and dive are moved to the
first and last line of all such elements, so short first and last paragraphs and
further articles stay.  Inside them a class, id or role marks furniture only if
it starts with a telling word (``share-buttons``, not ``post-header`` or
``notice-period``).

Defined results: null or empty html gives the empty string; a page cut off in
the middle of a tag, comment or script loses only that unfinished piece;
repeated rows are extracted one by one; nulls in page_id or url pass through;
other columns are ignored.  Nothing is shortened.
"""

from __future__ import annotations

import html as _html
import re

from pyspark.sql import DataFrame

from orderlens.llm.common import map_text

WINDOW = 3

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKENS = re.compile(r"[a-z]+")

# HTML element kinds.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "object", "svg",
       "canvas", "audio", "video", "select", "head"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
          "math", "mi", "mn", "mo", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup",
          "semantics"}
MEDIA = {"img", "picture", "source", "svg", "video", "audio", "canvas", "iframe", "object", "embed"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
BODY = {"article", "main"}
NEVER = {"html", "body", "article", "main"}
#: words of class, id or role that mark page furniture
FURNITURE = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor",
             "sponsored", "promo", "promotion", "banner", "sidebar", "comment", "comments", "disqus",
             "reply", "replies", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
             "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
             "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
             "social", "related", "recommended", "recommendations", "footer", "header", "masthead",
             "search", "pagination", "pager", "toolbar", "widget", "copyright", "complementary",
             "contentinfo", "dialog"}


#: furniture words that an article may use for parts of its own
OWN = {"header", "footer", "notice", "notices", "alert", "search", "widget", "banner", "menu", "dialog", "modal",
       "login", "copyright", "promo", "promotion", "toolbar", "subscription"}
NAMES = re.compile(r"[^\s]+")


def _furniture(name: str, attrs: str, inside_body: bool) -> bool:
    if name in ASIDE:
        return not (name == "header" and inside_body)   # an article's own header holds its title
    if name in NEVER or not attrs:
        return False
    values = [(a or b or c).lower() for _, a, b, c in ATTR.findall(attrs)]
    if inside_body:
        firsts = (TOKENS.match(x) for v in values for x in NAMES.findall(v))
        return any(m and m.group(0) in FURNITURE - OWN for m in firsts)
    return any(not FURNITURE.isdisjoint(TOKENS.findall(v)) for v in values)


def lines_of(page: str) -> list[tuple[str, int, bool, int]]:
    """(text, weight, furniture, number of the body element or 0) per block, in page order."""
    out, parts = [], []
    # (element, inside furniture, body element, lines and media before it)
    stack: list[tuple[str, bool, int, int, int]] = []
    off, body, bodies, links, plain = False, 0, 0, 0, 0
    media, quiet = 0, False           # media elements so far; whether only media came since the last line

    def flush():
        nonlocal plain, quiet
        text = " ".join(_html.unescape("".join(parts)).split())
        if text or parts and not quiet:
            out.append((text, 0 if off else min(plain, len(text)), off, body))
            quiet = False
        parts.clear()
        plain = 0

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            chunk = page[at:stop]
            parts.append(chunk)
            if not links:
                plain += len(chunk)
        if not m:
            break
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing = bool(m.group(1) or m.group(4))
        attrs = m.group(3) or m.group(6) or ""
        media += name in MEDIA and not closing
        if not closing and name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            flush() if name == "head" else None
            continue
        if name == "a":
            links = 0 if closing else 1
        if name in INLINE:
            if name == "span" or name == "label":
                if closing:
                    if any(x[0] == name for x in stack):
                        if off:
                            flush()
                        while stack.pop()[0] != name:
                            pass
                        off, body = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
                else:
                    hide = off or _furniture(name, attrs, bool(body))
                    if hide and not off:
                        flush()
                    stack.append((name, hide, body, -1, media))
                    off = hide
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            if any(x[0] == name for x in stack):
                while (top := stack.pop())[0] != name:
                    pass
                if top[3] == len(out):           # an empty element is an empty line, one with media none
                    if top[4] == media:
                        out.append(("", 0, off, body))
                    else:
                        quiet = True
        else:
            if stack and stack[-1][0] == "p":
                stack.pop()
            over = stack[-1] if stack else ("", False, 0, 0, 0)
            inner = over[2]
            if name in BODY and not inner:
                bodies += 1
                inner = bodies
            stack.append((name, over[1] or _furniture(name, attrs, bool(over[2])), inner, len(out), media))
        links = 0
        off, body = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
    flush()
    return out


def body_range(lines: list) -> tuple[int, int]:
    """First and last + 1 line of the text body."""
    weights = [w for _, w, _, _ in lines]
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    best, most, i = (0, 0), 0, 0
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        j = i                                   # surge at i; dive where the window sum is zero
        while j < len(sums) and sums[j]:
            j += 1
        total = sum(weights[i:j])
        if total > most:
            best, most = (i, j), total
        i = j
    s, e = best
    while s < e and not weights[s]:
        s += 1
    # link lists only: everything that is not furniture
    if not most:
        s, e = 0, len(lines)
    by_body: dict[int, int] = {}
    for _, w, _, b in lines[s:e]:
        by_body[b] = by_body.get(b, 0) + w
    inside = max((b for b in by_body if b), key=lambda b: (by_body[b], -b), default=0)
    if inside and (by_body[inside] or not most):
        own = [k for k, x in enumerate(lines) if x[3]]
        return own[0], own[-1] + 1
    return s, e


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = lines_of(page)
    s, e = body_range(lines)
    inside = {x[3] for x in lines[s:e] if x[3]}
    keep = [t for t, _, off, b in lines[s:e] if t and not off and (not inside or b)]
    return " ".join(keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    def start():
        def f(texts):
            got = [main_text(t) for t in texts]
            return [got, [len(t) for t in got]]
        return f
    return map_text(pages, ["page_id", "url"], "html", start, [("text", "string"), ("n_chars", "long")])
