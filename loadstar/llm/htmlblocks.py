"""Leaf blocks of an HTML page: the runs of text between block-level tags,
with the elements they stand in. One pass, whatever the page holds."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(
    r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Elements of the HTML standard by the part they play here.
VOID = set("area base br col embed hr img input link meta param source track "
           "wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i "
             "ins kbd mark q s samp small span strike strong sub sup time tt "
             "u var wbr img br".split())
SKIPPED = set("script style noscript template title svg math iframe object "
              "canvas audio video head textarea select".split())
RAW = set("script style textarea title noscript iframe".split())
SECTIONS = set("nav header footer aside form article main section dialog "
               "menu table figure blockquote".split())
# What an opening tag closes, and the elements that this does not reach
# beyond.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}),
          "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"table", "tr"}),
          "th": ({"td", "th"}, {"table", "tr"}),
          "option": ({"option"}, {"select"})}
# End tags that do not reach beyond these.
SCOPE = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"},
         "tr": {"table"}, "p": {"div", "article", "section", "body", "td",
                                "li", "blockquote", "aside", "main"}}
# Innermost open elements that a block's features look at.
DEPTH = 24


class Block(NamedTuple):
    text: str
    linked: int                       # characters of it inside links
    path: tuple[tuple[str, tuple[str, ...]], ...]   # (tag, names), outermost
    # first: class, id and role words of each open block-level element


def names(attrs: str, memo: dict[str, tuple]) -> tuple[tuple[str, ...], bool]:
    """Words of class, id, role and itemprop, and whether the element is
    hidden."""
    known = memo.get(attrs)
    if known is not None:
        return known
    words, hidden = [], False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role", "itemprop"):
            words += _NAME.findall(_CAMEL.sub(" ", value).lower())
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            hidden = True
        elif key == "style" and "display:none" in value.replace(
                " ", "").lower():
            hidden = True
    out = tuple(dict.fromkeys(words)), hidden
    if len(memo) >= 20_000:
        memo.clear()
    memo[attrs] = out
    return out


def blocks(html: str | None, memo: dict[str, tuple] | None = None
           ) -> list[Block]:
    """Blocks with text, in page order. Character references are decoded and
    white space within a block is one space; scripts, styles, comments, hidden
    and embedded elements have no text. Broken markup: an unclosed comment or
    script runs to the end, end tags without a start are ignored, an unclosed
    quote in a tag ends with the tag."""
    html, memo = html or "", {} if memo is None else memo
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    opened: Counter = Counter()
    text: list[str] = []
    linked, links, hidden = 0, 0, 0
    last_quote = {q: html.rfind(q) for q in "\"'"}
    lower = None

    def flush() -> None:
        nonlocal text, linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                out.append(Block(whole, min(linked, len(whole)), tuple(
                    e[:2] for e in stack[-DEPTH:])))
        text, linked = [], 0

    def close(n: int) -> None:
        nonlocal hidden
        for tag, _, hides in stack[n:]:
            opened[tag] -= 1
            hidden -= hides
        del stack[n:]

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            if not hidden:
                run = unescape(html[at:lt])
                text.append(run)
                if links:
                    linked += len(run)
            at = lt
            continue
        if html.startswith("<!--", at):
            to = html.find("-->", at + 4)
            at = end if to < 0 else to + 3
            continue
        if html[at + 1:at + 2] in ("!", "?"):
            to = html.find(">", at)
            at = end if to < 0 else to + 1
            continue
        m = (_TAG if at <= max(last_quote.values()) else _LOOSE).match(html, at)
        m = m or _LOOSE.match(html, at)
        if m is None:
            if html[at + 1:at + 2].isalpha() or html[at + 1:at + 2] == "/":
                break                          # a tag that the page cuts off
            if not hidden:
                text.append("<")
            at += 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE or tag in VOID:
                continue
            flush()
            if opened[tag]:
                stop = SCOPE.get(tag, ())
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if stack[k][0] in stop:
                        break
            continue
        if tag == "br":
            text.append(" ")
        if tag == "a":
            links += 1
        if tag in INLINE:
            continue
        flush()
        if tag in VOID:
            continue
        if opened["p"] and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if tag in CLOSES:
            shut, stop = CLOSES[tag]
            if any(opened[t] for t in shut):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in stop:
                        break
                    if stack[k][0] in shut:
                        close(k)
                        break
        if tag in ("body", "main", "article", "nav", "header", "footer"):
            links = 0                          # links that were never closed
        if tag == "body":
            close(0)
        words, hides = names(m[3], memo)
        hides = hides or tag in SKIPPED
        if m[3].endswith("/"):
            continue
        if tag in RAW:
            lower = lower if lower is not None else html.lower()
            to = lower.find("</" + tag, at) if len(lower) == end else -1
            if len(lower) != end:              # lower case changed lengths
                found = re.compile("</" + tag, re.I).search(html, at)
                to = found.start() if found else -1
            if to < 0:
                break
            to = html.find(">", to)
            at = end if to < 0 else to + 1
            continue
        stack.append((tag, words, hides))
        opened[tag] += 1
        hidden += hides
    flush()
    return out
