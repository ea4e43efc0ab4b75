"""Raw HTML to its leaf blocks: runs of text between block-level tags, each with the names on its tag path.

Scripts, styles, comments and what browsers do not show are left out; inline tags do not cut a block, and
a line break is white space.  Broken markup is read as browsers mostly do: a paragraph ends where the next
block begins, an end tag without a beginning is passed over, a tag cut off at the end of the page is dropped.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

# Element names of HTML by how they are laid out.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("title template noscript datalist".split())
CLOSED_BY = {"p": None, "title": None, "h1": None, "h2": None, "h3": None, "h4": None, "h5": None, "h6": None,
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]{0,4096}+\"|'[^']{0,4096}+'){0,500}+|[^>]*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NEVER_ENDS = re.compile(r"<!--(?!.*-->\Z)|<(script|style)(?!.*</\1\s*>\Z)", re.S | re.I)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?][^<]*\Z")
PATH_NAMES = 4096


def name_id(name: str) -> int:
    """The bucket of a tag (``nav``), of a part of a class, id or role (``.menu``), or of a block's own tag (``leaf:p``)."""
    return zlib.crc32(name.encode()) % PATH_NAMES


@lru_cache(1 << 16)
def tag_ids(name: str, attrs: str) -> frozenset[int]:
    parts = [p.lower() for value in _NAMED.findall(attrs) for p in _PART.findall(value)]
    return frozenset(map(name_id, [name, *("." + p for p in parts[:16])]))


class Leaf(NamedTuple):
    path: frozenset[int]  # the buckets of all names on the path; each element shares its parent's set where it adds nothing
    own: int
    text: str
    linked: int  # code points within links


def leaf_blocks(page: str) -> list[Leaf]:
    out: list[Leaf] = []
    stack: list[tuple[str, frozenset[int]]] = [("", frozenset())]
    open_names: Counter[str] = Counter()
    held: list[str] = []
    linked, in_link, unseen = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                name, path = stack[-1]
                out.append(Leaf(path, name_id("leaf:" + name), text, min(linked, len(text))))
        linked = 0

    def pop() -> str:
        nonlocal unseen
        name = stack.pop()[0]
        open_names[name] -= 1
        unseen -= name in UNSEEN
        return name

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not unseen:
            piece = html.unescape(piece) if "&" in piece else piece
            held.append(piece)
            linked += len(piece) if in_link else 0

    whole = page.rfind(">") + 1
    done = 0
    for found in _MARKUP.finditer(page, 0, whole):
        text(page[done : found.start()])
        done = found.end()
        name = found["name"]
        if name is None:
            if done == whole and _NEVER_ENDS.match(page, found.start(), whole):
                done = len(page)
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = 0 if found["end"] else 1
            elif name == "br":
                held.append(" ")
            continue
        flush()
        if found["end"]:
            if open_names[name] > 0:
                while pop() != name:
                    pass
            continue
        while len(stack) > 1 and stack[-1][0] in CLOSED_BY and ((by := CLOSED_BY[stack[-1][0]]) is None or name in by):
            pop()
        if name in VOID:
            continue
        above = stack[-1][1]
        ids = tag_ids(name, found["attrs"])
        stack.append((name, above if ids <= above else above | ids))
        open_names[name] += 1
        unseen += name in UNSEEN
    text(_CUT_OFF.sub("", page[done:]) if done < len(page) else "")
    flush()
    return out
