"""Pages as sequences of leaf blocks: a block is a run of text between block-level tags, with the path of open elements."""

from __future__ import annotations

import re
from html import unescape

#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not shown as text.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
#: A start tag of the key closes an open element of the values, up to the barrier.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
#: The rest of a tag; a failing match means that the page ends inside the tag, so it happens once at most.
_REST = re.compile(r"""(?>[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*+>""")
_ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """What the labeller sees of an element: its tag and the parts of its class, id and role."""
    out = [tag]
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        out += ["@" + part.lower() for part in _PARTS.findall(value)] if kind != "hidden" else ["@hidden"]
    return tuple(dict.fromkeys(out))


def leaf_blocks(html: str) -> list[Block]:
    """The blocks of a page in order, in time linear in its length; references decoded, white space collapsed."""
    blocks: list[Block] = []
    names: list[str] = []  # open block elements
    path: tuple = ()
    paths: list[tuple] = []
    pieces: list[str] = []
    linked = 0
    in_link = False
    raw_missing: set[str] = set()
    lower = None
    n, i = len(html), 0

    def close_block() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(text, path, min(linked, len(text))))
            pieces, linked = [], 0

    def pop_to(depth: int) -> None:
        nonlocal path
        path = paths[depth]
        del names[depth:], paths[depth:]

    while i < n:
        at = html.find("<", i)
        if at < 0:
            pieces.append(html[i:])
            break
        if at > i:
            pieces.append(html[i:at])
            if in_link:
                linked += at - i
        head = _NAME.match(html, at + 1)
        if not head:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 2)
                i = n if end < 0 else end + 3
            elif html.startswith(("<!", "<?", "</"), at):
                end = html.find(">", at)
                i = n if end < 0 else end + 1
            else:
                pieces.append("<")
                i = at + 1
            continue
        rest = _REST.match(html, head.end())
        if not rest:
            break  # the page ends inside a tag
        tag, closing = head[1].lower(), html[at + 1] == "/"
        i = rest.end()
        if tag in RAW and not closing:
            if tag not in raw_missing:
                lower = html.lower() if lower is None else lower
                end = lower.find("</" + tag, i) if len(lower) == n else html.find("</" + tag, i)
                if end >= 0:
                    i = end
                    continue
            raw_missing.add(tag)
            i = n
            continue
        if tag == "a":
            in_link = not closing
        if tag in INLINE:
            if tag in ("br", "img", "input", "wbr"):
                pieces.append(" ")
            continue
        close_block()
        if closing:
            if tag in names:
                pop_to(len(names) - 1 - names[::-1].index(tag))
            continue
        if tag in VOID:
            continue
        ends, barrier = CLOSES.get(tag, (None, None))
        if ends is None and names and names[-1] == "p":
            pop_to(len(names) - 1)
        elif ends is not None:
            for depth in range(len(names) - 1, max(-1, len(names) - 12), -1):
                if names[depth] in barrier:
                    break
                if names[depth] in ends:
                    pop_to(depth)
                    break
        names.append(tag)
        paths.append(path)
        if not html.startswith("/>", rest.end() - 2) or tag not in ("svg", "path", "use"):
            path = (path, _marks(tag, html[head.end() : rest.end() - 1]))
    close_block()
    return blocks


def path_marks(path: tuple) -> list[tuple[str, ...]]:
    """The marks of a path's elements, innermost first."""
    out = []
    while path:
        path, marks = path
        out.append(marks)
    return out
