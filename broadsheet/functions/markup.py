"""Per-page helper of the extraction UDF: a flat element table and the selector subset it answers.

Elements are numbered in document order, so the descendants of ``e`` are ``e + 1 .. end[e] - 1`` and
every selector step is one linear pass. Recovery from broken markup is limited to implied end tags.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from html import unescape

# Fixed values, from the HTML standard: elements without content, raw text elements, elements whose
# strings do not count as text of their ancestors, start tags that end an open element (and the
# elements that stop the search for it), and inline elements that an implied </p> may close.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset({"script", "style"})
OWN_TEXT = frozenset({"script", "style", "template", "rt", "rp"})
INLINE = frozenset("a abbr b big cite code em font i label q s small span strike strong sub sup tt u".split())
P_CLOSERS = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"body"}),
}
# An end tag cannot close its way through an open element of higher rank.
END_RANK = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180,
    "table": 190, "head": 200, "body": 200, "html": 220,
}
LOWEST_RANK = 100

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=(?:\s*(?:\"[^\"]*\"|'[^']*'))?+)*+)>"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_PLAIN = re.compile(r"[^<]+|<")
_PLAIN_TOKEN = re.compile(r"(?P<close>)(?P<name>)(?P<attrs>)(?P<text><)")
_BEGUN = re.compile(r"</?[a-zA-Z][^\s/>]*")
_BLANK = re.compile(r"\s*")
_ATTR = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW_TEXT}


class TagEnds:
    """Whether a tag that begins somewhere ends at all, that is at a ">" outside its quoted values.

    Where a value is quoted from depends on where the tag began, so quotes out of step can hide every ">" from some tags
    and not from others. Each "=" leads to the same next one whatever tag it is read for, so its answer is kept, and a page
    full of tags that never end is read in linear time.
    """

    def __init__(self, html: str):
        self.stops = [m.start() for m in re.finditer("[>=]", html)]
        self.html, self.known = html, {}
        self.quotes = {q: [m.start() for m in re.finditer(q, html)] for q in "\"'"}

    def found(self, at: int) -> bool:
        passed, answer = [], False
        i = bisect_left(self.stops, at)
        while i < len(self.stops):
            if self.html[self.stops[i]] == ">":
                answer = True
                break
            if i in self.known:
                answer = self.known[i]
                break
            passed.append(i)
            i = self._after(i)
        self.known.update(dict.fromkeys(passed, answer))
        return answer

    def _after(self, i: int) -> int:
        """The next stop after an "=" and the quoted value behind it, if there is one."""
        at = _BLANK.match(self.html, self.stops[i] + 1).end()
        quotes = self.quotes.get(self.html[at : at + 1], ())
        close = bisect_left(quotes, at + 1)
        return bisect_left(self.stops, quotes[close] + 1) if close < len(quotes) else i + 1


class Page:
    def __init__(self, html: str):
        self.tag: list[str] = []
        self.raw_attrs: list[str] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.texts: list[str] = []
        self.text_owner: list[int] = []
        self.text_kind: list[str] = []
        self.text_from: list[int] = []
        self.text_to: list[int] = []
        self.removed: set[int] = set()
        self._attrs: dict[int, dict[str, str]] = {}
        self._found: dict[str, list[int]] = {}
        self._by_tag: dict[str, list[int]] = {}
        self._open: dict[str, int] = {}
        self._places: dict[int, tuple[int, int]] | None = None
        self._build(html)

    def _build(self, html: str) -> None:
        open_elements: list[int] = []
        kinds: list[str] = [""]
        at, size = 0, len(html)
        last_end, ends = html.rfind(">"), None
        while at < size:
            begun = ends is not None and _BEGUN.match(html, at)
            # a tag without an end is text, which the pattern would find out by reading to the end of the page
            token = _PLAIN_TOKEN.match(html, at) if begun and not ends.found(begun.end()) else _TOKEN.match(html, at)
            if ends is None and token["text"] == "<" and _BEGUN.match(html, at):
                ends = TagEnds(html)
            if at > last_end:
                # no tag can end any more: each further "<" would be looked through to the end of the page
                for piece in _PLAIN.findall(html[at:].partition("<!--")[0]):
                    self._text(piece, open_elements, kinds[-1])
                break
            at = token.end()
            if token["text"] is not None:
                self._text(token["text"], open_elements, kinds[-1])
                continue
            if token["name"] is None:
                continue
            name = token["name"].lower()
            if token["close"]:
                rank = END_RANK.get(name, LOWEST_RANK)
                self._close(open_elements, kinds, {name}, lambda x: END_RANK.get(x, LOWEST_RANK) > rank)
                continue
            if name in IMPLIED_END:
                ended, stops = IMPLIED_END[name]
                self._close(open_elements, kinds, ended, stops.__contains__)
            elif name in P_CLOSERS:
                self._close(open_elements, kinds, {"p"}, lambda x: x not in INLINE)
            element = len(self.tag)
            self.tag.append(name)
            self._by_tag.setdefault(name, []).append(element)
            self.raw_attrs.append(token["attrs"])
            self.parent.append(open_elements[-1] if open_elements else -1)
            self.end.append(element + 1)
            self.text_from.append(len(self.texts))
            self.text_to.append(len(self.texts))
            if name in VOID:
                continue
            open_elements.append(element)
            self._open[name] = self._open.get(name, 0) + 1
            if name in OWN_TEXT:
                kinds.append(name)
            if name in RAW_TEXT:
                stop = _RAW_END[name].search(html, at)
                stop = stop.start() if stop else size
                self._text(html[at:stop], open_elements, name, raw=True)
                at = stop
        self._close_to(open_elements, kinds, 0)

    def _text(self, text: str, open_elements: list[int], kind: str, raw: bool = False) -> None:
        text = (text if raw or "&" not in text else unescape(text)).strip()
        if text:
            self.texts.append(text)
            self.text_owner.append(open_elements[-1] if open_elements else -1)
            self.text_kind.append(kind)

    def _close(self, open_elements, kinds, names, is_barrier) -> None:
        """End the nearest open element among ``names``, unless a barrier comes first."""
        if not any(self._open.get(name) for name in names):
            return
        for depth in range(len(open_elements) - 1, -1, -1):
            name = self.tag[open_elements[depth]]
            if name in names:
                self._close_to(open_elements, kinds, depth)
                return
            if is_barrier(name):
                return

    def _close_to(self, open_elements: list[int], kinds: list[str], depth: int) -> None:
        for element in open_elements[depth:]:
            self.end[element] = len(self.tag)
            self._open[self.tag[element]] -= 1
            self.text_to[element] = len(self.texts)
            if self.tag[element] in OWN_TEXT:
                kinds.pop()
        del open_elements[depth:]

    def attrs(self, element: int) -> dict[str, str]:
        found = self._attrs.get(element)
        if found is None:
            found = {}
            for name, *values in _ATTR.findall(self.raw_attrs[element]):
                found.setdefault(name.lower(), unescape(next(filter(None, values), "")))
            self._attrs[element] = found
        return found

    def classes(self, element: int) -> list[str]:
        return self.attrs(element).get("class", "").split()

    def text(self, element: int) -> str:
        kind = self.tag[element] if self.tag[element] in OWN_TEXT else ""
        parts = [
            self.texts[i]
            for i in range(self.text_from[element], self.text_to[element])
            if self.text_kind[i] == kind and self.text_owner[i] not in self.removed
        ]
        return " ".join(" ".join(parts).split())

    def select(self, scope: int | None, selector: str) -> list[int]:
        """Matches below ``scope`` (the whole page when None), in document order."""
        found = self._found.get(selector)
        if found is None:
            found = self._found[selector] = self._evaluate(selector)
        if scope is not None:
            found = found[bisect_left(found, scope + 1) : bisect_left(found, self.end[scope])]
        return [e for e in found if e not in self.removed] if self.removed else found

    def remove(self, scope: int | None, selector: str) -> None:
        before = len(self.removed)
        for element in self.select(scope, selector):
            self.removed.update(range(element, self.end[element]))
        if len(self.removed) > before:
            # Only sibling-dependent selectors can match anew once elements are gone.
            self._found = {s: f for s, f in self._found.items() if not sibling_dependent(s)}
            self._places = None

    def _evaluate(self, selector: str) -> list[int]:
        matched: set[int] = set()
        for steps in parse_selector(selector):
            reached: list[int] = []
            for combinator, compound in steps:
                candidates = [e for e in self._candidates(compound) if self._matches(e, compound)]
                reached = self._related(reached, combinator, candidates)
            matched.update(reached)
        return sorted(matched)

    def _candidates(self, compound: tuple) -> list[int]:
        for kind, name, _ in compound:
            if kind == "tag":
                return self._by_tag.get(name, [])
        for kind, name, _ in compound:
            if kind == "class":
                return [e for e, raw in enumerate(self.raw_attrs) if name in raw or "&" in raw]
        return list(range(len(self.tag)))

    def _related(self, previous: list[int], combinator: str, candidates: list[int]) -> list[int]:
        if combinator == "":
            return candidates
        if combinator == ">":
            parents = set(previous)
            return [e for e in candidates if self.parent[e] in parents]
        if combinator == "+":
            siblings = set(previous)
            return [e for e in candidates if self._place(e)[1] in siblings]
        if combinator == "~":
            first: dict[int, int] = {}
            for e in previous:
                first.setdefault(self.parent[e], e)
            return [e for e in candidates if first.get(self.parent[e], e) < e]
        below, spans, inside_until = [], iter(previous), -1
        span = next(spans, None)
        for e in candidates:
            while span is not None and span < e:
                inside_until = max(inside_until, self.end[span])
                span = next(spans, None)
            if e < inside_until:
                below.append(e)
        return below

    def _place(self, element: int) -> tuple[int, int]:
        """Position among the remaining siblings, and the sibling before."""
        if self._places is None:
            last: dict[int, tuple[int, int]] = {}
            self._places = {}
            for e, parent in enumerate(self.parent):
                if e not in self.removed:
                    position, before = last.get(parent, (0, -1))
                    self._places[e] = (position + 1, before)
                    last[parent] = (position + 1, e)
        return self._places[element]

    def _matches(self, element: int, compound: tuple) -> bool:
        if element in self.removed:
            return False
        for kind, name, value in compound:
            if kind == "tag":
                ok = self.tag[element] == name
            elif kind == "class":
                ok = name in self.classes(element)
            elif kind == "nth":
                ok = self._place(element)[0] == value
            else:
                found = self.attrs(element).get(name)
                ok = found is not None and (value is None or found == value)
            if not ok:
                return False
        return True


_PART = re.compile(
    r"\s*(?P<combinator>[>+~])\s*|(?P<comma>\s*,\s*)|(?P<space>\s+)|(?P<any>\*)"
    r"|\.(?P<cls>[-\w]+)|\#(?P<id>[-\w]+)|:nth-child\(\s*(?P<nth>\d+)\s*\)"
    r"|\[\s*(?P<attr>[-\w]+)\s*(?:=\s*(?:\"(?P<q2>[^\"]*)\"|'(?P<q1>[^']*)'|(?P<bare>[-\w]+))\s*)?\]"
    r"|(?P<tag>[a-zA-Z][-\w]*)"
)


def sibling_dependent(selector: str) -> bool:
    return any(mark in selector for mark in ("+", "~", ":nth-child"))


@lru_cache(maxsize=4096)
def parse_selector(selector: str) -> tuple:
    """Alternatives, each a tuple of (combinator, compound) steps. Unsupported syntax raises ValueError."""
    alternatives: list[list] = [[("", [])]]
    at, text = 0, selector.strip()
    while at < len(text):
        part = _PART.match(text, at)
        if part is None:
            raise ValueError(f"unsupported selector {selector!r} at {text[at:]!r}")
        at = part.end()
        steps = alternatives[-1]
        compound = steps[-1][1]
        if part["comma"]:
            alternatives.append([("", [])])
        elif part["combinator"] or part["space"]:
            steps.append((part["combinator"] or " ", []))
        elif part["any"]:
            compound.append(("any", None, None))
        elif part["cls"]:
            compound.append(("class", part["cls"], None))
        elif part["id"]:
            compound.append(("attr", "id", part["id"]))
        elif part["nth"]:
            compound.append(("nth", None, int(part["nth"])))
        elif part["attr"]:
            values = [v for v in (part["q2"], part["q1"], part["bare"]) if v is not None]
            compound.append(("attr", part["attr"].lower(), values[0] if values else None))
        else:
            compound.append(("tag", part["tag"].lower(), None))
    if any(not compound for steps in alternatives for _, compound in steps):
        raise ValueError(f"incomplete selector {selector!r}")
    return tuple(
        tuple((c, tuple(x for x in compound if x[0] != "any")) for c, compound in steps) for steps in alternatives
    )
