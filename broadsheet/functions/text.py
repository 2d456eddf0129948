"""Text functions as native Spark columns; nothing here leaves the JVM."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters that Python's ``\s`` matches (Java's ``\s`` is ASCII only)
# and the separator placed between the parts of a content hash.
WHITESPACE = r"[\u0009-\u000d\u001c-\u0020\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
HASH_SEPARATOR = "␟"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_null(c: Column | str) -> Column:
    """Empty text counts as missing."""
    return F.nullif(_col(c), F.lit(""))


def or_default(c: Column | str, default: Column) -> Column:
    return F.coalesce(or_null(c), default)


def clean_text(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(_col(c), WHITESPACE, " ")), F.lit(""))


@lru_cache(maxsize=1)
def _ascii_folding() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition leaves ASCII: to one character, or to several."""
    source, target, longer = [], [], {}
    for point in range(0x80, 0x30000):
        char = chr(point)
        if unicodedata.decomposition(char):
            left = "".join(x for x in unicodedata.normalize("NFKD", char) if x < "\x80")
            if len(left) == 1:
                source.append(char)
                target.append(left)
            elif left:
                longer[char] = left
    return "".join(source), "".join(target), longer


def _ranges(chars: Iterable[str], gap: int = 64) -> str:
    """A short character class that covers the characters, and others in between."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point - ranges[-1][1] <= gap:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def slugify(c: Column | str) -> Column:
    """Fold to ASCII, lower-case, hyphenate everything but letters and digits; NULL becomes ''.

    Folding one character at a time is exact: decomposition only reorders combining marks, and those
    are dropped. ``translate`` does it for the characters that leave one letter; each distinct
    character that leaves several is replaced on its own. ASCII text skips all of it.
    """
    source, target, longer = _ascii_folding()
    text = _col(c)
    expansions = F.from_json(F.lit(json.dumps(longer)), "map<string,string>")
    occurring = F.array_distinct(F.regexp_extract_all(text, F.lit(_ranges(longer)), F.lit(0)))
    expanded = F.aggregate(
        occurring, text, lambda done, x: F.replace(done, x, F.coalesce(F.element_at(expansions, x), x))
    )
    folded = F.regexp_replace(F.translate(expanded, source, target), r"[^\x00-\x7F]+", "")
    ascii_text = F.when(text.rlike(r"[^\x00-\x7F]"), folded).otherwise(text)
    hyphenated = F.regexp_replace(F.lower(ascii_text), "[^a-z0-9]+", "-")
    return F.coalesce(F.trim(hyphenated, F.lit("-")), F.lit(""))


def content_hash(*parts: Column | str) -> Column:
    """SHA-256 over the parts; a missing part counts as '' but keeps its separator."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.coalesce(_col(p), F.lit("")) for p in parts]), 256)


def _quote(c: Column) -> Column:
    in_array = F.to_json(F.array(c))
    return F.substring(in_array, F.lit(2), F.length(in_array) - 2)


def metadata_json(c: Column | str) -> Column:
    """JSON text of a map of lists, single values unwrapped, ', ' and ': ' as separators."""

    def entry(e: Column) -> Column:
        values = F.transform(e["value"], _quote)
        many = F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]"))
        return F.concat(_quote(e["key"]), F.lit(": "), F.when(F.size(values) == 1, values[0]).otherwise(many))

    entries = F.array_join(F.transform(F.map_entries(_col(c)), entry), ", ")
    return F.concat(F.lit("{"), F.coalesce(entries, F.lit("")), F.lit("}"))


def utc_now() -> Column:
    """Start of the running query; a run passes one literal instead so that all its rows agree."""
    return F.current_timestamp()
