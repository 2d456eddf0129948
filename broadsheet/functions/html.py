"""Config-driven page extraction: one Arrow UDF per page, everything after it is native columns.

``detail`` reads a page as an article, ``listing`` as a list of items with a next-page link. The
config is a dict (one site) or a column of JSON text (many sites). A page that cannot be processed
gives a row with ``error`` set; it never fails the task. Encodings are settled before: the input is
text.

Spark moves a filter on extracted fields below the projection and then runs the UDF twice, so write
the result out before filtering on it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..schemas import BOTH, DETAIL, ELEMENTS, LISTING
from .markup import OWN_TEXT, Page, parse_selector
from .text import _col

# The defaults of absent keys.
DEFAULT_LINK_ATTR = "href"
DEFAULT_IMAGE_ATTR = "src"
NO_PAGE = "no page"
#: Of a batch, so much html is read at a time, a page counting as so many bytes at least.
PIECE_BYTES, PAGE_BYTES = 1 << 20, 1 << 10
TEXT_FIELDS = ("title", "body", "published_at", "category", "author", "featured_image")


def _field(page: Page, scope: int | None, selector: str | None, attr: str | None) -> str | None:
    """First match: cleaned text with '' as NULL, or the raw attribute."""
    found = page.select(scope, selector) if selector else []
    if not found:
        return None
    return page.attrs(found[0]).get(attr) if attr else page.text(found[0]) or None


def _metadata(page: Page, scope: int | None, selectors: dict | None) -> list[tuple[str, list[str]]]:
    """All matches per key; an element without text answers with its classes."""
    found = ((key, page.select(scope, selector)) for key, selector in (selectors or {}).items())
    return [(key, [page.text(e) or " ".join(page.classes(e)) for e in es]) for key, es in found if es]


def _article(page: Page, scope: int | None, config: dict) -> dict:
    for selector in config.get("remove_selectors") or []:
        page.remove(scope, selector)
    attrs = {
        "published_at": config.get("published_at_attr"),
        "featured_image": config.get("featured_image_attr", DEFAULT_IMAGE_ATTR),
    }
    fields = {f: _field(page, scope, config.get(f"{f}_selector"), attrs.get(f)) for f in TEXT_FIELDS}
    return {**fields, "metadata": _metadata(page, scope, config.get("metadata_selectors"))}


def _detail(html: str, config: dict) -> dict:
    return _article(Page(html), None, config["article"])


def _next_href(page: Page, config: dict) -> str | None:
    if not config.get("enabled"):
        return None
    return _field_attr(page, None, config["next_selector"], config.get("next_attr", DEFAULT_LINK_ATTR))


def _field_attr(page: Page, scope: int | None, selector: str, attr: str) -> str | None:
    found = page.select(scope, selector)
    return page.attrs(found[0]).get(attr) if found else None


def _listing(html: str, config: dict) -> dict:
    return _listing_of(Page(html), config)


def _listing_of(page: Page, config: dict) -> dict:
    listed = config["list_page"]
    # The next link is read before any noise is removed.
    next_href = _next_href(page, config.get("pagination") or {})
    items, attr = [], listed.get("link_attr", DEFAULT_LINK_ATTR)
    for idx, item in enumerate(page.select(None, listed["item_selector"])):
        if listed.get("item_is_article"):
            items.append({"idx": idx, "article": _article(page, item, config["article"])})
        elif listed.get("link_selector"):
            items.append({"idx": idx, "href": _field_attr(page, item, listed["link_selector"], attr)})
        else:
            items.append({"idx": idx, "href": page.attrs(item).get(attr)})
    return {"next_href": next_href, "items": items}


def _both(html: str, config: dict) -> dict:
    """One parse for both readings: the listing first, as noise removal belongs to the article."""
    page = Page(html)
    try:
        out = _listing_of(page, config)
    except Exception as error:
        out = {"listing_error": f"{type(error).__name__}: {error}"}
    if (config.get("list_page") or {}).get("item_is_article"):
        return out
    try:
        return {**out, "fields": _article(page, None, config["article"])}
    except Exception as error:
        return {**out, "error": f"{type(error).__name__}: {error}"}


def _elements(html: str, _config: dict) -> dict:
    """The page's elements in document order, each with the strings directly in it; strings outside any element have no number."""
    page = Page(html)
    strings, numbers = [[] for _ in page.tag], [0]
    for owner, kind, text in zip(page.text_owner, page.text_kind, page.texts):
        if owner >= 0:
            strings[owner].append({"seq": numbers[-1], "kind": kind, "text": " ".join(text.split())})
        numbers.append(numbers[-1] + (owner >= 0))
    return {"elements": [
        {
            "node": e, "last": page.end[e] - 1, "parent": page.parent[e], "tag": tag, "attrs": list(page.attrs(e).items()),
            "classes": page.classes(e), "text_kind": tag if tag in OWN_TEXT else "",
            "text_from": numbers[page.text_from[e]], "text_to": numbers[page.text_to[e]], "strings": strings[e],
        }
        for e, tag in enumerate(page.tag)
    ]}


@lru_cache(maxsize=4096)
def _config(text: str | None) -> dict | None:
    """None where it is not JSON: then every page gives an error row."""
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def _selectors(config: dict) -> list[str]:
    article, listed, paging = (config.get(k) or {} for k in ("article", "list_page", "pagination"))
    found = [v for k, v in {**article, **listed, **paging}.items() if k.endswith("_selector")]
    found = [v for v in found if v and v != listed.get("wait_for_selector")]
    return found + list(article.get("remove_selectors") or []) + list((article.get("metadata_selectors") or {}).values())


def check_config(config: dict, *uses: str) -> None:
    """Raise ValueError on the driver for a config that no page could be read with.

    That is a selector outside the supported subset, or a missing key for what it is used for (``detail``, ``listing``).
    """
    if not isinstance(config, dict):
        raise ValueError(f"a config is an object, not {config!r}")
    listed, paging = (config.get(k) or {} for k in ("list_page", "pagination"))
    needs_article = "detail" in uses or "listing" in uses and listed.get("item_is_article")
    for missing, what in (
        (needs_article and not isinstance(config.get("article"), dict), "article"),
        ("listing" in uses and not listed.get("item_selector"), "list_page.item_selector"),
        ("listing" in uses and paging.get("enabled") and not paging.get("next_selector"), "pagination.next_selector"),
    ):
        if missing:
            raise ValueError(f"config {config.get('name', '')!r} has no {what}")
    for selector in _selectors(config):
        parse_selector(selector)


def check_configs(sites: DataFrame, walks: bool = True) -> None:
    """``check_config`` for the JSON texts in ``config``, one small row per site, for all that is done with them.

    What ``walks`` needs listings of every site; what does not reads listings where the config describes them.
    """
    for (text,) in sites.select("config").toLocalIterator():
        try:
            config = json.loads(text)
        except (TypeError, ValueError) as error:
            raise ValueError(f"config is not JSON: {error}") from error
        listed = config.get("list_page") or {} if isinstance(config, dict) else {}
        check_config(config, *(["listing"] if walks or listed else []), *([] if listed.get("item_is_article") else ["detail"]))


def _pieces(batch: list[pa.Array]) -> Iterator[list[pa.Array]]:
    """A batch of columns, the first of them html, cut so that only one piece at a time is Python objects, however many pages a batch has."""
    sizes = pc.fill_null(pc.binary_length(batch[0]), 0).to_numpy(zero_copy_only=False).astype("int64")
    piece = np.cumsum(np.maximum(sizes, PAGE_BYTES)) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
    for begin, end in zip(cuts, cuts[1:]):
        yield [column.slice(begin, end - begin) for column in batch]


def _extractor(read, use: str, ddl: str, html: Column | str, config: dict | Column) -> Column:
    schema = DataType.fromDDL(ddl)

    def failed(error: str) -> dict:
        return {"error": error, "listing_error": error} if use == "both" else {"error": error}

    def rows(pages, configs):
        for html, config in zip(pages, configs):
            try:
                yield failed(NO_PAGE) if html is None else read(html, config)
            except Exception as error:  # one bad page is one row
                yield failed(f"{type(error).__name__}: {error}")

    if isinstance(config, dict):
        check_config(config, use)

        def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                for (html,) in _pieces([batch]):
                    yield pa.array(list(rows(html.to_pylist(), [config] * len(html))), to_arrow_type(schema))

        return F.arrow_udf(extract, schema)(_col(html))

    def extract_each(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            for html, configs in _pieces(list(batch)):
                yield pa.array(list(rows(html.to_pylist(), map(_config, configs.to_pylist()))), to_arrow_type(schema))

    return F.arrow_udf(extract_each, schema)(_col(html), config)


def detail(html: Column | str, config: dict | Column) -> Column:
    return _extractor(_detail, "detail", DETAIL, html, config)


def both(html: Column | str, config: Column) -> Column:
    """A page read as a listing and, where items are links, as an article."""
    return _extractor(_both, "both", BOTH, html, config)


def listing(html: Column | str, config: dict | Column) -> Column:
    return _extractor(_listing, "listing", LISTING, html, config)


def elements(html: Column | str) -> Column:
    """A page as its elements, for any selectors to be asked of; see ``operators.elements``."""
    return _extractor(_elements, "elements", ELEMENTS, html, {})
