"""Pages as a table of elements, and selectors as joins and windows over it.

``element_table`` reads each distinct html once and writes one row per element: its place ``node`` in document order, the
``last`` place below it, its ``parent``, tag, attributes and own strings. What was read can then be asked any selector,
without html and without Python: a descendant stands at most at the ``last`` of a match before it (a running maximum), a
child shares a family with its parent, siblings are neighbours in it. All selectors of a call go through the same windows,
and each step is linear in the elements. Nothing is larger than one page: windows are per page or family.

Rows that are ``removed`` stay in the table, so that places and strings keep their numbers; no selector sees them. A page
without elements, or one that could not be read (``error``), has one row without ``node``.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import DEFAULT_IMAGE_ATTR, DEFAULT_LINK_ATTR, NO_PAGE, TEXT_FIELDS, check_config, elements
from ..functions.markup import parse_selector, sibling_dependent
from ..functions.urls import url_host, url_join
from ..session import materialize
from .extract import article_record

PAGE = "html_key"
ELEMENT = ["tag", "attrs", "classes", "text_kind", "text_from", "text_to"]


def with_html_key(pages: DataFrame, name: str = PAGE) -> DataFrame:
    """Pages that have the same html have the same key; none without html."""
    return pages.withColumn(name, F.sha2("html", 256))


def _of_pages(pages: DataFrame, read: DataFrame, how: str) -> DataFrame:
    """``pages`` without html, and what was read of it under names with an underscore, as other names are the pages' own."""
    named = read.select(*[F.col(c).alias(f"_{c}") for c in read.columns])
    return with_html_key(pages, f"_{PAGE}").drop("html").join(named, f"_{PAGE}", how)


def element_table(pages: DataFrame) -> DataFrame:
    """The elements of every distinct html of ``pages``, written. Pages without html have none.

    Html moves only where pages repeat, to be read once.
    """
    keyed = with_html_key(pages.select("html").where("html IS NOT NULL"))
    repeated = not keyed.groupBy(PAGE).count().where("count > 1").isEmpty()
    once = keyed.dropDuplicates([PAGE]) if repeated else keyed
    read = once.select(PAGE, elements("html").alias("read"))
    rows = read.select(PAGE, F.col("read.error").alias("error"), F.explode_outer("read.elements").alias("element"))
    return materialize(rows.select(PAGE, "element.*", "error", F.lit(False).alias("removed")))


def _compound(parts: Iterable[tuple]) -> Column:
    """What of a compound selector an element answers alone; its place among siblings is asked later."""
    met = F.lit(True)
    for kind, name, value in parts:
        if kind == "tag":
            met &= F.col("tag") == name
        elif kind == "class":
            met &= F.array_contains("classes", name)
        elif kind == "attr":
            found = F.try_element_at("attrs", F.lit(name))
            met &= found.isNotNull() if value is None else F.coalesce(found == value, F.lit(False))
    return met


class _Steps:
    """The steps of all paths of some selectors, each a column: whether an element meets it."""

    def __init__(self, selectors: dict[str, str], mark: str):
        self.paths = [(name, steps) for name, selector in selectors.items() for steps in parse_selector(selector)]
        self.mark = mark

    def column(self, path: int, k: int) -> str:
        return f"{self.mark}_{path}_{k}"

    def alone(self) -> dict[str, Column]:
        return {self.column(p, k): _compound(compound) for p, (_, steps) in enumerate(self.paths) for k, (_, compound) in enumerate(steps)}

    def last(self) -> dict[str, str]:
        """The column of each path's last step, and the selector's name."""
        return {self.column(p, len(steps) - 1): name for p, (name, steps) in enumerate(self.paths)}

    def walk(self, slim: DataFrame) -> DataFrame:
        """From what elements answer alone to what they meet in their place; all paths take a step at the same time."""
        steps = self.alone()
        if not steps:
            return slim
        slim = slim.withColumns({s: F.col(s) & ~F.col("removed") for s in steps})
        family = Window.partitionBy(PAGE, "parent").orderBy("node")
        before = family.rowsBetween(Window.unboundedPreceding, -1)
        nth = {(self.column(p, k), x[2]) for p, (_, path) in enumerate(self.paths) for k, (_, compound) in enumerate(path) for x in compound if x[0] == "nth"}
        if nth:
            slim = slim.withColumn("position", F.count_if(~F.col("removed")).over(family.rowsBetween(Window.unboundedPreceding, 0)))
            placed = {s: reduce(lambda a, b: a & b, [F.col("position") == n for t, n in nth if t == s], F.col(s)) for s, _ in nth}
            slim = slim.withColumns(placed).drop("position")

        above = Window.partitionBy(PAGE).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        for k in range(1, max(len(path) for _, path in self.paths)):
            now = {self.column(p, k): (path[k][0], self.column(p, k - 1)) for p, (_, path) in enumerate(self.paths) if k < len(path)}
            slim = _children(slim, {s: prev for s, (how, prev) in now.items() if how == ">"})
            related = {
                " ": lambda prev: F.max(F.when(F.col(prev), F.col("last"))).over(above) >= F.col("node"),
                "~": lambda prev: F.max(prev).over(before),
                "+": lambda prev: F.last(F.when(~F.col("removed"), F.col(prev)), ignorenulls=True).over(before),
            }
            slim = slim.withColumns({s: F.col(s) & F.coalesce(related[how](prev), F.lit(False)) for s, (how, prev) in now.items() if how != ">"})
        return slim


def _turns(selectors: Iterable[str]) -> list[list[str]]:
    """Selectors that look at siblings see what those before them have left; the others may go together."""
    turns: list[list[str]] = []
    for selector in selectors:
        if not turns or sibling_dependent(selector):
            turns.append([])
        turns[-1].append(selector)
    return turns


def _marked(table: DataFrame, selectors: dict[str, str], remove: Iterable[str], *carried: str) -> DataFrame:
    """html_key, node, last, ``removed`` once the matches of ``remove`` are, and ``names`` of the selectors met (or none).

    ``carried`` are further columns of the table; ``element`` holds those of elements that can match. One shuffle by page does
    for all of it, unless a selector asks for children.
    """
    turns = [_Steps({str(i): s for i, s in enumerate(turn)}, f"r{n}") for n, turn in enumerate(_turns(remove))]
    asked = _Steps(selectors, "s")
    alone = {k: c for steps in (*turns, asked) for k, c in steps.alone().items()}
    ends = asked.last()
    may = reduce(lambda a, b: a | b, [alone[s] for s in ends], F.lit(False))
    element = F.when(may, F.struct(*ELEMENT)).alias("element")
    slim = table.where("node IS NOT NULL").select(PAGE, "node", "last", "parent", "removed", *carried, element, *[c.alias(n) for n, c in alone.items()])
    so_far = Window.partitionBy(PAGE).orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    for steps in turns:
        hit = reduce(lambda a, b: a | b, [F.col(s) for s in steps.last()])
        until = F.max(F.when(hit, F.col("last"))).over(so_far)
        slim = steps.walk(slim).withColumn("removed", F.col("removed") | F.coalesce(until >= F.col("node"), F.lit(False))).drop(*steps.alone())
    names = F.array(*[F.when(F.col(s), name) for s, name in ends.items()]).cast("array<string>")
    return asked.walk(slim).select(PAGE, "node", "last", "removed", *carried, "element", F.array_distinct(F.array_compact(names)).alias("names"))


def _children(slim: DataFrame, steps: dict[str, str]) -> DataFrame:
    """Each step (a column) keeps what has a parent that met the step before."""
    if not steps:
        return slim
    met = reduce(lambda a, b: a | b, [F.col(prev) for prev in steps.values()])
    # a family is an element, if it met any step, and its children
    roles = F.filter(
        F.array(F.struct(F.col("node").alias("of"), F.lit(True).alias("head")), F.struct(F.col("parent").alias("of"), F.lit(False).alias("head"))),
        lambda role: ~role["head"] | met,
    )
    families = slim.withColumn("family", F.explode(roles))
    within = Window.partitionBy(PAGE, "family.of")
    kept = {s: F.col(s) & F.coalesce(F.max(F.when(F.col("family.head"), F.col(prev))).over(within), F.lit(False)) for s, prev in steps.items()}
    return families.withColumns(kept).where("NOT family.head").drop("family")


def select_elements(table: DataFrame, selectors: dict[str, str], remove: Iterable[str] = (), text: bool = False) -> DataFrame:
    """The elements that match, with the ``name`` of the selector; an element that several match has a row for each.

    ``remove`` is done first, as ``remove_elements`` does it, without writing a table. With ``text`` each has its text, as of
    ``with_text``. The order of ``node`` is that of the document. Unsupported selectors raise ValueError.
    """
    marked = _marked(table, selectors, remove, *(["strings"] if text else []))
    found = F.struct("node", "last", "element.*", "names")
    if not text:
        rows = marked.where(F.size("names") > 0).select(PAGE, found.alias("found"))
    else:
        kept = F.transform("strings", lambda s: F.struct(s["seq"], s["kind"], F.when(~F.col("removed"), s["text"]).alias("text")))
        pages = marked.groupBy(PAGE).agg(
            F.sort_array(F.flatten(F.collect_list(kept))).alias("strings"), F.collect_list(F.when(F.size("names") > 0, found)).alias("found")
        )
        read = F.transform("found", lambda f: f.withField("text", _text(F.col("strings"), f["text_from"], f["text_to"], f["text_kind"])))
        rows = pages.select(PAGE, F.explode(read).alias("found"))
    return rows.select(PAGE, "found.*").withColumn("name", F.explode("names")).drop("names")


def remove_elements(table: DataFrame, selectors: Iterable[str]) -> DataFrame:
    """The table, written, with the matches of each selector in turn ``removed``, and all that is in them."""
    gone = _marked(table, {}, selectors).where("removed").select(PAGE, "node", F.lit(True).alias("gone"))
    return materialize(table.join(gone, [PAGE, "node"], "left").withColumn("removed", F.coalesce("gone", F.lit(False))).select(*table.columns))


def _text(strings: Column, start: Column, end: Column, kind: Column) -> Column:
    """An element's text is a slice of its page's strings, without those of another kind."""
    own = F.filter(F.slice(strings, start + 1, end - start), lambda s: (s["kind"] == kind) & s["text"].isNotNull())
    return F.coalesce(F.array_join(F.transform(own, lambda s: s["text"]), " "), F.lit(""))


def with_text(table: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` and the ``text`` of each element, that of elements removed left out; '' if there is none.

    A page's strings stand in one array, and an element's are a slice of it.
    """
    strings = table.where(F.size("strings") > 0).select(PAGE, "removed", F.explode("strings").alias("s"))
    kept = F.struct("s.seq", "s.kind", F.when(~F.col("removed"), F.col("s.text")).alias("text"))
    pages = strings.groupBy(PAGE).agg(F.sort_array(F.collect_list(kept)).alias("_strings"))
    text = _text(F.col("_strings"), F.col("text_from"), F.col("text_to"), F.col("text_kind"))
    return found.join(pages, PAGE, "left").withColumn("text", text).drop("_strings")


def first_below(scopes: DataFrame, found: DataFrame, value: Column) -> DataFrame:
    """html_key, node and ``value`` of the first of ``found`` inside each of ``scopes``; null where there is none.

    It is the next one after the scope's begin, if the scope has not ended there: one window, no pairs.
    """
    nobody = F.lit(None)
    inner = found.select(PAGE, "node", F.lit(None).cast("int").alias("last"), F.struct("node", value.alias("value")).alias("inner"))
    outer = scopes.select(PAGE, "node", "last").withColumn("inner", nobody.cast(inner.schema["inner"].dataType))
    later = Window.partitionBy(PAGE).orderBy(F.desc("node"), F.col("inner").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    rows = outer.unionByName(inner).withColumn("next", F.last("inner", ignorenulls=True).over(later))
    return rows.where("last IS NOT NULL").select(PAGE, "node", F.when(F.col("next.node") <= F.col("last"), F.col("next.value")).alias("value"))


def read_details(table: DataFrame, config: dict) -> DataFrame:
    """html_key and ``fields``: what ``functions.html.detail`` reads, by joins. One row per page of the table."""
    check_config(config, "detail")
    article = config["article"]
    attrs = {"published_at": article.get("published_at_attr"), "featured_image": article.get("featured_image_attr", DEFAULT_IMAGE_ATTR)}
    fields = {f: article[f"{f}_selector"] for f in TEXT_FIELDS if article.get(f"{f}_selector")}
    keys = article.get("metadata_selectors") or {}
    asked = {**fields, **{f"metadata {k}": s for k, s in keys.items()}}
    found = select_elements(table, asked, article.get("remove_selectors") or [], text=True)
    first = F.row_number().over(Window.partitionBy(PAGE, "name").orderBy("node")) == 1
    read = found.withColumn("first", first).where(F.col("first") | F.col("name").startswith("metadata "))

    value = lambda f: F.try_element_at("attrs", F.lit(attrs[f])) if attrs.get(f) else F.nullif("text", F.lit(""))
    words = F.when(F.col("text") == "", F.array_join("classes", " ")).otherwise(F.col("text"))
    of = lambda name, c: F.max(F.when(F.col("name") == name, c))
    listed = lambda k: F.collect_list(F.when(F.col("name") == f"metadata {k}", F.struct("node", words.alias("value"))))
    page = read.groupBy(PAGE).agg(
        *[of(f, value(f)).alias(f) for f in fields],
        *[F.transform(F.sort_array(listed(k)), lambda x: x["value"]).alias(f"_m{i}") for i, k in enumerate(keys)],
    )
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"_m{i}").alias("value")) for i, k in enumerate(keys)])
    metadata = F.map_from_entries(F.filter(entries, lambda e: F.size(e["value"]) > 0)) if keys else F.create_map()
    metadata = F.coalesce(metadata.cast("map<string,array<string>>"), F.create_map().cast("map<string,array<string>>"))
    # every page has one row that is its first element, or none
    whole = table.where("node IS NULL OR node = 0").select(PAGE, "error").join(page, PAGE, "left")
    metadata = F.when(F.col("error").isNull(), metadata)
    columns = [(F.col(f) if f in fields else F.lit(None).cast("string")).alias(f) for f in TEXT_FIELDS]
    return whole.select(PAGE, F.struct(*columns, metadata.alias("metadata")).alias("fields"), "error")


def articles_from_elements(pages: DataFrame, table: DataFrame, config: dict) -> DataFrame:
    """``extract_articles`` over elements: one record for each of ``pages``, without its html."""
    read = _of_pages(pages, read_details(table, config), "left")
    record = article_record("_fields", "url", url_host("url"))
    kept = [c for c in pages.columns if c not in record and c != "html"]
    return read.select(*kept, *[c.alias(n) for n, c in record.items()], F.coalesce("_error", F.when(F.col(f"_{PAGE}").isNull(), NO_PAGE)).alias("error"))


def links_from_elements(pages: DataFrame, table: DataFrame, config: dict) -> DataFrame:
    """``list_items`` over elements, for sites whose items are links: page_url, item_idx, mode, item_url."""
    check_config(config, "listing")
    listed = config["list_page"]
    if listed.get("item_is_article"):
        raise ValueError("items that are articles are read by list_items")
    attr, link = listed.get("link_attr", DEFAULT_LINK_ATTR), listed.get("link_selector")
    found = select_elements(table, {"item": listed["item_selector"], **({"link": link} if link else {})})
    items, href = found.where("name = 'item'"), F.try_element_at("attrs", F.lit(attr))
    hrefs = first_below(items, found.where("name = 'link'"), href) if link else items.select(PAGE, "node", href.alias("value"))
    numbered = hrefs.withColumn("item_idx", F.row_number().over(Window.partitionBy(PAGE).orderBy("node")) - 1).where("value IS NOT NULL")
    kept = [c for c in pages.columns if c not in ("url", "html")]
    rows = _of_pages(pages, numbered.select(PAGE, "item_idx", "value"), "inner")
    return rows.select(*kept, F.col("url").alias("page_url"), F.col("_item_idx").alias("item_idx"), F.lit("link").alias("mode"), url_join("url", "_value").alias("item_url"))
