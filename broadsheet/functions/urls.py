"""URL functions as native Spark columns."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, or_default, slugify

# The generic URI syntax of RFC 3986, appendix B, and the schemes that allow references
# relative to a base.
URI = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"
RELATIVE_SCHEMES = ["", "file", "ftp", "http", "https", "sftp", "ws", "wss"]


def url_host(url: Column | str) -> Column:
    """The authority, with user and port where given."""
    return F.regexp_extract(_col(url), URI, 2)


def url_origin(url: Column | str) -> Column:
    return F.concat(F.lower(F.regexp_extract(_col(url), URI, 1)), F.lit("://"), url_host(url))


def article_id(url: Column | str) -> Column:
    """Identifier of the URL exactly as given."""
    return F.substring(F.sha2(_col(url), 256), 1, 16)


def article_slug(title: Column | str, url: Column | str) -> Column:
    title = _col(title)
    last_segment = F.substring_index(_col(url), "/", -1)
    return slugify(F.when(F.length(title) > 0, title).otherwise(last_segment))


def inline_url(page_url: Column | str, idx: Column | str) -> Column:
    return F.concat(_col(page_url), F.lit("#item-"), _col(idx).cast("string"))


def _path_of(segments: Column) -> Column:
    """Apply '.' and '..'; a path that ends in one of them names a directory."""

    def step(path: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0))))
            .when(segment == ".", path)
            .otherwise(F.array_append(path, segment))
        )

    walked = F.aggregate(segments, F.array().cast("array<string>"), step)
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.array_join(F.when(ends_in_dots, F.array_append(walked, F.lit(""))).otherwise(walked), "/")


def _let(value: Column, body) -> Column:
    """Name an intermediate value, so that it is written into the plan and evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _uri_parts(url: Column) -> Column:
    """Scheme, authority, path, query and fragment; '' where missing."""
    names = ("scheme", "host", "path", "query", "fragment")
    return F.struct(*[F.regexp_extract(url, URI, i).alias(n) for i, n in enumerate(names, 1)])


def _merge_paths(p: Column) -> Column:
    """The path of the reference, seen from the folder of the base, before '.' and '..' are applied."""
    parameters = F.regexp_extract(p["ref"]["path"], ";[^/]*$", 0)
    file = F.regexp_replace(p["ref"]["path"], ";[^/]*$", "")
    folder = F.when(p["ref"]["path"].startswith("/"), "").otherwise(F.regexp_replace(p["base"]["path"], "[^/]*$", ""))
    return F.struct(
        p["base"].alias("base"),
        p["ref"].alias("ref"),
        file.alias("file"),
        F.when(parameters == ";", "").otherwise(parameters).alias("parameters"),
        file.startswith("/").alias("rooted"),
        F.concat(folder, file).alias("merged"),
    )


def _resolved(p: Column) -> Column:
    def without_empty(segments: Column) -> Column:
        return F.filter(segments, lambda x, i: (x != "") | (i == 0) | (i == F.size(segments) - 1))

    walked = _let(F.split(p["merged"], "/"), lambda s: _path_of(F.when(p["rooted"], s).otherwise(without_empty(s))))
    needs_walk = p["merged"].rlike(r"(^|/)\.\.?(/|$)") | (~p["rooted"] & p["merged"].contains("//"))
    path = or_default(F.when(needs_walk, walked).otherwise(p["merged"]), F.lit("/"))
    return F.concat(path, p["parameters"])


def _joined(p: Column) -> Column:
    base, ref = p["base"], p["ref"]
    own_host = ref["host"] != ""
    same_document = (p["file"] == "") & (p["parameters"] == "")
    path = (
        F.when(own_host, F.concat(p["file"], p["parameters"]))
        .when(same_document, base["path"])
        .otherwise(_resolved(p))
    )
    host = F.when(own_host, ref["host"]).otherwise(base["host"])
    query = F.when(~own_host & same_document & (ref["query"] == ""), base["query"]).otherwise(ref["query"])
    parts = F.struct(path.alias("path"), host.alias("host"), query.alias("query"))
    return _let(
        parts,
        lambda x: F.concat(
            F.when(base["scheme"] != "", F.concat(F.lower(base["scheme"]), F.lit(":"))).otherwise(""),
            F.when(x["host"] != "", F.concat(F.lit("//"), x["host"])).otherwise(""),
            F.when((x["host"] != "") & (x["path"] != "") & ~x["path"].startswith("/"), "/").otherwise(""),
            x["path"],
            F.when(x["query"] != "", F.concat(F.lit("?"), x["query"])).otherwise(""),
            F.when(ref["fragment"] != "", F.concat(F.lit("#"), ref["fragment"])).otherwise(""),
        ),
    )


@lru_cache(maxsize=64)
def url_join(base: str, ref: str) -> Column:
    """Resolve the reference in one column against the page URL in another.

    Columns are given by name, and the expression is kept: building it takes many calls to the JVM.
    """
    base, ref = F.col(base), F.col(ref)
    tidy = F.regexp_replace(F.regexp_replace(ref, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    parts = F.struct(_uri_parts(base).alias("base"), _uri_parts(tidy).alias("ref"))

    def resolve(p: Column) -> Column:
        base_scheme, ref_scheme = F.lower(p["base"]["scheme"]), F.lower(p["ref"]["scheme"])
        foreign = ((ref_scheme != "") & (ref_scheme != base_scheme)) | ~base_scheme.isin(RELATIVE_SCHEMES)
        return F.when(foreign, ref).otherwise(_let(_merge_paths(p), _joined))

    return F.when(base == "", ref).when(ref == "", base).when(ref.isNotNull(), _let(parts, resolve))


def image_url(url: str, image: str) -> Column:
    """Resolve a non-empty image address; '' and NULL stay as they are."""
    return F.when(F.length(image) > 0, url_join(url, image)).otherwise(F.col(image))
