"""Site configs and run defaults."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import url_host
from ..schemas import SITE


@dataclass(frozen=True)
class Defaults:
    """The global settings that matter to the data; a site may override delay, jitter and headers."""

    delay_seconds: float = 2.0
    jitter_seconds: float = 1.0
    max_retries: int = 3
    user_agent: str = "broadsheet/1.0"
    respect_robots_txt: bool = True


def run_defaults(spark: SparkSession, path: str) -> Defaults:
    """Read the ``defaults`` object of the global config."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    given = json.loads(text).get("defaults", {})
    return Defaults(**{k: v for k, v in given.items() if k in Defaults.__dataclass_fields__})


def request_headers(defaults: Defaults, headers: Column) -> Column:
    """Default headers overlaid by those of the site."""
    agent = F.lit("User-Agent")
    own = F.coalesce(headers, F.create_map().cast("map<string,string>"))
    missing = F.when(~F.map_contains_key(own, "User-Agent"), F.create_map(agent, F.lit(defaults.user_agent)))
    return F.map_concat(F.coalesce(missing, F.create_map().cast("map<string,string>")), own)


def enabled_sites(sites: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Enabled unless said otherwise; ``only`` selects by name."""
    chosen = sites.where(F.coalesce("enabled", F.lit(True)))
    return chosen.where(F.col("name").isin(only)) if only else chosen


def site_hosts(sites: DataFrame, state: DataFrame | None = None, hosts: DataFrame | None = None) -> DataFrame:
    """The hosts whose pages belong to each site: ``domain, host``, one row each.

    Those of its start URLs and of its checkpoint, any in an optional list ``hosts``, and those that a table ``hosts`` (domain,
    host) names, for sites with more hosts than fit a config. The domain is a label only.
    """
    urls = [F.transform(F.coalesce("start_urls", F.array().cast("array<string>")), url_host)] if "start_urls" in sites.columns else []
    named = [F.coalesce("hosts", F.array().cast("array<string>"))] if "hosts" in sites.columns else []
    if not urls + named:
        raise ValueError("sites need start_urls or hosts")
    found = sites.select("domain", F.explode(F.concat(*urls, *named)).alias("host"))
    if state is not None:
        saved = state.join(sites.select("domain"), "domain", "left_semi")
        found = found.unionByName(saved.select("domain", url_host("last_url").alias("host")))
    if hosts is not None:
        found = found.unionByName(hosts.join(sites.select("domain"), "domain", "left_semi").select("domain", "host"))
    return found.where(F.length("host") > 0).distinct()


def read_sites(
    spark: SparkSession, folder: str, only: list[str] | None = None, defaults: Defaults | None = None
) -> DataFrame:
    """One row per config file, with ``site`` (its name), ``site_order`` and the raw ``config`` text.

    The raw text goes to the extraction, since a parsed row no longer tells an absent key from an
    explicit null. A file that is not such an object, or names no site, fails the job. Files are ordered by name; ids
    taken after the sort rise with it.
    """
    defaults = defaults or Defaults()
    files = spark.read.text(f"{folder}/*.json", wholetext=True)
    parsed = files.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("config"),
        F.from_json("value", SITE, {"mode": "FAILFAST"}).alias("site"),
    ).select("file_name", "config", "site.*")
    no_name = F.raise_error(F.concat("file_name", F.lit(" names no site")))
    parsed = parsed.withColumn("name", F.coalesce("name", no_name.cast("string")))
    ordered = enabled_sites(parsed, only).orderBy("file_name")
    return ordered.withColumns({
        "site": F.col("name"),
        "site_order": F.monotonically_increasing_id(),
        "delay_seconds": F.coalesce("request.delay_seconds", F.lit(defaults.delay_seconds)),
        "jitter_seconds": F.coalesce("request.jitter_seconds", F.lit(defaults.jitter_seconds)),
        "headers": request_headers(defaults, F.col("request.headers")),
    })
