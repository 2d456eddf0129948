"""The common end of a batch run and of a streaming batch: staged events into the store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.lookups import attach_lookup_ids, new_lookups
from ..operators.upsert import KEY, stamp_times, upsert_outcomes, written_keys
from ..session import materialize
from ..sources.store import TABLES, Store

# Slim columns of a staged event; the content stays behind until it is known which rows are written.
EVENT = ["site", *KEY, "seq", "mode", "item_url", "fetch", "content_hash", "category", "author", "featured_image"]
CONTENT = ["title", "slug", "body", "published_at", "metadata", "url"]

# Store table, its value column, the article column it serves, and the id column.
LOOKUPS = [
    ("categories", "name", "category", "category_id"),
    ("authors", "name", "author", "author_id"),
    ("images", "url", "featured_image", "featured_image_id"),
]


def touched_rows(store: Store, events: DataFrame) -> DataFrame:
    """Keys, hashes and times of the stored articles that share an article id with ``events``, written once.

    All that a batch asks the store: who owns an id, what is known. Partitions that no id of the batch can be in are not read.
    """
    return materialize(store.touched(materialize(events.select("article_id").distinct())))


def settle(
    store: Store,
    staged: DataFrame,
    add_content: Callable[[DataFrame], DataFrame],
    run_ts: Column,
    force: bool = False,
    state: DataFrame | None = None,
    batch: str = "",
    touched: DataFrame | None = None,
    also: Callable[[DataFrame], dict[str, DataFrame]] | None = None,
) -> DataFrame:
    """Decide every event, write what changed, and return the outcomes.

    ``add_content`` joins the content columns to the events whose fields stand at the end. Ids and
    times are attached to the slim events before, so content is shuffled once at most. ``also`` names further tables of the same commit, made
    from the outcomes.
    """
    stored = touched_rows(store, staged) if touched is None else touched
    outcomes = materialize(upsert_outcomes(staged.select(*EVENT), stored, force))

    # Names are kept from every item that reached extraction, written or not.
    named = outcomes.where("extracted")
    merged, run = {}, store.begin()
    for table, value, column, _ in LOOKUPS:
        lookup = store.lookup(table)
        names = named.select("domain", F.col(column).alias(value), "seq")
        merged[table] = lookup.unionByName(run.put(table, new_lookups(names, lookup, value)))

    keys = stamp_times(written_keys(outcomes), stored, run_ts)
    last_events = outcomes.drop("outcome", "reason", "extracted").join(keys, [*KEY, "seq"])
    for table, value, column, id_column in LOOKUPS:
        last_events = attach_lookup_ids(last_events, merged[table], column, id_column, value)
    columns = StructType.fromDDL(schemas.ARTICLES).names
    run.put("articles", add_content(last_events).select(*columns))
    if state is not None:
        run.put("state", state)
    for table, rows in (also(outcomes) if also else {}).items():
        run.put(table, rows.select(*StructType.fromDDL(TABLES[table]).names))
    run.commit(batch)
    return outcomes
