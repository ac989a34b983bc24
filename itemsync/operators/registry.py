"""The registry of indexed ids: merging, delete detection, shrinking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.schemas import REGISTRY_KEYS


def registry_rows(documents: DataFrame, platform: str) -> DataFrame:
    """What the registry keeps of freshly extracted documents; type labels in lower case."""
    return documents.select(
        F.col("id").cast("string").alias("id"),
        F.coalesce("parent_id", F.lit("")).alias("parent_id"),
        F.lower("type").alias("type"),
        F.lit(platform).alias("platform"),
        "object",
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]):
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def new_rows(registry: DataFrame, rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct rows that the registry does not hold yet.

    The registry is only probed for the rows at hand, so it is not shuffled
    where these fit a broadcast.
    """
    keys = keys or REGISTRY_KEYS
    fresh = rows.select(*keys).dropDuplicates()
    probe, known = fresh.alias("probe"), registry.select(*keys)
    held = known.join(probe, _same(known, fresh, keys), "left_semi").dropDuplicates().alias("held")
    held = held.select(*[F.col(key).alias(f"_{key}") for key in keys])
    match = F.lit(True)
    for key in keys:
        match = match & fresh[key].eqNullSafe(held[f"_{key}"])
    return fresh.join(held, match, "left_anti")


def merge_registry(registry: DataFrame, rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Registry plus rows it does not hold; equality on every field. What it holds stays as it is."""
    keys = keys or REGISTRY_KEYS
    return registry.select(*keys).unionByName(new_rows(registry, rows, keys))


def loaded_state(registry: DataFrame) -> DataFrame:
    """The two lists a run starts from: all ids, and the same ids as candidates for deletion."""
    states = F.array(F.lit("global_keys"), F.lit("delete_keys"))
    return registry.withColumn("state", F.explode(states))


def deleted_rows(registry: DataFrame, live: DataFrame, platform: str, key: list[str] | None = None) -> DataFrame:
    """Registry rows of the platform whose id is no longer live: a hash or merge anti join."""
    key = key or ["object", "id"]
    own = registry.filter(F.col("platform").contains(platform))
    return own.join(live.select(*key).distinct(), key, "left_anti")


#: Rows that a task of the comparison holds: as wished, and at most.
TASK_ROWS, MOST_TASK_ROWS = 250_000, 2_000_000
#: Pieces up to which a shuffle writes without holding its rows.
PIECES = 200


def pieces(rows: int) -> int:
    """Pieces in which so many rows are compared, so that those of one task are bounded whatever their number."""
    return max(min(-(-rows // TASK_ROWS), PIECES), -(-rows // MOST_TASK_ROWS), 1)


def deleted_ids(
    registry: DataFrame, live: DataFrame, platform: str, key: list[str] | None = None, live_rows: int = 0
) -> DataFrame:
    """Each deleted id once, though the registry may hold it under several types.

    Both sides are dealt once by key, narrow, into as many pieces as they have rows for,
    and compared by one aggregate. ``live_rows`` is how many live rows there are at most.
    A missing key is never live.
    """
    key = key or ["object", "id"]
    own = registry.filter(F.col("platform").contains(platform)).select(*key, F.lit(False).alias("_live"))
    found = live.select(*key).dropna().withColumn("_live", F.lit(True))
    n = pieces(own.count() + live_rows)
    met = own.unionByName(found).repartition(n, *key).groupBy(*key)
    # a group without a live row is of the registry
    return met.agg(F.max("_live").alias("_live")).filter("NOT _live").select(*key)


def cascade(registry: DataFrame, deleted: DataFrame) -> DataFrame:
    """Deleted ids together with the ids whose parent was deleted."""
    parents = deleted.select("object", F.col("id").alias("parent_id"))
    # items have no parent; their common empty value would be one hot key
    owned = registry.filter("parent_id <> ''")
    orphans = owned.join(parents, ["object", "parent_id"], "left_semi").select("object", "id")
    return deleted.unionByName(orphans).distinct()


def surviving(registry: DataFrame, deleted: DataFrame, platform: str, key: list[str] | None = None) -> DataFrame:
    """The registry after a deletion run: rows of deleted ids are gone, other platforms stay."""
    key = key or ["object", "id"]
    other = registry.filter(~F.col("platform").contains(platform) | F.col("platform").isNull())
    own = registry.filter(F.col("platform").contains(platform))
    return own.join(deleted.select(*key).distinct(), key, "left_anti").unionByName(other)
