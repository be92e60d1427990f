"""Changes of a knowledge base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def listing(files: DataFrame, columns: list[str]) -> DataFrame:
    return files.select(*columns)


def uploaded(files: DataFrame, batch: DataFrame, override: bool = True) -> DataFrame:
    """One row per (kb, path). With ``override`` the highest version wins, else the lowest; equal versions go by content.

    Combined map-side, so a path uploaded very often is one row per task.
    """
    every = files.unionByName(batch)
    rest = [c for c in every.columns if c not in ("kb", "path")]
    pick = F.max_by if override else F.min_by
    best = every.groupBy("kb", "path").agg(pick(F.struct(*rest), F.struct("version", F.to_json(F.struct(*rest)))).alias("f"))
    return best.select("kb", "path", "f.*")


def deleted(files: DataFrame, paths: DataFrame) -> DataFrame:
    return files.join(paths.select("kb", "path"), ["kb", "path"], "left_anti")


def meta_added(meta: Column, extra: dict[str, Column]) -> Column:
    """New keys only; keys that are there keep their value."""
    new = F.create_map(*[x for k, v in extra.items() for x in (F.lit(k), v)])
    return F.map_concat(F.map_filter(new, lambda k, v: ~F.map_contains_key(meta, k)), meta)


def meta_updated(meta: Column, extra: dict[str, Column]) -> Column:
    """Update or create keys."""
    new = F.create_map(*[x for k, v in extra.items() for x in (F.lit(k), v)])
    names = list(extra)
    return F.map_concat(F.map_filter(meta, lambda k, v: ~k.isin(names)), new)


def meta_removed(meta: Column, names: list[str]) -> Column:
    return F.map_filter(meta, lambda k, v: ~k.isin(names))


def meta_reset(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def meta_text(meta: Column) -> Column:
    """Sorted ``key=value`` pairs."""
    entries = F.array_sort(F.map_entries(meta))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


def with_fields(files: DataFrame, given: DataFrame, defaults: dict[str, Column], sizes: dict[str, int] | None = None) -> DataFrame:
    """Declared fields from the upload; a missing value gets the default; over-long text fails the job."""
    joined = files.join(given, "doc_id", "left")
    for field, default in defaults.items():
        value = F.coalesce(F.col(field), default)
        if sizes and field in sizes:
            message = F.lit(f"{field} is longer than {sizes[field]}")
            value = F.when(F.length(value) <= sizes[field], value).otherwise(F.raise_error(message).cast("string"))
        joined = joined.withColumn(field, value)
    return joined
