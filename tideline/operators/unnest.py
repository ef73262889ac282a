"""Expansion of nested arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_tiles(df: DataFrame, array_col: str = "tiles") -> DataFrame:
    """One row per tile with ``tile_id`` and ``position``.

    A tile without own position takes its offset in the array.
    """
    kept = [c for c in df.columns if c != array_col]
    exploded = df.select(*kept, F.posexplode(array_col).alias("_offset", "_tile"))
    return exploded.select(
        *kept,
        F.col("_tile.id").alias("tile_id"),
        F.coalesce(F.col("_tile.pos"), F.col("_offset")).alias("position"),
    )


def placed_tiles(array_col: str, positions: list[int]) -> Column:
    """Id and position of the tiles at the given positions, for :func:`explode_tiles`.

    It shrinks a ping to what a job reads before the ping is shuffled.
    """
    placed = F.transform(
        array_col, lambda tile, at: F.struct(tile["id"].alias("id"), F.coalesce(tile["pos"], at).alias("pos"))
    )
    return F.filter(placed, lambda tile: tile["pos"].isin(positions))


def slim_events(events: Column | str, category: str, names: list[str], extras: dict[str, Column] | None = None):
    """Array of just the wanted events, reduced to their name and the given extras.

    It shrinks a ping to what a job reads before the ping is shuffled.
    ``extras`` maps an output field to a function of the event's key/value list.
    """
    column = F.col(events) if isinstance(events, str) else events
    wanted = F.filter(column, lambda e: (e["category"] == category) & e["name"].isin(names))
    return F.transform(
        wanted,
        lambda e: F.struct(
            e["name"].alias("event_name"),
            *[build(e["extra"]).alias(field) for field, build in (extras or {}).items()],
        ),
    )


def explode_structs(df: DataFrame, array_col: str) -> DataFrame:
    """One row per struct of the array, its fields as columns."""
    kept = [c for c in df.columns if c != array_col]
    return df.select(*kept, F.inline(array_col))


def explode_matching(df: DataFrame, array_col: str, key: str, value_name: str) -> DataFrame:
    """One row per (key, value) entry with the given key; every match counts."""
    kept = [c for c in df.columns if c != array_col]
    matches = F.filter(F.col(array_col), lambda entry: entry["key"] == key)
    return df.select(*kept, F.explode(F.transform(matches, lambda m: m["value"])).alias(value_name))
