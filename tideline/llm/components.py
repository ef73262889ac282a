"""Connected components of links between ids, by alternating stars on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges; both stand still once the stars do."""
    mix = F.xxhash64("big", "small").cast("decimal(38,0)")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(mix).alias("mix")).first()
    return row["n"], row["mix"]


def components(links: DataFrame) -> DataFrame:
    """Label of every linked id, (``id``, ``label``): the smallest id it is connected with, itself left out.

    ``links`` has columns ``a`` and ``b`` in any order; rows may repeat, rows with a null
    or with equal ends say nothing. Each round joins the neighbours of an id to their
    smallest, first the larger ones, then the smaller ones; the rounds grow with the
    logarithm of the longest path. An id's neighbours are only ever minimised and joined,
    never gathered, and each round starts from a written table.
    """
    big, small = F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")
    edges = written(links.filter("a <> b").select(big, small).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("small", "big")).toDF("u", "v")
        least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
        least = least.select("_u", F.least("m", "_u").alias("m"))
        # Larger neighbours (and the id itself) are joined to the smallest of all.
        large = both.join(least, F.col("u") == F.col("_u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
        # Smaller neighbours are joined to the smallest of them, and the id as well.
        joined = large.join(least, F.col("u") == F.col("_u"))
        pairs = joined.select(F.col("v").alias("big"), F.col("m").alias("small")).union(least.select("_u", "m"))
        edges = written(pairs.filter("big <> small").distinct(), "links")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("big").alias("id"), F.col("small").alias("label"))
        state = now
