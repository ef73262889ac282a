"""First or last rows of a group by a sort order.

All helpers filter a row number directly above its window, so Spark plans a
group limit in front of the shuffle: a map task sends at most ``n`` rows of a
group, whatever share of the rows the group holds. Name the key with the most values
first: the sorts compare its first bytes before anything else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_rank"


def _columns(names: Sequence[str | Column] | str | Column) -> list[Column]:
    if isinstance(names, (str, Column)):
        names = [names]
    return [F.col(n) if isinstance(n, str) else n for n in names]


def top_n_per_group(df: DataFrame, group, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in the given order."""
    window = Window.partitionBy(*_columns(group)).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys,
    order_col: str,
    tie_break: Sequence[str] | str = (),
    ascending: bool = False,
    nulls_first: bool = False,
) -> DataFrame:
    """One row per key: the last by ``order_col``, or the first with ``ascending``.

    Rows of equal ``order_col`` are told apart by ``tie_break``, so that the
    result does not depend on the order of partitions.
    """
    ties = _columns(tie_break) if tie_break else []
    column = F.col(order_col)
    if ascending:
        order = [column.asc_nulls_last(), *[t.asc() for t in ties]]
    else:
        first = column.desc_nulls_first() if nulls_first else column.desc_nulls_last()
        order = [first, *[t.desc() for t in ties]]
    return top_n_per_group(df, keys, order, 1)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top ``k``; plans as TakeOrderedAndProject, not as a full sort."""
    return df.orderBy(*order).limit(k)
