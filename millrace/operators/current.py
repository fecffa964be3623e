"""Current state, conflicts, dimensions and the calendar. Survey ids A9-A12, A15, W1, W2, O1-O7, F17, F18."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_attributes(df: DataFrame, key: str, attributes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Slowly changing dimension of type 1: the attributes of each key's last row, nulls kept.

    One aggregate, combined before the shuffle; rows without a key make no dimension row.
    """
    last = F.max_by(F.struct(*attributes), F.struct(*order)).alias("_last")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(last).select(key, *[f"_last.{a}" for a in attributes])


def replace_merge(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key, the last by version (nulls first): what a replacing table shows after its merge.

    Most keys have few rows here, and numbering them is then faster than an aggregate of whole rows; for dimensions, whose keys
    have many, it is slower.
    """
    return last_n_per_key(df, keys, [F.desc_nulls_last(c) for c in version], 1)


def conflicts(df: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """Keys with more than one payload version: key columns, versions, payloads (sorted)."""
    # distinct first: the list then holds versions, however often each one was loaded
    versions = df.select(*keys, payload).distinct().groupBy(*keys)
    found = versions.agg(F.count(payload).alias("versions"), F.sort_array(F.collect_list(payload)).alias("payloads"))
    return found.filter("versions > 1")


def unconflicted(df: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """Rows of keys with exactly one stored row: a key in conflict loses all its rows, not only the losers.

    ``df`` has one row per key and payload, as :func:`replace_merge` on both leaves it.
    """
    every = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_versions", every).filter("_versions = 1").drop("_versions")


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first n rows of an order, without sorting the rest."""
    return df.orderBy(*order).limit(n)


def text_order(*columns: str) -> list:
    """Ascending sort columns in which a null text counts as an empty one."""
    return [F.coalesce(c, F.lit("")) for c in columns]


def last_ascending(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of an order, in that order."""
    return top_n(df, [F.desc(c) for c in order], n).orderBy(*order)


def merge_top_n(kept: DataFrame, batch: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The bounded list after a batch: both together, cut again."""
    return top_n(kept.unionByName(batch), order, n)


def last_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first n rows of each key; Spark cuts each task's share of a key to n before it is shuffled."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")


def calendar(df: DataFrame, column: str) -> DataFrame:
    """A row per day from the first to the last date of a column. Weeks are ISO weeks and Monday is day 1."""
    bounds = df.agg(F.min(F.col(column).cast("date")).alias("low"), F.max(F.col(column).cast("date")).alias("high"))
    days = bounds.filter("low is not null").select(F.explode(F.sequence("low", "high")).alias("date"))
    weekday = F.weekday("date") + 1
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.weekofyear("date").alias("week_of_year"),
        weekday.alias("day_of_week"),
        (weekday >= 6).alias("is_weekend"),
    )


def ordered_layout(df: DataFrame, partition: str, order: Sequence[str]) -> DataFrame:
    """Rows grouped by partition value and sorted inside, for a partitioned write with useful min/max statistics."""
    return df.repartition(partition).sortWithinPartitions(partition, *order)
