"""Exact ranks inside groups from histograms of digits, without a global sort.

Rows are counted by the digits of their sort key. Sums over the digits that are smaller, level by level, give the rank of a
bucket's first row; only the rows of one bucket are sorted. A bucket of more than ``most`` rows is not sorted but counted by
further digits, so that neither a hot group nor a hot key meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.staging import Scratch, if_small

#: Rows of a bucket that one task sorts.
BUCKET_ROWS = 1 << 16


def hex_digits(text: Column, first: int, length: int) -> Column:
    """The number that hexadecimal digits of a text stand for, from place ``first``, 1 being the first."""
    return F.conv(F.substring(text, first, length), 16, 10).cast("long")


def id_digits(value: Column) -> list[Column]:
    """A 64-bit number as digits of 16, 16, 16, 8 and 8 bits that order as it does; null comes first."""
    value = value.cast("long")
    top = F.coalesce(F.shiftright(value, 48) + F.lit(32_769), F.lit(0))
    parts = [(32, 65_535), (16, 65_535), (8, 255), (0, 255)]
    return [top.cast("long"), *[F.coalesce(F.shiftright(value, by).bitwiseAND(F.lit(mask)), F.lit(0)).cast("long") for by, mask in parts]]


def byte_digits(value: Column, first: int) -> Column:
    """Two bytes of a text from place ``first`` as one digit; where the text has ended comes before all bytes."""
    data = F.encode(value, "UTF-8")

    def one(at: int) -> Column:
        byte = F.hex(F.substring(data, at, 1))
        return F.when(byte == "", F.lit(0)).otherwise(F.conv(byte, 16, 10).cast("long") + 1)

    return one(first) * F.lit(257) + one(first + 1)


def row_digits(row: Column) -> list[Column]:
    """Digits of ``monotonically_increasing_id``: the partition, then blocks of 4,096 of its rows."""
    return [F.shiftright(row, 33), F.shiftright(row, 12).bitwiseAND(F.lit((1 << 21) - 1))]


def _starts(counts: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """Of each bucket, the number of rows of its key in buckets before it, by sums over siblings on every level."""
    levels = [counts]
    for j in reversed(range(1, len(names))):
        levels.insert(0, levels[0].groupBy(*key, *names[:j]).agg(F.sum("_n").alias("_n")))
    starts = None
    for j, level in enumerate(levels):
        before = Window.partitionBy(*key, *names[:j]).orderBy(names[j]).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        if starts is not None:
            level = level.join(starts, [*key, *names[:j]])
        start = F.col("_before") + F.col("_start") if j else F.col("_before")
        starts = level.select(*key, *names[: j + 1], start.alias("_start"), *(["_n"] if j == len(levels) - 1 else []))
    return starts


def radix_ranks(
    rows: DataFrame, group: Sequence[str], chunks: Sequence[Sequence[Column]], order: Sequence[str], scratch: Scratch,
    most: int = BUCKET_ROWS,
) -> DataFrame:
    """``rows``, best a written table, with _rank, from 0 in each group by ``order``.

    ``chunks`` are the leading digits of ``order``, not null, each list going on where the one before ends; the columns of
    ``group`` must not be null. Rows that a whole chunk leaves in one bucket of over ``most`` rows are told apart by the next
    one; after the last one a bucket is sorted whatever its size. An empty table gives no rows.
    """
    columns, key = rows.columns, list(group)
    rows, done = rows.withColumn("_base", F.lit(0).cast("long")), []
    for i, digits in enumerate(chunks):
        names = [f"_d{i}_{j}" for j in range(len(digits))]
        rows = rows.withColumns(dict(zip(names, digits, strict=True)))
        counts = scratch.write(rows.groupBy(*key, *names).agg(F.count(F.lit(1)).alias("_n")), f"digits-{i}")
        starts = scratch.write(_starts(counts, key, names), f"starts-{i}")
        key = [*key, *names]
        placed = rows.join(if_small(starts), key).withColumn("_base", F.col("_base") + F.col("_start")).drop("_start")
        last = i == len(chunks) - 1 or not starts.filter(F.col("_n") > most).head(1)
        cool = placed if last else placed.filter(F.col("_n") <= most)
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        done.append(cool.select(*columns, (F.col("_base") + nth - 1).alias("_rank")))
        if last:
            break
        rows = scratch.write(placed.filter(F.col("_n") > most).drop("_n"), f"hot-{i}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
