"""Mixing sources to target weights by entropy balancing.

Each document gets a rate ``w = q * exp(lambda_s * x)``, never above ``most``, with ``q`` the overall rate of the mix and
``x`` its size over the mean size in its source: of all rates that meet a source's token target, the ones closest to ``q``
in relative entropy. ``lambda_s`` solves the convex dual, found for all sources at once by Newton steps, each one
aggregation over the histogram of (source, size); a bracket keeps a step from leaving the root. Sums are decimals, so
that the order of partial sums cannot change a result between reruns.

Rates become copies by systematic rounding along the sizes of a source: the running sum of expected copies is rounded,
and a histogram cell takes the difference. The words taken are then off a target by less than about one document. Inside
a cell all documents have the same rate; those with the smallest hash of their id take the cell's odd copies, ranked in
buckets of bounded size.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import one_per_key, row_key
from millrace.plans.staging import Scratch, if_small

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights=(5, 2, 1), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to a table of (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``total`` times all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again by weight. The fixed point is
    ``min(most * size, level * weight)``; the level is found along the sources in the order of their caps per weight. The
    two sorts are over one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    capped = Window.orderBy("_per", F.col("source").asc_nulls_last())
    before = capped.rowsBetween(Window.unboundedPreceding, -1)
    after = capped.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    # the level is that of the first source in the order above whose cap it does not reach
    first = F.struct("_per", F.col("source").isNull().alias("last"), "source", "_level")
    return (
        sources.withColumn("_place", place)
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(most))
        .withColumn("_per", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(everything) * F.lit(total))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after))
        .withColumn("_found", F.min(F.when(F.col("_level") <= F.col("_per"), first)).over(everything))
        .withColumn("target", F.least("_cap", F.coalesce(F.col("_found._level") * F.col("_weight"), F.col("_cap"))))
        .select("source", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=(5, 2, 1),
    total: float = 1.5,
    most: float = 2.0,
    tolerance: float = 1e-7,
    bucket_rows: int = 50_000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, rate, copies, taken, and the columns in ``carry``.

    Null text has size 0. A null source is a source of its own, last in order. Documents of size 0 take no part in the
    balancing and get the copies their rate rounds to; they take 0 words. Rows that repeat an id are documents of their
    own. An empty table gives no rows. Other columns are ignored. The steps go on until the words of every source are within
    ``tolerance`` of its target, or its lambda is known to the last digits.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    size = F.when(F.col(text_col).isNull(), 0).otherwise(F.regexp_count(F.col(text_col), F.lit(WORD))).cast("long")
    sizes = scratch.write(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), size.alias("size"), *carry), "sizes")
    cells = scratch.write(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")

    sources = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("_docs")
    )
    mean = (F.col("source_size") / F.col("_docs")).alias("_mean")
    state = source_targets(sources, weights, total, most).join(
        sources.select(F.col("source").alias("_s"), mean), F.col("source").eqNullSafe(F.col("_s"))
    )
    state = scratch.write(
        state.drop("_s")
        .withColumn("_lambda", F.lit(0.0))
        .withColumn("_low", F.lit(-1e12))
        .withColumn("_high", F.lit(1e12))
        .withColumn("_off", F.lit(1.0)),
        "state",
    )
    known = F.col("_high") - F.col("_low") <= F.greatest(F.lit(1.0), F.abs("_lambda")) * F.lit(1e-13)
    for step in itertools.count():
        # every eighth step halves the bracket, so that the steps end
        state, last = scratch.write(_newton(cells, state, total, most, halve=step % 8 == 7), "state"), state
        scratch.release(last)
        if not state.filter((F.col("_off") > tolerance) & ~known).head(1):
            break

    cells = _with_state(cells, state).withColumn("rate", _rate(total, most))
    along = Window.partitionBy("source").orderBy("size")
    upto = F.floor(F.sum(F.col("n") * F.col("rate")).over(along) + F.lit(0.5)).cast("long")
    cells = cells.withColumn("_upto", upto).withColumn("_copies", F.col("_upto") - F.lag("_upto", 1, 0).over(along))
    # the running sum's rounding may ask one copy too many of a cell; no document takes more than `most`
    cells = scratch.write(
        cells.select(
            "source", "size", "n", "source_size", "target", "rate",
            F.least("_copies", F.col("n") * F.lit(int(most))).alias("_copies"),
            F.ceil(F.col("n") / F.lit(bucket_rows)).alias("_buckets"),
        ),
        "cells",
    )
    c = if_small(cells.withColumnsRenamed({"source": "_s", "size": "_z"}))
    rows = sizes.join(c, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    luck = F.xxhash64(F.col("_id"), F.lit("mix"))
    rows = scratch.write(rows.withColumn("_luck", luck).withColumn("_bucket", F.pmod("_luck", F.col("_buckets"))), "rows")
    # odd copies go to the buckets of a cell in order, and inside a bucket by rank
    cell = ["source", "size"]
    earlier = Window.partitionBy(*cell).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy(*cell, "_bucket").agg(F.count(F.lit(1)).alias("_in"))
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_in").over(earlier), F.lit(0))).drop("_in")
    buckets = buckets.withColumnsRenamed({"source": "_s", "size": "_z", "_bucket": "_b"})
    rank = F.row_number().over(Window.partitionBy(*cell, "_bucket").orderBy("_luck", "_id"))
    rows = rows.withColumn("_rank", rank).join(
        buckets,
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("_bucket") == F.col("_b")),
    )
    base = F.floor(F.col("_copies") / F.col("n"))
    odd = F.col("_copies") - base * F.col("n")
    copies = (base + F.when(F.col("_rank") + F.col("_before") <= odd, 1).otherwise(0)).cast("long")
    return rows.withColumn("copies", copies).select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), *carry,
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: all columns of ``docs`` and copy_no, a row per copy that the mix takes.

    Rows that repeat id and text are joined by what they say: together they get the copies of all of them. Null and empty texts
    have size 0 and the copies that their rate rounds to; null ids and sources are values like others, as in
    :func:`mix_sources`. An empty table gives no rows. A column copy_no is replaced; others may have any name.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    keys, kept = ["_k1", "_k2"], [c for c in docs.columns if c != "copy_no"]
    keyed = docs.select(F.struct(*kept).alias("_row"), *row_key(id_col, text_col))
    asked = keyed.select(*keys, *[F.col("_row")[c].alias(f"_{i}") for i, c in enumerate((id_col, text_col, source_col))])
    mixed = mix_sources(asked, "_0", "_1", "_2", carry=tuple(keys), **how)
    copies = mixed.groupBy(*keys).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    copies = scratch.write(copies, "copies")
    taken = one_per_key(keyed, copies, keys).join(if_small(copies), keys).filter("_copies > 0")
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("copy_no")
    return taken.select(*[F.col("_row")[c].alias(c) for c in kept], number)


def _with_state(cells: DataFrame, state: DataFrame) -> DataFrame:
    state = state.withColumnRenamed("source", "_s")
    return cells.join(state, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def _rate(total: float, most: float):
    """The tilted rate of a document; all at ``most`` where the target is that much of the source."""
    full = F.col("target") >= F.col("source_size") * F.lit(most * (1 - 1e-12))
    x = F.when(F.col("_mean") > 0, F.col("size") / F.col("_mean")).otherwise(F.lit(0.0))
    tilted = F.lit(total) * F.exp(F.least(F.col("_lambda") * x, F.log(F.lit(most / total))))
    return F.when(full, F.lit(float(most))).otherwise(tilted)


def _newton(cells: DataFrame, state: DataFrame, total: float, most: float, halve: bool) -> DataFrame:
    """One step for every source: the words at its lambda, their slope, the bracket, and the next lambda."""
    exact = "decimal(38,9)"
    x = F.when(F.col("_mean") > 0, F.col("size") / F.col("_mean")).otherwise(F.lit(0.0))
    at = _with_state(cells, state).withColumn("rate", _rate(total, most))
    words = F.col("n") * F.col("size") * F.col("rate")
    slope = F.when(F.col("rate") < F.lit(most * (1 - 1e-12)), words * x).otherwise(F.lit(0.0))
    sums = at.groupBy("source").agg(
        F.sum(words.cast("decimal(28,9)")).cast(exact).cast("double").alias("_words"),
        F.sum(slope.cast("decimal(28,9)")).cast(exact).cast("double").alias("_slope"),
    )
    gap = F.col("_words") - F.col("target")
    # a slope of almost nothing sends the step far away; it then counts as outside the bracket
    step = F.col("_lambda") - gap / F.greatest(F.col("_slope"), F.lit(1e-9))
    inside = (step > F.col("_low")) & (step < F.col("_high")) & F.lit(not halve)
    return (
        _with_state(sums, state)
        .withColumn("_low", F.when(gap < 0, F.col("_lambda")).otherwise(F.col("_low")))
        .withColumn("_high", F.when(gap > 0, F.col("_lambda")).otherwise(F.col("_high")))
        .withColumn("_off", F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0)))
        .withColumn("_next", F.when(inside, step).otherwise((F.col("_low") + F.col("_high")) / 2))
        .withColumn("_lambda", F.when(F.col("_off") <= F.lit(1e-12), F.col("_lambda")).otherwise(F.col("_next")))
        .select("source", "source_size", "target", "_mean", "_lambda", "_low", "_high", "_off")
    )
