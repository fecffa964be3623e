"""Exact dedup: a tree merge of sorted digest runs.

Every row's text becomes a digest. Rows are dealt into ``P = fan_in ** rounds`` runs; a run holds one entry per digest.
In each round, the ``fan_in`` runs that differ in one digit of their number exchange entries, each receiving those whose
digest has its digit, and merge the sorted pieces: equal digests become one entry with the kept identifier and the summed
count. After the last round each run holds one range of digests, merged over all runs. No run is ever held by one task
beyond its share, and a digest that a third of all rows have is one entry per run from the first level on.

The result comes back down the same tree: entries meet their winner by digest (at most ``P`` entries each), rows meet
their own run's entry by (run, digest), so that a hot digest is spread over all runs there too.

An entry is verified at every level: entries merge only if SHA-256, byte length and a second, independent 64-bit
hash of the text all agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.staging import Scratch

VERIFIED = ["_digest", "_bytes", "_check"]


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=lambda text: text,
    fan_in: int = 8,
    run_rows: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``keep``: whether the smallest or largest id of equal texts stays. ``normalise``: Column to Column, applied to the
    text before it is compared. Null text equals the empty text. Null ids lose to all others; if all ids of a group are
    null, keep_id is null. Of rows that repeat id and text, exactly one is kept. An empty table gives no rows; other columns
    are ignored, whatever their names.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "exact-dedup")
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    digests = scratch.write(
        docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
            "_id",
            F.monotonically_increasing_id().alias("_row"),
            F.unhex(F.sha2("_text", 256)).alias("_digest"),
            F.octet_length("_text").alias("_bytes"),
            F.xxhash64("_text").alias("_check"),
        ),
        "digests",
    )
    rounds = max(2, math.ceil(math.log(max(1, digests.count() / run_rows), fan_in)))
    runs = fan_in**rounds
    digests = digests.withColumn("_run", F.pmod(F.xxhash64("_row"), F.lit(runs)))

    # Null ids lose: they order below every id for "largest" and above every id for "smallest".
    pick, first = (F.max, F.col("_id").isNotNull()) if keep == "largest" else (F.min, F.col("_id").isNull())
    leaves = digests.groupBy("_run", *VERIFIED).agg(
        pick(F.struct(first.alias("first"), "_id", "_row")).alias("_best"), F.count(F.lit(1)).alias("_n")
    )
    leaves = scratch.write(leaves, "leaves")
    entries = leaves
    for level in range(rounds):
        entries = _merge_round(entries, level, fan_in, runs, pick)
    winners = entries.select(*VERIFIED, F.col("_best").alias("_won"), F.col("_n").alias("_size"))
    by_run = leaves.select("_run", *VERIFIED).join(winners, VERIFIED)
    return digests.join(by_run, ["_run", *VERIFIED]).select(
        F.col("_id").alias(id_col),
        F.col("_won._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_won._row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def _merge_round(entries: DataFrame, level: int, fan_in: int, runs: int, pick) -> DataFrame:
    """Runs that differ in digit ``level`` exchange entries by the same digit of the digest's home run, and merge."""
    weight = fan_in**level
    home = F.pmod(F.xxhash64("_digest"), F.lit(runs))

    def digit(number: Column) -> Column:
        return F.floor(number / F.lit(weight)) % F.lit(fan_in)

    moved = F.col("_run") + (digit(home) - digit(F.col("_run"))) * F.lit(weight)
    return (
        entries.withColumn("_run", moved.cast("long"))
        .repartition(F.col("_run"))
        .sortWithinPartitions("_run", *VERIFIED)
        .groupBy("_run", *VERIFIED)
        .agg(pick("_best").alias("_best"), F.sum("_n").alias("_n"))
    )
