"""The four reconciliations between the layers, each as one table of (check, violations). Survey ids Q6-Q9, P11, P13.

They are compositions of the operators in :mod:`millrace.operators.reconcile` and :mod:`millrace.operators.checks`. A check
with no violations has a row too; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import checks, contract, current, metrics, normalize, reconcile

KEY = normalize.LINEAGE
# Columns that the read model's list of newest events must not show.
FORBIDDEN = ("raw_payload", "reviewerID", "reviewerName", "reviewText", "summary")


def counted(found: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations): the number of rows of each table of violations."""
    rows = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in found.items()]
    return reduce(DataFrame.unionByName, rows)


def log_split(log: DataFrame, bronze: DataFrame, dlq: DataFrame) -> DataFrame:
    """The log against its clean and dead-letter tables: every row in exactly one of them, unchanged, and routed by its status."""
    parts = bronze.select(*KEY, "raw_payload", "message_key").unionByName(dlq.select(*KEY, "raw_payload", "message_key"))
    status, lines = F.col("validation_status"), ["raw_payload", "message_key"]
    return counted(
        {
            "log_duplicates": checks.duplicate_keys(log, KEY),
            "bronze_duplicates": checks.duplicate_keys(bronze, KEY),
            "dlq_duplicates": checks.duplicate_keys(dlq, KEY),
            "overlap": reconcile.overlap(bronze, dlq, KEY),
            "missing": reconcile.missing(log, parts, KEY),
            "extra": reconcile.missing(parts, log, KEY),
            "payload_changed": reconcile.mismatches(log, parts.dropDuplicates(KEY), KEY, lines),
            "bronze_misrouted": bronze.filter(~status.isin(*contract.BUSINESS) | status.isNull()),
            "dlq_misrouted": dlq.filter((status != "INVALID") | status.isNull()),
            "bronze_inconsistent": contract.inconsistent(bronze),
            "dlq_inconsistent": contract.inconsistent(dlq),
            "bronze_partition": bronze.filter(~F.col("ingest_date").eqNullSafe(F.to_date("ingested_at"))),
            "dlq_partition": dlq.filter(~F.col("ingest_date").eqNullSafe(F.to_date("ingested_at"))),
            "contract_versions": parts.sparkSession.createDataFrame([], "v string").unionByName(
                bronze.select(F.col("contract_version").alias("v")).unionByName(dlq.select(F.col("contract_version").alias("v"))).distinct()
            ).agg(F.count_distinct("v").alias("n")).filter("n > 1"),
        }
    )


def bronze_silver(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Clean rows against typed ones: same keys, same values once typed, same columns and types."""
    expected = normalize.to_silver(bronze)
    columns = [c for c in expected.columns if c not in KEY]
    wrong = checks.schema_differences(silver.schema, expected.schema)
    return counted(
        {
            "missing": reconcile.missing(expected, silver, KEY),
            "extra": reconcile.missing(silver, expected, KEY),
            "duplicates": checks.duplicate_keys(silver, KEY),
            "values": reconcile.mismatches(expected, silver.dropDuplicates(KEY), KEY, [c for c in columns if c in silver.columns]),
            "schema": silver.sparkSession.createDataFrame(wrong, "column string, difference string"),
        }
    )


def silver_gold(silver: DataFrame, staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Typed rows against staging by row hash, and staging without conflicts against the fact by keys and totals."""
    hashed = normalize.with_row_hash(silver, normalize.silver_columns()).select(*KEY, "silver_row_hash")
    merged = current.replace_merge(staging, [*KEY, "silver_row_hash"], ["loaded_at", "load_batch_id"])
    shown = current.unconflicted(merged, KEY, "silver_row_hash")
    totals = {
        "rows": F.count(F.lit(1)), "quantity": F.sum("quantity"), "amount": F.sum("total_amount"), "rating": F.sum(F.col("overall_rating").cast("long")),
    }
    return counted(
        {
            "staging_missing": reconcile.missing(hashed, staging, KEY),
            "staging_extra": reconcile.missing(staging.select(*KEY).distinct(), hashed, KEY),
            "hash_changed": reconcile.missing(hashed, staging, [*KEY, "silver_row_hash"]),
            "conflicts": current.conflicts(staging, KEY, "silver_row_hash"),
            "fact_missing": reconcile.missing(shown, fact, KEY),
            "fact_extra": reconcile.missing(fact, shown, KEY),
            "fact_duplicates": checks.duplicate_keys(fact, KEY),
            "totals": reconcile.kpi_parity(shown, fact, totals).filter("not agree"),
        }
    )


def read_model(
    validated: DataFrame, paid: str, minutes: DataFrame, latest: DataFrame, latest_rows: int = 100, summary: DataFrame | None = None,
    health: DataFrame | None = None, has_marker: Callable[[int], bool] | None = None,
) -> DataFrame:
    """The serving tables against what the validated rows say: minutes, sums to a thousandth, and the list of newest rows.

    ``summary``: the one row of all sums. ``health``: the row of the last batch, which must be OK, have numbers of its batch and rows
    and, by ``has_marker``, name a batch that is applied for good.
    """
    expected = metrics.commerce_minutes(validated, paid)
    key, measures = "ingest_minute", [c for c in expected.columns if c != "ingest_minute"]
    loose = {c: 0.001 for c in measures if dict(expected.dtypes)[c] == "double"}
    business = validated.filter(F.col("validation_status").isin(*contract.BUSINESS)).agg(F.count(F.lit(1)).alias("n"))
    shown = latest.agg(F.count(F.lit(1)).alias("shown"))
    forbidden = [(c,) for c in latest.columns if c in FORBIDDEN]
    more = {}
    if summary is not None:
        one = F.lit(1).alias("_one")
        sums = expected.agg(*[F.sum(m).alias(m) for m in measures]).select(one, "*")
        more["summary_changed"] = reconcile.mismatches(sums, summary.select(one, *measures), ["_one"], measures, loose)
    if health is not None:
        batch, rows = F.col("last_batch_id"), F.col("last_input_rows")
        wrong = (F.col("status") != "OK") | batch.isNull() | rows.isNull() | (batch < 0) | (rows < 0)
        more["health_not_ok"] = health.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("wrong")).filter("n <> 1 or wrong > 0")
        last = health.agg(F.max("last_batch_id")).first()[0]
        lost = [(last,)] if has_marker is not None and last is not None and not has_marker(last) else []
        more["marker_missing"] = minutes.sparkSession.createDataFrame(lost, "batch long")
    return counted(
        more
        | {
            "minutes_missing": reconcile.missing(expected, minutes, [key]),
            "minutes_extra": reconcile.missing(minutes, expected, [key]),
            "minutes_changed": reconcile.mismatches(expected, minutes, [key], measures, loose),
            "latest_length": business.crossJoin(shown).filter(F.col("shown") != F.least("n", F.lit(latest_rows))),
            "latest_forbidden": minutes.sparkSession.createDataFrame(forbidden, "column string"),
        }
    )
