"""Ordered steps with gates, and the medallion refresh built of them. Survey §2.12."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import checks, current, normalize, reconcile
from millrace.plans.staging import Scratch


@dataclass(frozen=True)
class Step:
    """``run`` gets the results of the steps so far by name. ``retries``: further attempts after a failure."""

    name: str
    run: Callable[[Mapping[str, Any]], Any]
    retries: int = 1


@dataclass
class Pipeline:
    steps: Sequence[Step]
    done: list[str] = field(default_factory=list)

    def execute(self) -> dict[str, Any]:
        """Runs the steps in order; the first that fails for good stops the rest."""
        results: dict[str, Any] = {}
        for step in self.steps:
            for attempt in range(step.retries + 1):
                try:
                    results[step.name] = step.run(results)
                    break
                except Exception as error:
                    if attempt == step.retries:
                        raise RuntimeError(f"step {step.name} failed") from error
            self.done.append(step.name)
        return results


def current_rows(staged: DataFrame) -> DataFrame:
    """The last stored row of each lineage whose rows all have one hash: one shuffle, merge and conflicts in one aggregate."""
    rest = [c for c in staged.columns if c not in normalize.LINEAGE]
    merged = staged.groupBy(*normalize.LINEAGE).agg(
        F.min("silver_row_hash").alias("_low"), F.max("silver_row_hash").alias("_high"),
        F.max_by(F.struct(*rest), F.struct("loaded_at", "load_batch_id")).alias("_row"),
    )
    return merged.filter("_low = _high").select(*normalize.LINEAGE, *[f"_row.{c}" for c in rest])


def star_schema(staged: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and fact from staged rows: one stored row per lineage, keys in conflict left out.

    The rows that all five tables are made of are written once.
    """
    rows = Scratch(staged.sparkSession, "star").write(current_rows(staged), "rows")
    order = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
    # The fact's columns.
    fact = [
        *normalize.LINEAGE, "asin", "store_id", "reviewer_id", "review_date", "review_timestamp", "order_id", "payment_id",
        "shipping_id", "unit_price", "quantity", "total_amount", "overall_rating", "helpful_yes", "total_vote", "payment_method",
        "payment_status", "shipping_method", "carrier_name", "shipping_status", "kafka_timestamp", "ingested_at", "ingest_date",
        "validation_status",
    ]
    return {
        "dim_product": current.latest_attributes(rows, "asin", ["product_name", "category", "sub_category", "brand"], order),
        "dim_store": current.latest_attributes(rows, "store_id", ["store_name", "city", "region", "store_type"], order),
        "dim_reviewer": current.latest_attributes(rows, "reviewer_id", ["reviewer_name"], order),
        "dim_date": current.calendar(rows, "review_date"),
        "fact_ecommerce_event": rows.select(*fact),
    }


def star_checks(staged: DataFrame, star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Violations between staging and a star: not empty, no conflicts, unique keys, no orphans, equal totals."""
    fact = star["fact_ecommerce_event"]
    keys = {"dim_product": "asin", "dim_store": "store_id", "dim_reviewer": "reviewer_id"}
    totals = {"n": F.count(F.lit(1)), "quantity": F.sum("quantity"), "amount": F.sum("total_amount"), "rating": F.avg("overall_rating")}
    merged = current.replace_merge(staged, [*normalize.LINEAGE, "silver_row_hash"], ["loaded_at", "load_batch_id"])
    return {
        "not_empty": fact.agg(F.count(F.lit(1)).alias("n")).filter("n = 0"),
        "no_conflicts": current.conflicts(staged, normalize.LINEAGE, "silver_row_hash"),
        "unique_lineage": checks.duplicate_keys(fact, normalize.LINEAGE),
        "no_orphans": reconcile.orphans(fact, {k: (star[d], k) for d, k in keys.items()}),
        "dates_known": checks.unrelated(fact, "review_date", star["dim_date"], "date"),
        "equal_totals": reconcile.kpi_parity(merged, fact, totals).filter("not agree"),
    } | {f"unique_{d}": checks.duplicate_keys(star[d], [k]) for d, k in keys.items()}


def publish_gates(staged: DataFrame) -> Callable[[Mapping[str, DataFrame]], object]:
    """Fails if a star that was written breaks one of :func:`star_checks`."""
    return lambda star: checks.require(star_checks(staged, star))
