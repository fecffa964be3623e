"""Typed normalisation of validated rows, and technical dedup. Survey ids P2-P7, P12, A8, Q3-Q5."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.ids import row_hash
from millrace.operators.contract import BUSINESS

LINEAGE = ["kafka_topic", "kafka_partition", "kafka_offset"]

# The typed layer's version and columns, each with the field it is made of and its type.
SILVER_VERSION = "silver-ecommerce-event-v1"
SILVER_FIELDS = {
    "reviewer_id": ("reviewerID", "string"),
    "asin": ("asin", "string"),
    "reviewer_name": ("reviewerName", "string"),
    "helpful": ("helpful", "array<int>"),
    "review_text": ("reviewText", "string"),
    "overall_rating": ("overall", "tinyint"),
    "review_summary": ("summary", "string"),
    "review_timestamp": ("unixReviewTime", "epoch"),
    "review_date": ("reviewTime", "MM dd, yyyy"),
    "day_diff": ("day_diff", "int"),
    "helpful_yes": ("helpful_yes", "int"),
    "total_vote": ("total_vote", "int"),
    "product_name": ("productName", "string"),
    "category": ("category", "string"),
    "sub_category": ("sub_category", "string"),
    "brand": ("brand", "string"),
    "unit_price": ("unitPrice", "decimal(18,2)"),
    "order_id": ("orderID", "string"),
    "quantity": ("quantity", "int"),
    "total_amount": ("totalAmount", "decimal(18,2)"),
    "store_id": ("storeID", "string"),
    "store_name": ("storeName", "string"),
    "city": ("city", "string"),
    "region": ("region", "string"),
    "store_type": ("storeType", "string"),
    "payment_id": ("paymentID", "string"),
    "payment_method": ("paymentMethod", "string"),
    "payment_status": ("paymentStatus", "string"),
    "shipping_id": ("shippingID", "string"),
    "shipping_method": ("shippingMethod", "string"),
    "carrier_name": ("carrierName", "string"),
    "shipping_status": ("shippingStatus", "string"),
}
NOT_STAGED = ("helpful", "review_text", "review_summary", "day_diff")


def normalise(df: DataFrame, mapping: Mapping[str, tuple[str | Column, str]]) -> DataFrame:
    """One projection of renamed, cast columns: target to (source, type).

    Types are Spark types, ``epoch`` (seconds to timestamp) or a date pattern with a comma or a slash; text that does not
    parse becomes null, never an error.
    """

    def typed(source: str | Column, kind: str) -> Column:
        value = F.col(source) if isinstance(source, str) else source
        if kind == "epoch":
            return F.timestamp_seconds(value)
        if kind not in ("", "string") and ("yyyy" in kind):
            return F.try_to_timestamp(value, F.lit(kind)).cast("date")
        return value.try_cast(kind)

    return df.select(*[typed(source, kind).alias(name) for name, (source, kind) in mapping.items()])


def to_silver(bronze: DataFrame, deduplicate: bool = True) -> DataFrame:
    """The 42 typed columns of clean rows; with ``deduplicate``, one row per lineage."""
    payload = {name: (f"payload.{source}", kind) for name, (source, kind) in SILVER_FIELDS.items()}
    lineage = {
        "kafka_topic": ("kafka_topic", "string"), "kafka_partition": ("kafka_partition", "int"),
        "kafka_offset": ("kafka_offset", "long"), "kafka_timestamp": ("kafka_timestamp", "timestamp"),
        "ingested_at": ("ingested_at", "timestamp"), "ingest_date": ("ingest_date", "date"),
        "validation_status": ("validation_status", "string"), "validation_warnings": ("validation_warnings", "array<string>"),
        "source_contract_version": ("contract_version", "string"),
        "silver_schema_version": (F.lit(SILVER_VERSION), "string"),
    }
    silver = normalise(bronze.filter(F.col("validation_status").isin(*BUSINESS)), payload | lineage)
    return one_per_lineage(silver) if deduplicate else silver


def one_per_lineage(df: DataFrame, lineage: Sequence[str] = LINEAGE) -> DataFrame:
    """Technical dedup: one row per place in the log; its copies are equal."""
    return df.dropDuplicates(list(lineage))


def silver_columns() -> list[str]:
    return [
        *SILVER_FIELDS, *LINEAGE, "kafka_timestamp", "ingested_at", "ingest_date", "validation_status",
        "validation_warnings", "source_contract_version", "silver_schema_version",
    ]


def with_row_hash(df: DataFrame, columns: Sequence[str], name: str = "silver_row_hash") -> DataFrame:
    return df.withColumn(name, row_hash(*columns))


def staging_batch(silver: DataFrame, load_batch_id: str) -> DataFrame:
    """Lineage first, the staged columns, the hash of the whole row, and the batch stamp."""
    kept = [c for c in silver_columns() if c not in NOT_STAGED and c not in LINEAGE]
    return with_row_hash(silver, silver_columns()).select(
        *LINEAGE, *kept, "silver_row_hash", F.lit(load_batch_id).alias("load_batch_id"), F.current_timestamp().alias("loaded_at")
    )


def without(df: DataFrame, *columns: str) -> DataFrame:
    """All columns but these (SELECT * EXCEPT)."""
    return df.drop(*columns)
