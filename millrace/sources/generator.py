"""Synthetic commerce events, the same for the same seed. Survey id S18."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import commerce_contract as c

#: Events that one task makes.
TASK_ROWS = 250_000


def commerce_events(spark: SparkSession, rows: int, seed: int = 42, null_share: float = 0.15, partitions: int | None = None) -> DataFrame:
    """(event_no, raw_payload): valid events, of which a share has null in one of asin, quantity and city.

    Without ``partitions`` their number grows with the rows: at least 8, and none of more than :data:`TASK_ROWS`.
    """
    partitions = partitions or max(8, -(-rows // TASK_ROWS))
    i = F.col("id")

    def number(name: str, below: int) -> Column:
        return F.pmod(F.xxhash64(i, F.lit(name), F.lit(seed)), F.lit(below)).cast("int")

    def pick(name: str, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), number(name, len(values)) + 1)

    def code(name: str, prefix: str, length: int) -> Column:
        return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(F.concat_ws("|", F.lit(name), F.lit(str(seed)), i.cast("string"))), 1, length)))

    def child(name: str, parent: Column, table: dict[str, list[str]]) -> Column:
        out = None
        for p, children in table.items():
            out = F.when(parent == p, pick(name, children)) if out is None else out.when(parent == p, pick(name, children))
        return out

    # what several fields depend on is a column of its own, so that it is computed once
    base = spark.range(0, rows, 1, partitions).withColumns({
        "_seconds": F.lit(1_672_600_000) + number("time", 63_000_000), "_category": pick("category", list(c.SUBCATEGORIES)),
        "_region": pick("region", list(c.CITIES)), "_quantity": number("quantity", 4) + 1,
        "_price": (number("price", 4_951) * 1000 + 50_000).cast("double"), "_votes": number("votes", 501),
        "_hole": F.when(number("chaos", 1_000_000) < int(null_share * 1_000_000), number("hole", 3)).otherwise(-1),
    })
    seconds, category, region = F.col("_seconds"), F.col("_category"), F.col("_region")
    quantity, price, votes = F.col("_quantity"), F.col("_price"), F.col("_votes")
    fields = {
        "reviewerID": code("reviewer", "", 14), "asin": code("asin", "B0", 8), "reviewerName": code("name", "Reviewer ", 6),
        "helpful": F.array(F.floor(votes / 2).cast("int"), votes), "reviewText": code("text", "Review ", 12),
        "overall": (number("overall", 5) + 1).cast("double"), "summary": code("summary", "Summary ", 8), "unixReviewTime": seconds,
        "reviewTime": F.date_format(F.timestamp_seconds(seconds), "MM dd, yyyy"), "day_diff": number("diff", 1061) + 4,
        "helpful_yes": F.floor(votes / 2).cast("int"), "total_vote": votes, "productName": code("product", "Product ", 6),
        "category": category, "sub_category": child("sub", category, c.SUBCATEGORIES), "brand": child("brand", category, c.USUAL_BRANDS),
        "unitPrice": price, "orderID": code("order", "ORD-", 10), "quantity": quantity, "totalAmount": price * quantity,
        "storeID": F.concat(F.lit("STR-HN-"), (number("store", 10) + 1).cast("string")), "storeName": code("shop", "Store ", 4),
        "city": child("city", region, c.CITIES), "region": region, "storeType": pick("type", c.STORE_TYPES),
        "paymentID": code("payment", "PAY-", 10), "paymentMethod": pick("method", c.PAYMENT_METHODS), "paymentStatus": F.lit(c.PAID),
        "shippingID": code("shipping", "SHP-", 10), "shippingMethod": pick("way", c.SHIPPING_METHODS),
        "carrierName": pick("carrier", c.CARRIERS), "shippingStatus": pick("state", [c.DELIVERED, c.MOVING, c.RETURNED]),
    }
    for k, name in enumerate(("asin", "quantity", "city")):
        fields[name] = F.when(F.col("_hole") != k, fields[name])
    payload = F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]), {"ignoreNullFields": "false"})
    return base.select(i.alias("event_no"), payload.alias("raw_payload"))


def as_log(events: DataFrame, topic: str = "events", partitions: int = 10) -> DataFrame:
    """Events as rows of a partitioned log: topic, partition, offset, timestamp, key, payload."""
    return events.select(
        F.lit(topic).alias("kafka_topic"), F.pmod("event_no", F.lit(partitions)).cast("int").alias("kafka_partition"),
        F.floor(F.col("event_no") / partitions).cast("long").alias("kafka_offset"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("event_no")).alias("kafka_timestamp"),
        F.lit(None).cast("string").alias("message_key"), "raw_payload",
    )
