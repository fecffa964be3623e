"""Queries of the commerce contract's flow: validation, layers, metrics, streams, star schema, reconciliations and alerts.

Every event of the table becomes a log row with a commerce payload; ``FAULTS`` says, by event_id, what is wrong with it and which
codes that must give. The SQL knows only that table, the formulas of the few varying fields, and the counts that follow.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.commerce_contract import COMMERCE, DELIVERED, FAILED, PAID, PENDING
from millrace.operators import alerts, contract, metrics, normalize
from millrace.plans import pipeline, reconciliation
from millrace.plans.staging import Scratch
from millrace.registry import query
from millrace.sources import tables
from millrace.streaming import ingest

_I = "event_id"
#: The fields of a valid event, as SQL over event_id.
VALID = {
    "reviewerID": f"lpad(cast({_I} % 70 as string), 14, '0')", "asin": f"concat('B0', lpad(cast({_I} % 50 as string), 8, '0'))",
    "reviewerName": "'Someone'", "helpful": f"array(cast({_I} % 200 as int), cast(200 + {_I} % 300 as int))", "reviewText": "'A text'",
    "overall": f"cast(1 + {_I} % 5 as double)", "summary": "'Words'", "unixReviewTime": f"1672600000L + {_I} % 1000 * 3600",
    "reviewTime": f"date_format(timestamp_seconds(1672600000L + {_I} % 1000 * 3600), 'MM dd, yyyy')", "day_diff": "1064",
    "helpful_yes": f"cast({_I} % 200 as int)", "total_vote": f"cast(200 + {_I} % 300 as int)", "productName": f"concat('Product ', {_I})",
    "category": "'Điện tử'", "sub_category": "'Laptop'", "brand": "'Sony'", "unitPrice": f"cast(50000 + {_I} % 100 * 1000 as double)",
    "orderID": "'ORD-A000000000'", "quantity": f"cast(1 + {_I} % 4 as int)",
    "totalAmount": f"cast((50000 + {_I} % 100 * 1000) * (1 + {_I} % 4) as double)", "storeID": f"concat('STR-HN-', 1 + {_I} % 10)",
    "storeName": f"concat('Store ', {_I})", "city": "'Hà Nội'", "region": "'Miền Bắc'", "storeType": "'Web Online'",
    "paymentID": "'PAY-A000000000'", "paymentMethod": "'Momo'", "paymentStatus": f"'{PAID}'", "shippingID": "'SHP-A000000000'",
    "shippingMethod": "'Tiêu chuẩn'", "carrierName": "'Viettel Post'", "shippingStatus": f"'{DELIVERED}'",
}
W101, W102 = "W101_UNUSUAL_BRAND_CATEGORY", "W102_PAYMENT_SHIPPING_INCONSISTENT"
#: (changed fields or, under the empty name, the whole text as SQL over ``payload``; errors; warnings), by event_id modulo their number.
FAULTS = [
    ({}, "", ""), ({"reviewerID": "'short'"}, "E101_REVIEWER_ID_PATTERN", ""), ({"asin": "'X'"}, "E102_ASIN_PATTERN", ""),
    ({"reviewText": "'  '"}, "E103_REVIEW_TEXT_EMPTY", ""), ({"overall": "4.5D"}, "E104_OVERALL_RANGE", ""), ({"summary": "''"}, "E105_SUMMARY_EMPTY", ""),
    ({"unixReviewTime": "1L"}, "E106_REVIEW_TIME_RANGE", ""), ({"day_diff": "3"}, "E107_DAY_DIFF_RANGE", ""), ({"helpful_yes": "501"}, "E108_HELPFUL_YES_RANGE", ""),
    ({"total_vote": "501"}, "E109_TOTAL_VOTE_RANGE", ""), ({"productName": "''"}, "E110_PRODUCT_NAME_EMPTY", ""), ({"category": "'Unknown'"}, "E111_CATEGORY_ENUM", W101),
    ({"sub_category": "'Unknown'"}, "E112_SUBCATEGORY_ENUM", ""), ({"brand": "'Unknown'"}, "E113_BRAND_ENUM", W101), ({"unitPrice": "49999D"}, "E114_UNIT_PRICE_RANGE", ""),
    ({"orderID": "'ORD-1'"}, "E115_ORDER_ID_PATTERN", ""), ({"quantity": "5"}, "E116_QUANTITY_RANGE", ""), ({"totalAmount": "1D"}, "E117_TOTAL_AMOUNT_RANGE", ""),
    ({"storeID": "'STR-A-11'"}, "E118_STORE_ID_PATTERN", ""), ({"storeName": "' '"}, "E119_STORE_NAME_EMPTY", ""), ({"city": "'Unknown'"}, "E120_CITY_ENUM", ""),
    ({"region": "'Unknown'"}, "E121_REGION_ENUM", ""), ({"storeType": "'Unknown'"}, "E122_STORE_TYPE_ENUM", ""), ({"paymentID": "'1'"}, "E123_PAYMENT_ID_PATTERN", ""),
    ({"paymentMethod": "'Gold'"}, "E124_PAYMENT_METHOD_ENUM", ""), ({"paymentStatus": "'?'"}, "E125_PAYMENT_STATUS_ENUM", ""), ({"shippingID": "'2'"}, "E126_SHIPPING_ID_PATTERN", ""),
    ({"shippingMethod": "'Foot'"}, "E127_SHIPPING_METHOD_ENUM", ""), ({"carrierName": "'Nobody'"}, "E128_CARRIER_ENUM", ""), ({"shippingStatus": "'Lost'"}, "E129_SHIPPING_STATUS_ENUM", ""),
    ({"helpful": "array(1)"}, "E130_HELPFUL_SHAPE", ""), ({"totalAmount": VALID["totalAmount"] + " + 1D"}, "E201_TOTAL_AMOUNT_MISMATCH", ""),
    ({"helpful": "array(499, 1)"}, "E202_HELPFUL_MISMATCH", ""), ({"helpful": "array(400, 300)", "helpful_yes": "400", "total_vote": "300"}, "E203_HELPFUL_EXCEEDS_TOTAL", ""),
    ({"category": "'Thời trang'"}, "E204_CATEGORY_SUBCATEGORY_MISMATCH", W101), ({"region": "'Miền Nam'"}, "E205_REGION_CITY_MISMATCH", ""),
    ({"reviewTime": "'01 01, 2020'"}, "E206_REVIEW_TIME_MISMATCH", ""), ({"brand": "'Nike'"}, "", W101), ({"paymentStatus": f"'{FAILED}'"}, "", W102),
    ({"paymentStatus": f"'{PENDING}'"}, "", W102), ({"brand": "'Nike'", "paymentStatus": f"'{FAILED}'"}, "", f"{W101},{W102}"), ({"reviewerName": "null"}, "", ""),
    ({"asin": "null"}, "E006_REQUIRED_NULL", ""), ({"quantity": "null", "brand": "'Nike'"}, "E006_REQUIRED_NULL", ""), ({"quantity": "5", "brand": "'Nike'"}, "E116_QUANTITY_RANGE", W101),
    ({"quantity": "5", "city": "'Unknown'"}, "E116_QUANTITY_RANGE,E120_CITY_ENUM", ""), ({"helpful": "array(499, 1)", "region": "'Miền Nam'"}, "E202_HELPFUL_MISMATCH,E205_REGION_CITY_MISMATCH", ""),
    ({"": "substring(payload, 1, 50)"}, "E001_MALFORMED_JSON", ""), ({"": "cast(null as string)"}, "E001_MALFORMED_JSON", ""), ({"": "concat('[', payload, ']')"}, "E002_TOP_LEVEL_NOT_OBJECT", ""),
    ({"": "replace(payload, '\"summary\":', '\"resume\":')"}, "E003_MISSING_FIELDS,E004_UNEXPECTED_FIELDS", ""), ({"": "replace(payload, '{\"r', '{\"x\":1,\"r')"}, "E004_UNEXPECTED_FIELDS", ""),
    ({"": "replace(payload, '\"day_diff\":1064', '\"day_diff\":\"1064\"')"}, "E005_TYPE_MISMATCH", ""), ({"": "replace(payload, '\"day_diff\":1064', '\"day_diff\":1064.5')"}, "E005_TYPE_MISMATCH", ""),
]
_N = len(FAULTS)
_SQL = f"""
    WITH f(k, errors, warnings, paid) AS (VALUES {', '.join(f"({k}, '{e}', '{w}', {str('paymentStatus' not in c).lower()})" for k, (c, e, w) in enumerate(FAULTS))}),
    v AS (
        SELECT event_id, event_id % 8 AS kafka_partition, event_id // 8 AS kafka_offset, ts, errors, warnings, paid, k,
               CASE WHEN errors <> '' THEN 'INVALID' WHEN warnings <> '' THEN 'WARNING' ELSE 'VALID' END AS status,
               1 + event_id % 4 AS quantity, 50000 + event_id % 100 * 1000 AS price, 1 + event_id % 5 AS rating
        FROM events JOIN f ON event_id % {_N} = k
    ),
    b AS (SELECT * FROM v WHERE status <> 'INVALID')
"""


#: Batches that the streams take the log in, each of as many files as there are cores.
BATCHES = 3


def _log(t) -> DataFrame:
    """The events as rows of a partitioned log, with their payloads; written, so that plans start from text as in a real log."""
    k = F.col(_I) % _N

    def field(name: str):
        value = F.expr(VALID[name])
        for i, (changes, _, _) in enumerate(FAULTS):
            if name in changes:
                value = F.when(k == i, F.expr(changes[name])).otherwise(value)
        return value.alias(name)

    payload = F.to_json(F.struct(*[field(f.name) for f in COMMERCE.fields]), {"ignoreNullFields": "false"})
    events = t("events")
    events = events.repartition(BATCHES * events.sparkSession.sparkContext.defaultParallelism)
    rows = events.select(_I, F.col("ts").cast("timestamp").alias("kafka_timestamp"), payload.alias("payload"))
    raw = F.col("payload")
    for i, (changes, _, _) in enumerate(FAULTS):
        if "" in changes:
            raw = F.when(k == i, F.expr(changes[""])).otherwise(raw)
    made = rows.select(
        F.lit("events").alias("kafka_topic"), (F.col(_I) % 8).cast("int").alias("kafka_partition"), F.expr(f"{_I} div 8").alias("kafka_offset"),
        "kafka_timestamp", F.lit(None).cast("string").alias("message_key"), raw.alias("raw_payload"), _I,
    )
    return Scratch(made.sparkSession, "commerce").write(made, "log")


def _validated(t) -> DataFrame:
    return contract.validate_json(_log(t), COMMERCE).withColumn("ingest_date", F.to_date("ingested_at"))


def _joined(name: str):
    return F.array_join(name, ",")


@query(_SQL + "SELECT event_id, errors, warnings, status FROM v")
def commerce_contract(t):
    return _validated(t).select(
        _I, _joined("validation_errors").alias("errors"), _joined("validation_warnings").alias("warnings"), F.col("validation_status").alias("status")
    )


@query(_SQL + """SELECT code, count(*) AS rows FROM (SELECT unnest(string_split(warnings, ',')) AS code FROM v WHERE warnings <> '') GROUP BY 1""")
def commerce_warning_counts(t):
    return contract.rule_counts(_validated(t), "validation_warnings")


_MINUTES = """SELECT strftime(ts, '%Y%m%d%H%M') AS ingest_minute, count(*) AS events_total, count(*) FILTER (status = 'VALID') AS valid_count,
       count(*) FILTER (status = 'WARNING') AS warning_count, count(*) FILTER (status = 'INVALID') AS invalid_count,
       count(*) FILTER (status <> 'INVALID') AS record_count, CAST(sum(CASE WHEN status <> 'INVALID' THEN quantity ELSE 0 END) AS BIGINT) AS quantity_sum,
       CAST(sum(CASE WHEN status <> 'INVALID' THEN price * quantity ELSE 0 END) AS DOUBLE) AS gross_item_value,
       CAST(sum(CASE WHEN status <> 'INVALID' AND paid THEN price * quantity ELSE 0 END) AS DOUBLE) AS successful_labeled_value,
       CAST(sum(CASE WHEN status <> 'INVALID' THEN rating ELSE 0 END) AS DOUBLE) AS rating_sum,
       count(*) FILTER (status <> 'INVALID') AS rating_count FROM v GROUP BY 1"""


@query(_SQL + _MINUTES)
def commerce_minutes(t):
    return metrics.commerce_minutes(_validated(t), PAID)


_SILVER = """SELECT kafka_partition::INTEGER AS kafka_partition, kafka_offset, lpad((event_id % 70)::VARCHAR, 14, '0') AS reviewer_id,
       CASE WHEN k = {nameless} THEN NULL ELSE 'Someone' END AS reviewer_name, rating::INTEGER AS rating, quantity::INTEGER AS quantity,
       price || '.00' AS unit_price, strftime(make_timestamp((1672600000 + event_id % 1000 * 3600) * 1000000), '%Y-%m-%d') AS review_date,
       1672600000 + event_id % 1000 * 3600 AS review_seconds, status, warnings FROM b""".format(
    nameless=next(i for i, (c, _, _) in enumerate(FAULTS) if "reviewerName" in c)
)


def _shown(silver: DataFrame) -> DataFrame:
    return silver.select(
        "kafka_partition", "kafka_offset", "reviewer_id", "reviewer_name", F.col("overall_rating").cast("int").alias("rating"), "quantity",
        F.col("unit_price").cast("string").alias("unit_price"), F.col("review_date").cast("string").alias("review_date"),
        F.unix_timestamp("review_timestamp").alias("review_seconds"), F.col("validation_status").alias("status"),
        _joined("validation_warnings").alias("warnings"),
    )


@query(_SQL + _SILVER)
def commerce_silver(t):
    bronze = contract.route(_validated(t))[0]
    bronze = Scratch(bronze.sparkSession, "commerce-bronze").write(bronze, "bronze")  # read twice, validated once
    return _shown(normalize.to_silver(bronze.unionByName(bronze)))


# ---- streams: each runs to its end in the shared folder, and what it has written is read back

_ONCE = {"availableNow": True}


def _log_stream(rows: DataFrame) -> DataFrame:
    """The files of a log as a stream."""
    spark = rows.sparkSession
    return ingest.file_stream(spark, rows._millrace_path, spark.sparkContext.defaultParallelism)


def _landed(t, label: str) -> tuple[Scratch, DataFrame]:
    """The log, and the layers that two streaming queries have made of its files."""
    rows = _log(t)
    scratch, stream = Scratch(rows.sparkSession, label), _log_stream(rows).drop(_I)
    for _ in range(2):  # the second run resumes from the checkpoints and finds nothing new
        both = ingest.start_ingest(stream, COMMERCE, f"{scratch.folder}/bronze", f"{scratch.folder}/dlq", f"{scratch.folder}/checkpoints", _ONCE)
        for q in both:
            q.awaitTermination()
    return scratch, rows


@query(_SQL + "SELECT kafka_partition::INTEGER AS kafka_partition, kafka_offset, errors, warnings, status, status <> 'INVALID' AS clean FROM v")
def stream_two_sinks(t):
    scratch, _ = _landed(t, "stream-sinks")

    def layer(name: str, clean: bool) -> DataFrame:
        return scratch.read(name).select(
            "kafka_partition", "kafka_offset", _joined("validation_errors").alias("errors"), _joined("validation_warnings").alias("warnings"),
            F.col("validation_status").alias("status"), F.lit(clean).alias("clean"),
        )

    return layer("bronze", True).unionByName(layer("dlq", False))


@query(_SQL + "SELECT status AS validation_status, count(*) AS rows FROM v GROUP BY 1")
def stream_committed_counts(t):
    scratch, rows = _landed(t, "stream-commits")
    spark = rows.sparkSession
    both = [tables.committed_status_counts(spark, f"{scratch.folder}/{name}") for name in ("bronze", "dlq")]
    return both[0].unionByName(both[1])


@query(_SQL + _SILVER)
def stream_silver(t):
    scratch, rows = _landed(t, "stream-silver")
    ingest.silver_increment(rows.sparkSession, f"{scratch.folder}/bronze", f"{scratch.folder}/silver", f"{scratch.folder}/checkpoints/silver")
    return _shown(scratch.read("silver"))


@query(_SQL + """SELECT kafka_partition::INTEGER AS kafka_partition, kafka_offset, quantity::INTEGER AS quantity,
       (price * quantity) || '.00' AS total_amount, true AS hashed FROM b""")
def stream_staging(t):
    scratch, rows = _landed(t, "stream-staging")
    spark, at = rows.sparkSession, scratch.folder
    ingest.silver_increment(spark, f"{at}/bronze", f"{at}/silver", f"{at}/checkpoints/silver")
    ingest.staging_increment(spark, f"{at}/silver", f"{at}/staging", f"{at}/checkpoints/staging")
    staged = scratch.read("staging")
    return staged.select(
        "kafka_partition", "kafka_offset", "quantity", F.col("total_amount").cast("string").alias("total_amount"),
        (F.length("silver_row_hash") == 64).alias("hashed"),
    )


def _served(t, label: str) -> ingest.ServingStore:
    rows = _log(t)
    scratch = Scratch(rows.sparkSession, label)
    # a batch is kept while both tables are made of it, so it has their columns only
    stream = contract.validate_json(_log_stream(rows), COMMERCE).select(*ingest.LATEST_COLUMNS)
    order = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
    store = ingest.ServingStore(rows.sparkSession, f"{scratch.folder}/serving", "ingest_minute", metrics.MINUTE_METRICS, order)
    minutes = lambda batch: metrics.commerce_minutes(batch, PAID)
    ingest.start_serving(stream, store, minutes, ingest.sanitised, f"{scratch.folder}/checkpoints/serving", _ONCE).awaitTermination()
    return store


@query(_SQL + _MINUTES)
def stream_serving_minutes(t):
    store = _served(t, "serving-minutes")
    store.compact(1)  # of the three batches, two are folded
    return store.minutes()


@query(_SQL + """SELECT kafka_partition::INTEGER AS kafka_partition, kafka_offset, status AS validation_status, quantity::INTEGER AS quantity,
       'Product ' || event_id AS product, rating::INTEGER AS overall, 14 AS shown FROM b ORDER BY ts DESC, kafka_partition DESC, kafka_offset DESC LIMIT 100""")
def stream_serving_latest(t):
    store = _served(t, "serving-latest")
    latest = store.latest()
    return latest.select(
        "kafka_partition", "kafka_offset", "validation_status", "quantity", F.col("productName").alias("product"), F.col("overall").cast("int").alias("overall"),
        F.lit(len(latest.columns)).alias("shown"),
    )


@query(_SQL + f""", m AS ({_MINUTES}), x AS (SELECT max(ts) AS newest FROM v),
       kept AS (SELECT m.* FROM m, x WHERE strptime(ingest_minute, '%Y%m%d%H%M') >= date_trunc('minute', newest) - INTERVAL 48 HOUR),
       s AS (SELECT sum(events_total) AS n FROM m)
       SELECT ingest_minute, events_total, gross_item_value, CAST(s.n AS BIGINT) AS all_events, 2::BIGINT AS last_batch_id, 'OK' AS status FROM kept, s""")
def serving_expiry(t):
    """Minutes of the last 48 hours after two folds and a replay of a folded batch; the sums still count every event."""
    rows, spark = _validated(t), t("events").sparkSession
    scratch = Scratch(spark, "serving-expiry")
    rows = scratch.write(rows, "validated")
    minutes = scratch.write(metrics.commerce_minutes(rows, PAID), "minutes")
    measures = [c for c in minutes.columns if c != "ingest_minute"]
    order = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
    store = ingest.ServingStore(spark, f"{scratch.folder}/serving", "ingest_minute", measures, order, retention=48 * 60)
    part = F.pmod(F.xxhash64("ingest_minute"), F.lit(3))
    for batch in (0, 1, 2):
        store.apply(minutes.filter(part == batch), ingest.sanitised(rows), batch)
        if batch:
            store.compact(batch - 1)
    store.apply(minutes, ingest.sanitised(rows), 0)
    total, last = store.summary().select(F.col("events_total").alias("all_events")), store.health().select("last_batch_id", "status")
    return store.minutes().select("ingest_minute", "events_total", "gross_item_value").crossJoin(total).crossJoin(last)


# ---- star schema: every eleventh event has a second staged version, which is a conflict

def _staged(t) -> DataFrame:
    silver = normalize.to_silver(contract.route(_validated(t))[0])
    silver = Scratch(silver.sparkSession, "star-silver").write(silver, "silver")
    again = silver.filter((F.col("kafka_offset") * 8 + F.col("kafka_partition")) % 11 == 0).withColumn("quantity", F.col("quantity") + 1)
    first = normalize.staging_batch(silver, "1")
    return first.unionByName(normalize.staging_batch(again, "2")).unionByName(normalize.staging_batch(silver, "3"))


_CURRENT = ", c AS (SELECT * FROM b WHERE event_id % 11 <> 0) "


@query(_SQL + _CURRENT + """SELECT kafka_partition::INTEGER AS kafka_partition, kafka_offset, 'B0' || lpad((event_id % 50)::VARCHAR, 8, '0') AS asin,
       'STR-HN-' || (1 + event_id % 10) AS store_id, quantity::INTEGER AS quantity, status AS validation_status FROM c""")
def star_fact(t):
    fact = pipeline.star_schema(_staged(t))["fact_ecommerce_event"]
    return fact.select("kafka_partition", "kafka_offset", "asin", "store_id", "quantity", "validation_status")


@query(_SQL + _CURRENT + """SELECT 'STR-HN-' || (1 + event_id % 10) AS store_id,
       arg_max('Store ' || event_id, (ts, kafka_partition, kafka_offset)) AS store_name, 'Hà Nội' AS city FROM c GROUP BY 1""")
def star_dim_store(t):
    return pipeline.star_schema(_staged(t))["dim_store"].select("store_id", "store_name", "city")


@query(_SQL + _CURRENT + """SELECT 'B0' || lpad((event_id % 50)::VARCHAR, 8, '0') AS asin,
       arg_max('Product ' || event_id, (ts, kafka_partition, kafka_offset)) AS product_name,
       arg_max(CASE WHEN warnings LIKE '%W101%' THEN 'Nike' ELSE 'Sony' END, (ts, kafka_partition, kafka_offset)) AS brand FROM c GROUP BY 1""")
def star_dim_product(t):
    return pipeline.star_schema(_staged(t))["dim_product"].select("asin", "product_name", "brand")


@query(_SQL + """, n AS (SELECT count(*) AS c FROM b WHERE event_id % 11 = 0)
       SELECT * FROM (VALUES ('not_empty', 0), ('unique_lineage', 0), ('no_orphans', 0), ('dates_known', 0), ('equal_totals', 1),
           ('unique_dim_product', 0), ('unique_dim_store', 0), ('unique_dim_reviewer', 0)) AS x("check", violations)
       UNION ALL SELECT 'no_conflicts', c FROM n""")
def star_gates(t):
    staged = Scratch(t("events").sparkSession, "star-gates").write(_staged(t), "staged")
    return reconciliation.counted(pipeline.star_checks(staged, pipeline.star_schema(staged)))


# ---- reconciliations of layers that differ in known places

_WHERE = "kafka_offset * 8 + kafka_partition"


@query(_SQL + """SELECT * FROM (VALUES ('log_duplicates', 0), ('bronze_duplicates', 0), ('dlq_duplicates', 0), ('extra', 0), ('dlq_inconsistent', 0),
           ('bronze_inconsistent', 0), ('bronze_misrouted', 0), ('bronze_partition', 0), ('dlq_partition', 0), ('contract_versions', 0)) AS x("check", violations)
       UNION ALL SELECT 'overlap', count(*) FROM b WHERE event_id % 29 = 0 AND event_id % 13 <> 0
       UNION ALL SELECT 'dlq_misrouted', count(*) FROM b WHERE event_id % 29 = 0
       UNION ALL SELECT 'missing', count(*) FROM b WHERE event_id % 13 = 0 AND event_id % 29 <> 0
       UNION ALL SELECT 'payload_changed', count(*) FROM v WHERE status = 'INVALID' AND event_id % 31 = 0""")
def recon_log_split(t):
    scratch = Scratch(t("events").sparkSession, "recon-log")
    rows = scratch.write(_validated(t), "validated")
    clean, dead = contract.route(rows)
    bronze = clean.filter(f"({_WHERE}) % 13 <> 0")
    dlq = dead.withColumn("raw_payload", F.when(F.expr(f"({_WHERE}) % 31 <> 0"), F.col("raw_payload")).otherwise("changed"))
    dlq = dlq.unionByName(clean.filter(f"({_WHERE}) % 29 = 0"))
    return reconciliation.log_split(rows, bronze, dlq)


@query(_SQL + """SELECT * FROM (VALUES ('extra', 0), ('schema', 1)) AS x("check", violations)
       UNION ALL SELECT 'missing', count(*) FROM b WHERE event_id % 13 = 0
       UNION ALL SELECT 'duplicates', count(*) FROM b WHERE event_id % 29 = 0 AND event_id % 13 <> 0
       UNION ALL SELECT 'values', count(*) FROM b WHERE event_id % 17 = 0 AND event_id % 13 <> 0""")
def recon_bronze_silver(t):
    scratch = Scratch(t("events").sparkSession, "recon-silver")
    bronze = scratch.write(contract.route(_validated(t))[0], "bronze")
    at = F.expr(_WHERE)
    silver = normalize.to_silver(bronze).filter(at % 13 != 0).withColumn("day_diff", F.col("day_diff").cast("long"))
    silver = silver.withColumn("store_name", F.when(at % 17 == 0, "changed").otherwise(F.col("store_name")))
    return reconciliation.bronze_silver(bronze, silver.unionByName(silver.filter(at % 29 == 0)))


@query(_SQL + """SELECT * FROM (VALUES ('staging_extra', 0), ('fact_extra', 0), ('fact_duplicates', 0), ('totals', 1)) AS x("check", violations)
       UNION ALL SELECT 'staging_missing', count(*) FROM b WHERE event_id % 13 = 0
       UNION ALL SELECT 'hash_changed', count(*) FROM b WHERE event_id % 13 = 0 OR event_id % 17 = 0
       UNION ALL SELECT 'conflicts', count(*) FROM b WHERE event_id % 19 = 0 AND event_id % 13 <> 0
       UNION ALL SELECT 'fact_missing', count(*) FROM b WHERE event_id % 23 = 0 AND event_id % 13 <> 0 AND event_id % 19 <> 0""")
def recon_silver_gold(t):
    scratch = Scratch(t("events").sparkSession, "recon-gold")
    silver, at = scratch.write(normalize.to_silver(contract.route(_validated(t))[0]), "silver"), F.expr(_WHERE)
    staged = normalize.staging_batch(silver.filter(at % 13 != 0), "1")
    hash_ = F.col("silver_row_hash")
    staged = staged.withColumn("silver_row_hash", F.when(at % 17 == 0, F.reverse(hash_)).otherwise(hash_))
    second = staged.filter(at % 19 == 0).withColumn("silver_row_hash", F.lit("another"))
    staged = scratch.write(staged.unionByName(second), "staged")
    fact = pipeline.star_schema(staged)["fact_ecommerce_event"].filter(at % 23 != 0)
    return reconciliation.silver_gold(silver, staged, fact)


@query(_SQL + f""", m AS ({_MINUTES}) SELECT * FROM (VALUES ('minutes_extra', 0), ('latest_length', 0), ('latest_forbidden', 2),
           ('summary_changed', 1), ('health_not_ok', 0), ('marker_missing', 1)) AS x("check", violations)
       UNION ALL SELECT 'minutes_missing', count(*) FROM m WHERE ingest_minute[12:12] = '3'
       UNION ALL SELECT 'minutes_changed', count(*) FROM m WHERE ingest_minute[12:12] = '5'""")
def recon_read_model(t):
    scratch = Scratch(t("events").sparkSession, "recon-read-model")
    rows = scratch.write(_validated(t), "validated")
    minutes, last = metrics.commerce_minutes(rows, PAID), F.substring("ingest_minute", 12, 1)
    off = F.when(last == "5", 1.0).when(last == "7", 0.0005).otherwise(0.0)
    shown = minutes.filter(last != "3").withColumn("gross_item_value", F.col("gross_item_value") + off)
    latest = ingest.sanitised(rows).orderBy(F.desc("kafka_timestamp")).limit(100).withColumns({"reviewerID": F.lit(""), "summary": F.lit("")})
    sums = shown.agg(*[F.sum(c).alias(c) for c in shown.columns if c != "ingest_minute"])
    health = rows.agg(F.count(F.lit(1)).alias("last_input_rows")).select(F.lit(7).cast("long").alias("last_batch_id"), "last_input_rows", F.lit("OK").alias("status"))
    return reconciliation.read_model(rows, PAID, shown, latest, summary=sums, health=health, has_marker=lambda batch: batch < 7)


# ---- metric windows and alerts

_KINDS = {"view": "delta", "click": "delta", "purchase": "gauge", "signup": "cumulative", "error": "delta"}


def _metric_events(t) -> DataFrame:
    """Events as metric events: the type is the metric, the value its value, and every third user has a topic."""
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair]), F.col("event_type"))
    at = F.col("ts").cast("timestamp")
    return t("events").select(
        F.col(_I).cast("string").alias("event_id"), at.alias("event_time"), at.alias("observed_at"), F.lit("shop").alias("component"),
        F.col("event_type").alias("metric_name"), F.coalesce(kind, F.lit("delta")).alias("metric_semantics"),
        F.when(F.col(_I) % 7 == 0, "WARNING").otherwise("OK").alias("status"), F.lit("r").alias("run_id"),
        F.create_map(F.lit("duration_ms"), F.round(F.col("value") * 100)).alias("values"),
        F.when(F.col("user_id") % 3 == 0, F.create_map(F.lit("topic"), F.lit("t"))).otherwise(F.create_map(F.lit("other"), F.lit(""))).alias("dimensions"),
        F.lit("v1").alias("schema_version"),
    )


@query("""WITH e AS (SELECT *, round(value * 100) AS v, CASE WHEN user_id % 3 = 0 THEN 't' END AS topic, CAST(event_id AS VARCHAR) AS id,
           time_bucket(INTERVAL 1 DAY, ts) AS w, CASE WHEN event_id % 7 = 0 THEN 'WARNING' ELSE 'OK' END AS status FROM events)
       SELECT strftime(w, '%Y-%m-%d') AS day, event_type AS metric_name, topic,
           CASE event_type WHEN 'purchase' THEN arg_max(v, (ts, id)) WHEN 'signup' THEN arg_max(v, (ts, id)) ELSE sum(v) END AS value,
           arg_max(status, (ts, id)) AS status, count(*) FILTER (status = 'WARNING') AS warnings, count(*) AS event_count,
           max(v) AS top, CASE WHEN count(*) >= 20 THEN quantile_disc(v, 0.95) END AS p95 FROM e GROUP BY 1, 2, 3""")
def metric_windows(t):
    windows = metrics.metric_windows(_metric_events(t), minutes=24 * 60)
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "metric_name", "topic", F.col("values")["duration_ms"].alias("value"), "status",
        F.coalesce(F.col("status_counts")["WARNING"], F.lit(0)).alias("warnings"), "event_count",
        F.col("statistics")["duration_ms_max"].alias("top"), F.col("statistics")["duration_ms_p95"].alias("p95"),
    )


@query("""WITH last AS (SELECT * FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 10),
       r AS (SELECT sum(100)::DOUBLE AS rows, sum(event_id % 60)::DOUBLE AS invalid FROM last),
       d AS (SELECT min(v) AS least FROM (SELECT round(value * 1000) + 20000 AS v FROM events WHERE event_id % 2 = 0
             ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 3)),
       p AS (SELECT * FROM events WHERE event_id % 11 = 0 ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1),
       c AS (SELECT * FROM events WHERE event_id % 13 = 0 ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1),
       q AS (SELECT * FROM events WHERE event_id % 17 = 0 ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1),
       s AS (SELECT 'bronze_invalid_rate' AS alert_name, invalid / rows AS x, 0.25 AS low, 0.40 AS high FROM r
             UNION ALL SELECT 'bronze_batch_duration', least, 25000, 75000 FROM d
             UNION ALL SELECT 'bronze_freshness', round(1709251200 - epoch(p.ts), 3), 75, 300 FROM p, c WHERE c.ts - INTERVAL 1 DAY < p.ts
             UNION ALL SELECT 'producer_delivery_gap', CAST(event_id % 3 AS DOUBLE), 0, 0 FROM p
             UNION ALL SELECT 'bronze_silver_row_mismatch', CAST(event_id % 2 AS DOUBLE), 0, 0 FROM q)
       SELECT alert_name, CASE WHEN x > high THEN 'CRITICAL' ELSE 'WARNING' END AS severity, x AS observed_value,
           CAST(CASE WHEN x > high THEN high ELSE low END AS DOUBLE) AS threshold FROM s WHERE x > low""")
def alert_signals(t):
    """All five rules. Quality counts of every event as a batch of 100 rows, durations of the even ones, where an odd batch's duration
    has no counts; deliveries, commits a day late and run counts of some of the events."""
    base, name = _metric_events(t).drop("component", "metric_name", "values", "dimensions"), F.lit(alerts.INGEST).alias("component")
    number = F.col("event_id").cast("long")
    where = F.create_map(F.lit("batch_id"), F.col("event_id")).alias("dimensions")
    quality = base.select(
        "*", name, F.lit("quality_counts").alias("metric_name"),
        F.create_map(F.lit("batch_input_rows"), F.lit(100.0), F.lit("invalid_count"), (number % 60).cast("double")).alias("values"), where,
    )
    worth = t("events").select(F.col(_I).cast("string").alias("event_id"), (F.round(F.col("value") * 1000) + 20_000).alias("_ms"))
    known = F.create_map(F.lit("batch_id"), F.when(number % 2 == 0, F.col("event_id")).otherwise("none")).alias("dimensions")
    slow = base.join(worth, "event_id").select(
        *base.columns, name, F.lit("batch_duration").alias("metric_name"), F.create_map(F.lit("duration_ms"), "_ms").alias("values"), known
    )
    def more(component: str, metric: str, every: int, **values) -> DataFrame:
        named = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("double"))])
        labels = [F.lit(component).alias("component"), F.lit(metric).alias("metric_name")]
        return base.filter(number % every == 0).select("*", *labels, named.alias("values"), where)

    sent = more("producer", "delivery_counts", 11, attempted=F.lit(10), acknowledged=10 - number % 3)
    late = more(alerts.INGEST, "last_committed", 13, committed_at_epoch_ms=F.unix_millis("event_time") - 86_400_000)
    runs = more(alerts.SILVER, "run_counts", 17, input_rows=F.lit(10), output_rows=10 - number % 2)
    everything = quality.unionByName(slow).unionByName(sent).unionByName(late).unionByName(runs)
    found = alerts.evaluate(everything, datetime(2024, 3, 1, tzinfo=timezone.utc))
    return found.select("alert_name", "severity", F.round("observed_value", 3).alias("observed_value"), "threshold")


# ---- log offsets

@query("""SELECT event_id, event_id % 8 + event_id // 8 AS total FROM events""")
def offset_totals(t):
    text = F.format_string('{"a":{"0":%d,"1":%d},"b":{}}', F.col(_I) % 8, F.expr(f"{_I} div 8"))
    return t("events").select(_I, tables.offset_total(text).alias("total"))


@query("""WITH l AS (SELECT event_id % 8 AS p, event_id // 8 AS o FROM events), m AS (SELECT p, max(o) + 1 AS high FROM l GROUP BY 1)
       SELECT CAST(l.p AS INTEGER) AS kafka_partition, o AS kafka_offset FROM l JOIN m USING (p) WHERE p % 3 = 0 OR o >= high // 2""")
def offset_window(t):
    """The rows between two snapshots of the log's offsets; partitions that the first one lacks start at 0."""
    log = t("events").select(F.lit("x").alias("kafka_topic"), (F.col(_I) % 8).cast("int").alias("kafka_partition"), F.expr(f"{_I} div 8").alias("kafka_offset"))
    after = log.groupBy(F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition")).agg((F.max("kafka_offset") + 1).alias("offset"))
    before = after.filter("partition % 3 <> 0").withColumn("offset", F.expr("offset div 2"))
    return tables.in_ranges(log, tables.offset_ranges(before, after)).select("kafka_partition", "kafka_offset")
