"""Queries of sources, sinks, the catalog, publishing and the monitoring pass: each runs its job and shows what it has left."""

from __future__ import annotations

import contextlib
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import ids
from millrace.functions.commerce_contract import COMMERCE
from millrace.operators import checks, current
from millrace.plans import gated_write, monitoring
from millrace.plans.publish import VersionedTables
from millrace.plans.staging import Scratch
from millrace.registry import money, query
from millrace.sources import byte_log, catalog, files, generator, record_log, tables
from millrace.streaming import alert_state, commits, ingest

# ---- catalog

TABLES = {
    "order_fact": catalog.Definition(
        "o_orderkey BIGINT, o_custkey BIGINT, price DECIMAL(18,2), order_month STRING", ["order_month"], ["o_custkey", "o_orderkey"]
    ),
    "customer_dim": catalog.Definition("c_custkey BIGINT, c_name STRING, c_mktsegment STRING", [], ["c_custkey"]),
}


def _catalog(t) -> str:
    """A database with both tables loaded."""
    orders, customer = t("orders"), t("customer")
    spark, database = orders.sparkSession, f"millrace_{uuid.uuid4().hex}"
    catalog.create_tables(spark, database, TABLES, Scratch(spark, "catalog").folder)
    month = F.date_format("o_orderdate", "yyyyMM").alias("order_month")
    fact = orders.select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"), month)
    catalog.load_table(fact, database, "order_fact", TABLES["order_fact"])
    catalog.load_table(customer.select("c_custkey", "c_name", "c_mktsegment"), database, "customer_dim", TABLES["customer_dim"])
    return database


@query("""SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, strftime(o_orderdate, '%Y%m') AS order_month,
       c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def catalog_scan(t):
    spark, database = t("orders").sparkSession, _catalog(t)
    fact, dim = spark.table(f"{database}.order_fact"), spark.table(f"{database}.customer_dim")
    joined = fact.join(dim, fact["o_custkey"] == dim["c_custkey"]).drop("c_custkey")
    return joined.withColumn("price", F.col("price").cast("string"))


def _filled(spark, database: str) -> DataFrame:
    """(table_name, rows, partitions): what the tables of a database hold."""
    counts = []
    for name, made in TABLES.items():
        by = F.count_distinct(*made.partition) if made.partition else F.lit(0).cast("long")
        counts.append(spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows"), by.alias("partitions")).select(F.lit(name).alias("table_name"), "*"))
    return counts[0].unionByName(counts[1])


@query("""SELECT table_name, columns, partition_columns, sort_keys, column_list, rows, partitions FROM (VALUES
       ('order_fact', 4::BIGINT, 1::BIGINT, 'o_custkey,o_orderkey', 'o_custkey:bigint,o_orderkey:bigint,order_month:string,price:decimal(18,2)'),
       ('customer_dim', 3, 0, 'c_custkey', 'c_custkey:bigint,c_mktsegment:string,c_name:string'))
       AS x(table_name, columns, partition_columns, sort_keys, column_list)
       JOIN (SELECT 'order_fact' AS table_name, count(*) AS rows, count(DISTINCT strftime(o_orderdate, '%Y%m')) AS partitions FROM orders
             UNION ALL SELECT 'customer_dim', count(*), 0 FROM customer) USING (table_name)""")
def catalog_metadata(t):
    spark, database = t("orders").sparkSession, _catalog(t)
    return catalog.table_summary(catalog.metadata(spark, database)).join(_filled(spark, database), "table_name")


@query("""SELECT table_name, column_name, problem, rows FROM (VALUES ('order_fact', 'price', 'type decimal(18,2), expected decimal(18,4)'),
       ('order_fact', 'o_custkey', 'unexpected'), ('order_fact', 'order_month', 'partition column or not'), ('customer_dim', 'c_phone', 'missing'))
       AS x(table_name, column_name, problem)
       JOIN (SELECT 'order_fact' AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'customer_dim', count(*) FROM customer) USING (table_name)""")
def catalog_contract(t):
    """What differs from a contract, with the rows of the table that it concerns."""
    expected = [
        ("order_fact", "o_orderkey", "bigint", False), ("order_fact", "price", "decimal(18,4)", False), ("order_fact", "order_month", "string", False),
        ("customer_dim", "c_custkey", "bigint", False), ("customer_dim", "c_name", "string", False),
        ("customer_dim", "c_mktsegment", "string", False), ("customer_dim", "c_phone", "string", False),
    ]
    spark, database = t("orders").sparkSession, _catalog(t)
    found = catalog.definition_differences(catalog.metadata(spark, database), expected)
    return found.join(_filled(spark, database).drop("partitions"), "table_name")


@query("""SELECT c_mktsegment, count(*) AS rows, 'a;b' AS mark FROM customer WHERE c_acctbal > 0 GROUP BY 1""")
def statement_script(t):
    view = f"millrace_{uuid.uuid4().hex}"
    t("customer").createOrReplaceTempView(view)
    script = f"""CREATE OR REPLACE TEMP VIEW {view}_rich AS SELECT * FROM {view} WHERE c_acctbal > 0;
        SELECT c_mktsegment, count(*) AS rows, 'a;b' AS mark FROM {view}_rich GROUP BY c_mktsegment;"""
    return tables.statements(t("customer").sparkSession, script)[-1]


# ---- sources and sinks

def _records(t) -> DataFrame:
    """Events as log records: every fifth has no key."""
    i = F.col("event_id")
    return t("events").select(
        F.lit("events").alias("topic"), (i % 8).cast("int").alias("partition"), F.expr("event_id div 8").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.when(i % 5 != 0, F.col("event_type")).cast("binary").alias("key"),
        F.concat(F.lit("é"), i.cast("string")).cast("binary").alias("value"),
    )


@query("""SELECT 'events' AS kafka_topic, CAST(event_id % 8 AS INTEGER) AS kafka_partition, event_id // 8 AS kafka_offset,
       epoch_us(ts) // 1000000 AS seconds, CASE WHEN event_id % 5 <> 0 THEN event_type END AS message_key, 'é' || event_id AS raw_payload FROM events""")
def log_projection(t):
    return tables.log_rows(_records(t)).withColumn("seconds", F.unix_timestamp("kafka_timestamp")).drop("kafka_timestamp")


@query("""SELECT count(*) AS records, count(*) FILTER (event_id % 5 = 0) AS keyless, CAST(sum(strlen('é' || event_id)) AS BIGINT) AS bytes,
       count(*) AS stored FROM events""")
def delivery_accounting(t):
    records = _records(t)
    spark, folder = records.sparkSession, Scratch(records.sparkSession, "delivery").folder
    sent = catalog.deliver(records.select("key", "value"), lambda df: df.write.parquet(f"{folder}/topic"))
    stored = spark.read.parquet(f"{folder}/topic").agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(*[F.lit(sent[c]).cast("long").alias(c) for c in ("records", "keyless", "bytes")], "stored")


@query("""SELECT 3::BIGINT AS added_files, count(*) AS added_rows, CAST(sum(event_id) AS BIGINT) AS total FROM events WHERE event_id % 2 = 1""")
def file_delta(t):
    """Files that a second append of three has added, and their rows, read by name."""
    events = t("events").select("event_id", "event_type")
    spark, folder = events.sparkSession, Scratch(events.sparkSession, "files").folder
    even, odd = (events.filter(F.col("event_id") % 2 == k) for k in (0, 1))
    even.repartition(2, "event_id").write.partitionBy("event_type").parquet(f"{folder}/table")
    before = Scratch(spark, "files").write(tables.data_files(spark, f"{folder}/table"), "before")
    odd.drop("event_type").repartition(3).write.mode("append").parquet(f"{folder}/table/event_type=a")
    added = tables.new_files(before, tables.data_files(spark, f"{folder}/table"))
    rows = tables.parquet_files(spark, f"{folder}/table", [r.path for r in added.select("path").collect()])
    counts = rows.agg(F.count(F.lit(1)).alias("added_rows"), F.sum("event_id").alias("total"))
    return counts.select(F.lit(added.count()).cast("long").alias("added_files"), "added_rows", "total")


@query("""SELECT count(*) AS rows, count(*) AS objects, count(*) AS places, true AS nulls_near, true AS repeatable FROM events""")
def generated_events(t):
    events = t("events")
    spark, rows = events.sparkSession, events.count()
    made = Scratch(spark, "generator").write(generator.as_log(generator.commerce_events(spark, rows)), "log")
    again = generator.as_log(generator.commerce_events(spark, rows))
    fields = F.size(F.json_object_keys("raw_payload"))
    holed = F.col("raw_payload").rlike(r":null[,}]")
    # by digests, so that no task holds the texts of its share of both logs
    digest = F.unhex(F.sha2("raw_payload", 256)).alias("digest")
    same = made.select(digest).exceptAll(again.select(digest)).isEmpty()
    place = F.struct("kafka_topic", "kafka_partition", "kafka_offset")
    return made.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(fields == len(COMMERCE.fields)).alias("objects"), F.count_distinct(place).alias("places"),
        (F.avg(holed.cast("double")).between(0.1, 0.2)).alias("nulls_near"), F.lit(same).alias("repeatable"),
    )


@query("""SELECT event_id, event_type FROM events""")
def stream_bounded_dedup(t):
    """A log that holds every row twice, as a stream of three batches that keeps the first of each."""
    events = t("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    spark, folder = events.sparkSession, Scratch(events.sparkSession, "dedup").folder
    events.unionByName(events).repartition(3).write.parquet(f"{folder}/log")
    kept = ingest.bounded_dedup(ingest.file_stream(spark, f"{folder}/log", 1), ["event_id"], "ts", "365 days")
    sink = kept.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    sink.start(f"{folder}/kept").awaitTermination()
    return spark.read.parquet(f"{folder}/kept").select("event_id", "event_type")


# ---- commits of a stream, batch by batch

#: Appends to the log, each a batch of both sinks; Spark compacts the log of every tenth batch of a sink.
BATCHES = 12
_STATUS = "CASE WHEN event_id % 7 = 3 THEN 'INVALID' WHEN event_id % 3 = 1 THEN 'WARNING' ELSE 'VALID' END"


def _observed_stream(t) -> tuple[DataFrame, str]:
    """A log that grows in twelve steps, the two sinks that a streaming query each has made of it, and what is seen of their batches."""
    records, n = _records(t), t("events").count()
    spark, folder = records.sparkSession, Scratch(records.sparkSession, "commits").folder
    number = F.col("offset") * 8 + F.col("partition")
    stream = record_log.record_log(spark, f"{folder}/log")
    status = F.expr(_STATUS.replace("event_id", "(kafka_offset * 8 + kafka_partition)"))
    rows = stream.select("kafka_topic", "kafka_partition", "kafka_offset", status.alias("validation_status"))
    sinks, checkpoints = ({name: f"{folder}/{kind}/{name}" for name in commits.ROUTES} for kind in ("sinks", "checkpoints"))
    for step in range(BATCHES):
        record_log.append_records(records.filter((number >= step * n // BATCHES) & (number < (step + 1) * n // BATCHES)), f"{folder}/log")
        running = [
            ingest.parquet_sink(rows.filter(F.col("validation_status").isin(*route)), name, sinks[name], checkpoints[name], ["validation_status"], {"availableNow": True})
            for name, route in commits.ROUTES.items()
        ]
        for query_ in running:
            query_.awaitTermination()
    return commits.observe(spark, sinks, checkpoints), folder


@query(f"""WITH n AS (SELECT count(*) AS n FROM events), e AS (SELECT *, {_STATUS} AS s FROM events, n)
       SELECT b AS batch_id, b = 9 AS compact, count(*) AS input_rows, count(*) FILTER (s = 'VALID') AS "VALID", count(*) FILTER (s = 'WARNING') AS "WARNING",
           count(*) FILTER (s = 'INVALID') AS "INVALID", CAST(NULL AS VARCHAR) AS problem, 2 AS lines, CAST(count(*) AS DOUBLE) AS logged_rows
       FROM range({BATCHES}) AS r(b), e WHERE event_id >= b * n // {BATCHES} AND event_id < (b + 1) * n // {BATCHES} GROUP BY b""")
def commit_observation(t):
    """Rows by status of each committed batch, and its events in the event log after a pass that saw half of the batches and two
    whole ones."""
    observed, folder = _observed_stream(t)
    scratch = Scratch(observed.sparkSession, "observed")
    observed, path = scratch.write(observed, "batches"), f"{folder}/events"
    for seen in (observed.filter("batch_id % 2 = 0"), observed, observed):
        commits.publish_commits(commits.commit_events(seen, "kafka_to_bronze_dlq", "run", "events"), path)
    logged = byte_log.read_events(observed.sparkSession, path).groupBy(F.col("dimensions")["batch_id"].cast("long").alias("batch_id"))
    logged = logged.agg(F.count(F.lit(1)).cast("int").alias("lines"), F.max(F.col("values")["batch_input_rows"]).alias("logged_rows"))
    return observed.drop("committed_at").join(logged, "batch_id")


# ---- monitoring log

_SOURCE = "app.jsonl"
_ID = "'00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0')"
#: What is wrong with a line, by event_id modulo their number: (replaced text, its replacement or the whole line, reason).
LINE_FAULTS = [
    ("", "", None), ("", '["x"]', "not a JSON object"), ("", '{"event_id": ', "not a JSON object"), ('"run_id":', '"run":', "unexpected fields"),
    ("00000000-", "0000-", "event_id is no UUID"), ("Z\"", "\"", "times need an offset"), ('"delta"', '"sum"', "unknown semantics"),
    ('"OK"', '"FINE"', "unknown status"), ('"shop"', '"  "', "blank text"), ('{"duration_ms":7.0}', "{}", "no values"),
    ("", "", "known failure"),
]
_REASONS = "VALUES " + ", ".join(f"({k}, {'NULL' if r is None else repr(r)})" for k, (_, _, r) in enumerate(LINE_FAULTS))

#: Ids of one document of the registry.
REGISTRY_IDS = 20_000


def _lines(t) -> DataFrame:
    """Events as lines of a metric log, with one fault each by :data:`LINE_FAULTS`."""
    at = ids.iso_millis(F.col("ts").cast("timestamp"))
    event = F.struct(
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("event_id"),
        at.alias("event_time"), at.alias("observed_at"), F.lit("shop").alias("component"), F.col("event_type").alias("metric_name"),
        F.lit("delta").alias("metric_semantics"), F.lit("OK").alias("status"), F.lit("r").alias("run_id"),
        F.create_map(F.lit("duration_ms"), F.lit(7.0)).alias("values"), F.create_map(F.lit("topic"), F.lit("t")).alias("dimensions"),
        F.lit("v1").alias("schema_version"),
    )
    line, k = F.to_json(event), F.col("event_id") % len(LINE_FAULTS)
    shown = line
    for i, (old, new, reason) in enumerate(LINE_FAULTS):
        if old or new:
            shown = F.when(k == i, F.replace(line, F.lit(old), F.lit(new)) if old else F.lit(new)).otherwise(shown)
    made = t("events").select(F.lit(_SOURCE).alias("source"), shown.alias("line"), F.col("event_id").alias("_number"))
    return made.withColumn("line_sha256", F.sha2(F.concat("line", F.col("_number").cast("string")), 256))


def _routed(t) -> tuple[DataFrame, DataFrame]:
    """Accepted events and rejected lines, those of the last fault by a registry of known failures."""
    lines = _lines(t)
    scratch = Scratch(lines.sparkSession, "metric-log")
    lines = scratch.write(lines, "lines")
    bad = lines.filter(F.col("_number") % len(LINE_FAULTS) == len(LINE_FAULTS) - 1)
    # a document for so many ids, since each is parsed whole
    known = bad.groupBy(F.expr(f"_number div {REGISTRY_IDS * len(LINE_FAULTS)}").alias("part")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_number").cast("string"), F.get_json_object("line", "$.event_id")))).alias("event_ids"))
    entry = F.struct(F.lit(_SOURCE).alias("source"), F.lit(LINE_FAULTS[-1][2]).alias("reason"), "event_ids")
    registry = F.to_json(F.struct(F.lit("monitoring-quarantine-v1").alias("schema_version"), F.array(entry).alias("entries")))
    known.select("part", registry.alias("value")).write.partitionBy("part").text(f"{scratch.folder}/registry")
    return byte_log.metric_events(lines.drop("_number"), tables.quarantine_registry(lines.sparkSession, f"{scratch.folder}/registry"))


@query(f"""WITH f(k, reason) AS ({_REASONS})
       SELECT CASE WHEN reason IS NULL THEN {_ID} END AS accepted_id, CASE WHEN reason IS NULL THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS seconds, reason
       FROM events JOIN f ON event_id % {len(LINE_FAULTS)} = k""")
def metric_log_routes(t):
    accepted, rejected = _routed(t)
    good = accepted.select(F.col("event_id").alias("accepted_id"), F.unix_timestamp("event_time").cast("string").alias("seconds"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(rejected.select(F.lit(None).cast("string").alias("accepted_id"), F.lit(None).cast("string").alias("seconds"), "reason"))


_PASSES = [datetime(2024, 3, 1, tzinfo=timezone.utc)] * 3


@query(f"""WITH e AS (SELECT event_id % {len(LINE_FAULTS)} AS k, event_id % 2 AS odd FROM events)
       SELECT 1 AS pass, true AS changed, count(*) FILTER (k = 0 AND odd = 0) AS journal, count(*) FILTER (k > 0 AND odd = 0) AS rejected FROM e
       UNION ALL SELECT 2, true, count(*) FILTER (k = 0), count(*) FILTER (k > 0) FROM e
       UNION ALL SELECT 3, false, count(*) FILTER (k = 0), count(*) FILTER (k > 0) FROM e""")
def monitoring_passes(t):
    """Half of the log, the whole log, and the whole log again, which changes nothing."""
    spark = t("events").sparkSession
    store = monitoring.MonitoringStore(spark, Scratch(spark, "passes").folder)
    half = lambda name: t(name).filter("event_id % 2 = 0")
    shown = []
    for i, (source, now) in enumerate(zip((half, t, t), _PASSES, strict=True)):
        changed, state = store.collect(*_routed(source), now)
        shown.append((i + 1, changed, state.accepted, state.rejected))
    return spark.createDataFrame(shown, "pass int, changed boolean, journal long, rejected long")


_LATE = f"event_id % {3 * len(LINE_FAULTS)} = 0 AND ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)"


@query(f"""WITH e AS (SELECT *, {_LATE} AS late, strftime(ts, '%Y%m%d') AS day FROM events WHERE event_id % {len(LINE_FAULTS)} = 0),
       days AS (SELECT day, bool_or(late) AS touched FROM e GROUP BY 1),
       w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, event_type AS metric_name, count(*) AS event_count FROM e GROUP BY 1, 2)
       SELECT strftime(w, '%Y-%m-%d %H:%M') AS at, metric_name, event_count, event_count * 7.0::DOUBLE AS millis,
           CASE WHEN touched THEN 2 ELSE 1 END AS written_by FROM w JOIN days ON day = strftime(w, '%Y%m%d')""")
def monitoring_late_windows(t):
    """Windows after a second pass that brings late events: those of the days that these touch are of the second pass, all others
    still of the first one."""
    events = t("events")
    spark = events.sparkSession
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("half"))
    marked = events.crossJoin(ends).withColumn("_late", (F.col("event_id") % (3 * len(LINE_FAULTS)) == 0) & (F.col("ts") < F.col("half")))
    store = monitoring.MonitoringStore(spark, Scratch(spark, "late").folder)
    for late in (False, True):
        part = marked.filter(F.col("_late") == late).drop("_late", "half")
        store.collect(*_routed(lambda _, part=part: part), _PASSES[0])
    days = store.versions.read("windows_index").select("span", F.col("pass").alias("written_by"))
    windows = store.read("windows").withColumn("span", F.date_format("window_start", "yyyyMMdd")).join(days, "span")
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("at"), "metric_name", "event_count", F.col("values")["duration_ms"].alias("millis"), "written_by"
    )


@query(f"""WITH e AS (SELECT event_id % {len(LINE_FAULTS)} IN (0, {len(LINE_FAULTS) - 1}) AS good FROM events)
       SELECT count(*) FILTER (good) AS journal, count(*) FILTER (NOT good) AS rejected, count(*) AS lines, 2 AS passes, true AS whole FROM e""")
def monitoring_files(t):
    """The metric log as files, more of them before the second of two passes; tasks find the lines in ranges of 64 KB."""
    lines = _lines(t)
    spark, folder = lines.sparkSession, Scratch(lines.sparkSession, "metric-files").folder
    spark.range(1).select(F.lit('{"schema_version": "monitoring-quarantine-v1", "entries": []}').alias("value")).write.text(f"{folder}/registry")
    store = monitoring.MonitoringStore(spark, f"{folder}/store")
    for part in (0, 1):
        lines.filter(F.col("_number") % 2 == part).select("line").write.mode("append").text(f"{folder}/logs")
        store.collect_files(f"{folder}/logs/part-*", f"{folder}/registry", _PASSES[0], split_bytes=64 << 10)
    state = store.state()
    whole = sum(int(c.split(":")[0]) for c in state.cursors.values()) == sum(files.matching(f"{folder}/logs/part-*").values())
    stored = store.read("journal").select("event_id").unionByName(store.read("rejected").select("event_id"))
    return stored.agg(F.count(F.lit(1)).alias("lines")).select(
        F.lit(state.accepted).cast("long").alias("journal"), F.lit(state.rejected).cast("long").alias("rejected"), "lines",
        F.lit(state.number).alias("passes"), F.lit(whole).alias("whole"),
    )


# ---- writes that are judged, and what they leave

@query("""SELECT * FROM (VALUES ('rows', 0), ('files', 0), ('schema', 0), ('empty', 0), ('partitions', 0)) AS x("check", violations)
       UNION ALL SELECT 'negative_balance', count(*) FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT 'short_name', count(*) FROM customer WHERE length(c_name) < 5
       UNION ALL SELECT 'duplicates', count(*) FROM (SELECT c_nationkey, c_mktsegment FROM customer GROUP BY 1, 2 HAVING count(*) > 1)""")
def write_gate(t):
    """The gate of a partitioned, compressed write: rules counted as the rows pass, the rest read back from the files."""
    customer = t("customer")
    rules = {"negative_balance": F.col("c_acctbal") < 0, "short_name": F.length("c_name") < 5}
    path = Scratch(customer.sparkSession, "gate").folder
    return gated_write.gated_write(customer, path, rules, ["c_mktsegment"], "zstd", ["c_nationkey", "c_mktsegment"], customer.count())


@query("""SELECT strftime(l_shipdate, '%Y') AS ship_year, count(*) AS rows, 0::BIGINT AS ordered_overlaps, true AS unordered_overlap FROM lineitem GROUP BY 1""")
def physical_order(t):
    """The fact written in order of part by year of shipping, and once more as it comes: overlapping row groups of both, from footers."""
    fact = t("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy").alias("ship_year"))
    spark, folder = fact.sparkSession, Scratch(fact.sparkSession, "order").folder
    gated_write.ordered_write(fact, f"{folder}/ordered", ["l_partkey", "l_orderkey", "l_linenumber"], ["ship_year"], files=6)
    fact.repartition(4, "l_orderkey").write.partitionBy("ship_year").parquet(f"{folder}/unordered")

    def years(name: str) -> DataFrame:
        groups = gated_write.row_groups(spark, f"{folder}/{name}", "l_partkey")
        year = F.regexp_extract("folder", "ship_year=(.*)$", 1).alias("ship_year")
        return gated_write.overlaps(groups).select(year, F.col("overlapping").alias(f"{name}_overlaps"))

    rows = gated_write.row_groups(spark, f"{folder}/ordered").groupBy(F.regexp_extract("file", "ship_year=([^/]*)/", 1).alias("ship_year"))
    joined = rows.agg(F.sum("rows").alias("rows")).join(years("ordered"), "ship_year").join(years("unordered"), "ship_year")
    return joined.select("ship_year", "rows", "ordered_overlaps", (F.col("unordered_overlaps") > 0).alias("unordered_overlap"))


# ---- alerts of a stream

@query("""WITH s AS (SELECT DISTINCT CAST(user_id % 40 AS VARCHAR) AS fingerprint, CASE WHEN value > 75 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
           date_trunc('second', ts) AS seen FROM events WHERE event_type = 'error'),
       l AS (SELECT *, lag(severity) OVER w AS was, lag(seen) OVER w AS prior, lead(seen) OVER w AS later, max(seen) OVER () AS until
             FROM s WINDOW w AS (PARTITION BY fingerprint ORDER BY seen, severity)),
       m AS (SELECT *, prior IS NOT NULL AND seen > prior + INTERVAL 12 HOUR AS silent FROM l),
       x AS (SELECT fingerprint, 'RESOLVED' AS state, was AS severity, CASE WHEN silent THEN prior + INTERVAL 12 HOUR ELSE seen END AS moved
             FROM m WHERE was IS NOT NULL AND (silent OR was <> severity)
             UNION ALL SELECT fingerprint, 'OPEN', severity, seen FROM m WHERE was IS NULL OR silent OR was <> severity
             UNION ALL SELECT fingerprint, 'RESOLVED', severity, seen + INTERVAL 12 HOUR FROM m WHERE later IS NULL AND seen + INTERVAL 12 HOUR <= until)
       SELECT fingerprint, state, severity, strftime(moved, '%Y-%m-%d %H:%M:%S') AS moved_at FROM x""")
def stream_alert_state(t):
    """Error events as signals, in three batches of a stream by time; an alert that is not seen for twelve hours times out."""
    signals = t("events").filter("event_type = 'error'").select(
        (F.col("user_id") % 40).cast("string").alias("fingerprint"), F.when(F.col("value") > 75, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("evaluated_at"),
    )
    spark, folder = signals.sparkSession, Scratch(signals.sparkSession, "alerts").folder
    ends = signals.agg(F.min("evaluated_at"), F.max("evaluated_at")).first()
    cuts = [ends[0] + (ends[1] - ends[0]) * i / 3 for i in range(4)]
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for low, high in zip(cuts[:-1], [*cuts[1:-1], None], strict=True):
            at = F.col("evaluated_at")
            signals.filter((at >= low) & (F.lit(True) if high is None else at < high)).coalesce(1).write.mode("append").parquet(f"{folder}/signals")
            stream = alert_state.alert_stream(ingest.file_stream(spark, f"{folder}/signals", 1), timedelta(hours=12), "0 seconds")
            sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
            sink.start(f"{folder}/moves").awaitTermination()
    finally:
        spark.conf.set(key, before)
    moves = spark.read.parquet(f"{folder}/moves")
    return moves.select("fingerprint", "state", "severity", F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss").alias("moved_at"))


# ---- publishing, orders, times

@query("""SELECT c_custkey, c_name, 'second' AS version FROM customer""")
def published_version(t):
    """The second of three versions: the first is replaced, the third fails its check and is not seen."""
    customer = t("customer").select("c_custkey", "c_name")
    store = VersionedTables(customer.sparkSession, Scratch(customer.sparkSession, "publish").folder)
    unique = lambda written: checks.require({"unique": checks.duplicate_keys(written["dim"], ["c_custkey"])})
    store.publish({"dim": customer.filter("c_custkey % 2 = 0")}, unique, "first")
    store.publish({"dim": customer}, unique, "second")
    with contextlib.suppress(ValueError):
        store.publish({"dim": customer.unionByName(customer)}, unique, "third")
    return store.read("dim").withColumn("version", F.lit(store.current()))


@query("""SELECT event_id, topic FROM (SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN event_type END AS topic, ts FROM events)
       ORDER BY coalesce(topic, ''), ts, event_id LIMIT 200""")
def nullable_topic_order(t):
    events = t("events").select("event_id", F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("topic"), "ts")
    return current.top_n(events, [*current.text_order("topic"), "ts", "event_id"], 200).drop("ts")


@query("""SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS nth FROM
       (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 50)""")
def last_n_ascending(t):
    last = current.last_ascending(t("events").select("event_id", "ts"), ["ts", "event_id"], 50)
    place = F.posexplode(F.transform("rows", lambda r: r["event_id"])).alias("nth", "event_id")
    listed = last.agg(F.collect_list(F.struct("ts", "event_id")).alias("rows")).select(place)
    return listed.select("event_id", (F.col("nth") + 1).cast("long").alias("nth"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z'
       WHEN 1 THEN strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000Z' END AS at FROM events""")
def iso_instants(t):
    """Texts with Z or an offset are instants; naive and unreadable ones are not."""
    text, k = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_id") % 4
    said = F.when(k == 0, F.concat(text, F.lit("Z"))).when(k == 1, F.concat(text, F.lit("+07:00"))).when(k == 2, text).otherwise("soon")
    return t("events").select("event_id", ids.iso_millis(ids.instant(said)).alias("at"))
