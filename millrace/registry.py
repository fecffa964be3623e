"""Every operator as a query over the star-schema and event tables, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import ids, rules
from millrace.operators import checks, contract, current, metrics, normalize, reconcile

MONEY = "decimal(18,2)"
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (tables) under its name; ``tables('orders')`` reads a table."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        _QUERIES[function.__name__] = run
        if sql:
            _SQL[function.__name__] = sql
        return function

    return register


def queries() -> dict:
    import millrace.registry_commerce  # noqa: F401  registers its own
    import millrace.registry_layers  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    import millrace.registry_commerce  # noqa: F401
    import millrace.registry_layers  # noqa: F401

    return dict(_SQL)


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def n(condition: Column | None = None) -> Column:
    """A count of rows, or of those that meet a condition."""
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def text(array: str | Column) -> Column:
    return F.array_join(F.sort_array(array), ",")


# ---- metrics

PAID = "purchase"
_MINUTE_SQL = """
    SELECT strftime(ts, '%Y%m%d%H%M') AS ingest_minute, count(*) AS events_total,
           count(*) FILTER (event_type = 'error') AS error_count,
           count(*) FILTER (event_type <> 'error') AS record_count,
           sum(CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS gross,
           sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS paid
    FROM events GROUP BY 1
"""


def _minutes(events: DataFrame) -> DataFrame:
    kind, value, zero = F.col("event_type"), money("value"), F.lit(0).cast(MONEY)
    business = kind != "error"
    return metrics.measures_by(
        events,
        {"ingest_minute": metrics.minute_key("ts")},
        {
            "events_total": F.lit(1).cast("long"),
            "error_count": F.when(~business, 1).otherwise(0).cast("long"),
            "record_count": F.when(business, 1).otherwise(0).cast("long"),
            "gross": F.when(business, value).otherwise(zero),
            "paid": F.when(kind == PAID, value).otherwise(zero),
        },
    )


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals as text, which both engines write alike."""
    return df.withColumns({c: F.col(c).cast(MONEY).cast("string") for c in columns})


@query(f"""SELECT ingest_minute, CAST(events_total AS BIGINT) AS events_total, CAST(error_count AS BIGINT) AS error_count,
       CAST(record_count AS BIGINT) AS record_count, CAST(CAST(gross AS DECIMAL(18,2)) AS VARCHAR) AS gross,
       CAST(CAST(paid AS DECIMAL(18,2)) AS VARCHAR) AS paid FROM ({_MINUTE_SQL})""")
def minute_metrics(t):
    return _plain(_minutes(t("events")), "gross", "paid")


@query(f"""SELECT CAST(sum(events_total) AS BIGINT) AS events_total, CAST(sum(error_count) AS BIGINT) AS error_count,
       CAST(sum(record_count) AS BIGINT) AS record_count, CAST(CAST(sum(gross) AS DECIMAL(18,2)) AS VARCHAR) AS gross,
       CAST(CAST(sum(paid) AS DECIMAL(18,2)) AS VARCHAR) AS paid, count(*) AS minutes FROM ({_MINUTE_SQL})""")
def minute_rollup_summary(t):
    names = ["events_total", "error_count", "record_count", "gross", "paid"]
    minutes = _minutes(t("events")).withColumn("minutes", F.lit(1).cast("long"))
    total = metrics.rollup(minutes, [*names, "minutes"]).filter("ingest_minute is null").drop("ingest_minute")
    return _plain(total, "gross", "paid")


_WINDOW = "time_bucket(INTERVAL 5 MINUTE, ts)"


def _windowed(events: DataFrame) -> DataFrame:
    start = F.date_format(F.window("ts", "5 minutes").start, "yyyy-MM-dd HH:mm:ss")
    return events.select(start.alias("window_start"), "event_type", "ts", "event_id", "value", "user_id")


@query(f"""SELECT strftime({_WINDOW}, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS event_count,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS VARCHAR) AS total FROM events GROUP BY 1, 2""")
def five_min_window(t):
    by = _windowed(t("events")).groupBy("window_start", "event_type")
    return _plain(by.agg(n().alias("event_count"), F.sum(money("value")).alias("total")), "total")


@query(f"""SELECT strftime({_WINDOW}, '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       arg_max_null(value, (ts, event_id)) AS last_value FROM events GROUP BY 1, 2""")
def gauge_last_per_window(t):
    by = _windowed(t("events")).groupBy("window_start", "event_type")
    return by.agg(F.max_by("value", F.struct("ts", "event_id")).alias("last_value"))


@query(f"""SELECT strftime({_WINDOW}, '%Y-%m-%d %H:%M:%S') AS window_start, max(event_id) AS top_event
       FROM events GROUP BY 1""")
def max_gauge_per_window(t):
    return _windowed(t("events")).groupBy("window_start").agg(F.max("event_id").alias("top_event"))


@query("""SELECT user_id, count(*) AS durations, CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS VARCHAR) AS total,
       max(value) AS top, CASE WHEN count(value) >= 20 THEN quantile_disc(value, 0.95) END AS p95 FROM events GROUP BY 1""")
def window_duration_stats(t):
    p95 = F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY value)")
    stats = t("events").groupBy("user_id").agg(
        n().alias("durations"), F.sum(money("value")).alias("total"), F.max("value").alias("top"),
        F.when(F.count("value") >= 20, p95).alias("p95"),
    )
    return _plain(stats, "total")


@query("""SELECT string_agg(event_type || ':' || rows, ',' ORDER BY event_type) AS histogram, sum(rows)::BIGINT AS rows
       FROM (SELECT event_type, count(*) AS rows FROM events GROUP BY 1)""")
def status_histogram(t):
    counts = metrics.histogram(t("events"), "event_type")
    pair = F.concat_ws(":", "event_type", F.col("rows").cast("string"))
    return counts.agg(text(F.collect_list(pair)).alias("histogram"), F.sum("rows").alias("rows"))


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value
       FROM events GROUP BY 1, 2""")
def latest_per_metric(t):
    events = t("events").select("user_id", "event_type", "event_id", "value", "ts")
    return metrics.latest(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""SELECT DISTINCT event_id, user_id, event_type FROM events""")
def dedup_idempotent_events(t):
    events = t("events").select("event_id", "user_id", "event_type", F.col("ts").alias("observed_at"))
    retried = events.unionByName(events.withColumn("observed_at", F.col("observed_at") + F.expr("interval 1 hour")))
    return metrics.dedup_events(retried).drop("observed_at")


# ---- contract

LINE_CONTRACT = contract.Contract(
    version="line-v1",
    fields=tuple(contract.Field(c, "double") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    field_rules=(
        rules.outside("E101_QUANTITY", "l_quantity", 2, 49),
        rules.outside("E102_DISCOUNT", "l_discount", 0.0, 0.09),
        rules.not_one_of("E103_FLAG", "l_returnflag", ["A", "N", "R"]),
        rules.pattern("E104_STATUS", "l_linestatus", "^[FO]$"),
        rules.blank("E105_EMPTY", "l_linestatus"),
    ),
    cross_rules=(
        rules.when("E201_PRICE", lambda get: get("l_extendedprice") < get("l_quantity") * 100),
        rules.child_not_of_parent("E202_FLAG_STATUS", "l_returnflag", "l_linestatus", {"N": ["O"], "A": ["F"], "R": ["F"]}),
    ),
    warning_rules=(rules.when("W101_TAXED_DISCOUNT", lambda get: (get("l_tax") >= 0.08) & (get("l_discount") >= 0.05)),),
)
_LINES_SQL = """
    WITH f AS (
        SELECT *, list_filter([
            CASE WHEN NOT l_quantity BETWEEN 2 AND 49 THEN 'E101_QUANTITY' END,
            CASE WHEN NOT l_discount BETWEEN 0.0 AND CAST(0.09 AS DOUBLE) THEN 'E102_DISCOUNT' END,
            CASE WHEN l_returnflag NOT IN ('A', 'N', 'R') THEN 'E103_FLAG' END,
            CASE WHEN NOT regexp_matches(l_linestatus, '^[FO]$') THEN 'E104_STATUS' END,
            CASE WHEN length(trim(l_linestatus)) = 0 THEN 'E105_EMPTY' END], lambda x: x IS NOT NULL) AS field
        FROM lineitem
    ),
    v AS (
        SELECT *, list_concat(field, list_filter([
            CASE WHEN len(field) = 0 AND l_extendedprice < l_quantity * 100 THEN 'E201_PRICE' END,
            CASE WHEN len(field) = 0 AND NOT (l_returnflag = 'N' AND l_linestatus = 'O' OR l_returnflag IN ('A', 'R') AND l_linestatus = 'F') THEN 'E202_FLAG_STATUS' END],
            lambda x: x IS NOT NULL)) AS errors,
            list_filter([CASE WHEN l_tax >= CAST(0.08 AS DOUBLE) AND l_discount >= CAST(0.05 AS DOUBLE) THEN 'W101_TAXED_DISCOUNT' END],
            lambda x: x IS NOT NULL) AS warnings
        FROM f
    ),
    s AS (
        SELECT *, CASE WHEN len(errors) > 0 THEN 'INVALID' WHEN len(warnings) > 0 THEN 'WARNING' ELSE 'VALID' END AS status
        FROM v
    )
"""
_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _lines(t) -> DataFrame:
    return contract.validate_table(t("lineitem"), LINE_CONTRACT)


@query(_LINES_SQL + f"SELECT {', '.join(_LINE_KEY)}, status FROM s WHERE status IN ('VALID', 'WARNING')")
def route_valid(t):
    return contract.route(_lines(t))[0].select(*_LINE_KEY, F.col("validation_status").alias("status"))


@query(_LINES_SQL + f"SELECT {', '.join(_LINE_KEY)}, array_to_string(errors, ',') AS errors FROM s WHERE status = 'INVALID'")
def route_dlq(t):
    return contract.route(_lines(t))[1].select(*_LINE_KEY, F.array_join("validation_errors", ",").alias("errors"))


@query(_LINES_SQL + f"""SELECT {', '.join(_LINE_KEY)}, array_to_string(errors, ',') AS errors,
       array_to_string(warnings, ',') AS warnings, status FROM s""")
def rule_codes(t):
    return _lines(t).select(
        *_LINE_KEY, F.array_join("validation_errors", ",").alias("errors"),
        F.array_join("validation_warnings", ",").alias("warnings"), F.col("validation_status").alias("status"),
    )


@query(_LINES_SQL + "SELECT code, count(*) AS rows FROM (SELECT unnest(errors) AS code FROM s) GROUP BY 1")
def rule_counts(t):
    return contract.rule_counts(_lines(t))


@query(_LINES_SQL + "SELECT status AS validation_status, count(*) AS rows FROM s GROUP BY 1")
def status_counts(t):
    return contract.status_counts(_lines(t))


@query(_LINES_SQL + """SELECT count(*) AS rows, count(*) FILTER (status = 'INVALID') AS invalid, CAST(0 AS BIGINT) AS inconsistent,
       count(*) = (SELECT count(*) FROM lineitem) AS conserved FROM s""")
def quality_invariants(t):
    lines = _lines(t)
    source = t("lineitem").agg(n().alias("_source"))
    invalid = F.col("validation_status") == "INVALID"
    counts = lines.agg(n().alias("rows"), n(invalid).alias("invalid"), n(contract.contradicts()).alias("inconsistent"))
    return counts.crossJoin(source).select(
        "rows", "invalid", "inconsistent", (F.col("rows") == F.col("_source")).alias("conserved")
    )


@query(_LINES_SQL + """SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(errors, ',') AS errors FROM s
       WHERE status = 'INVALID' ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 20""")
def invalid_sample(t):
    first = contract.invalid_sample(_lines(t), [*_LINE_KEY[:2], "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], 20)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("validation_errors", ",").alias("errors"))


PROPS = contract.Contract(version="props-v1", fields=(contract.Field("k", "int", "integer"),), field_rules=(rules.outside("E101_K", "k", 10, 90),))


@query("""SELECT event_id, array_to_string(json_keys(props), ',') AS keys, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 10 AND 90 THEN 'VALID' ELSE 'INVALID' END AS status,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 10 AND 90 THEN '' ELSE 'E101_K' END AS errors
       FROM events""")
def json_contract_types(t):
    checked = contract.validate_json(t("events"), PROPS, "props", strict=True, stamp=False)
    return checked.select(
        "event_id", F.array_join(F.json_object_keys("props"), ",").alias("keys"), "k",
        F.col("validation_status").alias("status"), F.array_join("validation_errors", ",").alias("errors"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 3 = 2 AND event_id % 7 = 0 THEN 'missing:k'
            WHEN event_id % 3 = 1 THEN 'unexpected:z' ELSE '' END AS fields,
       CASE WHEN event_id % 3 = 0 THEN 'E003_MISSING_FIELDS,E004_UNEXPECTED_FIELDS' WHEN event_id % 3 = 1 THEN 'E004_UNEXPECTED_FIELDS'
            WHEN event_id % 7 = 0 THEN 'E001_MALFORMED_JSON' WHEN event_id % 11 = 0 THEN 'E005_TYPE_MISMATCH'
            WHEN event_id % 13 = 0 THEN 'E006_REQUIRED_NULL' ELSE '' END AS errors
       FROM events""")
def json_structure_errors(t):
    i = F.col("event_id")
    raw = (
        F.when(i % 3 == 0, '{"y": 1}').when(i % 3 == 1, '{"k": 50, "z": 1}').when(i % 7 == 0, '{"k": ')
        .when(i % 11 == 0, '{"k": "x"}').when(i % 13 == 0, '{"k": null}').otherwise('{"k": 50}')
    )
    checked = contract.validate_json(t("events").withColumn("raw", raw), PROPS, "raw", stamp=False)
    lost = F.when(F.size("missing_fields") > 0, F.concat(F.lit("missing:"), F.array_join("missing_fields", ",")))
    extra = F.when(F.size("unexpected_fields") > 0, F.concat(F.lit("unexpected:"), F.array_join("unexpected_fields", ",")))
    return checked.select(
        "event_id", F.coalesce(lost, extra, F.lit("")).alias("fields"), F.array_join("validation_errors", ",").alias("errors")
    )


# ---- normalisation

@query("""SELECT event_id, CAST(user_id AS INTEGER) AS user_no, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, epoch_us(date_trunc('second', ts)) // 1000000 AS seconds,
       'silver-v1' AS schema_version FROM events WHERE event_type IN ('purchase', 'view')""")
def silver_normalize(t):
    mapping = {
        "event_id": ("event_id", "long"), "user_no": ("user_id", "int"), "amount": ("value", MONEY), "event_date": ("ts", "date"),
        "seconds": (F.unix_timestamp(F.col("ts").cast("timestamp")), "long"), "schema_version": (F.lit("silver-v1"), "string"),
    }
    typed = normalize.normalise(t("events").filter(F.col("event_type").isin("purchase", "view")), mapping)
    return _plain(typed, "amount").withColumn("event_date", F.col("event_date").cast("string"))


@query("SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus FROM orders")
def dedup_lineage(t):
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return normalize.one_per_lineage(orders.unionByName(orders), ["o_orderkey"])


@query("""SELECT o_orderkey, sha256('{"o_orderkey":' || o_orderkey || ',"status":' ||
       CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE '"' || o_orderstatus || '"' END || ',"price":' ||
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","keys":[' ||
       o_custkey || ',' || o_orderkey || ']}') AS row_hash FROM orders""")
def row_hash(t):
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status")
    day = F.col("o_orderdate").cast("date").alias("day")
    row = ["o_orderkey", status, money("o_totalprice").alias("price"), day, F.array("o_custkey", "o_orderkey").alias("keys")]
    return t("orders").select("o_orderkey", ids.row_hash(*row).alias("row_hash"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m') AS ship_month,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem""")
def fact_select(t):
    fact = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMM").alias("ship_month"),
        money("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("quantity"),
    )
    return _plain(current.ordered_layout(fact, "ship_month", ["l_partkey", "l_orderkey"]), "price")


@query("SELECT * EXCLUDE (c_acctbal) FROM customer")
def select_except(t):
    return normalize.without(t("customer"), "c_acctbal")


# ---- current state

_VERSIONS_SQL = """
    WITH v AS (
        SELECT o_orderkey, o_orderstatus || '1' AS payload, 1 AS loaded FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus || '1', 2 FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL SELECT o_orderkey, o_orderstatus || '2', 3 FROM orders WHERE o_orderkey % 5 = 0
    )
"""


def _versions(t) -> DataFrame:
    """Orders loaded once; even ones loaded again as they are; every fifth in a second version."""
    orders, key = t("orders"), F.col("o_orderkey")

    def load(rows: DataFrame, suffix: str, loaded: int) -> DataFrame:
        return rows.select("o_orderkey", F.concat("o_orderstatus", F.lit(suffix)).alias("payload"), F.lit(loaded).alias("loaded"))

    return load(orders, "1", 1).unionByName(load(orders.filter(key % 2 == 0), "1", 2)).unionByName(load(orders.filter(key % 5 == 0), "2", 3))


@query(_VERSIONS_SQL + "SELECT o_orderkey, payload, max(loaded) AS loaded FROM v GROUP BY 1, 2")
def replace_merge_current(t):
    return current.replace_merge(_versions(t), ["o_orderkey", "payload"], ["loaded"])


@query(_VERSIONS_SQL + """SELECT o_orderkey, count(DISTINCT payload) AS versions,
       array_to_string(list_sort(list(DISTINCT payload)), ',') AS payloads FROM v GROUP BY 1 HAVING count(DISTINCT payload) > 1""")
def conflict_view(t):
    return current.conflicts(_versions(t), ["o_orderkey"], "payload").withColumn("payloads", F.array_join("payloads", ","))


@query(_VERSIONS_SQL + """SELECT o_orderkey, any_value(payload) AS payload, max(loaded) AS loaded FROM v
       GROUP BY 1 HAVING count(DISTINCT payload) = 1""")
def current_view(t):
    merged = current.replace_merge(_versions(t), ["o_orderkey", "payload"], ["loaded"])
    return current.unconflicted(merged, ["o_orderkey"], "payload")


@query("""SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus,
       arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders GROUP BY 1""")
def dim_latest_customer(t):
    return current.latest_attributes(t("orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


_SHIPPED = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(f"""SELECT l_partkey, arg_max(l_suppkey, ({', '.join(_SHIPPED)})) AS l_suppkey,
       arg_max(l_returnflag, ({', '.join(_SHIPPED)})) AS l_returnflag FROM lineitem GROUP BY 1""")
def dim_latest_part(t):
    return current.latest_attributes(t("lineitem"), "l_partkey", ["l_suppkey", "l_returnflag"], _SHIPPED)


@query("""SELECT o_custkey, arg_max_null(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END, (o_orderdate, o_orderkey))
       AS last_priority FROM orders GROUP BY 1""")
def dim_null_latest(t):
    orders = t("orders").withColumn("last_priority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    return current.latest_attributes(orders, "o_custkey", ["last_priority"], ["o_orderdate", "o_orderkey"])


@query("""SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week,
       isodow(d) >= 6 AS is_weekend FROM (SELECT CAST(unnest(generate_series(
           (SELECT min(o_orderdate) FROM orders)::DATE, (SELECT max(o_orderdate) FROM orders)::DATE, INTERVAL 1 DAY)) AS DATE) AS d)""")
def dim_date(t):
    return current.calendar(t("orders"), "o_orderdate").withColumn("date", F.col("date").cast("string"))


@query("""SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events
       ORDER BY ts DESC, user_id DESC, event_id DESC LIMIT 100""")
def latest_n(t):
    newest = current.top_n(t("events"), [F.desc("ts"), F.desc("user_id"), F.desc("event_id")], 100)
    return newest.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))


@query("SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 50")
def merged_latest_list(t):
    events, order = t("events").select("event_id", "user_id"), [F.desc("event_id")]
    kept = current.top_n(events.filter("event_id % 2 = 0"), order, 50)
    return current.merge_top_n(kept, events.filter("event_id % 2 = 1"), order, 50)


@query("""SELECT user_id, count(*) AS batches, count(*) FILTER (event_type = 'error') AS errors,
       CAST(CAST(count(*) FILTER (event_type = 'error') AS DECIMAL(18,2)) / count(*) >= 0.25 AS BOOLEAN) AS alarming
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
       WHERE nth <= 10 GROUP BY 1""")
def last_n_per_group(t):
    last = current.last_n_per_key(t("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 10)
    errors = n(F.col("event_type") == "error")
    return last.groupBy("user_id").agg(n().alias("batches"), errors.alias("errors"), (errors / n() >= 0.25).alias("alarming"))


# ---- reconciliation

_SIDES_SQL = """
    WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0),
    b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                 o_totalprice + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 4 <> 1)
"""


def _sides(t) -> tuple[DataFrame, DataFrame]:
    orders, key = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), F.col("o_orderkey")
    changed = orders.filter(key % 4 != 1).withColumns({
        "o_orderstatus": F.when(key % 7 != 0, F.col("o_orderstatus")),
        "o_totalprice": F.col("o_totalprice") + F.when(key % 9 == 0, 1).otherwise(0),
    })
    return orders.filter(key % 10 != 0), changed


@query(_SIDES_SQL + "SELECT o_orderkey FROM a WHERE o_orderkey IN (SELECT o_orderkey FROM b)")
def recon_overlap(t):
    return reconcile.overlap(*_sides(t), ["o_orderkey"])


@query(_SIDES_SQL + "SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)")
def recon_missing(t):
    return reconcile.missing(*_sides(t), ["o_orderkey"])


@query(_SIDES_SQL + "SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)")
def recon_extra(t):
    a, b = _sides(t)
    return reconcile.missing(b, a, ["o_orderkey"])


@query(_SIDES_SQL + """SELECT o_orderkey, concat_ws(',', CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END,
       CASE WHEN abs(a.o_totalprice - b.o_totalprice) > 0.5 THEN 'o_totalprice' END) AS columns FROM a JOIN b USING (o_orderkey)
       WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR abs(a.o_totalprice - b.o_totalprice) > 0.5""")
def recon_payload(t):
    found = reconcile.mismatches(*_sides(t), ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"], {"o_totalprice": 0.5})
    return found.withColumn("columns", F.array_join("columns", ","))


@query(_SIDES_SQL + """SELECT count(a.o_orderkey) AS left_rows, count(b.o_orderkey) AS right_rows,
       count(*) FILTER (a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL) AS matched,
       count(*) FILTER (b.o_orderkey IS NULL) AS missing, count(*) FILTER (a.o_orderkey IS NULL) AS extra,
       count(*) FILTER (a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL AND (a.o_custkey IS DISTINCT FROM b.o_custkey OR
           a.o_orderstatus IS DISTINCT FROM b.o_orderstatus)) AS mismatched FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def recon_summary(t):
    return reconcile.reconcile(*_sides(t), ["o_orderkey"], ["o_custkey", "o_orderstatus"])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(',', CASE WHEN p.p_partkey IS NULL THEN 'l_partkey' END,
       CASE WHEN s.s_suppkey IS NULL THEN 'l_suppkey' END, CASE WHEN o.o_orderkey IS NULL THEN 'l_orderkey' END) AS missing
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) p ON l_partkey = p.p_partkey
       LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON l_suppkey = s.s_suppkey
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o.o_orderkey
       WHERE p.p_partkey IS NULL OR s.s_suppkey IS NULL OR o.o_orderkey IS NULL""")
def orphans_fact_dim(t):
    found = reconcile.orphans(
        t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
        {
            "l_partkey": (t("part").filter("p_size <= 45"), "p_partkey"),
            "l_suppkey": (t("supplier").filter("s_acctbal >= 0"), "s_suppkey"),
            "l_orderkey": (t("orders").filter("o_orderstatus <> 'P'"), "o_orderkey"),
        },
    )
    return found.withColumn("missing", F.array_join("missing", ","))


def _kpis() -> dict[str, Column]:
    return {
        "records": n(),
        "quantity": F.sum(F.col("l_quantity").cast("long")),
        "amount": F.sum(money("l_extendedprice")).cast("decimal(28,2)").cast("string"),
    }


_KPI_SQL = """SELECT count(*) AS records, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
    CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS VARCHAR) AS amount FROM lineitem"""


@query(_KPI_SQL)
def kpi_totals(t):
    return reconcile.kpis(t("lineitem"), _kpis())


@query(f"""SELECT a.records AS left_records, a.quantity AS left_quantity, a.amount AS left_amount, b.records AS right_records,
       b.quantity AS right_quantity, b.amount AS right_amount, a = b AS agree
       FROM ({_KPI_SQL}) a, ({_KPI_SQL} WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) b""")
def kpi_parity(t):
    known = t("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return reconcile.kpi_parity(t("lineitem"), t("lineitem").join(known, "l_orderkey", "left_semi"), _kpis())


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def semi_join_batches(t):
    large = t("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(large, "c_custkey", "left_semi").select("c_custkey", "c_name", "c_mktsegment")


@query("""SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'known failure' WHEN 'signup' THEN 'test traffic' END AS reason
       FROM events""")
def lookup_quarantine(t):
    events = t("events").select("event_id", "event_type")
    reasons = events.sparkSession.createDataFrame([("error", "known failure"), ("signup", "test traffic")], "event_type string, reason string")
    return reconcile.lookup(events, F.broadcast(reasons), ["event_type"])


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 2""")
def journal_append(t):
    orders = t("orders").select("o_orderkey", "o_orderstatus")
    journal, batch = orders.filter("o_orderkey % 3 = 0"), orders.filter("o_orderkey % 3 <> 2")
    return reconcile.append_new(journal, batch.unionByName(batch), ["o_orderkey"])


@query("""WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type = 'error' GROUP BY 1),
       b AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type = 'error' GROUP BY 1),
       j AS (SELECT coalesce(a.user_id, b.user_id) AS user_id,
           CASE WHEN a.n >= 10 THEN 'CRITICAL' WHEN a.n >= 7 THEN 'WARNING' END AS old,
           CASE WHEN b.n >= 10 THEN 'CRITICAL' WHEN b.n >= 7 THEN 'WARNING' END AS new FROM a FULL JOIN b ON a.user_id = b.user_id)
       SELECT user_id, 'RESOLVED' AS state, old AS severity, 0 AS transition_order FROM j WHERE old IS NOT NULL AND old IS DISTINCT FROM new
       UNION ALL SELECT user_id, 'OPEN', new, 1 FROM j WHERE new IS NOT NULL AND old IS DISTINCT FROM new""")
def alert_transitions(t):
    from datetime import datetime, timezone

    from millrace.operators import alerts

    def signals(when: str) -> DataFrame:
        errors = t("events").filter(f"event_type = 'error' and ts {when} timestamp_ntz'2024-01-16 00:00:00'")
        counts = errors.groupBy("user_id").agg(n().alias("n")).filter("n >= 7")
        severity = F.when(F.col("n") >= 10, "CRITICAL").otherwise("WARNING")
        return counts.select(
            F.col("user_id").cast("string").alias("fingerprint"), F.lit("errors").alias("alert_name"), F.lit("events").alias("component"),
            F.lit(None).cast("string").alias("topic"), severity.alias("severity"), F.col("n").cast("double").alias("observed_value"),
            F.lit(7.0).alias("threshold"), F.lit("").alias("evidence_event_id"),
        )

    moved = alerts.transitions(signals("<"), signals(">="), datetime(2024, 2, 1, tzinfo=timezone.utc))
    return moved.select(F.col("fingerprint").cast("long").alias("user_id"), "state", "severity", "transition_order")


# ---- checks

@query("SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t):
    return checks.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (status IS NULL) AS status
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status FROM orders)""")
def check_not_null(t):
    holed = t("orders").withColumn("status", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")))
    return checks.not_null(holed, ["o_orderkey", "status"])


@query("SELECT count(*) AS violations FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)")
def check_unique(t):
    return checks.duplicate_keys(t("orders"), ["o_custkey"]).agg(n().alias("violations"))


@query("SELECT o_orderpriority, count(*) AS rows FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def check_accepted(t):
    return checks.not_accepted(t("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def check_relationship(t):
    parents = t("customer").filter("c_mktsegment <> 'BUILDING'")
    return checks.unrelated(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query("""SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, CAST(0 AS BIGINT) AS null_required,
       count(*) FILTER (l_extendedprice < l_quantity * 200) AS underpriced, count(*) FILTER (l_discount > 0.05) AS discounted
       FROM lineitem""")
def gate_single_pass(t):
    return checks.gate(
        t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey"],
        {"underpriced": F.col("l_extendedprice") < F.col("l_quantity") * 200, "discounted": F.col("l_discount") > 0.05},
    )


@query("""SELECT event_id, sha256(concat_ws('|', event_type, user_id::VARCHAR, ''))[1:24] AS fingerprint,
       sha1(concat_ws('|', event_type, user_id::VARCHAR)) AS name_sha1 FROM events""")
def deterministic_ids(t):
    return t("events").select(
        "event_id", ids.fingerprint("event_type", "user_id", F.lit("")).alias("fingerprint"),
        F.sha1(F.concat_ws("|", "event_type", F.col("user_id").cast("string"))).alias("name_sha1"),
    )


@query("""SELECT event_id, CAST(uuid AS VARCHAR) AS uuid FROM (SELECT event_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' ||
       CASE h[17:17] WHEN '0' THEN '8' WHEN '4' THEN '8' WHEN '8' THEN '8' WHEN 'c' THEN '8' WHEN '1' THEN '9' WHEN '5' THEN '9'
           WHEN '9' THEN '9' WHEN 'd' THEN '9' WHEN '2' THEN 'a' WHEN '6' THEN 'a' WHEN 'a' THEN 'a' WHEN 'e' THEN 'a' ELSE 'b' END
       || h[18:20] || '-' || h[21:32] AS uuid
       FROM (SELECT event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || CAST('event|' || event_id AS BLOB)) AS h FROM events))""")
def deterministic_uuids(t):
    name = F.concat_ws("|", F.lit("event"), F.col("event_id").cast("string"))
    return t("events").select("event_id", ids.uuid5(uuid.NAMESPACE_URL, name).alias("uuid"))


@query("""SELECT strftime(o_orderdate, '%Y%m') AS month, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END)
       AS VARCHAR) AS finished_value, count(*) FILTER (o_orderstatus = 'P') AS pending, count(*) AS orders FROM orders GROUP BY 1""")
def kpi_extended(t):
    by = t("orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month"))
    finished = F.sum(F.when(F.col("o_orderstatus") == "F", money("o_totalprice")).otherwise(F.lit(0).cast(MONEY)))
    return _plain(by.agg(finished.alias("finished_value"), n(F.col("o_orderstatus") == "P").alias("pending"), n().alias("orders")), "finished_value")


@query("""SELECT user_id, CAST(count(*) AS BIGINT) AS rows, CAST(CASE WHEN user_id % 5 = 0 THEN 0 ELSE count(*) * 1000.0 / ((user_id % 5) * 250) END
       AS DOUBLE) AS rate FROM events GROUP BY 1""")
def rows_per_second(t):
    counts = t("events").groupBy("user_id").agg(n().alias("rows"))
    return counts.withColumn("rate", ids.rows_per_second(F.col("rows"), F.col("user_id") % 5 * 250))
