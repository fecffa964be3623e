"""Work that must not meet in one task, nor be done once more for each filter above it."""

import json
import re

from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from millrace import registry
from millrace import registry_commerce as commerce
from millrace import registry_layers as layers
from millrace.functions.commerce_contract import COMMERCE
from millrace.functions.rules import outside
from millrace.operators import contract
from millrace.plans import monitoring
from millrace.sources import byte_log, generator
from millrace.sources.generator import as_log, commerce_events
from millrace.streaming import ingest


def table(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_on_a_status_do_not_copy_the_validation(spark):
    log = spark.createDataFrame([("{}",)], "raw_payload string")
    rows = contract.validate_json(log, COMMERCE)
    parsed = plan_of(rows).count("from_json")
    for layer in contract.route(rows):
        assert plan_of(layer).count("from_json") == parsed
    checked = contract.validate_table(spark.createDataFrame([(1,)], "k int"), contract.Contract("k", (contract.Field("k", "int", "integer"),), (outside("E101_K", "k", 10, 90),)))
    assert plan_of(contract.inconsistent(checked)).count("E101_K") == plan_of(checked).count("E101_K")


def test_all_tasks_of_a_batch_write(spark, tmp_path):
    rows, at = commerce._log(table(spark)), str(tmp_path)
    for q in ingest.start_ingest(commerce._log_stream(rows), COMMERCE, f"{at}/bronze", f"{at}/dlq", f"{at}/cp", {"availableNow": True}):
        q.awaitTermination()
        assert not q.exception()
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == commerce.BATCHES
    ingest.silver_increment(spark, f"{at}/bronze", f"{at}/silver", f"{at}/cp/silver")
    for name in ("bronze", "dlq", "silver"):
        written = spark.read.parquet(f"{at}/{name}")
        files = written.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
        assert files.count() > commerce.BATCHES and files.agg(F.max("n")).first()[0] < written.count() / 2


def test_ranges_of_a_large_log_grow():
    assert len(byte_log.ranges({}, {"a": "640:0:"}, 64)) == 10
    assert len(byte_log.ranges({}, {"a": f"{1 << 30}:0:"}, 64 << 10)) <= byte_log.MANY_RANGES
    assert len(byte_log.ranges({}, {"a": f"{1 << 40}:0:"}, 64 << 10)) == (1 << 40) // byte_log.SPLIT_BYTES


def test_a_partition_of_many_rows_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(monitoring, "FILE_ROWS", 100, raising=False)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        monitoring._add(spark.range(10_000).withColumns({"pass": F.lit(1), "m": F.create_map(F.lit("a"), F.lit(1))}), str(tmp_path / "t"), ["pass"])
    finally:
        spark.conf.set(key, before)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert written.select("id").distinct().count() == written.count() == 10_000
    assert written.select(F.input_file_name()).distinct().count() > 1


def test_the_registry_of_failures_is_many_documents(spark, monkeypatch):
    seen, real = [], layers.tables.quarantine_registry
    monkeypatch.setattr(layers, "REGISTRY_IDS", 20, raising=False)
    monkeypatch.setattr(layers.tables, "quarantine_registry", lambda s, path: seen.append(path) or real(s, path))
    accepted, rejected = layers._routed(table(spark))
    events, faults = spark.read.parquet(f"{SMALL}/events.parquet"), len(layers.LINE_FAULTS)
    assert spark.read.text(seen[0]).count() > 1
    assert rejected.filter("reason = 'known failure'").count() == events.filter(F.col("event_id") % faults == faults - 1).count()
    assert accepted.count() == events.filter(F.col("event_id") % faults == 0).count()


def test_rows_are_validated_once(spark):
    silver = registry.queries()["commerce_silver"](spark, SMALL)
    assert "from_json" not in plan_of(silver)  # it reads the bronze that was written
    assert plan_of(registry.queries()["quality_invariants"](spark, SMALL)).count("FileScan parquet") == 2


def test_rules_are_compiled_by_the_jvm(spark):
    """The JVM interprets methods of over 8,000 bytes of code however often they run."""
    rows = contract.validate_json(spark.createDataFrame([("{}",)], "raw_payload string"), COMMERCE)
    for shown in (rows, contract.route(rows)[0], contract.inconsistent(rows)):
        text = spark._jvm.PythonSQLUtils.explainString(shown._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000


def test_plain_texts_are_not_parsed_into_variants(spark):
    """A text that the pattern takes is sound by its variant too, and odd ones go the longer way."""
    valid = json.loads(commerce_events(spark, 1, null_share=0).first().raw_payload)
    text = json.dumps(valid, ensure_ascii=False)
    plain = [
        text, json.dumps(valid, ensure_ascii=False, indent=1), f"\n {text}\t", json.dumps(valid | {"reviewerName": None}), json.dumps(valid | {"overall": -4, "unitPrice": 1.5e7}),
        text.replace('"quantity": ', '"quantity":-'), json.dumps(valid | {"helpful": [-1]}), json.dumps(valid | {"totalAmount": 2}).replace('"totalAmount": 2', '"totalAmount": 2.5E+3'),
    ]
    odd = [
        json.dumps(dict(reversed(valid.items()))), json.dumps(valid | {"summary": 'a "b"'}), text.replace('"Summary', '"Sum\nmary'), text + "x", text[:-1], f"[{text}]", text.replace("{", '{"x": 1, '),
        text[:-1] + ', "asin": "B"}', json.dumps(valid | {"asin": None}), json.dumps(valid | {"helpful": []}), json.dumps(valid | {"helpful": [1, None]}), json.dumps(valid | {"day_diff": 4.0}),
        json.dumps(valid | {"quantity": "2"}), json.dumps(valid | {"quantity": 10**18}), text.replace('"day_diff": ', '"day_diff": 0'), text.replace('"overall": ', '"overall": .'), "\v" + text,
        json.dumps(valid | {"overall": float("nan")}), json.dumps(valid | {"helpful": [1] * 65}), None,
    ]
    # escapes of letters beyond ASCII are escapes too
    plain = [p if "\\u" not in p else json.dumps(json.loads(p), ensure_ascii=False) for p in plain]
    df = spark.createDataFrame([(i, p) for i, p in enumerate([*plain, *odd])], "id int, raw string").orderBy("id")
    schema = F.schema_of_variant(F.try_parse_json("raw")).rlike(contract.sound_schema(COMMERCE))
    got = [tuple(r) for r in df.select(F.col("raw").rlike(contract.plain_object(COMMERCE)), F.coalesce(schema, F.lit(False))).collect()]
    assert [bool(p) for p, _ in got] == [True] * len(plain) + [False] * len(odd)
    assert all(sound for taken, sound in got if taken)


def test_generated_events_are_of_more_tasks_the_more_they_are(spark):
    assert commerce_events(spark, 0).count() == 0 and commerce_events(spark, 1000).rdd.getNumPartitions() == 8
    assert commerce_events(spark, 36_000_000).rdd.getNumPartitions() == 36_000_000 // generator.TASK_ROWS
    assert commerce_events(spark, 100, partitions=3).rdd.getNumPartitions() == 3
    few, many = (as_log(commerce_events(spark, 100, partitions=n)) for n in (1, 7))
    assert few.exceptAll(many).isEmpty() and many.count() == 100


def test_generated_logs_are_compared_by_digests(spark, monkeypatch):
    """No aggregate has the texts of two logs as its keys; logs that differ are told apart."""
    compared, real = [], DataFrame.exceptAll
    monkeypatch.setattr(DataFrame, "exceptAll", lambda a, b: compared.append((a, b)) or real(a, b))
    (row,) = layers.generated_events(table(spark)).collect()
    ((a, b),) = compared
    assert row.repeatable and a.schema == b.schema and [f.dataType.typeName() for f in a.schema] == ["binary"]
    assert a.select(F.max(F.octet_length(a.columns[0]))).first()[0] == 32
    logs, made = iter((42, 42, 43)), generator.commerce_events
    next(logs)
    monkeypatch.setattr(generator, "commerce_events", lambda s, rows: made(s, rows, next(logs)))
    (row,) = layers.generated_events(table(spark)).collect()
    assert not row.repeatable and row["rows"] == row.objects
