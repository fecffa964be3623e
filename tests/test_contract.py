import json

import pytest

from millrace.functions.commerce_contract import COMMERCE, FAILED
from millrace.operators import contract as c
from millrace.operators import metrics, normalize
from millrace.sources.generator import as_log, commerce_events


@pytest.fixture(scope="module")
def valid(spark):
    raw = commerce_events(spark, 1, null_share=0).first().raw_payload
    return json.loads(raw)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "events")
    as_log(commerce_events(spark, 500)).write.parquet(path)
    return spark.read.parquet(path)


def judge(spark, *payloads, **how):
    texts = [(i, p if p is None or isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(texts, "id int, raw_payload string")
    return [r for r in c.validate_json(df, COMMERCE, **how).orderBy("id").collect()]


def errors(row):
    return [e.split("_")[0] for e in row.validation_errors]


def test_generated_events_are_valid(spark):
    counts = c.status_counts(c.validate_json(as_log(commerce_events(spark, 200, null_share=0)), COMMERCE)).collect()
    assert {r.validation_status for r in counts} <= {"VALID", "WARNING"} and sum(r["rows"] for r in counts) == 200


def test_golden_cases(spark, valid):
    warning = valid | {"category": "Điện tử", "sub_category": "Laptop", "brand": "Nike", "reviewerName": None, "paymentStatus": FAILED, "shippingStatus": "Đã giao"}
    without = {k: v for k, v in valid.items() if k != "orderID"}
    got = judge(spark, valid, warning, valid | {"asin": None}, json.dumps(valid)[:50], without, valid | {"quantity": "two"})
    assert [r.validation_status for r in got] == ["VALID", "WARNING", "INVALID", "INVALID", "INVALID", "INVALID"]
    assert got[1].validation_warnings == ["W101_UNUSUAL_BRAND_CATEGORY", "W102_PAYMENT_SHIPPING_INCONSISTENT"]
    assert [errors(r) for r in got[2:]] == [["E006"], ["E001"], ["E003"], ["E005"]]
    assert got[4].missing_fields == ["orderID"]


def test_unknown_parents_break_the_usual_brand_rule(spark, valid):
    got = judge(spark, valid | {"category": "Unknown"}, valid | {"brand": "Unknown", "quantity": 5})
    assert [errors(r) for r in got] == [["E111"], ["E113", "E116"]]
    assert [r.validation_warnings for r in got] == [["W101_UNUSUAL_BRAND_CATEGORY"]] * 2


def test_structure_edges(spark, valid):
    twice = json.dumps(valid)[:-1] + ', "asin": "B000000000"}'
    got = judge(spark, "[1]", "3", "null", None, "{}", valid | {"extra": 1}, twice, valid | {"helpful": []})
    assert [errors(r) for r in got] == [["E002"], ["E002"], ["E002"], ["E001"], ["E003"], ["E004"], ["E001"], ["E005"]]
    assert got[5].unexpected_fields == ["extra"] and got[3].payload is None and got[6].payload is not None


@pytest.mark.parametrize(
    ("change", "codes"),
    [
        ({"reviewerID": "short"}, ["E101"]), ({"asin": "X"}, ["E102"]), ({"reviewText": "  "}, ["E103"]), ({"overall": 4.5}, ["E104"]),
        ({"day_diff": 3}, ["E107"]), ({"day_diff": 1064}, []), ({"quantity": 5}, ["E116"]), ({"storeID": "STR-A-11"}, ["E118"]),
        ({"region": "Nowhere"}, ["E121"]), ({"helpful": [1]}, ["E130"]), ({"unitPrice": 49_999}, ["E114"]),
        ({"helpful_yes": 501}, ["E108"]), ({"overall": 4}, []), ({"overall": 4.0}, []), ({"quantity": 1.0}, ["E005"]),
        ({"totalAmount": 60_000.5}, ["E201"]), ({"helpful": [0, 600]}, ["E202"]), ({"reviewTime": "not a day"}, ["E206"]),
    ],
)
def test_single_changes(spark, valid, change, codes):
    (row,) = judge(spark, valid | change)
    assert errors(row) == codes


def test_layers_cascade(spark, valid):
    (row,) = judge(spark, valid | {"quantity": 5, "city": "Huế", "region": "Miền Nam", "brand": "Nike", "category": "Mỹ phẩm"})
    # field errors hide cross-field ones; warnings show regardless
    assert errors(row) == ["E116"] and row.validation_warnings == ["W101_UNUSUAL_BRAND_CATEGORY"]


def test_null_predicates_and_strict(spark, valid):
    wide = valid | {"quantity": 2**40, "helpful": [12, None]}
    (loose,), (strict,) = judge(spark, wide), judge(spark, wide, strict=True)
    assert "E116" not in errors(loose) and errors(strict) == ["E005"]


def test_routing_invariants(spark, log):
    checked = c.validate_json(log, COMMERCE)
    clean, dead = c.route(checked)
    assert clean.count() + dead.count() == 500 and dead.count() > 20
    assert c.inconsistent(checked).count() == 0
    assert {r.code for r in c.rule_counts(checked).collect()} == {"E006_REQUIRED_NULL"}
    assert c.rule_counts(checked.limit(0)).count() == 0


def test_silver(spark, valid):
    raw = json.dumps(valid, ensure_ascii=False)
    lineage = [("t", 0, i, raw) for i in (0, 1, 2, 0)]
    df = spark.createDataFrame(lineage, "kafka_topic string, kafka_partition int, kafka_offset long, raw_payload string")
    rows = c.validate_json(df.selectExpr("*", "timestamp'2026-01-01 00:00:00' as kafka_timestamp"), COMMERCE)
    rows = rows.selectExpr("*", "date'2026-01-01' as ingest_date")
    silver = normalize.to_silver(rows)
    assert silver.columns == normalize.silver_columns() and len(silver.columns) == 42
    assert rows.count() == 4 and silver.count() == 3
    assert dict(silver.dtypes)["unit_price"] == "decimal(18,2)" and dict(silver.dtypes)["overall_rating"] == "tinyint"
    assert silver.filter("unit_price * quantity <> total_amount or review_date is null").count() == 0
    staged = normalize.staging_batch(silver, "b1")
    assert len(staged.columns) == 41 and staged.filter("length(silver_row_hash) = 64").count() == 3


def test_minute_metrics(spark):
    rows = [
        ("VALID", "2026-09-24 15:30:05", 2, 5_000_000.0, "paid", 4.0), ("WARNING", "2026-09-24 15:30:59", 1, 1_000_000.0, "no", 3.0),
        ("INVALID", "2026-09-24 15:30:10", 9, 7.0, "paid", 5.0), ("VALID", "2026-09-24 15:31:00", 1, 1.0, "paid", None),
    ]
    df = spark.createDataFrame(rows, "validation_status string, ts string, quantity int, totalAmount double, paymentStatus string, overall double")
    got = {r.ingest_minute: r.asDict() for r in metrics.commerce_minutes(df.selectExpr("*", "cast(ts as timestamp) kafka_timestamp"), "paid").collect()}
    first = got["202609241530"]
    assert first == {
        "ingest_minute": "202609241530", "events_total": 3, "valid_count": 1, "warning_count": 1, "invalid_count": 1, "record_count": 2,
        "quantity_sum": 3, "gross_item_value": 6_000_000.0, "successful_labeled_value": 5_000_000.0, "rating_sum": 7.0, "rating_count": 2,
    }
    assert got["202609241531"]["rating_count"] == 0


def test_expected_schemas_take_the_short_way_and_no_others(spark, valid):
    """The short way says the same as the long one, whatever the names are; forged names do not pass."""
    from pyspark.sql import functions as F

    def sound(contract, *payloads):
        df = spark.createDataFrame([(i, json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)], "id int, raw string")
        schema = F.schema_of_variant(F.try_parse_json("raw"))
        return [r[0] for r in df.orderBy("id").select(schema.rlike(c.sound_schema(contract))).collect()]

    assert sound(COMMERCE, valid, valid | {"reviewerName": None}, valid | {"overall": 4.5}, dict(reversed(valid.items()))) == [True] * 4
    assert sound(COMMERCE, valid | {"asin": None}, valid | {"quantity": 1.5}, valid | {"x": 1}, {"asin": "B"}, [valid]) == [False] * 5
    odd = c.Contract("v", (c.Field("a b", "string"), c.Field("đ", "int", "integer"), c.Field("Z", "string", nullable=True)))
    payloads = [
        {"a b": "x", "đ": 1, "Z": None}, {"a b": None, "đ": 1, "Z": "z"}, {"a b": "x", "đ": "1", "Z": "z"}, {"a b": "x", "đ": 2**40, "Z": "z"},
        {"a b": "x", "Z": "z"}, {"Z: STRING, a b": "x", "đ": 1}, {"a b": "x", "đ": 1, "Z": "z", "y": 0},
    ]
    df = spark.createDataFrame([(i, json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)], "id int, raw_payload string")
    found = {strict: [errors(r) for r in c.validate_json(df, odd, strict=strict).orderBy("id").collect()] for strict in (False, True)}
    assert found[False] == [[], ["E006"], ["E005"], [], ["E003"], ["E003", "E004"], ["E004"]]
    assert found[True] == [[], ["E006"], ["E005"], ["E005"], ["E003"], ["E003", "E004"], ["E004"]]
