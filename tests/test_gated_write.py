"""Gates in a write, and physical order proved from footers."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.commerce_contract import COMMERCE
from millrace.operators.contract import route, validate_json
from millrace.plans import gated_write as g
from millrace.sources.generator import as_log, commerce_events


def gate(df):
    return {r.check: r.violations for r in df.collect()}


@pytest.fixture
def numbers(spark):
    return spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("part"), F.col("id").cast("double").alias("value"))


def test_a_write_is_judged_as_it_runs(spark, numbers, tmp_path):
    rules = {"negative": F.col("value") < 0, "large": F.col("value") >= 990}
    path = str(tmp_path / "a")
    got = gate(g.gated_write(numbers, path, rules, ["part"], "zstd", ["id"], 1000))
    assert got == {"negative": 0, "large": 10, "rows": 0, "files": 0, "schema": 0, "empty": 0, "partitions": 0, "duplicates": 0}
    assert {r.codec for r in g.row_groups(spark, path).collect()} == {"ZSTD"} and spark.read.parquet(path).count() == 1000
    with pytest.raises(g.GateFailed, match="large=10"):
        g.require_gate(g.gated_write(numbers, str(tmp_path / "b"), rules), "numbers")
    odd = numbers.unionByName(numbers.limit(1)).withColumn("part", F.when(F.col("id") != 5, F.col("part")))
    got = gate(g.gated_write(odd, str(tmp_path / "c"), {}, ["part"], "snappy", ["id"], 1000))
    assert (got["rows"], got["duplicates"], got["partitions"], got["files"]) == (1, 1, 1, 0)
    assert gate(g.gated_write(numbers.limit(0), str(tmp_path / "d"), {}))["empty"] == 1
    # an older file in the folder is of another shape
    numbers.select("id", F.lit(1).alias("more")).write.option("compression", "snappy").parquet(str(tmp_path / "e"))
    got = gate(g.gated_write(numbers, str(tmp_path / "e"), {}, codec="zstd", mode="append"))
    assert got["rows"] == 2000 and got["files"] > 0 and got["schema"] > 0


def test_silver_is_rebuilt_behind_two_gates(spark, tmp_path):
    rows = validate_json(as_log(commerce_events(spark, 120)), COMMERCE).withColumn("ingest_date", F.to_date("ingested_at"))
    route(rows)[0].write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    got = gate(g.silver_rebuild(bronze, str(tmp_path / "silver")))
    assert not any(got.values()) and spark.read.parquet(str(tmp_path / "silver")).count() == bronze.count()
    first = bronze.limit(1)
    broken = {
        "duplicates=1": bronze.unionByName(first), "invalid_status=1": bronze.unionByName(first.withColumn("validation_status", F.lit("INVALID"))),
        "empty=1": bronze.limit(0),
    }
    for said, df in broken.items():
        with pytest.raises(g.GateFailed, match=f"bronze before the write.*{said}"):
            g.silver_rebuild(df, str(tmp_path / "never"))
    assert not (tmp_path / "never").exists()


def test_order_is_proved_from_footers(spark, numbers, tmp_path):
    rows = numbers.repartition(4)
    g.ordered_write(rows, str(tmp_path / "ordered"), ["id"], ["part"], files=5)
    rows.write.partitionBy("part").parquet(str(tmp_path / "not"))
    ordered, not_ = (g.overlaps(g.row_groups(spark, str(tmp_path / p), "id")).collect() for p in ("ordered", "not"))
    assert len(ordered) == len(not_) == 3 and sum(r.row_groups for r in ordered) >= 5
    assert all(r.overlapping == 0 for r in ordered) and all(r.overlapping == r.row_groups - 1 > 0 for r in not_)
    texts = numbers.select(F.format_string("%05d", F.col("id")).alias("t"), (F.col("id") - 500).alias("n"))
    g.ordered_write(texts, str(tmp_path / "t"), ["t"], files=3)
    for column in ("t", "n"):
        assert g.overlaps(g.row_groups(spark, str(tmp_path / "t"), column)).first().overlapping == 0
    assert g.row_groups(spark, str(tmp_path / "t"), "t").agg(F.sum("rows")).first()[0] == 1000
