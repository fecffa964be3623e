import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import ids
from millrace.operators import checks, current, reconcile


def test_latest_keeps_nulls_and_skips_null_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "y")], "k string, t int, v string")
    assert [tuple(r) for r in current.latest_attributes(df, "k", ["v"], ["t"]).collect()] == [("a", None)]
    assert current.latest_attributes(df.limit(0), "k", ["v"], ["t"]).count() == 0


def test_conflicts_lose_all_versions(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "c", 1)], "k int, p string, loaded int")
    merged = current.replace_merge(df, ["k", "p"], ["loaded"])
    assert sorted((r.k, r.p, r.loaded) for r in merged.collect()) == [(1, "a", 2), (1, "b", 3), (2, "c", 1)]
    assert [r.k for r in current.unconflicted(merged, ["k"], "p").collect()] == [2]
    assert [(r.k, r.versions, r.payloads) for r in current.conflicts(df, ["k"], "p").collect()] == [(1, 2, ["a", "b"])]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 12, 28),), (date(2025, 1, 1),), (None,)], "d date")
    got = {r.date: r for r in current.calendar(df, "d").collect()}
    assert len(got) == 5 and got[date(2024, 12, 29)].day_of_week == 7 and got[date(2024, 12, 28)].is_weekend
    assert got[date(2024, 12, 30)].week_of_year == 1 and not got[date(2025, 1, 1)].is_weekend
    assert current.calendar(df.filter("d is null"), "d").count() == 0


def test_reconcile_finds_each_kind(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "z", 3.0), (4, "w", 4.0)], "k int, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.0005), (2, None, 2.0), (3, "y", 3.0), (5, "q", 5.0)], "k int, s string, v double")
    row = reconcile.reconcile(a, b, ["k"], ["s", "v"], {"v": 0.001}).first()
    assert (row.left_rows, row.right_rows, row.matched, row.missing, row.extra, row.mismatched) == (4, 4, 3, 1, 1, 1)
    assert [(r.k, r["columns"]) for r in reconcile.mismatches(a, b, ["k"], ["s", "v"]).orderBy("k").collect()] == [(1, ["v"]), (3, ["s"])]
    assert not reconcile.kpi_parity(a, b, {"total": F.sum("v")}).first().agree
    empty = reconcile.reconcile(a.limit(0), b.limit(0), ["k"], ["s"]).first()
    assert (empty.left_rows, empty.extra) == (0, 0)


def test_orphans_ignore_null_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (None, 11)], "a int, b int")
    dims = {"a": (spark.createDataFrame([(1,)], "id int"), "id"), "b": (spark.createDataFrame([(10,), (10,)], "id int"), "id")}
    got = sorted(((r.a or 0), r.missing) for r in reconcile.orphans(fact, dims).collect())
    assert got == [(0, ["b"]), (2, ["a"])]


def test_checks_fail_loudly(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    with pytest.raises(ValueError, match="twice: 1"):
        checks.require({"twice": checks.duplicate_keys(df.dropna(), ["k"]), "fine": df.limit(0)})
    with pytest.raises(ValueError, match="missing \\['z'\\]"):
        checks.assert_columns(df, ["k", "v", "z"])
    with pytest.raises(PySparkException, match="no key"):
        checks.expect(df, F.col("k").isNotNull(), "no key").collect()
    found = checks.schema_differences(df.schema, spark.createDataFrame([], "k long, w string").schema)
    assert dict(found) == {"k": "int, expected bigint", "w": "missing, expected string", "v": "unexpected string"}


def test_uuid5_and_instants(spark):
    df = spark.createDataFrame([(n,) for n in ("a", "é|x", "")], "n string")
    for r in df.select("n", ids.uuid5(uuid.NAMESPACE_DNS, F.col("n")).alias("u")).collect():
        assert r.u == str(uuid.uuid5(uuid.NAMESPACE_DNS, r.n))
    times = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("2026-01-01T07:00:00.5+07:00",), ("2026-01-01T00:00:00",), ("x",), (None,)], "t string")
    got = [r[0] for r in times.select(ids.iso_millis(ids.instant(F.col("t")))).collect()]
    assert got == ["2026-01-01T00:00:00.000Z", "2026-01-01T00:00:00.500Z", None, None, None]


def test_top_and_last_n(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    assert [r.v for r in current.top_n(df, [F.desc("v")], 2).collect()] == [29, 28]
    assert sorted(r.v for r in current.last_n_per_key(df, ["k"], [F.desc("v")], 1).collect()) == [27, 28, 29]
