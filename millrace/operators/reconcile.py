"""Reconciliation of two tables. Survey ids J1-J7, J9, J11, J12, U1, U2, U4, A13, A14, Q4-Q9."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import any_of


def overlap(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of both sides."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys))


def missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks; swap the sides for extra rows."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def mismatches(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: Mapping[str, float] | None = None
) -> DataFrame:
    """Keys of both sides where a column differs, nulls equal; ``columns`` lists which. Numbers may have a tolerance."""
    tolerance = tolerance or {}
    a, b = left.alias("a"), right.alias("b")

    def differs(c: str) -> Column:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        if c in tolerance:
            return (x.isNull() != y.isNull()) | F.coalesce(F.abs(x - y) > tolerance[c], F.lit(False))
        return ~x.eqNullSafe(y)

    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    which = F.array_compact(F.array(*[F.when(differs(c), F.lit(c)) for c in columns]))
    return joined.filter(any_of([differs(c) for c in columns])).select(*[F.col(f"a.{k}") for k in keys], which.alias("columns"))


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: Mapping[str, float] | None = None
) -> DataFrame:
    """One row of counts from one full outer join: left_rows, right_rows, matched, missing, extra, mismatched.

    Keys are unique on either side (check with ``duplicate_keys``); key columns are null-safe.
    """
    tolerance = tolerance or {}
    a = left.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(c).alias(f"_x_{c}") for c in columns], F.lit(1).alias("_a"))
    b = right.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(c).alias(f"_y_{c}") for c in columns], F.lit(1).alias("_b"))

    def differs(c: str) -> Column:
        x, y = F.col(f"_x_{c}"), F.col(f"_y_{c}")
        if c in tolerance:
            return (x.isNull() != y.isNull()) | F.coalesce(F.abs(x - y) > tolerance[c], F.lit(False))
        return ~x.eqNullSafe(y)

    same_key = F.col(f"_a_{keys[0]}").eqNullSafe(F.col(f"_b_{keys[0]}"))
    for k in keys[1:]:
        same_key = same_key & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return a.join(b, same_key, "full_outer").agg(
        F.count("_a").alias("left_rows"),
        F.count("_b").alias("right_rows"),
        F.count_if(both).alias("matched"),
        F.count_if(F.col("_b").isNull()).alias("missing"),
        F.count_if(F.col("_a").isNull()).alias("extra"),
        F.count_if(both & any_of([differs(c) for c in columns])).alias("mismatched"),
    )


def orphans(fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows with a key that its dimension lacks; ``missing`` lists which. Null keys are no orphans.

    Rows with a null key are spread over all tasks by a hash of the row instead of meeting in one.
    """
    row = F.xxhash64(*[c for c, kind in fact.dtypes if "map<" not in kind and "variant" not in kind])  # those have no hash
    out = fact
    for key, (dim, column) in references.items():
        known = dim.select(F.col(column).alias(f"_{key}")).distinct()
        alike = F.xxhash64(F.col(key).try_cast(dim.schema[column].dataType))
        spread = F.when(F.col(key).isNull(), row).otherwise(alike) == F.xxhash64(f"_{key}")
        out = out.join(known, (F.col(key) == F.col(f"_{key}")) & spread, "left")
    lost = {k: F.col(k).isNotNull() & F.col(f"_{k}").isNull() for k in references}
    which = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in lost.items()]))
    return out.filter(any_of(list(lost.values()))).select(*fact.columns, which.alias("missing"))


def kpis(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def kpi_parity(left: DataFrame, right: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Both sides' one-row aggregates beside each other, and whether all agree. The cross join is of one row with one."""
    a = kpis(left, {f"left_{n}": c for n, c in measures.items()})
    b = kpis(right, {f"right_{n}": c for n, c in measures.items()})
    joined = a.crossJoin(b)
    same = ~any_of([~F.col(f"left_{n}").eqNullSafe(F.col(f"right_{n}")) for n in measures])
    return joined.withColumn("agree", same)


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a table with one row per key, such as a quarantine registry."""
    return df.join(table, list(keys), "left")


def append_new(journal: DataFrame, batch: DataFrame, identity: Sequence[str]) -> DataFrame:
    """The journal and the batch's rows whose identity it lacks, each once."""
    return journal.unionByName(batch.dropDuplicates(list(identity)).join(journal, list(identity), "left_anti"))
