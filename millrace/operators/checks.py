"""Data-quality checks that return violations as rows. Survey ids A3, A4, A6, A7, A26, A27, J7, Q1-Q3, Q10-Q16."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.rules import any_of


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: violations of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted ones, with their rows; nulls are not judged."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def unrelated(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key the parent lacks."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def gate(df: DataFrame, keys: Sequence[str], required: Sequence[str], violations: Mapping[str, Column]) -> DataFrame:
    """row_count, distinct_keys, null_required and each violation's rows, in one pass over the table."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.struct(*keys)).alias("distinct_keys"),
        F.count_if(any_of([F.col(c).isNull() for c in required])).alias("null_required"),
        *[F.count_if(c).alias(n) for n, c in violations.items()],
    )


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str]]:
    """(column, what is wrong) for missing, unexpected and differently typed columns."""
    have, want = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (actual, expected))
    found = [(n, f"missing, expected {t}") for n, t in want.items() if n not in have]
    found += [(n, f"unexpected {t}") for n, t in have.items() if n not in want]
    return found + [(n, f"{have[n]}, expected {t}") for n, t in want.items() if n in have and have[n] != t]


def assert_columns(df: DataFrame, expected: Sequence[str]) -> None:
    """Fails before a stream starts if columns have drifted."""
    lost, extra = sorted(set(expected) - set(df.columns)), sorted(set(df.columns) - set(expected))
    if lost or extra:
        raise ValueError(f"column drift: missing {lost}, extra {extra}")


@dataclass(frozen=True)
class CheckResult:
    name: str
    violations: int

    @property
    def passed(self) -> bool:
        return self.violations == 0


def run_checks(checks: Mapping[str, DataFrame]) -> list[CheckResult]:
    """Counts the violating rows of each check: only counts come to the driver."""
    return [CheckResult(name, df.count()) for name, df in checks.items()]


def require(checks: Mapping[str, DataFrame]) -> list[CheckResult]:
    """As :func:`run_checks`, but fails on the first violation, naming all."""
    results = run_checks(checks)
    if failed := [f"{r.name}: {r.violations}" for r in results if not r.passed]:
        raise ValueError("checks failed: " + ", ".join(failed))
    return results


def expect(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The same rows; reading one that breaks the condition fails the query."""
    return df.filter(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
