"""Declarative rules that compile to Column expressions.

A rule has a code and a predicate that is true where the row breaks it. A NULL predicate yields no code unless ``strict``
is set; codes of a layer come out as an array in rule order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    broken: Callable[[Callable[[str], Column]], Column]


Get = Callable[[str], Column]


def pattern(code: str, field: str, regex: str) -> Rule:
    return Rule(code, lambda get: ~get(field).rlike(regex))


def blank(code: str, field: str) -> Rule:
    return Rule(code, lambda get: F.length(F.trim(get(field))) == 0)


def outside(code: str, field: str, low, high) -> Rule:
    return Rule(code, lambda get: ~get(field).between(F.lit(low), F.lit(high)))


def not_one_of(code: str, field: str, values: Sequence) -> Rule:
    return Rule(code, lambda get: ~get(field).isin(list(values)))


def array_size_not(code: str, field: str, size: int) -> Rule:
    return Rule(code, lambda get: F.size(get(field)) != size)


def child_not_of_parent(code: str, parent: str, child: str, children: Mapping[str, Sequence[str]]) -> Rule:
    """No parent has the child among its own; so a parent without an entry breaks the rule too."""

    def broken(get: Get) -> Column:
        return ~any_of([(get(parent) == p) & get(child).isin(list(c)) for p, c in children.items()])

    return Rule(code, broken)


def when(code: str, broken: Callable[[Get], Column]) -> Rule:
    return Rule(code, broken)


def any_of(conditions: Sequence[Column]) -> Column:
    """Disjunction; false for no conditions."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def codes(rules: Sequence[Rule], get: Get, gate: Column | None = None, strict: bool = False) -> Column:
    """Array of the codes of broken rules, a code that several rules share once; empty where ``gate`` is not true.

    The gate stands once before the whole array, not in each rule: layers that build on each other stay small however often
    the optimizer copies them.
    """
    none = F.array().cast("array<string>")
    found = []
    for rule in rules:
        broken = rule.broken(get)
        found.append(F.when(F.coalesce(broken, F.lit(True)) if strict else broken, F.lit(rule.code)))
    if not found:
        return none
    # array_compact is a lambda, which keeps the rules out of whole-stage code: all of them in one method are too much for the JVM to
    # compile, whereas a projection of their own is cut into small methods
    listed = F.array_compact(F.array(*found)).cast("array<string>")
    if len({rule.code for rule in rules}) < len(rules):
        listed = F.array_distinct(listed)
    return listed if gate is None else F.when(gate, listed).otherwise(none)


def status_of(errors: Column, warnings: Column) -> Column:
    return F.when(F.size(errors) > 0, "INVALID").when(F.size(warnings) > 0, "WARNING").otherwise("VALID")
