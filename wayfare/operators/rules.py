"""Ordered validation rules: the first one that fails names the reason."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``fails`` is true on bad rows; an unknown outcome (NULL) counts as a pass.

    ``settled`` says that ``fails`` is never NULL on a row that passed the rules before
    it. Its negation is then a plain filter, which reaches the file scan.
    """

    name: str
    fails: Column
    settled: bool = True


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first failing rule, NULL when all pass."""
    outcome = F.lit(None).cast("string")
    for rule in reversed(rules):
        outcome = F.when(rule.fails, rule.name).otherwise(outcome)
    return outcome


def passes(rules: Sequence[Rule]) -> Column:
    """True exactly where ``first_failure`` is NULL."""
    verdict = None
    for rule in rules:
        passed = ~rule.fails if rule.settled else ~F.coalesce(rule.fails, F.lit(False))
        verdict = passed if verdict is None else verdict & passed
    return F.lit(True) if verdict is None else verdict


def missing_or(column: str, bad: Callable[[Column], Column]) -> Column:
    value = F.col(column)
    return value.isNull() | bad(value)


def not_positive(name: str, column: str) -> Rule:
    return Rule(name, missing_or(column, lambda value: value <= 0))


def negative(name: str, column: str) -> Rule:
    return Rule(name, missing_or(column, lambda value: value < 0))
