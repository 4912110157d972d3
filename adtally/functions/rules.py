"""Ordered rule tables turned into CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Rule(NamedTuple):
    """The first rule whose test holds decides."""

    test: Column
    action: str
    priority: str = "LOW"


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """CASE WHEN over (test, value) pairs in order."""
    chain = F
    for test, value in cases:
        chain = chain.when(test, value)
    return chain.otherwise(otherwise) if cases else F.lit(otherwise)


def action_of(rules: Sequence[Rule], otherwise: str) -> Column:
    return first_match([(r.test, r.action) for r in rules], otherwise)


def priority_of(rules: Sequence[Rule], otherwise: str = "LOW") -> Column:
    return first_match([(r.test, r.priority) for r in rules], otherwise)


def steps(value: Column, thresholds: Sequence[tuple[str, str]], below: str) -> Column:
    """Label by the highest threshold reached; thresholds descend, as decimal text."""
    limits = [(value >= F.lit(t).cast("decimal(28,10)"), label) for t, label in thresholds]
    return first_match(limits, below)


def buckets(value: Column, upper_bounds: Sequence[tuple[float, str]], last: str) -> Column:
    """Label by the first upper bound (exclusive) above ``value``."""
    return first_match([(value < F.lit(b), label) for b, label in upper_bounds], last)
