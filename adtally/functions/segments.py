"""Inactivity segments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .rules import buckets, first_match

# The segment labels and their day limits.
SEGMENTS = ["0-7 days", "7-14 days", "14-30 days", "30-90 days", "90+ days"]
LIMITS = [7.0, 14.0, 30.0, 90.0]

REACTIVATION_SEGMENTS = SEGMENTS[1:]


def five_segments(days: Column) -> Column:
    """All gaps, starting with those under a week."""
    return buckets(days, list(zip(LIMITS, SEGMENTS)), SEGMENTS[-1])


def four_segments(days: Column) -> Column:
    """Reactivations only: a gap under a week falls into the first label too."""
    return buckets(days, list(zip(LIMITS[1:], SEGMENTS[1:])), SEGMENTS[-1])


def segment_order(label: Column) -> Column:
    """Position of a label in the fixed report order."""
    return first_match([(label == s, i) for i, s in enumerate(SEGMENTS, 1)], len(SEGMENTS) + 1).cast("int")
