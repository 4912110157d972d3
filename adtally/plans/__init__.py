"""Report plans over the star-schema tables, each with its SQL twin."""

from __future__ import annotations


def catalog() -> dict:
    """All registered reports by name."""
    from . import (arppu_reports, bid_reports, campaign_reports, deposit_reports,  # noqa: F401  they register
                   insight_reports, io_reports, quality_reports, reactivation_reports, split_test_reports)
    from .registry import REPORTS

    return REPORTS
