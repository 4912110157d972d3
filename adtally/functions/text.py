"""Publisher ids, ad formats and brands read out of names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from .rules import first_match

# The ad formats.
FORMATS = ["POP", "PUSH", "VIDEO", "BANNER", "NATIVE"]
OTHER = "OTHER"

# The order in which a name is tested, current and older.
CURRENT_ORDER = ["POP", "BANNER", "VIDEO", "PUSH", "NATIVE"]
LEGACY_ORDER = ["BANNER", "VIDEO", "PUSH", "POP", "NATIVE"]

# Extra spellings of a format, and PUSH inside a longer word.
_ALSO = {"PUSH": ["IN-PAGE", "INPAGE"]}
_INNER_PUSH = {"current": "[A-Z]PUSH[A-Z]", "legacy": "^[A-Z]*PUSH|PUSH[A-Z]"}


def publisher_id(label: Column) -> Column:
    """The number in ``"(123) Name"``, else NULL."""
    return F.regexp_extract(label, r"^\((\d+)\)", 1).try_cast("long")


def _word_pattern(fmt: str, boundary: str) -> str:
    """``fmt`` next to a dash, before a space, or at the end of the name."""
    forms = [f"-{fmt}{boundary}", f"{fmt}-", rf"{fmt}\s", f"{fmt}$"]
    return "|".join(forms + _ALSO.get(fmt, []))


def ad_format(name: Column, rules: str = "current") -> Column:
    """Ad format by the first word test that fits; ``rules`` is current or legacy.

    A NULL name has no format word, so it is OTHER.
    """
    order, boundary = {"current": (CURRENT_ORDER, r"\b"), "legacy": (LEGACY_ORDER, "")}[rules]
    upper = F.upper(F.coalesce(name, F.lit("")))
    cases = []
    for fmt in order:
        # Most names lack the letters altogether, which is cheaper to see than the pattern.
        possible = upper.contains(fmt)
        for spelling in _ALSO.get(fmt, []):
            possible = possible | upper.contains(spelling)
        test = possible & upper.rlike(_word_pattern(fmt, boundary))
        if fmt == "PUSH":
            test = test & ~upper.rlike(_INNER_PUSH[rules])
        cases.append((test, fmt))
    return first_match(cases, OTHER)


def format_from_sub_id(sub_id: Column) -> Column:
    """Fallback format: the first format word found anywhere in the sub id."""
    return first_match([(sub_id.ilike(f"%{fmt}%"), fmt) for fmt in FORMATS], OTHER)


def brand_from_website(website: Column, patterns: Sequence[tuple[str, Sequence[str]]],
                       otherwise: str | None) -> Column:
    """Brand whose website fragment occurs first in ``patterns``: [(brand, [fragment, ...]), ...]."""
    cases = []
    for brand, fragments in patterns:
        test = F.lit(False)
        for fragment in fragments:
            test = test | website.ilike(f"%{fragment}%")
        cases.append((test, brand))
    return first_match(cases, F.lit(otherwise).cast("string"))


def brand_from_id(advertiser_id: Column, labels: Mapping[int, str]) -> Column:
    """Numeric advertiser id to brand; unknown ids give NULL."""
    number = advertiser_id.try_cast("double")
    return first_match([(number == F.lit(float(k)), v) for k, v in labels.items()],
                       F.lit(None).cast("string"))


def canonical_label(label: Column, spellings: Sequence[str]) -> Column:
    """Trim, and give known brand words their canonical letter case."""
    result = F.trim(label)
    for word in spellings:
        result = F.regexp_replace(result, f"(?i){re.escape(word)}", word)
    return result


def is_reference_name(name: Column, markers: Sequence[str] = ("PLR", "NOR")) -> Column:
    """Does a publisher name carry one of the reference-group markers?"""
    test = F.lit(False)
    for marker in markers:
        test = test | F.upper(name).contains(marker)
    return test


def column_name(raw: str) -> str:
    """Sheet header to column name: lower case, spaces and dashes to underscores."""
    return re.sub(r"[^a-z0-9_]", "", raw.lower().replace(" ", "_").replace("-", "_"))


def char_set(spec: str) -> list[str]:
    """Characters named by a notation such as ``"0-7"``, ``"0,2,4"`` or ``"8-9a-z"``, in lower case.

    Read from left to right, an item is a letter or digit, or two of them with a dash
    between: the characters from one to the other.  Two digits or two letters make a range;
    a mixed one such as ``8-a``, or one that runs backwards, names nothing.  Anything else
    only separates.
    """
    plain = lambda c: c.isascii() and c.isalnum()
    left, found = list(reversed(spec.lower())), set()
    while left:
        first = left.pop()
        if not plain(first):
            continue
        last = first
        if len(left) > 1 and left[-1] == "-" and plain(left[-2]):
            left.pop()
            last = left.pop()
        if first.isdigit() == last.isdigit():
            found |= {chr(code) for code in range(ord(first), ord(last) + 1)}
    return sorted(found)
