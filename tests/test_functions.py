from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adtally.functions import numeric as num, text, time as tm
from adtally.functions.segments import five_segments, four_segments
from adtally.sources import readers as rd

def test_format_word_positions(values):
    for fmt in text.FORMATS:
        accepted = [f"(7) Zed-{fmt}", f"(7) Zed-{fmt}/2", f"(7) Zed-{fmt.lower()}-eu", f"{fmt}-zed", f"zed {fmt} eu", f"zed{fmt.title()}", f"9{fmt}"]
        rejected = [f"{fmt}zed", f"zed-{fmt}x", f"(7) {fmt}zed-eu", f"{fmt}_eu", f"({fmt})"]
        names = [n for n in accepted if fmt != "PUSH" or "zedPush" != n] + rejected
        expected = [fmt] * (len(names) - len(rejected)) + [text.OTHER] * len(rejected)
        assert values(names, text.ad_format) == expected, fmt
    assert values(["zed", "", None], text.ad_format) == [text.OTHER] * 3


def test_push_spellings_and_inner_push(values):
    names = ["(7) zed in-page", "ZED-INPAGE 2", "(7) zed-push", "zedpusher-push", "xpushx push-"]
    assert values(names, text.ad_format) == ["PUSH", "PUSH", "PUSH", "OTHER", "OTHER"]


def test_older_rules(values):
    """A name that starts with letters up to PUSH, or goes on after it, and formats that go on after the word."""
    names = ["zedpush", "(7) zed-push", "(7) zed-popup", "(7) zed-pushy push-"]
    assert values(names, text.ad_format) == ["PUSH", "PUSH", "OTHER", "PUSH"]
    assert values(names, lambda c: text.ad_format(c, "legacy")) == ["OTHER", "PUSH", "POP", "OTHER"]


def test_rule_order_decides(values):
    pairs = [(a, b) for i, a in enumerate(text.FORMATS) for b in text.FORMATS[i + 1:]]
    names = [f"(7) zed-{a}-{b}" for a, b in pairs]
    for rules, order in (("current", text.CURRENT_ORDER), ("legacy", text.LEGACY_ORDER)):
        assert values(names, lambda c: text.ad_format(c, rules)) == [min(p, key=order.index) for p in pairs]


def test_publisher_id(values):
    assert values(["(123) Name", "Name (5)", "(x) Name", None, "(7)"], text.publisher_id) == [123, None, None, None, 7]


def test_char_set():
    assert text.char_set("0-7") == list("01234567")
    assert text.char_set("8-9a-z") == list("89abcdefghijklmnopqrstuvwxyz")
    assert text.char_set("0,2,A-C") == ["0", "2", "a", "b", "c"]
    assert text.char_set("ab,1-3") == ["1", "2", "3", "a", "b"]
    assert text.char_set("8-a") == text.char_set("z-x") == text.char_set("- ,") == []
    assert text.char_set("a-c-e, 5-") == ["5", "a", "b", "c", "e"]


def test_column_names():
    assert text.column_name("CPA PV (24h)") == "cpa_pv_24h"
    assert text.column_name("Event-Date") == "event_date"


def test_brand_spelling(values):
    assert values([" BRAND_A ", "x brand_a", None], lambda c: text.canonical_label(c, ["Brand_A"])) == ["Brand_A", "x Brand_A", None]


def test_brand_ids(values):
    ids = ["1", "2", "2.0", "3", None, "x"]
    assert values(ids, lambda c: text.brand_from_id(c, {1: "a", 2: "b"})) == ["a", "b", "b", None, None, None]


def test_text_numbers(values):
    raw = ["1,5", "1 000,25", "", "  ", None, " 7 "]
    assert values(raw, num.text_number) == [Decimal("1.5"), Decimal("1000.25"), None, None, None, Decimal(7)]
    assert values(raw[2:5], lambda c: num.text_number(c, blank=F.lit(0))) == [0, 0, 0]
    assert values(["0,00004", "0,123456", "12345678901234,000000000001"], num.text_number) == [
        Decimal("0.00004"), Decimal("0.123456"), Decimal("12345678901234.000000000001")]
    assert values(["inf", "abc"], lambda c: num.text_number(c, infinite_as_null=True, strict=False)) == [None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(["abc"], num.text_number)


def test_rounding_rules(values):
    ties = ["0.125", "0.375", "-0.125"]
    decimal = lambda c: c.cast("decimal(10,4)")
    assert values(ties, lambda c: num.half_up(decimal(c), 2)) == [Decimal("0.13"), Decimal("0.38"), Decimal("-0.13")]
    assert values(ties, lambda c: num.half_even(decimal(c), 2)) == [Decimal("0.12"), Decimal("0.38"), Decimal("-0.12")]


def test_zero_denominators(values):
    n, zero = lambda c: c.cast("bigint"), F.lit(0)
    assert values(["5"], lambda c: num.ratio(n(c), zero)) == [None]
    assert values(["5"], lambda c: num.ratio_or_zero(n(c), zero)) == [0]
    assert values(["5"], lambda c: num.ratio_floor_one(n(c), zero)) == [5]


def test_segments(values):
    days = ["0", "6.99", "7", "13.99", "14", "29.99", "30", "89.99", "90"]
    five = ["0-7 days"] * 2 + ["7-14 days"] * 2 + ["14-30 days"] * 2 + ["30-90 days"] * 2 + ["90+ days"]
    assert values(days, lambda c: five_segments(c.cast("double"))) == five
    assert values(["3", "7"], lambda c: four_segments(c.cast("double"))) == ["7-14 days"] * 2


def test_end_bounds(values):
    instants = ["2024-01-31 00:00:00", "2024-01-31 12:00:00", "2024-01-31 23:59:59", "2024-01-31 23:59:59.5", "2024-02-01 00:00:00"]
    inside = lambda bound: values(instants, lambda c: tm.within(c.cast("timestamp"), "2024-01-01", "2024-01-31", bound))
    assert inside(tm.END_OF_DAY) == [True, True, True, True, False]
    assert inside(tm.LAST_SECOND) == [True, True, True, False, False]
    assert inside(tm.MIDNIGHT) == [True, False, False, False, False]


def test_calendar(values):
    stamp = lambda c: c.cast("timestamp")
    assert [str(d) for d in values(["2024-01-07 23:00:00", "2024-01-08"], lambda c: tm.period_start(stamp(c), "week"))] == ["2024-01-01", "2024-01-08"]
    assert values(["2024-01-07", "2024-01-06"], lambda c: tm.weekday_from_sunday(stamp(c))) == [0, 6]


def test_names_of_files(values):
    names = ["spend_2025-11-01.csv", "spend_20251102.csv", "03-11-2025.csv", "nothing.csv", "2025-13-40 05-11-2025.csv"]
    assert [str(d) for d in values(names, rd.date_from_file_name)] == ["2025-11-01", "2025-11-02", "2025-11-03", "None", "2025-11-05"]
    months = ["Spend November.csv", "oct.csv", "x.csv"]
    assert values(months, lambda c: rd.month_from_file_name(c, 2025, "2025-11")) == ["2025-11", "2025-10", "2025-11"]


def test_instants(values):
    got = values(["2025-11-01 10:00:00 UTC", "2025-11-01 10:00:00.5", "2025-11-01T10:00:00Z", "soon", None], rd.parse_instant)
    assert [str(g) for g in got] == ["2025-11-01 10:00:00", "2025-11-01 10:00:00.500000", "2025-11-01 10:00:00", "None", "None"]
