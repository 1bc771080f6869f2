"""Column functions on hand-made values."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from funnelspark.functions import dates, rules, text
from funnelspark.functions.fuzzy import common_length, name_ratio


def values(frame, rows, schema, *cols):
    out = frame(rows, schema).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()
    return [tuple(r) if len(cols) > 1 else r[0] for r in out]


def test_phone(frame):
    rows = [("(555) 123-4567",), ("1-555-123-4567",), ("555 1234",), ("12",), (None,), ("2-555-123-4567",)]
    assert values(frame, rows, "p string", text.phone_e164(F.col("p"))) == [
        "+15551234567", "+15551234567", "+5551234", None, None, "+25551234567",
    ]


def test_yes_no_and_blank(frame):
    rows = [("Yes",), ("NO",), ("maybe",), (None,), (" -- ",), ("0",)]
    got = values(frame, rows, "v string", text.yes_no(F.col("v")), text.blank_to_null(F.col("v")),
                 text.blank_to_null(F.col("v"), text.SHEET_BLANK_MARKERS), text.is_present(F.col("v")))
    assert got == [
        (True, "Yes", "Yes", True), (False, "NO", "NO", True), (None, "maybe", "maybe", True), (None, None, None, False),
        (None, None, None, False), (None, "0", None, True),
    ]


def test_keys(frame):
    rows = [(" Ann ", "Lee", date(2000, 1, 2)), ("", "Lee", date(2000, 1, 2)), ("Ann", None, None), ("O'Neil", "Lee", None)]
    a, b, d = F.col("a"), F.col("b"), F.col("d")
    got = values(frame, rows, "a string, b string, d date", text.name_key(a, b), text.name_birth_key(a, b, d), text.letters_key(a, b))
    assert got == [
        ("ann|lee", "ann|lee|2000-01-02", "ann lee"), (None, None, "lee"), (None, None, "ann"), ("o'neil|lee", None, "oneil lee"),
    ]


def test_display(frame):
    rows = [("Ann Mary Lee", 3725), ("Ann", 59), ("  ", 0), (None, None)]
    n, s = F.col("n"), F.col("s")
    got = values(frame, rows, "n string, s int", text.initials(n), text.short_label(n), text.slug(n), text.duration_text(s))
    assert got == [
        ("AL", "Ann L.", "ann-mary-lee", "1h 02m"), ("AN", "Ann", "ann", "0m"), ("-", "Unknown", "unknown", "0m"),
        ("-", "Unknown", "unknown", "0m"),
    ]


def test_row_hash_collisions(frame):
    rows = [("a||b", "c"), ("a", "b||c"), (None, "x"), ("", "x")]
    plain = values(frame, rows, "p string, q string", text.row_hash(["p", "q"]))
    compat = values(frame, rows, "p string, q string", text.row_hash(["p", "q"], compat=True))
    assert len(set(plain)) == 4
    assert compat[0] == compat[1] and compat[2] == compat[3]


def test_tokens_and_punctuation(frame):
    rows = [("Brand - S|pmax",), (" it’s\ta – b ",)]
    got = values(frame, rows, "v string", text.has_token(F.col("v"), "s"), text.has_token(F.col("v"), "max"), text.plain_punctuation(F.col("v")))
    assert got == [(True, False, "Brand - S|pmax"), (False, False, "it'sa - b")]


def test_week_endings(frame):
    days = [date(2024, 1, 3), date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 7)]  # Wed Thu Fri Sun
    d = F.col("d")
    got = values(frame, [(x,) for x in days], "d date", dates.week_ending(d), dates.week_ending(d, "SUN"), dates.week_ending_strict(d), dates.week_start(d))
    thu, nxt, sun = date(2024, 1, 4), date(2024, 1, 11), date(2024, 1, 7)
    assert got == [(thu, sun, sun, date(2024, 1, 1)), (thu, sun, sun, date(2024, 1, 1)), (nxt, sun, sun, date(2024, 1, 1)), (nxt, sun, date(2024, 1, 14), date(2024, 1, 1))]


def test_local_date_across_clock_change(frame):
    # 05:30 UTC is before midnight in Chicago in winter (UTC-6) and after it in summer (UTC-5)
    rows = [(1704864600,), (1720589400,)]
    assert values(frame, rows, "t long", dates.local_date(F.col("t"), "America/Chicago")) == [date(2024, 1, 9), date(2024, 7, 10)]


def test_guarded_and_multi_format_dates(frame):
    rows = [("01-02-1890",), ("01-02-1990",), ("01-02-2990",), ("junk",), (None,)]
    assert values(frame, rows, "v string", dates.guarded_date(F.col("v"), "MM-dd-yyyy", F.lit(date(2024, 1, 1)))) == [
        None, date(1990, 1, 2), None, None, None,
    ]
    rows = [("04-28-2026 12:58 PM",), ("2026-04-28 12:58:00",), ("2026-04-28T12:58:00",), ("x",)]
    ts = dates.first_timestamp(F.col("v"), ["MM-dd-yyyy h:mm a", "yyyy-MM-dd HH:mm:ss", None])
    assert values(frame, rows, "v string", F.date_format(ts, "yyyy-MM-dd HH:mm")) == ["2026-04-28 12:58"] * 3 + [None]


def test_windows():
    with pytest.raises(ValueError):
        dates.Window(date(2024, 2, 1), date(2024, 1, 1))
    w = dates.last_full_week(date(2024, 1, 4))  # a Thursday: the week before
    assert (w.start, w.end, w.days) == (date(2023, 12, 22), date(2023, 12, 28), 7)
    assert dates.recent_weeks(date(2024, 1, 6), 3).start == date(2023, 12, 21)
    assert dates.recent_weeks(date(2024, 1, 6), 3, floor=date(2023, 12, 28)).start == date(2023, 12, 28)
    assert dates.trailing_days(date(2024, 1, 8), 7).end == date(2024, 1, 7)


def test_fiscal(frame):
    rows = [(date(2026, 3, 31), 4), (date(2026, 4, 30), 4), (date(2026, 3, 31), 1)]
    got = values(frame, rows, "d date, s int", dates.fiscal_year(F.col("d"), F.col("s")), dates.fiscal_period(F.col("d"), F.col("s")))
    assert got == [(2025, 12), (2026, 1), (2026, 3)]


def test_channel_prefers_used_label(frame):
    rows = [("Unused", "PPC  north"), ("GMB listing", "PPC x"), (None, "mat"), ("zzz", "Outbound Calls"), ("House", None), (None, None)]
    got = values(frame, rows, "l string, s string", rules.channel(F.col("l"), F.col("s"), ["house"]))
    assert got == ["PPC", "SEO", "Other", "Outbound", "Direct", "Other"]


def test_lead_type_order(frame):
    rows = [(True, "google ads"), (False, "3rd party google ads"), (False, "Word of Mouth web"), (False, "paid web"), (False, "step down"), (False, None)]
    got = values(frame, rows, "b boolean, t string", rules.lead_type(F.col("b"), F.col("t")))
    assert got == ["BD", "BD", "Alumni", "PPC", "Step Down", "Other"]


def test_label_site_is_word_bound(frame):
    rows = [("(spam) abc - outbound",), ("abcd",), (None,)]
    assert values(frame, rows, "l string", rules.label_site(F.col("l"), [(["ABC"], "A")], "none")) == ["A", "none", "none"]


def test_lookup_missing_key_is_default(frame):
    rows = [("a",), ("z",), (None,)]
    assert values(frame, rows, "k string", rules.lookup(F.col("k"), {"a": 1}), rules.lookup(F.col("k"), {"a": 1}, 0)) == [(1, 1), (None, 0), (None, 0)]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            keep = row[j]
            row[j] = prev + 1 if x == y else max(row[j], row[j - 1])
            prev = keep
    return row[-1]


def test_common_length_matches_table(frame):
    """Either text shorter, both beyond a machine word, letters of all widths, empty and NULL."""
    rng = random.Random(1)
    text = lambda most: "".join(rng.choice("abcé 🙂") for _ in range(rng.randrange(0, most)))
    pairs = [(text(20), text(20)) for _ in range(150)] + [(text(90), text(90)) for _ in range(60)] + [("a" * n, "ba" * n) for n in (61, 62, 63, 64, 70)]
    got = values(frame, [*pairs, (None, "a"), ("a", None)], "a string, b string", common_length(F.col("a"), F.col("b")))
    assert got == [_lcs(a, b) for a, b in pairs] + [None, None]


def test_name_ratio(frame):
    rows = [("abcd", "abxd"), ("", ""), (None, "a"), ("abc", "")]
    got = values(frame, rows, "a string, b string", name_ratio(F.col("a"), F.col("b")), name_ratio(F.col("a"), F.col("b"), "levenshtein"))
    assert got == [(75.0, 75.0), (100.0, 100.0), (None, None), (0.0, 0.0)]
