import random
import re

import pytest

from cardfile.functions import emails, names, phones, predicates, text

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0     　"


def test_strip_is_unicode(values):
    rng = random.Random(1)
    alphabet = SPACES + "ab​"
    inputs = ["".join(rng.choices(alphabet, k=rng.randrange(9))) for _ in range(500)]
    assert values(text.strip, inputs) == [s.strip() for s in inputs]


def test_long_gaps_are_read_once(values):
    long = "a" + " " * 400_000 + "b"
    assert values(text.strip, [long + "  "]) == [long]
    assert values(text.dedup_key, [long]) == ["a b"]


@pytest.mark.parametrize(
    "raw, key",
    [
        (None, ""),
        ("  A \t\n B  ", "a b"),
        ("A​B﻿", "ab"),
        ("​ A", " a"),  # the zero-width character hides the space from the strip
        ("É È", "é è"),
    ],
)
def test_dedup_key(values, raw, key):
    assert values(text.dedup_key, [raw]) == [key]


def test_trim_words(values):
    cases = {
        "x" * 40: "x" * 40,
        "x" * 41: "x" * 40,
        "a" * 30 + " " + "b" * 30: "a" * 30,
        "a" * 39 + " b": "a" * 39,
        "a" * 40 + " b": "a" * 40,
        "a " * 30: ("a " * 20).strip(),
        "  short  ": "short",
    }
    assert values(text.trim_words, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    "raw, cleaned, usable",
    [
        (None, "", False),
        ("", "", False),
        ("no digits", "", False),
        ("555-1234", "+5551234", False),
        ("(305) 555-0199", "+13055550199", True),
        ("1 305 555 0199", "+13055550199", True),
        ("0044 20 7946 0958", "+442079460958", True),
        ("00 123 456 789", "+00123456789", True),  # eleven digits keep their zeros
        ("305 555 0199 / 305 555 0100", "+30555501993055550100", True),
        ("١٢٣", "+١٢٣", False),
    ],
)
def test_clean_phone(values, raw, cleaned, usable):
    assert values(phones.clean_phone, [raw]) == [cleaned]
    assert values(lambda c: phones.phone_ok(phones.clean_phone(c)), [raw]) == [usable]


def test_add_plus(values):
    inputs = [None, "", "  ", " 305 ", "+1 305", "(305)", "٣x"]
    assert values(phones.add_plus, inputs) == [None, "", "", "+305", "+1 305", "(305)", "+٣x"]


@pytest.mark.parametrize(
    "name, invalid, bad",
    [
        (None, True, False),
        ("   ", True, False),
        ("20 Years in town", True, False),
        ("one year", True, False),
        ("Yearling Stables", False, False),
        ("Experience Homes", True, True),
        ("My BUSINESS", True, False),
        ("Compassionate Realty", True, True),
        ("undefined", True, True),
        ("Blue Door", False, False),
    ],
)
def test_bad_names(values, name, invalid, bad):
    assert values(names.is_invalid_business, [name]) == [invalid]
    assert values(names.has_bad_phrase, [name]) == [bad]


def test_replacement_names(spark):
    rows = spark.createDataFrame(
        [
            (0, "", "Ann "), (1, "Compass", ""), (2, "Compass", "  "), (3, None, None),
            (4, " Fine Homes ", "Ann"), (5, "5 years", "Ann"), (6, "w" * 39 + " tail", "Ann"),
        ],
        "i int, b string, a string",
    )
    got = rows.orderBy("i").select(
        names.business_or_realtors("b", "a"), names.business_or_agent("b", "a"),
        names.business_or_realtors("b", None),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Ann Realtors", "Ann", ""),
        ("", "Compass", ""),
        ("", "Compass", ""),
        ("", None, ""),
        ("Fine Homes", " Fine Homes ", "Fine Homes"),
        ("5 years", "Ann", "5 years"),
        ("w" * 39, "w" * 39 + " tail", "w" * 39),
    ]


def test_email_cells_differ(values):
    inputs = ["A@x.com ; b@x.com,C", "a@x.com b@x.com", None, " ; ,", "a@x.com ;b"]
    assert values(emails.split_emails_list, inputs) == [
        ["a@x.com", "b@x.com", "c"], ["a@x.com b@x.com"], [], [], ["a@x.com", "b"],
    ]
    assert values(emails.split_emails_at, inputs) == [
        ["a@x.com", "b@x.com"], ["a@x.com", "b@x.com"], [], [], ["a@x.com"],
    ]


def test_extract_emails(values):
    plain = re.compile(emails.EMAIL_LOCAL + "+@" + emails.EMAIL_DOMAIN)
    rng = random.Random(3)
    inputs = ["".join(rng.choices("ab.@_- com", k=rng.randrange(40))) for _ in range(800)]
    inputs += ["a@b.com_x@d.org", "x" * 200_000 + " a@b.co", "@" * 1000]
    assert values(emails.extract_emails, inputs) == [plain.findall(s) for s in inputs]


def test_status(values):
    inputs = ["Undeliverable", "UNDELIVERABLE ", None, "deliverable"]
    assert values(lambda c: predicates.status_is(c, "undeliverable"), inputs) == [True, False, False, False]
    assert values(predicates.pending, ["Completed", "completed", None, ""]) == [False, True, True, True]
    assert values(lambda c: text.blank_default(c, "Unknown"), ["", None, " "]) == ["Unknown", "Unknown", " "]
