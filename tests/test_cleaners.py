import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilwork.functions import cleaners as C
from veilwork.functions import masks as M
from veilwork.functions import patterns as P
from veilwork.functions.text import SPACE_CHARS, strip, tidy


def apply(spark, fn, values, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    rows = df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


D = dt.date

CASES = {
    "clean_text": [("  a \t b\n", "a b"), ("", None), ("  \x1f ", None), (None, None), ("x\xa0　y", "x y")],
    "clean_name": [
        ("  Rohan ", "Rohan"), ("Mary   Jane", "Mary Jane"), ("a\tb", None), ("N4me", None), ("José Ñ×", "José Ñ×"),
        ("O'Neil-Smith Jr.", "O'Neil-Smith Jr."), ("Ł", None), ("", None), ("\x1cAnn\x85", "Ann"), ("a\xa0b", None),
    ],
    "clean_email": [
        ("KARAN.C10@DEMO.ORG", "karan.c10@demo.org"), ("rohan.example.com", None), ("a@b.c", None), ("a b@c.de", None),
        ("a@b.co\n", "a@b.co"), (None, None),
    ],
    "clean_phone": [
        ("+917000205965", "7000205965"), ("07000604164", "7000604164"), ("98765ABC10", None), ("", None),
        ("(91) 9876-543210", "9876543210"), ("5876543210", None), ("919876543210", "9876543210"),
        ("9198765432", "9198765432"), ("9٨٧٦٥٤٣٢١٠", "9٨٧٦٥٤٣٢١٠"), ("0091 9876543210", None),
    ],
    "clean_date": [
        ("31/02/1998", None), ("1/2/2001", D(2001, 2, 1)), ("2099-12-01", D(2099, 12, 1)), ("15-08-69", D(1969, 8, 15)),
        ("15.08.68", D(2068, 8, 15)), ("25/13/1997", None), ("1/2-2001", None), ("2001-02- 5", D(2001, 2, 5)),
        ("2001-2-3", D(2001, 2, 3)), ("0000-01-01", None), ("01/01/0000", None), ("29.02.2000", D(2000, 2, 29)),
        ("29.02.1900", None), ("01/02/199", None), ("01/02/19999", None), ("00/01/2000", None), ("abc", None),
        ("2001/01/02", None), ("31/12/99", D(1999, 12, 31)),
    ],
    "clean_int": [
        ("1001.0", 1001), ("1e3", 1000), ("1.5", None), ("abc", None), ("Infinity", None), ("NaN", None), (" 7 ", 7),
        ("+5", 5), ("-5.", -5), ("1_000", 1000), ("१२", 12), ("1.50e1", 15), ("1e-3", None), ("1e-30", None),
        ("0e-30", 0), (".0", 0), ("99999999999999999999", None), ("5.00000000000000000000001", None), ("", None),
    ],
    "clean_amount": [
        (" 46875.25 ", 46875.25), ("-1500", -1500.0), ("₹45,000", 45000.0), ("₹ 1,23,456.5", 123456.5), ("abc", None),
        ("45000d", None), ("0x10", None), ("NaN", None), ("1e2", 100.0), (".5", 0.5), ("", None),
    ],
    "clean_percentage": [
        ("105", None), ("N/A", None), ("-10", None), ("73.57", 73.57), ("80 %%", 80.0), ("100%", 100.0), ("0", 0.0),
    ],
    "clean_age": [("-5", None), ("200", None), ("thirty", None), ("", None), ("120", 120), ("0", 0), ("19.0", 19)],
    "clean_account_type": [("savings", "SAVINGS"), ("VIP", None), (" fixed_deposit ", "FIXED_DEPOSIT")],
    "clean_gender": [("UNKNOWN", None), ("female", "FEMALE")],
    "clean_blood_group": [("Z+", None), (" ab- ", "AB-")],
    "clean_channel": [("FAX", None), ("Email", "EMAIL")],
    "clean_account_number": [("ACC-1_a", "ACC-1_a"), ("ab", None), ("-abc", None), ("a" * 50, "a" * 50), ("a" * 51, None)],
    "clean_medical_record_number": [("MRN-2025-00001", "MRN-2025-00001"), ("no number", None)],
    "is_valid_email": [("a@b.co", True), ("A@B.CO", True), ("x", False), (None, False), ("a@b.co\n", False)],
    "is_valid_phone": [("9876543210", True), ("+919876543210", False), (None, False)],
    "is_missing": [("", False), (None, True)],
}


@pytest.mark.parametrize("name", CASES)
def test_cleaner(spark, name):
    values, expected = zip(*CASES[name])
    assert apply(spark, getattr(C, name), values) == list(expected)


def test_location_takes_the_first_listed_place(spark):
    rows = ["12  MG Road, New Delhi", "Pune near MUMBAI", "Bengaluru", "gurugram", "Nowhere", "", None]
    df = spark.createDataFrame([(v,) for v in rows], "address string")
    got = [tuple(r) for r in C.with_location(df).collect()]
    assert got == [
        ("12 MG Road, New Delhi", "Delhi", "Delhi"), ("Pune near MUMBAI", "Mumbai", "Maharashtra"),
        ("Bengaluru", "Bangalore", "Karnataka"), ("gurugram", "Gurgaon", "Haryana"),
        ("Nowhere", None, None), (None, None, None), (None, None, None),
    ]


def test_comparable_values(spark):
    assert apply(spark, lambda c: C.comparable(c, "double"), [1.0, 12345678.9, None, float("nan"), -0.5], "double") == [
        "1", "12345678.9", "", "", "-0.5"
    ]
    assert apply(spark, lambda c: C.comparable(c, "date"), [D(2020, 1, 2), None], "date") == ["2020-01-02", ""]
    assert apply(spark, lambda c: C.comparable(c, "string"), [" Ab ", None]) == ["ab", ""]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(SPACE_CHARS + "aZ0.@é-"), max_size=12), min_size=5, max_size=40))
def test_whitespace_matches_python(spark, values):
    stripped = apply(spark, strip, values)
    assert stripped == [v.strip() for v in values]
    tidied = apply(spark, tidy, values)
    assert tidied == [" ".join(v.split()) or None for v in values]
    assert apply(spark, tidy, tidied) == tidied


def test_formats(spark):
    cases = {
        "email": ["a@b.co"], "phone": ["+91-9876543210", "09876543210", "9876543210"],
        "date": ["2020-1-2", "01/02/2020"], "credit_card": ["4111 1111 1111 1111", "4111-1111-1111-1111"],
        "bank_account": ["12345678"], "medical_record": ["MRN-12345", "mrn_AB123", "abcde"],
        "numeric": ["-1.5", "+7"], "alphabetic": ["O'Neil Jr."], "alphanumeric": ["a1"],
    }
    for kind, values in cases.items():
        assert all(apply(spark, lambda c: P.looks_like(c, kind), values)), kind
    refused = {"medical_record": "MRN-2025-00001", "phone": "1234567890", "bank_account": "1234567", "date": "1/2/20"}
    for kind, value in refused.items():
        assert apply(spark, lambda c: P.looks_like(c, kind), [value, None]) == [False, False]


def test_sample_features(spark):
    df = spark.createDataFrame([(["ab", "AB", "1 2 3"],), ([],)], "s array<string>")
    full, empty = df.select(*P.sample_features(F.col("s"))).collect()
    assert set(empty) == {0.0}
    assert full["unique_ratio"] == pytest.approx(2 / 3) and full["sample_count"] == 3
    assert full["avg_length"] == 3 and full["std_length"] == pytest.approx(2**0.5)
    assert full["avg_word_count"] == pytest.approx(5 / 3) and full["digit_value_ratio"] == pytest.approx(1 / 3)


def test_small_functions(spark):
    assert apply(spark, P.split_samples, ["a| |b ", "null", "", None]) == [["a", "b"], [], [], []]
    assert apply(spark, P.as_flag, [" Yes", "TRUE", "1", "n", None]) == [1, 1, 1, 0, 0]
    assert apply(spark, P.table_type, ["FACT_x", "dimXy", "table"]) == ["FACT", "DIMENSION", "TABLE"]
    assert sum(apply(spark, P.keyword_flags, ["Customer-ID"])[0]) == 2
    assert apply(spark, P.has_digit, ["x²", "٣", "a", None]) == [True, True, False, False]


def test_masks(spark):
    assert apply(spark, M.mask_email, ["aarav.sharma@example.com"]) == ["a****@example.com"]
    assert apply(spark, M.mask_tail, ["9876543210", "123456789012", None]) == ["******3210", "********9012", None]
    a, b, c = apply(spark, lambda x: M.pseudonym(x, F.lit("k")), ["1", "1", None])
    assert a == b and len(a) == 64 and c is None
