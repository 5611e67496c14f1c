"""Field cleaners: raw text in, cleaned value or NULL out. A cleaner never rejects a row.

Each cleaner has two halves. `to_*` takes text that is already tidy (stripped only for
names, with plain digits for numbers), and `clean_*` does both steps. Tables use the halves in two projections, so
that the regular expressions of the first one are not inlined many times over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions.text import (
    DECIMAL,
    ascii_digits,
    collapse,
    matches,
    replace_literal,
    strip,
    tidy,
)

# Accepted categories.
ACCOUNT_TYPES = ("SAVINGS", "CURRENT", "SALARY", "FIXED_DEPOSIT")
GENDERS = ("MALE", "FEMALE", "OTHER")
BLOOD_GROUPS = ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")
CHANNELS = ("EMAIL", "SMS", "SOCIAL", "SEARCH", "REFERRAL")

# Accepted formats.
NAME = "[A-Za-zÀ-ÿ.' -]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_CHARS = rf"[+{DECIMAL} ()-]+"
MOBILE = rf"[6-9]{DECIMAL}{{9}}"
RECORD_NUMBER = "[A-Za-z0-9][A-Za-z0-9_-]{2,49}"
SCALED_INTEGER = r"[-+]?([0-9]+(\.[0-9]{0,18})?|\.[0-9]{1,18})[eE][-+]?[0-9]+|[-+]?\.0+"
DECIMAL_NUMBER = r"[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?"

# Place names looked for in an address. Earlier entries win.
PLACES = (
    ("mumbai", "Mumbai", "Maharashtra"),
    ("delhi", "Delhi", "Delhi"),
    ("new delhi", "New Delhi", "Delhi"),
    ("kolkata", "Kolkata", "West Bengal"),
    ("bangalore", "Bangalore", "Karnataka"),
    ("bengaluru", "Bangalore", "Karnataka"),
    ("chennai", "Chennai", "Tamil Nadu"),
    ("hyderabad", "Hyderabad", "Telangana"),
    ("pune", "Pune", "Maharashtra"),
    ("ahmedabad", "Ahmedabad", "Gujarat"),
    ("jaipur", "Jaipur", "Rajasthan"),
    ("lucknow", "Lucknow", "Uttar Pradesh"),
    ("patna", "Patna", "Bihar"),
    ("bhubaneswar", "Bhubaneswar", "Odisha"),
    ("ranchi", "Ranchi", "Jharkhand"),
    ("guwahati", "Guwahati", "Assam"),
    ("chandigarh", "Chandigarh", "Chandigarh"),
    ("kochi", "Kochi", "Kerala"),
    ("thiruvananthapuram", "Thiruvananthapuram", "Kerala"),
    ("surat", "Surat", "Gujarat"),
    ("nagpur", "Nagpur", "Maharashtra"),
    ("indore", "Indore", "Madhya Pradesh"),
    ("bhopal", "Bhopal", "Madhya Pradesh"),
    ("coimbatore", "Coimbatore", "Tamil Nadu"),
    ("visakhapatnam", "Visakhapatnam", "Andhra Pradesh"),
    ("vijayawada", "Vijayawada", "Andhra Pradesh"),
    ("kanpur", "Kanpur", "Uttar Pradesh"),
    ("varanasi", "Varanasi", "Uttar Pradesh"),
    ("noida", "Noida", "Uttar Pradesh"),
    ("gurgaon", "Gurgaon", "Haryana"),
    ("gurugram", "Gurgaon", "Haryana"),
)

_DAY = "3[01]|[12][0-9]|0[1-9]|[1-9]"
_MONTH = "1[0-2]|0[1-9]|[1-9]"
_DAY_FIRST = rf"\A({_DAY})([/.-])({_MONTH})\2"
DAY_FIRST_LONG = _DAY_FIRST + r"((?!0000)[0-9]{4})\z"
DAY_FIRST_SHORT = _DAY_FIRST + r"([0-9]{2})\z"
YEAR_FIRST = rf"\A((?!0000)[0-9]{{4}})-({_MONTH})-({_DAY}| [1-9])\z"


def is_missing(c: Column) -> Column:
    """NULL is missing; empty text is not."""
    return c.isNull()


def is_missing_number(c: Column) -> Column:
    """NULL and NaN are missing."""
    return c.isNull() | F.isnan(c)


# ---- first halves ---------------------------------------------------------------


def stripped_text(c: Column) -> Column:
    """Trimmed text with its inner whitespace; empty text becomes NULL."""
    return F.nullif(strip(c), F.lit(""))


def number_text(c: Column) -> Column:
    """Tidy text with digits of any script as 0-9 and without digit-group underscores."""
    return ascii_digits(replace_literal(tidy(c), "_", ""))


# ---- second halves --------------------------------------------------------------


def to_name(stripped: Column) -> Column:
    """Letters, spaces, dots, apostrophes and hyphens only; checked before collapsing."""
    return F.when(matches(stripped, NAME), collapse(stripped))


def to_email(text: Column) -> Column:
    low = F.lower(text)
    return F.when(matches(low, EMAIL), low)


def to_phone(text: Column) -> Column:
    """Ten-digit mobile number without country code or trunk zero."""
    digits = F.regexp_replace(text, rf"[^{DECIMAL}]", "")
    size = F.length(digits)
    local = (
        F.when(digits.startswith("91") & (size == 12), F.substring(digits, 3, 10))
        .when(digits.startswith("0") & (size == 11), F.substring(digits, 2, 10))
        .otherwise(digits)
    )
    return F.when(matches(text, PHONE_CHARS) & matches(local, MOBILE), local)


def to_date(text: Column) -> Column:
    """Day-first dates with / - or . and a 2- or 4-digit year, or ISO dates."""
    short_year = F.regexp_extract(text, DAY_FIRST_SHORT, 4)
    century = F.when(short_year < "69", F.lit("20")).otherwise(F.lit("19"))
    iso = (
        F.when(text.rlike(DAY_FIRST_LONG), F.regexp_replace(text, DAY_FIRST_LONG, "$4-$3-$1"))
        .when(
            text.rlike(DAY_FIRST_SHORT),
            F.concat(century, F.regexp_replace(text, DAY_FIRST_SHORT, "$4-$3-$1")),
        )
        .when(text.rlike(YEAR_FIRST), replace_literal(text, " ", ""))
    )
    return iso.try_cast("date")


def to_int(number: Column) -> Column:
    """Integers, also written as 1001.0 or 1e3; anything fractional becomes NULL."""
    scaled = number.try_cast("decimal(38,18)")
    is_zero = matches(number, r"[-+]?[0.]+([eE].*)?")
    return F.when(
        matches(number, r"[-+]?[0-9]+(\.0*)?"),
        F.regexp_replace(number, r"\.0*\z", "").try_cast("bigint"),
    ).when(
        matches(number, SCALED_INTEGER) & (scaled == F.floor(scaled)) & ((scaled != 0) | is_zero),
        scaled.try_cast("bigint"),
    )


def _to_double(text: Column) -> Column:
    # The guard keeps out forms only the cast knows, such as 45000d, NaN and Infinity.
    return F.when(matches(text, DECIMAL_NUMBER), text.try_cast("double"))


def to_amount(number: Column) -> Column:
    """Money with optional rupee sign and thousands separators; negatives are kept."""
    return _to_double(F.trim(F.translate(number, "₹,", "")))


def to_percentage(number: Column) -> Column:
    value = _to_double(F.trim(F.rtrim(number, F.lit("%"))))
    return F.when(value.between(0, 100), value)


def to_age(number: Column) -> Column:
    years = to_int(number)
    return F.when(years.between(0, 120), years.cast("int"))


def to_category(text: Column, allowed: tuple[str, ...]) -> Column:
    up = F.upper(text)
    return F.when(up.isin(*allowed), up)


def to_account_type(text: Column) -> Column:
    return to_category(text, ACCOUNT_TYPES)


def to_gender(text: Column) -> Column:
    return to_category(text, GENDERS)


def to_blood_group(text: Column) -> Column:
    return to_category(text, BLOOD_GROUPS)


def to_channel(text: Column) -> Column:
    return to_category(text, CHANNELS)


def to_record_number(text: Column) -> Column:
    return F.when(matches(text, RECORD_NUMBER), text)


def place_of(address: str) -> Column:
    """struct(city, state) of the first listed place the named column mentions, else NULL.

    Written as SQL text, since building 31 branches call by call is slow.
    """
    branches = " ".join(
        f"WHEN contains(lower({address}), '{needle}') THEN named_struct('city', '{city}', 'state', '{state}')"
        for needle, city, state in PLACES
    )
    return F.expr(f"CASE {branches} END")


# ---- cleaners that take raw text ------------------------------------------------

clean_text = tidy


def clean_name(c: Column) -> Column:
    return to_name(stripped_text(c))


def clean_email(c: Column) -> Column:
    return to_email(tidy(c))


def is_valid_email(c: Column) -> Column:
    return F.coalesce(matches(c, EMAIL), F.lit(False))


def clean_phone(c: Column) -> Column:
    return to_phone(tidy(c))


def is_valid_phone(c: Column) -> Column:
    return F.coalesce(matches(c, MOBILE), F.lit(False))


def clean_date(c: Column) -> Column:
    return to_date(tidy(c))


def clean_int(c: Column) -> Column:
    return to_int(number_text(c))


def clean_amount(c: Column) -> Column:
    return to_amount(number_text(c))


def clean_percentage(c: Column) -> Column:
    return to_percentage(number_text(c))


def clean_age(c: Column) -> Column:
    return to_age(number_text(c))


def clean_upper(c: Column) -> Column:
    return F.upper(tidy(c))


def clean_account_type(c: Column) -> Column:
    return to_account_type(tidy(c))


def clean_gender(c: Column) -> Column:
    return to_gender(tidy(c))


def clean_blood_group(c: Column) -> Column:
    return to_blood_group(tidy(c))


def clean_channel(c: Column) -> Column:
    return to_channel(tidy(c))


def clean_account_number(c: Column) -> Column:
    return to_record_number(tidy(c))


def clean_medical_record_number(c: Column) -> Column:
    return to_record_number(tidy(c))


def with_location(rows: DataFrame, column: str = "address") -> DataFrame:
    """Tidy the address column and add city and state; all NULL for an empty address."""
    tidied = rows.withColumn(column, tidy(F.col(column)))
    placed = tidied.withColumn("_place", place_of(column))
    return placed.select(
        *rows.columns, F.col("_place.city").alias("city"), F.col("_place.state").alias("state")
    )


# ---- date rules and duplicate signatures ----------------------------------------


def date_is_not_future(c: Column, as_of: Column) -> Column:
    return F.coalesce(c <= as_of, F.lit(True))


def admission_is_consistent(admission: Column, birth: Column) -> Column:
    return F.coalesce(admission >= birth, F.lit(True))


def as_date(c: Column) -> Column:
    """Any value as a date, or NULL."""
    return c.try_cast("date")


def comparable(c: Column, dtype: str) -> Column:
    """One value as lower-case text for duplicate detection; NULL becomes ''."""
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        text = F.date_format(c, "yyyy-MM-dd")
    elif dtype in ("double", "float"):
        exact = c.try_cast("decimal(38,12)")
        plain = F.regexp_replace(exact.cast("string"), r"\.?0+\z", "")
        text = (
            F.when(F.isnan(c), F.lit(None).cast("string"))
            .when(exact.cast("double") == c, plain)
            .otherwise(F.lower(c.cast("string")))
        )
    else:
        text = F.lower(strip(c.cast("string")))
    return F.coalesce(text, F.lit(""))
