"""Recognising value formats, and features of column names and sample lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilwork.functions.cleaners import EMAIL
from veilwork.functions.text import ANY_DIGIT, DECIMAL, NOT_ASCII, SPACES, matches, replace_literal, strip

# Whole-value formats.
PATTERNS = {
    "email": EMAIL,
    "phone": rf"(?:\+91[- ]?|0)?[6-9]{DECIMAL}{{9}}",
    "date": (
        rf"{DECIMAL}{{4}}[-/]{DECIMAL}{{1,2}}[-/]{DECIMAL}{{1,2}}"
        rf"|{DECIMAL}{{1,2}}[-/]{DECIMAL}{{1,2}}[-/]{DECIMAL}{{4}}"
    ),
    "credit_card": rf"(?:{DECIMAL}[ -]?){{13,19}}",
    "bank_account": rf"{DECIMAL}{{8,18}}",
    "medical_record": "(?iu)(?:MRN[-_ ]?)?[A-Za-z0-9]{5,20}",
    "numeric": rf"[-+]?{DECIMAL}+(?:\.{DECIMAL}+)?",
    "alphabetic": r"[A-Za-z .\-']+",
    "alphanumeric": "[A-Za-z0-9]+",
}

# The words looked for in a column name.
KEYWORDS = (
    "email", "phone", "address", "name", "dob", "birth", "date",
    "account_number", "account_no", "account_num", "bank_account",
    "account", "medical", "record", "location", "blood", "gender",
    "balance", "salary", "diagnosis", "doctor", "campaign", "customer",
    "student", "patient", "employee", "member", "id", "key",
    "amount", "income", "credit", "debit", "transaction",
)

# The 18 profile features, in vector order.
PROFILE_FEATURES = (
    "email_match_ratio", "phone_match_ratio", "date_match_ratio",
    "credit_card_match_ratio", "bank_account_match_ratio", "medical_record_match_ratio",
    "numeric_ratio", "alphabetic_ratio", "alphanumeric_ratio", "unique_ratio",
    "avg_length", "min_length", "max_length", "null_or_empty", "sample_count",
    "std_length", "avg_word_count", "digit_value_ratio",
)


# Lengths a format can have; they rule out most values before the expression is tried.
LENGTHS = {
    "phone": (10, 14),
    "date": (8, 10),
    "credit_card": (13, 38),
    "bank_account": (8, 18),
    "medical_record": (5, 24),
}


def looks_like(c: Column, kind: str) -> Column:
    """Does the whole value have the named format? NULL counts as no."""
    value = replace_literal(c, " ", "") if kind == "credit_card" else c
    test = matches(value, PATTERNS[kind])
    if kind == "email":
        test = F.contains(c, F.lit("@")) & test
    elif kind in LENGTHS:
        test = F.length(value).between(*LENGTHS[kind]) & test
    return F.coalesce(test, F.lit(False))


def has_digit(c: Column) -> Column:
    found = c.rlike("[0-9]") | (c.rlike(NOT_ASCII) & c.rlike(ANY_DIGIT))
    return F.coalesce(found, F.lit(False))


def word_count(stripped: Column) -> Column:
    """Number of whitespace-separated words of a stripped, non-empty value."""
    return F.regexp_count(stripped, F.lit(SPACES)) + 1


def split_samples(c: Column) -> Column:
    """A '|'-joined sample list as an array; NULL, empty and 'NULL' give an empty array."""
    raw = strip(c)
    absent = raw.isNull() | (raw == "") | (F.upper(raw) == "NULL")
    parts = F.filter(F.transform(F.split(raw, r"\|"), strip), lambda x: x != "")
    return F.when(absent, F.array().cast("array<string>")).otherwise(parts)


def ratio(part: Column, total: Column) -> Column:
    """part / total, and 0 where total is 0."""
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def as_flag(c: Column) -> Column:
    """1 for true/1/yes/y in any case, else 0."""
    return F.coalesce(F.lower(strip(c.cast("string"))).isin("true", "1", "yes", "y"), F.lit(False)).cast("int")


def keyword_flags(name: Column) -> Column:
    """One 0/1 value per keyword found inside the column name."""
    low = replace_literal(F.lower(name), "-", "_")
    return F.array(*[F.contains(low, F.lit(k)).cast("double") for k in KEYWORDS])


def text_or_null_word(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit("NULL"))


def semantic_text(
    domain: Column, table: Column, table_type: Column, column: Column, data_type: Column, samples: Column
) -> Column:
    """The sentence that describes a column to the text model. `samples` is an array."""
    parts = (
        ("Domain", domain),
        ("Table", table),
        ("Table type", table_type),
        ("Column", column),
        ("Data type", data_type),
        ("Sample values", F.array_join(samples, "|")),
    )
    pieces = []
    for label, value in parts:
        pieces += [F.lit(f"{label}: "), text_or_null_word(value), F.lit(". ")]
    pieces[-1] = F.lit(".")
    return F.concat(*pieces)


def domain_of_schema(schema: Column) -> Column:
    """star_banking -> Banking."""
    return F.initcap(replace_literal(schema, "star_", ""))


def table_type(name: Column) -> Column:
    """FACT / DIMENSION / TABLE by name; the underscore is a wildcard here."""
    low = F.lower(name)
    return F.when(low.like("fact_%"), "FACT").when(low.like("dim_%"), "DIMENSION").otherwise("TABLE")


def sample_features(samples: Column) -> list[Column]:
    """The 18 profile features of one sample array, each as a double column."""
    n = F.size(samples)
    count = n.cast("double")

    def share(test):
        return ratio(F.size(F.filter(samples, test)).cast("double"), count)

    lengths = F.transform(samples, lambda v: F.length(v).cast("double"))

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    mean = ratio(total(lengths), count)
    variance = ratio(total(F.transform(lengths, lambda x: (x - mean) * (x - mean))), count)
    def fits(kind):
        return lambda v: looks_like(v, kind)

    columns = [share(fits(kind)) for kind in PATTERNS]
    columns += [
        ratio(F.size(F.array_distinct(F.transform(samples, F.lower))).cast("double"), count),
        mean,
        F.coalesce(F.array_min(lengths), F.lit(0.0)),
        F.coalesce(F.array_max(lengths), F.lit(0.0)),
        F.lit(0.0),  # an empty list is all zeros, so this flag is never set
        count,
        F.sqrt(variance),
        ratio(total(F.transform(samples, lambda v: word_count(v).cast("double"))), count),
        share(has_digit),
    ]
    return [c.alias(name) for c, name in zip(columns, PROFILE_FEATURES)]
