"""Classifying columns by name and value format, without a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions.patterns import ratio

# Words of a column name and the type they stand for; earlier ones win. A rule
# of several words needs them next to each other, whole.
NAME_RULES = (
    ("EMAIL", ("email",)),
    ("PHONE", ("phone", "mobile")),
    ("DATE_OF_BIRTH", ("date_of_birth", "dob", "birth")),
    ("MEDICAL_RECORD_NUMBER", ("medical_record", "mrn")),
    ("BANK_ACCOUNT_NUMBER", ("account_number", "account_no", "account_num", "bank_account")),
    ("HEALTH_INFORMATION", ("diagnosis", "blood")),
    ("FINANCIAL_INFORMATION", ("balance", "salary", "income", "acctbal", "totalprice")),
    ("ADDRESS", ("address",)),
    ("LOCATION", ("city", "state", "location")),
    ("DEMOGRAPHIC_INFORMATION", ("gender", "age")),
    ("PERSON_NAME", ("first_name", "last_name", "doctor_name", "c_name", "s_name")),
    ("DIRECT_IDENTIFIER", ("customer_id", "student_id", "patient_id", "custkey", "user_id")),
)
# Names of plain business columns; values that look like personal data say otherwise.
PLAIN_NAMES = ("account_type", "campaign", "course", "department", "channel")
# Names that are never personal data, whatever the values look like: lineage and surrogate keys.
LINEAGE = r"\A_|(?:\A|_)(?:key|source_file|bronze_id)\z"

# Formats that only these rules use. Record numbers may have several groups, cards
# are told by their check digit, and a text date may be one of birth if its year is plausible.
RULE_FORMATS = {
    "record_share": r"(?i)MRN[-_ ]?(?:[A-Z0-9]+-)*[A-Z0-9]{5,20}",
    "card_share": r"(?:[0-9][ -]?){12,18}[0-9]",
    "birth_share": r"(?:19[0-9]{2}|200[0-9])[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19[0-9]{2}|200[0-9])",
}

# Value format -> type, tried in this order: a card is not an account number, and a phone is neither.
FORMAT_RULES = (
    ("EMAIL", "email_match_ratio"),
    ("MEDICAL_RECORD_NUMBER", "record_share"),
    ("PHONE", "phone_match_ratio"),
    ("FINANCIAL_INFORMATION", "card_share"),
    ("BANK_ACCOUNT_NUMBER", "bank_account_match_ratio"),
    ("DATE_OF_BIRTH", "birth_share"),
)
THRESHOLD = 0.6
NAME_CONFIDENCE = 0.9


def has_words(name: Column, needles: tuple[str, ...]) -> Column:
    """Does the name have one of these as whole `_`-separated words?"""
    words = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return words.rlike(f"(?:\\A|_)(?:{'|'.join(needles)})(?:_|\\z)")


def name_type(column: Column) -> Column:
    """The type a column name suggests, NULL if none."""
    found = F.when(F.lower(column).rlike(LINEAGE), "NON_PII")
    for pii_type, needles in (*NAME_RULES, ("NON_PII", PLAIN_NAMES)):
        found = found.when(has_words(column, needles), pii_type)
    return found


def values_decide(column: Column) -> Column:
    """May values override the name? Only where it stands for a plain business column."""
    return (name_type(column) == "NON_PII") & ~F.lower(column).rlike(LINEAGE)


def rule_shares(samples: Column, data_type: Column) -> dict[str, Column]:
    """The share of samples that fit each of RULE_FORMATS. Typed columns have no text dates."""

    def share(name: str) -> Column:
        def fits(value: Column) -> Column:
            test = value.rlike(f"\\A(?:{RULE_FORMATS[name]})\\z")
            if name == "card_share":
                test &= F.call_function("luhn_check", F.translate(value, " -", ""))
            return test

        found = ratio(F.size(F.filter(samples, fits)).cast("double"), F.size(samples).cast("double"))
        return F.when(data_type == "string", found).otherwise(0.0) if name == "birth_share" else found

    return {name: share(name) for name in RULE_FORMATS}


def format_type() -> Column:
    """The type the values suggest, NULL if none; needs the profile features and `rule_shares`."""
    found = None
    for pii_type, feature in FORMAT_RULES:
        hit = F.col(feature) >= THRESHOLD
        found = F.when(hit, pii_type) if found is None else found.when(hit, pii_type)
    return found


def format_share() -> Column:
    return F.greatest(*[F.col(feature) for _, feature in FORMAT_RULES])


def classify_by_rules(features: DataFrame) -> DataFrame:
    """Add pii_type, final_confidence, detection_method (PATTERN) and evidence.

    A name that stands for personal data decides, and so does one of lineage and keys. For
    all others the values decide if they have a format. Where name and values agree the
    confidence is the share of values that fit, but no less than the name's own. `evidence`
    tells what the type rests on: NAME, VALUES, BOTH or NONE.
    """
    name = F.col("column_name")
    rows = features.withColumns(rule_shares(F.col("samples"), F.col("data_type"))).withColumn("_by_format", format_type())
    overruled = values_decide(name) & F.col("_by_format").isNotNull()
    rows = rows.withColumn("_by_name", F.when(~F.coalesce(overruled, F.lit(False)), name_type(name)))
    agree = F.col("_by_name") == F.col("_by_format")
    return rows.select(
        *features.columns,
        F.coalesce("_by_name", "_by_format", F.lit("NON_PII")).alias("pii_type"),
        F.when(agree, F.greatest(format_share(), F.lit(NAME_CONFIDENCE)))
        .when(F.col("_by_name").isNotNull(), F.lit(NAME_CONFIDENCE))
        .when(F.col("_by_format").isNotNull(), format_share())
        .otherwise(F.lit(0.5))
        .alias("final_confidence"),
        F.lit("PATTERN").alias("detection_method"),
        F.when(agree, "BOTH")
        .when(F.col("_by_name").isNotNull(), "NAME")
        .when(F.col("_by_format").isNotNull(), "VALUES")
        .otherwise("NONE")
        .alias("evidence"),
    )


def combine(rules: DataFrame, model: DataFrame) -> DataFrame:
    """Rules and model together, per column: PATTERN, ML or COMBINED.

    Agreement is COMBINED with the higher confidence. Otherwise a rule that looked at
    values wins, and then the model.
    """
    on = ["schema_name", "table_name", "column_name"]
    by_rule = rules.select(
        *on, F.col("pii_type").alias("_rule_type"), F.col("final_confidence").alias("_rule_conf"),
        F.col("evidence").alias("_rule_evidence"),
    )
    joined = model.join(by_rule, on)
    agree = F.col("pii_type") == F.col("_rule_type")
    by_value = F.col("_rule_evidence").isin("VALUES", "BOTH")
    return joined.select(
        *[c for c in model.columns if c not in ("pii_type", "final_confidence", "detection_method")],
        F.when(by_value, F.col("_rule_type")).otherwise(F.col("pii_type")).alias("pii_type"),
        F.when(agree, F.greatest("final_confidence", "_rule_conf"))
        .when(by_value, F.col("_rule_conf"))
        .otherwise(F.col("final_confidence"))
        .alias("final_confidence"),
        F.when(agree, "COMBINED").when(by_value, "PATTERN").otherwise("ML").alias("detection_method"),
    )
