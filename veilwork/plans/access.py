"""What each role may see of a table, and personal data inside free text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions.masks import mask_for
from veilwork.functions.patterns import ratio
from veilwork.sources.tables import TableStore

ADMINISTRATOR = "Administrator"
ANALYST = "Analyst"


class AccessDenied(PermissionError):
    """The role may not read the table."""


def secure_view(df: DataFrame, pii_types: dict[str, str], role: str, secret: Column | str) -> DataFrame:
    """The table as `role` may see it.

    Administrators see everything, analysts see every PII column masked by its type, and
    all others are refused. `pii_types` maps column names to types; an analyst sees a
    column missing from it redacted, since nothing is known about it.
    """
    if role == ADMINISTRATOR:
        return df
    if role != ANALYST:
        raise AccessDenied(f"role {role!r} may not read this table")
    secret = F.lit(secret) if isinstance(secret, str) else secret
    types = dict(df.dtypes)
    return df.select(
        *[
            mask_for(pii_types.get(c, "UNKNOWN"), F.col(c), types[c], secret).alias(c)
            for c in df.columns
        ]
    )


def catalog_types(catalog: DataFrame, schema: str, table: str) -> dict[str, str]:
    """Column -> PII type of one table, as the latest scan has it. One row per column."""
    own = catalog.where((F.col("schema_name") == schema) & (F.col("table_name") == table))
    return {r["column_name"]: r["pii_type"] for r in own.select("column_name", "pii_type").collect()}


AUDIT_LOG = "audit/access_log"
AUDIT_SCHEMA = "ts timestamp, user_id string, role string, resource string, action string, result string"


def audited_view(
    store: TableStore, catalog: DataFrame, df: DataFrame, schema: str, table: str,
    user_id: str, role: str, secret: Column | str, now: dt.datetime,
) -> DataFrame:
    """The table as the catalog and the role allow; every attempt leaves a row in the audit log."""

    def note(result: str) -> None:
        row = [(now, user_id, role, f"{schema}.{table}", "READ", result)]
        store.append(AUDIT_LOG, store.spark.createDataFrame(row, AUDIT_SCHEMA).coalesce(1))

    try:
        view = secure_view(df, catalog_types(catalog, schema, table), role, secret)
    except AccessDenied:
        note("DENIED")
        raise
    note("GRANTED")
    return view


# Personal data inside running text.
TEXT_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE": r"(?:\+91[- ]?|\b0|\b)[6-9][0-9]{9}\b",
    "DATE": r"\b(?:[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4})\b",
    "CREDIT_CARD": r"\b(?:[0-9][ -]?){12,18}[0-9]\b",
    "BANK_ACCOUNT": r"\b[0-9]{8,18}\b",
    "MEDICAL_RECORD": r"(?i)\bMRN[-_ ]?(?:[A-Z0-9]+-)*[A-Z0-9]{5,20}\b",
}
# Tried in this order, so that a longer format is not cut up by a shorter one.
REDACT_ORDER = ("EMAIL", "MEDICAL_RECORD", "DATE", "PHONE", "CREDIT_CARD", "BANK_ACCOUNT")


# What a text must match for a format to occur in it; most texts lack most of these.
_SIGNS = {"EMAIL": "@", "MEDICAL_RECORD": "(?i)mrn"}


def may_contain(text: Column, kind: str) -> Column:
    return text.rlike(_SIGNS.get(kind, "[0-9]"))


def scan_text(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Matches per row and kind of personal data, over the whole text; no shuffle."""
    value = F.col(text)
    counts = [
        F.when(may_contain(value, kind), F.regexp_count(value, F.lit(pattern)))
        .when(value.isNotNull(), F.lit(0))
        .alias(f"n_{kind.lower()}")
        for kind, pattern in TEXT_PATTERNS.items()
    ]
    return df.select(*keep, *counts)


# A text's spans, the formats tried in order at each place.
SPAN_PATTERN = "|".join(f"(?:{TEXT_PATTERNS[kind]})" for kind in REDACT_ORDER)


def span_kind(span: Column) -> Column:
    """The format of a span that SPAN_PATTERN has found. NULL for a card number whose check digit
    is wrong, unless it may be a bank account's."""
    kind = None
    for name in REDACT_ORDER:
        fits = span.rlike(f"\\A(?:{TEXT_PATTERNS[name]})\\z")
        if name == "CREDIT_CARD":
            fits &= F.call_function("luhn_check", F.translate(span, " -", ""))
        kind = F.when(fits, name) if kind is None else kind.when(fits, name)
    return kind


def text_spans(text: Column) -> Column:
    """Personal data in a text as array<struct<kind, value>>: spans that do not overlap, each of one kind."""
    found = F.regexp_extract_all(text, F.lit(SPAN_PATTERN), F.lit(0))
    typed = F.transform(found, lambda x: F.struct(span_kind(x).alias("kind"), x.alias("value")))
    suspect = may_contain(text, "EMAIL") | may_contain(text, "PHONE") | may_contain(text, "MEDICAL_RECORD")
    none = F.array().cast("array<struct<kind:string,value:string>>")
    return F.coalesce(F.when(suspect, F.filter(typed, lambda x: x["kind"].isNotNull())), none)


def redact_text(text: Column) -> Column:
    """The text with every match replaced by [KIND]."""
    clean = text
    for kind in REDACT_ORDER:
        clean = F.regexp_replace(clean, TEXT_PATTERNS[kind], f"[{kind}]")
    suspect = may_contain(text, "EMAIL") | may_contain(text, "PHONE") | may_contain(text, "MEDICAL_RECORD")
    return F.when(suspect, clean).otherwise(text)


def text_summary(df: DataFrame, text: str, group: str) -> DataFrame:
    """Per group: texts, texts with personal data, and matches per kind."""
    scanned = scan_text(df, text, [group])
    names = [c for c in scanned.columns if c != group]
    any_hit = F.greatest(*[F.col(c) for c in names]) > 0
    return (
        scanned.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.count_if(any_hit).alias("texts_with_pii"),
            *[F.sum(c).cast("bigint").alias(c) for c in names],
        )
        .withColumn("share", ratio(F.col("texts_with_pii"), F.col("texts")))
    )
