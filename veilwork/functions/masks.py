"""Masks for displaying personal data to readers who may not see it in clear."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "[REDACTED]"


def mask_email(c: Column) -> Column:
    """a****@example.com: first character, four stars, the domain. Other text is redacted."""
    fits = c.rlike(r"\A[^@\s]+@[^@\s]+\z")
    return F.when(fits, F.regexp_replace(c, r"\A([^@])[^@]*@", "$1****@")).otherwise(redact(c))


def mask_tail(c: Column, keep: int = 4) -> Column:
    """Stars except for the last `keep` characters; stars alone if these were half or more."""
    hidden = F.when(F.length(c) > 2 * keep, F.length(c) - keep).otherwise(F.length(c))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(c, F.length(c) - hidden))


def mask_name(c: Column) -> Column:
    """The first character and four stars; stars alone for a single character."""
    return F.concat(F.when(F.length(c) > 1, F.substring(c, 1, 1)).otherwise(F.lit("")), F.lit("****"), F.left(c, F.lit(0)))


def mask_birth_date(c: Column) -> Column:
    """The year only, as text."""
    return F.year(c).cast("string")


def redact(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(REDACTED))


def pseudonym(c: Column, secret: Column) -> Column:
    """Keyed SHA-256: equal values stay equal, and cannot be guessed without the secret."""
    inner = F.sha2(F.concat_ws("|", secret, c.cast("string")), 256)
    return F.when(c.isNotNull(), F.sha2(F.concat_ws("|", secret, inner), 256))


def mask_for(pii_type: str, c: Column, dtype: str, secret: Column) -> Column:
    """The mask a PII type calls for, as text."""
    text = c.cast("string")
    if pii_type == "NON_PII":
        return c
    if pii_type == "EMAIL":
        return mask_email(text)
    if pii_type in ("PHONE", "BANK_ACCOUNT_NUMBER"):
        return mask_tail(text)
    if pii_type == "PERSON_NAME":
        return mask_name(text)
    if pii_type == "DATE_OF_BIRTH" and dtype in ("date", "timestamp"):
        return mask_birth_date(c)
    if pii_type in ("MEDICAL_RECORD_NUMBER", "DIRECT_IDENTIFIER"):
        return pseudonym(c, secret)
    return redact(text)


TECHNIQUES = {
    # The name under which each type's mask is catalogued.
    "EMAIL": "PARTIAL_EMAIL",
    "PHONE": "KEEP_LAST_4",
    "BANK_ACCOUNT_NUMBER": "KEEP_LAST_4",
    "PERSON_NAME": "INITIAL",
    "DATE_OF_BIRTH": "YEAR_ONLY",
    "MEDICAL_RECORD_NUMBER": "KEYED_HASH",
    "DIRECT_IDENTIFIER": "KEYED_HASH",
    "ADDRESS": "REDACT",
    "LOCATION": "REDACT",
    "HEALTH_INFORMATION": "REDACT",
    "DEMOGRAPHIC_INFORMATION": "REDACT",
    "FINANCIAL_INFORMATION": "REDACT",
}

# The types whose columns readers see masked: the one policy of views and catalog.
MASKED_TYPES = tuple(TECHNIQUES)
