from __future__ import annotations

from oracles import exprs as X
from oracles.exprs import FIELDS, clean_ctes
from oracles.fixed import SENSITIVITY_POLICY
from oracles.profiling import counts, features, samples
from oracles.warehouse import star_ctes
from veilwork.queries.views import AUDIT
from veilwork.schemas import DOMAINS

DATE_COLUMNS = [
    "date_key", "full_date", "day", "day_name", "week", "month", "month_name", "quarter", "year", "is_weekend",
]


def star_columns(domain: str) -> dict[str, list[str]]:
    spec = DOMAINS[domain]
    out = {d.name: DATE_COLUMNS if d.is_date else [d.key, *d.attrs] for d in spec.dims}
    out[spec.fact.name] = [
        *[d.fact_key or d.key for d in spec.dims], *[m for m, _ in spec.fact.measures], "_bronze_id",
    ]
    return out


_counted, _sampled, _inventory = [], [], []
for _domain in DOMAINS:
    _spec = DOMAINS[_domain]
    _primary = {(d.name, d.key) for d in _spec.dims}
    _foreign = {(_spec.fact.name, d.fact_key or d.key) for d in _spec.dims}
    for _table, _columns in star_columns(_domain).items():
        _cte, _extra = f"{_domain}_{_table}", f"'star_{_domain}' AS schema_name, '{_table}' AS table_name, "
        _key = "_bronze_id" if "_bronze_id" in _columns else _columns[0]
        _counted.append(counts(_cte, _columns, _extra))
        _sampled.append(samples(_cte, _columns, _key, _extra))
        for _i, _c in enumerate(_columns, 1):
            _kind = "FACT" if _table.startswith("fact_") else "DIMENSION"
            _inventory.append(
                f"('star_{_domain}', '{_table}', '{_c}', '{_kind}', {(_table, _c) in _primary}, {(_table, _c) in _foreign}, {_i})"
            )

_STARS = ", ".join(star_ctes(d) for d in DOMAINS)
_INVENTORY = (
    f"(VALUES {', '.join(_inventory)}) i(schema_name, table_name, column_name, table_type, is_primary_key, is_foreign_key, ordinal_position)"
)
# The rules, written out here on their own.
_words = "'_' || regexp_replace(lower(column_name), '[^a-z0-9]+', '_', 'g') || '_'"
_lineage = "(column_name LIKE '\\_%' ESCAPE '\\' OR column_name = 'key' OR column_name LIKE '%\\_key' ESCAPE '\\')"
_names = (
    ("email", "EMAIL"), ("phone", "PHONE"), ("mobile", "PHONE"), ("date_of_birth", "DATE_OF_BIRTH"), ("dob", "DATE_OF_BIRTH"),
    ("birth", "DATE_OF_BIRTH"), ("medical_record", "MEDICAL_RECORD_NUMBER"), ("mrn", "MEDICAL_RECORD_NUMBER"),
    ("account_number", "BANK_ACCOUNT_NUMBER"), ("account_no", "BANK_ACCOUNT_NUMBER"), ("account_num", "BANK_ACCOUNT_NUMBER"),
    ("bank_account", "BANK_ACCOUNT_NUMBER"), ("diagnosis", "HEALTH_INFORMATION"), ("blood", "HEALTH_INFORMATION"),
    ("balance", "FINANCIAL_INFORMATION"), ("salary", "FINANCIAL_INFORMATION"), ("income", "FINANCIAL_INFORMATION"),
    ("acctbal", "FINANCIAL_INFORMATION"), ("totalprice", "FINANCIAL_INFORMATION"), ("address", "ADDRESS"),
    ("city", "LOCATION"), ("state", "LOCATION"), ("location", "LOCATION"), ("gender", "DEMOGRAPHIC_INFORMATION"),
    ("age", "DEMOGRAPHIC_INFORMATION"), ("first_name", "PERSON_NAME"), ("last_name", "PERSON_NAME"),
    ("doctor_name", "PERSON_NAME"), ("c_name", "PERSON_NAME"), ("s_name", "PERSON_NAME"), ("customer_id", "DIRECT_IDENTIFIER"),
    ("student_id", "DIRECT_IDENTIFIER"), ("patient_id", "DIRECT_IDENTIFIER"), ("custkey", "DIRECT_IDENTIFIER"),
    ("user_id", "DIRECT_IDENTIFIER"),
)
_by_name = (
    f"CASE WHEN {_lineage} THEN 'NON_PII' "
    + " ".join(f"WHEN contains({_words}, '_{n}_') THEN '{t}'" for n, t in _names)
    + " "
    + " ".join(
        f"WHEN contains({_words}, '_{n}_') AND by_format IS NULL THEN 'NON_PII'"
        for n in ("account_type", "campaign", "course", "department", "channel")
    )
    + " END"
)
# Formats of the rules alone, and how a sample fits them.
_card = "reverse(regexp_replace(value, '[ -]', '', 'g'))"
_twice = f"CAST(substr({_card}, i, 1) AS INTEGER) * (2 - i % 2)"
_check = f"list_sum(list_transform(range(1, length({_card}) + 1), lambda i: {_twice} - CASE WHEN {_twice} > 9 THEN 9 ELSE 0 END)) % 10 = 0"
_fits = {
    "record_share": "regexp_full_match(value, '(?i)MRN[-_ ]?([A-Z0-9]+-)*[A-Z0-9]{5,20}')",
    "card_share": f"CASE WHEN regexp_full_match(value, '([0-9][ -]?){{12,18}}[0-9]') THEN {_check} ELSE false END",
    "birth_share": "regexp_full_match(value, '(19[0-9][0-9]|200[0-9])[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](19[0-9][0-9]|200[0-9])')",
}
_own_shares = ", ".join(f"count(*) FILTER ({test}) / count(*) AS {name}" for name, test in _fits.items())
_by_format = """CASE WHEN email_match_ratio >= 0.6 THEN 'EMAIL' WHEN record_share >= 0.6 THEN 'MEDICAL_RECORD_NUMBER'
  WHEN phone_match_ratio >= 0.6 THEN 'PHONE' WHEN card_share >= 0.6 THEN 'FINANCIAL_INFORMATION'
  WHEN bank_account_match_ratio >= 0.6 THEN 'BANK_ACCOUNT_NUMBER' END"""
_share = "greatest(email_match_ratio, record_share, phone_match_ratio, card_share, bank_account_match_ratio)"
_level = " ".join(f"WHEN '{t}' THEN '{level}'" for t, level in SENSITIVITY_POLICY.items())
_technique = """WHEN 'EMAIL' THEN 'PARTIAL_EMAIL' WHEN 'PHONE' THEN 'KEEP_LAST_4' WHEN 'BANK_ACCOUNT_NUMBER' THEN 'KEEP_LAST_4'
  WHEN 'PERSON_NAME' THEN 'INITIAL' WHEN 'DATE_OF_BIRTH' THEN 'YEAR_ONLY' WHEN 'MEDICAL_RECORD_NUMBER' THEN 'KEYED_HASH'
  WHEN 'DIRECT_IDENTIFIER' THEN 'KEYED_HASH' WHEN 'ADDRESS' THEN 'REDACT' WHEN 'LOCATION' THEN 'REDACT'
  WHEN 'HEALTH_INFORMATION' THEN 'REDACT' WHEN 'DEMOGRAPHIC_INFORMATION' THEN 'REDACT' WHEN 'FINANCIAL_INFORMATION' THEN 'REDACT'"""

SCAN = f"""
WITH {_STARS},
counted AS MATERIALIZED ({' UNION ALL '.join(_counted)}),
sampled AS MATERIALIZED ({' UNION ALL '.join(_sampled)}),
feats AS (SELECT schema_name, table_name, column_name, {features()}, {_own_shares} FROM sampled GROUP BY 1, 2, 3),
formed AS (SELECT c.*, {_by_format} AS by_format, coalesce({_share}, 0.0) AS share
          FROM counted c LEFT JOIN feats f USING (schema_name, table_name, column_name)),
ruled AS (SELECT *, {_by_name} AS by_name FROM formed),
scan AS (SELECT schema_name, table_name, column_name, records_scanned, non_null_records,
  coalesce(by_name, by_format, 'NON_PII') AS pii_type,
  CASE WHEN by_name = by_format THEN greatest(share, 0.9) WHEN by_name IS NOT NULL THEN 0.9
       WHEN by_format IS NOT NULL THEN share ELSE 0.5 END AS confidence,
  'PATTERN' AS detection_method, CASE WHEN by_name = by_format THEN 'BOTH' WHEN by_name IS NOT NULL THEN 'NAME'
       WHEN by_format IS NOT NULL THEN 'VALUES' ELSE 'NONE' END AS evidence FROM ruled),
outcome AS MATERIALIZED (SELECT *, pii_type <> 'NON_PII' AS pii_detected,
  CASE WHEN pii_type <> 'NON_PII' THEN non_null_records ELSE 0 END AS pii_records_detected,
  CASE pii_type {_level} END AS sensitivity_level,
  upper(substr(schema_name, 6, 1)) || substr(schema_name, 7) AS domain,
  CASE WHEN pii_type <> 'NON_PII' THEN 'MASKED' ELSE 'NOT_MASKED' END AS masking_status,
  CASE pii_type {_technique} END AS masking_technique FROM scan)
"""

TEXT = {
    "EMAIL": X.EMAIL,
    "PHONE": r"(?:\+91[- ]?|\b0|\b)[6-9][0-9]{9}\b",
    "DATE": r"\b(?:[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4})\b",
    "CREDIT_CARD": r"\b(?:[0-9][ -]?){12,18}[0-9]\b",
    "BANK_ACCOUNT": r"\b[0-9]{8,18}\b",
    "MEDICAL_RECORD": r"(?i)\bMRN[-_ ]?(?:[A-Z0-9]+-)*[A-Z0-9]{5,20}\b",
}
_found = ", ".join(f"len(regexp_extract_all(text, '{p}')) AS n_{k.lower()}" for k, p in TEXT.items())
_redacted = "text"
for _k in ("EMAIL", "MEDICAL_RECORD", "DATE", "PHONE", "CREDIT_CARD", "BANK_ACCOUNT"):
    _redacted = f"regexp_replace({_redacted}, '{TEXT[_k]}', '[{_k}]', 'g')"
_hits = [f"n_{k.lower()}" for k in TEXT]


def tail(c: str) -> str:
    return (
        f"CASE WHEN length({c}) > 8 THEN repeat('*', CAST(length({c}) - 4 AS BIGINT)) || right({c}, 4) "
        f"ELSE repeat('*', CAST(length({c}) AS BIGINT)) END"
    )


def initial(c: str) -> str:
    return f"CASE WHEN length({c}) > 1 THEN left({c}, 1) ELSE '' END || '****' || left({c}, 0)"


def pseudonym(c: str) -> str:
    return f"sha256('k1|' || sha256('k1|' || CAST({c} AS VARCHAR)))"


def redact(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN '[REDACTED]' END"




def email_of(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}, '[^@\\s]+@[^@\\s]+') THEN left({c}, 1) || '****' || substr({c}, instr({c}, '@')) "
        f"WHEN {c} IS NOT NULL THEN '[REDACTED]' END"
    )


_email = email_of("email")
_clean = f"WITH {clean_ctes('banking')}"
_all = "_bronze_id, " + ", ".join(X.FIELDS["banking"]) + ", city, state"

ORACLES = {
    "column_inventory": f"""
        WITH {_STARS}, counted AS ({' UNION ALL '.join(_counted)})
        SELECT i.* REPLACE (CAST(i.ordinal_position AS BIGINT) AS ordinal_position), records_scanned, non_null_records FROM {_INVENTORY} JOIN counted USING (schema_name, table_name, column_name)""",
    "rule_classify_columns": SCAN
    + """SELECT schema_name, table_name, column_name, pii_type, round(confidence, 6) AS confidence, detection_method, evidence,
         records_scanned, pii_detected, pii_records_detected FROM outcome""",
    "pii_scan_fact": SCAN
    + """SELECT scan_id, date_key, count(*) AS columns, count(*) AS distinct_columns, count(*) FILTER (pii_detected) AS pii_columns,
         CAST(sum(records_scanned) AS BIGINT) AS records_scanned, CAST(sum(pii_records_detected) AS BIGINT) AS pii_records
         FROM outcome, (VALUES ('scan-1', 20260101::BIGINT), ('scan-2', 20260102::BIGINT)) d(scan_id, date_key) GROUP BY 1, 2""",
    "gold_row_counts": SCAN
    + f"""SELECT 'dim_source_schema' AS table_name, count(DISTINCT schema_name) AS row_count FROM outcome
         UNION ALL SELECT 'dim_table', count(DISTINCT schema_name || table_name) FROM outcome
         UNION ALL SELECT 'dim_column', count(*) FROM outcome
         UNION ALL SELECT 'dim_pii_type', {len(SENSITIVITY_POLICY)} UNION ALL SELECT 'dim_sensitivity', 3
         UNION ALL SELECT 'fact_pii_scan', 2 * count(*) FROM outcome""",
    "latest_scan": SCAN + "SELECT column_name, 'scan-2' AS scan_id, pii_detected, pii_records_detected FROM outcome",
    "pii_catalog": SCAN
    + """SELECT domain, schema_name, table_name, column_name, pii_type, sensitivity_level, detection_method,
         round(confidence, 6) AS confidence, pii_detected, masking_status, masking_technique, records_scanned,
         pii_records_detected FROM outcome""",
    "pii_inventory": SCAN
    + """SELECT CASE WHEN grouping(pii_type) = 0 THEN 'type' WHEN grouping(column_name) = 0 THEN 'column'
           WHEN grouping(table_name) = 0 THEN 'table' WHEN grouping(domain) = 0 THEN 'domain' ELSE 'total' END AS level,
         domain, table_name, column_name, pii_type, count(*) AS pii_columns, CAST(sum(pii_records_detected) AS BIGINT) AS pii_records
         FROM outcome WHERE pii_detected GROUP BY GROUPING SETS ((), (domain), (domain, table_name),
           (domain, table_name, column_name), (pii_type))""",
    "sensitivity_distribution": SCAN
    + "SELECT sensitivity_level, count(*) AS columns, count(*) FILTER (pii_detected) AS pii_columns FROM outcome GROUP BY 1",
    "masking_coverage": SCAN
    + """SELECT domain, count(*) FILTER (sensitivity_level <> 'LOW') AS sensitive_columns,
         count(*) FILTER (sensitivity_level <> 'LOW' AND masking_status = 'MASKED') AS masked_columns,
         round(masked_columns / sensitive_columns, 6) AS coverage FROM outcome GROUP BY 1""",
    "scan_outcome": SCAN
    + """SELECT schema_name, count(*) AS columns, count(*) FILTER (pii_detected) AS pii_columns,
         CAST(sum(pii_records_detected) AS BIGINT) AS pii_records FROM outcome GROUP BY 1""",
    "mask_email": f"{_clean} SELECT _bronze_id, {_email} AS email FROM clean_banking",
    "mask_phone": f"{_clean} SELECT _bronze_id, {tail('phone')} AS phone FROM clean_banking",
    "mask_account_number": f"{_clean} SELECT _bronze_id, {tail('account_number')} AS account_number FROM clean_banking",
    "mask_others": f"""{_clean} SELECT _bronze_id, {initial('first_name')} AS first_name,
        CAST(year(date_of_birth) AS VARCHAR) AS date_of_birth, {redact('address')} AS address,
        {pseudonym('customer_id')} AS customer_id FROM clean_banking""",
    "mask_raw_values": f"""{_clean} SELECT _bronze_id, {_email} AS email, {email_of("('@' || phone)")} AS no_user,
        {tail('phone')} AS phone, {tail('left(phone, 4)')} AS short, {initial('first_name')} AS first_name,
        {initial('left(first_name, 1)')} AS one_letter FROM raw_banking""",
    "redact_record_numbers": """SELECT doc_id, 'seen [MEDICAL_RECORD] and ' ||
        CASE WHEN length('1234' || doc_id || 'x') BETWEEN 5 AND 20 THEN '[MEDICAL_RECORD]' ELSE 'mrn-1234' || doc_id || 'x' END
        || ' Mrn 77 ok' AS clean FROM documents""",
    "catalog_role_view": f"""WITH {star_ctes('banking')} SELECT {pseudonym('customer_id')} AS customer_id,
        {initial('first_name')} AS first_name, {initial('last_name')} AS last_name, {email_of('email')} AS email,
        {tail('phone')} AS phone, CAST(year(date_of_birth) AS VARCHAR) AS date_of_birth FROM banking_dim_customer""",
    "access_audit": f"""WITH {star_ctes('banking')}, n AS (SELECT count(*) AS customers FROM banking_dim_customer)
        SELECT user_id, role, 'star_banking.dim_customer' AS resource, 'READ' AS action, result, customers
        FROM n, (VALUES ('1', 'Administrator', 'GRANTED'), ('2', 'Analyst', 'GRANTED'), ('3', 'Visitor', 'DENIED')) v(user_id, role, result)""",
    "secure_view_analyst": f"""{_clean} SELECT _bronze_id, {pseudonym('customer_id')} AS customer_id,
        {initial('first_name')} AS first_name, {initial('last_name')} AS last_name, {_email} AS email,
        {tail('phone')} AS phone, CAST(year(date_of_birth) AS VARCHAR) AS date_of_birth,
        {tail('account_number')} AS account_number, account_type, {redact('balance')} AS balance,
        {redact('address')} AS address, {redact('city')} AS city, {redact('state')} AS state FROM clean_banking""",
    "secure_view_administrator": f"{_clean} SELECT {_all} FROM clean_banking",
    "text_scan_documents": f"SELECT doc_id, {_found} FROM documents",
    "text_scan_conversations": f"SELECT conv_id, turn, {_found} FROM conversations",
    "text_redact_documents": f"""
        WITH r AS (SELECT doc_id, {_redacted} AS clean FROM documents)
        SELECT doc_id, length(clean) AS n, md5(clean) AS digest FROM r""",
    "text_summary_documents": f"""
        WITH s AS (SELECT lang, {_found} FROM documents)
        SELECT lang, count(*) AS texts, count(*) FILTER (greatest({', '.join(_hits)}) > 0) AS texts_with_pii,
          {', '.join(f'CAST(sum({h}) AS BIGINT) AS {h}' for h in _hits)},
          round(texts_with_pii / texts, 6) AS share FROM s GROUP BY 1""",
    "audit_daily": f"""
        WITH log AS ({AUDIT}) SELECT date_trunc('day', ts) AS window_start, role, resource, action, result,
          count(*) AS accesses, count(DISTINCT user_id) AS users FROM log GROUP BY ALL""",
    "audit_by_user": f"""
        WITH log AS ({AUDIT}) SELECT user_id, count(*) AS accesses, count(*) FILTER (result = 'DENIED') AS denied,
          min(ts) AS first_access, max(ts) AS last_access FROM log GROUP BY 1""",
    "stream_audit": f"""
        WITH log AS ({AUDIT}), days AS (SELECT date_trunc('day', ts) AS window_start, role, resource, action, result,
          count(*) AS accesses FROM log GROUP BY ALL)
        SELECT * FROM days WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
}
for _column, _query in (("domain", "sensitivity_by_domain"), ("pii_type", "sensitivity_by_type")):
    ORACLES[_query] = SCAN + f"""SELECT {_column}, count(*) FILTER (sensitivity_level = 'HIGH') AS HIGH,
        count(*) FILTER (sensitivity_level = 'MEDIUM') AS MEDIUM, count(*) FILTER (sensitivity_level = 'LOW') AS LOW
        FROM outcome GROUP BY 1"""

# ---- spans in free text: one pass over all formats, then one kind per span

_ORDER = ("EMAIL", "MEDICAL_RECORD", "DATE", "PHONE", "CREDIT_CARD", "BANK_ACCOUNT")
_digits = "reverse(regexp_replace(v, '[ -]', '', 'g'))"
_doubled = f"CAST(substr({_digits}, i, 1) AS INTEGER) * (2 - i % 2)"
_luhn = f"list_sum(list_transform(range(1, length({_digits}) + 1), lambda i: {_doubled} - CASE WHEN {_doubled} > 9 THEN 9 ELSE 0 END)) % 10 = 0"
_typed = " ".join(
    f"WHEN regexp_full_match(v, '{TEXT[k]}'){f' AND {_luhn}' if k == 'CREDIT_CARD' else ''} THEN '{k}'" for k in _ORDER
)


def _spans(source: str, keys: str) -> str:
    pattern = "|".join(f"(?:{TEXT[k]})" for k in _ORDER)
    return f"""
    WITH f AS (SELECT {keys}, regexp_extract_all(text, '{pattern}') AS found FROM {source}),
    u AS (SELECT {keys}, i AS place, found[i] AS v FROM f, unnest(range(1, len(found) + 1)) AS t(i)),
    k AS (SELECT {keys}, place, v, CASE {_typed} END AS kind FROM u)
    SELECT {keys}, md5(coalesce(string_agg(kind || '=' || v, '|' ORDER BY place), '')) AS digest,
      {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k.lower()}" for k in _ORDER)}
    FROM {source} LEFT JOIN (SELECT * FROM k WHERE kind IS NOT NULL) USING ({keys}) GROUP BY {keys}"""


ORACLES["text_spans_documents"] = _spans("documents", "doc_id")
ORACLES["text_spans_conversations"] = _spans("conversations", "conv_id, turn")

# ---- known persons: every value looked for in every text

_known = {"email": "email", "phone": "phone", "account": "account_number", "name": "first_name || ' ' || last_name"}


def _persons(source: str, keys: str, number: str) -> str:
    values = " UNION ALL ".join(
        f"SELECT {i} AS place, lower(regexp_replace({X.strip(v)}, '\\s+', ' ', 'g')) AS value FROM clean_banking"
        for i, v in enumerate(_known.values())
    )
    kinds = "[" + ", ".join(f"'{k}'" for k in _known) + "]"
    return rf"""
    WITH {clean_ctes('banking')},
    said AS (SELECT _bronze_id, ' Seen: ' || upper(email) || ', ' || account_number || '; ' || first_name || '  '
      || last_name || ' (' || phone || ')' AS said FROM raw_banking),
    t AS MATERIALIZED (SELECT {keys}, text || coalesce(said, '') AS text,
      lower(regexp_replace(text || coalesce(said, ''), '\s+', ' ', 'g')) AS low
      FROM {source} LEFT JOIN said ON _bronze_id = {number}),
    w AS MATERIALIZED (SELECT value, {kinds}[1 + min(place)] AS kind FROM ({values}) WHERE length(value) >= 5 GROUP BY value),
    c AS (SELECT {keys}, any_value(text) AS text, string_agg(replace(regexp_escape(value), '\ ', '\s+'), '|' ORDER BY length(value) DESC, value) AS pattern
      FROM t JOIN w ON contains(low, value) GROUP BY {keys}),
    f AS (SELECT {keys}, regexp_extract_all(text, '(?i)\b(?:' || pattern || ')\b') AS found FROM c),
    u AS (SELECT {keys}, i AS place, lower(found[i]) AS v, lower(regexp_replace(found[i], '\s+', ' ', 'g')) AS value
      FROM f, unnest(range(1, len(found) + 1)) AS x(i)),
    k AS (SELECT * FROM u JOIN w USING (value))
    SELECT {keys}, md5(coalesce(string_agg(v, '|' ORDER BY place), '')) AS digest,
      {', '.join(f"count(*) FILTER (kind = '{k}') AS n_known_{k}" for k in _known)}
    FROM {source} LEFT JOIN k USING ({keys}) GROUP BY {keys}"""


ORACLES["known_persons_documents"] = _persons("documents", "doc_id", "doc_id % 700")
ORACLES["known_persons_conversations"] = _persons("conversations", "conv_id, turn", "conv_id * 7 + turn")

# ---- keys found in the data


def _key_checks(domain: str, table=lambda name: name) -> list[str]:
    """One SELECT per declared key of a domain; `table` names the CTE of a star table."""
    spec, out = DOMAINS[domain], []
    fact = table(f"{domain}_{spec.fact.name}")
    for d in spec.dims:
        own, key = table(f"{domain}_{d.name}"), d.fact_key or d.key
        repeated = f"SELECT count(*) FROM (SELECT {d.key} FROM {own} WHERE {d.key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        out.append(
            f"SELECT 'star_{domain}' AS schema_name, '{d.name}' AS table_name, '{d.key}' AS column_name, 'PRIMARY KEY' AS constraint_type, "
            f"NULL AS ref_table, NULL AS ref_column, (SELECT count(*) - count({d.key}) FROM {own}) + ({repeated}) AS violations"
        )
        out.append(
            f"SELECT 'star_{domain}', '{spec.fact.name}', '{key}', 'FOREIGN KEY', '{d.name}', '{d.key}', (SELECT count(DISTINCT {key}) FROM {fact} "
            f"WHERE {key} NOT IN (SELECT {d.key} FROM {own} WHERE {d.key} IS NOT NULL))"
        )
    return out


ORACLES["declared_keys"] = f"WITH {_STARS} " + " UNION ALL ".join(x for n in DOMAINS for x in _key_checks(n))
_swap = {"medical_dim_diagnosis": "few", "medical_dim_doctor": "twice", "medical_dim_location": "keyless"}
ORACLES["broken_keys"] = f"""
    WITH {star_ctes('medical')},
    few AS (SELECT * FROM medical_dim_diagnosis WHERE diagnosis NOT LIKE '%7'),
    twice AS (SELECT * FROM medical_dim_doctor UNION ALL SELECT * FROM medical_dim_doctor WHERE doctor_name LIKE '%Rao'),
    keyless AS (SELECT CASE WHEN city <> 'Ranchi' THEN location_key END AS location_key FROM medical_dim_location)
    SELECT * FROM ({' UNION ALL '.join(_key_checks('medical', lambda t: _swap.get(t, t)))}) WHERE violations > 0"""

_ints = [
    ("region", "r_regionkey"), ("nation", "n_nationkey"), ("nation", "n_regionkey"), ("customer", "c_custkey"),
    ("customer", "c_nationkey"), ("supplier", "s_suppkey"), ("supplier", "s_nationkey"), ("part", "p_partkey"),
    ("part", "p_size"), ("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"),
    ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("lineitem", "l_linenumber"), ("events", "event_id"),
    ("events", "user_id"), ("labels", "doc_id"), ("labels", "quality"), ("labels", "toxic"), ("documents", "doc_id"),
    ("documents", "n_chars"),
]
ORACLES["inclusion_dependencies"] = " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS column_name, '{u}.{d}' AS within_column WHERE NOT EXISTS "
    f"(SELECT {c} FROM {t} WHERE {c} NOT IN (SELECT {d} FROM {u}))"
    for t, c in _ints
    for u, d in _ints
    if (t, c) != (u, d)
)

# Text columns with names that say nothing: only the values tell. Samples are the rows of lowest key hash.
_HIDDEN = """h AS (SELECT c_custkey, 'MRN-2025-' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS campaign,
  CASE WHEN c_custkey % 2 = 0 THEN '4111 1111 1111 1111' ELSE '5500005555555559' END AS course,
  CASE WHEN c_custkey % 2 = 0 THEN '4111111111111112' ELSE CAST(100000000000 + c_custkey AS VARCHAR) END AS department,
  '12/07/' || CAST(1950 + c_custkey % 50 AS VARCHAR) AS channel,
  '12/07/' || CAST(2020 + c_custkey % 5 AS VARCHAR) AS note FROM customer)"""
_hidden = ["c_custkey", "campaign", "course", "department", "channel", "note"]
_hidden_name = "CASE WHEN column_name = 'c_custkey' THEN 'DIRECT_IDENTIFIER' WHEN column_name <> 'note' AND by_format IS NULL THEN 'NON_PII' END"
ORACLES["rule_formats"] = f"""
    WITH {_HIDDEN}, sampled AS ({samples('h', _hidden, 'c_custkey')}),
    feats AS (SELECT column_name, {features()}, {_own_shares} FROM sampled GROUP BY 1),
    formed AS (SELECT *, coalesce({_by_format}, CASE WHEN birth_share >= 0.6 THEN 'DATE_OF_BIRTH' END) AS by_format,
      greatest({_share}, birth_share) AS share FROM feats),
    ruled AS (SELECT *, {_hidden_name} AS by_name FROM formed)
    SELECT column_name, coalesce(by_name, by_format, 'NON_PII') AS pii_type,
      CASE WHEN by_name IS NOT NULL THEN 0.9 WHEN by_format IS NOT NULL THEN share ELSE 0.5 END AS final_confidence,
      CASE WHEN by_name IS NOT NULL THEN 'NAME' WHEN by_format IS NOT NULL THEN 'VALUES' ELSE 'NONE' END AS evidence FROM ruled"""

_education = {f"star_education/{t}": (f"education_{t}", c) for t, c in star_columns("education").items()}
_education["silver/education"] = ("silver_education", ["_bronze_id", *FIELDS["education"], "city", "state"])
ORACLES["counts_from_footers"] = f"WITH {star_ctes('education')} " + " UNION ALL ".join(
    counts(cte, columns, f"'{name}' AS table_name, ") for name, (cte, columns) in _education.items()
)
