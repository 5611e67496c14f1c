from __future__ import annotations

from oracles import exprs as X
from oracles.exprs import FIELDS, clean_ctes, raw_cte, silver_ctes
from oracles.fixed import SENSITIVITY_POLICY
from veilwork.schemas import DOMAINS


def _columns(domain, **columns):
    picked = ", ".join(f"{expr} AS {out}" for out, expr in columns.items())
    return f"WITH {raw_cte(domain)} SELECT _bronze_id, {picked} FROM raw_{domain}"


def valid(c, pattern):
    return f"coalesce({X.full(c, pattern)}, false)"


ORACLES = {
    "is_missing": _columns("marketing", missing="customer_id IS NULL"),
    "clean_text": _columns("education", course=X.text("course"), department=X.text("department")),
    "clean_name": _columns("banking", first_name=X.name("first_name"), last_name=X.name("last_name")),
    "clean_email": _columns("banking", email=X.email("email")),
    "is_valid_email": _columns("education", valid=valid("email", X.EMAIL)),
    "clean_phone": _columns("banking", phone=X.phone("phone")),
    "is_valid_phone": _columns("education", valid=valid("phone", "[6-9][0-9]{9}")),
    "clean_date": _columns("banking", date_of_birth=X.date("date_of_birth")),
    "clean_int": _columns("education", student_id=X.integer("student_id")),
    "clean_amount": _columns("banking", balance=X.amount("balance")),
    "clean_percentage": _columns("education", percentage=X.percentage("percentage")),
    "clean_age": _columns("marketing", age=X.age("age")),
    "clean_upper": _columns("marketing", channel=X.upper("channel")),
    "clean_account_type": _columns("banking", account_type=X.account_type("account_type")),
    "clean_gender": _columns("marketing", gender=X.gender("gender")),
    "clean_blood_group": _columns("medical", blood_group=X.blood_group("blood_group")),
    "clean_channel": _columns("marketing", channel=X.channel("channel")),
    "clean_account_number": _columns("banking", account_number=X.record_number("account_number")),
    "clean_medical_record_number": _columns(
        "medical", medical_record_number=X.record_number("medical_record_number")
    ),
    "clean_location": _columns(
        "education", address=X.text("address"), city=X.place("address", 1), state=X.place("address", 2)
    ),
    "clean_text_documents": f"""
        WITH t AS (SELECT doc_id, {X.text('text')} AS clean FROM documents)
        SELECT doc_id, length(clean) AS n, md5(clean) AS digest FROM t""",
    "date_is_not_future": _columns("education", ok=f"coalesce({X.date('date_of_birth')} <= {X.TODAY}, true)"),
    "admission_is_consistent": _columns(
        "medical", ok=f"coalesce({X.date('admission_date')} >= {X.date('date_of_birth')}, true)"
    ),
    "as_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
    "comparable_values": f"""
        WITH {clean_ctes('banking')}
        SELECT _bronze_id, coalesce(CAST(customer_id AS VARCHAR), '') AS customer_id,
          coalesce(lower(first_name), '') AS first_name, coalesce(strftime(date_of_birth, '%Y-%m-%d'), '') AS date_of_birth,
          coalesce(lower(account_type), '') AS account_type, coalesce(lower(city), '') AS city,
          coalesce(CASE WHEN balance = floor(balance) THEN CAST(CAST(balance AS BIGINT) AS VARCHAR)
                        ELSE CAST(balance AS VARCHAR) END, '') AS balance
        FROM clean_banking""",
    "common_fields": f"""
        WITH {clean_ctes('marketing')}
        SELECT _bronze_id, first_name, last_name, email, phone, address, city, state FROM typed_marketing""",
    "date_rules": f"""
        WITH {clean_ctes('medical')} SELECT _bronze_id, date_of_birth, admission_date FROM clean_medical""",
    "critical_faults": f"WITH {silver_ctes('education')} SELECT _bronze_id, fault FROM fault_education",
    "rejected_rows": f"""
        WITH {silver_ctes('banking')} SELECT _bronze_id, reject_reason FROM reason_banking WHERE reject_reason IS NOT NULL""",
    "not_null_filter": f"""
        WITH {clean_ctes('banking')} SELECT _bronze_id, account_number FROM clean_banking WHERE account_number IS NOT NULL""",
    "in_list_filter": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "conditional_columns": """
        SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS returned,
          CASE WHEN l_quantity >= 30 THEN 'BULK' WHEN l_quantity >= 10 THEN 'PACK' ELSE 'UNIT' END AS size FROM lineitem""",
    "skip_processed": f"""
        WITH {raw_cte('education')} SELECT _bronze_id, student_id FROM raw_education
        WHERE _bronze_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "dedupe_first_wins": """
        SELECT event_id, user_id, event_type, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
    "insert_ignore": """
        SELECT DISTINCT user_id, 'seen' AS state FROM events WHERE event_type <> 'click'
          AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click' AND value > 150)""",
    "duplicate_documents": f"""
        WITH s AS (SELECT doc_id, lower({X.strip('text')}) AS v FROM documents)
        SELECT sha256(length(v) || ':' || v) AS signature, count(*) AS copies, min(doc_id) AS first_id
        FROM s GROUP BY 1 HAVING count(*) > 1""",
}

for _name, _spec in DOMAINS.items():
    _all = ", ".join(FIELDS[_name])
    ORACLES[f"silver_{_name}"] = f"""
        WITH {silver_ctes(_name)} SELECT _bronze_id, {_all}, city, state FROM silver_{_name}"""
    ORACLES[f"classified_{_name}"] = f"""
        WITH {silver_ctes(_name)} SELECT _bronze_id, {_spec.primary_key}, first_name, reject_reason FROM reason_{_name}"""

_stats = " UNION ALL ".join(
    f"""SELECT '{n}' AS domain, count(*) AS bronze_rows, 0 AS already_processed,
        count(*) FILTER (reject_reason IS NULL) AS inserted, count(*) FILTER (reject_reason IS NOT NULL) AS rejected,
        count(*) FILTER (reject_reason = 'INVALID_PRIMARY_KEY') AS invalid_primary_key,
        count(*) FILTER (reject_reason = 'MISSING_FIRST_NAME') AS missing_first_name,
        count(*) FILTER (reject_reason = 'DUPLICATE_PRIMARY_KEY') AS duplicate_primary_key, 0 AS exact_duplicate
        FROM reason_{n}"""
    for n in DOMAINS
)
_COUNTS = (
    "bronze_rows", "already_processed", "inserted", "rejected", "invalid_primary_key", "missing_first_name",
    "duplicate_primary_key", "exact_duplicate",
)
_sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTS)
ORACLES["silver_run_stats"] = (
    f"WITH {', '.join(silver_ctes(n) for n in DOMAINS)}, s AS ({_stats}) "
    f"SELECT domain, {_sums} FROM s GROUP BY 1 UNION ALL SELECT 'TOTAL', {_sums} FROM s"
)
ORACLES["ingest_to_silver"] = ORACLES["silver_run_stats"]

_types = list(SENSITIVITY_POLICY)
_pick = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_types))
_level = " ".join(f"WHEN '{t}' THEN '{level}'" for t, level in SENSITIVITY_POLICY.items())
ORACLES["sensitivity_policy"] = f"""
    WITH t AS (SELECT CASE l_partkey % {len(_types)} {_pick} END AS pii_type, l_quantity FROM lineitem)
    SELECT pii_type, CASE pii_type {_level} END AS sensitivity_level, count(*) AS n, sum(l_quantity) AS quantity
    FROM t GROUP BY 1, 2"""

# A first batch is settled, then all records are offered.
_two = f"""
    WITH {clean_ctes('banking')},
    f AS (SELECT c.*, r.first_name LIKE '%building%' OR r.first_name LIKE '%machinery%' AS early,
            CASE WHEN c.customer_id IS NULL THEN 'INVALID_PRIMARY_KEY' WHEN c.first_name IS NULL THEN 'MISSING_FIRST_NAME' END AS fault
          FROM clean_banking c JOIN raw_banking r USING (_bronze_id)),
    done AS (SELECT * FROM f WHERE early AND fault IS NULL
             QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _bronze_id) = 1),
    open AS (SELECT * FROM f WHERE _bronze_id NOT IN (SELECT _bronze_id FROM done)),
    judged AS (SELECT *, CASE WHEN fault IS NOT NULL THEN fault
        WHEN customer_id IN (SELECT customer_id FROM done) THEN 'DUPLICATE_PRIMARY_KEY'
        WHEN row_number() OVER (PARTITION BY fault IS NULL, customer_id ORDER BY _bronze_id) > 1 THEN 'DUPLICATE_PRIMARY_KEY'
        END AS reject_reason FROM open)
"""
ORACLES["silver_second_batch"] = _two + "SELECT _bronze_id, customer_id, email FROM judged WHERE reject_reason IS NULL"
ORACLES["classified_second_batch"] = _two + "SELECT _bronze_id, customer_id, reject_reason FROM judged"


def _comparable(c, kind="text"):
    if kind == "date":
        return f"coalesce(strftime({c}, '%Y-%m-%d'), '')"
    if kind == "double":
        return (
            f"coalesce(CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END, '')"
        )
    return f"coalesce(lower({X.strip(c)}), '')"


def _signature(columns):
    parts = []
    for c, kind in columns:
        text = _comparable(c, kind)
        parts += [f"CAST(length({text}) AS VARCHAR)", text]
    return f"sha256(concat_ws(':', {', '.join(parts)}))"


_education = (
    ("first_name", "text"), ("last_name", "text"), ("date_of_birth", "date"),
    ("course", "text"), ("department", "text"), ("percentage", "double"),
)
ORACLES["row_signature"] = f"""
    WITH {clean_ctes('education')} SELECT _bronze_id, {_signature(_education)} AS signature FROM clean_education"""
_medical = [(c, "text") for c in ("first_name", "email", "blood_group", "doctor_name", "diagnosis")]
ORACLES["duplicate_groups"] = f"""
    WITH {clean_ctes('medical')} SELECT {_signature(_medical)} AS signature, count(*) AS copies, min(_bronze_id) AS first_id
    FROM clean_medical GROUP BY 1 HAVING count(*) > 1"""
_marketing = (("first_name", "text"), ("email", "text"), ("gender", "text"), ("campaign_date", "date"))
ORACLES["exact_duplicates_refused"] = f"""
    WITH {clean_ctes('marketing')},
    s AS (SELECT _bronze_id, channel, {_signature(_marketing)} AS sig FROM clean_marketing)
    SELECT _bronze_id FROM s WHERE channel IS DISTINCT FROM 'EMAIL'
      AND sig NOT IN (SELECT sig FROM s WHERE channel = 'EMAIL')
    QUALIFY row_number() OVER (PARTITION BY sig ORDER BY _bronze_id) = 1"""
