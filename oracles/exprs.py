"""DuckDB expressions for single values."""

from __future__ import annotations

from oracles.fixed import PLACES
from veilwork.queries.views import AS_OF, VIEWS
from veilwork.schemas import DOMAINS

WS = r"[\t\n\x0b\f\r\x1c-\x1f\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TODAY = f"DATE '{AS_OF.isoformat()}'"


def full(c: str, pattern: str) -> str:
    return f"regexp_full_match({c}, '{pattern}')"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(c: str) -> str:
    return f"regexp_replace({c}, '{WS}+', ' ', 'g')"


def text(c: str) -> str:
    return f"nullif(trim({collapse(c)}), '')"


def name(c: str) -> str:
    s = strip(c)
    return f"CASE WHEN {full(s, "[A-Za-zÀ-ÿ.'' -]+")} THEN {collapse(s)} END"


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def email(c: str) -> str:
    low = f"lower({text(c)})"
    return f"CASE WHEN {full(low, EMAIL)} THEN {low} END"


def phone(c: str) -> str:
    t = text(c)
    digits = f"regexp_replace({t}, '[^0-9]', '', 'g')"
    local = (
        f"CASE WHEN {digits} LIKE '91%' AND length({digits}) = 12 THEN substr({digits}, 3) "
        f"WHEN {digits} LIKE '0%' AND length({digits}) = 11 THEN substr({digits}, 2) ELSE {digits} END"
    )
    return f"CASE WHEN {full(t, '[+0-9 ()-]+')} AND {full(local, '[6-9][0-9]{9}')} THEN {local} END"


def date(c: str) -> str:
    t = text(c)
    long_formats = "['%d/%m/%Y', '%d-%m-%Y', '%d.%m.%Y']"
    padded = f"left({t}, length({t}) - 2) || CASE WHEN right({t}, 2) < '69' THEN '20' ELSE '19' END || right({t}, 2)"
    return (
        f"CASE WHEN {full(t, '[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{4}')} THEN CAST(try_strptime({t}, {long_formats}) AS DATE) "
        f"WHEN {full(t, '[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{2}')} THEN CAST(try_strptime({padded}, {long_formats}) AS DATE) "
        f"WHEN {full(t, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')} THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE) END"
    )


def integer(c: str) -> str:
    t = text(c)
    return f"CASE WHEN {full(t, '[-+]?[0-9]+(\\.0*)?')} THEN try_cast(regexp_replace({t}, '\\.0*$', '') AS BIGINT) END"


def number(t: str) -> str:
    return f"CASE WHEN {full(t, '[-+]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][-+]?[0-9]+)?')} THEN try_cast({t} AS DOUBLE) END"


def amount(c: str) -> str:
    return number(f"trim(replace(replace({text(c)}, '₹', ''), ',', ''))")


def percentage(c: str) -> str:
    n = number(f"trim(rtrim({text(c)}, '%'))")
    return f"CASE WHEN {n} BETWEEN 0 AND 100 THEN {n} END"


def age(c: str) -> str:
    n = integer(c)
    return f"CASE WHEN {n} BETWEEN 0 AND 120 THEN {n} END"


def upper(c: str) -> str:
    return f"upper({text(c)})"


def one_of(c: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN {upper(c)} IN ({listed}) THEN {upper(c)} END"


def account_type(c: str) -> str:
    return one_of(c, "SAVINGS", "CURRENT", "SALARY", "FIXED_DEPOSIT")


def gender(c: str) -> str:
    return one_of(c, "MALE", "FEMALE", "OTHER")


def blood_group(c: str) -> str:
    return one_of(c, "A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")


def channel(c: str) -> str:
    return one_of(c, "EMAIL", "SMS", "SOCIAL", "SEARCH", "REFERRAL")


def record_number(c: str) -> str:
    t = text(c)
    return f"CASE WHEN {full(t, '[A-Za-z0-9][A-Za-z0-9_-]{2,49}')} THEN {t} END"


def place(c: str, part: int) -> str:
    low = f"lower({text(c)})"
    whens = " ".join(f"WHEN contains({low}, '{p[0]}') THEN '{p[part]}'" for p in PLACES)
    return f"CASE {whens} END"


FIELDS = {
    "banking": {
        "customer_id": integer, "first_name": name, "last_name": name, "email": email, "phone": phone,
        "date_of_birth": date, "account_number": record_number, "account_type": account_type,
        "balance": amount, "address": text,
    },
    "education": {
        "student_id": integer, "first_name": name, "last_name": name, "email": email, "phone": phone,
        "date_of_birth": date, "address": text, "course": text, "department": text,
        "enrollment_date": date, "percentage": percentage,
    },
    "medical": {
        "patient_id": integer, "first_name": name, "last_name": name, "email": email, "phone": phone,
        "date_of_birth": date, "address": text, "blood_group": blood_group, "diagnosis": text,
        "doctor_name": name, "admission_date": date, "medical_record_number": record_number,
    },
    "marketing": {
        "customer_id": integer, "first_name": name, "last_name": name, "email": email, "phone": phone,
        "address": text, "age": age, "gender": gender, "campaign_name": text, "campaign_date": date,
        "channel": channel,
    },
}

PK = {name: d.primary_key for name, d in DOMAINS.items()}


def not_future(c: str) -> str:
    return f"CASE WHEN {c} <= {TODAY} THEN {c} END"


def raw_cte(domain: str) -> str:
    return f"raw_{domain} AS ({VIEWS[domain]})"


def clean_ctes(domain: str) -> str:
    """raw_, typed_ (cleaned) and clean_ (with date rules) of a domain."""
    typed = ", ".join(f"{fn(c)} AS {c}" for c, fn in FIELDS[domain].items())
    dates = {c for c, fn in FIELDS[domain].items() if fn is date}
    columns = []
    for c in FIELDS[domain]:
        if c not in dates:
            columns.append(c)
        elif c == "admission_date":
            birth = not_future("date_of_birth")
            columns.append(
                f"CASE WHEN {c} <= {TODAY} AND ({birth} IS NULL OR {c} >= {birth}) THEN {c} END AS {c}"
            )
        else:
            columns.append(f"{not_future(c)} AS {c}")
    return (
        f"{raw_cte(domain)}, typed_{domain} AS MATERIALIZED (SELECT _bronze_id, {typed}, "
        f"{place('address', 1)} AS city, {place('address', 2)} AS state FROM raw_{domain}), "
        f"clean_{domain} AS (SELECT _bronze_id, {', '.join(columns)}, city, state FROM typed_{domain})"
    )


def silver_ctes(domain: str) -> str:
    """The above with fault_ (every row and its reason) and silver_ (accepted rows)."""
    pk = PK[domain]
    return (
        f"{clean_ctes(domain)}, fault_{domain} AS (SELECT *, CASE WHEN {pk} IS NULL THEN 'INVALID_PRIMARY_KEY' "
        f"WHEN first_name IS NULL THEN 'MISSING_FIRST_NAME' END AS fault FROM clean_{domain}), "
        f"reason_{domain} AS (SELECT * EXCLUDE (fault), CASE WHEN fault IS NOT NULL THEN fault "
        f"WHEN row_number() OVER (PARTITION BY fault IS NULL, {pk} ORDER BY _bronze_id) > 1 THEN 'DUPLICATE_PRIMARY_KEY' END "
        f"AS reject_reason FROM fault_{domain}), "
        f"silver_{domain} AS MATERIALIZED (SELECT * EXCLUDE (reject_reason) FROM reason_{domain} WHERE reject_reason IS NULL)"
    )


def hash60(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in columns)
    return f"CAST('0x' || substr(md5(concat_ws(chr(31), {parts})), 1, 15) AS BIGINT)"


def surrogate(columns: tuple[str, ...], buckets: int, base: int = 0) -> str:
    bucket = f"({hash60(*columns)} % {buckets})"
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"{base} + (row_number() OVER (PARTITION BY {bucket} ORDER BY {order}) - 1) * {buckets} + {bucket} + 1"


def date_parts(c: str, week: bool = True) -> str:
    extra = f"dayname({c}) AS day_name, CAST(weekofyear({c}) AS BIGINT) AS week, " if week else ""
    return (
        f"CAST(strftime({c}, '%Y%m%d') AS BIGINT) AS date_key, {c} AS full_date, CAST(day({c}) AS BIGINT) AS day, {extra}"
        f"CAST(month({c}) AS BIGINT) AS month, monthname({c}) AS month_name, CAST(quarter({c}) AS BIGINT) AS quarter, "
        f"CAST(year({c}) AS BIGINT) AS year, isodow({c}) IN (6, 7) AS is_weekend"
    )
