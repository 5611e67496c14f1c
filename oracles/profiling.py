from __future__ import annotations

from oracles import exprs as X
from oracles.exprs import FIELDS, clean_ctes, hash60, raw_cte
from oracles.fixed import KEYWORDS, PROFILE_FEATURES

FORMATS = {
    "email": X.EMAIL,
    "phone": r"(?:\+91[- ]?|0)?[6-9][0-9]{9}",
    "date": r"[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4}",
    "credit_card": r"(?:[0-9][ -]?){13,19}",
    "bank_account": r"[0-9]{8,18}",
    "medical_record": r"(?i)(?:MRN[-_ ]?)?[A-Za-z0-9]{5,20}",
    "numeric": r"[-+]?[0-9]+(?:\.[0-9]+)?",
    "alphabetic": r"[A-Za-z .\-'']+",
    "alphanumeric": "[A-Za-z0-9]+",
}


def fits(c: str, kind: str) -> str:
    value = f"replace({c}, ' ', '')" if kind == "credit_card" else c
    return f"coalesce({X.full(value, FORMATS[kind])}, false)"


def long_rows(source: str, columns: list[str], keep: str = "") -> str:
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns
    )


def counts(source: str, columns: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS column_name, count(*) AS records_scanned, count({c}) AS non_null_records FROM {source}"
        for c in columns
    )


def samples(source: str, columns: list[str], key: str, extra: str = "") -> str:
    """(column_name, n, value): the five non-null values of lowest row hash."""
    return " UNION ALL ".join(
        f"(SELECT {extra}'{c}' AS column_name, row_number() OVER (ORDER BY {hash60(key)}, CAST({c} AS VARCHAR)) AS n, "
        f"{X.strip(f'CAST({c} AS VARCHAR)')} AS value FROM {source} WHERE {c} IS NOT NULL QUALIFY n <= 5)"
        for c in columns
    )


def features(n: str = "count(*)") -> str:
    """Aggregates over `value`, one per profile feature."""
    parts = [
        f"coalesce(round(count(*) FILTER ({fits('value', k)}) / nullif({n}, 0), 6), 0.0) AS {f}"
        for k, f in zip(FORMATS, PROFILE_FEATURES)
    ]
    length = "CAST(length(value) AS DOUBLE)"
    words = f"CAST(len(list_filter(regexp_split_to_array(value, '{X.WS}+'), lambda w: w <> '')) AS DOUBLE)"
    parts += [
        f"coalesce(round(count(DISTINCT lower(value)) / nullif({n}, 0), 6), 0.0) AS unique_ratio",
        f"coalesce(round(avg({length}), 6), 0.0) AS avg_length",
        f"coalesce(min({length}), 0.0) AS min_length",
        f"coalesce(max({length}), 0.0) AS max_length",
        "CAST(0 AS DOUBLE) AS null_or_empty",
        f"CAST({n} AS DOUBLE) AS sample_count",
        f"coalesce(round(stddev_pop({length}), 6), 0.0) AS std_length",
        f"coalesce(round(avg({words}), 6), 0.0) AS avg_word_count",
        f"coalesce(round(count(*) FILTER (regexp_matches(value, '[0-9]')) / nullif({n}, 0), 6), 0.0) AS digit_value_ratio",
    ]
    return ", ".join(parts)


def profile(source: str, columns: list[str]) -> str:
    trimmed = X.strip("value")
    return f"""
    SELECT column_name, count(*) AS records, count(value) AS values,
      round((count(*) - count(value)) / count(*), 6) AS null_ratio, {features('count(value)')}
    FROM (SELECT column_name, nullif({trimmed}, '') AS value FROM ({long_rows(source, columns)})) GROUP BY 1"""


ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice"]
_orders = "ord AS (SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders)"
_marketing = ["_bronze_id", *FIELDS["marketing"], "city", "state"]
_medical = [*FIELDS["medical"], "city", "state"]
_lineitem = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_banking = list(FIELDS["banking"])
_listed = "string_agg(value, '|' ORDER BY n)"
_names = "['Customer-ID', 'email_address', 'account-no', 'DOB', 'blood_group', 'full-name']"
_flags = " || ".join(
    f"CASE WHEN contains(replace(lower(v), '-', '_'), '{k}') THEN '1' ELSE '0' END" for k in KEYWORDS
)

ORACLES = {
    "split_samples": f"""
        WITH {raw_cte('banking')},
        j AS (SELECT _bronze_id, CASE WHEN account_type = 'VIP' THEN 'null'
                ELSE concat_ws('|', first_name, phone, account_number, balance) END AS v FROM raw_banking),
        p AS (SELECT _bronze_id, CASE WHEN upper(trim(v)) IN ('', 'NULL') THEN []
                ELSE list_filter(list_transform(string_split(trim(v), '|'), lambda x: trim(x)), lambda x: x <> '') END AS a FROM j)
        SELECT _bronze_id, len(a) AS n, array_to_string(a, ',') AS parts FROM p""",
    "ratio": """
        SELECT l_suppkey, coalesce(round(count(*) FILTER (l_returnflag = 'R')
          / nullif(count(*) FILTER (l_quantity > 49), 0), 6), 0.0) AS ratio FROM lineitem GROUP BY 1""",
    "format_predicates": f"""
        WITH {raw_cte('banking')}, l AS ({long_rows('raw_banking', _banking, '_bronze_id')})
        SELECT _bronze_id, column_name, {', '.join(f"{fits('trim(value)', k)} AS {k}" for k in FORMATS)} FROM l""",
    "as_flag": """
        SELECT event_id, CASE WHEN event_type IN ('click', 'view') OR (event_type = 'error' AND user_id = 1)
          THEN 1::BIGINT ELSE 0::BIGINT END AS flag FROM events""",
    "keyword_flags": f"""
        WITH t AS (SELECT event_id, event_type || '_' || ({_names})[user_id % 6 + 1] AS v FROM events)
        SELECT event_id, {_flags} AS flags FROM t""",
    "semantic_text": f"""
        WITH {raw_cte('marketing')}
        SELECT _bronze_id, 'Domain: Campaign ' || upper(substr(campaign_name, 10, 1)) || substr(campaign_name, 11)
          || '. Table: ' || lower(replace(campaign_name, ' ', '_')) || '. Table type: '
          || CASE WHEN campaign_name LIKE 'Campaign c%' THEN 'DIMENSION' ELSE 'TABLE' END
          || '. Column: ' || coalesce(customer_id, 'NULL') || '. Data type: text. Sample values: '
          || trim(first_name || '|' || gender) || '.' AS sentence FROM raw_marketing""",
    "text_or_null_word": f"""
        WITH {raw_cte('marketing')} SELECT _bronze_id, coalesce(customer_id, 'NULL') AS customer_id FROM raw_marketing""",
    "domain_of_schema": """
        SELECT c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS domain,
          'Warehouse table in star_' || lower(c_mktsegment) AS description FROM customer""",
    "table_type": """
        SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'FACT' WHEN 1 THEN 'DIMENSION' ELSE 'TABLE' END AS table_type FROM part""",
    "column_counts": f"WITH {clean_ctes('marketing')} {counts('clean_marketing', _marketing)}",
    "column_counts_lineitem": counts("lineitem", _lineitem),
    "column_samples": f"""
        WITH {_orders} SELECT column_name, {_listed} AS samples FROM ({samples('ord', ORDERS, 'o_orderkey')}) GROUP BY 1""",
    "column_samples_sparse": f"""
        WITH {clean_ctes('marketing')} SELECT column_name, {_listed} AS samples
        FROM ({samples('clean_marketing', _marketing, '_bronze_id')}) GROUP BY 1""",
    "sample_features": f"""
        WITH {_orders} SELECT column_name, {features()} FROM ({samples('ord', ORDERS, 'o_orderkey')}) GROUP BY 1""",
    "profile_columns": f"WITH {clean_ctes('medical')} {profile('clean_medical', _medical)}",
    "profile_conversations": profile("conversations", ["conv_id", "turn", "role", "text"]),
}
_kept = ", ".join(
    ["null_ratio", *PROFILE_FEATURES[:9], "avg_length", "std_length", "avg_word_count", "digit_value_ratio", "min_length", "max_length"]
)
ORACLES["profile_by_loads"] = f"""
    WITH {raw_cte('banking')}, p AS ({profile('raw_banking', _banking)})
    SELECT column_name, records, values, {_kept}, true AS unique_close, true AS median_close, 2::BIGINT AS loads_sketched FROM p"""
ORACLES["profile_lineitem"] = f"SELECT * EXCLUDE (unique_ratio), true AS unique_close FROM ({profile('lineitem', _lineitem)})"
