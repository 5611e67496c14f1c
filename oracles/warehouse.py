from __future__ import annotations

from oracles.exprs import PK, clean_ctes, date_parts, raw_cte, silver_ctes, surrogate
from veilwork.queries.views import VIEWS
from veilwork.schemas import DOMAINS

BUCKETS = 64


def star_ctes(domain: str) -> str:
    """Silver CTEs, then one per star table, named <domain>_<table>."""
    spec = DOMAINS[domain]
    parts = [silver_ctes(domain)]
    joins, keys = [], []
    for i, dim in enumerate(spec.dims):
        cte = f"{domain}_{dim.name}"
        if dim.is_date:
            day = dim.attrs[0]
            parts.append(
                f"{cte} AS (SELECT {date_parts('d')} FROM (SELECT DISTINCT {day} AS d FROM silver_{domain} WHERE {day} IS NOT NULL))"
            )
            joins.append(f"LEFT JOIN {cte} d{i} ON d{i}.full_date = s.{day}")
            keys.append(f"d{i}.date_key AS {dim.fact_key}")
            continue
        where = " AND ".join(f"{c} IS NOT NULL" for c in dim.required) or "true"
        columns = ", ".join(dim.attrs)
        parts.append(
            f"{cte} AS MATERIALIZED (SELECT {surrogate(dim.attrs, BUCKETS)} AS {dim.key}, {columns} "
            f"FROM (SELECT DISTINCT {columns} FROM silver_{domain} WHERE {where}))"
        )
        test = "IS NOT DISTINCT FROM" if dim.null_safe_lookup else "="
        on = " AND ".join(f"d{i}.{c} {test} s.{c}" for c in dim.lookup_columns)
        joins.append(f"{'JOIN' if dim.is_person else 'LEFT JOIN'} {cte} d{i} ON {on}")
        keys.append(f"d{i}.{dim.key}")
    measures = [f"CAST({e} AS {'BIGINT' if e == '1' else 'DOUBLE'}) AS {m}" for m, e in spec.fact.measures]
    parts.append(
        f"{domain}_{spec.fact.name} AS (SELECT {', '.join(keys + measures)}, s._bronze_id "
        f"FROM silver_{domain} s {' '.join(joins)})"
    )
    return ", ".join(parts)


ORACLES = {}
for _name, _spec in DOMAINS.items():
    for _table in [d.name for d in _spec.dims] + [_spec.fact.name]:
        ORACLES[f"{_name}_{_table}"] = f"WITH {star_ctes(_name)} SELECT * FROM {_name}_{_table}"

ORACLES["fact_second_load"] = f"""
    WITH {silver_ctes('banking')},
    old AS (SELECT * FROM silver_banking WHERE account_type = 'SAVINGS'),
    new AS (SELECT * FROM silver_banking WHERE account_type IS DISTINCT FROM 'SAVINGS')
    SELECT 'dim_customer' AS table_name, count(*) AS added FROM new
      WHERE customer_id NOT IN (SELECT customer_id FROM old)
    UNION ALL SELECT 'dim_account', count(*) FROM (SELECT DISTINCT account_number, account_type FROM new
      WHERE account_number IS NOT NULL
        AND account_number NOT IN (SELECT account_number FROM old WHERE account_number IS NOT NULL))
    UNION ALL SELECT 'dim_location', count(*) FROM (
      SELECT address, city, state FROM new EXCEPT SELECT address, city, state FROM old)
    UNION ALL SELECT 'fact_account', count(*) FROM new"""

_counted = " UNION ALL ".join(
    f"SELECT '{n}' AS domain, '{t}' AS table_name, count(*) AS row_count FROM {n}_{t}"
    for n, spec in DOMAINS.items()
    for t in [d.name for d in spec.dims] + [spec.fact.name]
)
ORACLES["star_row_counts"] = f"WITH {', '.join(star_ctes(n) for n in DOMAINS)} {_counted}"

ORACLES |= {
    "surrogate_keys": f"""
        SELECT {surrogate(('p_brand', 'p_type'), BUCKETS, 1000)} AS part_key, p_brand, p_type
        FROM (SELECT DISTINCT p_brand, p_type FROM part)""",
    "date_dimension": f"SELECT {date_parts('d')} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)",
    "date_parts": f"SELECT event_id, {date_parts('d')} FROM (SELECT event_id, CAST(ts AS DATE) AS d FROM events)",
    "calendar": f"""
        SELECT {date_parts('d', week=False)} FROM (
          SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
    "calendar_use": """
        WITH days AS (SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)),
                        CAST(last_day(max(o_orderdate)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
        SELECT year(d) AS year, month(d) AS month, count(o_orderkey) AS orders,
          count(*) FILTER (o_orderkey IS NOT NULL AND isodow(d) >= 6) AS on_weekends
        FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY 1, 2""",
    "join_required": """
        SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment FROM orders
        JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""",
    "join_optional": """
        SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment FROM orders
        LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""",
    "join_null_safe": f"""
        WITH {silver_ctes('education')} SELECT _bronze_id, address, city, state,
          min(_bronze_id) OVER (PARTITION BY address, city, state) AS place_id FROM silver_education""",
    "join_computed_key": """
        WITH days AS (SELECT DISTINCT CAST(CAST(ts AS DATE) - INTERVAL 60 MONTH AS DATE) AS d FROM events)
        SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, dayname(d) AS day_name
        FROM orders LEFT JOIN days ON d = CAST(o_orderdate AS DATE)""",
    "anti_join": """
        SELECT p_partkey AS l_partkey, p_name FROM part
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)""",
    "anti_join_null_safe": f"""
        WITH {silver_ctes('medical')} SELECT DISTINCT address, city, state FROM silver_medical
        WHERE address IS NOT NULL AND city IS DISTINCT FROM 'Ranchi'""",
    "anti_join_required": f"""
        WITH {silver_ctes('medical')} SELECT DISTINCT doctor_name, diagnosis FROM silver_medical
        WHERE doctor_name IS NOT NULL AND doctor_name NOT IN
          (SELECT doctor_name FROM silver_medical WHERE doctor_name IS NOT NULL AND blood_group = 'A+')""",
    "semi_join": """
        SELECT c_custkey AS o_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""",
    "exists_column": """
        SELECT c_custkey, EXISTS (SELECT 1 FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
          WHERE s.s_nationkey = c.c_nationkey AND s.s_acctbal > 5000) AS has_rich_supplier FROM customer c""",
    "multiway_join": """
        SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey""",
    "distinct_rows": f"WITH {silver_ctes('marketing')} SELECT DISTINCT address, city, state FROM silver_marketing",
    "ordered_rows": """
        SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place,
          o_orderkey, o_totalprice FROM orders QUALIFY place <= 10 ORDER BY 1, 2""",
    "first_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "set_difference": """
        SELECT DISTINCT p_partkey FROM part
        WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48)""",
    "aligned_columns": "SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "csv_export": f"WITH {silver_ctes('banking')} SELECT customer_id, email, address FROM silver_banking",
    "bronze_ingest": " UNION ALL ".join(
        f"SELECT '{n}' AS domain, count(*) AS rows, count(*) AS ids, 1::BIGINT AS batches, "
        f"count(*) FILTER (contains(email, '@')) AS emails FROM ({VIEWS[n]}) v"
        for n in DOMAINS
    ),
    "bronze_second_run": "SELECT count(*) > 0 AS all_skipped, 0::BIGINT AS files_failed, 0::BIGINT AS rows_ingested FROM customer",
    "manifest": " UNION ALL ".join(f"SELECT '{n}' AS domain, count(*) AS rows FROM ({VIEWS[n]}) v" for n in DOMAINS),
    "ingest_to_star": f"WITH {', '.join(silver_ctes(n) for n in DOMAINS)} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS domain, count(*) AS fact_rows, 0::BIGINT AS added_by_second_run FROM silver_{n}" for n in DOMAINS
    ),
    "stream_to_silver": f"""
        WITH {silver_ctes('banking')} SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers FROM silver_banking""",
}



def two_batches(domain: str) -> str:
    """fault_ of a domain, then first_ and both_: Silver after the rows with even ids, and after all."""
    pk = PK[domain]
    won = f"SELECT * EXCLUDE (fault) FROM fault_{domain} WHERE fault IS NULL AND _bronze_id % 2 = {{}}"
    once = f"QUALIFY row_number() OVER (PARTITION BY {pk} ORDER BY _bronze_id) = 1"
    return (
        f"{silver_ctes(domain)}, first_{domain} AS MATERIALIZED ({won.format(0)} {once}), "
        f"second_{domain} AS MATERIALIZED ({won.format(1)} AND {pk} NOT IN (SELECT {pk} FROM first_{domain}) {once}), "
        f"both_{domain} AS (SELECT * FROM first_{domain} UNION ALL SELECT * FROM second_{domain})"
    )


def _members(domain: str) -> list[str]:
    """SELECTs of (domain, table, rows after the first batch, rows after both)."""
    spec = DOMAINS[domain]
    out = [
        f"SELECT '{domain}', '{table}', (SELECT count(*) FROM first_{domain}), (SELECT count(*) FROM both_{domain})"
        for table in (f"silver_{domain}", spec.fact.name)
    ]
    for dim in spec.dims:
        where = " AND ".join(f"{c} IS NOT NULL" for c in (dim.required or (dim.attrs if dim.is_date else ()))) or "true"
        test = "IS NOT DISTINCT FROM" if dim.null_safe_load else "="
        same = " AND ".join(f"f.{c} {test} s.{c}" for c in dim.match)
        columns = ", ".join(f"s.{c}" for c in dim.attrs)
        first = f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM first_{domain} s WHERE {where})"
        more = (
            f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM second_{domain} s WHERE {where} "
            f"AND NOT EXISTS (SELECT 1 FROM first_{domain} f WHERE {same}))"
        )
        out.append(f"SELECT '{domain}', '{dim.name}', ({first}), ({first}) + ({more})")
    return out


ORACLES["star_two_batches"] = (
    f"WITH {', '.join(two_batches(n) for n in DOMAINS)}, t(domain, table_name, after_first, after_both) AS ("
    + " UNION ALL ".join(x for n in DOMAINS for x in _members(n))
    + ") SELECT * FROM t"
)
ORACLES["facts_two_batches"] = f"""
    WITH {two_batches('medical')} SELECT patient_id, first_name, doctor_name, address, city, admission_date AS full_date
    FROM both_medical"""

ORACLES["stream_all_domains"] = f"WITH {', '.join(two_batches(n) for n in DOMAINS)} " + " UNION ALL ".join(
    f"SELECT '{n}' AS domain, count(*) AS rows, count(DISTINCT {PK[n]}) AS keys, sum({PK[n]})::BIGINT AS key_sum, "
    f"0::BIGINT AS added_by_repeats FROM both_{n}"
    for n in DOMAINS
)

_digest = """count(*) AS rows, count(*) AS ids, count(DISTINCT customer_id) AS customers,
  sum(length(address))::BIGINT AS address_chars, count(*) FILTER (contains(address, chr(10))) AS broken_addresses"""
for _name in ("stream_two_folders", "stream_header_order", "batch_then_stream"):
    ORACLES[_name] = f"SELECT {_digest} FROM ({VIEWS['banking']}) v"
ORACLES["signature_rules"] = "SELECT true AS one_each, true AS named_and_sized, true AS dated, true AS repeatable"
ORACLES["packed_loads"] = f"""
    SELECT {_digest}, 8::BIGINT AS loads_packed, 1::BIGINT AS files, true AS same_rows FROM ({VIEWS['banking']}) v"""
ORACLES["stream_line_breaks"] = f"""SELECT {_digest} FROM (
    SELECT * REPLACE ('Flat "1",' || chr(10) || address AS address) FROM ({VIEWS['banking']}) v)"""
ORACLES["ingest_faults"] = f"""SELECT 1::BIGINT AS left_out, 1::BIGINT AS files_failed, count(*) AS rows,
    0::BIGINT AS emails, count(*) AS balances FROM ({VIEWS['banking']}) v"""

__all__ = ["ORACLES", "clean_ctes", "raw_cte", "star_ctes"]
