"""Raw, faulty records of the four domains, derived from the given tables.

The SQL means the same in Spark and in DuckDB.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


AS_OF = dt.date(2026, 1, 1)

BANKING = """
SELECT c_custkey AS _bronze_id,
 CASE WHEN c_custkey % 97 = 5 THEN concat('X', CAST(c_custkey AS STRING))
      WHEN c_custkey % 41 = 7 THEN CAST(c_custkey - 1 AS STRING)
      WHEN c_custkey % 13 = 3 THEN concat(' ', CAST(c_custkey AS STRING), '.0 ')
      ELSE CAST(c_custkey AS STRING) END AS customer_id,
 CASE WHEN c_custkey % 53 = 9 THEN '' WHEN c_custkey % 59 = 4 THEN 'N4me'
      ELSE concat('  Ann ', lower(c_mktsegment), ' ') END AS first_name,
 CASE WHEN c_custkey % 23 = 1 THEN 'O''Neil-Smith' ELSE concat('Nation  ', CAST(c_nationkey AS STRING)) END AS last_name,
 CASE WHEN c_custkey % 11 = 2 THEN 'bad.example.com'
      ELSE concat('USER', CAST(c_custkey AS STRING), '@Example.com') END AS email,
 CASE c_custkey % 6 WHEN 0 THEN CAST(7000000000 + c_custkey AS STRING)
      WHEN 1 THEN concat('+91 ', CAST(8000000000 + c_custkey AS STRING))
      WHEN 2 THEN concat('0', CAST(9000000000 + c_custkey AS STRING))
      WHEN 3 THEN '98765ABC10' WHEN 4 THEN '' ELSE CAST(1000000000 + c_custkey AS STRING) END AS phone,
 CASE c_custkey % 8 WHEN 0 THEN '31/02/1998' WHEN 1 THEN '1/2/2001' WHEN 2 THEN '2099-12-01'
      WHEN 3 THEN '15-08-69' WHEN 4 THEN '15.08.68' WHEN 5 THEN '25/13/1997'
      WHEN 6 THEN '' ELSE '1990-07-04' END AS date_of_birth,
 CASE c_custkey % 7 WHEN 3 THEN '' WHEN 5 THEN 'no number'
      ELSE concat('ACCT', CAST(100000 + c_custkey - c_custkey % 3 AS STRING)) END AS account_number,
 CASE c_custkey % 5 WHEN 0 THEN 'savings' WHEN 1 THEN ' CURRENT ' WHEN 2 THEN 'VIP'
      WHEN 3 THEN 'Salary' ELSE 'FIXED_DEPOSIT' END AS account_type,
 CASE WHEN c_custkey % 17 = 1 THEN 'abc' WHEN c_custkey % 5 = 0 THEN '₹45,000'
      ELSE concat(' ', CAST(c_custkey % 1000 - 100 AS STRING), '.25 ') END AS balance,
 CASE c_custkey % 4 WHEN 0 THEN '12  MG Road, New Delhi' WHEN 1 THEN '7 Brigade Road, BENGALURU'
      WHEN 2 THEN 'Nowhere' ELSE '' END AS address
FROM customer
"""

EDUCATION = """
SELECT o_orderkey AS _bronze_id,
 CASE WHEN o_orderkey % 89 = 3 THEN '' WHEN o_orderkey % 37 = 5 THEN CAST(o_orderkey - 1 AS STRING)
      WHEN o_orderkey % 43 = 2 THEN concat(CAST(o_orderkey AS STRING), '.5')
      ELSE CAST(o_orderkey AS STRING) END AS student_id,
 CASE WHEN o_orderkey % 71 = 6 THEN '  ' ELSE concat('Student ', lower(o_orderstatus)) END AS first_name,
 CASE WHEN o_orderkey % 29 = 8 THEN 'Mary   Jane' ELSE 'Sen' END AS last_name,
 CASE WHEN o_orderkey % 13 = 2 THEN 'a@b' ELSE concat('s', CAST(o_orderkey AS STRING), '@uni.example.org') END AS email,
 CASE o_orderkey % 3 WHEN 0 THEN CAST(9000000000 + o_orderkey AS STRING)
      WHEN 1 THEN concat('(91) ', CAST(6000000000 + o_orderkey AS STRING)) ELSE '12345' END AS phone,
 CASE o_orderkey % 5 WHEN 0 THEN '2001-2-3' WHEN 1 THEN '03.04.1999' WHEN 2 THEN '30/02/2000'
      WHEN 3 THEN '2150-01-01' ELSE '9-9-04' END AS date_of_birth,
 CASE o_orderkey % 6 WHEN 0 THEN '5 Park Street, Kolkata' WHEN 1 THEN 'Sector 17, chandigarh'
      WHEN 2 THEN 'Noida / New Delhi' WHEN 3 THEN '' WHEN 4 THEN 'Pune' ELSE '1 Civil Lines' END AS address,
 concat(' Course  ', o_orderpriority) AS course,
 CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE concat('Dept ', CAST(o_custkey % 40 AS STRING)) END AS department,
 CASE WHEN o_orderkey % 17 = 4 THEN '32/06/2025' WHEN o_orderkey % 31 = 4 THEN '01/01/2090'
      ELSE concat(CAST(extract(day FROM o_orderdate) AS STRING), '/', CAST(extract(month FROM o_orderdate) AS STRING),
                  '/', CAST(extract(year FROM o_orderdate) AS STRING)) END AS enrollment_date,
 CASE o_orderkey % 6 WHEN 0 THEN '105' WHEN 1 THEN 'N/A' WHEN 2 THEN '-10'
      WHEN 3 THEN concat(CAST(o_orderkey % 101 AS STRING), ' %%') ELSE concat(CAST(o_orderkey % 100 AS STRING), '.5') END AS percentage
FROM orders
"""

MEDICAL = """
SELECT o_orderkey AS _bronze_id,
 CASE WHEN o_orderkey % 83 = 3 THEN 'P-1' WHEN o_orderkey % 47 = 5 THEN '77' ELSE CAST(o_orderkey + 9000 AS STRING) END AS patient_id,
 CASE WHEN o_orderkey % 67 = 6 THEN '???' ELSE concat('Pat. ', o_orderstatus) END AS first_name,
 'Iyer' AS last_name,
 concat('p', CAST(o_custkey AS STRING), '@Med.Example.com') AS email,
 CAST(6000000000 + o_custkey AS STRING) AS phone,
 CASE o_orderkey % 4 WHEN 0 THEN '01/06/1998' WHEN 1 THEN '1970-12-31' WHEN 2 THEN '05/05/2120' ELSE '' END AS date_of_birth,
 CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN concat(CAST(o_custkey % 90 AS STRING), ' Hill Road, Mumbai')
      ELSE 'Ranchi' END AS address,
 CASE o_orderkey % 6 WHEN 0 THEN 'a+' WHEN 1 THEN ' O- ' WHEN 2 THEN 'Z+' WHEN 3 THEN 'AB-' WHEN 4 THEN '' ELSE 'B+' END AS blood_group,
 concat('Diagnosis ', CAST(o_custkey % 25 AS STRING)) AS diagnosis,
 CASE WHEN o_orderkey % 9 = 1 THEN '12345' WHEN o_orderkey % 9 = 2 THEN '' ELSE concat('Dr. ', substr(o_orderpriority, 3), CASE WHEN o_custkey % 4 = 0 THEN ' Rao' ELSE ' Sen' END) END AS doctor_name,
 concat(CAST(extract(year FROM o_orderdate) AS STRING), '-', CAST(extract(month FROM o_orderdate) AS STRING), '-',
        CAST(extract(day FROM o_orderdate) AS STRING)) AS admission_date,
 CASE WHEN o_orderkey % 15 = 0 THEN '-' ELSE concat('MRN-', CAST(o_orderkey AS STRING)) END AS medical_record_number
FROM orders
"""

MARKETING = """
SELECT event_id AS _bronze_id,
 CASE WHEN event_id % 79 = 1 THEN NULL WHEN event_id % 19 = 3 THEN '5000' ELSE CAST(event_id + 5000 AS STRING) END AS customer_id,
 CASE WHEN event_id % 61 = 6 THEN '' ELSE concat('Visitor ', event_type) END AS first_name,
 CASE WHEN event_id % 2 = 0 THEN 'Rao' ELSE '' END AS last_name,
 concat('u', CAST(user_id AS STRING), '@shop.example.net') AS email,
 concat('+91-', CAST(7000000000 + user_id AS STRING)) AS phone,
 CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat(CAST(user_id AS STRING), ' Lake Road, KOLKATA') ELSE 'Gurugram' END AS address,
 CASE event_id % 7 WHEN 0 THEN '-5' WHEN 1 THEN '200' WHEN 2 THEN 'thirty' WHEN 3 THEN '' WHEN 4 THEN '120' ELSE CAST(user_id % 100 AS STRING) END AS age,
 CASE event_id % 4 WHEN 0 THEN 'male' WHEN 1 THEN ' Female' WHEN 2 THEN 'UNKNOWN' ELSE 'OTHER' END AS gender,
 concat('Campaign ', event_type) AS campaign_name,
 CASE WHEN event_id % 10 = 9 THEN '32/06/2025'
      ELSE concat(CAST(extract(day FROM ts) AS STRING), '-', CAST(extract(month FROM ts) AS STRING), '-', CAST(extract(year FROM ts) AS STRING)) END AS campaign_date,
 CASE event_type WHEN 'click' THEN 'email' WHEN 'view' THEN 'Social' WHEN 'purchase' THEN 'SEARCH' WHEN 'error' THEN 'FAX' ELSE ' sms ' END AS channel
FROM events
"""

VIEWS = {"banking": BANKING, "education": EDUCATION, "medical": MEDICAL, "marketing": MARKETING}
SOURCES = {"banking": "customer", "education": "orders", "medical": "orders", "marketing": "events"}

# Accesses to protected resources, one per event.
AUDIT = """
SELECT event_id, ts, user_id,
 CASE user_id % 3 WHEN 0 THEN 'Administrator' WHEN 1 THEN 'Analyst' ELSE 'Visitor' END AS role,
 CASE event_type WHEN 'signup' THEN 'star_banking.dim_customer' WHEN 'view' THEN 'star_medical.dim_patient'
      ELSE 'gold.fact_pii_scan' END AS resource,
 CASE event_type WHEN 'click' THEN 'EXPORT' ELSE 'READ' END AS action,
 CASE WHEN user_id % 3 = 2 OR event_type = 'error' THEN 'DENIED' ELSE 'GRANTED' END AS result
FROM events
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_domain(spark: SparkSession, folder: str, domain: str) -> DataFrame:
    source = SOURCES[domain]
    rows = table(spark, folder, source)
    return spark.sql(VIEWS[domain].replace(f"FROM {source}\n", "FROM {src}\n"), src=rows)


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(AUDIT.replace("FROM events\n", "FROM {src}\n"), src=table(spark, folder, "events"))
