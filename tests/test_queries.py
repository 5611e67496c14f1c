"""Registered queries against their SQL, and the shape of their plans."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from tools.check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

CHECKED = (
    "clean_name", "clean_phone", "clean_date", "clean_location", "comparable_values", "silver_banking",
    "classified_education", "silver_run_stats", "classified_second_batch", "row_signature",
    "banking_fact_account", "medical_fact_admission", "surrogate_keys", "join_null_safe", "calendar",
    "column_samples", "sample_features", "profile_columns", "rule_classify_columns", "pii_inventory",
    "secure_view_analyst", "text_redact_documents", "stratified_split", "overall_metrics", "bronze_ingest",
    "stream_audit",
)
LAZY = (
    "silver_banking", "silver_medical", "classified_marketing", "silver_run_stats", "education_dim_student",
    "education_fact_enrollment", "duplicate_groups", "profile_columns", "text_summary_documents", "audit_daily",
    "stratified_split", "surrogate_keys", "secure_view_analyst",
)


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_same_as_sql(spark, duck, name):
    outcome = compare(spark, duck, FOLDER, name, queries()[name], oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


@pytest.mark.parametrize("name", LAZY)
def test_plan_stays_in_the_engine(spark, name):
    text = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Cartesian", "BroadcastNestedLoop"):
        assert bad not in text
    assert "BatchScan" in text or "FileScan" in text


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
