"""Registered queries against their SQL. RECORDLOOM_FULL=1 runs all of them."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from check_oracle import compare, connect
from recordloom.suite import QUERIES

SF = "/root/testdata/sf0.001"
QUICK = (
    "csv_scan", "route_source", "clean_names", "soft_string_null", "parse_locations", "parse_mixed_dates", "fuzzy_label",
    "quarantine", "row_hashdiff", "union_align", "dedup_nested_key", "upsert_merge", "rollback", "change_feed", "latest_run",
    "weighted_sample", "audit_rules", "candidate_pairs_sliced", "match_scores", "gold_records", "running_sample",
)
NAMES = [n for n, q in QUERIES.items() if q.sql] if os.environ.get("RECORDLOOM_FULL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name].run(spark, SF), con, QUERIES[name].sql) is None


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns[:2] == ["anchor_entity_id", "anchor_data_source"]


def test_normal_form_finds_the_spelt_out_runs_by_the_named_class(spark):
    from recordloom.suite import corpus

    values = [None, "", " ", "a b", " a  b ", "a -b", "\ta\n\nb c", "\u00e4\u00f6 x", "x \U0001f600 y\U0001f600z", "--", "a b  c - d, e_f.", "a \u00a0b\u0660\u0131\uff21", "AZaz09@[`{/:"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", F.regexp_replace("v", corpus._RUNS, " ").alias("runs"), corpus._normal(F.col("v")).alias("n")).collect()
    spelt = {v: None if v is None else re.sub("[^A-Za-z0-9]+", " ", v) for v in values}
    assert {r["v"]: r["runs"] for r in got} == spelt
    assert {r["v"]: r["n"] for r in got} == {v: x and x.strip().upper() or None for v, x in spelt.items()}
