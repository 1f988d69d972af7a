"""Sampling, distributions and data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions.text import empty_to_null, strip
from recordloom.operators import audit, sampling
from recordloom.sources.readers import keep_keys
from recordloom.suite.base import query, table

# Sample weights per event type.
WEIGHTS = {"error": 5.0, "purchase": 2.0, "signup": 0.5, "view": 0.0}
_WEIGHT_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items()) + " ELSE 1.0 END::DOUBLE"
_U_SQL = "((('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT)::DOUBLE + 0.5) / 4294967296.0"
_SAMPLE_SQL = f"""
    SELECT event_id, event_type, user_id, pow({_U_SQL}, 1.0 / ({_WEIGHT_SQL})) AS sample_score FROM events
    WHERE {_WEIGHT_SQL} > 0 ORDER BY sample_score DESC, event_id LIMIT 1000
"""


def _sample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return sampling.weighted_sample(events, "event_type", WEIGHTS, key=F.col("event_id"))


@query("weighted_sample", f"SELECT event_id, event_type, user_id, round(sample_score, 9) AS sample_score FROM ({_SAMPLE_SQL})")
def weighted_sample(spark, sf_dir):
    return _sample(spark, sf_dir).withColumn("sample_score", F.round("sample_score", 9))


@query("raw_distribution", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def raw_distribution(spark, sf_dir):
    return sampling.raw_distribution(table(spark, sf_dir, "events"), "event_type")


@query("sample_distribution", f"SELECT event_type AS value, count(*) AS n FROM ({_SAMPLE_SQL}) GROUP BY 1")
def sample_distribution(spark, sf_dir):
    return sampling.sample_distribution(_sample(spark, sf_dir), "event_type")


@query(
    "sample_accounting",
    f"""SELECT (SELECT count(*) FROM ({_SAMPLE_SQL})) AS sampled_rows, (SELECT count(*) FROM events WHERE {_WEIGHT_SQL} > 0) AS raw_rows""",
)
def sample_accounting(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return sampling.sample_accounting(events, _sample(spark, sf_dir), "event_type", WEIGHTS)


@query(
    "key_semi_join",
    f"SELECT user_id, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM ({_SAMPLE_SQL})) GROUP BY 1",
)
def key_semi_join(spark, sf_dir):
    """Every event of the users drawn into the sample."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    rows = keep_keys(events, _sample(spark, sf_dir).select("user_id"), "user_id")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def _audited(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    quality = table(spark, sf_dir, "labels").select("doc_id", "quality")
    title = empty_to_null(strip(F.substring_index("text", "\n", 1)))
    return docs.join(quality, "doc_id", "left").select(
        F.col("doc_id").alias("entity_id"),
        F.when(F.col("quality") == 1, F.col("n_chars")).alias("vendor_id"),
        title.alias("company_name"), F.upper("source").alias("address_1"), F.col("n_chars").cast("string").alias("postal_code"),
        F.when(F.col("quality").isNotNull(), F.col("lang")).alias("city"),
    )


_AUDIT_SQL = r"""
    WITH a AS (SELECT doc_id AS entity_id, CASE WHEN quality = 1 THEN n_chars END AS vendor_id,
                      nullif(regexp_replace(split_part(text, chr(10), 1), '^\s+|\s+$', '', 'g'), '') AS company_name,
                      upper(source) AS address_1, CAST(n_chars AS VARCHAR) AS postal_code, CASE WHEN quality IS NOT NULL THEN lang END AS city
               FROM documents LEFT JOIN labels USING (doc_id)),
    u AS (SELECT 'entity_id' AS c, CAST(entity_id AS VARCHAR) AS v FROM a UNION ALL SELECT 'vendor_id', CAST(vendor_id AS VARCHAR) FROM a
          UNION ALL SELECT 'company_name', company_name FROM a),
    uc AS (SELECT c, v, count(*) AS n FROM u WHERE v IS NOT NULL GROUP BY 1, 2),
    us AS (SELECT c, coalesce(sum(n) FILTER (n = 1), 0)::BIGINT AS good, sum(n)::BIGINT AS seen FROM uc GROUP BY 1),
    r AS (
      SELECT c AS "column", 'unique' AS rule, 0.95::DOUBLE AS mostly, 'warning' AS severity, good, seen FROM us WHERE c IN ('entity_id', 'vendor_id')
      UNION ALL SELECT c, 'unique', 0.7, 'warning', good, seen FROM us WHERE c = 'company_name'
      UNION ALL SELECT c, 'unique', 1.0, 'critical', good, seen FROM us WHERE c = 'entity_id'
      UNION ALL SELECT 'company_name', 'not_null', 1.0, 'critical', count(company_name), count(*) FROM a
      UNION ALL SELECT 'address_1', 'not_null', 0.3, 'warning', count(address_1), count(*) FROM a
      UNION ALL SELECT 'city', 'not_null', 0.7, 'warning', count(city), count(*) FROM a
      UNION ALL SELECT 'postal_code', 'length_between', 0.8, 'warning', count(*) FILTER (length(postal_code) BETWEEN 3 AND 12), count(postal_code) FROM a
      UNION ALL SELECT 'address_1', 'length_equals', 0.5, 'info', count(*) FILTER (length(address_1) = 5), count(address_1) FROM a),
    res AS (SELECT *, CASE WHEN seen = 0 THEN 1.0 ELSE good / seen END AS observed FROM r)
"""


def _audit_results(spark, sf_dir):
    rows = _audited(spark, sf_dir)
    extra = [audit.RuleSet(("address_*",), (audit.AuditRule("length_equals", 0.5, "info", 5),))]
    rules = audit.bind(rows.columns, audit.rules_for("business_entity_registry", extra))
    return audit.audit(rows, rules)


@query("audit_rules", f'{_AUDIT_SQL} SELECT "column", rule, mostly, severity, good, seen, round(observed, 9) AS observed, observed >= mostly AS success FROM res')
def audit_rules(spark, sf_dir):
    return _audit_results(spark, sf_dir).withColumn("observed", F.round("observed", 9))


@query(
    "audit_verdict",
    f"""{_AUDIT_SQL}, f AS (SELECT count(*) FILTER (observed < mostly AND severity = 'critical') AS critical_failures,
        count(*) FILTER (observed < mostly AND severity = 'warning') AS warning_failures,
        count(*) FILTER (observed < mostly AND severity = 'info') AS info_failures FROM res)
    SELECT *, CASE WHEN critical_failures > 0 THEN 'failed' WHEN warning_failures > 0 THEN 'passed_with_warnings'
        WHEN info_failures > 0 THEN 'passed_with_info' ELSE 'passed' END AS outcome, critical_failures = 0 AS passed FROM f""",
)
def audit_verdict(spark, sf_dir):
    return audit.verdict(_audit_results(spark, sf_dir))
