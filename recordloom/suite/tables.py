"""Deduplication, history and run metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions.keys import with_load_metadata
from recordloom.operators import dedup, history, runs
from recordloom.settings import LOAD_TS
from recordloom.suite.base import query, table

_RANKED_ORDERS_SQL = """
    SELECT o_custkey, o_orderkey, o_orderstatus = 'F' AS is_active, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
           CASE WHEN o_totalprice > 100000 THEN o_orderdate END AS placed FROM orders
"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", (F.col("o_orderstatus") == "F").alias("is_active"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderdate")).alias("placed"),
    )


@query(
    "dedup_ranked_active",
    f"""
    SELECT * FROM ({_RANKED_ORDERS_SQL})
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY is_active DESC,
        2 + (is_active IS NOT NULL)::INT + (priority IS NOT NULL)::INT + (placed IS NOT NULL)::INT DESC, o_orderkey) = 1
    """,
)
def dedup_ranked_active(spark, sf_dir):
    return dedup.dedup_ranked(_orders(spark, sf_dir), ["o_custkey"], [F.col("o_orderkey")])


@query(
    "dedup_nested_key",
    """
    SELECT l_partkey AS entity_id, l_returnflag AS data_source, l_orderkey, l_linenumber, l_quantity AS global_score
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_returnflag
        ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_extendedprice) = 1
    """,
)
def dedup_nested_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_partkey").alias("entity_id"), F.col("l_returnflag").alias("data_source")).alias("anchor_entity"),
        "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").alias("global_score"),
    )
    kept = dedup.dedup_integrated(rows, ties=[F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")])
    return kept.select("anchor_entity.*", "l_orderkey", "l_linenumber", "global_score")


@query(
    "dedup_counts",
    """
    SELECT count(*) AS initial_count, count(DISTINCT o_custkey) AS deduplicated_count FROM orders
    """,
)
def dedup_counts(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return dedup.dedup_counts(rows, dedup.dedup_ranked(rows, ["o_custkey"], [F.col("o_orderkey")]))


@query(
    "fill_counts",
    f"""
    SELECT o_orderkey, CAST(2 + (is_active IS NOT NULL)::INT + (priority IS NOT NULL)::INT + (placed IS NOT NULL)::INT AS INTEGER) AS fill_count
    FROM ({_RANKED_ORDERS_SQL})
    """,
)
def fill_counts(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return rows.select("o_orderkey", dedup.fill_count(rows).alias("fill_count"))


# --- history: version 1 is the customer table; version 2 raises the balance of one segment,
# leaves the rest as it is and adds the suppliers; version 3 restores version 1.

_V1 = """v1 AS (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS party_id, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
        coalesce(CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END, 'UNKNOWN') AS segment FROM customer)"""
_V2 = """v2 AS (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS party_id, c_name AS name,
        CAST(CAST(c_acctbal AS DECIMAL(12,2)) + CASE WHEN c_mktsegment = 'BUILDING' THEN 10 ELSE 0 END AS VARCHAR) AS balance,
        coalesce(CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END, 'UNKNOWN') AS segment FROM customer
    UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR), 'SUPPLIER' FROM supplier)"""
_HISTORY = f"""WITH {_V1}, {_V2},
    h2 AS (SELECT v1.*, 1::BIGINT AS valid_from, CASE WHEN v1.balance <> v2.balance THEN 2::BIGINT END AS valid_to FROM v1 JOIN v2 USING (party_id)
        UNION ALL SELECT v2.*, 2::BIGINT, NULL FROM v2 LEFT JOIN v1 USING (party_id) WHERE v1.party_id IS NULL OR v1.balance <> v2.balance)"""
_COLUMNS = ("party_id", "name", "balance", "segment")


def _version_1(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("party_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("balance"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segment"),
    )
    return with_load_metadata(rows, ["party_id"], "segment")


def _version_2(spark, sf_dir):
    raised = F.col("c_acctbal").cast("decimal(12,2)") + F.when(F.col("c_mktsegment") == "BUILDING", 10).otherwise(0)
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("party_id"), F.col("c_name").alias("name"),
        raised.cast("decimal(12,2)").cast("string").alias("balance"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("party_id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("decimal(12,2)").cast("string").alias("balance"), F.lit("SUPPLIER").alias("segment"),
    )
    return with_load_metadata(customers.unionByName(suppliers), ["party_id"], "segment")


def _history_2(spark, sf_dir):
    first = history.initialise(_version_1(spark, sf_dir), 1)
    return history.upsert(first, _version_2(spark, sf_dir), ["party_id"], 2)


@query("upsert_merge", f"{_HISTORY} SELECT * FROM h2")
def upsert_merge(spark, sf_dir):
    return _history_2(spark, sf_dir).select(*_COLUMNS, "valid_from", "valid_to")


@query("upsert_idempotent", f"{_HISTORY} SELECT * FROM h2")
def upsert_idempotent(spark, sf_dir):
    """The same batch once more as version 3 changes no row."""
    again = history.upsert(_history_2(spark, sf_dir), _version_2(spark, sf_dir), ["party_id"], 3)
    return again.select(*_COLUMNS, "valid_from", "valid_to")


@query(
    "upsert_by_partition",
    f"""WITH {_V1}, moved AS (SELECT party_id, name, balance, 'MOVED' AS segment FROM v1 WHERE segment = 'BUILDING')
    SELECT *, 1::BIGINT AS valid_from, NULL::BIGINT AS valid_to FROM v1 UNION ALL SELECT *, 2, NULL FROM moved""",
)
def upsert_by_partition(spark, sf_dir):
    """With the partition column in the match key a changed partition inserts a second row."""
    first = history.initialise(_version_1(spark, sf_dir), 1)
    moved = _version_1(spark, sf_dir).where("segment = 'BUILDING'").withColumn("segment", F.lit("MOVED"))
    out = history.upsert(first, moved, ["party_id"], 2, partition_key="segment")
    return out.select(*_COLUMNS, "valid_from", "valid_to")


@query(
    "change_feed",
    f"""WITH {_V1}, {_V2}
    SELECT 'insert' AS change_type, v2.* FROM v2 WHERE party_id NOT IN (SELECT party_id FROM v1)
    UNION ALL SELECT 'update_preimage', v1.* FROM v1 JOIN v2 USING (party_id) WHERE v1.balance <> v2.balance
    UNION ALL SELECT 'update_postimage', v2.* FROM v1 JOIN v2 USING (party_id) WHERE v1.balance <> v2.balance""",
)
def change_feed(spark, sf_dir):
    feed = history.change_feed(_version_1(spark, sf_dir), _version_2(spark, sf_dir), ["party_id"])
    return feed.select("change_type", *_COLUMNS)


@query(
    "change_feed_deletes",
    f"""WITH {_V1}, {_V2}
    SELECT 'delete' AS change_type, v2.* FROM v2 WHERE party_id NOT IN (SELECT party_id FROM v1)
    UNION ALL SELECT 'update_preimage', v2.* FROM v1 JOIN v2 USING (party_id) WHERE v1.balance <> v2.balance
    UNION ALL SELECT 'update_postimage', v1.* FROM v1 JOIN v2 USING (party_id) WHERE v1.balance <> v2.balance""",
)
def change_feed_deletes(spark, sf_dir):
    feed = history.change_feed(_version_2(spark, sf_dir), _version_1(spark, sf_dir), ["party_id"])
    return feed.select("change_type", *_COLUMNS)


@query(
    "history_feed",
    f"""{_HISTORY}
    SELECT 2::BIGINT AS commit_version, CASE WHEN valid_to = 2 THEN 'update_preimage'
           WHEN party_id IN (SELECT party_id FROM v1) THEN 'update_postimage' ELSE 'insert' END AS change_type, party_id, balance
    FROM h2 WHERE valid_from = 2 OR valid_to = 2""",
)
def history_feed(spark, sf_dir):
    feed = history.history_feed(_history_2(spark, sf_dir), ["party_id"], since=1)
    return feed.select("commit_version", "change_type", "party_id", "balance")


@query("as_of", f"WITH {_V1} SELECT * FROM v1")
def as_of(spark, sf_dir):
    return history.as_of(_history_2(spark, sf_dir), 1).select(*_COLUMNS)


@query("current_rows", f"WITH {_V2} SELECT * FROM v2")
def current_rows(spark, sf_dir):
    return history.current(_history_2(spark, sf_dir)).select(*_COLUMNS)


@query(
    "rollback",
    f"""{_HISTORY}
    SELECT party_id, name, balance, segment, valid_from,
           coalesce(valid_to, CASE WHEN valid_from = 2 THEN 3::BIGINT END) AS valid_to FROM h2
    UNION ALL SELECT party_id, name, balance, segment, 3, NULL FROM h2 WHERE valid_to = 2""",
)
def rollback(spark, sf_dir):
    out = history.rollback(_history_2(spark, sf_dir), 1, ["party_id"], 3)
    return out.select(*_COLUMNS, "valid_from", "valid_to")


@query("current_version", "SELECT CASE WHEN count(*) > 0 THEN 2::BIGINT ELSE 0 END AS version FROM customer")
def current_version(spark, sf_dir):
    return history.current_version(_history_2(spark, sf_dir))


@query("load_timestamp", "SELECT count(*) AS n_rows, 1::BIGINT AS n_instants FROM customer")
def load_timestamp(spark, sf_dir):
    """One instant for the whole batch."""
    return _version_1(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(LOAD_TS).alias("n_instants"))


@query(
    "latest_run",
    """
    WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, min(event_id) AS run_id, max(ts) AS "timestamp",
                      string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS table_group, count(*) AS n_events FROM events GROUP BY 1, 2)
    SELECT table_group, run_id, "timestamp", n_events FROM r
    QUALIFY row_number() OVER (PARTITION BY table_group ORDER BY "timestamp" DESC, run_id) = 1
    """,
)
def latest_run(spark, sf_dir):
    """A user's day is a run over the event types seen that day."""
    made = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("event_id").alias("run_id"), F.max("ts").alias("timestamp"), F.collect_set("event_type").alias("table_names"),
        F.count(F.lit(1)).alias("n_events"),
    )
    made = made.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = runs.latest_runs(made).select("table_group", "run_id", "timestamp", "n_events")
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
