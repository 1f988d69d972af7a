"""Scans, sinks and routing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.keys import with_load_metadata
from recordloom.sources import readers, writers
from recordloom.specs import route
from recordloom.suite.base import query, scratch, table

CSV_COLUMNS = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


_CSV_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '"' || c_name || '", ' || c_mktsegment AS c_name,
           CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer
    """


def _read_back(spark, sf_dir, multi_line):
    """Write customers as CSV with quotes and commas inside values, read them back as strings."""
    path = scratch(spark, "csv")
    out = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit('"'), "c_name", F.lit('", '), "c_mktsegment").alias("c_name"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    out.write.option("header", True).option("escape", '"').csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])
    return readers.read_csv(spark, path, schema, multi_line).select(*CSV_COLUMNS)


@query("csv_scan", _CSV_SQL)
def csv_scan(spark, sf_dir):
    return _read_back(spark, sf_dir, True)


@query("csv_scan_split", _CSV_SQL)
def csv_scan_split(spark, sf_dir):
    """The same files, found to hold no value over several lines and read in splits."""
    return _read_back(spark, sf_dir, None)


@query("column_subset", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def column_subset(spark, sf_dir):
    return readers.select_existing(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "no_such"])


@query(
    "partitioned_table_read",
    """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment
    FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def partitioned_table_read(spark, sf_dir):
    """A table partitioned by a nullable column: the sentinel goes in on write and out on read."""
    path = scratch(spark, "partitioned")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    )
    loaded = with_load_metadata(rows, ["c_custkey"], "segment")
    writers.write_table(loaded, path, "segment")
    keys = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select("o_custkey")
    return readers.read_table(
        readers.read_parquet(spark, path, loaded.schema), ["c_custkey", "c_name", "segment"], keys, "c_custkey", partition_key="segment"
    )


@query(
    "table_overwrite",
    "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier",
)
def table_overwrite(spark, sf_dir):
    """Replacing a table replaces its schema as well."""
    path = scratch(spark, "overwritten")
    writers.overwrite_table(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path, "c_mktsegment")
    fresh = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    writers.overwrite_table(fresh, path, "nation")
    return readers.read_parquet(spark, path, fresh.schema)


@query(
    "skip_loaded",
    "SELECT o_orderkey AS path FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def skip_loaded(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"))
    return readers.not_loaded(files, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path")))


# Routing patterns in order of precedence.
ROUTES = (
    ("business_entity_registry", "business_entity_registry"),
    ("licenses_registry", "licenses_registry"),
    ("sub_contractors_registry", "sub_contractors_registry"),
    ("((deduplicated|integrated)_records).*", "integrated_entity"),
    ("(gold_records).*", "gold_business_entity"),
)
_FOLDERS = {
    "BUILDING": "bronze/Business_Entity_Registry/",
    "MACHINERY": "bronze/licenses_registry/",
    "HOUSEHOLD": "silver/SUB_CONTRACTORS_registry/",
    "FURNITURE": "integrated/deduplicated_records/",
}
_FOLDER_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _FOLDERS.items()) + " ELSE 'other/' END"


@query(
    "route_source",
    f"""
    WITH p AS (SELECT {_FOLDER_SQL} || c_name || '.csv' AS path FROM customer
               UNION ALL SELECT 'gold/gold_records/' || s_name AS path FROM supplier)
    SELECT path, CASE {' '.join(f"WHEN regexp_matches(path, '{p}', 'i') THEN '{n}'" for p, n in ROUTES)} END AS source
    FROM p
    """,
)
def route_source(spark, sf_dir):
    folder = F.lit("other/")
    for segment, name in _FOLDERS.items():
        folder = F.when(F.col("c_mktsegment") == segment, name).otherwise(folder)
    paths = (
        table(spark, sf_dir, "customer").select(F.concat(folder, "c_name", F.lit(".csv")).alias("path"))
        .unionAll(table(spark, sf_dir, "supplier").select(F.concat(F.lit("gold/gold_records/"), "s_name").alias("path")))
    )
    return paths.select("path", route(F.col("path"), ROUTES).alias("source"))
