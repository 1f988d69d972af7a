"""Column cleaning, lookups and validation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import dates, lookup, text
from recordloom.functions.abbreviations import abbreviation_table, expand_abbreviations
from recordloom.functions.address import parse_location
from recordloom.functions.keys import composite_key, hash_diff
from recordloom.operators import align, validate
from recordloom.specs import Reject, SourceSpec
from recordloom.suite.base import query, table

_PUNCT = r"[!-/:-@\[-`{-~]"


def _sql_norm_id(x: str) -> str:
    return f"nullif(trim(upper(regexp_replace({x}, '{_PUNCT}', '', 'g'))), '')"


@query(
    "clean_ids",
    f"""
    SELECT c_custkey, {_sql_norm_id("'  ' || c_name || '-' || CAST(c_nationkey AS VARCHAR) || ' '")} AS clean_id,
           {_sql_norm_id("CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 1000 THEN '--' ELSE c_mktsegment END")} AS maybe_id
    FROM customer
    """,
)
def clean_ids(spark, sf_dir):
    raw = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") < 1000, "--").otherwise(F.col("c_mktsegment"))
    padded = F.concat(F.lit("  "), "c_name", F.lit("-"), F.col("c_nationkey").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.normalize_id(padded).alias("clean_id"), text.normalize_id(text.empty_to_null(raw)).alias("maybe_id")
    )


_FORMS = {"ECONOMY": " Inc.", "SMALL": ", L.L.C.", "LARGE": " & Sons Co. Ltd", "STANDARD": " Corp", "MEDIUM": " Incwell"}
_RAW_NAME_SQL = (
    "'\t' || p_name || CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _FORMS.items()) + " ELSE '' END || ' '"
)


def _raw_names(spark, sf_dir):
    form = F.lit("")
    for kind, suffix in _FORMS.items():
        form = F.when(F.col("p_type") == kind, suffix).otherwise(form)
    return table(spark, sf_dir, "part").withColumn("raw", F.concat(F.lit("\t"), "p_name", form, F.lit(" ")))


_STRIP = r"'^\s+|\s+$', '', 'g'"


@query(
    "clean_names",
    f"""
    WITH n AS (SELECT p_partkey, {_RAW_NAME_SQL} AS raw FROM part)
    SELECT p_partkey, regexp_replace(raw, {_STRIP}) AS company_name,
           trim(upper(regexp_replace(regexp_replace(regexp_replace(raw, {_STRIP}), '{text.LEGAL_SUFFIX}', ''),
                '{_PUNCT}', '', 'g'))) AS company_name_normalized
    FROM n
    """,
)
def clean_names(spark, sf_dir):
    return _raw_names(spark, sf_dir).select(
        "p_partkey", text.strip(F.col("raw")).alias("company_name"),
        text.normalize_company_name(F.col("raw")).alias("company_name_normalized"),
    )


@query(
    "soft_string_null",
    f"""
    SELECT doc_id, regexp_full_match(text, '[0-9!-/:-@\\[-`{{-~\\s]+') AS text_is_junk,
           CASE WHEN regexp_full_match(CAST(n_chars AS VARCHAR) || ' -', '[0-9!-/:-@\\[-`{{-~\\s]+') THEN NULL ELSE 'x' END AS soft_number,
           CASE WHEN length(source) >= 5 THEN source END AS long_source
    FROM documents
    """,
)
def soft_string_null(spark, sf_dir):
    number = F.concat(F.col("n_chars").cast("string"), F.lit(" -"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.soft_string(F.col("text")).isNull().alias("text_is_junk"),
        F.when(text.soft_string(number).isNotNull(), "x").alias("soft_number"),
        text.min_length(F.col("source"), 5).alias("long_source"),
    )


_STREETS = {"ECONOMY": "Rd.", "SMALL": "BLVD,", "LARGE": "ste #4", "STANDARD": "Pkwy", "MEDIUM": "Apt#9"}
_ADDRESS_SQL = (
    "CAST(p_size AS VARCHAR) || '  ' || p_name || ' ' || CASE p_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STREETS.items()) + " ELSE 'NE St' END"
)
_TERMS_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in abbreviation_table().items()) + "}"


@query(
    "expand_abbrev",
    rf"""
    SELECT p_partkey, array_to_string(list_transform(string_split_regex({_ADDRESS_SQL}, '\s+'), lambda t:
             coalesce({_TERMS_SQL}[upper(regexp_extract(t, '^[^,.\s#]+'))] || substr(t, length(regexp_extract(t, '^[^,.\s#]+')) + 1), t)
           ), ' ') AS address
    FROM part
    """,
)
def expand_abbrev(spark, sf_dir):
    street = F.lit("NE St")
    for kind, word in _STREETS.items():
        street = F.when(F.col("p_type") == kind, word).otherwise(street)
    raw = F.concat(F.col("p_size").cast("string"), F.lit("  "), "p_name", F.lit(" "), street)
    return table(spark, sf_dir, "part").select("p_partkey", expand_abbreviations(raw).alias("address"))


@query(
    "parse_locations",
    """
    WITH n AS (SELECT c_custkey, c_nationkey + 10 AS num, c_mktsegment AS seg, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT c_custkey,
           CASE WHEN seg <> 'FURNITURE' THEN CAST(num AS VARCHAR) || ' TRADE BOULEVARD' END AS address_1,
           CASE WHEN seg = 'BUILDING' THEN 'STE 400' END AS address_2,
           CASE WHEN seg = 'MACHINERY' THEN '331' || CAST(num AS VARCHAR) END AS postal_code,
           CASE WHEN seg <> 'FURNITURE' THEN n_name END AS city,
           CASE WHEN seg = 'MACHINERY' THEN 'FL' END AS state
    FROM n
    """,
)
def parse_locations(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    number = (F.col("c_nationkey") + 10).cast("string")
    street = F.concat(number, F.lit(" Trade Blvd"))
    raw = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(street, F.lit(", Ste 400, "), F.lower("n_name")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(street, F.lit(", "), "n_name", F.lit(", FL 331"), number))
        .when(F.col("c_mktsegment") == "FURNITURE", F.col("n_name"))
        .otherwise(F.concat(F.lit(" "), street, F.lit(",  "), "n_name", F.lit(" ")))
    )
    return customers.select("c_custkey", parse_location(raw).alias("p")).select("c_custkey", "p.*")


_DATE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%m/%d/%y') WHEN '2-HIGH' THEN strftime(o_orderdate, '%d.%m.%Y')
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m') WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y')
    ELSE CASE o_orderstatus WHEN 'F' THEN 'n/a' WHEN 'O' THEN strftime(o_orderdate, '%B %-d, %Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END END"""


@query(
    "parse_mixed_dates",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'F') THEN NULL
                ELSE CAST(month(o_orderdate) AS INTEGER) END AS month,
           CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'F') THEN NULL
                ELSE CAST(day(o_orderdate) AS INTEGER) END AS day,
           (o_orderpriority = '5-LOW' AND o_orderstatus = 'F') AS bad
    FROM orders
    """,
)
def parse_mixed_dates(spark, sf_dir):
    d = F.col("o_orderdate")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "MM/dd/yy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "dd.MM.yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "yyyy-MM"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format(d, "yyyy"))
        .when(F.col("o_orderstatus") == "F", F.lit("n/a"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "MMMM d, yyyy"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey", dates.parse_partial_date(F.col("raw")).alias("d"), dates.date_is_unparseable(F.col("raw")).alias("bad")
    ).select("o_orderkey", "d.year", "d.month", "d.day", "bad")


@query(
    "lookup_label",
    """
    SELECT c_custkey, CASE WHEN n_nationkey IS NOT NULL THEN CAST(c_nationkey AS VARCHAR) END AS nation_code, n_name AS nation_label
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) ON n_nationkey = c_nationkey
    """,
)
def lookup_label(spark, sf_dir):
    mapping = table(spark, sf_dir, "nation").where("n_regionkey < 4").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("label")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation_code"))
    return lookup.code_label(customers, "nation_code", mapping, "nation_label")


_NOISY_SQL = "substr(p_name, 1, p_size % length(p_name)) || substr(p_name, p_size % length(p_name) + 2)"


@query(
    "fuzzy_label",
    rf"""
    WITH m AS (SELECT min(p_partkey) AS code, p_name AS entry FROM part GROUP BY p_name),
    q AS (SELECT DISTINCT upper({_NOISY_SQL}) AS label FROM part),
    s AS (SELECT label, code, entry, trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS a,
                 trim(regexp_replace(lower(entry), '[^a-z0-9]+', ' ', 'g')) AS b FROM q, m),
    d AS (SELECT label, code, entry, 100.0::DOUBLE * (1.0::DOUBLE - levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE) AS score FROM s)
    SELECT label, code, entry AS match, score FROM d WHERE score >= 80
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, entry, code) = 1
    """,
)
def fuzzy_label(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    mapping = part.groupBy(F.col("p_name").alias("label")).agg(F.min("p_partkey").alias("code"))
    cut = F.col("p_size") % F.length("p_name")
    noisy = F.upper(F.concat(F.substring(F.col("p_name"), F.lit(1), cut), F.substring(F.col("p_name"), cut + 2, F.length("p_name"))))
    return lookup.fuzzy_code(part.select(noisy.alias("label")), "label", mapping)


ORDER_SPEC = SourceSpec(
    name="orders_feed",
    path_pattern="orders_feed",
    primary_key=("order_id",),
    partition_key="status",
    schema=T.StructType(
        [
            T.StructField("order_id", T.StringType(), False),
            T.StructField("customer", T.StringType(), False),
            T.StructField("status", T.StringType()),
            T.StructField("total", T.DecimalType(12, 2)),
            T.StructField("ordered", T.StructType([T.StructField(p, T.IntegerType()) for p in ("year", "month", "day")])),
        ]
    ),
    raw_header=("Order", "Customer", "Status", "Total", "Date"),
    columns={
        "order_id": lambda: text.normalize_id(text.empty_to_null(F.col("Order"))),
        "customer": lambda: text.normalize_id(text.empty_to_null(F.col("Customer"))),
        "status": lambda: text.canonical(F.col("Status")),
        "total": lambda: F.col("Total").try_cast("decimal(12,2)"),
        "ordered": lambda: dates.parse_partial_date(F.col("Date")),
    },
    raw_rejects=(Reject("date_unparseable", lambda: dates.date_is_unparseable(F.col("Date"))),),
    rejects=(
        Reject("total_too_small", lambda: F.col("total") < 1000),
        Reject("date_out_of_range", lambda: ~dates.date_parts_in_range(F.col("ordered"))),
    ),
)
_RAW_ORDERS_SQL = """
    raw AS (SELECT 'O-' || CAST(o_orderkey AS VARCHAR) AS "Order",
        CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN '' ELSE 'c_' || CAST(o_custkey AS VARCHAR) END AS "Customer",
        ' ' || lower(o_orderstatus) AS "Status", CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS "Total",
        CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date"
        FROM orders),
    checked AS (SELECT *, concat_ws(',', CASE WHEN "Date" = 'unknown' THEN 'date_unparseable' END,
        CASE WHEN "Customer" = '' THEN 'customer_missing' END,
        CASE WHEN CAST("Total" AS DECIMAL(12,2)) < 1000 THEN 'total_too_small' END) AS reasons FROM raw)
"""


def _raw_orders(spark, sf_dir):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("Order"),
        F.when((priority == "5-LOW") & (status == "F"), "")
        .otherwise(F.concat(F.lit("c_"), F.col("o_custkey").cast("string"))).alias("Customer"),
        F.concat(F.lit(" "), F.lower(status)).alias("Status"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("Total"),
        F.when((priority == "2-HIGH") & (status == "P"), "unknown")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Date"),
    )


@query(
    "validate_split",
    f"""
    WITH {_RAW_ORDERS_SQL}
    SELECT replace("Order", '-', '') AS order_id, upper(replace("Customer", '_', '')) AS customer, trim(upper("Status")) AS status,
           "Total" AS total, CAST(year(CAST("Date" AS DATE)) AS INTEGER) AS year, CAST(month(CAST("Date" AS DATE)) AS INTEGER) AS month,
           CAST(day(CAST("Date" AS DATE)) AS INTEGER) AS day
    FROM checked WHERE reasons = ''
    """,
)
def validate_split(spark, sf_dir):
    valid = validate.validate(_raw_orders(spark, sf_dir), ORDER_SPEC).stored().valid
    return valid.select("order_id", "customer", "status", F.col("total").cast("string").alias("total"), "ordered.*")


@query("quarantine", f"WITH {_RAW_ORDERS_SQL} SELECT * FROM checked WHERE reasons <> ''")
def quarantine(spark, sf_dir):
    rejected = validate.validate(_raw_orders(spark, sf_dir), ORDER_SPEC).stored().rejected
    return rejected.withColumn("reasons", F.array_join("reject_reasons", ",")).drop("reject_reasons")


@query(
    "load_metrics",
    f"""
    WITH {_RAW_ORDERS_SQL}
    SELECT count(*) AS total, count(*) FILTER (reasons = '') AS success, count(*) FILTER (reasons <> '') AS failure FROM checked
    """,
)
def load_metrics(spark, sf_dir):
    return validate.validate(_raw_orders(spark, sf_dir), ORDER_SPEC).stored().metrics()


@query(
    "schema_enforcement",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey,
           TRY_CAST(replace(s_name, 'Supplier#', CASE WHEN s_acctbal < 0 THEN 'x' ELSE '' END) AS INTEGER) AS s_name,
           CAST(NULL AS VARCHAR) AS extra
    FROM supplier
    """,
)
def schema_enforcement(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("s_suppkey", T.StringType()), T.StructField("s_nationkey", T.LongType()),
            T.StructField("s_name", T.IntegerType()), T.StructField("extra", T.StringType()),
        ]
    )
    mark = F.when(F.col("s_acctbal") < 0, "x").otherwise("")
    rows = table(spark, sf_dir, "supplier").withColumn("s_name", F.replace("s_name", F.lit("Supplier#"), mark))
    return validate.enforce_schema(rows, schema, safe=True)


def _customer_flat(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(12,2)")).alias("balance"), "c_mktsegment",
    )


@query(
    "row_hashdiff",
    """
    SELECT c_custkey, md5(concat_ws(chr(31), c_name, coalesce(CASE WHEN c_acctbal >= 0
           THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END, chr(0)), coalesce(c_mktsegment, chr(0)))) AS hdiff
    FROM customer
    """,
)
def row_hashdiff(spark, sf_dir):
    rows = _customer_flat(spark, sf_dir)
    return rows.select("c_custkey", hash_diff(rows, ["c_custkey"]).alias("hdiff"))


@query(
    "union_align",
    """
    SELECT c_custkey AS party_id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation,
           CAST(c_custkey AS VARCHAR) AS unique_id, 'customer' AS data_source FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_nationkey, CAST(s_suppkey AS VARCHAR), 'supplier' FROM supplier
    """,
)
def union_align(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return align.align_sources({"customer": (customers, "party_id"), "supplier": (suppliers, "party_id")})


@query(
    "composite_key",
    """
    SELECT 'c_custkey-__-' || CAST(c_custkey AS VARCHAR) AS composite_id, 'customer' AS data_source, c_name AS name, NULL AS s_name FROM customer
    UNION ALL SELECT 's_suppkey-__-' || CAST(s_suppkey AS VARCHAR), 'supplier', NULL, s_name FROM supplier
    """,
)
def composite_ids(spark, sf_dir):
    customers = align.tag_source(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name")), "c_custkey", "customer")
    suppliers = align.tag_source(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", "supplier")
    return align.union_by_name([customers, suppliers]).select("composite_id", "data_source", "name", "s_name")


@query(
    "null_safe_keys",
    "SELECT c_custkey, 'segment-__-' || CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment_key FROM customer",
)
def null_safe_keys(spark, sf_dir):
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", composite_key("segment", segment).alias("segment_key"))
