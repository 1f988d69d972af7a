"""The document table as three registries that share real-world entities.

A document is a record: its opening line is the name, its closing line the street, its
language the city, and a digest of the whole normalised text its entity id. Sources are
assigned to the three registries by name. Copies and near copies across sources are the
entities to resolve. The SQL constants state the same definitions for the expected results.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordloom.functions.text import empty_to_null, strip
from recordloom.operators.align import align_sources
from recordloom.operators.blocking import profiles, with_profile_id
from recordloom.operators.dedup import dedup_ranked
from recordloom.operators.model import MatchModel, exact_match, jaro_winkler_at, with_term_frequencies
from recordloom.plans.settings_er import ResolutionSettings
from recordloom.session import cut_lineage
from recordloom.suite.base import table

REGISTRY = tuple(f"src{i}" for i in range(0, 7))
LICENSES = tuple(f"src{i}" for i in range(7, 14))
VENDORS = tuple(f"src{i}" for i in range(14, 20))
KEYS = {
    "business_entity_registry": "entity_id",
    "licenses_registry": "license_id",
    "sub_contractors_registry": "vendor_id",
}

BLOCKING = ResolutionSettings.blocking
DETERMINISTIC = ResolutionSettings.deterministic
TRAINING = ResolutionSettings.training
# Comparisons and given parameters of the match model.
COMPARISONS = (
    exact_match("entity_id", term_frequency=True),
    jaro_winkler_at("company_name_normalized", term_frequency=True),
    jaro_winkler_at("address_1", term_frequency=True),
    jaro_winkler_at("city"),
)
MODEL = MatchModel(
    COMPARISONS,
    prior=0.001,
    parameters={
        "entity_id": {0: (0.3, 0.998), 1: (0.7, 0.002)},
        "company_name_normalized": {0: (0.05, 0.6), 1: (0.15, 0.38), 2: (0.2, 0.01), 3: (0.6, 0.01)},
        "address_1": {0: (0.2, 0.6), 1: (0.2, 0.375), 2: (0.1, 0.015), 3: (0.5, 0.01)},
        "city": {0: (0.05, 0.4), 1: (0.05, 0.1), 2: (0.05, 0.05), 3: (0.85, 0.45)},
    },
)
COLUMNS = tuple(c.column for c in COMPARISONS)


#: Runs of other characters than A-Z, a-z and 0-9. Java looks the named class up in a table, which
#: takes a tenth of the time of the spelt-out one or less.
_RUNS = r"\P{Alnum}+"


def _normal(c: Column) -> Column:
    plain = F.regexp_replace(c, _RUNS, " ")
    return empty_to_null(F.upper(strip(plain)))


def registries(spark, sf_dir):
    """The three registry frames as they would stand in the silver layer."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    title = F.substring_index("text", "\n", 1)
    closing = F.when(F.contains("text", F.lit("\n")), F.substring_index("text", "\n", -1))

    def rows(sources):
        # parse before the join, so only short fields take part in the shuffle
        parsed = docs.where(F.col("source").isin(*sources)).select(
            "doc_id", F.upper("lang").alias("city"), "n_chars",
            empty_to_null(strip(title)).alias("company_name"),
            _normal(title).alias("company_name_normalized"),
            _normal(closing).alias("address_1"),
            F.md5(F.coalesce(_normal(F.col("text")), F.lit("")).cast("binary")).alias("digest"),
        ).where(F.col("company_name").isNotNull())
        return parsed.join(labels, "doc_id", "left")

    entities = rows(REGISTRY).select(
        F.col("digest").alias("entity_id"), "company_name", "company_name_normalized", "address_1",
        F.col("n_chars").cast("string").alias("postal_code"), "city",
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_active"),
    )
    flagged = F.when(F.col("toxic") == 1, "FLAGGED").when(F.col("toxic") == 0, "CLEAR")
    licenses = rows(LICENSES).select(
        F.concat(F.lit("L"), F.col("doc_id").cast("string")).alias("license_id"), "company_name", "company_name_normalized",
        "address_1", F.lit(None).cast("string").alias("postal_code"), "city",
        F.when(F.col("toxic").isNotNull(), F.concat(F.lit("90000"), F.col("toxic").cast("string"))).alias("naics_code"),
        flagged.alias("naics_code_label"),
        F.struct(
            (F.lit(2000) + F.col("n_chars") % 50).cast("int").alias("year"),
            (F.lit(1) + F.col("n_chars") % 12).cast("int").alias("month"),
            (F.lit(1) + F.col("n_chars") % 28).cast("int").alias("day"),
        ).alias("expiration_date"),
    )
    vendors = rows(VENDORS).select(
        F.concat(F.lit("V"), F.col("doc_id").cast("string")).alias("vendor_id"),
        F.when(F.col("quality").isNotNull(), F.col("digest")).alias("entity_id"),
        "company_name", "company_name_normalized",
        F.when(F.col("quality") == 1, "GOOD").when(F.col("quality") == 0, "POOR").alias("certification_type"),
        F.lower("city").alias("trade_specialty"),
    )
    return {"business_entity_registry": entities, "licenses_registry": licenses, "sub_contractors_registry": vendors}


TIES = ("company_name", "address_1", "postal_code", "city")


def snapshots(spark, sf_dir):
    """Deduplicated frames with their key column, ready for resolution."""
    frames = registries(spark, sf_dir)
    out = {}
    for name, df in frames.items():
        ties = [F.col(c).asc_nulls_last() for c in TIES if c in df.columns]
        out[name] = (dedup_ranked(df, [KEYS[name]], ties), KEYS[name])
    return out


def stored_snapshots(spark, sf_dir):
    """The snapshots as written tables, for plans that read them several times: the texts are
    parsed once and only short fields are read again."""
    return {n: (cut_lineage(df, f"snapshot-{n}"), key) for n, (df, key) in snapshots(spark, sf_dir).items()}


def records(spark, sf_dir, link_type="link_and_dedupe", frames=None):
    return with_profile_id(align_sources(frames or snapshots(spark, sf_dir)), COLUMNS, link_type)


def profile_rows(spark, sf_dir, link_type="link_and_dedupe", term_frequencies=False, frames=None):
    rows = profiles(records(spark, sf_dir, link_type, frames), COLUMNS, link_type)
    if not term_frequencies:
        return rows
    # stored, because each frequency reads them three times
    return with_term_frequencies(cut_lineage(rows, "folded"), COMPARISONS, "n_records")


def stored_profiles(spark, sf_dir, link_type="link_and_dedupe", term_frequencies=False):
    """Profiles as a written table: every blocking rule reads them on both sides of its join."""
    return cut_lineage(profile_rows(spark, sf_dir, link_type, term_frequencies), "profiles")


# ------------------------------------------------------------------ expected results in SQL


def _norm_sql(x: str) -> str:
    return f"nullif(trim(upper(regexp_replace({x}, '[^A-Za-z0-9]+', ' ', 'g'))), '')"


def _in(sources) -> str:
    return "(" + ", ".join(f"'{s}'" for s in sources) + ")"


SILVER_SQL = rf"""
    d AS (SELECT doc_id, upper(lang) AS city, n_chars, source, quality, toxic,
            nullif(regexp_replace(split_part(text, chr(10), 1), '^\s+|\s+$', '', 'g'), '') AS company_name,
            {_norm_sql("split_part(text, chr(10), 1)")} AS company_name_normalized,
            CASE WHEN contains(text, chr(10)) THEN {_norm_sql("split_part(text, chr(10), -1)")} END AS address_1,
            md5(coalesce({_norm_sql("text")}, '')) AS digest
        FROM documents LEFT JOIN labels USING (doc_id)),
    ber AS (SELECT digest AS entity_id, company_name, company_name_normalized, address_1, CAST(n_chars AS VARCHAR) AS postal_code, city,
            coalesce(quality = 1, false) AS is_active
        FROM d WHERE source IN {_in(REGISTRY)} AND company_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY digest ORDER BY coalesce(quality = 1, false) DESC,
            5 + (company_name_normalized IS NOT NULL)::INT + (address_1 IS NOT NULL)::INT DESC,
            company_name NULLS LAST, address_1 NULLS LAST, postal_code NULLS LAST, city NULLS LAST) = 1),
    lic AS (SELECT 'L' || CAST(doc_id AS VARCHAR) AS license_id, company_name, company_name_normalized, address_1, NULL::VARCHAR AS postal_code, city,
            CASE WHEN toxic IS NOT NULL THEN '90000' || CAST(toxic AS VARCHAR) END AS naics_code,
            CASE toxic WHEN 1 THEN 'FLAGGED' WHEN 0 THEN 'CLEAR' END AS naics_code_label,
            CAST(2000 + n_chars % 50 AS INTEGER) AS ey, CAST(1 + n_chars % 12 AS INTEGER) AS em, CAST(1 + n_chars % 28 AS INTEGER) AS ed
        FROM d WHERE source IN {_in(LICENSES)} AND company_name IS NOT NULL),
    sub AS (SELECT 'V' || CAST(doc_id AS VARCHAR) AS vendor_id, CASE WHEN quality IS NOT NULL THEN digest END AS entity_id, company_name,
            company_name_normalized, CASE quality WHEN 1 THEN 'GOOD' WHEN 0 THEN 'POOR' END AS certification_type, lower(city) AS trade_specialty
        FROM d WHERE source IN {_in(VENDORS)} AND company_name IS NOT NULL)
"""

# every source row under one schema
ALL_SQL = f"""{SILVER_SQL},
    rec AS (SELECT 'business_entity_registry' AS data_source, entity_id AS unique_id, 'entity_id' AS key_name, entity_id, company_name,
            company_name_normalized, address_1, postal_code, city, is_active, NULL::VARCHAR AS license_id, NULL::VARCHAR AS naics_code,
            NULL::VARCHAR AS naics_code_label, NULL::INTEGER AS ey, NULL::INTEGER AS em, NULL::INTEGER AS ed, NULL::VARCHAR AS vendor_id,
            NULL::VARCHAR AS certification_type, NULL::VARCHAR AS trade_specialty FROM ber
        UNION ALL SELECT 'licenses_registry', license_id, 'license_id', NULL, company_name, company_name_normalized, address_1, postal_code, city,
            NULL, license_id, naics_code, naics_code_label, ey, em, ed, NULL, NULL, NULL FROM lic
        UNION ALL SELECT 'sub_contractors_registry', vendor_id, 'vendor_id', entity_id, company_name, company_name_normalized, NULL, NULL, NULL,
            NULL, NULL, NULL, NULL, NULL, NULL, NULL, vendor_id, certification_type, trade_specialty FROM sub),
    nodes AS (SELECT *, data_source || '-__-' || unique_id AS node_id, key_name || '-__-' || unique_id AS composite_id,
            md5(concat_ws(chr(31), {', '.join(f'coalesce({c}, chr(0))' for c in COLUMNS)})) AS pid FROM rec)"""


def profiles_sql(by_source: bool = False) -> str:
    """Profiles with term frequencies; by source when the link type tells sources apart."""
    source = ", any_value(data_source) AS data_source" if by_source else ""
    nodes = "nodes"
    cte = ALL_SQL
    if by_source:
        parts = ", ".join(f"coalesce({c}, chr(0))" for c in COLUMNS)
        cte += f", snodes AS (SELECT * REPLACE (md5(concat_ws(chr(31), {parts}, data_source)) AS pid) FROM nodes)"
        nodes = "snodes"
    tf = "".join(
        f""", tf_{c} AS (SELECT {c}, count(*) / (SELECT count({c}) FROM nodes) AS tf FROM nodes WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("entity_id", "company_name_normalized", "address_1")
    )
    return f"""{cte},
    p0 AS (SELECT pid, {', '.join(f'any_value({c}) AS {c}' for c in COLUMNS)}{source}, count(*) AS n_records, min(node_id) AS first_node
        FROM {nodes} GROUP BY pid){tf},
    prof AS (SELECT p0.*, a.tf AS tf_entity_id, b.tf AS tf_company_name_normalized, c.tf AS tf_address_1 FROM p0
        LEFT JOIN tf_entity_id a USING (entity_id) LEFT JOIN tf_company_name_normalized b USING (company_name_normalized)
        LEFT JOIN tf_address_1 c USING (address_1))"""


def _rule_sql(rule) -> str:
    def side(k, s):
        return f"{s}.{k.column}" if k.prefix is None else f"substr({s}.{k.column}, 1, {k.prefix})"

    return "(" + " AND ".join(f"{side(k, 'l')} = {side(k, 'r')}" for k in rule.keys) + ")"


def _present_sql(rule) -> str:
    return "(" + " AND ".join(f"{k.column} IS NOT NULL" for k in rule.keys) + ")"


def pairs_sql(rules=BLOCKING, by_source: bool = False, on: str = "") -> str:
    """Folded candidate pairs ``pairs`` with the first matching rule; copies of a profile included."""
    first = "CASE " + " ".join(f"WHEN {_rule_sql(r)} THEN '{r.name}'" for r in rules) + " END"
    some = " OR ".join(_rule_sql(r) for r in rules)
    sides = ", ".join(f"l.{c} AS {c}_l, r.{c} AS {c}_r" for c in COLUMNS)
    tfs = ", ".join(f"l.tf_{c} AS tf_{c}_l, r.tf_{c} AS tf_{c}_r" for c in ("entity_id", "company_name_normalized", "address_1"))
    own_first = "CASE " + " ".join(f"WHEN {_present_sql(r)} THEN '{r.name}'" for r in rules) + " END"
    own_sides = ", ".join(f"{c}, {c}" for c in COLUMNS)
    own_tfs = ", ".join(f"tf_{c}, tf_{c}" for c in ("entity_id", "company_name_normalized", "address_1"))
    copies = "" if "<>" in on else f"""
        UNION ALL SELECT pid, pid, {own_sides}, {own_tfs}, {own_first}, n_records * (n_records - 1) // 2 FROM prof
        WHERE n_records > 1 AND ({' OR '.join(_present_sql(r) for r in rules)})"""
    return f"""{profiles_sql(by_source)},
    pairs AS (SELECT l.pid AS pid_l, r.pid AS pid_r, {sides}, {tfs}, {first} AS rule, l.n_records * r.n_records AS n_pairs
        FROM prof l JOIN prof r ON l.pid < r.pid {on} AND ({some}){copies})"""


def level_sql(c) -> str:
    a, b = f"{c.column}_l", f"{c.column}_r"
    cases = [f"WHEN {a} IS NULL OR {b} IS NULL THEN -1", f"WHEN {a} = {b} THEN {c.exact_level}"]
    for i, t in enumerate(sorted(c.thresholds, reverse=True)):
        cases.append(f"WHEN jaro_winkler_similarity({a}, {b}) >= {t} THEN {c.exact_level - 1 - i}")
    return "CASE " + " ".join(cases) + " ELSE 0 END"


def vectors_sql(rules=BLOCKING) -> str:
    levels = ", ".join(f"CAST({level_sql(c)} AS INTEGER) AS {c.gamma}" for c in COMPARISONS)
    return f"{pairs_sql(rules)}, vec AS (SELECT *, {levels} FROM pairs)"


def scores_sql() -> str:
    terms = [f"({MODEL.prior_weight!r}::DOUBLE)"]
    for c in COMPARISONS:
        ladder = " ".join(f"WHEN {g} THEN {MODEL.log_factor(c, g)!r}::DOUBLE" for g in c.levels)
        terms.append(f"(CASE {c.gamma} {ladder} ELSE 0.0::DOUBLE END)")
        if c.term_frequency:
            u = MODEL.parameters[c.column][c.exact_level][1]
            terms.append(
                f"(CASE WHEN {c.gamma} = {c.exact_level} THEN log2({u!r}::DOUBLE / greatest(tf_{c.column}_l, tf_{c.column}_r)) ELSE 0.0::DOUBLE END)"
            )
    return f"""{vectors_sql()},
    wt AS (SELECT *, {' + '.join(terms)} AS match_weight FROM vec),
    scored AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + pow(2.0::DOUBLE, -match_weight)) AS match_probability FROM wt)"""


def links_sql() -> str:
    """Connected components by recursive minimum label, then one row per record."""
    return scores_sql().replace("d AS (SELECT doc_id", "RECURSIVE d AS (SELECT doc_id", 1) + """,
    good AS (SELECT pid_l, pid_r FROM scored WHERE match_probability >= 0.9),
    edge AS (SELECT pid_l AS a, pid_r AS b FROM good WHERE pid_l <> pid_r UNION SELECT pid_r, pid_l FROM good WHERE pid_l <> pid_r),
    reach(a, b) AS (SELECT a, a FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
    label AS (SELECT a AS pid, min(first_node) AS name FROM reach JOIN prof ON prof.pid = reach.b GROUP BY 1),
    links AS (SELECT coalesce(label.name, CASE WHEN g.pid_l IS NOT NULL THEN prof.first_node END, nodes.node_id) AS cluster_id,
            nodes.unique_id AS primary_key_id, nodes.key_name AS primary_key_type, nodes.data_source, nodes.composite_id
        FROM nodes JOIN prof USING (pid) LEFT JOIN label USING (pid)
        LEFT JOIN (SELECT pid_l FROM good WHERE pid_l = pid_r) g ON g.pid_l = nodes.pid)"""
