"""Survivorship and publishing over the resolved document registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import gold, runs, survivorship
from recordloom.operators.align import tag_source, union_by_name
from recordloom.plans.jobs import resolve
from recordloom.plans.settings_er import ResolutionSettings
from recordloom.session import cut_lineage
from recordloom.suite import corpus
from recordloom.suite.base import query
from recordloom.suite.matching import link_rows

_FIELDS = (
    "entity_id", "company_name", "company_name_normalized", "address_1", "postal_code", "city", "is_active", "license_id",
    "naics_code", "naics_code_label", "expiration_date", "vendor_id", "certification_type", "trade_specialty", "data_source",
)
_BOOLEAN = ("is_active",)


def _text(f: str, side: str = "") -> str:
    return f"CAST({side}{f} AS VARCHAR)"


def _filled(f: str) -> str:
    return rf"coalesce(regexp_replace({_text(f)}, '^\s+|\s+$', '', 'g') <> '', false)"


def _truthy(f: str) -> str:
    return f"coalesce({f}, false)" if f in _BOOLEAN else _filled(f)


def _canon(f: str, side: str = "") -> str:
    return rf"upper(regexp_replace({_text(f, side)}, '^\s+|\s+$', '', 'g'))"


def _present(f: str, side: str = "") -> str:
    return f"({side}{f} IS NOT NULL)" if f in _BOOLEAN else f"coalesce({_text(f, side)} <> '', false)"


def members_sql() -> str:
    return f"""{corpus.links_sql()},
    mem AS (SELECT links.cluster_id, nodes.* EXCLUDE (ey, em, ed),
            CASE WHEN ey IS NOT NULL THEN CAST(ey AS VARCHAR) || '-' || CAST(em AS VARCHAR) || '-' || CAST(ed AS VARCHAR) END AS expiration_date
        FROM nodes JOIN links USING (composite_id))"""


def scored_sql() -> str:
    populated = " + ".join(f"{_filled(f)}::INT" for f in _FIELDS)
    long = " UNION ALL ".join(
        f"SELECT cluster_id, composite_id, '{f}' AS field, {_canon(f)} AS value FROM mem WHERE {_truthy(f)}" for f in _FIELDS
    )
    return f"""{members_sql()},
    cells AS ({long}),
    agree AS (SELECT cluster_id, field, value, count(*) - 1 AS others FROM cells GROUP BY 1, 2, 3),
    points AS (SELECT composite_id, sum(others) AS points FROM cells JOIN agree USING (cluster_id, field, value) GROUP BY 1),
    sc0 AS (SELECT mem.*, count(*) OVER (PARTITION BY cluster_id) AS cluster_size, {populated} AS populated, coalesce(points, 0) AS points
        FROM mem LEFT JOIN points USING (composite_id)),
    sc1 AS (SELECT *, populated / 15.0::DOUBLE AS depth_score, CASE WHEN cluster_size <= 2 THEN 1.0::DOUBLE WHEN populated > 0
            THEN points::DOUBLE / (populated * (cluster_size - 1))::DOUBLE ELSE 0.0::DOUBLE END AS consensus_score FROM sc0),
    sc AS (SELECT *, (depth_score + 2.0::DOUBLE * consensus_score) / 3.0::DOUBLE AS global_score FROM sc1)"""


def ranked_sql() -> str:
    compared = " + ".join(f"({_present(f, 's.')} AND {_present(f, 'a.')})::INT" for f in _FIELDS)
    equal = " + ".join(
        f"coalesce({_present(f, 's.')} AND {_present(f, 'a.')} AND {_canon(f, 's.')} = {_canon(f, 'a.')}, false)::INT" for f in _FIELDS
    )
    return f"""{scored_sql()},
    anchor AS (SELECT * FROM sc WHERE data_source IN ('business_entity_registry', 'sub_contractors_registry') AND coalesce(entity_id <> '', false)
        QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY global_score DESC, composite_id) = 1),
    reason AS (SELECT cluster_id, CASE WHEN NOT bool_or(sc.data_source IN ('business_entity_registry', 'sub_contractors_registry')) THEN 'no_anchor_source'
            WHEN max(a.composite_id) IS NULL THEN 'no_anchor_key' WHEN NOT bool_or(coalesce(sc.company_name <> '', false)) THEN 'no_company_name' END AS reject_reason
        FROM sc LEFT JOIN anchor a USING (cluster_id) GROUP BY 1),
    rk AS (SELECT s.*, s.composite_id = a.composite_id AS is_anchor,
            CASE WHEN s.composite_id = a.composite_id THEN 1.0::DOUBLE WHEN ({compared}) > 0 THEN ({equal})::DOUBLE / ({compared})::DOUBLE ELSE 0.0::DOUBLE END AS agreement_score,
            row_number() OVER (PARTITION BY s.cluster_id ORDER BY s.composite_id <> a.composite_id, s.global_score DESC, s.composite_id) AS rk
        FROM sc s JOIN anchor a USING (cluster_id) JOIN reason USING (cluster_id) WHERE reject_reason IS NULL),
    alt AS (SELECT * FROM rk WHERE NOT is_anchor AND coalesce(entity_id <> '', false)),
    lics AS (SELECT cluster_id, license_id, expiration_date, rk FROM rk WHERE data_source = 'licenses_registry' AND coalesce(license_id <> '', false)
        QUALIFY row_number() OVER (PARTITION BY cluster_id, license_id ORDER BY rk) = 1)"""


def integrated_sql() -> str:
    first = ", ".join(f"arg_min({f}, rk) FILTER ({_present(f)}) AS {f}" for f in survivorship.SURVIVING_FIELDS)
    filled = " + ".join(f"({_present(f)})::INT" for f in survivorship.OPTIONAL_FIELDS)
    return f"""{ranked_sql()},
    one AS (SELECT cluster_id, arg_min(entity_id, rk) FILTER (is_anchor) AS anchor_id, arg_min(data_source, rk) FILTER (is_anchor) AS anchor_source,
            max(depth_score) FILTER (is_anchor) AS depth, max(consensus_score) FILTER (is_anchor) AS consensus,
            max(global_score) FILTER (is_anchor) AS anchor_score,
            coalesce(nullif(arg_min(coalesce(vendor_id, ''), rk) FILTER (is_anchor), ''),
                arg_min(vendor_id, rk) FILTER (NOT is_anchor AND coalesce(entity_id <> '', false) AND coalesce(vendor_id <> '', false))) AS vendor_id,
            count(*) FILTER (NOT is_anchor AND coalesce(entity_id <> '', false)) AS n_alternates, {first} FROM rk GROUP BY 1),
    integ AS (SELECT * REPLACE (coalesce(is_active, false) AS is_active), n_alternates > 0 AS has_id_conflict,
            round((7 + {filled}) / 14.0::DOUBLE, 4) AS global_score FROM one)"""


def kept_sql() -> str:
    return f"""{integrated_sql()},
    kept AS (SELECT * FROM integ QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor_source ORDER BY is_active DESC, global_score DESC, cluster_id) = 1),
    bridge AS (SELECT anchor_id AS anchor_entity_id, anchor_source AS anchor_data_source, '' AS alt_entity_id, '' AS alt_data_source, true AS is_anchor FROM kept
        UNION ALL SELECT anchor_id, anchor_source, alt.entity_id, alt.data_source, false FROM alt JOIN kept USING (cluster_id))"""


_R9 = "round({0}, 9) AS {0}"


def _rounded(*names):
    return [F.round(n, 9).alias(n) for n in names]


def members(spark, sf_dir):
    """Linked source rows, stored once: every merge step reads them more than once."""
    frames = corpus.stored_snapshots(spark, sf_dir)
    tagged = union_by_name([tag_source(df, key, name) for name, (df, key) in frames.items()])
    return cut_lineage(survivorship.link_records(tagged, link_rows(spark, sf_dir, frames)), "members")


def _ranked(spark, sf_dir):
    scored = cut_lineage(survivorship.score_members(members(spark, sf_dir)), "scored")
    ranked = survivorship.with_anchor_agreement(scored, survivorship.pick_anchors(scored))
    return ranked.where(F.col("reject_reason").isNull())


@query(
    "linked_members",
    f"WITH {members_sql()} SELECT cluster_id, composite_id, data_source, entity_id, license_id, vendor_id, is_active, city FROM mem",
)
def linked_members(spark, sf_dir):
    return members(spark, sf_dir).select(
        "cluster_id", "composite_id", "data_source", "entity_id", "license_id", "vendor_id", "is_active", "city"
    )


@query(
    "cluster_lists",
    f"""WITH {members_sql()} SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY composite_id) - 1 AS ordinal, composite_id, data_source, city FROM mem""",
)
def cluster_lists(spark, sf_dir):
    """Member rows in their place in their cluster."""
    return survivorship.cluster_lists(members(spark, sf_dir)).select("cluster_id", "ordinal", "composite_id", "data_source", "city")


@query(
    "orphan_members",
    f"""WITH {members_sql()}
    SELECT CASE WHEN data_source = 'licenses_registry' THEN 'orphan_' || composite_id ELSE cluster_id END AS cluster_id, composite_id FROM mem""",
)
def orphan_members(spark, sf_dir):
    """Rows whose links are missing stay, each as a cluster of its own."""
    frames = corpus.stored_snapshots(spark, sf_dir)
    tagged = union_by_name([tag_source(df, key, name) for name, (df, key) in frames.items()])
    partial = link_rows(spark, sf_dir, frames).where("data_source <> 'licenses_registry'")
    return survivorship.link_records(tagged, partial).select("cluster_id", "composite_id")


@query(
    "member_scores",
    f"""WITH {scored_sql()} SELECT cluster_id, composite_id, CAST(cluster_size AS BIGINT) AS cluster_size,
        {_R9.format('depth_score')}, {_R9.format('consensus_score')}, {_R9.format('global_score')} FROM sc""",
)
def member_scores(spark, sf_dir):
    scored = survivorship.score_members(members(spark, sf_dir))
    return scored.select(
        "cluster_id", "composite_id", "cluster_size", *_rounded("depth_score", "consensus_score", "global_score")
    )


@query(
    "anchors_pick",
    f"""WITH {ranked_sql()} SELECT reason.cluster_id, CASE WHEN reject_reason IS NULL OR reject_reason = 'no_company_name' THEN anchor.composite_id END AS anchor, reject_reason
        FROM reason LEFT JOIN anchor USING (cluster_id)""",
)
def anchors_pick(spark, sf_dir):
    anchors = survivorship.pick_anchors(survivorship.score_members(members(spark, sf_dir)))
    return anchors.select("cluster_id", F.col("anchor.composite_id").alias("anchor"), "reject_reason")


@query(
    "anchor_agreement",
    f"WITH {ranked_sql()} SELECT cluster_id, composite_id, is_anchor, {_R9.format('agreement_score')} FROM rk",
)
def anchor_agreement(spark, sf_dir):
    return _ranked(spark, sf_dir).select("cluster_id", "composite_id", "is_anchor", *_rounded("agreement_score"))


@query(
    "alternates",
    f"""WITH {ranked_sql()} SELECT cluster_id, composite_id, entity_id, data_source, {_R9.format('depth_score')}, {_R9.format('consensus_score')},
        {_R9.format('global_score')}, {_R9.format('agreement_score')}, vendor_id FROM alt""",
)
def alternates(spark, sf_dir):
    rows = survivorship.alternates_of(_ranked(spark, sf_dir))
    scores = ("depth_score", "consensus_score", "global_score", "agreement_score")
    return rows.select("cluster_id", "composite_id", "entity_id", "data_source", *_rounded(*scores), "vendor_id")


@query("license_rollup", f"WITH {ranked_sql()} SELECT cluster_id, license_id, expiration_date FROM lics")
def license_rollup(spark, sf_dir):
    rows = survivorship.licenses_of(_ranked(spark, sf_dir))
    parts = [F.col(f"expiration_date.{p}").cast("string") for p in ("year", "month", "day")]
    return rows.select("cluster_id", "license_id", F.concat_ws("-", *parts).alias("expiration_date"))


_SURVIVING = ", ".join(survivorship.SURVIVING_FIELDS)


@query(
    "surviving_records",
    f"""WITH {integrated_sql()} SELECT cluster_id, anchor_id, anchor_source, round(anchor_score, 9) AS anchor_score, vendor_id, n_alternates,
        has_id_conflict, {_SURVIVING}, global_score FROM integ""",
)
def surviving_records(spark, sf_dir):
    rows = survivorship.integrate(members(spark, sf_dir)).records
    return rows.select(
        "cluster_id", F.col("anchor_entity.entity_id").alias("anchor_id"), F.col("anchor_entity.data_source").alias("anchor_source"),
        F.round("anchor_entity.global_score", 9).alias("anchor_score"), F.col("anchor_entity.vendor_id").alias("vendor_id"),
        "n_alternates", "has_id_conflict", *survivorship.SURVIVING_FIELDS, "global_score",
    )


@query(
    "id_conflict",
    f"WITH {integrated_sql()} SELECT n_alternates, count(*) AS n_clusters FROM integ GROUP BY 1",
)
def id_conflict(spark, sf_dir):
    return survivorship.alternates_histogram(survivorship.integrate(members(spark, sf_dir)).records)


@query(
    "cluster_rejects",
    f"WITH {ranked_sql()} SELECT cluster_id, composite_id, reject_reason FROM mem JOIN reason USING (cluster_id) WHERE reject_reason IS NOT NULL",
)
def cluster_rejects(spark, sf_dir):
    return survivorship.integrate(members(spark, sf_dir)).rejected.select("cluster_id", "composite_id", "reject_reason")


@query(
    "merge_metrics",
    f"WITH {ranked_sql()} SELECT count(*) AS total, count(*) FILTER (reject_reason IS NULL) AS success, count(*) FILTER (reject_reason IS NOT NULL) AS failure FROM reason",
)
def merge_metrics(spark, sf_dir):
    scored = survivorship.score_members(members(spark, sf_dir))
    return survivorship.merge_metrics(survivorship.pick_anchors(scored))


@query(
    "nested_records",
    f"""WITH {integrated_sql()}
    SELECT cluster_id AS splink_id, anchor_id, has_id_conflict, n_alternates,
        (SELECT count(*) FROM lics WHERE lics.cluster_id = integ.cluster_id) AS n_licenses, {_SURVIVING}, global_score FROM integ""",
)
def nested_records(spark, sf_dir):
    """The published records; their children are in tables of their own."""
    shaped = survivorship.shape(survivorship.integrate(members(spark, sf_dir)))
    return shaped.records.select(
        "splink_id", F.col("anchor_entity.entity_id").alias("anchor_id"), "has_id_conflict", "n_alternates", "n_licenses",
        *survivorship.SURVIVING_FIELDS, "global_score",
    )


@query(
    "alt_entities",
    f"""WITH {ranked_sql()} SELECT cluster_id AS splink_id, row_number() OVER (PARTITION BY cluster_id ORDER BY rk) - 1 AS ordinal, entity_id, data_source,
        {_R9.format('depth_score')}, {_R9.format('consensus_score')}, {_R9.format('global_score')}, {_R9.format('agreement_score')}, vendor_id FROM alt""",
)
def alt_entities(spark, sf_dir):
    found = survivorship.shape(survivorship.integrate(members(spark, sf_dir))).alt_entities
    scores = ("depth_score", "consensus_score", "global_score", "agreement_score")
    return found.select("splink_id", "ordinal", "entity_id", "data_source", *_rounded(*scores), "vendor_id")


def _date_text():
    return F.concat_ws("-", *[F.col(f"expiration_date.{p}").cast("string") for p in ("year", "month", "day")]).alias("expiration_date")


@query(
    "record_licenses",
    f"""WITH {ranked_sql()} SELECT cluster_id AS splink_id, row_number() OVER (PARTITION BY cluster_id ORDER BY rk) - 1 AS ordinal, license_id, expiration_date FROM lics""",
)
def record_licenses(spark, sf_dir):
    found = survivorship.shape(survivorship.integrate(members(spark, sf_dir))).licenses
    return found.select("splink_id", "ordinal", "license_id", _date_text())


@query(
    "dedup_integrated",
    f"WITH {kept_sql()} SELECT cluster_id, anchor_id, anchor_source, is_active, global_score FROM kept",
)
def dedup_integrated(spark, sf_dir):
    kept = gold.dedup_clusters(survivorship.integrate(members(spark, sf_dir))).records
    return kept.select(
        "cluster_id", F.col("anchor_entity.entity_id").alias("anchor_id"), F.col("anchor_entity.data_source").alias("anchor_source"),
        "is_active", "global_score",
    )


def _gold(spark, sf_dir):
    return gold.publish(survivorship.integrate(members(spark, sf_dir)))


@query(
    "gold_anchors",
    f"""WITH {kept_sql()} SELECT anchor_id AS anchor_entity_id, anchor_source AS anchor_data_source, round(anchor_score, 9) AS anchor_score, vendor_id,
        cluster_id AS splink_id, has_id_conflict, {_SURVIVING}, global_score FROM kept""",
)
def gold_anchors(spark, sf_dir):
    return _gold(spark, sf_dir).anchors.withColumn("anchor_score", F.round("anchor_score", 9))


@query("id_bridge", f"WITH {kept_sql()} SELECT * FROM bridge")
def id_bridge(spark, sf_dir):
    return _gold(spark, sf_dir).bridge


@query("id_bridge_from_nested", f"WITH {kept_sql()} SELECT * FROM bridge")
def id_bridge_from_nested(spark, sf_dir):
    kept = gold.dedup_clusters(survivorship.integrate(members(spark, sf_dir)))
    return gold.bridge_of_shape(survivorship.shape(kept))


@query(
    "gold_records",
    f"""WITH {kept_sql()} SELECT anchor_entity_id, anchor_data_source, nullif(alt_entity_id, '') AS source_entity_id,
        nullif(alt_data_source, '') AS source_data_source, vendor_id, {_SURVIVING},
        (SELECT count(*) FROM lics WHERE lics.cluster_id = kept.cluster_id) AS n_licenses
    FROM bridge JOIN kept ON anchor_id = anchor_entity_id AND anchor_source = anchor_data_source""",
)
def gold_records(spark, sf_dir):
    return _gold(spark, sf_dir).records


@query(
    "gold_licenses",
    f"""WITH {kept_sql()} SELECT anchor_id AS anchor_entity_id, anchor_source AS anchor_data_source,
        row_number() OVER (PARTITION BY cluster_id ORDER BY lics.rk) - 1 AS ordinal, license_id, expiration_date FROM lics JOIN kept USING (cluster_id)""",
)
def gold_licenses(spark, sf_dir):
    """Licenses of gold records, in order."""
    return _gold(spark, sf_dir).licenses.withColumn("expiration_date", _date_text())


@query("run_record")
def run_record(spark, sf_dir):
    settings = {"blocking": [r.name for r in corpus.BLOCKING], "cluster_threshold": 0.9}
    return runs.run_record(link_rows(spark, sf_dir), list(corpus.KEYS), settings).drop("timestamp", "run_id")


@query("end_to_end")
def end_to_end(spark, sf_dir):
    """Dedup, training, resolution, merge and publishing in one go."""
    frames = {n: (df.withColumns({"hdiff": F.lit(""), "ldts": F.lit(None).cast("timestamp")}), k)
              for n, (df, k) in corpus.stored_snapshots(spark, sf_dir).items()}
    settings = ResolutionSettings(
        blocking=corpus.BLOCKING, deterministic=corpus.DETERMINISTIC, training=corpus.TRAINING,
        comparisons=corpus.COMPARISONS,
    )
    found = resolve(frames, settings)
    tagged = union_by_name([tag_source(df, key, name) for name, (df, key) in frames.items()])
    linked = cut_lineage(survivorship.link_records(tagged, found.links), "members")
    return gold.publish(survivorship.integrate(linked)).records
