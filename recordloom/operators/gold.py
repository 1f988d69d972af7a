"""Publishing: anchors, the id bridge and gold records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from recordloom.functions.text import empty_to_null
from recordloom.operators.dedup import dedup_integrated
from recordloom.operators.skew import heavy_keys, split_join
from recordloom.operators.survivorship import Integrated, SURVIVING_FIELDS, Shaped, ordered
from recordloom.settings import CLUSTER_ID, DATA_SOURCE

# The key of a gold record.
GOLD_KEY = ("anchor_entity_id", "anchor_data_source", "source_entity_id", "source_data_source")


@dataclass(frozen=True)
class Gold:
    anchors: DataFrame
    bridge: DataFrame
    records: DataFrame
    licenses: DataFrame


def dedup_clusters(result: Integrated) -> Integrated:
    """Keep the best integrated record per anchor; children of dropped records go with them."""
    records = dedup_integrated(result.records, ties=[F.col(CLUSTER_ID)])
    kept = records.select(CLUSTER_ID)
    return Integrated(
        records,
        result.alternates.join(kept, CLUSTER_ID, "left_semi"),
        result.licenses.join(kept, CLUSTER_ID, "left_semi"),
        result.rejected,
    )


def anchors_table(records: DataFrame) -> DataFrame:
    """Anchor identity and score in flat columns next to the surviving fields."""
    return records.select(
        F.col("anchor_entity.entity_id").alias("anchor_entity_id"),
        F.col("anchor_entity.data_source").alias("anchor_data_source"),
        F.col("anchor_entity.global_score").alias("anchor_score"),
        F.col("anchor_entity.vendor_id").alias("vendor_id"),
        F.col(CLUSTER_ID).alias("splink_id"),
        "has_id_conflict",
        *[f for f in (*SURVIVING_FIELDS, "n_licenses") if f in records.columns],
        "global_score",
    )


def id_bridge(records: DataFrame, alternates: DataFrame) -> DataFrame:
    """A row per anchor (empty alternate) and per alternate. Alternates are rows already, so
    the bridge never goes through an array."""
    anchor_ids = records.select(
        CLUSTER_ID,
        F.col("anchor_entity.entity_id").alias("anchor_entity_id"),
        F.col("anchor_entity.data_source").alias("anchor_data_source"),
    )
    own = anchor_ids.select(
        "anchor_entity_id", "anchor_data_source", F.lit("").alias("alt_entity_id"), F.lit("").alias("alt_data_source"),
        F.lit(True).alias("is_anchor"),
    )
    others = alternates.select(CLUSTER_ID, "entity_id", DATA_SOURCE).join(anchor_ids, CLUSTER_ID).select(
        "anchor_entity_id", "anchor_data_source", F.col("entity_id").alias("alt_entity_id"),
        F.col(DATA_SOURCE).alias("alt_data_source"), F.lit(False).alias("is_anchor"),
    )
    return own.unionByName(others)


def bridge_of_shape(shaped: Shaped) -> DataFrame:
    """The same bridge from the published shape."""
    alternates = shaped.alt_entities.withColumnRenamed("splink_id", CLUSTER_ID)
    return id_bridge(shaped.records.withColumnRenamed("splink_id", CLUSTER_ID), alternates)


def gold_records(bridge: DataFrame, anchors: DataFrame) -> DataFrame:
    """Bridge rows with the surviving values of their anchor, matched on id and source.

    Rows without a company name are not published; an empty source id becomes null. ``n_licenses``
    counts the anchor's rows of :func:`gold_licenses`.
    """
    joined = bridge.join(anchors, ["anchor_entity_id", "anchor_data_source"])
    carried = [c for c in ("vendor_id", *SURVIVING_FIELDS, "n_licenses") if c in anchors.columns]
    return joined.where(F.col("company_name").isNotNull()).select(
        "anchor_entity_id", "anchor_data_source",
        empty_to_null(F.col("alt_entity_id")).alias("source_entity_id"),
        empty_to_null(F.col("alt_data_source")).alias("source_data_source"),
        *carried,
    )


def gold_licenses(result: Integrated) -> DataFrame:
    """Licenses of each published anchor, a row each, in order."""
    owner = result.records.where(F.col("company_name").isNotNull()).select(
        CLUSTER_ID,
        F.col("anchor_entity.entity_id").alias("anchor_entity_id"),
        F.col("anchor_entity.data_source").alias("anchor_data_source"),
    )
    sizes = result.licenses.groupBy(CLUSTER_ID).agg(F.count(F.lit(1)).alias("n"))
    rows = split_join(result.licenses, owner, CLUSTER_ID, heavy_keys(sizes, CLUSTER_ID, "n"), ["license_id"])
    placed = ordered(rows, F.struct("rank", "license_id"), "gold-licenses")
    return placed.select("anchor_entity_id", "anchor_data_source", "ordinal", "license_id", "expiration_date")


def publish(result: Integrated) -> Gold:
    """Gold tables of deduplicated integrated records."""
    kept = dedup_clusters(result)
    counts = kept.licenses.groupBy(CLUSTER_ID).agg(F.count(F.lit(1)).alias("n_licenses"))
    counted = kept.records.join(counts, CLUSTER_ID, "left").withColumn("n_licenses", F.coalesce("n_licenses", F.lit(0)))
    anchors = anchors_table(counted)
    bridge = id_bridge(kept.records, kept.alternates)
    return Gold(anchors, bridge, gold_records(bridge, anchors), gold_licenses(kept))
