"""Merge each cluster into one surviving record.

Clusters may be of any size, so nothing here packs a cluster into one value. Every step is
an aggregate with map-side combining, or a join of member rows with one row per cluster.
Results are three flat tables: surviving records, alternates and licenses; ``shape`` keys the
last two by cluster and ordinal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from recordloom.functions.text import canonical, strip
from recordloom.operators.skew import heavy_keys, split_join
from recordloom.session import cut_lineage
from recordloom.settings import CLUSTER_ID, COMPOSITE_ID, DATA_SOURCE, HASH_DIFF, LOAD_TS, ORPHAN_PREFIX

# Bookkeeping columns that carry no evidence, anchor sources and the fields
# that survive one by one.
METADATA_COLUMNS = (CLUSTER_ID, COMPOSITE_ID, LOAD_TS, HASH_DIFF)
ANCHOR_SOURCES = ("business_entity_registry", "sub_contractors_registry")
LICENSE_SOURCE = "licenses_registry"
SURVIVING_FIELDS = (
    "company_name", "address_1", "postal_code", "city", "is_active", "naics_code", "naics_code_label",
    "certification_type", "trade_specialty",
)
OPTIONAL_FIELDS = (
    "address_1", "postal_code", "city", "naics_code", "naics_code_label", "certification_type", "trade_specialty",
)
ALWAYS_POPULATED = 7  # anchor, alternates, splink id, conflict flag, name, active flag, licenses
NO_SOURCE, NO_KEY, NO_NAME = "no_anchor_source", "no_anchor_key", "no_company_name"


@dataclass(frozen=True)
class Integrated:
    records: DataFrame
    alternates: DataFrame
    licenses: DataFrame
    rejected: DataFrame


def link_records(sources: DataFrame, link_rows: DataFrame) -> DataFrame:
    """Every source row with its cluster; a row without a link becomes its own orphan cluster."""
    distinct_links = link_rows.select(
        CLUSTER_ID, F.concat_ws("-__-", "primary_key_type", "primary_key_id").alias(COMPOSITE_ID)
    ).dropDuplicates()
    return sources.join(distinct_links, COMPOSITE_ID, "left").withColumn(
        CLUSTER_ID, F.coalesce(CLUSTER_ID, F.concat(F.lit(ORPHAN_PREFIX), COMPOSITE_ID))
    )


def data_keys(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in METADATA_COLUMNS]


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(name)
    return F.col(name).cast("string")


def _populated(text: Column) -> Column:
    return F.coalesce(strip(text) != "", F.lit(False))


def _truthy(df: DataFrame, name: str) -> Column:
    """Values that count as evidence of agreement: ``False`` and empty ones do not."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.coalesce(F.col(name), F.lit(False))
    return _populated(_as_text(df, name))


def _present(df: DataFrame, name: str) -> Column:
    """Neither null nor the empty string; ``False`` is present."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    return c.isNotNull()


def _count(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("int") for c in conditions])


def score_members(members: DataFrame) -> DataFrame:
    """Add ``depth_score``, ``consensus_score`` and ``global_score`` to every member row.

    Consensus compares a value with the other members of its cluster and is 1 for clusters of
    one or two, which are most of them; only members of larger clusters are unpivoted to
    (cluster, field, value) and counted.
    """
    keys = data_keys(members)
    populated = _count([_populated(_as_text(members, k)) for k in keys])
    sizes = members.groupBy(CLUSTER_ID).agg(F.count(F.lit(1)).alias("_size"))
    heavy = heavy_keys(sizes, CLUSTER_ID, "_size")
    sized = split_join(members, sizes, CLUSTER_ID, heavy, [COMPOSITE_ID]).withColumn("_populated", populated)

    cells = F.explode(
        F.array_compact(
            F.array(
                *[
                    F.when(
                        _truthy(members, k),
                        F.struct(F.lit(k).alias("field"), canonical(_as_text(members, k)).alias("value")),
                    )
                    for k in keys
                ]
            )
        )
    )
    # One struct column as the key: the counts must not inherit the partitioning by cluster,
    # or all cells of a large cluster would be counted in the task that holds the cluster.
    long = (
        sized.where(F.col("_size") > 2).select(CLUSTER_ID, COMPOSITE_ID, cells.alias("c"))
        .select(COMPOSITE_ID, F.struct(CLUSTER_ID, "c.field", "c.value").alias("cell"))
    )
    agreement = long.groupBy("cell").agg((F.count(F.lit(1)) - 1).alias("_others")).where(F.col("_others") > 0)
    shared = split_join(long, agreement, "cell", heavy_keys(agreement, "cell", "_others"), [COMPOSITE_ID])
    points = shared.groupBy(COMPOSITE_ID).agg(F.sum("_others").alias("_points"))

    scored = sized.join(points, COMPOSITE_ID, "left")
    possible = F.col("_populated") * (F.col("_size") - 1)
    consensus = (
        F.when(F.col("_size") <= 2, 1.0)
        .when(possible > 0, F.coalesce("_points", F.lit(0)) / possible)
        .otherwise(0.0)
    )
    depth = F.col("_populated") / F.lit(len(keys))
    return (
        scored.withColumn("depth_score", depth)
        .withColumn("consensus_score", consensus)
        .withColumn("global_score", (F.col("depth_score") + F.lit(2) * F.col("consensus_score")) / F.lit(3))
        .drop("_populated", "_points")
        .withColumnRenamed("_size", "cluster_size")
    )


def _rank() -> Column:
    """Order inside a cluster: best score first, then the composite id."""
    return F.struct((-F.col("global_score")).alias("s"), F.col(COMPOSITE_ID).alias("k"))


def pick_anchors(scored: DataFrame, anchor_sources: Sequence[str] = ANCHOR_SOURCES) -> DataFrame:
    """One row per cluster: the anchor row (null when there is none), the reject reason and the cluster's size."""
    valid_source = F.col(DATA_SOURCE).isin(list(anchor_sources))
    eligible = valid_source & _present(scored, "entity_id")
    row = F.struct(*[F.col(c) for c in scored.columns if c != CLUSTER_ID])
    picked = scored.groupBy(CLUSTER_ID).agg(
        F.min_by(row, F.when(eligible, _rank())).alias("anchor"),
        F.bool_or(valid_source).alias("_source"),
        F.bool_or(_present(scored, "company_name")).alias("_name"),
        F.count(F.lit(1)).alias("n_members"),
    )
    reason = F.when(~F.coalesce("_source", F.lit(False)), NO_SOURCE).when(F.col("anchor").isNull(), NO_KEY).when(
        ~F.coalesce("_name", F.lit(False)), NO_NAME
    )
    return picked.select(CLUSTER_ID, "anchor", reason.alias("reject_reason"), "n_members")


def with_anchor_agreement(scored: DataFrame, anchors: DataFrame) -> DataFrame:
    """Members with ``is_anchor``, their agreement with the anchor and the reject reason of their cluster."""
    keys = data_keys_of_scored(scored)
    heavy = heavy_keys(anchors, CLUSTER_ID, "n_members")
    joined = split_join(scored, anchors.drop("n_members"), CLUSTER_ID, heavy, [COMPOSITE_ID])

    def both(k: str) -> Column:
        theirs = F.col(f"anchor.{k}")
        if isinstance(scored.schema[k].dataType, T.StringType):
            return _present(scored, k) & F.coalesce(theirs != "", F.lit(False))
        return F.col(k).isNotNull() & theirs.isNotNull()

    def text(k: str, side: str = "") -> Column:
        c = F.col(f"{side}{k}")
        return F.to_json(c) if isinstance(scored.schema[k].dataType, T.StructType) else c.cast("string")

    compared = _count([both(k) for k in keys])
    equal = _count([both(k) & (canonical(text(k)) == canonical(text(k, "anchor."))) for k in keys])
    is_anchor = F.coalesce(F.col(COMPOSITE_ID) == F.col(f"anchor.{COMPOSITE_ID}"), F.lit(False))
    agreement = F.when(is_anchor, 1.0).when(compared > 0, equal / compared).otherwise(0.0)
    return joined.withColumn("is_anchor", is_anchor).withColumn("agreement_score", agreement).drop("anchor")


def data_keys_of_scored(scored: DataFrame) -> list[str]:
    added = {"depth_score", "consensus_score", "global_score", "cluster_size"}
    return [c for c in data_keys(scored) if c not in added]


def alternates_of(members: DataFrame) -> DataFrame:
    """Non-anchor members that have an entity id, one row each, with their scores."""
    return members.where(~F.col("is_anchor") & _present(members, "entity_id")).select(
        CLUSTER_ID, COMPOSITE_ID, "entity_id", DATA_SOURCE, "depth_score", "consensus_score", "global_score",
        "agreement_score", "vendor_id",
    )


def licenses_of(members: DataFrame) -> DataFrame:
    """Distinct licenses per cluster; the best-ranked member gives the expiration date."""
    rank = F.struct((~F.col("is_anchor")).alias("a"), (-F.col("global_score")).alias("s"), F.col(COMPOSITE_ID).alias("k"))
    return (
        members.where((F.col(DATA_SOURCE) == LICENSE_SOURCE) & _present(members, "license_id"))
        .groupBy(CLUSTER_ID, "license_id")
        .agg(F.min_by(F.struct("expiration_date"), rank).alias("best"), F.min(rank).alias("rank"))
        .select(CLUSTER_ID, "license_id", F.col("best.expiration_date").alias("expiration_date"), "rank")
    )


def survive(members: DataFrame) -> DataFrame:
    """One row per cluster: first present value per field in rank order, scores and flags."""
    rank = F.struct((~F.col("is_anchor")).alias("a"), (-F.col("global_score")).alias("s"), F.col(COMPOSITE_ID).alias("k"))
    fields = [f for f in SURVIVING_FIELDS if f in members.columns]
    alternate = ~F.col("is_anchor") & _present(members, "entity_id")
    first = [F.min_by(f, F.when(_present(members, f), rank)).alias(f) for f in fields]
    anchor = ("entity_id", DATA_SOURCE, "depth_score", "consensus_score", "global_score", "agreement_score", "vendor_id")
    one = members.groupBy(CLUSTER_ID).agg(
        F.min_by(F.struct(*anchor), F.when(F.col("is_anchor"), rank)).alias("_anchor"),
        F.min_by("vendor_id", F.when(alternate & _present(members, "vendor_id"), rank)).alias("_alt_vendor"),
        F.count_if(alternate).alias("n_alternates"),
        *first,
    )
    vendor = F.coalesce(F.nullif(F.col("_anchor.vendor_id"), F.lit("")), F.col("_alt_vendor"))
    one = one.select(
        CLUSTER_ID,
        F.struct(*[F.col(f"_anchor.{a}").alias(a) for a in anchor[:-1]], vendor.alias("vendor_id")).alias("anchor_entity"),
        "n_alternates",
        (F.col("n_alternates") > 0).alias("has_id_conflict"),
        *[F.col(f) if f != "is_active" else F.coalesce(f, F.lit(False)).alias(f) for f in fields],
    )
    filled = _count([_present(one, f) for f in OPTIONAL_FIELDS if f in fields]) + F.lit(ALWAYS_POPULATED)
    return one.withColumn("global_score", F.round(filled / F.lit(ALWAYS_POPULATED + len(OPTIONAL_FIELDS)), 4))


def integrate(members: DataFrame, anchor_sources: Sequence[str] = ANCHOR_SOURCES) -> Integrated:
    """Linked member rows to surviving records, alternates, licenses and rejected members.

    Scores and agreements are stored once, because all four results read them.
    """
    scored = cut_lineage(score_members(members), "scored")
    anchors = pick_anchors(scored, anchor_sources)
    ranked = cut_lineage(with_anchor_agreement(scored, anchors), "ranked")
    merged = ranked.where(F.col("reject_reason").isNull())
    return Integrated(
        records=survive(merged),
        alternates=alternates_of(merged),
        licenses=licenses_of(merged),
        rejected=ranked.where(F.col("reject_reason").isNotNull()).select(*members.columns, "reject_reason"),
    )


ENTITY_TYPE = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("data_source", T.StringType()),
        *[T.StructField(s, T.DoubleType()) for s in ("depth_score", "consensus_score", "global_score", "agreement_score")],
        T.StructField("vendor_id", T.StringType()),
    ]
)

def ordered(children: DataFrame, rank: Column, tag: str = "ordered") -> DataFrame:
    """``children`` with ``ordinal``, their place in their cluster by ``rank``, from 0.

    All rows are sorted by ranges of cluster and rank and numbered through; a row's ordinal is its
    number less the first of its cluster. So a cluster of any size spreads over many ranges, and
    no task sorts or holds one. The rank must be a total order inside a cluster.
    """
    key = F.struct(F.col(CLUSTER_ID).alias("c"), rank.alias("r"))
    placed = children.withColumn("_key", key).repartitionByRange("_key").sortWithinPartitions("_key").drop("_key")
    # stored, so that a row keeps the number it was given: the range in the high bits, the place in it in the low ones
    placed = cut_lineage(placed.withColumn("_at", F.monotonically_increasing_id()), tag).withColumn("_part", F.shiftright("_at", 33))
    counts = sorted(tuple(r) for r in placed.groupBy("_part").agg(F.count(F.lit(1))).collect())  # a row per range
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    first = children.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    numbered = placed.join(F.broadcast(first), "_part").withColumn("_no", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    numbered = numbered.drop("_part", "_start", "_at")
    heads = numbered.groupBy(CLUSTER_ID).agg(F.min("_no").alias("_head"), F.count(F.lit(1)).alias("_n"))
    joined = split_join(numbered, heads.drop("_n"), CLUSTER_ID, heavy_keys(heads, CLUSTER_ID, "_n"), ["_no"])
    return joined.withColumn("ordinal", F.col("_no") - F.col("_head")).drop("_no", "_head")


def cluster_lists(members: DataFrame) -> DataFrame:
    """Member rows with ``ordinal``, their place in their cluster by composite id."""
    return ordered(members, F.col(COMPOSITE_ID), "cluster-lists")


@dataclass(frozen=True)
class Shaped:
    """Integrated records as published: one row per cluster, and its children in tables keyed by
    ``splink_id, ordinal``. A cluster without children of a kind has no rows there."""

    records: DataFrame
    alt_entities: DataFrame
    licenses: DataFrame


def shape(result: Integrated) -> Shaped:
    """The published shape, the same for clusters of every size."""
    entity = [f.name for f in ENTITY_TYPE]
    alt_rank = F.struct((-F.col("global_score")).alias("s"), F.col(COMPOSITE_ID).alias("k"))
    alternates = ordered(result.alternates, alt_rank, "alt-entities")
    licenses = ordered(result.licenses, F.struct("rank", "license_id"), "licenses")
    counts = result.licenses.groupBy(CLUSTER_ID).agg(F.count(F.lit(1)).alias("n_licenses"))
    records = result.records.join(counts, CLUSTER_ID, "left").select(
        F.col(CLUSTER_ID).alias("splink_id"), "has_id_conflict", "anchor_entity", "n_alternates",
        *[f for f in SURVIVING_FIELDS if f in result.records.columns],
        F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), "global_score",
    )
    return Shaped(
        records,
        alternates.select(F.col(CLUSTER_ID).alias("splink_id"), "ordinal", *entity),
        licenses.select(F.col(CLUSTER_ID).alias("splink_id"), "ordinal", "license_id", "expiration_date"),
    )


def alternates_histogram(records: DataFrame) -> DataFrame:
    """Clusters by number of alternates."""
    return records.groupBy("n_alternates").agg(F.count(F.lit(1)).alias("n_clusters"))


def merge_metrics(anchors: DataFrame) -> DataFrame:
    """Clusters merged and rejected."""
    failed = F.col("reject_reason").isNotNull()
    return anchors.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~failed).alias("success"), F.count_if(failed).alias("failure")
    )
