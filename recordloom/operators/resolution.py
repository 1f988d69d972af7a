"""From records to links: predict, cluster, and report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from recordloom.operators import cells
from recordloom.operators.blocking import (
    CELL_ROWS, COPIES, NODE, PACKED_ROWS, PID, BlockingRule, Key, PackedPairs, copy_pairs, hub_pairs, profile_pairs, without_implied,
)
from recordloom.operators.components import connected_components
from recordloom.operators.model import MatchModel, agreements, can_reach, comparison_vectors, required_equalities, score_pairs
from recordloom.operators.skew import heavy_keys, split_join
from recordloom.session import cut_lineage
from recordloom.settings import CLUSTER_ID, CLUSTER_THRESHOLD, DATA_SOURCE, PREDICT_THRESHOLD, UNIQUE_ID


def pruned_rules(rules: Sequence[BlockingRule], model: MatchModel, threshold: float) -> list[BlockingRule]:
    """Rules that find every pair able to reach ``threshold``, and as few others as the model alone can tell.

    When the model needs exact agreement on some column to get there, that column joins the
    block key. A hot prefix block is then never paired up as a whole: only its records that
    agree on a required column meet.
    """
    required = required_equalities(model, threshold)
    if not required:
        return []
    return without_implied([r.refined(s) for r in rules for s in required])


def rare_rules(rules: Sequence[BlockingRule], model: MatchModel, threshold: float) -> list[BlockingRule]:
    """:func:`pruned_rules` that also use the term frequencies of the rows.

    A pair agrees on one of the sets of :func:`agreements`, with values rare enough. Rows whose value
    is too frequent to carry a pair by itself meet only where they agree on a further column, so
    a hot value is not paired up as a whole either. A rule leaves out rows that a rule of fewer
    columns pairs already.
    """
    weighed = {c.column for c in model.comparisons if c.term_frequency}
    useful: list[tuple[frozenset[str], BlockingRule]] = []
    for equal, rare in agreements(model, threshold):
        # pairs that agree on more of the weighed columns than these have a set of their own
        fitting = [r.refined(equal) for r in rules if {k.column for k in r.keys if k.prefix is None} & weighed <= equal]
        for rule in without_implied(fitting):
            finders = [o for s, o in useful if s <= equal and rule.implies(o)]
            if all(o.rare for o in finders):
                useful.append((equal, replace(rule, rare=rare, unless=tuple(o.rare for o in finders))))
    return [rule for _, rule in useful]


def predict(
    profile_rows: DataFrame,
    rules: Sequence[BlockingRule],
    model: MatchModel,
    threshold: float = PREDICT_THRESHOLD,
    link_type: str = "link_and_dedupe",
    cell_rows: int = CELL_ROWS,
    apart: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Scored pairs of profiles (and of copies inside one) with probability of at least ``threshold``.

    Pairs are scored in the stage that joins them. Those that could not reach the threshold
    whatever their similarity fail the join condition; only the rest are measured in Python.
    Where the model asks for no exact agreement, every candidate is joined, so pairs lie packed in
    cells then, and only those that may reach the threshold are spelled out.
    With ``apart`` pairs of different profiles are left out that are alike in that column. ``l`` and ``r``
    are whole profiles, or have their columns ``keep``.
    """
    kept = profile_rows.columns if keep is None else list(keep)
    narrow = {side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in kept]) for side in "lr"}
    useful = rare_rules(rules, model, threshold)
    copies = copy_pairs(profile_rows, rules, link_type)
    if not useful:
        return _matching(copies, model, threshold).withColumns(narrow)
    if frozenset() not in required_equalities(model, threshold):
        return _matching(profile_pairs(profile_rows, useful, link_type, cell_rows, apart).unionByName(copies), model, threshold).withColumns(narrow)
    pairs = PackedPairs(profile_rows, tuple(useful), link_type, max(cell_rows, PACKED_ROWS), apart)
    # the frequencies are needed for the weights alone
    told = dict.fromkeys([*kept, *[f"tf_{c.column}" for c in model.comparisons if c.term_frequency]])
    scored = score_pairs(cells.reaching(pairs, model, threshold, list(told)), model).where(F.col("match_probability") >= threshold)
    return scored.withColumns(narrow).unionByName(_matching(copies, model, threshold).withColumns(narrow))


def _matching(pairs: DataFrame, model: MatchModel, threshold: float) -> DataFrame:
    pairs = pairs.where(can_reach(model, threshold))
    scored = score_pairs(comparison_vectors(pairs, model.comparisons), model)
    return scored.where(F.col("match_probability") >= threshold)


def spanning_predictions(
    profile_rows: DataFrame, rules: Sequence[BlockingRule], model: MatchModel, threshold: float = CLUSTER_THRESHOLD
) -> DataFrame:
    """``l, r, match_probability``: pairs of :func:`predict` that connect the same profiles as all of them.

    The matches in a block of a value grow with its square, but clusters need no more than what connects it.
    So rows are first scored with the hubs of their groups alone, those alike in the columns without term
    frequencies, then also in the prefixes of the rules. After that come all pairs of the rules whose ends
    these matches have not connected yet. Copies inside a profile are all told.
    """
    useful = rare_rules(rules, model, threshold)
    ends = [*[F.struct(F.col(f"{side}.{PID}").alias(PID)).alias(side) for side in "lr"], "match_probability"]
    if not useful:
        return predict(profile_rows, rules, model, threshold, keep=(PID,)).select(*ends)
    plain = [Key(c.column) for c in model.comparisons if not c.term_frequency]
    prefixes = sorted({k for r in rules for k in r.keys if k.prefix is not None}, key=lambda k: (k.column, k.prefix))
    near = hub_pairs(profile_rows, useful, [c.column for c in model.comparisons], [plain, [*plain, *prefixes]])
    spokes = cut_lineage(_matching(near, model, threshold).select(*ends), "hub-predictions")
    known = connected_components(spokes.select(F.col(f"l.{PID}").alias("a"), F.col(f"r.{PID}").alias("b")), "a", "b")
    placed = profile_rows.join(known.withColumnRenamed("node", PID), PID, "left").withColumn("component", F.coalesce("component", PID))
    rest = predict(cut_lineage(placed, "placed"), rules, model, threshold, apart="component", keep=(PID,)).select(*ends)
    return spokes.unionByName(rest)


def cluster(
    profile_rows: DataFrame, predictions: DataFrame, threshold: float = CLUSTER_THRESHOLD
) -> DataFrame:
    """``(pid, cluster_id)``: connected profiles share the least node id of their component.

    ``cluster_id`` is null for a profile whose copies match neither each other nor any other
    profile: each of its records is a cluster of its own.
    """
    matches = predictions.where(F.col("match_probability") >= threshold).select(
        F.col(f"l.{PID}").alias("a"), F.col(f"r.{PID}").alias("b")
    )
    components = connected_components(matches, "a", "b")
    copies_match = matches.where(F.col("a") == F.col("b")).select(F.col("a").alias(PID), F.lit(True).alias("_same"))
    placed = (
        profile_rows.select(PID, COPIES, "first_node")
        .join(components.withColumnRenamed("node", PID), PID, "left")
        .join(copies_match, PID, "left")
    )
    named = components.join(profile_rows.select(F.col(PID).alias("node"), "first_node"), "node").groupBy("component").agg(
        F.min("first_node").alias("_name"), F.count(F.lit(1)).alias("_size")
    )
    alone = F.when(F.coalesce("_same", F.lit(False)) | (F.col(COPIES) == 1), F.col("first_node"))
    # most profiles match nothing and have no component; a component may hold any part of the others
    joined = split_join(placed, named.drop("_size"), "component", heavy_keys(named, "component", "_size"), [PID], "left")
    return joined.select(PID, F.coalesce("_name", alone).alias(CLUSTER_ID))


def links(identified: DataFrame, clusters: DataFrame, key_names: Mapping[str, str]) -> DataFrame:
    """One row per record: its cluster, key value, key column name and source."""
    names = F.create_map(*[F.lit(x) for pair in key_names.items() for x in pair])
    return (
        identified.select(PID, NODE, UNIQUE_ID, DATA_SOURCE)
        .join(clusters, PID, "left")
        .select(
            F.coalesce(CLUSTER_ID, NODE).alias(CLUSTER_ID),
            F.col(UNIQUE_ID).alias("primary_key_id"),
            F.try_element_at(names, F.col(DATA_SOURCE)).alias("primary_key_type"),
            DATA_SOURCE,
        )
    )


def expand_pairs(predictions: DataFrame, identified: DataFrame) -> DataFrame:
    """Record-level pairs behind folded predictions, for callers that want them spelled out.

    The output has ``n_pairs`` rows per input row, so it is as large as the answer it spells out.
    """
    left = identified.select(F.col(PID).alias("pid_l"), F.col(NODE).alias("node_l"))
    right = identified.select(F.col(PID).alias("pid_r"), F.col(NODE).alias("node_r"))
    keyed = predictions.select(
        F.col(f"l.{PID}").alias("pid_l"), F.col(f"r.{PID}").alias("pid_r"), "match_weight", "match_probability"
    )
    return keyed.join(left, "pid_l").join(right, "pid_r").where(
        (F.col("pid_l") != F.col("pid_r")) | (F.col("node_l") < F.col("node_r"))
    ).select("node_l", "node_r", "match_weight", "match_probability")


def overlap_report(link_rows: DataFrame) -> DataFrame:
    """Clusters per combination of sources. The set per cluster is bounded by the number of sources."""
    signature = F.array_join(F.array_sort(F.collect_set(DATA_SOURCE)), " + ").alias("sources")
    return link_rows.groupBy(CLUSTER_ID).agg(signature).groupBy("sources").agg(F.count(F.lit(1)).alias("n_clusters"))


def record_counts(link_rows: DataFrame) -> DataFrame:
    """Records per source plus the total (source null)."""
    return link_rows.rollup(DATA_SOURCE).agg(F.count(F.lit(1)).alias("n_records"))


def linkage_summary(link_rows: DataFrame) -> DataFrame:
    """Records, links, clusters and the linkage rate (0 for no records), in one shuffle of cluster sizes."""
    sizes = link_rows.groupBy(CLUSTER_ID).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("links_count"), F.count(F.lit(1)).alias("clusters_count"))
    rate = F.when(
        F.col("links_count") > 0, (F.col("links_count") - F.col("clusters_count")) / F.col("links_count")
    ).otherwise(0.0)
    return totals.withColumn("linkage_rate", rate)


def cluster_sizes(link_rows: DataFrame) -> DataFrame:
    """Histogram of cluster sizes: the first place where over-merging shows."""
    sizes = link_rows.groupBy(CLUSTER_ID).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n_clusters"))
