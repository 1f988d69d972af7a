"""Entity resolution over the document registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators import blocking, model, resolution, training
from recordloom.session import cut_lineage
from recordloom.settings import MAX_RANDOM_PAIRS
from recordloom.suite import corpus
from recordloom.suite.base import query

_GAMMAS = [c.gamma for c in corpus.COMPARISONS]


def _ids():
    return F.col("l.pid").alias("pid_l"), F.col("r.pid").alias("pid_r")



def _stats_sql() -> str:
    parts = [
        f"""SELECT '{r.name}' AS rule, {', '.join(f"{k.name}::VARCHAR AS k{i}" for i, k in enumerate(r.keys))}{''.join(f", NULL AS k{i}" for i in range(len(r.keys), 3))},
            count(*) AS n_rows FROM nodes WHERE {corpus._present_sql(r)} GROUP BY ALL"""
        for r in corpus.BLOCKING
    ]
    return f"""WITH {corpus.ALL_SQL}, s AS ({' UNION ALL '.join(parts)})
        SELECT rule, n_rows, n_rows * (n_rows - 1) // 2 AS n_pairs, count(*) AS n_blocks FROM s GROUP BY 1, 2"""


@query("block_stats", _stats_sql())
def block_stats(spark, sf_dir):
    """Histogram of block sizes per rule."""
    stats = blocking.block_statistics(corpus.records(spark, sf_dir), corpus.BLOCKING)
    return stats.groupBy("rule", "n_rows", "n_pairs").agg(F.count(F.lit(1)).alias("n_blocks"))


@query("candidate_pairs", f"WITH {corpus.pairs_sql()} SELECT rule, pid_l, pid_r, n_pairs FROM pairs")
def candidate_pairs(spark, sf_dir):
    """Folded candidate pairs; the weights add up to the number of record pairs."""
    pairs = blocking.all_pairs(corpus.stored_profiles(spark, sf_dir), corpus.BLOCKING)
    return pairs.select("rule", *_ids(), "n_pairs")


@query("candidate_pairs_sliced", f"WITH {corpus.pairs_sql()} SELECT rule, pid_l, pid_r, n_pairs FROM pairs")
def candidate_pairs_sliced(spark, sf_dir):
    """The same with hot blocks spread over cells of at most 8 rows a side."""
    pairs = blocking.all_pairs(corpus.stored_profiles(spark, sf_dir), corpus.BLOCKING, cell_rows=8)
    return pairs.select("rule", *_ids(), "n_pairs")


@query(
    "pairs_across_sources",
    f"""WITH {corpus.pairs_sql(by_source=True, on='AND l.data_source <> r.data_source')}
    SELECT rule, pid_l, pid_r, n_pairs FROM pairs""",
)
def pairs_across_sources(spark, sf_dir):
    rows = corpus.stored_profiles(spark, sf_dir, "link")
    return blocking.all_pairs(rows, corpus.BLOCKING, "link").select("rule", *_ids(), "n_pairs")


@query(
    "pairs_within_sources",
    f"""WITH {corpus.pairs_sql(by_source=True, on='AND l.data_source = r.data_source')}
    SELECT rule, pid_l, pid_r, n_pairs FROM pairs""",
)
def pairs_within_sources(spark, sf_dir):
    rows = corpus.stored_profiles(spark, sf_dir, "dedupe")
    return blocking.all_pairs(rows, corpus.BLOCKING, "dedupe").select("rule", *_ids(), "n_pairs")


@query(
    "deterministic_pairs",
    f"WITH {corpus.pairs_sql(corpus.DETERMINISTIC)} SELECT rule, CAST(sum(n_pairs) AS BIGINT) AS n_pairs FROM pairs GROUP BY 1",
)
def deterministic_pairs(spark, sf_dir):
    return blocking.count_pairs(blocking.all_pairs(corpus.stored_profiles(spark, sf_dir), corpus.DETERMINISTIC))


_TF_COLUMNS = ("entity_id", "company_name_normalized", "address_1")


@query(
    "term_frequencies",
    f"WITH {corpus.profiles_sql()} "
    + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS value, round(tf, 12) AS tf FROM tf_{c}" for c in _TF_COLUMNS),
)
def term_frequencies(spark, sf_dir):
    records = corpus.records(spark, sf_dir)
    parts = [
        model.term_frequencies(records, c).select(
            F.lit(c).alias("name"), F.col(c).alias("value"), F.round(f"tf_{c}", 12).alias("tf")
        )
        for c in _TF_COLUMNS
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("comparison_vectors", f"WITH {corpus.vectors_sql()} SELECT pid_l, pid_r, {', '.join(_GAMMAS)} FROM vec")
def comparison_vectors(spark, sf_dir):
    pairs = blocking.all_pairs(corpus.stored_profiles(spark, sf_dir), corpus.BLOCKING, packed=True)
    return model.comparison_vectors(pairs, corpus.COMPARISONS).select(*_ids(), *_GAMMAS)


@query(
    "pattern_counts",
    f"WITH {corpus.vectors_sql()} SELECT {', '.join(_GAMMAS)}, CAST(sum(n_pairs) AS BIGINT) AS n FROM vec GROUP BY ALL",
)
def pattern_counts(spark, sf_dir):
    pairs = blocking.all_pairs(corpus.stored_profiles(spark, sf_dir), corpus.BLOCKING, packed=True)
    return training.pattern_counts(pairs, corpus.COMPARISONS)


def _scored_profiles(spark, sf_dir, frames=None):
    return cut_lineage(corpus.profile_rows(spark, sf_dir, term_frequencies=True, frames=frames), "profiles")


def _predictions(spark, sf_dir, threshold=0.01, frames=None):
    rows = _scored_profiles(spark, sf_dir, frames)
    return rows, resolution.predict(rows, corpus.BLOCKING, corpus.MODEL, threshold, keep=("pid",))


@query(
    "match_scores",
    f"""WITH {corpus.scores_sql()} SELECT pid_l, pid_r, round(match_weight, 6) AS match_weight,
        round(match_probability, 9) AS match_probability, n_pairs, {', '.join(_GAMMAS)} FROM scored WHERE match_probability >= 0.01""",
)
def match_scores(spark, sf_dir):
    _, scored = _predictions(spark, sf_dir)
    return scored.select(
        *_ids(), F.round("match_weight", 6).alias("match_weight"), F.round("match_probability", 9).alias("match_probability"),
        F.col("n_pairs").cast("bigint").alias("n_pairs"), *_GAMMAS,
    )


@query(
    "strong_matches",
    f"""WITH {corpus.scores_sql()} SELECT pid_l, pid_r, round(match_probability, 9) AS match_probability FROM scored
        WHERE match_probability >= 0.9999""",
)
def strong_matches(spark, sf_dir):
    """At a high threshold the model demands exact agreement, which joins the block keys."""
    _, scored = _predictions(spark, sf_dir, 0.9999)
    return scored.select(*_ids(), F.round("match_probability", 9).alias("match_probability"))


@query(
    "expanded_pairs",
    f"""WITH {corpus.scores_sql()}
    SELECT least(a.node_id, b.node_id) AS node_l, greatest(a.node_id, b.node_id) AS node_r, round(match_weight, 6) AS match_weight
    FROM scored JOIN nodes a ON a.pid = pid_l JOIN nodes b ON b.pid = pid_r
    WHERE match_probability >= 0.9 AND (pid_l <> pid_r OR a.node_id < b.node_id)""",
)
def expanded_pairs(spark, sf_dir):
    """Matches spelled out per record pair."""
    frames = corpus.stored_snapshots(spark, sf_dir)
    _, scored = _predictions(spark, sf_dir, 0.9, frames)
    pairs = resolution.expand_pairs(scored, corpus.records(spark, sf_dir, frames=frames))
    return pairs.select(
        F.least("node_l", "node_r").alias("node_l"), F.greatest("node_l", "node_r").alias("node_r"),
        F.round("match_weight", 6).alias("match_weight"),
    )


@query(
    "prior_estimate",
    f"""WITH {corpus.pairs_sql(corpus.DETERMINISTIC)}
    SELECT n_deterministic, n_possible, round(n_deterministic / 0.7 / n_possible, 12) AS prior FROM
      (SELECT CAST(sum(n_pairs) AS BIGINT) AS n_deterministic FROM pairs),
      (SELECT count(*) * (count(*) - 1) // 2 AS n_possible FROM nodes)""",
)
def prior_estimate(spark, sf_dir):
    out = training.estimate_prior(
        corpus.records(spark, sf_dir), corpus.stored_profiles(spark, sf_dir), corpus.DETERMINISTIC
    )
    return out.withColumn("prior", F.round("prior", 12))


def _drawn_sql() -> str:
    """Pairs of the records whose digest draws them, with their levels."""
    sides = ", ".join(f"l.{c} AS {c}_l, r.{c} AS {c}_r" for c in corpus.COLUMNS)
    levels = ", ".join(f"CAST({corpus.level_sql(c)} AS INTEGER) AS {c.gamma}" for c in corpus.COMPARISONS)
    return f"""{corpus.ALL_SQL},
    drawn AS (SELECT * FROM nodes WHERE ('0x' || substr(md5('u/' || node_id), 1, 13))::BIGINT
        < floor(least(1.0::DOUBLE, sqrt(2.0::DOUBLE * {MAX_RANDOM_PAIRS}) / (SELECT count(*) FROM nodes)) * {1 << 52})),
    vec AS (SELECT {levels} FROM (SELECT {sides} FROM drawn l JOIN drawn r ON l.node_id < r.node_id)),
    n AS ({" UNION ALL ".join(f"SELECT '{c.column}' AS comparison, {c.gamma} AS level, count(*) AS n FROM vec WHERE {c.gamma} >= 0 GROUP BY 2" for c in corpus.COMPARISONS)})"""


@query("u_estimate", f"""WITH {_drawn_sql()} SELECT comparison, level, n, round(n / sum(n) OVER (PARTITION BY comparison), 12) AS u FROM n""")
def u_estimate(spark, sf_dir):
    """Level shares among random pairs."""
    records = cut_lineage(corpus.records(spark, sf_dir).select("node_id", *corpus.COLUMNS), "records")
    pairs = training.random_pairs(records, corpus.COLUMNS, records.count())
    return training.level_shares(model.comparison_vectors(pairs, corpus.COMPARISONS), corpus.COMPARISONS).withColumn("u", F.round("u", 12))


_STEP_RULE = corpus.TRAINING[0]
_STEP_FREE = [c for c in corpus.COMPARISONS if c.column not in _STEP_RULE.columns()]
_STEP_PRIOR = 0.1


def _step_u(c):
    return {g: u for g, (_, u) in corpus.MODEL.parameters[c.column].items()}


def _em_step_sql() -> str:
    start = training.start_values(_STEP_FREE)

    def chance(values_of) -> str:
        cases = []
        for c in _STEP_FREE:
            ladder = " ".join(f"WHEN {g} THEN {max(v, model.PROBABILITY_FLOOR)!r}::DOUBLE" for g, v in values_of(c).items())
            cases.append(f"(CASE {c.gamma} {ladder} ELSE 1.0::DOUBLE END)")
        return " * ".join(cases)

    levels = " UNION ALL ".join(f"SELECT '{c.column}' AS comparison, {g} AS level" for c in _STEP_FREE for g in c.levels)
    cells = " UNION ALL ".join(f"SELECT '{c.column}' AS comparison, {c.gamma} AS level, w, n FROM weighed WHERE {c.gamma} >= 0" for c in _STEP_FREE)
    gammas = ", ".join(c.gamma for c in _STEP_FREE)
    return f"""WITH {corpus.vectors_sql([_STEP_RULE])},
    pat AS (SELECT {gammas}, sum(n_pairs)::BIGINT AS n FROM vec GROUP BY ALL),
    ch AS (SELECT *, {_STEP_PRIOR}::DOUBLE * {chance(lambda c: start[c.column])} AS a, {1 - _STEP_PRIOR}::DOUBLE * {chance(_step_u)} AS b FROM pat),
    weighed AS (SELECT *, a / (a + b) * n AS w FROM ch),
    total AS (SELECT sum(w) / sum(n) AS prior, sum(n * ln(a + b)) AS log_likelihood FROM weighed),
    cells AS ({cells}),
    sums AS (SELECT comparison, level, sum(w) AS w, sum(n)::BIGINT AS n FROM cells GROUP BY 1, 2)
    SELECT l.comparison, l.level, round(coalesce(w, 0) / (SELECT sum(w) FROM sums s WHERE s.comparison = l.comparison), 9) AS m, coalesce(n, 0)::BIGINT AS n,
        round(prior, 9) AS prior, round(log_likelihood, 3) AS log_likelihood
    FROM ({levels}) l LEFT JOIN sums USING (comparison, level), total"""


@query("em_step", _em_step_sql())
def em_step(spark, sf_dir):
    """One round of training over the pairs of the first training rule."""
    pairs = blocking.all_pairs(corpus.stored_profiles(spark, sf_dir), [_STEP_RULE])
    patterns = cut_lineage(training.pattern_counts(pairs, _STEP_FREE), "patterns")
    u = {c.column: _step_u(c) for c in _STEP_FREE}
    found = training.em_step(patterns, _STEP_FREE, training.start_values(_STEP_FREE), u, _STEP_PRIOR)
    return found.withColumns({"m": F.round("m", 9), "prior": F.round("prior", 9), "log_likelihood": F.round("log_likelihood", 3)})


@query("em_train")
def em_train(spark, sf_dir):
    """A whole training run; the result is the parameter table."""
    records = cut_lineage(corpus.records(spark, sf_dir).select("node_id", "pid", "data_source", *corpus.COLUMNS), "records")
    rows = cut_lineage(blocking.profiles(records, corpus.COLUMNS), "profiles")
    trained = training.train(records, rows, corpus.COMPARISONS, corpus.DETERMINISTIC, corpus.TRAINING)
    return trained.to_frame(spark)


def link_rows(spark, sf_dir, frames=None):
    frames = frames or corpus.stored_snapshots(spark, sf_dir)
    rows = _scored_profiles(spark, sf_dir, frames)
    # clusters need no more pairs than connect them, and of a pair its ends and probability
    scored = cut_lineage(resolution.spanning_predictions(rows, corpus.BLOCKING, corpus.MODEL, 0.9), "predictions")
    placed = resolution.cluster(rows, scored, 0.9)
    return resolution.links(corpus.records(spark, sf_dir, frames=frames), placed, corpus.KEYS)


@query("links", f"WITH {corpus.links_sql()} SELECT cluster_id, primary_key_id, primary_key_type, data_source FROM links")
def links(spark, sf_dir):
    return link_rows(spark, sf_dir)


@query(
    "clusters",
    f"WITH {corpus.links_sql()} SELECT cluster_id, count(*) AS n_records, count(DISTINCT data_source) AS n_sources FROM links GROUP BY 1",
)
def clusters(spark, sf_dir):
    return link_rows(spark, sf_dir).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("data_source").alias("n_sources")
    )


@query(
    "overlap_report",
    f"""WITH {corpus.links_sql()}, s AS (SELECT cluster_id, string_agg(DISTINCT data_source, ' + ' ORDER BY data_source) AS sources FROM links GROUP BY 1)
    SELECT sources, count(*) AS n_clusters FROM s GROUP BY 1""",
)
def overlap_report(spark, sf_dir):
    return resolution.overlap_report(link_rows(spark, sf_dir))


@query(
    "linkage_rate",
    f"""WITH {corpus.links_sql()} SELECT count(*) AS links_count, count(DISTINCT cluster_id) AS clusters_count,
        round((count(*) - count(DISTINCT cluster_id)) / count(*), 9) AS linkage_rate FROM links""",
)
def linkage_rate(spark, sf_dir):
    return resolution.linkage_summary(link_rows(spark, sf_dir)).withColumn("linkage_rate", F.round("linkage_rate", 9))


@query(
    "cluster_sizes",
    f"WITH {corpus.links_sql()}, s AS (SELECT count(*) AS size FROM links GROUP BY cluster_id) SELECT size, count(*) AS n_clusters FROM s GROUP BY 1",
)
def cluster_sizes(spark, sf_dir):
    return resolution.cluster_sizes(link_rows(spark, sf_dir))


@query(
    "record_counts",
    f"WITH {corpus.ALL_SQL} SELECT data_source, count(*) AS n_records FROM nodes GROUP BY ROLLUP (data_source)",
)
def record_counts(spark, sf_dir):
    return resolution.record_counts(corpus.records(spark, sf_dir))
