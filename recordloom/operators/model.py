"""Comparisons and the parameters of the match model (Fellegi and Sunter 1969)."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordloom.functions.similarity import jaro_winkler_above, similarity_upper_bound
from recordloom.operators.blocking import PID, PackedPairs, Rarity
from recordloom.operators.skew import heavy_keys, split_join

PROBABILITY_FLOOR = 1e-6


@dataclass(frozen=True)
class Comparison:
    """Ordinal agreement on one column. Level -1 is a missing value, 0 disagreement, the highest exact."""

    column: str
    thresholds: tuple[float, ...] = ()
    term_frequency: bool = False

    @property
    def exact_level(self) -> int:
        return len(self.thresholds) + 1

    @property
    def levels(self) -> range:
        return range(self.exact_level + 1)

    @property
    def gamma(self) -> str:
        return f"gamma_{self.column}"

    def similarity(self, left: Column, right: Column) -> Column:
        return jaro_winkler_above(left, right, min(self.thresholds))

    def level(self, left: Column, right: Column, similarity: Column | None = None) -> Column:
        ladder = F.when(left.isNull() | right.isNull(), -1).when(left == right, self.exact_level)
        for i, t in enumerate(sorted(self.thresholds, reverse=True)):
            ladder = ladder.when(similarity >= t, self.exact_level - 1 - i)
        return ladder.otherwise(0).cast("int")


def exact_match(column: str, term_frequency: bool = False) -> Comparison:
    return Comparison(column, (), term_frequency)


def jaro_winkler_at(column: str, thresholds: Sequence[float] = (0.9, 0.7), term_frequency: bool = False) -> Comparison:
    return Comparison(column, tuple(thresholds), term_frequency)


@dataclass(frozen=True)
class MatchModel:
    """``parameters[column][level] = (m, u)``; either may be missing when it was never trained.
    ``sessions`` names the training rules with the rounds they took and whether they settled."""

    comparisons: tuple[Comparison, ...]
    prior: float
    parameters: Mapping[str, Mapping[int, tuple[float | None, float | None]]]
    sessions: tuple[tuple[str, int, bool], ...] = ()

    def log_factor(self, comparison: Comparison, level: int) -> float:
        """log2(m/u); an untrained level says nothing."""
        m, u = self.parameters.get(comparison.column, {}).get(level, (None, None))
        if m is None or u is None:
            return 0.0
        return math.log2(max(m, PROBABILITY_FLOOR) / max(u, PROBABILITY_FLOOR))

    @property
    def prior_weight(self) -> float:
        return math.log2(self.prior / (1 - self.prior))

    def untrained(self) -> list[tuple[str, int]]:
        return [
            (c.column, g)
            for c in self.comparisons
            for g in c.levels
            if None in self.parameters.get(c.column, {}).get(g, (None, None))
        ]

    def to_json(self) -> str:
        return json.dumps(
            {
                "prior": self.prior,
                "sessions": [list(s) for s in self.sessions],
                "comparisons": [
                    {
                        "column": c.column,
                        "thresholds": list(c.thresholds),
                        "term_frequency": c.term_frequency,
                        "levels": {str(g): list(self.parameters.get(c.column, {}).get(g, (None, None))) for g in c.levels},
                    }
                    for c in self.comparisons
                ],
            },
            indent=4,
        )

    @classmethod
    def from_json(cls, document: str) -> "MatchModel":
        data = json.loads(document)
        comparisons = tuple(
            Comparison(c["column"], tuple(c["thresholds"]), c["term_frequency"]) for c in data["comparisons"]
        )
        parameters = {c["column"]: {int(g): tuple(mu) for g, mu in c["levels"].items()} for c in data["comparisons"]}
        return cls(comparisons, data["prior"], parameters, tuple(tuple(s) for s in data.get("sessions", [])))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (c.column, g, *self.parameters.get(c.column, {}).get(g, (None, None))) for c in self.comparisons for g in c.levels
        ]
        return spark.createDataFrame(rows, "comparison string, level int, m double, u double")


def save_model(spark: SparkSession, model: MatchModel, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> MatchModel:
    return MatchModel.from_json(spark.read.text(path, wholetext=True).first()["value"])


def comparison_vectors(pairs: DataFrame | PackedPairs, comparisons: Sequence[Comparison]) -> DataFrame:
    """Add one level column per comparison to pairs with sides ``l`` and ``r``.

    Packed pairs are told with their ids alone in ``l`` and ``r``.
    """
    if isinstance(pairs, PackedPairs):
        from recordloom.operators import cells  # which reads this module

        copies = comparison_vectors(pairs.copies(), comparisons)
        ids = [F.struct(F.col(f"{side}.{PID}").alias(PID)).alias(side) for side in "lr"]
        return cells.vectors(pairs, comparisons).unionByName(copies.select("rule", *ids, "n_pairs", *[c.gamma for c in comparisons]))
    fuzzy = [c for c in comparisons if c.thresholds]
    sides = {c: (F.col(f"l.{c.column}"), F.col(f"r.{c.column}")) for c in comparisons}
    measured = pairs.withColumns({f"_sim_{c.column}": c.similarity(*sides[c]) for c in fuzzy}) if fuzzy else pairs
    levels = {c.gamma: c.level(*sides[c], F.col(f"_sim_{c.column}") if c.thresholds else None) for c in comparisons}
    return measured.withColumns(levels).drop(*[f"_sim_{c.column}" for c in fuzzy])


def can_reach(model: MatchModel, threshold: float) -> Column:
    """False only for pairs that no similarity score could lift to ``threshold``.

    Everything known without string similarity (missing, exact, lengths, term frequencies) is
    taken as it is, the rest at its most favourable. It runs inside the join, before Python.
    """
    best = F.lit(model.prior_weight)
    for c in model.comparisons:
        left, right = F.col(f"l.{c.column}"), F.col(f"r.{c.column}")
        exact = F.lit(model.log_factor(c, c.exact_level))
        if c.term_frequency:
            exact = exact + _frequency_bonus(model, c)
        reachable = model.log_factor(c, 0)
        other = F.lit(reachable)
        ladder = None
        for g, t in zip(range(1, c.exact_level), sorted(c.thresholds)):
            reachable = max(reachable, model.log_factor(c, g))
            bound = similarity_upper_bound(left, right) >= t
            ladder = F.when(bound, F.lit(reachable)).otherwise(other if ladder is None else ladder)
        best = best + F.when(left.isNull() | right.isNull(), 0.0).when(left == right, exact).otherwise(
            other if ladder is None else ladder
        )
    needed = math.log2(threshold / (1 - threshold)) if threshold > 0 else -1e300
    return best >= F.lit(needed - 1e-9)


def _frequency_bonus(model: MatchModel, c: Comparison) -> Column:
    """log2(u / larger term frequency) of an exact agreement."""
    _, u = model.parameters.get(c.column, {}).get(c.exact_level, (None, None))
    if u is None:
        return F.lit(0.0)
    tf = F.greatest(F.col(f"l.tf_{c.column}"), F.col(f"r.tf_{c.column}"))
    return F.coalesce(F.log2(F.lit(u) / tf), F.lit(0.0))


def term_frequencies(records: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Share of each value among the non-null ones."""
    n = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    counts = records.where(F.col(column).isNotNull()).groupBy(column).agg(n.alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, (F.col("n") / total).alias(f"tf_{column}"))


def with_term_frequencies(profile_rows: DataFrame, comparisons: Sequence[Comparison], weight: str) -> DataFrame:
    """Attach term frequencies to profiles, before pairing, so pairs carry them for free.

    Profiles without a value, often most of them, and those of a very common one are split.
    """
    own = profile_rows
    for c in comparisons:
        if c.term_frequency:
            rows = own.groupBy(c.column).agg(F.count(F.lit(1)).alias("_rows"))
            frequencies = term_frequencies(own, c.column, weight)
            profile_rows = split_join(profile_rows, frequencies, c.column, heavy_keys(rows, c.column, "_rows"), ["pid"], "left")
    return profile_rows


def score_pairs(vectors: DataFrame, model: MatchModel) -> DataFrame:
    """Add the factor per comparison, ``match_weight`` and ``match_probability``."""
    factors = {}
    for c in model.comparisons:
        ladder = F.lit(0.0)
        for g in c.levels:
            ladder = F.when(F.col(c.gamma) == g, F.lit(model.log_factor(c, g))).otherwise(ladder)
        factors[f"bf_{c.column}"] = ladder
        if c.term_frequency:
            bonus = F.when(F.col(c.gamma) == c.exact_level, _frequency_bonus(model, c)).otherwise(0.0)
            factors[f"tf_adjustment_{c.column}"] = bonus
    scored = vectors.withColumns(factors)
    weight = reduce(lambda a, b: a + b, [F.col(name) for name in factors], F.lit(model.prior_weight))
    scored = scored.withColumn("match_weight", weight)
    return scored.withColumn("match_probability", F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.0), -F.col("match_weight"))))


def required_equalities(model: MatchModel, threshold: float) -> list[frozenset[str]]:
    """Minimal column sets of which one must agree exactly in any pair that reaches ``threshold``.

    The model has at most a few hundred level patterns. Those that can pass (counting any
    term-frequency bonus as unlimited) are listed, and the exact columns of each collected.
    An empty set means some pattern passes without exact agreement: nothing can be pruned.
    """
    needed = needed_weight(threshold)
    found: set[frozenset[str]] = set()
    for levels in product(*[(-1, *c.levels) for c in model.comparisons]):
        weight, equal = model.prior_weight, set()
        for c, g in zip(model.comparisons, levels):
            if g < 0:
                continue
            weight += model.log_factor(c, g)
            if g == c.exact_level:
                equal.add(c.column)
                if c.term_frequency:
                    weight = math.inf
        if weight >= needed - 1e-9:
            found.add(frozenset(equal))
    return _minimal(found)


def needed_weight(threshold: float) -> float:
    """Match weight of the probability ``threshold``."""
    return math.log2(threshold / (1 - threshold)) if threshold > 0 else -math.inf


def _minimal(sets: set[frozenset[str]]) -> list[frozenset[str]]:
    return sorted((s for s in sets if not any(o < s for o in sets)), key=lambda s: (len(s), sorted(s)))


def agreements(model: MatchModel, threshold: float) -> list[tuple[frozenset[str], Rarity | None]]:
    """Column sets, each with the rarity that its values must have, by which pairs reach ``threshold``.

    Of the columns with term frequencies, a pair agrees exactly on some set. As equal values have one
    frequency, the row alone tells the most that a pair can weigh which agrees on just this set: exact
    factors and bonuses there, the best inexact level of the others, the best level of columns without
    frequencies. So a frequent value is no reason to pair all rows that have it. Sets come by size.
    Pairs without any such agreement have the columns that :func:`required_equalities` names, if they can pass.
    """
    weighed = [c for c in model.comparisons if c.term_frequency]
    plain = [c for c in model.comparisons if not c.term_frequency]
    needed = needed_weight(threshold)
    names = {c.column for c in weighed}
    out = [(s, None) for s in required_equalities(model, threshold) if not s & names]
    best = sum(max(0.0, *(model.log_factor(c, g) for g in c.levels)) for c in plain)
    for own in sorted(product((False, True), repeat=len(weighed)), key=lambda x: (sum(x), x)):
        if not any(own):
            continue
        weight, values = model.prior_weight + best, []
        for c, equal in zip(weighed, own):
            if equal:
                weight += model.log_factor(c, c.exact_level)
                _, u = model.parameters.get(c.column, {}).get(c.exact_level, (None, None))
                if u is not None:
                    values.append((f"tf_{c.column}", u))
            else:
                weight += max(0.0, *(model.log_factor(c, g) for g in range(c.exact_level)))
        # no frequency is above 1
        always = weight + sum(math.log2(u) for _, u in values) >= needed - 1e-9
        if values or always:
            out.append((frozenset(c.column for c, equal in zip(weighed, own) if equal), None if always else Rarity(needed - weight - 1e-9, tuple(values))))
    return out
