"""Schema enforcement and the split into valid and rejected rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T

from recordloom.session import cut_lineage
from recordloom.specs import SourceSpec

REASONS = "reject_reasons"
METRICS = ("total", "success", "failure")


def enforce_schema(df: DataFrame, schema: T.StructType, safe: bool = False) -> DataFrame:
    """Declared columns in declared order and type; everything else is dropped.

    ``safe`` turns a value that does not fit into null instead of failing the job.
    """
    def fit(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        return (c.try_cast(f.dataType) if safe else c.cast(f.dataType)).alias(f.name)

    return df.select(*[fit(f) for f in schema])


def reject_reasons(rules: list[tuple[str, Column]]) -> Column:
    """Array with the code of every rule that a row breaks; a null condition breaks nothing."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(code)) for code, condition in rules]))


@dataclass(frozen=True)
class Validated:
    """``tagged`` holds raw, clean and reasons; the two outputs are filters over it."""

    tagged: DataFrame
    spec: SourceSpec
    counts: Mapping[str, int] | None = None

    def stored(self) -> "Validated":
        """The same over a written table. Both outputs and the metrics read it, so every row is
        cleaned once; without it each of them would clean the rows again, and a filter on the
        reasons would even do so twice. The metrics are observed while the rows are written."""
        seen = Observation(f"load-{self.spec.name}-{uuid.uuid4().hex}")
        stored = cut_lineage(self.tagged.observe(seen, *_counts(F.size(REASONS) == 0)), f"validated-{self.spec.name}")
        return Validated(stored, self.spec, {name: seen.get.get(name, 0) for name in METRICS})

    @property
    def valid(self) -> DataFrame:
        return self.tagged.where(F.size(REASONS) == 0).select("clean.*")

    @property
    def rejected(self) -> DataFrame:
        """Raw rows as they arrived, with their reasons."""
        return self.tagged.where(F.size(REASONS) > 0).select("raw.*", REASONS)

    def metrics(self) -> DataFrame:
        """One row of counts; those of stored rows need no pass of their own."""
        if self.counts is not None:
            facts = [F.lit(self.counts[name]).cast("bigint").alias(name) for name in METRICS]
            return self.tagged.sparkSession.range(1).select(*facts)
        return load_metrics(self.tagged, F.size(REASONS) == 0)


def validate(raw: DataFrame, spec: SourceSpec) -> Validated:
    """Clean and check every raw row in one projection, without a shuffle unless a lookup needs one."""
    originals = [c for c in raw.columns if c != "_corrupt_record"]
    df = raw.withColumn("raw", F.struct(*[F.col(f"`{c}`") for c in originals]))
    early = [(r.code, r.condition()) for r in spec.raw_rejects]
    if "_corrupt_record" in raw.columns:
        early.append(("corrupt_record", F.col("_corrupt_record").isNotNull()))
    early_codes = reject_reasons(early) if early else F.array().cast("array<string>")
    if spec.derived:
        df = df.withColumns({n: e() for n, e in spec.derived.items()})
    clean = df.select("raw", early_codes.alias("_early"), *[e().alias(n) for n, e in spec.columns.items()])
    for apply in spec.lookups:
        clean = apply(clean)
    rules = [(f"{c}_missing", F.col(c).isNull()) for c in spec.required()]
    rules += [(r.code, r.condition()) for r in spec.rejects]
    reasons = F.concat(F.col("_early"), reject_reasons(rules)) if rules else F.col("_early")
    shaped = clean.select(
        "raw",
        F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema]).alias("clean"),
        reasons.alias(REASONS),
    )
    return Validated(shaped, spec)


def _counts(is_valid: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), F.count_if(is_valid).alias("success"), F.count_if(~is_valid).alias("failure")]


def load_metrics(df: DataFrame, is_valid: Column) -> DataFrame:
    """Total, success and failure counts in one pass."""
    return df.agg(*_counts(is_valid))
