"""Data-quality rules bound to columns by glob pattern, evaluated in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, functions as F

SEVERITIES = ("critical", "warning", "info")


@dataclass(frozen=True)
class AuditRule:
    """``kind`` is unique, not_null, length_between or length_equals."""

    kind: str
    mostly: float = 1.0
    severity: str = "warning"
    low: int | None = None
    high: int | None = None
    column: str | None = None

    def __post_init__(self):
        if self.kind not in ("unique", "not_null", "length_between", "length_equals"):
            raise ValueError(f"unknown rule kind {self.kind!r}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"unknown severity {self.severity!r}")
        if not 0 <= self.mostly <= 1:
            raise ValueError("mostly must be between 0 and 1")

    def apply_to(self, column: str) -> "AuditRule":
        return replace(self, column=column)


@dataclass(frozen=True)
class RuleSet:
    patterns: tuple[str, ...]
    rules: tuple[AuditRule, ...]


# The standard rules, their shares and severities.
STANDARD_RULES = (
    RuleSet(("*_id",), (AuditRule("unique", 0.95, "warning"),)),
    RuleSet(("company_name",), (AuditRule("not_null", 1.0, "critical"), AuditRule("unique", 0.7, "warning"))),
    RuleSet(("company_name_normalized",), (AuditRule("not_null", 0.95, "critical"),)),
    RuleSet(("address_1",), (AuditRule("not_null", 0.3, "warning"),)),
    RuleSet(("zip_code", "postal_code"), (AuditRule("length_between", 0.8, "warning", 3, 12),)),
    RuleSet(("city",), (AuditRule("not_null", 0.7, "warning"),)),
)
# The identifiers that must be unique in their own source.
CRITICAL_IDS = {
    "business_entity_registry": "entity_id",
    "sub_contractors_registry": "vendor_id",
    "licenses_registry": "license_id",
}


def rules_for(source: str, additional: Sequence[RuleSet] = ()) -> tuple[RuleSet, ...]:
    own = CRITICAL_IDS.get(source)
    extra = (RuleSet((own,), (AuditRule("unique", 1.0, "critical"),)),) if own else ()
    return (*STANDARD_RULES, *extra, *additional)


def bind(columns: Sequence[str], sets: Sequence[RuleSet]) -> list[AuditRule]:
    """One bound rule per matching column and template, without repeats."""
    bound: dict[AuditRule, None] = {}
    for s in sets:
        if not s.patterns:
            raise ValueError(f"rule set without patterns: {s}")
        if not s.rules:
            raise ValueError(f"rule set without rules: {s}")
        for c in columns:
            if any(fnmatchcase(c, p) for p in s.patterns):
                bound.update({r.apply_to(c): None for r in s.rules})
    return list(bound)


def _passes(rule: AuditRule) -> Column:
    length = F.length(F.col(rule.column).cast("string"))
    if rule.kind == "length_between":
        return length.between(rule.low, rule.high)
    return length == rule.low


def audit(df: DataFrame, rules: Sequence[AuditRule]) -> DataFrame:
    """One result row per rule: share observed, share required, outcome.

    Row-wise rules share one aggregate. Uniqueness unpivots the audited columns into
    (column, value) and counts them in a single shuffle after map-side combining, whatever
    the number of columns, so a value that fills a third of a column is summed before it moves.
    """
    rules = list(rules)
    if not rules:
        raise ValueError("no audit rule matches")
    row_rules = [(i, r) for i, r in enumerate(rules) if r.kind != "unique"]
    unique_rules = [(i, r) for i, r in enumerate(rules) if r.kind == "unique"]
    parts = []
    if row_rules:
        aggregates = []
        for i, r in row_rules:
            c = F.col(r.column)
            if r.kind == "not_null":
                good, seen = F.count(c), F.count(F.lit(1))
            else:
                good, seen = F.count_if(_passes(r)), F.count(c)
            aggregates += [good.alias(f"g{i}"), seen.alias(f"s{i}")]
        wide = df.agg(*aggregates)
        pairs = [F.struct(F.lit(i).alias("rule"), F.col(f"g{i}").alias("good"), F.col(f"s{i}").alias("seen")) for i, _ in row_rules]
        parts.append(wide.select(F.explode(F.array(*pairs)).alias("x")).select("x.*"))
    if unique_rules:
        names = sorted({r.column for _, r in unique_rules})
        cells = F.explode(
            F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])
        ).alias("cell")
        counted = df.select(cells).select("cell.*").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        per_column = counted.groupBy("name").agg(
            F.coalesce(F.sum(F.when(F.col("value").isNotNull() & (F.col("n") == 1), F.col("n"))), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("seen"),
        )
        which = F.explode(
            F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.column).alias("name")) for i, r in unique_rules])
        ).alias("w")
        # from the rules, so that a table without rows has its results too
        wanted = df.sparkSession.range(1).select(which).select("w.rule", "w.name").join(per_column, "name", "left")
        parts.append(wanted.select("rule", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("seen", F.lit(0)).alias("seen")))
    counts = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    described = F.element_at(
        F.array(
            *[
                F.struct(
                    F.lit(r.column).alias("column"), F.lit(r.kind).alias("rule"), F.lit(float(r.mostly)).alias("mostly"),
                    F.lit(r.severity).alias("severity"),
                )
                for r in rules
            ]
        ),
        F.col("rule") + 1,
    )
    # nothing to judge (no rows or only nulls) counts as met
    observed = F.when(F.col("seen") == 0, 1.0).otherwise(F.col("good") / F.col("seen"))
    return counts.select(
        described.alias("d"), F.col("good").cast("bigint").alias("good"), F.col("seen").cast("bigint").alias("seen"),
        observed.alias("observed"),
    ).select("d.*", "good", "seen", "observed", (F.col("observed") >= F.col("d.mostly")).alias("success"))


def verdict(results: DataFrame) -> DataFrame:
    """Critical failures fail the audit; warnings and infos pass with a note."""
    failed = [F.count_if(~F.col("success") & (F.col("severity") == s)).alias(f"{s}_failures") for s in SEVERITIES]
    note = (
        F.when(F.col("critical_failures") > 0, "failed")
        .when(F.col("warning_failures") > 0, "passed_with_warnings")
        .when(F.col("info_failures") > 0, "passed_with_info")
        .otherwise("passed")
    )
    return results.agg(*failed).withColumn("outcome", note).withColumn("passed", F.col("critical_failures") == 0)
