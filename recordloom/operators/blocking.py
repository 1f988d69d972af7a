"""Candidate pairs for entity resolution.

Two ideas keep pair generation from growing with copies and hot blocks:

* Records are first folded into *profiles*: one row per distinct combination of compared
  values, with the number of records behind it. Any two records of a profile compare the
  same way, so a group of copies of any size costs one row and no pairs.
* A block that is still large is spread over a grid of cells of about ``cell_rows`` rows from
  either side, and every pair meets in exactly one cell. Rules with many pairs are joined in as
  many tasks as their pairs ask for, since the few bytes of a hot block say nothing of its work.

Nothing is capped or dropped: the pair table with its ``n_pairs`` weights stands for
every record pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.functions.keys import composite_key, digest
from recordloom.operators.skew import heavy_keys, split_join
from recordloom.session import cut_lineage
from recordloom.settings import DATA_SOURCE, UNIQUE_ID

PID = "pid"
NODE = "node_id"
COPIES = "n_records"
LINK_TYPES = ("link_and_dedupe", "dedupe", "link")
CELL_ROWS = 1024
PACKED_ROWS = 2048  # in a larger cell more pairs share their values
TASK_PAIRS = 250_000  # pairs of a task, about
MAX_TASKS = 20_000


@dataclass(frozen=True)
class Key:
    """One part of a blocking rule: a column or the first characters of one."""

    column: str
    prefix: int | None = None

    @property
    def name(self) -> str:
        return self.column if self.prefix is None else f"substr({self.column}, 1, {self.prefix})"

    def value(self, side: str | None = None) -> Column:
        c = F.col(self.column if side is None else f"{side}.{self.column}")
        return c if self.prefix is None else F.substring(c, 1, self.prefix)

    def implies(self, other: "Key") -> bool:
        """Rows that agree on this key agree on ``other``."""
        return self.column == other.column and (
            self.prefix is None or (other.prefix is not None and other.prefix <= self.prefix)
        )


@dataclass(frozen=True)
class Rarity:
    """Rows whose values are rare enough: the sum of log2(u / frequency) over ``values``, pairs of a
    frequency column and u, is at least ``needed``."""

    needed: float
    values: tuple[tuple[str, float], ...]

    def holds(self, side: str | None = None) -> Column:
        bonus = F.lit(0.0)
        for column, u in self.values:
            bonus = bonus + F.coalesce(F.log2(F.lit(u) / F.col(column if side is None else f"{side}.{column}")), F.lit(0.0))
        return bonus >= F.lit(self.needed)


@dataclass(frozen=True)
class BlockingRule:
    """Records agree on the rule when every key is equal and non-null.

    With ``rare`` only rows take part that meet it, with ``unless`` only those that meet none of these.
    Both speak of columns that the keys hold whole, so the two rows of a pair that agrees take part together.
    """

    keys: tuple[Key, ...]
    rare: Rarity | None = None
    unless: tuple[Rarity, ...] = ()

    @property
    def name(self) -> str:
        return " & ".join(k.name for k in self.keys)

    def columns(self) -> set[str]:
        return {k.column for k in self.keys}

    def refined(self, equal: frozenset[str]) -> "BlockingRule":
        """The rule with whole-column equality on ``equal`` added; prefixes of those columns are implied."""
        kept = [k for k in self.keys if k.column not in equal]
        return BlockingRule(tuple(sorted({*kept, *(Key(c) for c in equal)}, key=lambda k: (k.column, k.prefix or 0))))

    def implies(self, other: "BlockingRule") -> bool:
        """Rows that agree on the keys of this rule agree on those of ``other``."""
        return all(any(k.implies(o) for k in self.keys) for o in other.keys)

    def limits(self, side: str | None = None) -> list[Column]:
        return [*([self.rare.holds(side)] if self.rare else []), *[~u.holds(side) for u in self.unless]]


def block_on(*keys: str | tuple[str, int]) -> BlockingRule:
    """``block_on("city", ("name", 4))``: equal city and equal first four characters of name."""
    return BlockingRule(tuple(Key(*((k,) if isinstance(k, str) else k)) for k in keys))


def without_implied(rules: Sequence[BlockingRule]) -> list[BlockingRule]:
    """Drop rules whose pairs another rule already covers (rows that agree on the one agree on the other)."""
    kept: list[BlockingRule] = []
    for i, rule in enumerate(rules):
        covered = any(
            rule.implies(other) and (j < i or not other.implies(rule)) for j, other in enumerate(rules) if j != i
        )
        if not covered:
            kept.append(rule)
    return kept


def with_profile_id(records: DataFrame, columns: Sequence[str], link_type: str = "link_and_dedupe") -> DataFrame:
    """Add node and profile ids. The profile id is a digest, so records find their profile without a join."""
    if link_type not in LINK_TYPES:
        raise ValueError(f"unknown link type {link_type!r}")
    parts = [F.col(c) for c in columns]
    if link_type != "link_and_dedupe":
        parts.append(F.col(DATA_SOURCE))
    return records.withColumn(NODE, composite_key(F.col(DATA_SOURCE), F.col(UNIQUE_ID))).withColumn(PID, digest(parts))


def profiles(identified: DataFrame, columns: Sequence[str], link_type: str = "link_and_dedupe") -> DataFrame:
    """One row per distinct combination of compared values."""
    carried = [*columns, *([DATA_SOURCE] if link_type != "link_and_dedupe" else [])]
    return identified.groupBy(PID).agg(
        *[F.first(c).alias(c) for c in carried], F.count(F.lit(1)).alias(COPIES), F.min(NODE).alias("first_node")
    )


def _key_struct(rule: BlockingRule) -> Column:
    return F.struct(*[k.value().alias(f"k{i}") for i, k in enumerate(rule.keys)])


def _has_key(rule: BlockingRule) -> Column:
    return reduce(lambda a, b: a & b, [*[k.value().isNotNull() for k in rule.keys], *rule.limits()])


def block_statistics(
    records: DataFrame, rules: Sequence[BlockingRule], weight: Column | None = None
) -> DataFrame:
    """Rows and pairs per block of every rule, from one scan and one shuffle of counts."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(_has_key(r), F.struct(F.lit(r.name).alias("rule"), F.to_json(_key_struct(r)).alias("block")))
                for r in rules
            ]
        )
    )
    rows = F.sum(F.lit(1) if weight is None else weight)
    return (
        records.select(F.explode(entries).alias("b"), *([] if weight is None else [COPIES]))
        .groupBy("b.rule", "b.block")
        .agg(rows.cast("bigint").alias("n_rows"))
        .withColumn("n_pairs", (F.col("n_rows") * (F.col("n_rows") - 1) / 2).cast("bigint"))
    )


def hot_blocks(rows: DataFrame, rules: Sequence[BlockingRule], cell_rows: int) -> DataFrame:
    """Blocks with more rows than a cell holds, with the number of slices per side."""
    return _hot(block_statistics(rows, rules), cell_rows)


def _hot(stats: DataFrame, cell_rows: int) -> DataFrame:
    hot = stats.where(F.col("n_rows") > cell_rows)
    return hot.select("rule", "block", F.ceil(F.col("n_rows") / cell_rows).cast("int").alias("slices"))


def _mixed(rows: DataFrame, rules: Sequence[BlockingRule], apart: str) -> DataFrame:
    """Blocks whose rows differ in the column ``apart``: the others hold no pair that is asked for."""
    entries = F.array_compact(
        F.array(*[F.when(_has_key(r), F.struct(F.lit(r.name).alias("rule"), F.to_json(_key_struct(r)).alias("block"))) for r in rules])
    )
    least, most = F.min(apart).alias("least"), F.max(apart).alias("most")
    blocks = rows.select(F.explode(entries).alias("b"), apart).groupBy("b.rule", "b.block").agg(least, most, F.count(F.lit(1)).alias("n_rows"))
    return blocks.where(F.col("least") < F.col("most")).select(
        "rule", "block", "n_rows", (F.col("n_rows") * (F.col("n_rows") - 1) / 2).cast("bigint").alias("n_pairs")
    )


def hub_pairs(rows: DataFrame, rules: Sequence[BlockingRule], columns: Sequence[str], within: Sequence[Sequence[Key]] = ((),)) -> DataFrame:
    """Some of the pairs of :func:`profile_pairs`, no more than its blocks have rows: each row with the hub of its group.

    Each element of ``within`` divides a block into groups, the rows that are alike in these keys, nulls being alike.
    The hub is the row with the fewest values in ``columns``, as a missing value speaks against no pair.
    """
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    named = [
        F.when(_has_key(r), digest([F.lit(f"{i} {j}"), *[k.value() for k in (*r.keys, *keys)]]))
        for i, r in enumerate(rules) for j, keys in enumerate(within)
    ]
    entries = rows.select(PID, filled.alias("filled"), F.explode(F.array_compact(F.array(*named))).alias("group"))
    groups = entries.groupBy("group").agg(F.min(F.struct("filled", PID)).alias("hub"), F.count(F.lit(1)).alias("n"))
    groups = groups.where(F.col("n") > 1)
    spokes = split_join(
        entries.select(PID, "group"), groups.select("group", F.col(f"hub.{PID}").alias("hub")), "group", heavy_keys(groups, "group", "n"), [PID]
    )
    # the spokes of a hub that are in several of its groups are told once
    spokes = cut_lineage(spokes.where(F.col(PID) != F.col("hub")).select(PID, "hub").distinct(), "spokes")
    sizes = spokes.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    ends = spokes.join(rows.select(PID, F.struct("*").alias("l")), PID)
    pairs = split_join(ends, rows.select(F.col(PID).alias("hub"), F.struct("*").alias("r")), "hub", heavy_keys(sizes, "hub", "n"), [PID])
    ordered = F.col(f"l.{PID}") < F.col(f"r.{PID}")
    return pairs.select(F.when(ordered, F.col("l")).otherwise(F.col("r")).alias("l"), F.when(ordered, F.col("r")).otherwise(F.col("l")).alias("r"))


def _agree(rule: BlockingRule) -> Column:
    return reduce(lambda a, b: a & b, [*[k.value("l") == k.value("r") for k in rule.keys], *rule.limits("l")])


def _measured(rows: DataFrame, rules: Sequence[BlockingRule], cell_rows: int, apart: str | None) -> tuple[DataFrame, DataFrame, dict]:
    """Sizes of blocks and the hot ones, stored, as every rule asks for its own; of each rule the largest block and its pairs."""
    stats = cut_lineage(_mixed(rows, rules, apart) if apart else block_statistics(rows, rules), "blocks")
    hot = cut_lineage(_hot(stats, cell_rows), "hot-blocks")
    sizes = stats.groupBy("rule").agg(F.max("n_rows").alias("most"), F.sum(F.col("n_pairs").cast("double")).alias("n_pairs"))
    return stats, hot, {row["rule"]: row for row in sizes.collect()}


def profile_pairs(
    profile_rows: DataFrame,
    rules: Sequence[BlockingRule],
    link_type: str = "link_and_dedupe",
    cell_rows: int = CELL_ROWS,
    apart: str | None = None,
) -> DataFrame:
    """Distinct pairs of different profiles that share a block of any rule.

    Columns ``l`` and ``r`` are the two profile rows with ``l.pid < r.pid``; ``n_pairs`` is
    the number of record pairs behind them; ``rule`` the first rule that produced the pair.
    A pair is produced once: rule *k* leaves out pairs that agree on an earlier rule, which
    needs no global distinct. With ``apart`` only pairs that differ in that column, which is
    never null; blocks alike in it are not joined.
    """
    rules = list(rules)
    # One narrow job measures the blocks, whose sizes are stored, as every rule asks for its hot ones.
    # Only when some block is too large for a cell does the plan pay for slicing; otherwise each
    # rule is a plain equi-join.
    stats, hot, measured = _measured(profile_rows, rules, cell_rows, apart)
    parts = []
    for k, rule in enumerate(rules):
        keyed = profile_rows.where(_has_key(rule)).select(F.struct("*").alias("row"), _key_struct(rule).alias("key"))
        if apart:
            mixed = stats.where(F.col("rule") == rule.name).select("block")
            keyed = keyed.join(mixed, F.to_json("key") == F.col("block"), "left_semi")
        size = measured.get(rule.name)
        if size is not None and size["most"] > cell_rows:
            left, right, on = *_sliced(keyed, hot.where(F.col("rule") == rule.name), cell_rows), ["key", "cell_l", "cell_r"]
        else:
            left, right, on = keyed, keyed, ["key"]
        packed = "rows" in left.columns
        left = left.select(F.col("rows" if packed else "row").alias("l"), *on)
        right = right.select(F.col("rows" if packed else "row").alias("r"), *on)
        tasks = min(MAX_TASKS, math.ceil(size["n_pairs"] / TASK_PAIRS)) if size is not None else 0
        if tasks > 1:
            left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
        pairs = left.join(right, on)
        if packed:
            pairs = pairs.withColumn("l", F.explode("l")).withColumn("r", F.explode("r"))
        pairs = pairs.where(F.col("l.pid") < F.col("r.pid"))
        if apart:
            pairs = pairs.where(F.col(f"l.{apart}") != F.col(f"r.{apart}"))
        for earlier in rules[:k]:
            pairs = pairs.where(~F.coalesce(_agree(earlier), F.lit(False)))
        parts.append(pairs.select(F.lit(rule.name).alias("rule"), "l", "r"))
    out = reduce(DataFrame.unionAll, parts)
    same_source = F.col(f"l.{DATA_SOURCE}") == F.col(f"r.{DATA_SOURCE}") if link_type != "link_and_dedupe" else None
    if link_type == "dedupe":
        out = out.where(same_source)
    elif link_type == "link":
        out = out.where(~same_source)
    return out.withColumn("n_pairs", F.col(f"l.{COPIES}") * F.col(f"r.{COPIES}"))


def _sliced(keyed: DataFrame, hot: DataFrame, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread hot blocks over ``slices x slices`` cells; other blocks keep the single cell (0, 0).

    A left row of slice c goes to cells (c, 0..s-1), a right row of slice d to (0..s-1, d),
    so the two meet in cell (c, d) only. A row is copied once per slice, so slices of fewer than
    ``CELL_ROWS`` rows are packed into arrays ``rows``, one row each, and dealt over a grid of
    ``CELL_ROWS`` rows a side: two packed slices that meet there are a cell.
    """
    sliced = keyed.join(
        hot.select("block", "slices"), F.to_json("key") == F.col("block"), "left"
    ).withColumn("slices", F.coalesce("slices", F.lit(1)))
    sliced = sliced.withColumn("own", F.pmod(F.xxhash64(F.col("row.pid")), F.col("slices")).cast("int"))
    content = "row"
    if cell_rows < CELL_ROWS:
        content = "rows"
        sliced = sliced.groupBy("key", "slices", "own").agg(F.collect_list("row").alias(content))
        grid = F.ceil(F.col("slices") * F.lit(cell_rows) / F.lit(CELL_ROWS)).cast("int")
        sliced = sliced.withColumn("slices", grid).withColumn("own", F.pmod(F.col("own"), F.col("slices")))
    sliced = sliced.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    left = sliced.select(content, "key", F.col("own").alias("cell_l"), F.col("other").alias("cell_r"))
    right = sliced.select(content, "key", F.col("other").alias("cell_l"), F.col("own").alias("cell_r"))
    return left, right


def copy_pairs(
    profile_rows: DataFrame, rules: Sequence[BlockingRule], link_type: str = "link_and_dedupe"
) -> DataFrame:
    """Pairs inside a profile as one row each: ``l`` = ``r`` and ``n_pairs`` = n(n-1)/2."""
    if link_type == "link":
        return profile_rows.where(F.lit(False)).select(
            F.lit("").alias("rule"), F.struct("*").alias("l"), F.struct("*").alias("r"), F.lit(0).cast("bigint").alias("n_pairs")
        )
    first_rule = F.coalesce(*[F.when(_has_key(r), F.lit(r.name)) for r in rules])
    n = F.col(COPIES)
    return profile_rows.where((n > 1) & first_rule.isNotNull()).select(
        first_rule.alias("rule"), F.struct("*").alias("l"), F.struct("*").alias("r"),
        (n * (n - 1) / 2).cast("bigint").alias("n_pairs"),
    )


@dataclass(frozen=True)
class PackedPairs:
    """The pairs of :func:`all_pairs` that are not spelled out: the rows of a cell lie side by side, for a
    reader that needs no row of its own for each pair (:mod:`recordloom.operators.cells`)."""

    rows: DataFrame | None
    rules: tuple[BlockingRule, ...]
    link_type: str = "link_and_dedupe"
    cell_rows: int = PACKED_ROWS
    apart: str | None = None
    columns: tuple[str, ...] = ()

    def copies(self) -> DataFrame:
        return copy_pairs(self.rows, self.rules, self.link_type)

    def holding(self, columns: Iterable[str]) -> "PackedPairs":
        """With these columns of the rows in the cells."""
        return replace(self, columns=tuple(sorted(columns)))

    def bare(self) -> "PackedPairs":
        """Without the rows, for tasks."""
        return replace(self, rows=None)

    def held(self, key: Key) -> str:
        """Name of the column that has ``key`` in the rows of a cell."""
        return key.column if key.prefix is None else f"_{key.prefix}_{key.column}"


def packed_cells(pairs: PackedPairs) -> DataFrame:
    """``rule, l, r``: cells of the blocks of each rule, by its number, with their rows as arrays; a null ``r``
    stands for ``l`` itself, of which each two rows are a pair.

    The slices of a hot block are paired with each other and each with itself, so two rows meet once.
    ``_met`` tells by its bits which rules but the last a row takes part in.
    """
    rows, rules = pairs.rows, list(pairs.rules)
    stats, hot, measured = _measured(rows, rules, pairs.cell_rows, pairs.apart)
    own = {PID, COPIES, *pairs.columns, *([pairs.apart] if pairs.apart else []), *([DATA_SOURCE] if pairs.link_type != "link_and_dedupe" else [])}
    keys = {pairs.held(k): k.value() for rule in rules[:-1] for k in rule.keys if pairs.held(k) not in own}
    met = [F.when(_has_key(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules[:-1])]
    packed = F.struct(
        *sorted(own), *[v.alias(name) for name, v in keys.items()], reduce(lambda a, b: a + b, met, F.lit(0)).cast("bigint").alias("_met")
    )
    parts = []
    for k, rule in enumerate(rules):
        size = measured.get(rule.name)
        keyed = rows.where(_has_key(rule)).select(packed.alias("row"), _key_struct(rule).alias("key"))
        if pairs.apart:
            mixed = stats.where(F.col("rule") == rule.name).select("block")
            keyed = keyed.join(mixed, F.to_json("key") == F.col("block"), "left_semi")
        tasks = max(1, min(MAX_TASKS, math.ceil(size["n_pairs"] / TASK_PAIRS))) if size is not None else 1
        if size is None or size["most"] <= pairs.cell_rows:
            whole = keyed.repartition(tasks, "key").groupBy("key").agg(F.collect_list("row").alias("l"))
            parts.append(whole.where(F.size("l") > 1).select(F.lit(k).alias("rule"), "l", F.lit(None).cast(whole.schema["l"].dataType).alias("r")))
            continue
        sliced = keyed.join(hot.where(F.col("rule") == rule.name).select("block", "slices"), F.to_json("key") == F.col("block"), "left")
        sliced = sliced.withColumn("slices", F.coalesce("slices", F.lit(1)))
        sliced = sliced.withColumn("own", F.pmod(F.xxhash64(F.col(f"row.{PID}")), F.col("slices")).cast("int"))
        lists = sliced.groupBy("key", "slices", "own").agg(F.collect_list("row").alias("rows"))
        on = ["key", "cell_l", "cell_r"]
        left = lists.select("key", F.col("own").alias("cell_l"), F.explode(F.sequence(F.col("own"), F.col("slices") - 1)).alias("cell_r"), F.col("rows").alias("l"))
        right = lists.where(F.col("own") > 0).select(
            "key", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("cell_l"), F.col("own").alias("cell_r"), F.col("rows").alias("r")
        )
        cells = left.repartition(tasks, *on).join(right.repartition(tasks, *on), on, "left")
        cells = cells.where(F.when(F.col("cell_l") == F.col("cell_r"), F.size("l") > 1).otherwise(F.col("r").isNotNull()))
        parts.append(cells.select(F.lit(k).alias("rule"), "l", "r"))
    return reduce(DataFrame.unionAll, parts)


def all_pairs(
    profile_rows: DataFrame, rules: Sequence[BlockingRule], link_type: str = "link_and_dedupe", cell_rows: int | None = None,
    packed: bool = False,
) -> DataFrame | PackedPairs:
    """Every candidate pair in folded form: different profiles, then copies of one profile. With ``packed``
    they are not spelled out."""
    if packed:
        return PackedPairs(profile_rows, tuple(rules), link_type, cell_rows or PACKED_ROWS)
    return profile_pairs(profile_rows, rules, link_type, cell_rows or CELL_ROWS).unionByName(
        copy_pairs(profile_rows, rules, link_type)
    )


def count_pairs(pairs: DataFrame) -> DataFrame:
    """Record pairs per first matching rule."""
    return pairs.groupBy("rule").agg(F.sum("n_pairs").cast("bigint").alias("n_pairs"))
