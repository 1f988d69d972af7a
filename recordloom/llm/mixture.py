"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordloom.llm.tables import cut_lineage

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
#: Slots of a schedule, about; a block has at least one word.
SLOTS = 1 << 20
_GOLDEN = 0.6180339887498949
_CHUNK, _CELLS, _SEED = 1 << 16, 1024, "7:"
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Mix:
    """``docs``: a row per document with its place, ``taken`` and the first slot it fills; ``copies``: a row per copy
    with its words and first slot; ``sources``: targets; ``schedule``: slots in mixing order."""

    docs: DataFrame
    copies: DataFrame
    sources: DataFrame
    schedule: DataFrame
    block: int


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """``source, source_id, source_size, weight, target``, one row per source.

    Sources in code-point order, null last, weigh 1, 2, 3 and so on again. Targets share the sum
    of all sizes by weight but stop at ``MOST_PASSES`` sizes; what is above is shared again. In
    order of size per weight the sources that stop come first, so running sums give the level
    at which the rest shares. The windows run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("source_id") % len(WEIGHTS) + 1).cast("double")
    named = sums.withColumn("source_id", F.row_number().over(place) - 1).withColumn("weight", weight).withColumn("most", MOST_PASSES * F.col("source_size"))
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy(F.col("most") / F.col("weight"), "source_id").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = named.withColumn("level", level)
    # the first source in that order that stays below its most sets the level of the rest
    place = F.when(F.col("level") * F.col("weight") < F.col("most"), F.struct(F.col("most") / F.col("weight"), "source_id"))
    rest = F.min_by("level", place).over(every)
    target = F.when(F.coalesce(F.col("rest") * F.col("weight") < F.col("most"), F.lit(False)), F.col("rest") * F.col("weight")).otherwise(F.col("most").cast("double"))
    return leveled.withColumn("rest", rest).select("source", "source_id", "source_size", "weight", target.alias("target"))


def running(df: DataFrame, keys: list[str], part: str, value: str, order: list) -> DataFrame:
    """``df`` with ``start``: the sum of ``value`` over the rows of the same ``keys`` that come before.

    Parts are summed first and only within a part are rows sorted, so no task holds a whole group.
    """
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias("#sum"))
    sums = sums.withColumn("#before", F.coalesce(F.sum("#sum").over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("#own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return inner.join(sums.drop("#sum"), [*keys, part]).withColumn("start", F.col("#before") + F.col("#own")).drop("#before", "#own")


def mix(docs: DataFrame, row: str | None = None) -> Mix:
    """Decide how many words of each document the mixture takes, repeats counted.

    The points ``frac(i * golden ratio)`` are mapped through the cumulated targets, which gives
    the source of slot ``i``; slots are ranked per source; the source's documents, in a fixed
    pseudo-random order, form a stream that is repeated up to ``MOST_PASSES`` times and cut into
    equal-token blocks; the slot of rank ``r`` takes block ``r``. A source's slots end at its
    target, and slots the sequence has not yet given a source by its end follow after it. So a
    source's taken words are its target, rounded, and no document exceeds ``MOST_PASSES`` times
    its size. The order comes from a digest of the id (ties: the text's hash), so reruns agree.
    ``first_slot`` is the first slot of the schedule that a document fills, null where it is not
    taken: the place in the mixture that the sequence gives it. ``row`` names a column that
    numbers the rows; without it they are numbered here.

    Null text: size 0, taken 0. A null source is a source, the last. Null ids order as the empty
    text; rows that repeat an id are documents of their own. An empty table has an empty schedule.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(_SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    number = F.monotonically_increasing_id() if row is None else F.col(f"`{row}`")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words("text").alias("size"), key.alias("order"), F.xxhash64("text").alias("h"), number.alias("row"))
    sized = cut_lineage(sized, "llm-sized")
    sources = cut_lineage(source_targets(sized), "llm-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, -(-total // SLOTS))
    want = F.least(MOST_PASSES * F.col("source_size"), F.floor(F.col("target") + 0.5)).cast("long")
    goal = sources.select("source", "source_id", "source_size", "target", want.alias("want"), F.ceil(want / F.lit(block)).cast("long").alias("owed"))

    # slots of the golden-ratio sequence
    run = Window.partitionBy(F.lit(0)).orderBy("source_id")
    share = F.sum("target").over(run) / F.lit(float(max(total, 1)))
    spans = goal.withColumn("high", share).withColumn("low", F.coalesce(F.lag("high").over(run), F.lit(0.0))).where("owed > 0")
    cells = F.sequence(F.floor(F.col("low") * _CELLS).cast("long"), F.floor(F.least(F.col("high"), F.lit(1.0)) * _CELLS).cast("long"))
    spans = spans.select("source_id", "owed", "low", "high", F.explode(cells).alias("cell"))
    point = F.col("id") * F.lit(_GOLDEN) - F.floor(F.col("id") * F.lit(_GOLDEN))
    points = spark.range(-(-total // block)).select(F.col("id").alias("slot"), point.alias("u")).withColumn("cell", F.floor(F.col("u") * _CELLS).cast("long"))
    dealt = points.join(spans, "cell").where("u >= low AND u < high").select("slot", "source_id", "owed", (F.col("slot") / _CHUNK).cast("long").alias("chunk"), F.lit(1).alias("one"))
    ranked = running(dealt, ["source_id"], "chunk", "one", [F.col("slot")]).select("source_id", "slot", F.col("start").alias("rank"), "owed").where("rank < owed").drop("owed")
    ranked = cut_lineage(ranked, "llm-slots")
    given = ranked.groupBy("source_id").agg(F.count("*").alias("given"))
    late = goal.join(given, "source_id", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < owed")
    late = late.select("source_id", F.explode(F.sequence(F.col("given"), F.col("owed") - 1)).alias("rank"))
    schedule = ranked.select("source_id", "slot", "rank").unionByName(late.select("source_id", (F.lit(-(-total // block)) + F.col("rank")).alias("slot"), "rank"))

    # documents' places in the repeated stream, cut at block edges
    owner = goal.withColumnRenamed("source", "of")
    placed = sized.join(F.broadcast(owner), F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("part", F.substring("order", 1, 3))
    placed = cut_lineage(running(placed, ["source_id"], "part", "size", [F.col("order"), F.col("doc_id"), F.col("h"), F.col("row")]), "llm-placed")
    passes = F.transform(F.array(*map(F.lit, range(MOST_PASSES))), lambda p: F.col("start") + p * F.col("source_size"))
    again = placed.where("size > 0").select("row", "source_id", "size", "want", F.explode(passes).alias("at")).where("at < want")
    till = F.least(F.col("at") + F.col("size"), F.col("want"))
    pieces = again.select("row", "size", "source_id", "at", till.alias("till"))
    pieces = pieces.select("row", "size", "source_id", "at", "till", F.explode(F.sequence(F.floor(F.col("at") / block).cast("long"), F.floor((F.col("till") - 1) / block).cast("long"))).alias("rank"))
    length = F.least("till", (F.col("rank") + 1) * block) - F.greatest("at", F.col("rank") * block)
    copies = pieces.join(schedule, ["source_id", "rank"]).groupBy("row", "at").agg(F.sum(length).alias("words"), F.first("size").alias("size"), F.min("slot").alias("slot"))
    copies = cut_lineage(copies, "llm-copies")
    taken = copies.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    out = placed.join(taken, "row", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "row")
    return Mix(out, copies.select("row", "words", "size", "slot"), sources, schedule, block)


def mixed_documents(docs: DataFrame, in_order: bool = True) -> DataFrame:
    """``docs`` as the mixture has them, in the order of the schedule: each as often as it is taken.

    Documents stay whole. The last copy of a source, of which only some words are due, is dealt if
    they are half of it or more, so a source is off its target by half a document at most. The
    order is that of the slots that the copies' first words fill; a caller that puts the rows in an
    order of its own need not pay for it. The columns are those of ``docs``.
    """
    own = docs.columns
    rows = cut_lineage(docs.withColumn("#row", F.monotonically_increasing_id()), "llm-rows")
    dealt = mix(rows, "#row").copies.where("2 * words >= size").select(F.col("row").alias("#row"), "slot")
    dealt = dealt.withColumnsRenamed({"slot": "#slot"}).join(rows, "#row")
    if in_order:
        dealt = dealt.repartitionByRange("#slot", "#row").sortWithinPartitions("#slot", "#row")
    return dealt.select(*own)
