"""Lookup joins: code to label, and the best fuzzy label for a noisy one.

No side is force-broadcast: the optimiser broadcasts a mapping only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.functions.text import strip
from recordloom.settings import FUZZY_THRESHOLD


def code_label(df: DataFrame, code: str, mapping: DataFrame, label: str) -> DataFrame:
    """Unknown codes become null and known ones get their label.

    ``mapping`` has columns ``code`` and ``label`` with unique codes.
    """
    known = mapping.select(F.upper(F.col("code").cast("string")).alias("_code"), F.col("label").alias(label))
    joined = df.join(known, F.upper(F.col(code)) == F.col("_code"), "left")
    return joined.withColumn(code, F.when(F.col("_code").isNotNull(), F.col(code))).drop("_code")


def fuzzy_key(label: Column) -> Column:
    """Lower-cased label with every run of non-alphanumerics turned into one blank."""
    return strip(F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}]+", " "))


def _segments(length: Column, tolerance: Column) -> Column:
    """Even split of a string of ``length`` into ``tolerance + 1`` pieces: structs of index, start, size."""
    n = tolerance + F.lit(1)
    return F.transform(
        F.sequence(F.lit(0), tolerance),
        lambda i: F.struct(
            i.alias("i"),
            (F.floor(i * length / n) + 1).cast("int").alias("start"),
            (F.floor((i + 1) * length / n) - F.floor(i * length / n)).cast("int").alias("size"),
        ),
    )


def _shifts() -> dict[str, Column]:
    """Least and most shift of a segment of an entry (``el, tol, seg``) in a label (``ql``) within ``edits``.

    The shift is what the edits before the segment add or take, and the rest of the difference in
    length falls behind it. There are no more edits before it than segments, nor behind it, nor on
    both sides than the pair allows.
    """
    i, rest, longer = F.col("seg.i"), F.col("tol") - F.col("seg.i"), F.col("ql") - F.col("el")
    return {
        "low": F.greatest(-i, longer - rest, F.ceil((longer - F.col("edits")) / 2).cast("int")),
        "high": F.least(i, longer + rest, F.floor((longer + F.col("edits")) / 2).cast("int")),
    }


def fuzzy_code(labels: DataFrame, label: str, mapping: DataFrame, threshold: int = FUZZY_THRESHOLD) -> DataFrame:
    """Best mapping entry per distinct label with similarity of at least ``threshold`` percent.

    Similarity is ``1 - levenshtein / longer length``. An entry is cut into one segment more than
    any partner may have edits, so some segment is free of edits, and one of those lies such
    that the segments before it hold no more edits than they are, and those behind it as well.
    Candidates therefore come from an equi-join on (length, segment number, segment text), with
    each segment looked for only where :func:`_shifts` lets it stand, instead of comparing every
    label with every entry. The join loses no qualifying pair.
    """
    if not 50 < threshold <= 100:
        raise ValueError("the segment join is exact only for thresholds above 50 and up to 100")
    share = threshold / 100.0
    slack = 1.0 - share
    # the longest partner of an entry has el / share characters, so no pair needs more edits than this
    tolerance = F.floor(F.floor(F.col("el") / share + 1e-9) * slack + 1e-9).cast("int")
    entries = (
        mapping.where(F.col("label").isNotNull())
        .select(F.col("code"), F.col("label").alias("entry"), fuzzy_key(F.col("label")).alias("ek"))
        .where(F.length("ek") > 0)
        .withColumn("el", F.length("ek"))
        .withColumn("tol", tolerance)
    )
    pieces = (
        entries.withColumn("seg", F.explode(_segments(F.col("el"), F.col("tol"))))
        .select(
            "code", "entry", "ek", "el", F.col("seg.i").alias("si"),
            F.substring("ek", F.col("seg.start"), F.col("seg.size")).alias("piece"),
        )
    )
    wanted = labels.select(F.col(label).alias("q")).where(F.col("q").isNotNull()).distinct()
    wanted = wanted.withColumn("qk", fuzzy_key(F.col("q"))).where(F.length("qk") > 0).withColumn("ql", F.length("qk"))
    probes = (
        wanted.withColumn(
            "el",
            F.explode(
                F.sequence(
                    F.ceil(F.col("ql") * share - 1e-9).cast("int"), F.floor(F.col("ql") / share + 1e-9).cast("int")
                )
            ),
        )
        .withColumn("tol", tolerance)
        .withColumn("edits", F.floor(F.greatest("ql", "el") * slack + 1e-9).cast("int"))
        .withColumn("seg", F.explode(_segments(F.col("el"), F.col("tol"))))
        .withColumns(_shifts())
        .withColumns({"low": F.greatest(F.lit(1), F.col("seg.start") + F.col("low")), "high": F.least(F.col("seg.start") + F.col("high"), F.col("ql") - F.col("seg.size") + 1)})
        .where("low <= high")
        .withColumn("at", F.explode(F.sequence("low", "high")))
        .select(
            "q", "qk", "ql", "el", F.col("seg.i").alias("si"),
            F.substring("qk", F.col("at"), F.col("seg.size")).alias("piece"),
        )
        .distinct()
    )
    scored = probes.join(pieces, ["el", "si", "piece"]).withColumn(
        "score",
        F.lit(100.0)
        * (F.lit(1.0) - F.levenshtein("qk", "ek") / F.greatest("ql", F.col("el")).cast("double")),
    )
    best = (
        scored.where(F.col("score") >= threshold)
        .groupBy("q")
        .agg(F.min_by(F.struct("code", "entry", "score"), F.struct(-F.col("score"), "entry", "code")).alias("best"))
    )
    return best.select(F.col("q").alias(label), "best.code", F.col("best.entry").alias("match"), "best.score")
