"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordloom.llm.graph import components
from recordloom.llm.tables import Scratch, texts
from recordloom.llm.words import SPACED, Slice, grams, map_batches, mix64, slices, words

#: Bands of so many rows: a pair at similarity 0.8 shares no band with probability 1e-6.
BANDS, ROWS = 26, 4
#: Coordinates whose lowest bit is kept as a sketch, sixty-four in a long.
SKETCH = 208
#: Longs of the bitmap into which each shingle of a set is hashed.
BITMAP = 16
LEADER_ROUNDS = 2
#: Pairs for which the set of one document is sent once.
PARTNERS = 256
#: Size of the Arrow batches in which texts and sets go to Python.
BATCH_BYTES = 4 << 20
_SKETCH_LONGS = -(-SKETCH // 64)
_BLOCK = 2048


def _sigma(x: np.ndarray) -> np.ndarray:
    """First permutation of the 32-bit integers; breaks up any structure of the elements."""
    x = x ^ (x >> np.uint32(15))
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    x *= np.uint32(0x297A2D39)
    x ^= x >> np.uint32(15)
    return x


def _pi(x: np.ndarray) -> np.ndarray:
    """Second permutation of the 32-bit integers, the one that is shifted."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def circulant_signature(elements: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash values of a set of 64-bit elements: coordinate ``k`` is the smallest
    ``pi(sigma(x) + k)`` over the set, so one shifted permutation serves all coordinates."""
    start = _sigma((elements >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(size, dtype=np.uint32)
    out = np.full(size, np.uint32(0xFFFFFFFF))
    for i in range(0, len(start), _BLOCK):
        np.minimum(out, _pi(start[i:i + _BLOCK, None] + shifts).min(axis=0), out=out)
    return out


def shingle_sets(part: Slice, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's ``k``-word shingles; of fewer words, one of the whole sequence."""
    found = words(part, SPACED)
    hashes = found.hashes()
    rolled = grams(hashes, k)
    out = []
    for first, last in zip(found.bounds[:-1], found.bounds[1:]):
        if last - first >= k:
            out.append(np.unique(rolled[first:last - k + 1]))
        else:
            out.append(grams(hashes[first:last], int(last - first)) if last > first else rolled[:0])
    return out


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, sketch, bitmap``: a digest of the set, one key per band, the
    lowest bit of each coordinate and a bitmap of the set; empty sets have none of them."""

    def one(batch: pa.RecordBatch) -> dict[str, object]:
        n, digest, keys, sketch, bitmap = [], [], [], [], []
        seeds = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
        for part in slices(batch.column("text")):
            for s in shingle_sets(part, k):
                n.append(len(s))
                if not len(s):
                    digest.append(None)
                    keys.append(None)
                    sketch.append(None)
                    bitmap.append(None)
                    continue
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                coordinates = circulant_signature(s, SKETCH)
                odd = np.zeros(64 * _SKETCH_LONGS, dtype=bool)
                odd[:SKETCH] = coordinates & np.uint32(1)
                sketch.append(np.packbits(odd, bitorder="little").view(np.int64))
                marked = np.zeros(64 * BITMAP, dtype=bool)
                marked[mix64(s) % np.uint64(64 * BITMAP)] = True
                bitmap.append(np.packbits(marked, bitorder="little").view(np.int64))
                rows = coordinates[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                key = seeds.copy()
                for j in range(ROWS):
                    key = mix64(key ^ rows[:, j]) + np.uint64(j)
                keys.append(key.view(np.int64))
        return {"n_shingles": n, "digest": digest, "bands": keys, "sketch": sketch, "bitmap": bitmap}

    return map_batches(texts(docs), one, "n_shingles long, digest binary, bands array<long>, sketch array<long>, bitmap array<long>", keep=["doc_id"])


def sketch_columns(side: str) -> list[Column]:
    """The set size, sketch and bitmap as plain columns of the ``x`` or ``y`` side of a pair."""
    sketch = [F.col("sketch")[i].alias(f"{side}s{i}") for i in range(_SKETCH_LONGS)]
    bitmap = [F.col("bitmap")[i].alias(f"{side}b{i}") for i in range(BITMAP)]
    collided = F.col("n_shingles") - F.aggregate("bitmap", F.lit(0), lambda n, x: n + F.bit_count(x))
    return [F.col("n_shingles").alias(f"{side}n"), collided.alias(f"{side}c"), *sketch, *bitmap]


def may_be_similar(similarity_pct: int) -> Column:
    """Whether the pair of ``sketch_columns`` of ``x`` and ``y`` may reach the similarity.

    A bit that only one bitmap has is a shingle that only this set has, so the bits in common and
    the collisions of a set bound the intersection from above and nothing is lost. Of the sketches
    so many must agree as at 4.6 standard deviations below what is expected at the threshold: 2e-6
    of the true pairs are lost, and long texts, whose bitmaps are full, are told apart as well. The
    terms are few, so that the compiled loop of the join stays small.
    """
    p = (1 + similarity_pct / 100) / 2
    least = int(SKETCH * p - 4.6 * (SKETCH * p * (1 - p)) ** 0.5)
    differ = common = F.lit(0)
    for i in range(_SKETCH_LONGS):
        differ = differ + F.bit_count(F.col(f"xs{i}").bitwiseXOR(F.col(f"ys{i}")))
    for i in range(BITMAP):
        common = common + F.bit_count(F.col(f"xb{i}").bitwiseAND(F.col(f"yb{i}")))
    most = common + F.least("xc", "yc")
    return ((100 + similarity_pct) * most >= similarity_pct * (F.col("xn") + F.col("yn"))) & (differ <= SKETCH - least)


def verified(pairs: DataFrame, docs: DataFrame, k: int, similarity_pct: int, scratch: Scratch) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full shingle sets are similar enough.

    The sets of the documents named in a pair are computed once and stored. The set of ``b`` is
    sent once for ``PARTNERS`` of its pairs and comes before those of its partners, so a task
    holds one set and lets the others pass; a much-named document is dealt to several tasks.
    The result is stored and the sets are removed again.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    chosen = texts(docs).where("doc_id IS NOT NULL").join(named, "doc_id", "left_semi")

    def sets_of(batch: pa.RecordBatch) -> dict[str, object]:
        return {"shingles": [s.tobytes() for part in slices(batch.column("text")) for s in shingle_sets(part, k)]}

    sets = scratch.cut(map_batches(chosen, sets_of, "shingles binary", keep=["doc_id"]), "llm-sets")
    shares = pairs.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    dealt = pairs.join(shares, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    held = shares.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    held = held.join(sets.withColumnRenamed("doc_id", "b"), "b").select("b", "part", F.lit(None).cast("long").alias("a"), "shingles")
    passing = dealt.join(sets.withColumnRenamed("doc_id", "a"), "a").select("b", "part", "a", "shingles")
    # a null ``a`` sorts first
    rows = held.unionByName(passing).repartition("b", "part").sortWithinPartitions("b", "part", "a").select("a", "b", "shingles")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[np.ndarray] = []
        last = None  # what the row before was
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, body in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("shingles")):
                shingles = np.frombuffer(body.as_buffer(), dtype=np.uint64)
                if a is None:
                    own = [*own, shingles.copy()] if last == (None, b) else [shingles.copy()]
                elif any(_similar(shingles, s, similarity_pct) for s in own):
                    found.append((a, b))
                last = (a, b)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    links = scratch.cut(rows.mapInArrow(similar, "a long, b long").distinct(), "llm-links")
    scratch.drop(sets)
    return links


def _similar(x: np.ndarray, y: np.ndarray, similarity_pct: int) -> bool:
    """Whether two sorted sets are similar enough; empty ones are not."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < similarity_pct * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int(np.count_nonzero(large[at] == small))
    return 100 * common >= similarity_pct * (len(x) + len(y) - common)


def near_duplicates(docs: DataFrame, k: int = 5, similarity_pct: int = 80) -> DataFrame:
    """One row per row of ``docs`` with the group of near copies it belongs to.

    Returns ``doc_id, n_shingles, component_id, kept``. Documents are linked when
    ``100 * |intersection| >= similarity_pct * |union|`` of their distinct ``k``-word shingles;
    ``component_id`` is the smallest id reachable over links, ``kept`` whether that is the row's own.

    Equal sets form one class with one representative, found by a digest, so copies never meet
    in pairs. In each bucket of each band the representatives are compared with a leader, not
    with each other. Only where a bucket still spans several components after the leader rounds
    are the remaining pairs between components checked, all of them. Nothing is capped.

    Null text, or text without words: ``n_shingles`` 0, a component of its own. Null id: the row
    takes no part, ``component_id`` is null and ``kept`` true. Repeated ids are one node, linked
    by any of their texts. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, BATCH_BYTES)
    sig = scratch.cut(signatures(docs, k), "llm-signatures")
    usable = sig.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = scratch.cut(usable.groupBy("digest").agg(F.min("doc_id").alias("rep")), "llm-classes")
    member = usable.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep")
    member = scratch.cut(member.distinct(), "llm-members")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("n")).where("n > 1")
    by_id = member.join(several.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = usable.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    rows = scratch.cut(
        reps.select("doc_id", F.explode("bands").alias("key"))
        .join(reps.select(F.explode("bands").alias("key"), "doc_id").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("key"), "key"),
        "llm-buckets",
    )
    sketches = usable.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "n_shingles", "sketch", "bitmap")
    sketches = scratch.cut(sketches, "llm-sketches")
    links = by_id
    done = None
    groups = spark.createDataFrame([], "node long, component long")
    for step in range(LEADER_ROUNDS + 1):
        named = rows.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
        named = scratch.cut(named, "llm-open")
        order = F.col("doc_id") if step == 0 else F.xxhash64("doc_id", "key", F.lit(step))
        heads = named.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct(order.alias("o"), "doc_id", "component")).alias("h")
        ).where("low < high").select("key", F.col("h.doc_id").alias("b"), F.col("h.component").alias("other"))
        heads = scratch.cut(heads, "llm-heads")
        if heads.isEmpty():
            break
        last, open_rows = rows, None
        rows = named.select("key", "doc_id").join(heads.select("key"), "key", "left_semi") if step else named.select("key", "doc_id")
        if step < LEADER_ROUNDS:
            pairs = named.join(heads, "key").where("component <> other").select(F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b")).distinct()
            pairs = pairs.join(sketches.select(F.col("doc_id").alias("a"), *sketch_columns("x")), "a")
            pairs = pairs.join(sketches.select(F.col("doc_id").alias("b"), *sketch_columns("y")), "b").where(may_be_similar(similarity_pct)).select("a", "b")
        else:
            open_rows = named.join(heads.select("key", F.col("other").alias("main")), "key").join(sketches, "doc_id")
            open_rows = scratch.cut(open_rows.select("key", "doc_id", "component", "main", *sketch_columns("x")), "llm-rest")
            own = [c for c in open_rows.columns if c.startswith("x")]
            other = open_rows.select(F.col("key").alias("k2"), F.col("doc_id").alias("b"), F.col("component").alias("other"), *[F.col(c).alias("y" + c[1:]) for c in own])
            apart = (F.col("other") == F.col("main")) | (F.col("component") < F.col("other"))
            pairs = (
                open_rows.where("component <> main").withColumnRenamed("doc_id", "a")
                .join(other, (F.col("key") == F.col("k2")) & apart & may_be_similar(similarity_pct))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            )
        pairs = pairs.distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = scratch.cut(pairs, "llm-pairs")
        done = pairs if done is None else done.unionByName(pairs)
        found = verified(pairs, docs, k, similarity_pct, scratch)
        links = links.unionByName(found)
        groups = components(links)
        rows = scratch.cut(rows, "llm-buckets")
        scratch.drop(last, named, heads, open_rows)
    if done is None:
        groups = components(links)
    named = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    named = scratch.cut(named, "llm-named-classes")
    scratch.drop_all_but(sig, named)
    with_set = sig.where("digest IS NOT NULL").join(named, "digest", "left")
    without = sig.where("digest IS NULL").withColumn("component", F.lit(None).cast("long"))
    out = with_set.select("doc_id", "n_shingles", "component").unionByName(without.select("doc_id", "n_shingles", "component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
