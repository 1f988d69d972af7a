"""The pipeline's stages on the smallest tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.session import cut_lineage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = cut_lineage(stage(spark, before, SF), "test-stage")
        if name != "token blocks":
            assert sorted(after.columns) == sorted(docs.columns)
        if name == "language":
            kept = {r.doc_id for r in before.collect() if r.text and any(c.isalpha() for c in r.text)}
            assert {r.doc_id for r in after.collect()} == kept
        elif name == "near copies":
            sets = {}
            for r in before.collect():
                w = re.findall(rb"[^\x20\x09-\x0D]+", r.text.encode().lower())
                sets[r.doc_id] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
            left = sorted(r.doc_id for r in after.collect())
            for i, a in enumerate(left):
                for b in left[:i]:
                    assert 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])
            for gone in set(sets) - set(left):
                assert any(100 * len(sets[gone] & s) >= 80 * len(sets[gone] | s) for i, s in sets.items() if i != gone)
        elif name == "mixture":
            words = [[len(re.findall(rb"[^\x20\x09-\x0D]+", r.text.encode())) for r in d.collect()] for d in (before, after)]
            sources = before.select("source").distinct().count()
            assert abs(sum(words[0]) - sum(words[1])) <= sources * max(words[0]) / 2
            assert {r.text for r in after.collect()} <= {r.text for r in before.collect()}
        elif name == "token blocks":
            assert after.count() == before.count()
        before = after


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated ids with different texts, near copies under null ids, a null source and columns of clashing names."""
    base = " ".join(f"word{i} lorem" for i in range(120))
    rows = [(1, base, "en", "a"), (1, "quite another text under the same id " * 9, "en", "a"), (2, base + " tail", "en", "b"), (None, base, "en", "a"),
            (None, "something else without an id " * 12, "en", None), (3, "alone here with some words of its own " * 7, "en", "b"), (4, None, "en", "a"), (5, "", None, "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars int, first string, slot int, component_id int"
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 1) for r in rows], schema)


def test_near_copies_by_row(spark, odd):
    left = sorted((r.doc_id, (r.text or "")[:9]) if r.doc_id is not None else (-1, r.text[:9]) for r in corpus_pipeline.drop_near_copies(spark, odd, SF).collect())
    assert left == [(-1, "something"), (1, "quite ano"), (1, "word0 lor"), (3, "alone her"), (4, ""), (5, "")]
    assert corpus_pipeline.drop_near_copies(spark, odd.where("false"), SF).collect() == []


def test_stages_take_odd_and_empty_tables(spark, odd):
    for docs in (odd, odd.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            after = cut_lineage(stage(spark, docs, SF), "test-odd")
            if name != "token blocks":
                assert after.columns == odd.columns
            docs = after
    assert docs.count() == 0


def test_language_of_few_or_no_labelled_rows(spark, odd):
    """Without a label texts with letters stay; a language of a few long texts is learned."""
    from recordloom.llm import language

    bare = odd.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, bare, SF).count() == odd.where("length(text) > 0").count()
    long = spark.createDataFrame([(i, "ein langer Text " * 500, "de") for i in range(3)], "doc_id long, text string, lang string")
    assert language.training_rows(long, F.lit(True), limit=1).count() >= 1
