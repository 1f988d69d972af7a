"""Diagonal voting: the base against a plain search, merged spans, long templates and odd tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from recordloom.llm import license_scan
from recordloom.llm.tables import table

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_FULL = {template: label for label, template in license_scan.TEMPLATES}


def scan(spark, texts: list[str | None]) -> dict[int, object]:
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    return {r.doc_id: r for r in got}


def plain_base(text: str | None) -> tuple:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = _WORD.findall(lower)
    found = []
    for label, phrase in license_scan.PHRASES:
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(want)] == want]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def test_base_equals_a_plain_search(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    # phrases at the front, at the end and within, broken by other words in some rows
    planted = docs.where("doc_id % 3 = 0").select(
        (F.col("doc_id") + 10_000_000).alias("doc_id"),
        F.concat(F.lit("CC by cc-BY\nby "), F.coalesce("text", F.lit("")), F.lit(" All rights\treserved. General public, licenses. General Public License cc")).alias("text"),
    )
    both = docs.unionByName(planted).cache()
    want = {r.doc_id: plain_base(r.text) for r in both.collect()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scan_licenses(both).collect()}
    assert got == want and sum(n for _, n, *_ in want.values()) > 100
    both.unpersist()


def test_a_repeated_pair_does_not_part_neighbouring_diagonals(spark):
    notice = "you may not use this file except in compliance with the license {} you may obtain a copy of the license at"
    got = scan(spark, [notice.format(w) for w in ("", "dnl", "dnl rem", "rem " * 40)])
    assert [got[i].labels for i in range(4)] == ["apache-2.0"] * 3 + [""]
    assert got[0].score == 1.0 and got[3].score < license_scan.LEAST_COVER


@pytest.mark.parametrize("template", sorted(_FULL))
def test_each_template_is_found_whole_but_not_by_its_half(spark, template):
    words = template.split()
    got = scan(spark, [" ".join(words).upper(), "x y " * 50 + " ".join(words) + " z", " ".join(words[:len(words) // 2])])
    assert _FULL[template] in got[0].labels.split(",") and got[0].score == 1.0
    assert _FULL[template] in got[1].labels.split(",") and got[1].n_words == 101 + len(words)


def test_templates_of_any_length_keep_all_their_places(spark):
    longest = max(_FULL, key=lambda t: len(t.split()))
    words = longest.split()
    assert len(words) > 64
    number = len(license_scan.PHRASES) + [t for _, t in license_scan.TEMPLATES].index(longest)
    texts = [longest, " ".join(words[:70]), " ".join(words[70:])]
    found = license_scan.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where(F.col("template") == number)
    cover = {r.doc_id: r.cover for r in found.groupBy("doc_id").agg(F.max("cover").alias("cover")).collect()}
    pairs = len(words) - 1
    assert cover == {0: 1.0, 1: pytest.approx(69 / pairs), 2: pytest.approx((pairs - 70) / pairs)}


def test_long_texts_and_clashing_names(spark):
    filler = "word " * 300_000
    rows = [(1, filler + "All rights reserved " + filler, "h", "w", "l", 1), (1, filler + "All rights reserved " + filler, "h", "w", "l", 2), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, words string, label string, pos int")
    got = license_scan.scan_licenses(docs).collect()
    assert len(got) == 3
    assert {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.labels) for r in got} == {(1, 600_003, 1, 300_000, 300_000, "reserved"), (None, 0, 0, None, None, "")}
