"""Operators for training data against brute force on small tables, with the awkward cases in them."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.llm import contamination, html_text, language, language_model, license_scan, mixture, near_dedup, neighbours, token_blocks, toxicity
from recordloom.llm.queries import tokenizer_path
from recordloom.llm.tables import crc_fold

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, language string, own string"


def lower(text):
    return (text or "").encode().lower()


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text or ""), 0.5, "x", "y")


def prose(rng, n, words=("alpha", "beta", "Gamma.", "delta,", "épsilon", "zeta")):
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    """Nulls, empty and long texts, copies, near copies, repeated rows, null and repeated ids."""
    rng = random.Random(5)
    base = prose(rng, 120)
    out = [row(i, prose(rng, rng.randrange(1, 200)), ("en", "fr")[i % 2], ("a", "b", "c")[i % 3]) for i in range(40)]
    out += [row(100 + i, base + f" tail{i}", source="b") for i in range(6)]
    out += [row(200, base), row(201, base), row(201, base), row(202, None, None, None), row(203, ""), row(204, " \t\n"), row(205, "12 34 !!")]
    out += [row(206, prose(rng, 30_000)), row(207, "Short one"), row(208, "short ONE"), row(None, base), row(None, "no id at all", None, None)]
    return out


@pytest.fixture(scope="module")
def frame(spark, docs):
    return spark.createDataFrame(docs, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = SPACED.findall(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def test_near_duplicates_match_all_pairs(frame, docs, empty):
    sets = {}
    for d in docs:
        if d[0] is not None:
            sets.setdefault(d[0], []).append(shingles(d[1], 4))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(x and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    got = near_dedup.near_duplicates(frame, k=4).collect()
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (find(r.doc_id), find(r.doc_id) == r.doc_id)
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
    assert near_dedup.near_duplicates(empty).collect() == []


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[500:2500]
    same = np.mean(near_dedup.circulant_signature(a, 512) == near_dedup.circulant_signature(b, 512))
    assert abs(same - 0.6) < 0.1


def test_bounds_before_verification_lose_no_similar_pair(spark):
    rng = np.random.default_rng(5)
    rows = []
    for n in (12, 60, 300, 2500):
        base = [f"w{x}" for x in rng.integers(0, 10**6, n)]
        for edits in range(0, n // 8 + 1, max(1, n // 60)):
            own = list(base)
            for at in rng.choice(n, edits, replace=False):
                own[at] = f"x{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    grams = {i: {tuple(w[j:j + 4]) for j in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in rows)}
    sig = near_dedup.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    x = sig.select(F.col("doc_id").alias("a"), *near_dedup.sketch_columns("x"))
    y = sig.select(F.col("doc_id").alias("b"), *near_dedup.sketch_columns("y"))
    passed = {(r.a, r.b) for r in x.join(y, F.col("a") < F.col("b")).where(near_dedup.may_be_similar(80)).select("a", "b").collect()}
    every = [(a, b) for a in grams for b in grams if a < b]
    similar = {(a, b) for a, b in every if 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])}
    assert similar and similar <= passed and len(passed) < len(every) / 2


def test_contamination_matches_brute_force(spark, frame, docs, empty):
    long = next(d[1] for d in docs if d[0] == 206)
    items = [(1, " ".join(long.split()[50:80])), (2, "Short ONE!"), (3, None), (4, "..."), (None, "no id"), (5, "Short one"), (5, "Short one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = []
    for item, text in items:
        w = PLAIN.findall(lower(text))
        k = min(13, len(w))
        windows += [(item, tuple(w[i:i + k])) for i in range(len(w) - k + 1) if k]
    want = []
    for d in docs:
        w = PLAIN.findall(lower(d[1]))
        hit, named = set(), set()
        for item, g in windows:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    named |= {str(item)} if item is not None else set()
        want.append((d[0] or -1, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    got = contamination.contamination(frame, bench).collect()
    assert sorted((r[0] or -1, *r[1:]) for r in got) == sorted(want)
    assert contamination.contamination(empty, bench).collect() == []
    assert contamination.contamination(frame, bench.limit(0)).where("n_hit > 0").count() == 0
    kept = contamination.remove_contaminated(frame, bench)
    assert kept.columns == frame.columns and kept.count() == sum(not w[5] for w in want)
    cut = {r.doc_id: r.text for r in contamination.remove_spans(frame, bench).collect()}
    assert cut[207] == "" and cut[202] is None and len(cut[206].split()) == 30_000 - 30


def test_language_models_are_distributions_and_tell_languages(spark, frame, empty):
    rows = spark.createDataFrame([("en", "the cat and the hat " * 9), ("fr", "le chat et le chapeau " * 9), ("en", ""), ("fr", "x")], "lang string, text string")
    models = language.train(rows)
    for context in (b"", b"t", b"th", b"the", b"zzz", b"le "):
        k = len(context)
        head = int.from_bytes(context, "big") << 8
        bits = models.bits(np.arange(256, dtype=np.uint64) + np.uint64(head), k)
        assert np.allclose(np.exp2(-bits.astype(np.float64)).sum(axis=0), 1, atol=1e-4)
    texts = spark.createDataFrame([(1, "the hat"), (2, "le chapeau"), (3, None), (4, ""), (5, "12 -"), (None, "et le")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.with_language(texts, models).collect()}
    assert [got[i].language.lang_pred for i in (1, 2, 3, 4, 5, None)] == ["en", "fr", "und", "und", "und", "fr"]
    assert all(0 <= r.language.score <= 1 for r in got.values())
    assert language.identify(empty, F.lit(True)).collect() == []
    none = language.keep_identified(frame, F.lit(True))
    assert none.columns == frame.columns and none.where("doc_id IN (202, 203, 204, 205)").count() == 0


def test_base_score_and_normalisation(frame, docs, empty):
    fold = crc_fold("doc_id", 7)
    got = language_model.score(frame, fold != 2).collect()
    learned = [d for d in docs if zlib.crc32(str(d[0] if d[0] is not None else "").encode()) % 7 != 2]
    count = Counter(w for d in learned for w in [*SPACED.findall(lower(d[1])), None])
    n, v = sum(count.values()), len(count)
    want = sorted((d[0] or -1, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*SPACED.findall(lower(d[1])), None]), 6)) for d in docs)
    assert sorted((r.doc_id or -1, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    assert language_model.score(empty, fold != 2).collect() == []
    rng = np.random.default_rng(0)
    net = language_model.LogBilinear(rng.normal(size=(8, 4)).astype(np.float32), np.ones((3, 4), np.float32), rng.normal(size=(7, 4)).astype(np.float32), np.zeros(7, np.float32))
    before = np.tile([[1, 2, 3]], (7, 1))
    assert np.isclose(np.exp(net.log_probability(before, np.arange(7))).sum(), 1, atol=1e-5)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_neighbours_with_a_far_vector_and_a_far_mean(spark, kind):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(1500, 12)) + 1000).astype(np.float32).astype(np.float64)
    x[7] = 1e10
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    got = neighbours.nearest(rows, F.col("vec_id") % 50 == 0).collect()
    hits = 0
    for q in range(0, 1500, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.97 * 300


def test_neighbours_without_structure_are_all_found(spark, monkeypatch):
    """Spread vectors of many dimensions and clumps the graph does not connect: every nearest row, in order, with ties."""
    monkeypatch.setattr(neighbours, "CHECK_NODES", 300)
    monkeypatch.setattr(neighbours, "CHECK_QUERIES", 16)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2400, 48)).round(2)
    x[1500:] = np.repeat(rng.normal(size=(100, 48)) * 9, 9, axis=0).round(2) + rng.integers(0, 2, (900, 48)) / 4
    x[40:60] = np.eye(20, 48)
    x[60:70] = x[60]
    x = x.astype(np.float32).astype(np.float64)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.nearest(rows, F.col("vec_id") % 20 == 0).collect()
    for q in range(0, 2400, 20):
        total = np.zeros(len(x))
        for j in range(48):
            total += (x[:, j] - x[q, j]) ** 2
        d = np.sqrt(total)
        best = [int(j) for j in np.lexsort((np.arange(len(x)), d)) if j != q][:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert own == [(i + 1, j, d[j]) for i, j in enumerate(best)]


def test_language_model_trains_on_every_row_in_parts(spark, monkeypatch):
    monkeypatch.setattr(language_model, "PART_BYTES", 500_000)
    cycle = " ".join(f"w{i}" for i in range(600))
    docs = spark.createDataFrame([(i, f"{cycle} " * 35) for i in range(20)], "doc_id long, text string")
    counts = language_model.word_counts(docs)
    shared = spark.sparkContext.broadcast(language_model.vocabulary(counts))
    assert shared.value.own == 600 and shared.value.outputs == 600 + 1 + language_model.SUFFIX_CLASSES
    stored = language_model.encoded(docs, shared)
    assert len(stored.inputFiles()) > 1
    assert stored.agg(F.sum(F.octet_length("sequence")) / 4).first()[0] == shared.value.tokens == 20 * (600 * 35 + 1)
    assert all(r.score > r.base_score / 2 for r in language_model.score(docs, F.lit(True)).collect())


def test_licenses_match_brute_force(spark, empty):
    texts = ["All rights reserved. CC BY, and cc-by again", None, "", "Licensed under the Apache License, Version 2.0.", "rights reserved", "General Public, License",
             "This program is free software: YOU can now redistribute it and/or modify it under the terms of the GNU General Public License"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "cc by")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert (by[0].n_base, by[0].first_word, by[0].last_word, by[0].base_labels) == (3, 0, 6, "cc-by,reserved")
    assert (by[1].n_words, by[1].n_base, by[1].first_word, by[1].labels) == (0, 0, None, "")
    assert by[3].labels == "apache-2.0" and by[3].score == 1.0 and by[4].n_base == 0
    assert by[5].base_labels == "gpl" and by[6].labels == "gpl,gpl-notice" and by[None].n_base == 1
    assert license_scan.scan_licenses(empty).collect() == []


def test_mixture_fills_targets(frame, docs, empty):
    got = mixture.mix(frame).docs.collect()
    assert len(got) == len(docs)
    sizes = Counter()
    for d in docs:
        sizes[d[3]] += len(SPACED.findall((d[1] or "").encode()))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    stopped = {}
    while True:
        level = (sum(sizes.values()) - sum(stopped.values())) / max(1, sum(weight[s] for s in names if s not in stopped))
        more = [s for s in names if s not in stopped and level * weight[s] > 3 * sizes[s]]
        if not more:
            break
        stopped |= {s: 3 * sizes[s] for s in more}
    target = {s: stopped.get(s, level * weight[s]) for s in names}
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert abs(r.target - target[r.source]) < 1e-6 and r.taken <= 3 * r.size and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    mixed = mixture.mixed_documents(frame)
    assert mixed.columns == frame.columns
    largest, dealt, given, whole = Counter(), Counter(), Counter(), {tuple(r) for r in frame.collect()}
    for d in docs:
        largest[d[3]] = max(largest[d[3]], len(SPACED.findall((d[1] or "").encode())))
        given[d[3]] += 1
    for r in mixed.collect():
        assert tuple(r) in whole  # no text is cut
        dealt[r.source] += len(SPACED.findall((r.text or "").encode()))
    assert all(abs(dealt[s] - target[s]) <= largest[s] / 2 + 1 for s in names)
    assert mixture.mix(empty).docs.collect() == [] and mixture.mixed_documents(empty).collect() == []


def test_the_sequence_sets_the_order_of_the_mixture(frame, monkeypatch):
    """Documents fill the slots that the golden ratio deals to their source; another sequence deals others."""
    made = mixture.mix(frame)
    golden = {r.row: r.first_slot for r in made.docs.collect()}
    targets = sorted(made.sources.collect(), key=lambda r: r.source_id)
    total, block = sum(r.source_size for r in targets), made.block
    ranks, slots = Counter(), {}
    for i in range(-(-total // block)):
        u, high = i * 0.6180339887498949 % 1, 0.0
        for r in targets:
            high += r.target / total
            if u < high:
                slots[r.source_id, ranks[r.source_id]] = i
                ranks[r.source_id] += 1
                break
    rows_of = {(r.source_id, r["rank"]): r.slot for r in made.schedule.collect()}
    assert sum(rows_of.get(k) == v for k, v in slots.items()) >= len(slots) - 3 * len(targets)  # but for the ends of the targets
    assert set(golden.values()) - {None} <= set(rows_of.values())
    order = [r.source for r in mixture.mixed_documents(frame).collect()]
    monkeypatch.setattr(mixture, "_GOLDEN", 0.25)
    other = mixture.mix(frame).docs.collect()
    assert [r.first_slot for r in other] != [golden[r.row] for r in other]
    assert [r.source for r in mixture.mixed_documents(frame).collect()] != order


def test_coder_round_trips_and_rejects_damage():
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 65_536, 5000), np.full(7000, 9), np.tile(rng.integers(0, 300, 50), 120), np.array([2]), rng.zipf(1.3, 9000) % 49_408]
    coded = token_blocks.encode_blocks(blocks)
    for a, b in zip(blocks, token_blocks.decode_blocks([len(b) for b in blocks], coded)):
        assert np.array_equal(a, b)
    assert sum(map(len, coded[2])) < 2 * 6000 / 4
    whole = token_blocks.pack([1, None], [2, 4998], blocks[0], coded[0])
    names, sizes, n, _, lanes = token_blocks.unpack(whole)
    assert (names, sizes.tolist(), n, lanes) == ([1, None], [2, 4998], 5000, coded[0])
    with pytest.raises(ValueError):
        token_blocks.unpack(whole[:100] + b"\xff" + whole[101:])


def test_token_ids_match_the_library(frame, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for d in docs:
        ids = library.encode(d[1] or "", add_special_tokens=False).ids + [2]
        want[(d[0] or -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    got = token_blocks.token_ids(frame, tokenizer_path()).collect()
    assert Counter((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id if r.doc_id is not None else -1 for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    assert token_blocks.token_ids(empty, tokenizer_path()).collect() == []
    odd = [b"<|endoftext|>x", "Ångström  é".encode(), b"it's 123"]
    for text, ids in zip(odd, token_blocks.tokenizer(tokenizer_path()).encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text.decode(), add_special_tokens=False).ids


def test_neighbours_recall_and_cases(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8)).round(3)
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] * 8), (None, rows[1][1]), (2004, [1.0, 2.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect()
    ids = [i for i, v in rows if i is not None and i not in range(2000, 2005)]
    y = np.array([v for i, v in rows if i in set(ids)], dtype=np.float32).astype(float)
    found, total = 0, 0
    for q in [i for i in ids if i % 100 == 0]:
        d = np.sqrt(((y - y[ids.index(q)]) ** 2).sum(axis=1))
        best = [ids[j] for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        own = {r.rank: r for r in got if r.query_id == q}
        assert sorted(own) == list(range(1, 11))
        assert all(abs(r.score - d[ids.index(r.vec_id)]) < 1e-9 for r in own.values())
        found += len(set(best) & {r.vec_id for r in own.values()})
        total += 10
    assert found >= 0.9 * total
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).collect() == []


def test_main_text():
    page = """<html><head><title>T</title><script>var t="</p><p>no";</script></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div class="cookie-notice">We use cookies, you know.</div><article><h1>Head &amp; line</h1><p>First  paragraph,\n with text.<p><b>Bold<br>two</p>
    <div class="ad">Buy now, cheap.</div><p>Last one &eacute;.</p><section id="comments"><p>Nice article, I think.</p></section></article>
    <aside>Other things, to read.</aside><form><p>Sign up.</p></form><footer>&copy; me</footer>"""
    assert html_text.main_text(page) == "Head & line\nFirst paragraph, with text.\nBold two\nLast one é."
    assert html_text.main_text("") == "" and html_text.main_text("<nav>a</nav>") == ""
    assert html_text.main_text("<p>a < b && c") == "a < b && c"


def test_main_text_loses_no_section_and_no_named_wrapper():
    long = " ".join(f"Sentence {i}, of the story." for i in range(200))
    short = " ".join(f"Another {i}, after it." for i in range(35))
    nav = "<nav><a href=/>Home</a></nav><footer>me</footer>"
    for tag in ("section", "div"):
        page = f"<body>{nav}<article><h1>Title</h1><{tag}>{long}</{tag}><h2><a href=#b>Two</a></h2><{tag}>{short}</{tag}></article></body>"
        assert html_text.main_text(page) == f"Title\n{long}\nTwo\n{short}"
    page = f"<body>{nav}<div><h1>Title</h1><p>{short}</p><section><p>{long}</p></section></div></body>"
    assert html_text.main_text(page) == f"Title\n{short}\n{long}"
    side = '<div class="sidebar"><p>Other things, to read.</p></div>'
    for name in ("has-sidebar", "elementor-widget"):
        page = f'<body>{nav}<div class="{name}"><p>{long}</p><p>{short}</p>{side}</div></body>'
        assert html_text.main_text(page) == f"{long}\n{short}"
    page = f'<body>{nav}<div class="comments"><p>{long}</p></div><article><h1>Title</h1><p>{short}</p></article></body>'
    assert html_text.main_text(page) == f"Title\n{short}"
    page = f'<body><article><h1>T</h1><p>{long}</p><p><a href="/more">The whole, linked paragraph.</a></p></article></body>'
    assert html_text.main_text(page) == f"T\n{long}\nThe whole, linked paragraph."


def test_extract_keeps_every_row(spark):
    pages = spark.createDataFrame([(1, "u", None, "z"), (1, "u", "<p>x.", "z"), (None, None, "", "z")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_text.extract(pages).collect()) == ["", "", "x."]


def test_toxicity_separates_planted_words(spark, frame, empty):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        rows.append((i, prose(rng, 40) + (" awful nasty" if bad else " lovely")))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "awful nasty")], "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, known, F.col("doc_id") % 2 == 0).collect()}
    assert all((got[i].predicted == 1) == (i % 5 == 0) for i in range(400)) and got[None].predicted == 1
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].predicted == 0
    assert {r.score for r in toxicity.score(docs, known.limit(0), F.lit(True)).collect()} == {0.0}
    assert toxicity.score(empty, known, F.lit(True)).collect() == []
