import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings as hsettings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from recordloom.functions.similarity import _scores, jaro_winkler, jaro_winkler_above, jaro_winkler_pairs
from recordloom.operators import blocking, components, model, resolution, training
from recordloom.operators.blocking import block_on
from recordloom.operators.model import MatchModel, exact_match, jaro_winkler_at

words = st.lists(st.tuples(st.text("ABCD ", max_size=80), st.text("ABCD ", max_size=80)), min_size=1, max_size=20)


@hsettings(max_examples=40, deadline=None)
@given(words)
def test_jaro_winkler_equals_duckdb(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    want = [r[0] for r in duckdb.execute(
        "SELECT jaro_winkler_similarity(x, y) FROM (SELECT unnest(?) AS x, unnest(?) AS y, unnest(range(?)) AS i) ORDER BY i", [a, b, len(a)]
    ).fetchall()]
    assert np.allclose(jaro_winkler_pairs(a, b), want, atol=1e-12)


def _duckdb(a, b):
    found = duckdb.execute("SELECT jaro_winkler_similarity(x, y) FROM (SELECT unnest(?) AS x, unnest(?) AS y, unnest(range(?)) AS i) ORDER BY i", [a, b, len(a)])
    return [r[0] for r in found.fetchall()]


@pytest.mark.parametrize("letters", ["AB", "ABCDEFGHIJKLMNOPQRSTUVWXYZ     "])
def test_strings_of_any_length_equal_duckdb(letters):
    """Lengths far apart, so that windows leave positions behind, and more cells than one piece holds."""
    rng = random.Random(3)
    text = lambda: "".join(rng.choice(letters) for _ in range(int(10 ** rng.uniform(0, 3.7))))
    a, b = [text() for _ in range(400)], [text() for _ in range(400)]
    a += [x + "Z" * 700 + y for x, y in zip(a[:50], b)]
    b += [x + "Y" * 600 + y for x, y in zip(a[:50], b)]
    assert np.allclose(jaro_winkler_pairs(a, b), _duckdb(a, b), atol=1e-12)
    assert jaro_winkler_pairs(["é" * 600, "", "\U0001F600x" * 999], ["é" * 600, "x", "\U0001F600x" * 999]).tolist() == [1.0, 0.0, 1.0]


def test_common_characters_bound_the_score():
    rng = random.Random(4)
    a = ["".join(rng.choice("ABCDEFGH") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    b = ["".join(rng.choice("EFGHIJKL" if i % 2 else "ABCDEFGH") for _ in range(rng.randint(0, 900))) for i in range(60)]
    left, right = np.repeat(np.arange(60), 60), np.tile(np.arange(60), 60)
    whole, cut = _scores(a, b, left, right, None), _scores(a, b, left, right, 0.7)
    assert np.isnan(cut).any() and (whole[np.isnan(cut)] < 0.7).all()
    assert np.array_equal(whole[~np.isnan(cut)], cut[~np.isnan(cut)])


def test_similarity_column(spark):
    pairs = [("ALPHA", "ALPHB"), (None, "X"), ("X", None), ("ALPHA", "ALPHB"), ("Q" * 900, "Q" * 899 + "R"), ("ABC", "XYZ"), ("SAME", "SAME"), ("", "X")]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    whole = [r[0] for r in df.select(jaro_winkler(F.col("a"), F.col("b"))).collect()]
    assert [w is None for w in whole] == [a is None or b is None for a, b in pairs]
    assert np.allclose([w for w in whole if w is not None], _duckdb(*map(list, zip(*[p for p in pairs if None not in p]))))
    above = [r[0] for r in df.select(jaro_winkler_above(F.col("a"), F.col("b"), 0.7)).collect()]
    assert [x is not None for x in above] == [True, False, False, True, True, False, False, False]


COMPARISONS = (exact_match("eid", True), jaro_winkler_at("name", term_frequency=True), exact_match("city"))
COLUMNS = [c.column for c in COMPARISONS]
RULES = (block_on("eid"), block_on("name"), block_on(("name", 2), "city"))


def _records(spark, seed=1, n=80, link_type="link_and_dedupe"):
    rng = random.Random(seed)
    names = ["ALPHA", "ALPHB", "ALTO", "BETA", "BETAX", "GAMMA"]
    data = [
        (f"s{rng.randint(0, 2)}", str(i), rng.choice([None, "e1", "e2", "e3", "e4"]), rng.choice([*names, None]), rng.choice(["x", "y", None]))
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, city string")
    return data, blocking.with_profile_id(df, COLUMNS, link_type)


def _agrees(a, b):
    same = lambda i, k=None: a[i] is not None and b[i] is not None and a[i][:k] == b[i][:k]
    return same(2) or same(3) or (same(3, 2) and same(4))


def _brute(data, link_type="link_and_dedupe"):
    for i, a in enumerate(data):
        for b in data[i + 1 :]:
            if _agrees(a, b) and {"link": a[0] != b[0], "dedupe": a[0] == b[0]}.get(link_type, True):
                yield tuple(sorted([f"{a[0]}-__-{a[1]}", f"{b[0]}-__-{b[1]}"]))


@pytest.mark.parametrize("link_type", blocking.LINK_TYPES)
@pytest.mark.parametrize("cell_rows", [3, 4096])
def test_folded_pairs_stand_for_every_record_pair(spark, link_type, cell_rows):
    data, records = _records(spark, link_type=link_type)
    profiles = blocking.profiles(records, COLUMNS, link_type)
    pairs = blocking.all_pairs(profiles, RULES, link_type, cell_rows)
    want = list(_brute(data, link_type))
    assert pairs.agg(F.sum("n_pairs")).first()[0] == len(want)
    spelled = resolution.expand_pairs(pairs.withColumns({"match_weight": F.lit(0.0), "match_probability": F.lit(1.0)}), records)
    assert sorted(tuple(sorted(r)) for r in spelled.select("node_l", "node_r").collect()) == sorted(want)


def test_one_hot_profile_makes_no_pairs(spark):
    """A third of all rows being copies costs one folded row."""
    data = [("s0", str(i), "e", "SAME", "x") for i in range(300)] + [("s1", str(i), None, f"N{i}", None) for i in range(600)]
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, city string")
    profiles = blocking.profiles(blocking.with_profile_id(df, COLUMNS), COLUMNS)
    pairs = blocking.all_pairs(profiles, RULES)
    assert pairs.count() == 1 and pairs.first()["n_pairs"] == 300 * 299 // 2


MODEL = MatchModel(COMPARISONS, 0.05, {
    "eid": {0: (0.2, 0.9), 1: (0.8, 0.1)},
    "name": {0: (0.05, 0.7), 1: (0.1, 0.1), 2: (0.25, 0.1), 3: (0.6, 0.1)},
    "city": {0: (0.3, 0.5), 1: (0.7, 0.5)},
})


@pytest.mark.parametrize("threshold", [0.01, 0.5, 0.9, 0.99])
def test_pruned_prediction_equals_scoring_every_candidate(spark, threshold):
    _, records = _records(spark)
    profiles = model.with_term_frequencies(blocking.profiles(records, COLUMNS), COMPARISONS, "n_records")
    everything = model.score_pairs(model.comparison_vectors(blocking.all_pairs(profiles, RULES), COMPARISONS), MODEL)
    want = everything.where(F.col("match_probability") >= threshold)
    got = resolution.predict(profiles, RULES, MODEL, threshold)
    shape = [F.col("l.pid").alias("a"), F.col("r.pid").alias("b"), F.round("match_weight", 9).alias("w"), "n_pairs"]
    assert rows(got.select(*shape)) == rows(want.select(*shape))


def test_required_equalities():
    sharp = MatchModel(COMPARISONS, 1e-6, {**MODEL.parameters, "eid": {0: (0.2, 0.9), 1: (0.8, 1e-6)}})
    assert model.required_equalities(sharp, 0.9) == [frozenset({"eid"}), frozenset({"name"})]
    assert frozenset() in model.required_equalities(MODEL, 0.01)
    refined = resolution.pruned_rules(RULES, sharp, 0.9)
    assert {r.name for r in refined} == {"eid", "name"}


def test_frequent_values_are_not_paired_as_a_whole(spark):
    """A value too frequent to carry a pair meets only where the rows agree on more; no passing pair is lost."""
    rng = random.Random(8)
    data = [(f"s{i % 3}", str(i), f"e{i // 2 if i % 9 == 0 else i}", "SAME" if i % 3 else f"N{i % 40}", rng.choice(["x", "y", None])) for i in range(240)]
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, city string")
    records = blocking.with_profile_id(df, COLUMNS)
    profiles = model.with_term_frequencies(blocking.profiles(records, COLUMNS), COMPARISONS, "n_records").localCheckpoint()
    sharp = MatchModel(COMPARISONS, 0.001, {
        "eid": {0: (0.4, 0.99), 1: (0.6, 0.01)}, "name": {0: (0.2, 0.7), 1: (0.2, 0.2), 2: (0.1, 0.09), 3: (0.5, 0.01)}, "city": MODEL.parameters["city"],
    })
    everything = model.score_pairs(model.comparison_vectors(blocking.all_pairs(profiles, RULES), COMPARISONS), sharp)
    shape = [F.col("l.pid").alias("a"), F.col("r.pid").alias("b"), F.round("match_weight", 9).alias("w"), "n_pairs"]
    for threshold in (0.002, 0.05, 0.5, 0.9, 0.999):
        got = resolution.predict(profiles, RULES, sharp, threshold)
        assert rows(got.select(*shape)) == rows(everything.where(F.col("match_probability") >= threshold).select(*shape))
    assert blocking.profile_pairs(profiles, [block_on("name")]).count() > 12_000
    assert blocking.profile_pairs(profiles, resolution.rare_rules(RULES, sharp, 0.05)).count() < 1_000


def test_components_do_not_depend_on_edge_order(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randint(0, 150):03d}", f"n{rng.randint(0, 150):03d}") for _ in range(110)]
    edges += [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(40)]  # a long path
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = sorted((x, find(x)) for x in parent if any(x in e and e[0] != e[1] for e in edges))
    for _ in range(2):
        rng.shuffle(edges)
        df = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges], "a string, b string")
        assert rows(components.connected_components(df, "a", "b"), "node", "component") == want
    assert components.connected_components(df.where("a < ''"), "a", "b").count() == 0


def test_unmatched_copies_stay_apart_and_matched_ones_join(spark):
    data = [("s0", "1", None, "ALPHA", None), ("s0", "2", None, "ALPHA", None), ("s1", "3", "e", "ALPHA", "x"), ("s1", "4", "e", "ALPHA", "x"),
            ("s1", "5", None, None, "y"), ("s1", "6", None, None, "y")]
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, city string")
    records = blocking.with_profile_id(df, COLUMNS)
    profiles = blocking.profiles(records, COLUMNS)
    plain = MatchModel((exact_match("eid"), jaro_winkler_at("name"), exact_match("city")), MODEL.prior, MODEL.parameters)
    placed = resolution.cluster(profiles, resolution.predict(profiles, RULES, plain, 0.5), 0.5)
    links = resolution.links(records, placed, {"s0": "k0", "s1": "k1"})
    groups = {}
    for r in links.collect():
        groups.setdefault(r["cluster_id"], []).append(r["primary_key_id"])
    assert ["3", "4"] in [sorted(g) for g in groups.values()]
    assert all([k] in groups.values() for k in "1256")
    assert links.count() == 6 and {r["primary_key_type"] for r in links.collect()} == {"k0", "k1"}


def test_random_pairs_cover_everything_when_few(spark):
    _, records = _records(spark, n=40)
    pairs = training.random_pairs(records, COLUMNS, 40)
    assert pairs.count() == 40 * 39 // 2
    some = training.random_pairs(records, COLUMNS, 40, max_pairs=100).count()
    assert 20 <= some <= 250


def test_em_recovers_planted_parameters():
    truth_m = {"a": {0: 0.1, 1: 0.9}, "b": {0: 0.2, 1: 0.8}, "c": {0: 0.05, 1: 0.95}}
    u = {"a": {0: 0.9, 1: 0.1}, "b": {0: 0.8, 1: 0.2}, "c": {0: 0.95, 1: 0.05}}
    comparisons = [exact_match(x) for x in "abc"]
    patterns = []
    for levels in [(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]:
        p_m = p_u = 1.0
        for c, g in zip("abc", levels):
            p_m *= truth_m[c][g]
            p_u *= u[c][g]
        patterns.append((levels, round(1e6 * (0.3 * p_m + 0.7 * p_u))))
    found = training.expectation_maximisation(patterns, comparisons, u, iterations=200, tolerance=1e-7)
    assert found.converged and len(found.likelihoods) < 200 and abs(found.prior - 0.3) < 0.01
    assert all(abs(found.m[c][g] - truth_m[c][g]) < 0.02 for c in "abc" for g in (0, 1))
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(found.likelihoods, found.likelihoods[1:]))
    assert not training.expectation_maximisation(patterns, comparisons, u, iterations=3).converged
    assert training.expectation_maximisation([], comparisons, u).m == {}


def test_a_step_in_spark_equals_a_round_on_collected_counts(spark):
    comparisons = [exact_match("a"), jaro_winkler_at("b")]
    u = {"a": {0: 0.9, 1: 0.1}, "b": {0: 0.7, 1: 0.1, 2: 0.1, 3: 0.1}}
    patterns = [((0, 0), 50), ((1, 3), 20), ((-1, 1), 5), ((1, -1), 7), ((0, 3), 2)]
    frame = spark.createDataFrame([(*p, n) for p, n in patterns], "gamma_a int, gamma_b int, n bigint")
    start = training.start_values(comparisons)
    got = training.em_step(frame, comparisons, start, u, 0.1).collect()
    one = training.expectation_maximisation(patterns, comparisons, u, 0.1, iterations=1)
    assert all(abs(r.prior - one.prior) < 1e-12 and abs(r.log_likelihood - one.likelihoods[0]) < 1e-9 for r in got)
    assert {(r.comparison, r.level) for r in got} == {(c.column, g) for c in comparisons for g in c.levels}
    for r in got:
        assert (r.n == 0) == (r.level not in one.m[r.comparison])
        assert r.m == pytest.approx(one.m[r.comparison].get(r.level, 0.0), abs=1e-12)
    assert all(r.m is None for r in training.em_step(frame.where("false"), comparisons, start, u, 0.1).collect())


def test_sessions_are_combined_by_median():
    got = training.combine_sessions([{"a": {0: 0.1}}, {"a": {0: 0.3, 1: 0.5}}, {"a": {0: 0.2}}])
    assert got == {"a": {0: 0.2, 1: 0.5}}


def test_model_survives_json(spark, tmp_path):
    path = str(tmp_path / "m")
    model.save_model(spark, MODEL, path)
    back = model.load_model(spark, path)
    assert back == MatchModel(MODEL.comparisons, MODEL.prior, {c: {g: tuple(v) for g, v in lv.items()} for c, lv in MODEL.parameters.items()})
    assert back.untrained() == [] and back.to_frame(spark).count() == 8


def test_training_runs_end_to_end(spark):
    _, records = _records(spark, n=120)
    profiles = blocking.profiles(records, COLUMNS)
    trained = training.train(records, profiles, COMPARISONS, [block_on("eid", "name")], [block_on("name"), block_on("eid")])
    assert 0 < trained.prior < 1
    assert set(trained.parameters) == set(COLUMNS)
    assert [x[0] for x in trained.sessions] == ["name", "eid"] and all(0 < rounds < 25 or not settled for _, rounds, settled in trained.sessions)
    assert MatchModel.from_json(trained.to_json()).sessions == trained.sessions


@pytest.mark.parametrize("name", ["u_estimate", "em_train", "end_to_end"])
def test_training_queries_draw_the_default_number_of_pairs(spark, monkeypatch, name):
    from recordloom.settings import MAX_RANDOM_PAIRS
    from recordloom.suite import corpus, matching, merging

    class Drawn(Exception):
        pass

    def draw(records, columns, n_records, max_pairs=MAX_RANDOM_PAIRS, salt="u"):
        raise Drawn(max_pairs)

    monkeypatch.setattr(training, "random_pairs", draw)
    run = getattr(merging if name == "end_to_end" else matching, name)
    with pytest.raises(Drawn) as drawn:
        run(spark, "/root/testdata/sf0.001")
    assert drawn.value.args == (10_000_000,)


SHARP = MatchModel(COMPARISONS, 1e-3, {**MODEL.parameters, "name": {0: (0.05, 0.7), 1: (0.1, 0.25), 2: (0.25, 0.01), 3: (0.6, 0.01)}})


def test_spanning_predictions_connect_what_all_predictions_connect(spark):
    rng = random.Random(1)
    pick = lambda *values: rng.choice(values)
    data = [(f"s{rng.randint(0, 2)}", str(i), pick(None, f"e{i % 40}", f"e{i}"), pick(None, f"NAME{i % 60}", f"ALPHA{i % 30}X", "MANY"), pick("x", "y", None)) for i in range(400)]
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, city string")
    profiles = model.with_term_frequencies(blocking.profiles(blocking.with_profile_id(df, COLUMNS), COLUMNS), COMPARISONS, "n_records").cache()
    every = resolution.predict(profiles, RULES, SHARP, 0.5).cache()
    some = resolution.spanning_predictions(profiles, RULES, SHARP, 0.5).cache()
    shape = ["l.pid", F.col("r.pid").alias("other"), F.round("match_probability", 9)]
    assert {tuple(r) for r in some.select(*shape).collect()} <= {tuple(r) for r in every.select(*shape).collect()}
    want = rows(resolution.cluster(profiles, every, 0.5), "pid", F.coalesce("cluster_id", F.lit("")))
    assert rows(resolution.cluster(profiles, some, 0.5), "pid", F.coalesce("cluster_id", F.lit(""))) == want
    assert len({w[1] for w in want}) < len(want)


def test_pairs_of_a_connected_block_are_not_all_predicted(spark):
    n = 60
    data = [("s0", str(i), f"e{i}", "HOT NAME", "x") for i in range(n)] + [("s1", str(i), None, f"{i * 7919} N{i}", None) for i in range(6000)]
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, city string")
    profiles = model.with_term_frequencies(blocking.profiles(blocking.with_profile_id(df, COLUMNS), COLUMNS), COMPARISONS, "n_records").cache()
    likely = MatchModel(COMPARISONS, 0.1, SHARP.parameters)
    assert resolution.predict(profiles, [block_on("name")], likely, 0.5).count() == n * (n - 1) // 2
    found = resolution.spanning_predictions(profiles, [block_on("name")], likely, 0.5).cache()
    assert found.count() == n - 1
    assert resolution.cluster(profiles, found, 0.5).groupBy("cluster_id").count().agg(F.max("count")).first()[0] == n
