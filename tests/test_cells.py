import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordloom.functions.similarity import _jaro, _jaro_of_many, _number_characters, _scores, _Strings, similarities
from recordloom.operators import blocking, cells, model, resolution, training
from recordloom.operators.blocking import PackedPairs, block_on
from recordloom.operators.model import MatchModel, exact_match, jaro_winkler_at

COMPARISONS = (exact_match("eid", True), jaro_winkler_at("name", term_frequency=True), jaro_winkler_at("street"), exact_match("city"))
COLUMNS = [c.column for c in COMPARISONS]
GAMMAS = [c.gamma for c in COMPARISONS]
RULES = (block_on("eid"), block_on("name"), block_on(("name", 2), "city"), block_on(("name", 2), ("street", 1)), block_on(("name", 1)))
MODEL = MatchModel(COMPARISONS, 0.05, {
    "eid": {0: (0.2, 0.9), 1: (0.8, 0.1)},
    "name": {0: (0.05, 0.7), 1: (0.1, 0.1), 2: (0.25, 0.1), 3: (0.6, 0.1)},
    "street": {0: (0.05, 0.7), 1: (0.1, 0.1), 2: (0.25, 0.1), 3: (0.6, 0.1)},
    "city": {0: (0.3, 0.5), 1: (0.7, 0.5)},
})


@pytest.mark.parametrize("letters", ["AB", "ABCDEFGHIJKLMNOPQRSTUVWXYZ      ", "EÉ\U0001F600xyz"])
def test_one_string_with_many_partners_scores_as_pair_by_pair(letters):
    """Rare letters far apart are kept apart by the window."""
    rng = random.Random(5)
    weights = [2.0 ** -(i % 7) for i in range(len(letters))]
    left, right = (["".join(rng.choices(letters, weights, k=rng.randint(1, 300))) for _ in range(n)] for n in (40, 60))
    a, b = (np.array([rng.randrange(n) for _ in range(3000)]) for n in (40, 60))  # some pairs twice, some not at all
    p, t = _Strings(left), _Strings(right)
    alphabet = _number_characters(p, t)
    assert np.array_equal(_jaro_of_many(p, t, a, b, alphabet), _jaro(p, t, a, b, alphabet))
    assert np.array_equal(_scores(left, right, a, b, None), _scores(right, left, b, a, None))


def _profiles(spark, n=400, link_type="link_and_dedupe"):
    rng = random.Random(2)
    pick = lambda *values: rng.choice(values)
    data = [(f"s{rng.randint(0, 2)}", str(i), pick(None, f"e{i % 30}"), pick(None, "ALPHA", "ALPHB", "ALTO", "ALPHABET INC", "BETA", "BETAX", ""),
             pick(None, "MAIN STREET", "MAIN STRET", "MILL ROAD", "X"), pick("x", "y", None)) for i in range(n)]
    data += [("s0", f"c{i}", None, "ALPHA", "X", "x") for i in range(4)]  # copies
    df = spark.createDataFrame(data, "data_source string, unique_id string, eid string, name string, street string, city string")
    return blocking.profiles(blocking.with_profile_id(df, COLUMNS, link_type), COLUMNS, link_type).cache()


@pytest.mark.parametrize("link_type", blocking.LINK_TYPES)
@pytest.mark.parametrize("cell_rows", [7, 2048])
def test_packed_pairs_are_the_spelled_ones(spark, link_type, cell_rows):
    profiles = _profiles(spark, link_type=link_type)
    spelled = blocking.all_pairs(profiles, RULES, link_type)
    packed = blocking.all_pairs(profiles, RULES, link_type, cell_rows, packed=True)
    shape = ["rule", F.col("l.pid").alias("a"), F.col("r.pid").alias("b"), "n_pairs", *GAMMAS]
    assert rows(model.comparison_vectors(packed, COMPARISONS).select(*shape)) == rows(model.comparison_vectors(spelled, COMPARISONS).select(*shape))
    assert rows(training.pattern_counts(packed, COMPARISONS)) == rows(training.pattern_counts(spelled, COMPARISONS))


@pytest.mark.parametrize("threshold, cell_rows", [(0.0, 2048), (0.01, 7), (0.6, 2048)])
def test_pairs_that_may_reach_a_threshold_are_told(spark, threshold, cell_rows):
    """In lists and, where a block is large, in matrices, with whole rows on both sides."""
    profiles = model.with_term_frequencies(_profiles(spark), COMPARISONS, "n_records").cache()
    every = model.score_pairs(model.comparison_vectors(blocking.all_pairs(profiles, RULES), COMPARISONS), MODEL).where(F.col("match_probability") >= threshold).cache()
    told = cells.reaching(PackedPairs(profiles, RULES, cell_rows=cell_rows), MODEL, threshold, profiles.columns)
    found = model.score_pairs(told, MODEL).where(F.col("match_probability") >= threshold)
    shape = ["rule", F.to_json("l").alias("a"), F.to_json("r").alias("b"), "n_pairs", F.round("match_weight", 9).alias("w"), *GAMMAS]
    assert rows(found.select(*shape)) == rows(every.where("l.pid <> r.pid").select(*shape))
    predicted = resolution.predict(profiles, RULES, MODEL, threshold).select("l.pid", F.col("r.pid").alias("b"), "n_pairs", *GAMMAS)
    assert rows(predicted) == rows(every.select("l.pid", F.col("r.pid").alias("b"), "n_pairs", *GAMMAS))


def _batch(n_values, n=200):
    row = [{"pid": f"{i:032d}", "n_records": 1 + i % 2, "name": f"NAME {'ABCDEFGH'[i % n_values] * 9} {i % n_values}", "_met": 0} for i in range(n)]
    kind = pa.struct([("pid", pa.string()), ("n_records", pa.int64()), ("name", pa.string()), ("_met", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([row], pa.list_(kind)), pa.nulls(1, pa.list_(kind))], names=["rule", "l", "r"]
    )


@pytest.mark.parametrize("large", [1, 1 << 30])
def test_two_values_are_measured_once_in_a_cell(monkeypatch, large):
    monkeypatch.setattr(cells, "_LARGE", large)
    measured = []
    monkeypatch.setattr(cells, "similarities", lambda values, a, b, least: measured.append(len(a)) or similarities(values, a, b, least))
    held = cells._Rows(_batch(5), PackedPairs(None, (block_on(("name", 4)),)), ["name"])
    n = 0
    for a, b, live, rule in cells._pieces(held):
        level = cells._all_levels(held, [jaro_winkler_at("name")], a, b, live)[0]
        n += int(live.sum())
        assert ((level == 3) == (held.codes["name"][a] == held.codes["name"][b]))[live].all()
    assert n == 200 * 199 // 2 and sum(measured) == 5 * 4 // 2
