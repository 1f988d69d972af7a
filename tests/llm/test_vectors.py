"""Search, mining and whitening of vectors against plain loops over Python integers, with the awkward cases in them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import hard_negatives, top_products, vector_blocks, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, asks int, norm double, score double, body string, no int, rank int, kind string, top double, block int, chunk int, part int"
REST = ("x", 1, 0.5, 0.5, "b", 1, 1, "k", 1.0, 1, 1, 1)


@pytest.fixture(scope="module")
def table():
    """Random vectors, a vector a third of the rows repeat, ties, repeated rows and ids, nulls and odd components."""
    rng = random.Random(3)
    point = lambda size=1.0: [rng.gauss(0, size) for _ in range(6)]
    out = [(i, point(rng.choice((0.5, 1.0, 2.0))), rng.randrange(3)) for i in range(90)]
    common = point()
    out += [(i, common, i % 2) for i in range(90, 140)]
    out += [(7, out[7][1], out[7][2]), (20, point(), 1), (140, [0.0] * 6, 2), (141, [-1.0] * 6, 0), (143, common, None), (None, point(), 1)]
    out += [(200, None, 1), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (202, [math.nan] + [0.0] * 5, 1), (203, [math.inf] * 6, 1), (204, [1.0, 2.0], 1), (205, [], 1)]
    return [(*r, *REST) for r in out]


@pytest.fixture
def small(monkeypatch):
    """Several blocks, waves and tasks on a small table."""
    for module in (top_products, hard_negatives):
        monkeypatch.setattr(module, "BLOCK", 16)
        monkeypatch.setattr(module, "CHUNK", 5)
        monkeypatch.setattr(module, "STEP", 6)
    monkeypatch.setattr(vector_blocks, "TASK_CHUNKS", 2)


def whole_vectors(rows, scale, offset=0):
    """Row, integers of those that take part, of dimension 6."""
    fine = [r for r in rows if r[1] is not None and len(r[1]) == 6 and all(c is not None and math.isfinite(c) for c in r[1])]
    return [(r, [math.floor(scale * c) + offset for c in r[1]]) for r in fine]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, k, every, scale=64):
    own = sorted({(r[0], tuple(x)) for r, x in whole_vectors(rows, scale) if r[0] is not None})
    out = []
    for q, x in own:
        if q % every == 0:
            near = sorted(((-inner(x, y), v) for v, y in own if v != q))[:k]
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("scale", [64, 10**7])  # the second needs more than 53 bits
def test_top_products(spark, table, small, scale):
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    found = top_products.search(frame, F.col("vec_id") % 10 == 0, k=7, scale=scale)
    assert sorted(map(tuple, found.collect())) == brute_top(table, 7, 10, scale)


def test_top_products_of_few_rows(spark, table):
    frame = spark.createDataFrame(table[:4], SCHEMA)
    assert sorted(map(tuple, top_products.search(frame, F.col("vec_id") % 2 == 0).collect())) == brute_top(table[:4], 20, 2)
    assert top_products.search(frame.where("false"), F.col("vec_id") % 2 == 0).collect() == []
    assert top_products.search(frame, F.lit(False)).collect() == []
    huge = spark.createDataFrame([(1, [1e300], 0, *REST)], SCHEMA)
    with pytest.raises(ValueError):
        top_products.search(huge, F.lit(True))


def test_bounds_drop_pairs(spark, small, monkeypatch):
    """Short vectors are neither sent to a query nor scored once long ones fill its list."""
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) + (9 if i < 40 else 0) for _ in range(6)], 0, *REST) for i in range(400)]
    met = []
    own = vector_blocks.meet
    monkeypatch.setattr(vector_blocks, "meet", lambda state, vectors, units, *more: met.append(units.count()) or own(state, vectors, units, *more))
    found = top_products.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 20, k=5)
    assert sorted(map(tuple, found.collect())) == [r for r in brute_top(rows, 5, 20) if r[0] == 20]
    assert sum(met) < 10 < 400 / 16


def test_segment_bounds_hold():
    rng = np.random.default_rng(2)
    for d in (1, 3, 6, 40):
        x, y = rng.integers(-300, 300, (30, d)), rng.integers(-300, 300, (30, d)) + 50
        a, b = hard_negatives.summaries(x), hard_negatives.summaries(y)
        real, width = x @ y.T, []
        for level in hard_negatives.SEGMENTS:
            middle, spread = a[f"mean{level}"] @ b[f"mean{level}"].T, a[f"dev{level}"] @ b[f"dev{level}"].T
            assert (middle - spread <= real + 1e-6).all() and (real <= middle + spread + 1e-6).all()
            width.append(spread.mean())
        assert width[0] >= width[1] - 1e-9


def brute_negatives(rows, every, n_positive, n_negative, low, high, scale=256):
    own = sorted({(r[0], r[2], tuple(x)) for r, x in whole_vectors(rows, scale) if r[0] is not None and r[2] is not None})
    out = []
    for a, label, x in own:
        if a % every:
            continue
        scored = sorted((-inner(x, y), v, other) for v, other, y in own)
        for s, p, _ in [r for r in scored if r[2] == label and r[1] != a][:n_positive]:
            fits = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:n_negative]
            out += [(a, p, i + 1, v, -s, -t) for i, (t, v, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("scale", [256, 10**7])
def test_hard_negatives(spark, table, small, scale):
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    found = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, F.col("label"), scale=scale)
    expected = brute_negatives(table, 10, 5, 10, 30, 90, scale)
    assert sorted(map(tuple, found.collect())) == expected
    assert len(expected) > 200


def test_hard_negatives_of_few_rows(spark, table):
    frame = spark.createDataFrame(table[:9], SCHEMA)
    found = hard_negatives.mine(frame, F.col("vec_id") % 2 == 0, F.col("label"), 2, 3, 10, 100)
    assert sorted(map(tuple, found.collect())) == brute_negatives(table[:9], 2, 2, 3, 10, 100)
    assert hard_negatives.mine(frame.where("false"), F.lit(True), F.col("label")).collect() == []
    assert hard_negatives.mine(frame, F.lit(True), F.lit(None).cast("int")).collect() == []


def check_whitening(found, rows, components=8):
    own = whole_vectors(rows, 1024, 100_000)
    n = len(own)
    x = np.array([v for _, v in own], dtype=object)
    whole = n * x - x.sum(axis=0)
    y = (whole / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = min(components, int((values > 1e-9 * values[0]).sum()))
    expected = {}
    for (r, _), w, z in zip(own, whole, y):
        expected.setdefault(r[0], []).append((int((w**2).sum()), z @ vectors[:, :some] / np.sqrt(values[:some])))
    got = {}
    for r in found.collect():
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        got.setdefault((r.vec_id, r.component), []).append((r.deviation, r.whitened))
    assert sorted(got, key=str) == sorted([(i, c + 1) for i in expected for c in range(some)], key=str)
    assert sum(map(len, got.values())) == n * some
    for c in range(some):
        ones = [(i, (d, w[c])) for i, all_ in expected.items() for d, w in all_]
        mine = [(i, v) for (i, at), all_ in got.items() if at == c + 1 for v in all_]
        sign = np.sign(sum(w * dict(ones)[i][1] for i, (_, w) in mine if len(expected[i]) == 1))
        for (i, (d, w)), (j, (e, v)) in zip(sorted(ones, key=str), sorted(((i, (d, sign * w)) for i, (d, w) in mine), key=str)):
            assert i == j and d == e
        assert sorted(w for _, (_, w) in ones) == pytest.approx(sorted(sign * w for _, (_, w) in mine), abs=1e-7)
    return some


def test_whitening(spark, table):
    assert check_whitening(whitening.whiten(spark.createDataFrame(table, SCHEMA).repartition(3)), table) == 6


def test_whitening_of_deficient_and_badly_scaled_tables(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1e-2), rng.gauss(0, 1e3)
        rows.append((i, [float(round(a * 64)), float(round(b * 640)), float(round(c)), 3.0, float(round(a * 64)) * 2, float(round(c)) - 1], 0, *REST))
    assert check_whitening(whitening.whiten(spark.createDataFrame(rows, SCHEMA)), rows) == 3
    assert check_whitening(whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=2), rows, 2) == 2


def test_whitening_of_nothing(spark, table):
    frame = spark.createDataFrame(table, SCHEMA)
    assert whitening.whiten(frame.where("false")).collect() == []
    assert whitening.whiten(frame.where("vec_id = 3")).collect() == []  # one row
    assert whitening.whiten(frame.where("vec_id between 91 and 99")).collect() == []  # equal ones
    far = spark.createDataFrame([(i, [i * 1e9, 0.0], 0, *REST) for i in range(5)], SCHEMA)
    assert {r.deviation for r in whitening.whiten(far).collect() if r.vec_id in (0, 4)} == {None}
