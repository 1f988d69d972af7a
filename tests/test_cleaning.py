import pytest
from pyspark.sql import functions as F

from recordloom.functions import dates, lookup, text
from recordloom.functions.abbreviations import expand_abbreviations
from recordloom.functions.address import clean_street, parse_location


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, expected",
    [("UEI_5560", "UEI5560"), (" st-550 ", "ST550"), ("--", None), (None, None), ("a ", "A")],
)
def test_normalize_id(spark, value, expected):
    assert one(spark, value, text.normalize_id) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("discord Inc.", "DISCORD"),
        ("SUNBELT ROOFING Limited", "SUNBELT ROOFING"),
        ("Foo Bar Co. Ltd", "FOO BAR"),
        ("Incwell", "INCWELL"),
        ("LIBERTY HVAC SOLUTIONS LLC", "LIBERTY HVAC SOLUTIONS"),
        (None, None),
    ],
)
def test_normalize_company_name(spark, value, expected):
    assert one(spark, value, text.normalize_company_name) == expected


@pytest.mark.parametrize("value, kept", [("12-3 4", False), ("12a", True), ("...", False), ("é", True)])
def test_soft_string(spark, value, kept):
    assert one(spark, value, text.soft_string) == (value if kept else None)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("124 POWER AVE, SUITE B, alaska", "124 POWER Avenue, SUITE B, alaska"),
        ("46132", "46132"),
        ("9  Main St.  #10", "9 Main Street. #10"),
        ("Attn Rt 5", "Attention Route 5"),
    ],
)
def test_expand_abbreviations(spark, value, expected):
    assert one(spark, value, expand_abbreviations) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("202 CARGO ROAD, MIAMI", ("202 CARGO ROAD", None, None, "MIAMI", None)),
        ("2887 Main St, Ste 13, SEATTLE", ("2887 MAIN STREET", "STE 13", None, "SEATTLE", None)),
        ("1 Oak Ave, Salem, OR 97301", ("1 OAK AVENUE", None, "97301", "SALEM", "OR")),
        ("1 Oak Ave, Salem OR 97301", ("1 OAK AVENUE", None, "97301", "SALEM", "OR")),
        ("DENVER", (None,) * 5),
        (None, (None,) * 5),
    ],
)
def test_parse_location(spark, value, expected):
    assert tuple(one(spark, value, parse_location)) == expected


def test_registry_street_falls_back_to_the_raw_value(spark):
    assert one(spark, "44 dock st, STE 400", clean_street) == "44 DOCK STREET"
    assert one(spark, "po box 5", clean_street) == "PO BOX 5"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2023-08-15", (2023, 8, 15)), ("2023-08", (2023, 8, None)), ("2023", (2023, None, None)),
        ("15th August 2023", (2023, 8, 15)), ("August 15, 2023", (2023, 8, 15)), ("2023/08/15", (2023, 8, 15)),
        ("2023.08.15", (2023, 8, 15)), ("15-08-2023", (2023, 8, 15)), ("06/15/25", (2025, 6, 15)),
        ("28/04/22", (2022, 4, 28)), ("01-01-1900", (1900, 1, 1)), ("06/15/99", (1999, 6, 15)),
        ("Invalid Date String", None), ("2023-02-31", None), (None, None),
    ],
)
def test_partial_dates(spark, value, expected):
    got = one(spark, value, dates.parse_partial_date)
    assert (tuple(got) if got else None) == expected
    assert one(spark, value, dates.date_is_unparseable) == (expected is None and value is not None)


def test_date_ranges(spark):
    df = spark.sql("SELECT named_struct('year', y, 'month', m, 'day', d) AS x FROM VALUES (1499,1,1),(2000,13,1),(2000,1,32),(1500,12,31),(2000,null,null) t(y,m,d)")
    assert [r[0] for r in df.select(dates.date_parts_in_range(F.col("x"))).collect()] == [False, False, False, True, True]


def test_code_label_drops_unknown_codes(spark):
    mapping = spark.createDataFrame([("a1", "Alpha"), ("B2", "Beta")], "code string, label string")
    df = spark.createDataFrame([("A1",), ("b2",), ("c3",), (None,)], "code string")
    assert sorted(map(str, lookup.code_label(df, "code", mapping, "name").collect())) == sorted(
        map(str, [r for r in spark.createDataFrame([("A1", "Alpha"), ("b2", "Beta"), (None, None), (None, None)], "code string, name string").collect()])
    )


def _levenshtein(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            previous, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, previous + (x != y))
    return line[-1]


@pytest.mark.parametrize("threshold", [60, 80, 90])
def test_fuzzy_code_matches_brute_force(spark, threshold):
    import random

    rng = random.Random(threshold)
    entries = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    labels = set()
    for e in entries:
        chars = list(e)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(chars) + 1)
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "x"])
        labels.add("".join(chars) or "z")
    mapping = spark.createDataFrame([(i, e) for i, e in enumerate(entries)], "code int, label string")
    got = {r["q"]: r["score"] for r in lookup.fuzzy_code(spark.createDataFrame([(x,) for x in labels], "q string"), "q", mapping, threshold).collect()}
    want = {}
    for q in labels:
        best = max(100 * (1 - _levenshtein(q, e) / max(len(q), len(e))) for e in entries)
        if best >= threshold:
            want[q] = best
    assert got.keys() == want.keys()
    assert all(abs(got[q] - want[q]) < 1e-9 for q in want)
