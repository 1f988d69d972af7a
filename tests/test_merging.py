import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from conftest import rows
from recordloom.operators import gold, survivorship

SCHEMA = """cluster_id string, composite_id string, data_source string, entity_id string, company_name string, company_name_normalized string,
    address_1 string, postal_code string, city string, is_active boolean, license_id string, naics_code string, naics_code_label string,
    expiration_date struct<year:int,month:int,day:int>, vendor_id string, certification_type string, trade_specialty string"""
COLUMNS = [c.split()[0] for c in SCHEMA.replace("struct<year:int,month:int,day:int>", "date").replace("\n", " ").split(",")]


def member(**values):
    return tuple(values.get(c) for c in COLUMNS)


def registry(cluster, key, **values):
    return member(cluster_id=cluster, composite_id=f"entity_id-__-{key}", data_source="business_entity_registry", entity_id=key, **values)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_single_registry_row_has_the_known_scores(spark):
    """8 of 15 keys filled: depth 8/15, consensus 1, score 0.8444; 10 of 14 output fields: 0.7143."""
    data = [registry("c", "UEI1093", company_name="A", company_name_normalized="A", address_1="1 X ST", postal_code="1", city="ROME", is_active=False)]
    got = survivorship.integrate(frame(spark, data)).records.first()
    assert got["anchor_entity"]["depth_score"] == 8 / 15 and got["anchor_entity"]["consensus_score"] == 1.0
    assert round(got["anchor_entity"]["global_score"], 5) == 0.84444
    assert got["global_score"] == 0.7143
    assert got["has_id_conflict"] is False and got["is_active"] is False


def _expected(cluster):
    """Row-at-a-time statement of the merge rules for one cluster."""
    keys = [c for c in COLUMNS if c not in ("cluster_id", "composite_id")]
    text = lambda v: str(v).strip().upper()
    records = [dict(zip(COLUMNS, m)) for m in cluster]
    seen = {k: Counter(text(r[k]) for r in records if r[k]) for k in keys}
    n = len(records)
    for r in records:
        filled = [k for k in keys if r[k] is not None and str(r[k]).strip() != ""]
        r["depth"] = len(filled) / len(keys)
        agree = sum(max(0, seen[k].get(text(r[k]), 0) - 1) for k in filled)
        r["consensus"] = 1.0 if n <= 2 else (agree / (len(filled) * (n - 1)) if filled else 0.0)
        r["score"] = (r["depth"] + 2 * r["consensus"]) / 3
    anchors = [r for r in records if r["data_source"] != "licenses_registry" and r["entity_id"]]
    if not anchors:
        return None
    anchor = min(anchors, key=lambda r: (-r["score"], r["composite_id"]))
    rest = sorted((r for r in records if r is not anchor), key=lambda r: (-r["score"], r["composite_id"]))
    out = {}
    for f in survivorship.SURVIVING_FIELDS:
        out[f] = next((r[f] for r in [anchor, *rest] if r[f] not in (None, "")), None)
    if out["company_name"] is None:
        return None
    out["is_active"] = bool(out["is_active"])
    alternates = [r["composite_id"] for r in rest if r["entity_id"]]
    vendor = anchor["vendor_id"] or next((r["vendor_id"] for r in rest if r["entity_id"] and r["vendor_id"]), None)
    licenses = []
    for r in [anchor, *rest]:
        if r["data_source"] == "licenses_registry" and r["license_id"] and r["license_id"] not in licenses:
            licenses.append(r["license_id"])
    return anchor, out, alternates, vendor, licenses


def _random_members(seed):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    out = []
    for c in range(25):
        for i in range(rng.choice([1, 2, 3, 5, 9])):
            kind = pick("business_entity_registry", "licenses_registry", "sub_contractors_registry")
            key = f"{c}-{i}"
            common = dict(cluster_id=f"c{c:02d}", composite_id=f"{kind[0]}-__-{key}", data_source=kind,
                          company_name=pick("Acme", " ACME ", "Beta", None, ""), company_name_normalized=pick("ACME", "BETA", None), city=pick("ROME", "OSLO", None))
            if kind == "business_entity_registry":
                out.append(member(**common, entity_id=pick(f"E{key}", "", None), address_1=pick("1 A ST", None), is_active=pick(True, False)))
            elif kind == "licenses_registry":
                out.append(member(**common, license_id=pick("L1", "L2", f"L{key}"), naics_code=pick("1", None), expiration_date=pick(None, (2020, 1, 2))))
            else:
                out.append(member(**common, vendor_id=f"V{key}", entity_id=pick(f"E{key}", None), trade_specialty=pick("x", "y", None)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_the_row_at_a_time_rules(spark, seed):
    data = _random_members(seed)
    result = survivorship.integrate(frame(spark, data))
    clusters = {}
    for m in data:
        clusters.setdefault(m[0], []).append(m)
    want = {c: _expected(ms) for c, ms in clusters.items()}
    records = {r["cluster_id"]: r for r in result.records.collect()}
    assert set(records) == {c for c, w in want.items() if w}
    shaped = survivorship.shape(result)
    listed = {}
    for r in shaped.licenses.orderBy("ordinal").collect():
        listed.setdefault(r["splink_id"], []).append(r)
    counts = {r["splink_id"]: (r["n_alternates"], r["n_licenses"]) for r in shaped.records.collect()}
    for c, r in records.items():
        anchor, fields, alternates, vendor, licenses = want[c]
        assert r["anchor_entity"]["entity_id"] == anchor["entity_id"]
        assert abs(r["anchor_entity"]["global_score"] - anchor["score"]) < 1e-12
        assert {f: r[f] for f in fields} == fields
        assert r["anchor_entity"]["vendor_id"] == vendor
        assert r["n_alternates"] == len(alternates)
        assert [x["license_id"] for x in listed.get(c, [])] == licenses
        assert [x["ordinal"] for x in listed.get(c, [])] == list(range(len(licenses)))
        assert counts[c] == (len(alternates), len(licenses))
    assert {r["cluster_id"] for r in result.rejected.select("cluster_id").distinct().collect()} == {c for c, w in want.items() if not w}
    assert result.rejected.count() == sum(len(clusters[c]) for c, w in want.items() if not w)


def test_children_have_one_shape_at_every_size(spark):
    """Ordinals run from 0 without a gap however large the cluster and however many ranges hold it."""
    data = [registry("c", f"E{i:03d}", company_name="A", city="ROME") for i in range(300)] + [registry("d", "X", company_name="B")]
    result = survivorship.integrate(frame(spark, data))
    shaped = survivorship.shape(result)
    assert rows(shaped.records, "splink_id", "n_alternates") == [("c", 299), ("d", 0)]
    alternates = shaped.alt_entities.orderBy("ordinal").collect()
    assert [(r["ordinal"], r["entity_id"]) for r in alternates] == [(i, f"E{i + 1:03d}") for i in range(299)]
    assert gold.bridge_of_shape(shaped).count() == 301
    listed = survivorship.cluster_lists(frame(spark, data)).where("cluster_id = 'c'").orderBy("composite_id").collect()
    assert [r["ordinal"] for r in listed] == list(range(300))
    wide = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.col("id").cast("string")).alias("cluster_id"), F.col("id").alias("v"))
    placed = survivorship.ordered(wide.repartition(7), F.col("v"))
    assert placed.where("cluster_id = 'hot' AND ordinal = v").count() == 4000 and placed.where("cluster_id <> 'hot' AND ordinal = 0").count() == 1000


def test_gold_joins_on_id_and_source(spark):
    data = [
        registry("c1", "E1", company_name="A", is_active=True),
        member(cluster_id="c2", composite_id="v-1", data_source="sub_contractors_registry", entity_id="E1", vendor_id="V1", company_name="B"),
        registry("c3", "E1", company_name="A2", city="ROME", is_active=False),
        member(cluster_id="c1", composite_id="v-2", data_source="sub_contractors_registry", entity_id="E9", vendor_id="V2", company_name="A"),
        member(cluster_id="c1", composite_id="l-1", data_source="licenses_registry", license_id="L1", company_name="A"),
    ]
    result = survivorship.integrate(frame(spark, data))
    out = gold.publish(result)
    assert rows(out.bridge, "anchor_entity_id", "anchor_data_source", "alt_entity_id", "is_anchor") == [
        ("E1", "business_entity_registry", "", True), ("E1", "business_entity_registry", "E9", False), ("E1", "sub_contractors_registry", "", True),
    ]
    got = sorted((r["anchor_data_source"], r["company_name"], r["source_entity_id"] or "", r["vendor_id"]) for r in out.records.collect())
    assert got == [
        ("business_entity_registry", "A", "", "V2"), ("business_entity_registry", "A", "E9", "V2"), ("sub_contractors_registry", "B", "", "V1"),
    ]
    assert rows(out.licenses, "anchor_entity_id", "anchor_data_source", "ordinal", "license_id") == [("E1", "business_entity_registry", 0, "L1")]
    assert rows(out.records, "anchor_data_source", "n_licenses") == [("business_entity_registry", 1)] * 2 + [("sub_contractors_registry", 0)]
