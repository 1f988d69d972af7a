import csv

import pytest

from conftest import rows
from recordloom.operators import audit as audits
from recordloom.operators.validate import validate
from recordloom.plans import jobs
from recordloom.plans.settings_er import ResolutionSettings
from recordloom.session import CHECKPOINT_CONF, durable_dir
from recordloom.sources.readers import read_any
from recordloom.specs import business_entity_registry, default_specs
from recordloom.streaming.ingest import ingest_bronze

TRADES = ("PLUMBING", "MASONRY", "ROOFING", "HVAC", "STEEL", "PAVING")
TOWNS = ("LAKESIDE", "HARBOR", "SUMMIT", "PRAIRIE", "CANYON", "RIVER", "DESERT")
CITIES = ("MIAMI", "DENVER", "BOSTON")


def _write(path, header, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *data])


@pytest.fixture()
def raw(tmp_path):
    registry, licenses, vendors = [], [], []
    for i, (town, trade) in enumerate((t, d) for t in TOWNS for d in TRADES):
        city = CITIES[i % 3]
        registry.append((f"UEI_{1000 + i}", f"{town} {trade} INC", f"{100 + i} OAK RD", city, f"{33000 + i}", "ACT" if i % 2 else "EXP"))
        if i % 2 == 0:
            licenses.append((f"ST-{i}", f"{town.title()} {trade}", f"{100 + i} Oak Road, {city}", "238220", "2026-05-22" if i % 4 else "N/A"))
        if i % 3 == 0:
            vendors.append((f"V-{i}", f"{town} {trade} LLC", f"UEI_{1000 + i}" if i % 2 else "", "MBE", trade))
    registry += [registry[0], ("", "NO ID", "1 X ST", "MIAMI", "1", "ACT"), ("UEI_9", "", "1 X ST", "MIAMI", "1", "ACT")]
    licenses += [licenses[0]]
    specs = default_specs()
    paths = []
    for spec, data in zip(specs, (registry, licenses, vendors)):
        path = tmp_path / "bronze" / spec.name / f"{spec.name}.csv"
        _write(path, spec.raw_header, data)
        paths.append(str(path))
    return specs, paths, jobs.Layout(str(tmp_path / "lake"))


def test_all_jobs(spark, raw):
    specs, paths, layout = raw
    out = jobs.run_all(spark, paths, specs, layout, ResolutionSettings(max_random_pairs=20_000))
    n = len(TOWNS) * len(TRADES)
    assert spark.read.parquet(layout.errors("business_entity_registry")).count() == 2
    assert spark.read.parquet(layout.deduplicated("business_entity_registry")).count() == n
    assert spark.read.parquet(layout.deduplicated("licenses_registry")).count() == 21
    anchors = {r["anchor_entity_id"] for r in out.anchors.collect()}
    assert anchors == {f"UEI{1000 + i}" for i in range(n)}
    assert out.records.where("n_licenses > 0").count() > 0 and out.licenses.count() == out.anchors.agg({"n_licenses": "sum"}).first()[0]
    # the newest run over the same sources is taken, and merging it again replaces its result
    run_id = jobs.newest_run(spark, specs, layout)
    rejected = spark.read.parquet(layout.integrated(run_id, "rejected")).count()
    jobs.create_integrated(spark, specs, layout)
    assert spark.read.parquet(layout.integrated(run_id, "rejected")).count() == rejected
    with pytest.raises(ValueError):
        jobs.newest_run(spark, specs[:1], layout)
    assert out.bridge.where("is_anchor").count() == out.anchors.count()
    # loading the same files again changes nothing
    before = jobs.silver_table(spark, layout, specs[0]).history().count()
    jobs.bronze_to_silver(spark, paths[0], specs, layout)
    assert jobs.silver_table(spark, layout, specs[0]).history().count() == before
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(spark, "bronze/other.csv", specs, layout)


def test_audit_of_silver(spark, raw):
    specs, paths, layout = raw
    jobs.bronze_to_silver(spark, paths[2], specs, layout)
    results = jobs.audit_silver(spark, specs[2], layout, {"HVAC": 2.0})
    assert audits.verdict(results).first()["passed"]


def test_stream_ingest_loads_each_file_once(spark, tmp_path):
    spec, layout = business_entity_registry(), jobs.Layout(str(tmp_path / "lake"))
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    row = ("UEI_1", "Acme Inc", "1 Main St", "Rome", "00100", "ACT")
    _write(folder / "a.csv", spec.raw_header, [row, ("", "x", "", "", "", "")])
    ingest_bronze(spark, str(folder), spec, layout, checkpoint, str(tmp_path / "archive"))
    _write(folder / "b.csv", spec.raw_header, [row[:5] + ("EXP",), ("UEI_2", "Beta", "", "", "", "ACT")])
    ingest_bronze(spark, str(folder), spec, layout, checkpoint, str(tmp_path / "archive"))
    ingest_bronze(spark, str(folder), spec, layout, checkpoint, str(tmp_path / "archive"))
    table = jobs.silver_table(spark, layout, spec)
    assert rows(table.read(), "entity_id", "is_active") == [("UEI1", False), ("UEI2", True)]
    assert table.version() == 2 and table.read(version=1).count() == 1
    assert spark.read.parquet(layout.errors(spec.name)).count() == 1


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    spec, layout = business_entity_registry(), jobs.Layout(str(tmp_path / "lake"))
    _write(tmp_path / "a.csv", spec.raw_header, [("UEI_1", "Acme Inc", "1 Main St", "Rome", "00100", "ACT"), ("", "x", "", "", "", "")])
    raw = read_any(spark, str(tmp_path / "a.csv"), spec.raw_schema)
    for _ in range(2):
        assert jobs.load_validated(spark, validate(raw, spec).stored(), layout, "s-0")["version"] == 1
    assert jobs.silver_table(spark, layout, spec).version() == 1
    assert spark.read.parquet(layout.errors(spec.name)).count() == 1


def test_durable_folder_comes_from_the_session(spark, tmp_path):
    spark.conf.set(CHECKPOINT_CONF, str(tmp_path)) if spark.conf.isModifiable(CHECKPOINT_CONF) else None
    assert durable_dir(spark)
