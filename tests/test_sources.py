import json

import pytest

from conftest import rows
from recordloom.operators.validate import validate
from recordloom.sources import readers, writers
from recordloom.specs import SourceSpec, business_entity_registry, default_specs, licenses_registry, spec_for_path, sub_contractors_registry
from pyspark.sql import types as T


def test_csv_keeps_quoted_commas_blanks_and_reads_empty_as_null(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,"x, ""y""", MIAMI\n2,,"two\nlines"')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    assert [tuple(r) for r in readers.read_any(spark, str(path), schema).select("a", "b", "c").collect()] == [
        ("1", 'x, "y"', " MIAMI"), ("2", None, "two\nlines"),
    ]


def test_csv_marks_rows_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "business_entity_registry.csv"
    spec = business_entity_registry()
    path.write_text(",".join(spec.raw_header) + "\nUEI_1,Acme Inc,1 Main St,Rome,00100,ACT\nUEI_2,Beta,2 Main St,Rome,1,ACT,extra,extra")
    checked = validate(readers.read_any(spark, str(path), spec.raw_schema), spec)
    assert rows(checked.valid, "entity_id", "address_1", "is_active") == [("UEI1", "1 MAIN STREET", True)]
    assert [r["reject_reasons"] for r in checked.rejected.collect()] == [["corrupt_record"]]


@pytest.mark.parametrize("document, n", [([{"a": 1}, {"a": 2}], 2), ({"a": 3}, 1)])
def test_json_list_or_object(spark, tmp_path, document, n):
    path = tmp_path / "d.json"
    path.write_text(json.dumps(document, indent=4))
    assert readers.read_any(spark, str(path)).count() == n


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.txt")


def test_discover_filters_by_name_or_path(spark, tmp_path):
    for name in ("bronze/a/one.csv", "bronze/b/two.csv", "bronze/b/deduplicated.parquet"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    assert rows(readers.discover(spark, str(tmp_path), r"deduplicated\.parquet"), "file_name") == [("deduplicated.parquet",)]
    assert readers.discover(spark, str(tmp_path), r"/b/.*csv", match_on_path=True).count() == 1
    assert readers.discover(spark, str(tmp_path)).count() == 3


def test_partitioned_table_keeps_text_partitions(spark, tmp_path):
    df = spark.createDataFrame([("1", "07101"), ("2", "UNKNOWN")], "id string, zip string")
    writers.write_table(df, str(tmp_path / "t"), "zip")
    out = readers.read_table(readers.read_parquet(spark, str(tmp_path / "t"), df.schema), ["id", "zip", "none"], ["1", "2"], "id", "zip")
    assert sorted(map(tuple, out.collect()), key=str) == [("1", "07101"), ("2", None)]


def test_json_sink(spark, tmp_path):
    writers.write_json(spark.createDataFrame([("r", None)], "run string, note string"), str(tmp_path / "m"))
    assert readers.read_json(spark, str(tmp_path / "m")).first().asDict() == {"run": "r", "note": None}


def test_routing():
    assert spec_for_path("bronze/x/BUSINESS_entity_registry.csv", (SPEC,)) is SPEC
    assert spec_for_path("bronze/other.csv", (SPEC,)) is None


SPEC = SourceSpec("business_entity_registry", "business_entity_registry", ("id",), T.StructType([T.StructField("id", T.StringType())]))


def test_spec_needs_its_keys():
    with pytest.raises(TypeError):
        SourceSpec("x", "x", ("missing",), T.StructType([T.StructField("id", T.StringType())]))


def _raw(spark, spec, data):
    return spark.createDataFrame(data, spec.raw_schema)


def test_registry_rules(spark):
    spec = business_entity_registry()
    out = validate(_raw(spark, spec, [
        ("UEI_1", "Acme Corp.", "12 SHORE DR", " MIAMI", "33101", "ACT"),
        ("UEI_2", "Acme", "123", "42", None, "active"),
        ("", "No Id", None, None, None, "ACT"),
        ("UEI_4", "", None, None, None, None),
    ]), spec)
    assert rows(out.valid, "entity_id", "company_name_normalized", "city", "is_active") == [
        ("UEI1", "ACME", "MIAMI", True), ("UEI2", "ACME", None, False),
    ]
    assert sorted(r["reject_reasons"][0] for r in out.rejected.collect()) == ["company_name_missing", "entity_id_missing"]
    assert out.metrics().first().asDict() == {"total": 4, "success": 2, "failure": 2}


def test_license_options_and_lookup(spark):
    naics = spark.createDataFrame([("484110", "Freight")], "code string, label string")
    data = [("ST-1", "A Inc", "1 Main St, Rome", "484110", "N/A"), ("ST-2", "B", "Ro", "999", "06/15/25"),
            ("ST-3", "C", None, None, "1400")]
    lenient = validate(_raw(spark, licenses_registry(), data), licenses_registry(naics))
    assert sorted(map(tuple, lenient.valid.select("license_id", "naics_code", "naics_code_label", "expiration_date.year").collect())) == [
        ("ST1", "484110", "Freight", None), ("ST2", None, None, 2025),
    ]
    assert [r["reject_reasons"] for r in lenient.rejected.collect()] == [["expiration_date_out_of_range"]]
    strict = validate(_raw(spark, licenses_registry(), data), licenses_registry(naics, "reject", "reject"))
    assert sorted(r["reject_reasons"][0] for r in strict.rejected.collect()) == [
        "expiration_date_out_of_range", "expiration_date_unparseable", "location_too_short",
    ]


def test_vendor_id_is_optional(spark):
    spec = sub_contractors_registry()
    out = validate(_raw(spark, spec, [("MIA-1", "X", None, "MBE", "Brick, Masonry")]), spec).valid
    assert rows(out, "vendor_id", "trade_specialty") == [("MIA1", "Brick, Masonry")]
    assert out.first()["entity_id"] is None


def test_default_specs(spark):
    assert [s.name for s in default_specs()] == ["business_entity_registry", "licenses_registry", "sub_contractors_registry"]
