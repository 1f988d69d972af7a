"""CSV files that can be split, and folders loaded by their manifest."""

import csv

import pytest

from recordloom.plans import jobs
from recordloom.sources import readers
from recordloom.specs import default_specs


def put(path, rows, end="\r\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows(rows)
    return str(path)


def test_a_file_without_line_breaks_in_values_is_split(spark, tmp_path):
    path = put(tmp_path / "x.csv", [("a", "b"), *[(f"k{i}", f'say "{i}", twice') for i in range(20_000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        split = readers.read_csv(spark, path, multi_line=None)
        whole = readers.read_csv(spark, path)
        assert split.rdd.getNumPartitions() > 4 and whole.rdd.getNumPartitions() == 1
        assert split.count() == 20_000 and split.exceptAll(whole).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "text, alone",
    [
        ('a,b\n1,"x\ny"\n', False), ('a,b\n1,"x""y"\n', True), ('a,b\r\n1,2\r\n', True), ("a,b\n1,2\r3,4\n", False),
        ("a,b\n1,2\n   \n3,4\n", False), ("a,b\n1,2\n\n3,4\n", True), ('a,b\n1,5" pipe\n', False), ("a,b\n", True), ("", True),
        ('a,b\n1,"\n"\n2,"\n"\n', False), ('a,b\n1,"""\n"""\n', False),
    ],
)
def test_lines_that_need_context(spark, tmp_path, text, alone):
    path = tmp_path / "x.csv"
    path.write_bytes(text.encode())
    assert readers.lines_need_context(spark, str(path)) != alone
    if text:
        got, want = ([tuple(r) for r in readers.read_csv(spark, str(path), multi_line=m).collect()] for m in (None, True))
        assert sorted(got, key=str) == sorted(want, key=str)


def vendors(*ids):
    return [default_specs()[2].raw_header, *[(i, f"FIRM {i}", "UEI1", "MBE", "HVAC") for i in ids]]


def test_each_file_is_loaded_once_and_archived(spark, tmp_path):
    specs, layout, box = default_specs(), jobs.Layout(str(tmp_path / "lake")), tmp_path / "box"
    put(box / "sub_contractors_registry" / "a.csv", vendors("v1", "v2"))
    put(box / "sub_contractors_registry" / "b.csv", vendors("v3", ""))
    put(box / "other" / "c.csv", [("x",), ("1",)])
    first = jobs.load_new_files(spark, str(box), specs, layout)
    assert [(n["source"], n["files"], n["success"], n["failure"]) for n in first] == [("sub_contractors_registry", 2, 3, 1)]
    assert jobs.load_new_files(spark, str(box), specs, layout) == []
    put(box / "sub_contractors_registry" / "d.csv", vendors("v4"))
    kept = tmp_path / "kept"
    assert [n["files"] for n in jobs.load_new_files(spark, str(box), specs, layout, str(kept))] == [1]
    assert sorted(str(p.relative_to(kept)) for p in kept.rglob("*.csv")) == [f"sub_contractors_registry/{x}.csv" for x in "abd"]
    assert [p.name for p in box.rglob("*.csv")] == ["c.csv"]
    assert jobs.silver_table(spark, layout, specs[2]).read().count() == 4


def test_a_call_that_died_is_finished_under_its_name(spark, tmp_path, monkeypatch):
    specs, layout, box = default_specs(), jobs.Layout(str(tmp_path / "lake")), tmp_path / "box"
    put(box / "sub_contractors_registry" / "a.csv", vendors("v1", ""))
    real = jobs.write_parquet

    def dies(df, path, mode="errorifexists"):
        if path.endswith("/loaded"):
            raise OSError("lost")
        real(df, path, mode)

    monkeypatch.setattr(jobs, "write_parquet", dies)
    with pytest.raises(OSError):
        jobs.load_new_files(spark, str(box), specs, layout)
    monkeypatch.undo()
    put(box / "sub_contractors_registry" / "b.csv", vendors("v2"))
    assert [n["files"] for n in jobs.load_new_files(spark, str(box), specs, layout)] == [1, 1]
    table = jobs.silver_table(spark, layout, specs[2])
    assert table.read().count() == 2 and table.history().count() == 2
    assert spark.read.parquet(layout.errors(specs[2].name)).count() == 1
