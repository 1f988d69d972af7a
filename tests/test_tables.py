import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordloom.functions.keys import with_load_metadata
from recordloom.operators import audit, dedup, history, runs, sampling
from recordloom.operators.history import HistoryTable
from recordloom.streaming.ingest import RunningSample


def frame(spark, data, schema="id string, city string, n int"):
    return spark.createDataFrame(data, schema)


def test_dedup_is_a_subset_and_unique(spark):
    df = spark.range(500).select((F.col("id") % 37).alias("k"), "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("x"))
    kept = dedup.dedup_ranked(df, ["k"])
    assert kept.count() == 37 and kept.select("k").distinct().count() == 37
    assert kept.exceptAll(df).count() == 0
    assert kept.where("x IS NULL").count() == 0


def test_dedup_plan_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    plan = dedup.dedup_ranked(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_dedup_prefers_active_then_fuller_rows(spark):
    df = spark.createDataFrame(
        [(1, True, None), (1, False, "x"), (2, False, None), (2, False, "y"), (2, None, "z")], "k int, is_active boolean, v string"
    )
    assert rows(dedup.dedup_ranked(df, ["k"]), "k", "v") == [(1, None), (2, "y")]


def test_integrated_dedup_needs_a_rank(spark):
    with pytest.raises(ValueError):
        dedup.dedup_integrated(spark.range(1), ["id"])
    with pytest.raises(ValueError):
        dedup.dedup_ranked(spark.range(1), [])


def test_hash_tells_null_from_empty(spark):
    df = with_load_metadata(frame(spark, [("1", None, 1), ("2", "", 1)]), ["id"])
    assert df.select("hdiff").distinct().count() == 2


def test_history_table_round_trip(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], "city")
    first = frame(spark, [("1", "07101", 1), ("2", None, 2), ("3", "Rome", 3)])
    second = frame(spark, [("1", "07101", 10), ("2", None, 2), ("4", "Oslo", 4), ("4", "Oslo", 4)])
    assert table.version() == 0
    assert table.write(first) == 1 and table.write(second) == 2
    assert rows(table.read(), "id", "city", "n") == [("1", "07101", 10), ("2", "UNKNOWN", 2), ("3", "Rome", 3), ("4", "Oslo", 4)]
    assert rows(table.read(version=1), "id", "n") == [("1", 1), ("2", 2), ("3", 3)]
    before = rows(table.history(), "id", "n", "valid_from")
    files = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "t").rglob("*.parquet"))
    assert table.write(second) == 2
    assert rows(table.history(), "id", "n", "valid_from") == before  # identical input changes nothing
    assert sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "t").rglob("*.parquet")) == files  # and writes nothing
    changes = rows(table.changes(since=1), "change_type", "id", "n")
    assert changes == [("insert", "4", 4), ("update_postimage", "1", 10), ("update_preimage", "1", 1)]
    assert table.rollback(version=1) == 3
    assert rows(table.read(), "id", "n") == [("1", 1), ("2", 2), ("3", 3)]
    assert rows(table.read(version=2), "id", "n") == [("1", 10), ("2", 2), ("3", 3), ("4", 4)]
    stamp = table.commits().where("version = 2").first()["committed_at"]
    assert rows(table.read(timestamp=stamp), "id", "n") == [("1", 10), ("2", 2), ("3", 3), ("4", 4)]
    with pytest.raises(ValueError):
        table.rollback()
    assert table.overwrite(frame(spark, [("9", "x", 9)])) == 4
    assert rows(table.read(), "id") == [("9",)] and table.read(version=3).count() == 3
    with pytest.raises(ValueError):
        HistoryTable(spark, str(tmp_path / "t"), ["id"]).read(version=77)


def test_an_upsert_rewrites_only_the_buckets_it_changes(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], buckets=8)
    table.write(frame(spark, [(str(i), "Rome", i) for i in range(200)]))
    live = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "live").rglob("*.parquet")}
    before = live()
    assert table.write(frame(spark, [(str(i), "Rome", -1 if i == 7 else i) for i in range(200)])) == 2
    after = live()
    assert len({p.parent for p in before}) == 8 and len({p.parent for p in before if p not in after}) == 1
    assert len([p for p in after if p not in before]) == 1
    assert rows(table.read().where("n = -1"), "id") == [("7",)] and table.read().count() == 200
    assert rows(spark.read.parquet(str(tmp_path / "t" / "closed")), "id", "n", "valid_to") == [("7", 7, 2)]


def test_a_writer_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    table.write(frame(spark, [("1", "Rome", 1), ("2", "Oslo", 2)]))

    def die(*_):
        raise RuntimeError("lost")

    second = frame(spark, [("1", "Rome", 10), ("3", "Bern", 3)])
    with monkeypatch.context() as m:
        m.setattr(HistoryTable, "_mark", die)  # rows are replaced, the version is not yet there
        with pytest.raises(RuntimeError):
            table.write(second, "s-1")
    assert table.version() == 1
    assert table.write(second) == 2 and not (tmp_path / "t" / "pending").exists()
    assert rows(table.read(), "id", "n") == [("1", 10), ("2", 2), ("3", 3)] and rows(table.read(version=1), "id", "n") == [("1", 1), ("2", 2)]
    with monkeypatch.context() as m:
        m.setattr(HistoryTable, "_finish", lambda self: None)  # stored aside, nothing replaced
        table.write(frame(spark, [("2", "Oslo", 20)]))
    assert rows(table.read(), "id", "n") == [("1", 10), ("2", 2), ("3", 3)]
    assert table.write(frame(spark, [("2", "Oslo", 21)])) == 4
    assert rows(table.read(), "id", "n") == [("1", 10), ("2", 21), ("3", 3)] and rows(table.read(version=3), "id", "n") == [("1", 10), ("2", 20), ("3", 3)]


def test_a_table_takes_new_columns_and_a_new_schema(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"])
    assert table.write(frame(spark, [("1", "Rome", 1), ("2", "Oslo", 2)])) == 1
    assert table.write(frame(spark, [("2", "Oslo", 2, "x"), ("3", "Bern", 3, "y")], "id string, city string, n int, extra string")) == 2
    assert rows(table.read(), "id", "extra") == [("1", None), ("2", "x"), ("3", "y")]
    assert "extra" not in table.read(version=1).columns and table.read(version=1).count() == 2
    assert table.overwrite(frame(spark, [("7", 1.5)], "id string, size double")) == 3
    assert set(table.read().columns) >= {"id", "size"} and not {"city", "n", "extra"} & set(table.read().columns)
    assert table.write(frame(spark, [("7", 2.5), ("8", 3.5)], "id string, size double")) == 4
    assert rows(table.read(), "id", "size") == [("7", 2.5), ("8", 3.5)]
    assert rows(table.read(version=2), "id", "city", "extra") == [("1", "Rome", None), ("2", "Oslo", "x"), ("3", "Bern", "y")]
    assert table.rollback(version=2) == 5
    assert rows(table.read(), "id", "city", "extra") == [("1", "Rome", None), ("2", "Oslo", "x"), ("3", "Bern", "y")]


def test_a_named_batch_is_written_once(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"])
    assert table.write(frame(spark, [("1", "Rome", 1)]), "s-0") == 1
    assert table.write(frame(spark, [("1", "Rome", 2)]), "s-1") == 2
    assert table.write(frame(spark, [("1", "Rome", 1)]), "s-0") == 1
    assert table.version() == 2 and rows(table.read(), "id", "n") == [("1", 2)]


def test_change_feed_applied_to_old_gives_new(spark):
    old = with_load_metadata(spark.range(100).select(F.col("id"), (F.col("id") % 5).alias("v")), ["id"])
    new = with_load_metadata(spark.range(20, 130).select(F.col("id"), (F.col("id") % 4).alias("v")), ["id"])
    feed = history.change_feed(old, new, ["id"])
    gone = feed.where("change_type IN ('delete', 'update_preimage')").select("id")
    added = feed.where("change_type IN ('insert', 'update_postimage')").select("id", "v")
    rebuilt = old.join(gone, "id", "left_anti").select("id", "v").unionAll(added)
    assert rows(rebuilt) == rows(new, "id", "v")


def test_latest_run_ignores_the_order_of_tables(spark):
    made = spark.sql("""SELECT * FROM VALUES ('a', array('x','y'), timestamp'2020-01-01'), ('b', array('y','x'), timestamp'2021-01-01'),
        ('c', array('x','y'), timestamp'2021-01-01'), ('d', array('z'), timestamp'2019-01-01') t(run_id, table_names, timestamp)""")
    assert rows(runs.latest_runs(made), "table_group", "run_id") == [("x,y", "b"), ("z", "d")]


def test_run_ids_follow_time():
    assert runs.time_ordered_id()[14] == "7"


def test_sample_inclusion_grows_with_weight(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, "heavy").otherwise("light").alias("w"))
    sample = sampling.weighted_sample(df, "w", {"heavy": 4.0, "light": 1.0}, rows=1000, key=F.col("id"))
    counts = dict(rows(sampling.sample_distribution(sample, "w")))
    assert sum(counts.values()) == 1000 and counts["heavy"] > 3 * counts["light"]


def test_weights_are_checked(spark):
    with pytest.raises(ValueError):
        sampling.check_weights({"a": -1})
    assert sampling.check_weights({"a": 1000}) == {"a": 100.0}
    df = spark.createDataFrame([("a",), ("b",), (None,)], "w string")
    assert sampling.sample_scores(df, "w", {"a": 0.0}, key=F.coalesce("w", F.lit("-"))).count() == 2
    assert dict(rows(sampling.sample_distribution(df, "w"))) == {"a": 1, "b": 1, "None": 1}


def test_running_sample_equals_the_batch_sample(spark, tmp_path):
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("w"))
    keeper = RunningSample(str(tmp_path / "s"), "w", "id", {"1": 3.0, "2": 0.0}, rows=50)
    for i in range(3):
        keeper.update(df.where(F.col("id") % 3 == i) if i < 2 else df.where(F.col("id") % 3 == 2), i)
    whole = sampling.weighted_sample(df, "w", {"1": 3.0, "2": 0.0}, 50, key=F.col("id"))
    assert rows(keeper.result(spark), "id") == rows(whole, "id")


def test_audit(spark):
    df = spark.createDataFrame([("1", "a", "12345"), ("1", None, "1"), ("2", "b", None)], "entity_id string, company_name string, postal_code string")
    rules = audit.bind(df.columns, audit.rules_for("business_entity_registry"))
    got = {(r["column"], r["rule"], r["severity"]): (r["good"], r["seen"], r["success"]) for r in audit.audit(df, rules).collect()}
    assert got == {
        ("entity_id", "unique", "warning"): (1, 3, False), ("entity_id", "unique", "critical"): (1, 3, False),
        ("company_name", "not_null", "critical"): (2, 3, False), ("company_name", "unique", "warning"): (2, 2, True),
        ("postal_code", "length_between", "warning"): (1, 2, False),
    }
    outcome = audit.verdict(audit.audit(df, rules)).first()
    assert outcome["outcome"] == "failed" and not outcome["passed"]
    with pytest.raises(ValueError):
        audit.bind(["a"], [audit.RuleSet((), rules)])
    with pytest.raises(ValueError):
        audit.bind(["a"], [audit.RuleSet(("*",), ())])
    with pytest.raises(ValueError):
        audit.audit(df, [])


def test_audit_of_an_empty_table_has_every_rule(spark):
    from recordloom.operators import audit

    empty = spark.createDataFrame([], "k string, city string")
    kinds = [audit.AuditRule("not_null", column="k"), audit.AuditRule("unique", column="k")]
    got = sorted((r["rule"], r.seen, r.success) for r in audit.audit(empty, kinds).collect())
    assert got == [("not_null", 0, True), ("unique", 0, True)]


def test_large_weights_are_used_as_they_are():
    from recordloom.operators.sampling import check_weights

    assert check_weights({"a": 1e6}, most=None) == {"a": 1e6}
