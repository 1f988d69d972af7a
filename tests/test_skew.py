"""Hot keys, null keys and hubs: right rows, and no task that gets them all."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordloom.operators import blocking, components, survivorship
from recordloom.operators.model import exact_match, with_term_frequencies
from recordloom.operators.skew import HOT_KEYS, heavy_keys, split_join
from recordloom.session import cut_lineage
from recordloom.suite import matching

TASKS = 32


@pytest.fixture
def plain_shuffles(spark):
    """As many tasks as partitions and no help from adaptive execution."""
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(TASKS), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    per_task = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(per_task) / sum(per_task)


def test_a_third_on_one_key_and_most_keys_null(spark, plain_shuffles):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 30 == 1, F.concat(F.lit("k"), F.col("id") % 500))
    left = spark.range(n).select(F.col("id").alias("row"), key.alias("key"))  # a third hot, most of the rest null
    counts = left.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    right = counts.where("key IS NOT NULL").select("key", F.upper("key").alias("value"))
    heavy = heavy_keys(counts, "key", "n", hot_rows=200)
    assert rows(heavy, "key") == [("hot",)]
    for how in ("inner", "left"):
        joined = split_join(left, right, "key", heavy, ["row"], how)
        assert largest_share(joined) < 3 / TASKS
        assert rows(joined, "row", "key", "value") == rows(left.join(right, "key", how), "row", "key", "value")


    assert largest_share(left.join(right, "key")) > 1 / 4


def test_split_keys_are_few_at_any_size(spark):
    counts = spark.range(5000).select(F.col("id").alias("key"), F.lit(1_000_000).alias("n"))
    assert heavy_keys(counts, "key", "n").count() <= HOT_KEYS
    assert heavy_keys(counts.where("false"), "key", "n").count() == 0


def test_the_rows_of_a_hot_cluster_are_scored_in_many_tasks(spark, plain_shuffles, monkeypatch):
    monkeypatch.setattr(heavy_keys, "__defaults__", (50,))
    n = 6000
    members = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("cluster_id"),
        F.concat(F.lit("entity_id-__-"), F.col("id")).alias("composite_id"), F.lit("business_entity_registry").alias("data_source"),
        F.col("id").cast("string").alias("entity_id"), F.lit("NAME").alias("company_name"), F.lit("x").alias("city"), F.lit(None).cast("string").alias("vendor_id"),
    )
    scored = survivorship.score_members(members)
    assert largest_share(scored) < 3 / TASKS
    ranked = survivorship.with_anchor_agreement(scored, survivorship.pick_anchors(scored))
    assert largest_share(ranked) < 3 / TASKS
    assert ranked.count() == n and ranked.where("is_anchor").count() == 1 + n - n // 3


def test_term_frequencies_of_mostly_null_and_common_values(spark, plain_shuffles, monkeypatch):
    monkeypatch.setattr(heavy_keys, "__defaults__", (50,))
    profiles = spark.range(8000).select(
        F.col("id").cast("string").alias("pid"), F.lit(1).alias("n_records"),
        F.when(F.col("id") % 10 == 0, F.lit("v")).alias("rare"), F.when(F.col("id") % 2 == 0, F.lit("common")).otherwise(F.col("id").cast("string")).alias("often"),
    )
    found = with_term_frequencies(profiles, [exact_match("rare", True), exact_match("often", True)], "n_records")
    assert largest_share(found) < 3 / TASKS
    assert found.groupBy("tf_rare").count().collect() and rows(found.groupBy("tf_rare").count().na.fill(-1.0)) == [(-1.0, 7200), (1.0, 800)]
    assert found.where("tf_often = 0.5").count() == 4000


def test_a_hub_is_split_and_named_by_its_least_node(spark, plain_shuffles):
    n = 6000
    star = spark.range(1, n).select(F.lit("n000000").alias("a"), F.format_string("n%06d", "id").alias("b"))
    late = spark.range(1, n).select(F.lit("z").alias("a"), F.format_string("n%06d", "id").alias("b"))  # a hub that is not the least
    pair = spark.createDataFrame([("x1", "x2"), ("x2", "x3"), ("y", "y")], "a string, b string")
    found = components.connected_components(star.unionAll(late).unionAll(pair), "a", "b", hot_rows=100)
    assert rows(found.groupBy("component").count()) == [("n000000", n + 1), ("x1", 3)]
    nodes, coded = components.numbered(star)
    assert [r.node for r in nodes.orderBy("id").collect()] == sorted(r.node for r in nodes.collect())
    both = coded.unionAll(coded.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _ = components._to_least(both, 100, 2 * n)
    assert largest_share(joined) < 3 / TASKS


def test_small_cells_are_packed_and_tasks_follow_the_pairs(spark, monkeypatch):
    n = 400
    rows = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("pid"), F.lit("a").alias("name"), F.lit("s").alias("data_source"), F.lit(1).alias("n_records")
    )
    rule = blocking.block_on("name")
    keyed = rows.select(F.struct("*").alias("row"), F.struct(F.col("name").alias("k0")).alias("key"))
    left, right = blocking._sliced(keyed, blocking.hot_blocks(rows, [rule], 8), 8)
    assert left.count() + right.count() <= 2 * n  # 40,000 when each row was copied to every cell
    monkeypatch.setattr(blocking, "TASK_PAIRS", 1000)
    for cells in (8, blocking.CELL_ROWS):
        pairs = blocking.profile_pairs(rows, [rule], cell_rows=cells)
        found = pairs.select("l.pid", F.col("r.pid").alias("other"))
        assert found.count() == found.distinct().count() == n * (n - 1) // 2
        assert pairs.rdd.getNumPartitions() == 80


def test_block_sizes_are_measured_once(spark, monkeypatch):
    n = 60
    made = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("pid"), F.lit("a").alias("name"), F.lit("s").alias("data_source"), F.lit(1).alias("n_records")
    )
    monkeypatch.setattr(blocking, "CELL_ROWS", 8)  # cells are not packed, so a plan has no aggregates but those of the sizes
    pairs = blocking.profile_pairs(made, [blocking.block_on("name"), blocking.block_on("name", "data_source")], cell_rows=8)
    assert "Aggregate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count() == n * (n - 1) // 2


def test_links_store_folded_profiles_and_narrow_predictions(spark, tmp_path, monkeypatch):
    texts = [("src0", "Alpha beta gamma\nmiddle\nClosing line one"), ("src7", "Alpha beta gamma\nother\nClosing line one"), ("src1", "Something else\nx\nAnother end"), ("src14", None), ("src8", "")]
    docs = [(i, text, "en", source, len(text or "")) for i, (source, text) in enumerate(texts)]
    # other names, so that those of the first two are rare enough to carry their pair
    docs += [(100 + i, f"Name{i:03d} of {i * 7919}\nx\nStreet{i:03d} at {i * 104729}", "de", "src2", 30) for i in range(300)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stored = {}
    monkeypatch.setattr(matching, "cut_lineage", lambda df, tag: stored.setdefault(tag, (df.columns, df.inputFiles())) and cut_lineage(df, tag))
    found = matching.link_rows(spark, str(tmp_path))
    sizes = rows(found.groupBy("cluster_id").count().groupBy("count").count())
    assert sizes == [(1, 301), (2, 1)]
    assert all("/folded-" in f for f in stored["profiles"][1])  # not the snapshots, once per frequency
    assert stored["predictions"][0] == ["l", "r", "match_probability"]
