"""The operators bound to the given tables, and the SQL of the results that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.llm import contamination, hard_negatives, html_text, language, language_model, license_scan, mixture, near_dedup, neighbours, token_blocks, top_products, toxicity, whitening
from recordloom.llm.tables import crc_fold, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def tokenizer_path() -> str:
    """The public tokenizer's file; every node has the package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A-Z lower-cased, nothing else.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"


@query("op1_language_model")
def op1(spark, sf_dir):
    found = language_model.score(table(spark, sf_dir, "documents"), crc_fold("doc_id", 7) != 2)
    return found.select("doc_id", (crc_fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_toxicity")
def op2(spark, sf_dir):
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_fold("doc_id", 4) != 2)
    return found.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op3_near_duplicates")
def op3(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4, similarity_pct=80)


@query("op4_licenses")
def op4(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_neighbours")
def op5(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op6_html_text")
def op6(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


CONTAMINATION_SQL = f"""
    WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS g, least(13, len(w)) AS k
        FROM i, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(p) WHERE len(w) > 0),
    spot AS (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k FROM d, (SELECT DISTINCT k FROM win)), unnest(range(1, len(w) - k + 2)) AS t(p)),
    hit AS (SELECT doc_id, p, k, item_id FROM spot JOIN win USING (g, k)),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + k)) AS t(q) GROUP BY 1),
    named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query("op7_contamination", CONTAMINATION_SQL)
def op7(spark, sf_dir):
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_token_blocks")
def op8(spark, sf_dir):
    return token_blocks.token_ids(table(spark, sf_dir, "documents"), tokenizer_path())


#: Targets by filling up to the level at which the weights of the sources not yet stopped share the rest.
MIXTURE_SQL = rf"""
    WITH d AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size,
        md5('7:' || CAST(doc_id AS VARCHAR)) AS k FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
    l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce((SELECT sum(3 * source_size) FROM s b WHERE 3 * b.source_size / b.w < 3 * a.source_size / a.w), 0))
        / ((SELECT sum(w) FROM s) - coalesce((SELECT sum(w) FROM s b WHERE 3 * b.source_size / b.w < 3 * a.source_size / a.w), 0)) AS lev FROM s a),
    t AS (SELECT source, source_size, least(3.0 * source_size, w * coalesce((SELECT arg_min(lev, 3 * source_size / w) FROM l WHERE lev * w < 3 * source_size), 1e300)) AS target FROM l),
    p AS (SELECT doc_id, size, source_size, target, least(3 * source_size, floor(target + 0.5)::BIGINT) AS want,
        sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS a, d.source
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    b AS (SELECT greatest(1, ceil(sum(source_size) / 1048576.0)::BIGINT) AS block, sum(source_size)::BIGINT AS total, ceil(sum(source_size) / greatest(1, ceil(sum(source_size) / 1048576.0)))::BIGINT AS slots FROM t),
    r AS (SELECT *, coalesce(lag(high) OVER (ORDER BY source NULLS LAST), 0) AS low
        FROM (SELECT source, sum(target::DOUBLE) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / (SELECT total FROM b) AS high FROM t)),
    g AS (SELECT i, i * 0.6180339887498949::DOUBLE - floor(i * 0.6180339887498949::DOUBLE) AS u FROM range((SELECT slots FROM b)) AS x(i)),
    z AS (SELECT source, i AS slot, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS rank FROM g JOIN r ON u >= low AND u < high)
    SELECT doc_id, size, source_size, target::DOUBLE AS target, CAST(greatest(0, least(size, want - a)) + greatest(0, least(size, want - a - source_size))
        + greatest(0, least(size, want - a - 2 * source_size)) AS BIGINT) AS taken,
        CASE WHEN size > 0 AND a < want THEN coalesce(z.slot, (SELECT slots FROM b) + a // (SELECT block FROM b)) END AS first_slot
    FROM p LEFT JOIN z ON z.source IS NOT DISTINCT FROM p.source AND z.rank = a // (SELECT block FROM b)"""


@query("op9_mixture", MIXTURE_SQL)
def op9(spark, sf_dir):
    return mixture.mix(table(spark, sf_dir, "documents")).docs.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


@query("op10_language")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold("doc_id", 4)
    models = language.train(language.training_rows(docs, fold != 2))
    found = language.with_language(docs.select("doc_id", "text"), models)
    return found.select("doc_id", (fold == 2).alias("held_out"), "language.lang_pred", "language.score")


#: Rows that take part, with their integers as doubles, which hold every product here exactly.
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"

TOP_PRODUCTS_SQL = f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings WHERE {_FINITE}),
    p AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM p QUALIFY rank <= 20"""


@query("op11_top_products", TOP_PRODUCTS_SQL)
def op11(spark, sf_dir):
    return top_products.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


HARD_NEGATIVES_SQL = f"""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
    p AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
        FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
    pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM pos JOIN p USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def op12(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
