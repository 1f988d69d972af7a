"""From raw documents to encoded training data: the stages, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.llm import contamination, language, mixture, near_dedup, token_blocks
from recordloom.llm.queries import tokenizer_path
from recordloom.llm.tables import crc_fold, cut_lineage, table

#: Size of the Arrow batches in which texts go to Python; a task holds a few on either side.
BATCH_BYTES = 4 << 20

#: No SQL can follow the byte models and the coder; the tests use brute force.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Set the size of Arrow batches for this session: the rows of a stage are written by its caller."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told: null texts and texts without a letter."""
    _small_batches(spark)
    return language.keep_identified(docs, crc_fold("doc_id", 4) != 2)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words.

    Rows are numbered first, so those that repeat an id, or have none, are documents of their own.
    Of a group the smallest id stays, null last; of rows that tie, the first.
    """
    own = docs.columns
    rows = cut_lineage(docs.withColumn("#row", F.monotonically_increasing_id()), "llm-numbered")
    found = near_dedup.near_duplicates(rows.select(F.col("#row").alias("doc_id"), "text"), k=5)
    named = rows.select("#row", F.col("doc_id").alias("#id")).join(found.select(F.col("doc_id").alias("#row"), "component_id"), "#row")
    named = cut_lineage(named, "llm-groups")
    order = F.struct(F.col("#id").isNull().alias("n"), "#id", "#row")
    first = named.groupBy("component_id").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("component_id", F.col("first.#row").alias("#first"))
    # what goes is the smaller part, so whole rows are matched with that
    gone = cut_lineage(named.join(first, "component_id").where("`#row` <> `#first`").select("#row"), "llm-gone")
    return rows.join(gone, "#row", "left_anti").select(*own)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which benchmark passages make up a twentieth or more."""
    _small_batches(spark)
    return contamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document, whole, as often as the mixture takes it; the next stage sorts them by id."""
    return mixture.mixed_documents(docs, in_order=False)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in coded blocks, read back: a row per document of the mixture."""
    _small_batches(spark)
    return token_blocks.token_ids(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("contamination", decontaminate),
    ("mixture", mix_sources),
    ("token blocks", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "llm-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
