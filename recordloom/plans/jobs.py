"""The user-level jobs, from raw files to published records."""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.functions.keys import restore_unknown
from recordloom.operators import audit as audits
from recordloom.operators import gold as publishing
from recordloom.operators.align import align_sources, tag_source, union_by_name
from recordloom.operators.blocking import PID, profiles, with_profile_id
from recordloom.operators.dedup import dedup_ranked
from recordloom.operators.history import HistoryTable
from recordloom.operators.model import MatchModel, load_model, save_model, with_term_frequencies
from recordloom.operators.resolution import cluster, links, predict
from recordloom.operators.runs import latest_runs, run_record, time_ordered_id
from recordloom.operators.sampling import weighted_sample
from recordloom.operators.survivorship import Integrated, integrate, link_records
from recordloom.operators.training import train
from recordloom.operators.validate import validate
from recordloom.plans.settings_er import ResolutionSettings
from recordloom.session import cut_lineage
from recordloom.settings import HASH_DIFF, LOAD_TS, SAMPLE_ROWS
from recordloom.sources.readers import READERS, discover, file_type, not_loaded, path_exists, read_any, read_csv, read_parquet
from recordloom.sources.writers import move_files, overwrite_table, quarantine_clusters, quarantine_rows, write_json, write_parquet
from recordloom.specs import SourceSpec, route, spec_for_path

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Folders of a run."""

    root: str

    def silver(self, source: str) -> str:
        return f"{self.root}/silver/{source}/records"

    def deduplicated(self, source: str) -> str:
        return f"{self.root}/silver/{source}/deduplicated.parquet"

    def errors(self, source: str) -> str:
        return f"{self.root}/errors/{source}/errors.parquet"

    def manifest(self) -> str:
        return f"{self.root}/manifest"

    def run(self, run_id: str) -> str:
        return f"{self.root}/entity_resolution/{run_id}"

    def integrated(self, run_id: str, part: str) -> str:
        return f"{self.run(run_id)}/integrated/{part}"

    def mart(self, part: str) -> str:
        return f"{self.root}/data_mart/{part}"


def silver_table(spark: SparkSession, layout: Layout, spec: SourceSpec) -> HistoryTable:
    return HistoryTable(spark, layout.silver(spec.name), spec.primary_key, spec.partition_key)


def bronze_to_silver(spark: SparkSession, path: str, specs: Sequence[SourceSpec], layout: Layout) -> dict:
    """Validate a raw file, quarantine its bad rows and upsert the good ones."""
    spec = spec_for_path(path, specs)
    if spec is None:
        raise ValueError(f"no source matches {path!r}")
    checked = validate(read_any(spark, path, spec.raw_schema if file_type(path) == ".csv" else None, spec.multi_line), spec)
    return load_validated(spark, checked.stored(), layout)


_PLANNED = "batch string, source string, file_type string, path string, length long"


def load_new_files(spark: SparkSession, prefix: str, specs: Sequence[SourceSpec], layout: Layout, archive: str | None = None) -> list[dict]:
    """Load every raw file below ``prefix`` that no earlier call has loaded: one batch per source and file type.

    A manifest under the layout lists the files of each batch before it is loaded and the batches
    that are. A call that died leaves a planned batch, which the next call loads first under the
    same name, so its rows and its quarantine are there once. Files of no source are left alone.
    With ``archive``, a folder outside ``prefix``, loaded files are moved there. The driver holds the
    names of new files, never their contents.
    """
    manifest, by_name = layout.manifest(), {s.name: s for s in specs}
    planned = _stored(spark, f"{manifest}/planned", _PLANNED)
    files = discover(spark, prefix).withColumn("source", route(F.col("path"), [(s.path_pattern, s.name) for s in specs])).where("source IS NOT NULL")
    fresh = [r for r in not_loaded(files, planned).select("source", "path", "length").collect() if file_type(r["path"])]
    named: dict[tuple[str, str], list] = {}
    for r in sorted(fresh, key=lambda r: r["path"]):
        named.setdefault((r["source"], file_type(r["path"])), []).append(r)
    if named:
        batch = {key: hashlib.sha256("\n".join(r["path"] for r in rows).encode()).hexdigest()[:16] for key, rows in named.items()}
        rows = [(batch[key], *key, r["path"], r["length"]) for key, group in named.items() for r in group]
        write_parquet(spark.createDataFrame(rows, _PLANNED), f"{manifest}/planned", mode="append")
    waiting = _stored(spark, f"{manifest}/planned", _PLANNED).join(_stored(spark, f"{manifest}/loaded", "batch string"), "batch", "left_anti")
    waiting = waiting.where(F.col("source").isin(list(by_name))).groupBy("batch", "source", "file_type").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("source", "batch").collect()
    out = []
    for todo in waiting:
        spec, paths = by_name[todo["source"]], todo["paths"]
        if todo["file_type"] == ".csv":
            raw = read_csv(spark, paths, spec.raw_schema, spec.multi_line)
        else:
            raw = READERS[todo["file_type"]](spark, paths)
        out.append(load_validated(spark, validate(raw, spec).stored(), layout, todo["batch"]) | {"files": len(paths)})
        write_parquet(spark.createDataFrame([(todo["batch"],)], "batch string"), f"{manifest}/loaded", mode="append")
    if archive is not None:
        loaded = _stored(spark, f"{manifest}/planned", _PLANNED).join(_stored(spark, f"{manifest}/loaded", "batch string"), "batch", "left_semi")
        move_files(spark, [r["path"] for r in files.join(loaded.select("path"), "path", "left_semi").select("path").collect()], prefix, archive)
    return out


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the manifest, empty before its first row."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def load_validated(spark: SparkSession, checked, layout: Layout, batch: str | None = None) -> dict:
    """Quarantine the rejected rows and upsert the valid ones. A named batch that is loaded again changes neither."""
    spec = checked.spec
    counts = checked.counts or checked.metrics().first().asDict()
    if counts["failure"]:
        quarantine_rows(checked.rejected, layout.errors(spec.name), batch or uuid.uuid4().hex)
    version = silver_table(spark, layout, spec).write(checked.valid, batch)
    return {"source": spec.name, "version": version, **counts}


def audit_silver(
    spark: SparkSession, spec: SourceSpec, layout: Layout, weights: Mapping[str, float] | None = None,
    rows: int = SAMPLE_ROWS, additional: Sequence[audits.RuleSet] = (),
) -> DataFrame:
    """Rule results over a weighted sample of the current silver rows."""
    table = restore_unknown(silver_table(spark, layout, spec).read(), spec.partition_key)
    sample = weighted_sample(table, spec.weight_column, weights, rows, key=F.col(spec.primary_key[0]))
    return audits.audit(sample, audits.bind(spec.schema.fieldNames(), audits.rules_for(spec.name, additional)))


def dedup_silver(spark: SparkSession, spec: SourceSpec, layout: Layout) -> DataFrame:
    """Best row per key of the current silver rows, stored as a snapshot."""
    table = restore_unknown(silver_table(spark, layout, spec).read(), spec.partition_key)
    overwrite_table(dedup_ranked(table, spec.primary_key), layout.deduplicated(spec.name))
    return spark.read.parquet(layout.deduplicated(spec.name))


@dataclass(frozen=True)
class Resolution:
    links: DataFrame
    predictions: DataFrame
    model: MatchModel


def resolve(
    frames: Mapping[str, tuple[DataFrame, str]],
    settings: ResolutionSettings | None = None,
    model: MatchModel | None = None,
) -> Resolution:
    """Link and deduplicate ``{source: (frame, primary key)}``; trains a model when none is given."""
    settings = settings or ResolutionSettings()
    columns = [c.column for c in settings.comparisons]
    # bookkeeping of the load plays no part in matching
    bare = {n: (df.drop(HASH_DIFF, LOAD_TS), key) for n, (df, key) in frames.items()}
    records = with_profile_id(align_sources(bare), columns, settings.link_type)
    records = cut_lineage(records.select("node_id", "pid", "unique_id", "data_source", *columns), "records")
    rows = profiles(records, columns, settings.link_type)
    rows = cut_lineage(with_term_frequencies(rows, settings.comparisons, "n_records"), "profiles")
    if model is None:
        model = train(
            records, rows, settings.comparisons, settings.deterministic, settings.training, settings.recall,
            settings.max_random_pairs, settings.link_type,
        )
    predictions = cut_lineage(
        predict(rows, settings.blocking, model, settings.predict_threshold, settings.link_type, keep=(PID,)), "predictions"
    )
    placed = cluster(rows, predictions, settings.cluster_threshold)
    return Resolution(links(records, placed, {n: key for n, (_, key) in frames.items()}), predictions, model)


def run_resolution(
    spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout, settings: ResolutionSettings | None = None,
    model_path: str | None = None,
) -> str:
    """Resolve the deduplicated sources and store links, model and run record. Returns the run id."""
    settings = settings or ResolutionSettings()
    frames = {s.name: (spark.read.parquet(layout.deduplicated(s.name)), s.primary_key[0]) for s in specs}
    model = load_model(spark, model_path) if model_path else None
    result = resolve(frames, settings, model)
    run_id = time_ordered_id()
    folder = layout.run(run_id)
    write_parquet(result.links, f"{folder}/links.parquet")
    save_model(spark, result.model, f"{folder}/model")
    stored = spark.read.parquet(f"{folder}/links.parquet")
    write_json(run_record(stored, list(frames), settings.as_dict(), f"{folder}/links.parquet", run_id), f"{folder}/metadata")
    return run_id


def member_rows(frames: Mapping[str, tuple[DataFrame, str]], link_rows: DataFrame) -> DataFrame:
    """Source rows of every source under one schema, with composite id and cluster."""
    tagged = [tag_source(df, key, name) for name, (df, key) in frames.items()]
    return link_records(union_by_name(tagged), link_rows)


def newest_run(spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout) -> str:
    """The newest run over just these sources."""
    records = spark.read.json(f"{layout.root}/entity_resolution/*/metadata").select("run_id", "table_names", F.col("timestamp").cast("timestamp"))
    found = latest_runs(records).where(F.col("table_group") == ",".join(sorted(s.name for s in specs))).select("run_id").first()
    if found is None:
        raise ValueError(f"no run over {[s.name for s in specs]} below {layout.root}")
    return found["run_id"]


def create_integrated(spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout, run_id: str | None = None) -> Integrated:
    """Merge the clusters of a run, the newest by default, and store the result under it,
    quarantining clusters without an anchor. A run merged again replaces its own result."""
    run_id = run_id or newest_run(spark, specs, layout)
    frames = {s.name: (spark.read.parquet(layout.deduplicated(s.name)), s.primary_key[0]) for s in specs}
    members = cut_lineage(member_rows(frames, spark.read.parquet(f"{layout.run(run_id)}/links.parquet")), "members")
    result = integrate(members)
    for part in ("records", "alternates", "licenses"):
        overwrite_table(getattr(result, part), layout.integrated(run_id, part))
    quarantine_clusters(result.rejected, layout.integrated(run_id, "rejected"))
    return read_integrated(spark, layout, run_id)


def read_integrated(spark: SparkSession, layout: Layout, run_id: str) -> Integrated:
    return Integrated(*[spark.read.parquet(layout.integrated(run_id, p)) for p in ("records", "alternates", "licenses", "rejected")])


def create_gold(spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout, run_id: str | None = None) -> publishing.Gold:
    """Deduplicate the integrated records of a run, the newest by default, and publish anchors,
    bridge, gold records and their licenses."""
    made = publishing.publish(read_integrated(spark, layout, run_id or newest_run(spark, specs, layout)))
    parts = {"anchors": made.anchors, "id_bridge": made.bridge}
    for part, df in parts.items():
        overwrite_table(df, layout.mart(part))
    anchors, bridge = (spark.read.parquet(layout.mart(part)) for part in parts)
    gold = publishing.gold_records(bridge, anchors)
    overwrite_table(gold, layout.mart("gold_records"), "city")
    overwrite_table(made.licenses, layout.mart("gold_licenses"))
    records = read_parquet(spark, layout.mart("gold_records"), gold.schema)
    return publishing.Gold(anchors, bridge, records, spark.read.parquet(layout.mart("gold_licenses")))


def run_all(
    spark: SparkSession, raw_paths: Sequence[str], specs: Sequence[SourceSpec], layout: Layout,
    settings: ResolutionSettings | None = None,
) -> publishing.Gold:
    """Every job in order."""
    for path in raw_paths:
        bronze_to_silver(spark, path, specs, layout)
    for spec in specs:
        outcome = audits.verdict(audit_silver(spark, spec, layout)).first()
        if not outcome["passed"]:
            log.warning("audit of %s: %s", spec.name, outcome["outcome"])
        dedup_silver(spark, spec, layout)
    run_id = run_resolution(spark, specs, layout, settings)
    create_integrated(spark, specs, layout, run_id)
    return create_gold(spark, specs, layout, run_id)
