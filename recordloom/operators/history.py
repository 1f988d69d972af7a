"""Tables with row history: upsert, change feed, as-of read and rollback.

A history holds one row per version of a record: its columns, ``hdiff``, ``ldts`` and the
half-open validity interval ``[valid_from, valid_to)``; ``valid_to`` is null for the current
version. The functions are pure DataFrame plans. ``HistoryTable`` stores a history as
Parquet so that an upsert appends closed rows and rewrites only the buckets it changes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from recordloom.functions.keys import with_load_metadata
from recordloom.operators.dedup import first_per_key, tie_break
from recordloom.session import cut_lineage
from recordloom.settings import HASH_DIFF
from recordloom.sources.writers import write_parquet

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
ACTION = "action"
BUCKET = "_bucket"


def initialise(batch: DataFrame, version: int = 1) -> DataFrame:
    """First version of a table; ``batch`` already carries the load metadata."""
    return batch.withColumn(VALID_FROM, F.lit(version).cast("bigint")).withColumn(VALID_TO, F.lit(None).cast("bigint"))


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull()).drop(VALID_FROM, VALID_TO)


def as_of(history: DataFrame, version: int) -> DataFrame:
    """Rows that were current at a version."""
    alive = (F.col(VALID_FROM) <= version) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > version))
    return history.where(alive).drop(VALID_FROM, VALID_TO)


def version_at(commits: DataFrame, timestamp) -> DataFrame:
    """Last version committed at or before a timestamp; ``commits`` has version and committed_at."""
    return commits.where(F.col("committed_at") <= F.lit(timestamp).cast("timestamp")).agg(
        F.coalesce(F.max("version"), F.lit(0)).alias("version")
    )


def current_version(history: DataFrame) -> DataFrame:
    """Highest version seen; 0 for an empty table. Closing a row also marks a version."""
    return history.agg(
        F.coalesce(F.greatest(F.max(VALID_FROM), F.max(VALID_TO)), F.lit(0)).cast("bigint").alias("version")
    )


def one_per_key(batch: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    """A batch may name a key twice; the merge takes one of the rows, the same one every time."""
    return first_per_key(batch, list(primary_key), [F.col(HASH_DIFF), tie_break(batch)])


def merge_actions(live: DataFrame, batch: DataFrame, match_keys: Sequence[str]) -> DataFrame:
    """Outer join of current rows and a batch with the action per key.

    ``insert`` unmatched batch rows, ``update`` where the hash differs, ``keep`` the rest.
    Both sides stay whole rows (``old``, ``new``); keys never match on null.
    """
    o = live.select(F.struct("*").alias("old"), *[F.col(k).alias(f"_o_{k}") for k in match_keys])
    n = batch.select(F.struct("*").alias("new"), *[F.col(k).alias(f"_n_{k}") for k in match_keys])
    matches = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in match_keys]
    joined = o.join(n, matches, "full_outer")
    action = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "keep")
        .when(F.col(f"old.{HASH_DIFF}") != F.col(f"new.{HASH_DIFF}"), "update")
        .otherwise("keep")
    )
    return joined.select("old", "new", action.alias(ACTION))


def upsert(
    history: DataFrame,
    batch: DataFrame,
    primary_key: Sequence[str],
    version: int,
    partition_key: str | None = None,
) -> DataFrame:
    """Idempotent upsert of a prepared batch as ``version``; nothing is ever deleted.

    One shuffle of the current rows and the batch on the key. Each matched row yields at
    most two output rows: the old one with its interval closed and the new one. With
    ``partition_key`` a changed partition value inserts a second row for the same key.
    """
    keys = [*primary_key, *([partition_key] if partition_key else [])]
    columns = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)]
    live = history.where(F.col(VALID_TO).isNull()).drop(VALID_TO)
    merged = merge_actions(live, one_per_key(batch, keys).select(*columns), keys)
    v, no_end = F.lit(version).cast("bigint"), F.lit(None).cast("bigint")

    def row(side: str, start, end):
        fields = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*fields, start.cast("bigint").alias(VALID_FROM), end.alias(VALID_TO))

    started = F.col(f"old.{VALID_FROM}")
    out = (
        F.when(F.col(ACTION) == "insert", F.array(row("new", v, no_end)))
        .when(F.col(ACTION) == "update", F.array(row("old", started, v), row("new", v, no_end)))
        .otherwise(F.array(row("old", started, no_end)))
    )
    rows = merged.select(F.explode(out).alias("r")).select("r.*")
    return history.where(F.col(VALID_TO).isNotNull()).select(*rows.columns).unionByName(rows)


def rollback(history: DataFrame, to_version: int, primary_key: Sequence[str], version: int) -> DataFrame:
    """Make an old version current again, as a new version. Rows born later are closed.

    A row current in both states stays open; the others are closed and the old ones reopened.
    """
    if to_version is None:
        raise ValueError("rollback needs a version")
    was_alive = (F.col(VALID_FROM) <= to_version) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > to_version))
    is_alive = F.col(VALID_TO).isNull()
    v, no_end = F.lit(version).cast("bigint"), F.lit(None).cast("bigint")
    columns = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)]
    closed = history.withColumn(VALID_TO, F.when(is_alive & ~was_alive, v).otherwise(F.col(VALID_TO)))
    reopened = history.where(was_alive & ~is_alive).select(*columns, v.alias(VALID_FROM), no_end.alias(VALID_TO))
    return closed.select(*columns, VALID_FROM, VALID_TO).unionByName(reopened)


def change_feed(old: DataFrame, new: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    """Row-level changes between two states of a table, from one outer join on the key."""
    joined = merge_actions(old, new, primary_key)

    def tagged(side: str, kind: str):
        return F.struct(F.lit(kind).alias("change_type"), F.col(side).alias("row"))

    changes = (
        F.when(F.col("old").isNull(), F.array(tagged("new", "insert")))
        .when(F.col("new").isNull(), F.array(tagged("old", "delete")))
        .when(
            F.col(ACTION) == "update",
            F.array(tagged("old", "update_preimage"), tagged("new", "update_postimage")),
        )
    )
    return joined.select(F.explode(changes).alias("c")).select("c.change_type", "c.row.*")


def history_feed(history: DataFrame, primary_key: Sequence[str], since: int = 1) -> DataFrame:
    """Every change committed after version ``since``, newest first, read from the intervals.

    An interval opened by a commit is an insert, or a post-image when the same commit also
    closed one for the key; a closed one alone is a delete. The groups of the window hold at
    most two rows.
    """
    opened = history.where(F.col(VALID_FROM) > since).withColumn("commit_version", F.col(VALID_FROM))
    closed = history.where(F.col(VALID_TO) > since).withColumn("commit_version", F.col(VALID_TO))
    sides = opened.withColumn("_opened", F.lit(True)).unionByName(closed.withColumn("_opened", F.lit(False)))
    group = Window.partitionBy(*primary_key, "commit_version")
    paired = F.bool_or("_opened").over(group) & ~F.bool_and("_opened").over(group)
    kind = (
        F.when(F.col("_opened"), F.when(paired, "update_postimage").otherwise("insert"))
        .otherwise(F.when(paired, "update_preimage").otherwise("delete"))
    )
    feed = sides.withColumn("change_type", kind).drop("_opened", VALID_FROM, VALID_TO)
    return feed.orderBy(F.col("commit_version").desc(), *primary_key, "change_type")


class HistoryTable:
    """A history as plain Parquet: ``live`` holds the current rows, dealt to buckets by a hash of
    the key, ``closed/v=N`` the rows that version N closed, ``commits/v=N`` its time.

    An upsert compares keys and hashes first and rewrites only the buckets that a changed row
    falls into; a batch that changes nothing writes nothing. The rows of a version are stored
    aside before they replace anything, so a writer that died is finished by the next one. One
    writer at a time; a reader beside it may see buckets of both versions.
    """

    def __init__(self, spark: SparkSession, path: str, primary_key: Sequence[str], partition_key: str | None = None, buckets: int = 16):
        self.spark, self.path = spark, path.rstrip("/")
        self.primary_key, self.partition_key, self.buckets = tuple(primary_key), partition_key, buckets

    def _folder(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        files, p = self._folder(path)
        return files.exists(p)

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.primary_key), F.lit(self.buckets)).cast("int")

    def commits(self) -> DataFrame | None:
        """One row per version: its time, the schema of its live rows and the batch that made it, if it had a name."""
        root = f"{self.path}/commits"
        fields = "version bigint, committed_at timestamp, live_schema string, batch string"
        return self.spark.read.schema(fields).parquet(root) if self._exists(root) else None

    def version(self, timestamp=None) -> int:
        commits = self.commits()
        if commits is None:
            return 0
        if timestamp is not None:
            return version_at(commits, timestamp).first()["version"]
        return commits.agg(F.max("version").alias("v")).first()["v"] or 0

    def _schema(self, version: int) -> T.StructType:
        row = self.commits().where(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"{self.path} has no version {version}")
        return T.StructType.fromJson(json.loads(row["live_schema"]))

    def _live(self, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = self._schema(self.version())
        rows = self.spark.read.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{self.path}/live")
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))).select(*schema.fieldNames())

    def history(self) -> DataFrame:
        """All rows with their intervals, with the columns of all versions; null where a version had none.

        A column whose type an overwrite changed can only be read by version once no closed row has it.
        """
        live = _opened(self._live())
        if not self._exists(f"{self.path}/closed"):
            return live
        fields = {f.name: f for f in live.schema}
        for row in self.commits().select("live_schema").distinct().collect():
            for f in T.StructType.fromJson(json.loads(row["live_schema"])):
                fields.setdefault(f.name, f)
        closed = self.spark.read.schema(T.StructType(list(fields.values()))).parquet(f"{self.path}/closed")
        return live.unionByName(closed.select(*fields), allowMissingColumns=True)

    def read(self, version: int | None = None, timestamp=None) -> DataFrame:
        """The rows of a version with the columns that it had; the newest by default."""
        if timestamp is not None:
            version = self.version(timestamp)
        if version is None:
            return self._live().drop(VALID_FROM)
        return as_of(self.history(), version).select(*[c for c in self._schema(version).fieldNames() if c != VALID_FROM])

    def write(self, data: DataFrame, batch: str | None = None) -> int:
        """Create the table, or upsert ``data`` into it. Returns the version that holds the data.

        Of the live rows only keys and hashes are compared; whole rows are read from the buckets
        that change. Columns that only ``data`` has are added, null in the rows that stay. A named
        ``batch`` that a version was already made of changes nothing and returns that version.
        """
        self._finish()
        version = self.version()
        if batch is not None and version:
            seen = self.commits().where(F.col("batch") == batch).agg(F.min("version").alias("v")).first()["v"]
            if seen is not None:
                return seen
        prepared = with_load_metadata(data, self.primary_key, self.partition_key)
        if version == 0:
            return self._commit(initialise(prepared, 1), 1, batch, whole=True)
        changes = cut_lineage(self._changed(prepared), "changes")
        touched = [r[0] for r in changes.select(self._bucket()).distinct().collect()]  # no more than there are buckets
        if not touched:
            if batch is None:
                return version
            return self._mark(version + 1, self._schema(version), batch)
        live = _opened(self._live(touched))
        added = {f.name: F.lit(None).cast(f.dataType) for f in prepared.schema if f.name not in live.columns}
        return self._commit(upsert(live.withColumns(added), changes, self.primary_key, version + 1), version + 1, batch)

    def _changed(self, batch: DataFrame) -> DataFrame:
        """Rows of a batch, one per key, that are new or differ from the live row."""
        known = self._live().select(*[F.col(k).alias(f"_k_{k}") for k in self.primary_key], F.col(HASH_DIFF).alias("_known"))
        same = [F.col(k) == F.col(f"_k_{k}") for k in self.primary_key]
        rows = one_per_key(batch, self.primary_key).join(known, same, "left")
        return rows.where(F.col("_known").isNull() | (F.col("_known") != F.col(HASH_DIFF))).select(*batch.columns)

    def overwrite(self, data: DataFrame) -> int:
        """Close every live row and start from ``data`` and its schema; old versions stay readable."""
        self._finish()
        version = self.version() + 1
        fresh = initialise(with_load_metadata(data, self.primary_key, self.partition_key), version)
        if version > 1:
            gone = self._live().withColumn(VALID_TO, F.lit(version).cast("bigint"))
            return self._commit(fresh.unionByName(gone, allowMissingColumns=True), version, whole=True, columns=fresh.drop(VALID_TO).columns)
        return self._commit(fresh, version, whole=True)

    def rollback(self, version: int | None = None, timestamp=None) -> int:
        if version is None and timestamp is None:
            raise ValueError("rollback needs a version or a timestamp")
        self._finish()
        target = self.version(timestamp) if version is None else version
        new = self.version() + 1
        return self._commit(rollback(self.history(), target, self.primary_key, new), new, whole=True, columns=self._schema(target).fieldNames())

    def changes(self, since: int = 1) -> DataFrame:
        """Net changes after version ``since``, from the rows that changed alone."""
        history = self.history()
        old = history.where((F.col(VALID_FROM) <= since) & (F.col(VALID_TO) > since)).drop(VALID_FROM, VALID_TO)
        new = history.where((F.col(VALID_FROM) > since) & F.col(VALID_TO).isNull()).drop(VALID_FROM, VALID_TO)
        return change_feed(old, new, self.primary_key)

    def _commit(self, rows: DataFrame, version: int, batch: str | None = None, whole: bool = False, columns: Sequence[str] | None = None) -> int:
        """Store aside the open rows of ``rows`` and those closed by this version, and let them take effect."""
        rows = rows.where(F.col(VALID_TO).isNull() | (F.col(VALID_TO) == version))
        aside = rows.withColumns({BUCKET: self._bucket(), "_closed": F.col(VALID_TO).isNotNull().cast("int")})
        order = [BUCKET, *([self.partition_key] if self.partition_key else [])]
        aside.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("_closed").parquet(f"{self.path}/pending/rows")
        live_schema = rows.select(*(columns or rows.drop(VALID_TO).columns)).schema.json()
        facts = [F.lit(x).alias(n) for n, x in (("version", version), ("whole", whole), ("live_schema", live_schema), ("row_schema", aside.drop("_closed").schema.json()))]
        write_parquet(self.spark.range(1).select(*facts, F.lit(batch).cast("string").alias("batch")), f"{self.path}/pending/ready", mode="overwrite")
        self._finish()
        return version

    def _finish(self) -> None:
        """Let a version that is stored aside take effect; each step can be repeated."""
        if not self._exists(f"{self.path}/pending/ready"):
            return
        ready = self.spark.read.parquet(f"{self.path}/pending/ready").first()
        fields = T.StructType([*T.StructType.fromJson(json.loads(ready["row_schema"])), T.StructField("_closed", T.IntegerType())])
        rows = self.spark.read.schema(fields).parquet(f"{self.path}/pending/rows")
        live_schema = T.StructType.fromJson(json.loads(ready["live_schema"]))
        write_parquet(rows.where("_closed = 1").drop("_closed", BUCKET), f"{self.path}/closed/v={ready['version']}", mode="overwrite")
        live = rows.where("_closed = 0").select(*live_schema.fieldNames(), BUCKET)
        mode = "static" if ready["whole"] else "dynamic"
        live.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(f"{self.path}/live")
        self._mark(ready["version"], live_schema, ready["batch"])
        files, pending = self._folder(f"{self.path}/pending")
        files.delete(pending, True)

    def _mark(self, version: int, live_schema: T.StructType, batch: str | None) -> int:
        marker = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"), F.current_timestamp().alias("committed_at"),
            F.lit(live_schema.json()).alias("live_schema"), F.lit(batch).cast("string").alias("batch"),
        )
        write_parquet(marker, f"{self.path}/commits/v={version}", mode="overwrite")
        return version


def _opened(live: DataFrame) -> DataFrame:
    return live.withColumn(VALID_TO, F.lit(None).cast("bigint"))
