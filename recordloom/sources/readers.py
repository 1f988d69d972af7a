"""File scans. CSV is read as strings against a declared header; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from recordloom.functions.keys import restore_unknown

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, multi_line: bool | None = True) -> DataFrame:
    """Header row to string columns. With a schema, unreadable lines keep their text in ``_corrupt_record``.

    Quoted values may span lines, which makes a file unsplittable: one task reads all of it. With
    ``multi_line`` None a scan over the lines looks first whether any value does, and if none does
    the files are split; both ways give the same rows. False says that none does.
    """
    if multi_line is None:
        multi_line = lines_need_context(spark, path)
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("encoding", "UTF-8")
    if schema is None:
        return reader.option("inferSchema", False).csv(path)
    return reader.schema(with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def lines_need_context(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether some line of the CSV files can not be read without those around it.

    A quote within a value is doubled, so a value spans lines only if some line has an odd number
    of quotes. Lines that end in a bare carriage return, or hold only blanks, count as well: the
    reader of single lines takes them in another way. The scan is split, and ends at the first such line.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    odd = F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1
    blank = line.rlike(r"\A[ \t\x0B\f]+\r?\z")
    return not lines.where(odd | line.rlike(r"\r(?!\z)") | blank).isEmpty()


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A document that is a list gives one row per element, an object gives one row."""
    reader = spark.read.option("multiLine", True)
    return (reader if schema is None else reader.schema(schema)).json(path)


READERS = {".csv": read_csv, ".parquet": read_parquet, ".json": read_json}


def file_type(path: str) -> str | None:
    """The extension of a file that can be read, else null."""
    return next((e for e in READERS if path.rstrip("/").lower().endswith(e)), None)


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool | None = True) -> DataFrame:
    """Dispatch on the file extension; ``multi_line`` is for CSV."""
    extension = file_type(path)
    if extension is None:
        raise ValueError(f"unknown file type for {path!r}, expected one of {sorted(READERS)}")
    if extension == ".csv":
        return read_csv(spark, path, schema, multi_line)
    return READERS[extension](spark, path, schema)


def discover(
    spark: SparkSession, prefix: str, file_name_pattern: str | None = None, match_on_path: bool = False
) -> DataFrame:
    """Files under a prefix, one row each, optionally kept by a regex on the name or the whole path.

    Only listing metadata is used: the file contents are never read.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modificationTime")
    )
    if file_name_pattern is None:
        return files
    return files.where(F.col("path" if match_on_path else "file_name").rlike(file_name_pattern))


def select_existing(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Only the requested columns that exist; everything when none are requested."""
    return df if not columns else df.select(*[c for c in columns if c in df.columns])


def keep_keys(df: DataFrame, keys: DataFrame | Sequence, key_column: str) -> DataFrame:
    """Rows whose key is among ``keys``: an ``IN`` filter that reaches the scan for a literal
    list, a semi join for a frame of keys."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(key_column)), key_column, "left_semi")
    return df.where(F.col(key_column).isin(list(keys)))


def read_table(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    keys: DataFrame | Sequence | None = None,
    key_column: str | None = None,
    partition_key: str | None = None,
) -> DataFrame:
    """Projection, key filter and sentinel restore over a stored table."""
    if keys is not None:
        if key_column is None:
            raise ValueError("a key filter needs key_column")
        table = keep_keys(table, keys, key_column)
    if partition_key in table.columns:
        table = restore_unknown(table, partition_key)
    return select_existing(table, columns)


def not_loaded(files: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Files that the manifest of processed files does not list yet."""
    return files.join(manifest.select(path), path, "left_anti")


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
