"""Other file readers: Parquet, per-entity CSV, lists and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hanok.functions.text import try_cast_to
from hanok.schema import MANIFEST_SCHEMA, STATE_SCHEMA
from hanok.sources.bronze import existing, read_pages


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a forced schema leaves out file columns it does not name."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV read as text, each file by its own header, then cast by name; failed casts become NULL."""
    return try_cast_to(read_pages(spark, path, columns=None), schema)


def read_keyed_csv(spark: SparkSession, glob: str, pattern: str, key: str) -> DataFrame:
    """Per-entity CSV files as text, each by its own header, with the key taken from each file name."""
    rows = read_pages(spark, glob, columns=None)
    name = F.regexp_extract("_file", "[^/]*$", 0)
    return rows.withColumn(key, F.regexp_extract(name, pattern, 1).try_cast("bigint")).drop("_file")


def read_csv_tree(spark: SparkSession, prefix: str, legacy_file: str | None = None) -> DataFrame:
    """All CSV files below a folder, at any depth, as text and each by its own header; the legacy file where there are none."""
    if prefix.lower().endswith(".csv"):
        return read_pages(spark, prefix, columns=None).drop("_file")
    root = prefix.rstrip("/")
    if existing(spark, [root]):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
        if not listed.select("path").isEmpty():
            return read_pages(spark, root, columns=None, recursive=True, only="*.csv").drop("_file")
    if legacy_file is None:
        raise ValueError(f"no CSV file below {prefix}")
    return read_pages(spark, legacy_file, columns=None).drop("_file")


def complex_numbers(spark: SparkSession, path: str) -> DataFrame:
    """Complex numbers: the first field of each line, where it is all digits."""
    first = F.trim(F.split("value", ",")[0])
    return spark.read.text(path).select(first.alias("complex_no")).where(F.col("complex_no").rlike("^[0-9]+$"))


def unit_types(df: DataFrame) -> DataFrame:
    """(complexNo, complexName, areaNo) from a unit-type list; areaNo may be called pyeongNo."""
    if "complexNo" not in df.columns:
        raise ValueError("unit-type list has no column complexNo")
    area = next((c for c in ("pyeongNo", "areaNo") if c in df.columns), None)
    if area is None:
        raise ValueError("unit-type list has no column pyeongNo or areaNo")
    name = F.col("complexName") if "complexName" in df.columns else F.lit("")
    return df.select(
        F.col("complexNo").try_cast("bigint").alias("complexNo"), name.alias("complexName"),
        F.col(area).try_cast("bigint").alias("areaNo"),
    ).where(F.col("areaNo").isNotNull()).distinct()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A run manifest: one JSON document."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The crawl state with its defaults: version 2 for a new state, 1 for an old file without one."""
    if not existing(spark, [path]):
        blank = spark.createDataFrame([(None,) * len(spark.createDataFrame([], STATE_SCHEMA).columns)], STATE_SCHEMA)
        return blank.withColumns({"version": F.lit(2), "done": F.lit(False)})
    read = spark.read.schema(STATE_SCHEMA).option("multiLine", True).json(path)
    return read.withColumns(
        {"version": F.coalesce("version", F.lit(1)), "done": F.coalesce("done", F.lit(False))}
    )
