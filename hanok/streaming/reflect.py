"""New landed pages reflected into the raw table as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hanok.plans.refresh import RAW_TABLE, load_partitions
from hanok.session import shared_checkpoint_dir
from hanok.sinks import lake
from hanok.sources.bronze import path_columns


def touched_partitions(new_files: DataFrame) -> DataFrame:
    """(lawd_cd, deal_ym) of the files in a batch."""
    return (
        path_columns(new_files, "_file").select(F.col("lawdCd").alias("lawd_cd"), "deal_ym")
        .where(F.col("lawd_cd").isNotNull() & F.col("deal_ym").isNotNull()).distinct()
    )


def reflect_new_pages(
    spark: SparkSession,
    bronze_path: str,
    table: str = RAW_TABLE,
    checkpoint: str | None = None,
    location: str | None = None,
    table_format: str = lake.PARQUET,
    max_files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Take up all page files that arrived since the last run and stop.

    A batch only says which partitions got files; those partitions are then read whole
    and replaced, so one late page never drops its siblings. A batch that runs again
    after a failure replaces the same partitions with the same rows.
    """
    root = bronze_path.rstrip("/")
    arrivals = (
        # Of this format's columns only the path is asked for, so no file is opened.
        spark.readStream.schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY")
        .format("binaryFile")
        .option("pathGlobFilter", "page=*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(root)
        .select(F.col("path").alias("_file"))
    )

    def reflect(batch: DataFrame, _: int) -> None:
        load_partitions(batch.sparkSession, root, touched_partitions(batch), table, location, table_format)

    # A folder of its own per landing zone and table, where every executor can reach it.
    place = checkpoint or f"{shared_checkpoint_dir(spark)}/reflect/{table}"
    return (
        arrivals.writeStream.foreachBatch(reflect)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )
