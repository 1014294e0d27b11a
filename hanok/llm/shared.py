"""What several operators need: reading tables, cutting lineage, moving text columns through Arrow."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_OWN: list[str] = []  # folders made by this process


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave that unset; its warehouse then holds the folder, since driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them see")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/llm_work"
    _OWN.append(f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _OWN[-1]


def clear_work(spark: SparkSession) -> None:
    """Delete the folders made so far, once everything that was derived from them is written elsewhere or no longer needed."""
    while _OWN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_OWN.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: lineage ends there, on disks that outlive executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Texts, null as empty."""
    return [x or "" for x in column.to_pylist()]


def map_batches(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``rows`` over each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield rows(batch)

    return df.mapInArrow(run, schema)


def replace_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with other values in one column and the same schema."""
    at = batch.schema.get_field_index(name)
    return pa.RecordBatch.from_arrays([*batch.columns[:at], values.cast(batch.schema.field(at).type), *batch.columns[at + 1 :]], schema=batch.schema)
