"""Joins. None carries a broadcast hint: Spark broadcasts a side whose measured size
is under its threshold and otherwise shuffles, splitting hot keys adaptively."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def with_dimension(facts: DataFrame, dimension: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Facts with the dimension's columns, NULL where it has no such key."""
    return facts.join(dimension, keys, "left")


def with_region_name(df: DataFrame, names: DataFrame, key: str = "sggcd") -> DataFrame:
    """Add ``region_ko``: the region's name, or its code where it has none."""
    named = names.select(F.col(key).alias("_key"), F.col("region_ko").alias("_name"))
    return (
        df.join(named, F.col(key) == F.col("_key"), "left")
        .withColumn("region_ko", F.coalesce("_name", F.col(key)))
        .drop("_key", "_name")
    )


def only_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are listed. Only where the keys are partition columns of ``df`` are files left out before they are opened."""
    return df.join(listed.select(*keys).distinct(), list(keys), "left_semi")


def not_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(listed.select(*keys).distinct(), list(keys), "left_anti")


def with_parent(children: DataFrame, parents: DataFrame, child_key: str, key: str, name: str) -> DataFrame:
    """Children with ``parentCortarNo`` and ``parentCortarName`` of the level above."""
    above = parents.select(F.col(key).alias("parentCortarNo"), F.col(name).alias("parentCortarName"))
    return children.join(above, F.col(child_key) == F.col("parentCortarNo"), "inner")


def with_single_row(df: DataFrame, one_row: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add values of a one-row frame as constants; ``names`` maps its columns to new ones."""
    packed = one_row.select(F.struct(*[F.col(c).alias(n) for c, n in names.items()]).alias("_one")).scalar()
    return (
        df.withColumn("_one", packed)
        .withColumns({n: F.col(f"_one.{n}") for n in names.values()})
        .drop("_one")
    )


def latest_only(df: DataFrame, column: str, reference: DataFrame | None = None) -> DataFrame:
    """Rows of the latest value of ``column`` in ``reference`` (the frame itself by default)."""
    newest = (df if reference is None else reference).agg(F.max(column).alias("_max")).scalar()
    return df.where(F.col(column) == newest)
