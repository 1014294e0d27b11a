"""Ordered slices. Every order ends in columns that make it total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hanok.operators.medians import value_bucket


def first_rows(df: DataFrame, count: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``count`` rows of a total order; each task keeps only its own best rows."""
    return df.orderBy(*order).limit(count)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], count: int = 1) -> DataFrame:
    """The first rows of every key; Spark drops later rows before the shuffle."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).where(F.col("_rn") <= count).drop("_rn")


def names_by_best(df: DataFrame, name: str, rate: str) -> DataFrame:
    """Each name once, ordered by its best rate."""
    return df.groupBy(name).agg(F.max(rate).alias(rate)).orderBy(F.desc_nulls_last(rate), name)


def order_bucket(column: str, kind: str) -> Column:
    """A whole number that never falls where the column rises, so that ranks can be counted bucket by bucket.

    Numbers go by ``value_bucket`` (at most some millions of buckets, whatever the rows), days and times as numbers, text by its first
    three bytes. Other types have one bucket.
    """
    c = F.col(column)
    if kind in ("date", "timestamp"):
        c = (F.unix_date(c) if kind == "date" else F.unix_micros(c)).cast("double")
    elif kind == "string":
        c = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 3)), 6, "0"), 16, 10).cast("double")
        return F.coalesce(c, F.lit(0.0)).cast("long")
    elif not kind.startswith(("decimal", "double", "float", "bigint", "int", "smallint", "tinyint")):
        return F.lit(0).cast("long")
    return value_bucket(c.cast("double"))


def ranked_values(df: DataFrame, column: str, rank_name: str) -> DataFrame:
    """Distinct values with their rank from 0, in two steps: ranks of buckets by running counts, then ranks within each bucket.

    One task sees a row per bucket, not per value; the values of a bucket are ordered in a task of their own.
    """
    kind = dict(df.dtypes)[column]
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_b", order_bucket(column, kind))
    counts = values.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_b").alias("_sb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_b").orderBy(column)) - 1
    # Null-safe: a plain comparison would put a filter below the distinct values, and they would be found once more.
    placed = values.withColumn("_within", within).join(starts, F.col("_b").eqNullSafe(F.col("_sb")))
    return placed.select(column, (F.col("_start") + F.col("_within")).cast("int").alias(rank_name))
