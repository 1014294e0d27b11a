"""Exact medians per group that survive one group holding most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Buckets per unit of ln(value): each covers a ten-thousandth of the value's size.
BUCKETS_PER_LOG = 10_000
# The same for a first look at large groups: a hundredth, so that a group has some hundred buckets.
COARSE_BUCKETS_PER_LOG = 100
# Groups are dealt to so many slots by a hash of their keys; those of a slot with more rows than this are narrowed down instead of sorted.
SLOTS = 1 << 14
CROWDED = 1_000_000


def grouped_median(rows: DataFrame, keys: Sequence[str], value: Column, median_name: str, count_name: str) -> DataFrame:
    """Exact median of ``value`` and row count per group, one way for groups of every size; rows without a value are left out.

    Values are ordered like a sort does: negative infinity first, infinity and then NaN last. Nothing is computed
    while the plan is built.
    """
    narrow = rows.select(*keys, value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    return split_median(narrow, keys, "_v", median_name, count_name)


def large_group_median(rows: DataFrame, keys: Sequence[str], value: Column, median_name: str, count_name: str) -> DataFrame:
    """The same for few groups of many rows, however unevenly the rows are dealt to tasks.

    A first reading counts coarse buckets, whose number depends on the groups and the spread of their values, so that no task's
    count grows with its rows. A second one counts the values of the bucket or two that hold a group's middle ranks; these are narrowed
    down as in ``split_median``. ``rows`` are read twice, but hardly any are shuffled.
    """
    keys = list(keys)
    bucketed = rows.select(*keys, value.cast("double").alias("_v")).where(F.col("_v").isNotNull()).withColumn("_c", value_bucket("_v", COARSE_BUCKETS_PER_LOG))
    middle = _middle_buckets(bucketed.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_bn")), keys, "_c")
    near = bucketed.join(middle, _same([*keys, "_c"])).select(*keys, "_c", "_v", "_before", "_total")
    # A bucket's place in its group is the same in all its rows.
    place = (F.max("_before").alias("_start"), F.max("_total").alias("_all"))
    counted = near.groupBy(*keys, "_c", "_v", value_bucket("_v").alias("_b")).agg(F.count(F.lit(1)).alias("_n"), *place)
    return _median_of_counts(counted, keys, median_name, count_name, "_c")


def small_group_median(
    rows: DataFrame, keys: Sequence[str], value: Column, median_name: str, count_name: str, crowded: int = CROWDED
) -> DataFrame:
    """The same for many groups of few rows, from a written table: a group's values are shuffled once and sorted.

    Rows are read three times. A first reading counts them by slots, a hash of their keys, so a group of more than ``crowded`` rows
    shows however many groups there are; a slot's groups then all go the way of ``split_median``, and no task sorts such a group.
    """
    keys = list(keys)
    narrow = rows.select(*keys, value.cast("double").alias("_v"), F.xxhash64(*keys).alias("_h")).where(F.col("_v").isNotNull())
    narrow = narrow.withColumn("_slot", F.pmod("_h", F.lit(SLOTS)).cast("int"))
    full = narrow.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > crowded)
    # One row: for every slot whether it is crowded.
    flags = full.agg(F.collect_list("_slot").alias("_full")).select(
        F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda slot: F.array_contains("_full", slot)).alias("_flags")
    )
    in_crowd = F.get(flags.scalar(), F.col("_slot"))
    # The hash goes first: a sort then compares hardly anything else.
    ordered = Window.partitionBy("_h", *keys).orderBy("_v")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = narrow.where(~in_crowd).select(
        *keys, "_v",
        F.row_number().over(ordered).alias("_rank"),
        F.lead("_v").over(ordered).alias("_next"),
        F.count(F.lit(1)).over(whole).alias("_total"),
    )
    high = F.when(F.col("_total") % 2 == 1, F.col("_v")).otherwise(F.col("_next"))
    # Zero has one sign, as in counts of values.
    median = (F.col("_v") + high) / 2 + F.lit(0.0)
    usual = ranked.where(F.col("_rank") == F.floor((F.col("_total") + 1) / 2)).select(*keys, median.alias(median_name), F.col("_total").alias(count_name))
    return usual.unionByName(split_median(narrow.where(in_crowd).select(*keys, "_v"), keys, "_v", median_name, count_name))


def value_bucket(value: str | Column, per_log: int = BUCKETS_PER_LOG) -> Column:
    """A whole number that grows with the value, zero at zero and finer than any price band needs; its ends hold what is not finite."""
    v = F.col(value) if isinstance(value, str) else value
    size = F.floor(F.log1p(F.abs(v)) * F.lit(per_log))
    top = 1 << 40
    return (
        F.when(F.isnan(v), F.lit(top + 1))
        .when(v == float("inf"), F.lit(top))
        .when(v == float("-inf"), F.lit(-top))
        .otherwise((F.signum(v) * size).try_cast("long"))
    )


def split_median(rows: DataFrame, keys: Sequence[str], value: str, median_name: str, count_name: str) -> DataFrame:
    """Exact median by narrowing down: count per value, then per value bucket, then within one bucket.

    Equal values collapse before the first shuffle, and values of one group
    spread over all tasks. A running count over the group's buckets, whose number depends
    on the spread of values and not on the rows, finds the one or two that hold the middle ranks; only
    their values are ordered.
    """
    keys = list(keys)
    counted = rows.groupBy(*keys, F.col(value).alias("_v"), value_bucket(value).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    return _median_of_counts(counted, keys, median_name, count_name)


def medians_by_grain(
    rows: DataFrame, grains: dict[str, tuple[Sequence[str], Column | None]], value: Column, median_name: str, count_name: str
) -> DataFrame:
    """Exact medians of several groupings at once, from one reading of ``rows``: ``grain``, all keys (null where a grain lacks one),
    the median and the count.

    ``grains`` names each grouping's keys and, if not all rows belong to it, a condition on keys. Values are counted once, at the
    finest grouping, and these counts are rolled up to all others.
    """
    every = list(dict.fromkeys(k for keys, _ in grains.values() for k in keys))
    narrow = rows.select(*every, value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    kinds = dict(narrow.dtypes)
    finest = narrow.groupBy(*every, "_v", value_bucket("_v").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))

    def at(name: str, keys: Sequence[str]) -> Column:
        return F.struct(F.lit(name).alias("grain"), *[(F.col(k) if k in keys else F.lit(None).cast(kinds[k])).alias(k) for k in every])

    all_of = F.array_compact(F.array(*[at(name, keys) if holds is None else F.when(holds, at(name, keys)) for name, (keys, holds) in grains.items()]))
    counted = finest.select(F.explode(all_of).alias("_g"), "_v", "_b", "_n").select("_g.*", "_v", "_b", "_n")
    return _median_of_counts(counted, ["grain", *every], median_name, count_name)


def _same(columns: Sequence[str]) -> Column:
    """Null-safe throughout: a plain comparison would put a filter below the counting, and it would run once more."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in columns])


def _middle_buckets(buckets: DataFrame, keys: list[str], bucket: str, within: str | None = None) -> DataFrame:
    """The one or two buckets of each group that hold its middle ranks: keys and bucket (``_m_``), rows before the bucket, all rows.

    ``buckets`` holds ``_bn`` rows each. With ``within`` they are of that coarser bucket alone, which ``_start`` of the group's ``_all`` rows precede.
    """
    parts = [*keys, within] if within else keys
    in_group = Window.partitionBy(*parts)
    upto = F.sum("_bn").over(in_group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0))
    ranked = buckets.select(
        *parts, bucket, "_bn",
        (F.col("_all") if within else F.sum("_bn").over(in_group)).alias("_total"),
        (F.col("_start") + upto if within else upto).alias("_upto"),
    )
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    return ranked.select(
        *[F.col(k).alias(f"_m_{k}") for k in (*parts, bucket)], (F.col("_upto") - F.col("_bn")).alias("_before"), "_upto", "_total"
    ).where((F.col("_upto") >= low) & (F.col("_before") < high)).drop("_upto")


def _median_of_counts(counted: DataFrame, keys: list[str], median_name: str, count_name: str, within: str | None = None) -> DataFrame:
    """Medians of values (``_v``) that occur ``_n`` times in buckets ``_b``; with ``within`` of the values in the middle coarser buckets."""
    parts = [*keys, within] if within else keys
    place = (F.max("_start").alias("_start"), F.max("_all").alias("_all")) if within else ()
    middle = _middle_buckets(counted.groupBy(*parts, "_b").agg(F.sum("_n").alias("_bn"), *place), keys, "_b", within)
    in_bucket = Window.partitionBy(*parts, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.join(middle, _same([*parts, "_b"])).select(
        *keys, "_v", "_total",
        F.floor((F.col("_total") + 1) / 2).alias("_low"),
        F.floor((F.col("_total") + 2) / 2).alias("_high"),
        (F.col("_before") + F.sum("_n").over(in_bucket)).alias("_rank"),
    )
    return placed.groupBy(*keys).agg(
        (
            (
                F.min(F.when(F.col("_rank") >= F.col("_low"), F.col("_v")))
                + F.min(F.when(F.col("_rank") >= F.col("_high"), F.col("_v")))
            )
            / 2
        ).alias(median_name),
        F.max("_total").alias(count_name),
    )


def approximate_median(c: Column) -> Column:
    """Median from a bounded, mergeable sketch; always one of the group's values."""
    return F.percentile_approx(c, 0.5, 10_000)
