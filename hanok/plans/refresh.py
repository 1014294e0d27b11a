"""Jobs: load the raw table, keep it and the marts up to date, publish the boards."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from hanok.operators import ledger
from hanok.operators.changes import PARTITION_KEYS
from hanok.operators.quality import partition_entries
from hanok.plans import boards, landing, monthly, price_change
from hanok.plans.catalog import DatasetCatalog
from hanok.schema import RAW_PARTITION_COLUMNS, RAW_SCHEMA
from hanok.sinks import lake
from hanok.sources import bronze, files

RAW_TABLE = "apt_trade_raw"


def full_load(
    spark: SparkSession, bronze_path: str, table: str = RAW_TABLE, location: str | None = None,
    recreate: bool = False, append: bool = False, table_format: str = lake.PARQUET, header: Sequence[str] | None = None,
) -> None:
    """Load the whole landing zone. Partitions are replaced, so a second run adds nothing; ``append`` adds.

    ``header`` saves one reading of the files where all are known to have it.
    """
    lake.create_table(spark, table, RAW_SCHEMA, RAW_PARTITION_COLUMNS, location, recreate, table_format)
    rows = bronze.scan_all(spark, bronze_path, header)
    if append:
        lake.append(rows, table, RAW_PARTITION_COLUMNS, table_format)
    else:
        lake.replace_partitions(rows, table, RAW_PARTITION_COLUMNS, table_format)


def load_partitions(
    spark: SparkSession, bronze_path: str, entries: DataFrame, table: str = RAW_TABLE,
    location: str | None = None, table_format: str = lake.PARQUET,
) -> None:
    """Replace the listed (lawd_cd, deal_ym) partitions with their landed pages; others stay."""
    lake.create_table(spark, table, RAW_SCHEMA, RAW_PARTITION_COLUMNS, location, False, table_format)
    lake.replace_partitions(bronze.scan_partitions(spark, bronze_path, entries), table, RAW_PARTITION_COLUMNS, table_format)


def reflect_pages(spark: SparkSession, entries: DataFrame, pages: str, table: str = RAW_TABLE, table_format: str = lake.PARQUET) -> list[str]:
    """Replace the listed (lawd_cd, deal_ym) partitions of the raw table by what the page table holds of them; the months, as codes.

    Partitions without a landed row are dropped. Running it again changes nothing.
    """
    lake.create_table(spark, table, RAW_SCHEMA, RAW_PARTITION_COLUMNS, None, False, table_format)
    months = set()
    for group in landing.in_groups(entries.select(*PARTITION_KEYS).distinct()):
        keys = [(r.lawd_cd, r.deal_ym) for r in group]
        months |= {ym for _, ym in keys}
        chosen = lake.partition_filter(PARTITION_KEYS, keys)
        source = F.concat(F.lit(f"{pages}/LAWD_CD="), "lawd_cd", F.lit("/DEAL_YM="), "deal_ym", F.lit("/page="), "page_no", F.lit(".csv"))
        rows = spark.table(pages).where(chosen)
        filled = {(r.lawd_cd, r.deal_ym) for r in rows.select(*PARTITION_KEYS).distinct().collect()}
        # A partition of pages is one of the raw table.
        lake.replace_partitions(bronze.to_raw_table(rows.withColumn("_file", source)), table, RAW_PARTITION_COLUMNS, table_format, gathered=True)
        gone = [{"year": int(ym[:4]), "month": int(ym[4:]), "lawdCd": code} for code, ym in keys if (code, ym) not in filled]
        lake.drop_partitions(spark, table, gone, table_format)
    return sorted(months)


def incremental_load(
    spark: SparkSession, bronze_path: str | None, manifest_path: str, table: str = RAW_TABLE,
    location: str | None = None, table_format: str = lake.PARQUET, pages: str | None = None,
) -> bool:
    """Reflect one run's manifest into the raw table, from the page table ``pages`` or the landing zone; False where there is nothing to do."""
    if not bronze.existing(spark, [manifest_path]):
        return False
    entries = partition_entries(files.read_manifest(spark, manifest_path))
    if entries.isEmpty():
        return False
    if pages is not None:
        reflect_pages(spark, entries, pages, table, table_format)
    else:
        load_partitions(spark, bronze_path, entries, table, location, table_format)
    return True


def daily_sync(
    spark: SparkSession, answers: DataFrame, database: str, pages: str = landing.PAGE_TABLE, markers: str = landing.MARKER_TABLE,
    table: str = RAW_TABLE, run: landing.Run | None = None, table_format: str = lake.PARQUET,
) -> list[str]:
    """Land a run's answers, reflect the changed partitions into the raw table, and bring the marts of their months up to date."""
    run = run or landing.Run()
    landing.land_answers(spark, answers, pages, markers, table_format=table_format, run=run)
    months = reflect_pages(spark, ledger.changed_in(spark.table(landing.run_table(pages)), run.run_id), pages, table, table_format)
    monthly.update_marts(spark, table, database, months, table_format)
    return months


build_marts = monthly.build_marts
MART_TABLES = ("region_monthly_stats", "complex_monthly_median", "region_last12m", "complex_bucket_12m", "region_names", "price_sketches")


def board_catalog(sources: dict[str, DataFrame]) -> DatasetCatalog:
    """All boards over the mart tables."""
    catalog = DatasetCatalog(sources)
    catalog.define("region_decision_monthly", ("region_monthly_stats", "region_names"), boards.region_decision_monthly)
    catalog.define("region_decision_latest", ("region_decision_monthly", "region_monthly_stats"), boards.region_decision_latest)
    catalog.define("national_signal_trend", ("region_decision_monthly",), boards.national_signal_trend)
    catalog.define("national_monthly_price", ("region_monthly_stats",), boards.national_monthly_price)
    catalog.define("national_price_quantiles", ("price_sketches",), lambda s: boards.price_quantiles(s, "deal_month_date"))
    catalog.define("monthly_trades", ("region_monthly_stats",), boards.monthly_trades)
    catalog.define("latest_month_trades", ("region_monthly_stats",), boards.latest_month_trades)
    catalog.define("region_last12_named", ("region_last12m", "region_names"), boards.region_last12_named)
    catalog.define(
        "complex_premium_latest", ("complex_monthly_median", "region_monthly_stats", "region_names"), boards.complex_premium_latest
    )
    catalog.define("complex_gap_12m", ("complex_bucket_12m", "region_last12m", "region_names"), boards.complex_gap_12m)
    return catalog


def price_change_catalog(sources: dict[str, DataFrame], start: str, end: str) -> DatasetCatalog:
    """The price change datasets of a period over typed trade history and the complexes."""
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    both = ("trade_history", "complexes")
    catalog = DatasetCatalog(sources)
    catalog.define("price_change", both, lambda trades, complexes: price_change.price_changes(trades, complexes, first, last))
    catalog.define("price_change_map", ("price_change",), price_change.map_layer)
    catalog.define("price_change_kpi", ("price_change",), price_change.kpi)
    catalog.define("price_change_extremes", ("price_change",), price_change.top_bottom)
    catalog.define("price_change_frames", both, lambda trades, complexes: price_change.price_change_frames(trades, complexes, first, last))
    catalog.define("price_change_frame_layers", ("price_change_frames",), price_change.frame_layers)
    catalog.define("avg_price_by_date", ("trade_history",), price_change.avg_price_by_date)
    return catalog


def publish_boards(spark: SparkSession, database: str) -> DatasetCatalog:
    """Views of all boards over the written marts."""
    catalog = board_catalog({name: spark.table(f"{database}.{name}") for name in MART_TABLES})
    catalog.publish_views()
    return catalog


def write_boards(spark: SparkSession, database: str, table_format: str = lake.PARQUET) -> list[str]:
    """Write every board, replaced at once for its readers. A board that others refer to is read back, not computed again."""
    return _write_all(spark, database, MART_TABLES, board_catalog, table_format)


def write_price_changes(spark: SparkSession, database: str, start: str, end: str, table_format: str = lake.PARQUET) -> list[str]:
    """Write the price change datasets of a period from the tables ``trade_history`` and ``complexes``."""
    return _write_all(spark, database, ("trade_history", "complexes"), lambda s: price_change_catalog(s, start, end), table_format)


def _write_all(
    spark: SparkSession, database: str, inputs: Sequence[str], catalog: Callable[[dict[str, DataFrame]], DatasetCatalog], table_format: str
) -> list[str]:
    sources = {name: spark.table(f"{database}.{name}") for name in inputs}
    written: list[str] = []
    for name in catalog(sources).names():
        # Definitions stand in dependency order; what is written becomes a source of the rest.
        lake.publish(catalog(sources).get(name), f"{database}.{name}", table_format=table_format)
        sources[name] = spark.table(f"{database}.{name}")
        written.append(name)
    return written
