"""Row checks and normalisation on the way from text to typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hanok.functions import dates, text


def failed_columns(columns: Sequence[str], schema: T.StructType) -> Column:
    """Names of the columns whose value does not cast to its type."""
    kinds = {f.name: f.dataType for f in schema.fields}
    marks = [F.when(F.col(c).try_cast(kinds[c]).isNull(), F.lit(c)) for c in columns]
    return F.array_compact(F.array(*marks))


def flag_bad_rows(raw: DataFrame, columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """Add ``failed`` with the columns that reject a row; empty for a good one."""
    return raw.withColumn("failed", failed_columns(columns, schema))


def split_bad_rows(raw: DataFrame, columns: Sequence[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    flagged = flag_bad_rows(raw, columns, schema)
    return (
        flagged.where(F.size("failed") == 0).drop("failed"),
        flagged.where(F.size("failed") > 0),
    )


def typed_trades(raw: DataFrame, required: Sequence[str], schema: T.StructType) -> DataFrame:
    """Accepted rows cast to the trade schema, with the trade date put together."""
    good, _ = split_bad_rows(raw, required, schema)
    made = good.withColumn(
        "date",
        dates.padded_date(*[F.col(c).try_cast("bigint") for c in ("tradeYear", "tradeMonth", "tradeDate")]),
    )
    return text.try_cast_to(made, schema)


# Korean key, English keys and type of each normalised field.
NORMALISED_FIELDS = (
    ("거래금액(만원)", ("거래금액", "dealAmount"), "long"),
    ("건축년도", ("건축년도", "buildYear"), "long"),
    ("년", ("년", "dealYear"), "long"),
    ("월", ("월", "dealMonth"), "long"),
    ("일", ("일", "dealDay"), "long"),
    ("전용면적", ("전용면적", "exclusiveArea", "excluUseAr"), "double"),
    ("층", ("층", "floor"), "long"),
)


def normalise_rows(raw: DataFrame) -> DataFrame:
    """Trim all text and add the typed fields, from Korean or English keys."""
    trimmed = text.trim_strings(raw)
    present = set(trimmed.columns)
    out = {}
    for name, sources, kind in NORMALISED_FIELDS:
        options = [F.col(f"`{c}`").cast("string") for c in sources if c in present]
        filled = text.first_filled(*options) if options else F.lit(None).cast("string")
        out[name] = text.lenient_long(filled) if kind == "long" else text.lenient_double(filled)
    return trimmed.withColumns(out)


def usable_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose listed columns all hold text."""
    for c in columns:
        df = df.where(text.blank_to_null(F.col(c)).isNotNull())
    return df


def partition_entries(manifest: DataFrame) -> DataFrame:
    """Usable, distinct (lawd_cd, deal_ym) entries of run manifests."""
    exploded = manifest.select(F.explode("completed_partitions").alias("p")).select("p.lawd_cd", "p.deal_ym")
    return usable_pairs(exploded, ["lawd_cd", "deal_ym"]).distinct()


def code_list(df: DataFrame, candidates: Sequence[str] = ("LAWD_CD", "lawd_cd", "cortarNo")) -> DataFrame:
    """Distinct five-digit region codes from the first known column, sorted."""
    column = next((c for c in candidates if c in df.columns), None)
    if column is None:
        raise ValueError(f"none of the columns {list(candidates)} is present")
    code = F.substring(F.trim(F.col(column).cast("string")), 1, 5)
    return df.select(code.alias("lawd_cd")).where(F.col("lawd_cd") != "").distinct().orderBy("lawd_cd")


def code_list_in_file_order(df: DataFrame, order: str, candidates: Sequence[str] = ("lawd_cd", "lawdcode", "code", "cortarno")) -> DataFrame:
    """Distinct codes in order of first appearance; column names match in any case."""
    known = {c.lower(): c for c in reversed(df.columns)}
    column = next((known[c] for c in candidates if c in known), None)
    if column is None:
        raise ValueError(f"none of the columns {list(candidates)} is present")
    code = F.substring(F.trim(F.col(column).cast("string")), 1, 5).alias("lawd_cd")
    return (
        df.select(code, F.col(order).alias("_o")).where(F.col("lawd_cd") != "")
        .groupBy("lawd_cd").agg(F.min("_o").alias("_o"))
        .orderBy("_o", "lawd_cd").select("lawd_cd")
    )


def choose_codes(spark: SparkSession, named: Sequence[str] = (), code_table: DataFrame | None = None, region_table: DataFrame | None = None, order: str = "line") -> DataFrame:
    """Codes by precedence: those named, else a code table's, else those of a region table's ``cortarNo``."""
    if named:
        rows = [(i, c.strip()) for i, c in enumerate(named) if c.strip()]
        return code_list_in_file_order(spark.createDataFrame(rows, f"{order} INT, lawd_cd STRING"), order)
    if code_table is not None:
        return code_list_in_file_order(code_table, order, ("lawd_cd", "lawdcode", "code"))
    if region_table is not None:
        return code_list_in_file_order(region_table, order, ("cortarno",))
    raise ValueError("no codes, code table or region table given")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Frames with differing columns put together; absent columns become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
