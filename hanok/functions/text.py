"""Cleaning, lenient casts and small parsers on string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def first_filled(*options: Column) -> Column:
    """The first option holding text (blank counts as missing)."""
    return F.coalesce(*[blank_to_null(c) for c in options])


def _bare_number(c: Column) -> Column:
    return F.replace(F.trim(c), F.lit(","), F.lit(""))


def lenient_long(c: Column) -> Column:
    """Whole number from text such as ``' 120,000 '``; NULL where it is none, as for ``84.97``."""
    return _bare_number(c).try_cast("bigint")


def lenient_double(c: Column) -> Column:
    """Finite number from text with blanks and thousands commas; NULL where it is none."""
    bare = _bare_number(c)
    # Spark reads "84d", "nan" and "infinity" as numbers; they are none here.
    return F.when(bare.rlike(r"^[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]{1,3})?$"), F.nullif(F.abs(bare.try_cast("double")), F.lit(float("inf"))) * F.when(F.startswith(bare, F.lit("-")), -1.0).otherwise(1.0))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column, leaving the others as they are."""
    return df.select(
        [
            F.trim(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def try_cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``; absent columns and failed casts become typed NULLs."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def to_flag(c: Column, default: bool = False) -> Column:
    """Boolean from the usual spellings, ``default`` for anything else."""
    word = F.lower(F.trim(c))
    # The spellings that count.
    return (
        F.when(word.isin("1", "true", "yes", "y", "on"), F.lit(True))
        .when(word.isin("0", "false", "no", "n", "off"), F.lit(False))
        .otherwise(F.lit(default))
    )


def leading_digits(c: Column) -> Column:
    """The first run of digits in a text as a number (``'2024년'`` gives 2024)."""
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("int")


def table_references(sql_text: Column) -> Column:
    """Distinct ``catalog.schema.table`` names after FROM or JOIN, quotes removed, sorted.

    Comments and texts in quotation marks go first, so nothing in them counts. A part of a name is a plain word, or anything
    between backticks or double quotes.
    """
    code = F.regexp_replace(sql_text, r"--[^\n]*|(?s:/[*].*?[*]/)|'[^']*'", " ")
    word = '(?:[^\\W\\d]\\w*|`[^`]+`|"[^"]+")'
    names = F.regexp_extract_all(code, F.lit(f"(?i)(?:^|\\W)(?:from|join)\\s+({word}(?:[.]{word})*)"), F.lit(1))
    full = F.filter(names, lambda name: F.size(F.regexp_extract_all(name, F.lit(word), F.lit(0))) == 3)
    return F.array_sort(F.array_distinct(F.transform(full, lambda name: F.translate(name, '`"', ""))))


def uri_bucket(uri: Column) -> Column:
    """Bucket of an ``s3://`` or ``s3a://`` address."""
    return F.regexp_extract(uri, r"^s3a?://([^/]+)", 1)


def uri_key(uri: Column) -> Column:
    """Key of an ``s3://`` or ``s3a://`` address without the leading slash."""
    return F.regexp_extract(uri, r"^s3a?://[^/]+/+(.*)$", 1)


def bucket_path(uri: Column) -> Column:
    """``bucket/key``, or the bucket alone where the address has no key."""
    key = uri_key(uri)
    return F.when(key == "", uri_bucket(uri)).otherwise(F.concat_ws("/", uri_bucket(uri), key))


def dataset_root(path: Column) -> Column:
    """A path without its partition folders and file name pattern."""
    return F.regexp_replace(F.regexp_replace(path, r"/[A-Za-z_]+=.*$", ""), r"/+$", "")


def plain_etag(c: Column) -> Column:
    """The MD5 in an object tag; NULL for multipart tags and other lengths."""
    # A plain tag has 32 digits, a multipart one a hyphen.
    bare = F.regexp_replace(F.trim(c), r'^"+|"+$', "")
    return F.when((F.length(bare) == 32) & ~bare.contains("-"), bare)
