"""SimHash near-duplicates through segment bit counts.

A fingerprint's 64 bits form 32 segments of two bits. The bit counts of the segments are a point of a grid, and the
Manhattan distance of two points never exceeds the bit distance of the fingerprints. Fingerprints within three bits
are within one step in the first or in the second 16 segments, so each point looks at its own cell and the next ones
of both halves; what meets there is compared by all 32 counts and then by the bits themselves.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from hanok.llm.components import components
from hanok.llm.shared import as_bytes, map_batches, written

SEED = 42
BLOCK = 1 << 16  # shingles hashed at a time
LOW = 0x5555555555555555  # the lower bit of every segment


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the eight bytes of a hash in one count table, and the bits of each byte value."""
    bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
    return np.arange(8, dtype=np.int64) * 256, bits


def fingerprint(text: bytes, size: int, tables: tuple[np.ndarray, np.ndarray]) -> int:
    """The unsigned fingerprint of a text in UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(size, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    offsets, bits = tables
    ones = np.zeros((8, 8))
    for at in range(0, len(starts), BLOCK):
        shingles = [joined[a:b] for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.dtype("<u8"), len(shingles))
        spread = hashes.view(np.uint8).reshape(-1, 8) + offsets
        ones += np.einsum("jv,vb->jb", np.bincount(spread.ravel(), minlength=2048).reshape(8, 256).astype(np.float64), bits, optimize=True)
    return int(np.packbits((2 * ones > len(starts)).ravel(), bitorder="little").view("<u8")[0])


def _prints(docs: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, fp); ``key`` tells texts with one doc_id apart."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        tables = _tables()
        found = np.array([fingerprint(x, shingle, tables) for x in as_bytes(batch.column(2))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "key", "fp"])

    return map_batches(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text")), "doc_id long, key long, fp long", rows)


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long; null and wordless texts have zero."""
    return _prints(docs, shingle, doc_id, text).select("doc_id", "fp")


def embedding(fp: Column) -> Column:
    """Counts of the 32 segments in unary (00, 01, 11): bits that differ between two are their Manhattan distance."""
    up = F.shiftrightunsigned(fp, 1)
    any_set, both_set = fp.bitwiseOR(up).bitwiseAND(F.lit(LOW)), fp.bitwiseAND(up).bitwiseAND(F.lit(LOW))
    return any_set.bitwiseOR(F.shiftleft(both_set, 1))


def _steps(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and cells at Manhattan distance one of 16 unary counts each."""
    rows, out = [], []
    for at in range(0, 32, 2):
        low, high = (cells >> at) & 1, (cells >> (at + 1)) & 1
        for where, changed in ((low == 0, 1 << at), ((low == 1) & (high == 0), 1 << at), ((low == 1) & (high == 0), 2 << at), (high == 1, 2 << at)):
            found = np.flatnonzero(where)
            rows.append(found)
            out.append(cells[found] ^ changed)
    return np.concatenate(rows), np.concatenate(out)


def cells(points: DataFrame, neighbours: bool) -> DataFrame:
    """(cell, fp, point) for both halves of every point of (fp, point): its own cells and, if asked, those one step away."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp, point = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        which, keys = [], []
        for half in (0, 1):
            own = (point.view(np.uint64) >> np.uint64(32 * half)).astype(np.int64) & 0xFFFFFFFF
            near = _steps(own) if neighbours else (np.empty(0, np.int64),) * 2
            which += [np.arange(len(own)), near[0]]
            keys += [own + (half << 32), near[1] + (half << 32)]
        at = np.concatenate(which)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp[at]), pa.array(point[at])], names=["cell", "fp", "point"])

    return map_batches(points.select("fp", "point"), "cell long, fp long, point long", rows)


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b) with a < b: every pair of different values of ``prints`` (fp) within ``max_bits`` bits, once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("one step in a half covers up to three bits")
    points = prints.select("fp").distinct().withColumn("point", embedding(F.col("fp")))
    home = cells(points, neighbours=False).select("cell", F.col("fp").alias("b"), F.col("point").alias("b_point"))
    near = cells(points, neighbours=True).select("cell", F.col("fp").alias("a"), F.col("point").alias("a_point"))
    close = (
        (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a_point").bitwiseXOR(F.col("b_point"))) <= max_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    return near.join(home, "cell").where(close).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    Documents with equal fingerprints meet in one row before anything else, so copies cost nothing further. A row
    without doc_id has a fingerprint and no component, and links nothing. Repeated rows stay repeated. doc_id is an integer; texts of
    any length are read whole.
    """
    prints = written(fingerprints(docs, shingle, doc_id, text), "simhash")
    first = written(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-first")
    pairs = links(first, max_bits)
    pairs = pairs.join(first.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(
        first.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b"
    )
    found = components(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")), "simhash-links")
    classes = written(
        first.join(found, first["first"] == found["node"], "left").select("fp", F.coalesce("component", "first").alias("component_id")),
        "simhash-classes",
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return prints.join(classes, "fp", "left").select("doc_id", "fp", component.alias("component_id"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Of each component of fingerprints the document with the smallest doc_id; rows without doc_id stay as they are.

    A doc_id may stand for several texts: each belongs to its own component, and every component keeps one row.
    """
    prints = written(_prints(docs.where("doc_id IS NOT NULL"), shingle, "doc_id", "text"), "simhash")
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min_by("key", F.struct("doc_id", "key")).alias("key")), "simhash-first")
    found = components(links(first, max_bits), "simhash-links")
    classes = first.join(found, first["fp"] == found["node"], "left").groupBy(F.coalesce("component", "fp").alias("component"))
    chosen = classes.agg(F.min("doc_id").alias("kept_id"), F.min_by("key", F.struct("doc_id", "key")).alias("kept_key")).drop("component")
    key = F.xxhash64("text")
    named = docs.where("doc_id IS NOT NULL")
    named = named.join(chosen, (named["doc_id"].cast("long") == chosen["kept_id"]) & (F.xxhash64(named["text"]) == chosen["kept_key"]), "left_semi")
    order = F.row_number().over(Window.partitionBy("doc_id", key).orderBy("text"))
    named = named.select(F.struct("*").alias("row"), order.alias("nth")).where("nth = 1").select("row.*")
    return named.unionByName(docs.where("doc_id IS NULL"))
