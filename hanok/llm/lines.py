"""Lines that many documents repeat, dropped from all of them but the last.

Every distinct line has a 128-bit hash. The hashes are dealt to shards; each shard gets a minimal perfect hash (levels of bits, a key
sits on the first level where it alone has its slot), which numbers its keys without holes. By that number lie a 32-bit fingerprint and
the count of documents; for frequent lines also the greatest doc_id. Documents send their line hashes to the shards, which look them up
in the arrays; no line text is ever joined or shuffled.

Shards hold a set number of hashes, so their number grows with the table. A line of very many documents would send them all to one shard:
lines of at least one in ``HOT_SHARE`` look-ups, at most that many, go to every task instead and are settled where the text is.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from hanok.llm.shared import as_bytes, map_batches, written

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 13  # hashes that a shard gets on average
HOT_SHARE = 100_000  # lines with at least 1 / HOT_SHARE of all look-ups go to every task: 24 bytes each
HOT_LEAST = 1000
BUFFER = 1 << 18  # hashes that a task sums up at a time
BLANKS = b" \t\n\v\f\r"
NO_ID = -(1 << 63)  # stands for a null doc_id, below all others
_CONTINUED = bytes(range(0x80, 0xC0))
_STEP, _A, _B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of the line's key (blanks stripped at both ends, A-Z lower-cased); None where the key has fewer code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.translate(None, _CONTINUED)) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _slots(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    """Each key's slot on a level, from all of its 128 bits."""
    x = high + np.uint64((level + 1) * _STEP % (1 << 64))
    x = ((x ^ (x >> np.uint64(30))) * np.uint64(_A)) ^ low
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_B)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys, about four bits a key; other keys get any number or -1."""

    def __init__(self, bits: np.ndarray, sizes: list[int]):
        self.bits, self.sizes, self.ranks = bits, sizes, np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            size = -(-2 * len(high) // 64) * 64
            slots = _slots(high, low, len(levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            left = ~alone[slots]
            high, low = high[left], low[left]
        return cls(np.concatenate(levels) if levels else np.empty(0, bool), [len(x) for x in levels])

    def places(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found, left, start = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            slots = start + _slots(high[left], low[left], level, size)
            hit = self.bits[slots]
            found[left[hit]] = self.ranks[slots[hit]]
            left, start = left[~hit], start + size
        return found


def _summed(high: np.ndarray, low: np.ndarray, ids: np.ndarray, looks: np.ndarray, keep: int):
    """Per distinct hash: high, low, its ``keep`` least different ids and the greatest (as offsets into a flat array), look-ups.

    Sums of sums are sums: whether a hash has ``keep`` different ids, and its greatest id, are exact however rows were grouped before.
    """
    order = np.lexsort((ids, low, high))
    high, low, ids, looks = high[order], low[order], ids[order], looks[order]
    new_key = np.ones(len(high), bool)
    new_key[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    total = np.add.reduceat(looks, np.flatnonzero(new_key)) if len(looks) else looks
    new = new_key.copy()
    new[1:] |= ids[1:] != ids[:-1]
    key = np.cumsum(new_key)[new] - 1
    first = np.flatnonzero(new_key[new])
    nth = np.arange(len(key)) - first[key]
    kept = (nth < keep) | np.append(key[1:] != key[:-1], True)[: len(key)]
    starts = np.append(0, np.cumsum(np.bincount(key[kept], minlength=len(first))))
    return high[new_key], low[new_key], ids[new][kept], starts, total


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, hashes): per row of ``docs`` (doc_id, row, text) the 16 bytes of each of its different keys."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [b"".join({h for x in text.split(b"\n") if (h := line_hash(x, min_chars))}) for text in as_bytes(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "row", "hashes"])

    return map_batches(docs.select("doc_id", "row", "text"), "doc_id long, row long, hashes binary", rows)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """high, low, doc_id and row of every hash of a batch of the line table."""
    hashes = [x or b"" for x in batch.column(2).to_pylist()]
    times = np.array([len(x) // 16 for x in hashes], np.int64)
    ids, row = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), times) for i in (0, 1))
    return *_halves(b"".join(hashes)), ids, row


def index(lines: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per shard: its perfect hash and the arrays behind it, and its lines with ``HOT_LEAST`` look-ups or more.

    Tasks first sum up their own hashes, so a shard gets a line at most once from each ``BUFFER``, with ``min_docs`` + 1 ids at most.
    """

    def sums(batches):
        held, size = [], 0

        def out():
            high, low, ids, looks = (np.concatenate(x) for x in zip(*held))
            high, low, ids, starts, looks = _summed(high, low, ids, looks, min_docs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((high % np.uint64(shards)).astype(np.int64)), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids)), pa.array(looks),
                ],
                names=["shard", "high", "low", "ids", "looks"],
            )

        for batch in batches:
            high, low, ids, _ = _flat(batch)
            for at in range(0, len(high), BUFFER):
                held.append((high[at : at + BUFFER], low[at : at + BUFFER], ids[at : at + BUFFER], np.ones(len(high[at : at + BUFFER]), np.int64)))
                size += len(held[-1][0])
                if size >= BUFFER:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        high, low, looks = (group.column(c).to_numpy() for c in ("high", "low", "looks"))
        ids = group.column("ids").chunk(0)
        times = np.diff(ids.offsets.to_numpy())
        first = np.zeros(int(times.sum()), np.int64)
        first[np.cumsum(times) - times] = looks  # a row's look-ups count once
        high, low, ids, starts, looks = _summed(np.repeat(high.view(np.uint64), times), np.repeat(low.view(np.uint64), times), ids.flatten().to_numpy(), first, min_docs)
        hashed = PerfectHash.build(high, low)
        place = hashed.places(high, low)
        prints, counts, last = np.empty(len(high), np.uint32), np.empty(len(high), np.uint8), np.empty(len(high), np.int64)
        prints[place], counts[place], last[place] = low.astype(np.uint32), np.minimum(np.diff(starts), min_docs), ids[starts[1:] - 1]
        hot = np.flatnonzero(looks >= HOT_LEAST)
        hot = hot[np.diff(starts)[hot] >= min_docs]
        lists = [high.view(np.int64)[hot], low.view(np.int64)[hot], ids[starts[1:] - 1][hot], looks[hot]]
        return pa.table({
            "shard": group.column("shard").slice(0, 1), "levels": pa.array([hashed.sizes], pa.list_(pa.int32())), "bits": pa.array([np.packbits(hashed.bits).tobytes()]),
            "prints": pa.array([prints.tobytes()]), "counts": pa.array([counts.tobytes()]), "last": pa.array([last[counts >= min_docs].tobytes()]),
            "hot": pa.array([[dict(zip(("high", "low", "last", "looks"), map(int, x))) for x in zip(*lists)]], pa.list_(pa.struct([(c, pa.int64()) for c in ("high", "low", "last", "looks")]))),
        })

    if not 0 < min_docs < 256:
        raise ValueError("counts are single bytes")
    pairs = lines.mapInArrow(sums, "shard long, high long, low long, ids array<long>, looks long")
    schema = "shard long, levels array<int>, bits binary, prints binary, counts binary, last binary, hot array<struct<high: long, low: long, last: long, looks: long>>"
    return pairs.groupBy("shard").applyInArrow(build, schema)


def look_up(shard: dict, high: np.ndarray, low: np.ndarray, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash belongs to a line of ``min_docs`` documents or more, and the greatest doc_id of those (else 0)."""
    bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(shard["levels"])).astype(bool)
    place = PerfectHash(bits, shard["levels"]).places(high, low)
    prints, counts, last = (np.frombuffer(shard[c], t) for c, t in (("prints", np.uint32), ("counts", np.uint8), ("last", np.int64)))
    frequent = counts >= min_docs
    found = place >= 0
    found[found] = (prints[place[found]] == low[found].astype(np.uint32)) & frequent[place[found]]
    holder = np.zeros(len(high), np.int64)
    holder[found] = last[(np.cumsum(frequent) - 1)[place[found]]]
    return found, holder


def repeated(lines: DataFrame, index: DataFrame, hot: dict[bytes, int], shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, hash): the lines that rows of the line table lose, without those in ``hot``."""

    hot_high = np.array([_halves(h)[0][0] for h in hot], np.uint64)

    def dealt(batch: pa.RecordBatch) -> pa.RecordBatch:
        high, low, ids, row = _flat(batch)
        open_ = ~np.isin(high, hot_high)
        for i in np.flatnonzero(~open_):
            open_[i] = np.array([high[i], low[i]]).tobytes() not in hot
        high, low, ids, row = high[open_], low[open_], ids[open_], row[open_]
        return pa.RecordBatch.from_arrays(
            [pa.array((high % np.uint64(shards)).astype(np.int64)), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(ids), pa.array(row)],
            names=["shard", "high", "low", "doc_id", "row"],
        )

    def probe(asked: pa.Table, shard: pa.Table) -> pa.Table:
        high, low = (asked.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        ids, row = (asked.column(c).to_numpy() for c in ("doc_id", "row"))
        lost = np.zeros(len(high), bool)
        if len(high) and shard.num_rows:
            lost, holder = look_up(shard.to_pylist()[0], high, low, min_docs)
            lost &= holder != ids
        hashes = np.column_stack([high[lost], low[lost]]).astype(np.uint64).tobytes()
        return pa.table({"doc_id": ids[lost], "row": row[lost], "hash": pa.array([hashes[i : i + 16] for i in range(0, len(hashes), 16)], pa.binary())})

    asked = map_batches(lines, "shard long, high long, low long, doc_id long, row long", dealt)
    return asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, "doc_id long, row long, hash binary")


def hot_lines(index: DataFrame, look_ups: int) -> dict[bytes, int]:
    """Hash and greatest doc_id of the lines with at least 1 / ``HOT_SHARE`` of all look-ups: at most ``HOT_SHARE``."""
    found = index.select(F.explode("hot").alias("h")).select("h.*").where(F.col("looks") * HOT_SHARE >= look_ups).collect()
    return {np.array([r["high"], r["low"]], np.int64).tobytes(): r["last"] for r in found}


def without_repeated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and kept, the text of the lines that stay, joined by line feeds.

    A line whose key (blanks stripped, A-Z lower-cased) has ``min_chars`` code points or more and occurs in ``min_docs`` documents or more
    goes from all of them but that with the greatest doc_id, however often a document holds it. A null or empty text is one empty line.
    Documents of one doc_id are one document to the count, and each keeps its lines where theirs is the greatest; repeated rows stay
    repeated. A null doc_id is below all others; doc_id is an integer. Texts of any length are cut whole, one at a time.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    lines = written(line_table(own, min_chars), "line-hashes")
    look_ups = (lines.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0) // 16
    shards = max(1, math.ceil(look_ups / SHARD_KEYS))
    arrays = written(index(lines, shards, min_docs), "line-index")
    hot = hot_lines(arrays, look_ups)
    lost = repeated(lines, arrays, hot, shards, min_docs).groupBy("doc_id", "row").agg(F.collect_set("hash").alias("lost"))
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        hot, kept, n_lines, n_dropped = shared.value, [], [], []
        for doc_id, text, lost in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
            lines, lost, stay = text.split(b"\n"), set(lost or ()), []
            for x in lines:
                h = line_hash(x, min_chars)
                if h is None or (h not in lost and hot.get(h, doc_id) == doc_id):
                    stay.append(x)
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        ids = pa.array([None if i == NO_ID else i for i in batch.column(0).to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([ids, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])

    joined = own.join(lost, ["doc_id", "row"], "left").select("doc_id", "text", "lost")
    return map_batches(joined, "doc_id long, n_lines long, n_dropped long, kept string", drop)
