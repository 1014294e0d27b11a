"""Benchmark passages in documents, by a set join with a prefix filter.

Every item is cut into windows of ten words; a window is the set of its three-word shingles with their places. A document
holds a window exactly only if it holds the window's rarest shingle, so that one shingle is the necessary prefix: its places
in a document are the candidates. A candidate is dropped where the window would not fit between the document's ends, and
the rest is compared word by word. Rarity is counted over all documents.

A benchmark of up to ``INDEX_WINDOWS`` windows and ``INDEX_BYTES`` goes to the tasks as an index. Of a larger one only Bloom filters do,
which have a set size; documents' shingles that pass meet the windows' prefixes in a shuffle join, with the words around them.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from hanok.llm.shared import as_bytes, map_batches, written

WINDOW = 10
SHINGLE = 3
INDEX_WINDOWS = 200_000  # windows that are held as an index in every task; their words are numbered in 21 bits
INDEX_BYTES = 32 << 20
BLOOM_BITS = 1 << 27  # of a filter at most, 16 MB
SALTS = 8  # tasks that share the places of one prefix

# What counts as part of a word: digits, a-z, and every byte of a character beyond ASCII. A-Z become a-z.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, window): the distinct windows of every item, words joined by blanks. Wordless items have none."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, found = [], []
        for item, x in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            w = words(x)
            own = {b" ".join(w[i : i + WINDOW]) for i in range(max(1, len(w) - WINDOW + 1))} if w else ()
            items += [item] * len(own)
            found += own
        return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(found, pa.binary())], names=["item_id", "win"])

    return map_batches(benchmark.select(F.col(item_id).cast("string"), F.col(text)), "item_id string, win binary", rows).distinct()


def small(found: DataFrame, most: int = INDEX_WINDOWS) -> list[tuple[str | None, bytes]] | None:
    """The windows of ``found`` in order, if they are few enough for an index."""
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("win")), F.lit(0))).first()
    if n > most or size > INDEX_BYTES:
        return None
    return sorted(((r[0], bytes(r[1])) for r in found.collect()), key=lambda x: (x[1], x[0] is None, x[0] or ""))


class Index:
    """Windows by their words, ready to be looked up in documents."""

    def __init__(self, pairs: list[tuple[str | None, bytes]]):
        self.items: list[list[str]] = []
        texts: list[bytes] = []
        for item, window in pairs:
            if not texts or texts[-1] != window:
                texts.append(window)
                self.items.append([])
            if item is not None:
                self.items[-1].append(item)
        split = [x.split(b" ") for x in texts]
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for x in split for w in x}))}
        if len(self.number) >= 1 << 21:
            raise ValueError("the windows have more different words than fit in 21 bits")
        self.lengths = np.array([len(x) for x in split], np.int64)
        self.matrix = np.zeros((len(split), WINDOW), np.int64)
        for i, x in enumerate(split):
            self.matrix[i, : len(x)] = [self.number[w] for w in x]
        # shingle at each place of each window; windows of fewer words have one shorter shingle
        self.sizes = sorted({min(SHINGLE, n) for n in self.lengths.tolist()})
        self.at = np.full((len(split), WINDOW), -1, np.int64)
        for size in self.sizes:
            own = np.flatnonzero(np.minimum(self.lengths, SHINGLE) == size)
            for place in range(WINDOW - size + 1):
                fits = own[self.lengths[own] >= place + size]
                self.at[fits, place] = keys(self.matrix[fits], place, size)
        self.shingles = np.unique(self.at[self.at >= 0])
        self.places = np.empty((0, 3), np.int64)

    def order(self, counts: np.ndarray) -> None:
        """Choose each window's rarest shingle; ``counts`` go with ``shingles``."""
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((self.shingles, counts))] = np.arange(len(counts))
        ranks = np.where(self.at >= 0, rank[np.searchsorted(self.shingles, np.maximum(self.at, self.shingles[0]))] if len(rank) else 0, np.iinfo(np.int64).max)
        place = ranks.argmin(axis=1)
        prefix = self.at[np.arange(len(place)), place]
        by = np.argsort(prefix, kind="stable")
        self.prefixes, self.first, self.count = np.unique(prefix[by], return_index=True, return_counts=True)
        self.window, self.place = by, place[by]

    def numbers(self, found: list[bytes]) -> np.ndarray:
        """The numbers of words; 0 for a word that no window has."""
        return np.fromiter(map(self.number.get, found, repeat(0)), np.int64, len(found))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every occurrence."""
        n, starts, found = len(numbers), [], []
        for size in self.sizes:
            at, key = shingles(numbers, size)
            if not len(at):
                continue
            slot = np.minimum(np.searchsorted(self.prefixes, key), len(self.prefixes) - 1)
            same = self.prefixes[slot] == key
            at, slot = at[same], slot[same]
            times = self.count[slot]
            entry = np.repeat(self.first[slot] - np.cumsum(times) + times, times) + np.arange(times.sum())
            start, window = np.repeat(at, times) - self.place[entry], self.window[entry]
            fits = (start >= 0) & (start + self.lengths[window] <= n)  # places between the document's ends
            start, window = start[fits], window[fits]
            equal = np.ones(len(start), bool)
            for i in range(WINDOW):  # word by word
                inside = i < self.lengths[window]
                equal &= ~inside | (numbers[np.minimum(start + i, n - 1)] == self.matrix[window, i])
            starts.append(start[equal])
            found.append(window[equal])
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts), np.concatenate(found)


def keys(matrix: np.ndarray, place: int, size: int) -> np.ndarray:
    key = matrix[:, place]
    for i in range(1, size):
        key = key << 21 | matrix[:, place + i]
    return key << 21 * (SHINGLE - size)


def shingles(numbers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the shingles whose words all are in the index."""
    whole = numbers[: max(0, len(numbers) - size + 1)] > 0
    for i in range(1, size):
        whole = whole & (numbers[i : i + len(whole)] > 0)
    at = np.flatnonzero(whole)
    key = numbers[at]
    for i in range(1, size):
        key = key << 21 | numbers[at + i]
    return at, key << 21 * (SHINGLE - size)


def _counted(docs: DataFrame, index: Index) -> np.ndarray:
    """How often each shingle of the index occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        total = np.zeros(len(index.shingles), np.int64)
        for batch in batches:
            for x in as_bytes(batch.column(0)):
                numbers = index.numbers(words(x))
                for size in index.sizes:
                    key = shingles(numbers, size)[1]
                    slot = np.minimum(np.searchsorted(index.shingles, key), len(index.shingles) - 1)
                    np.add.at(total, slot[index.shingles[slot] == key], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["shingle", "n"])

    counts = np.zeros(len(index.shingles), np.int64)
    if len(counts):
        for shingle, n in docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n")).collect():
            counts[shingle] = n
    return counts


def index(docs: DataFrame, pairs: list[tuple[str | None, bytes]]) -> Index:
    """The windows, their shingles ordered by how rare they are in ``docs`` (text)."""
    made = Index(pairs)
    made.order(_counted(docs, made))
    return made


# A benchmark too large for an index


def _shingle_keys(found: list[bytes], size: int, known: dict[bytes, int]) -> np.ndarray:
    """A 64-bit key of every run of ``size`` words; ``known`` remembers words' hashes."""
    hashes = np.empty(len(found), np.uint64)
    for i, w in enumerate(found):
        h = known.get(w)
        if h is None:
            if len(known) > 1 << 18:
                known.clear()
            h = known[w] = xxhash.xxh64_intdigest(w)
        hashes[i] = h
    n = max(0, len(found) - size + 1)
    key = np.full(n, size, np.uint64)
    for i in range(size):
        key = (key ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key in a filter of 2 ** ``bits``."""
    shift = np.uint64(64 - bits)
    return ((keys * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64), (((keys ^ (keys >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> shift).astype(np.int64)


def _bloom(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A filter of the column ``key``, as bytes of 8 bits, and its size as a power of two, ``BLOOM_BITS`` at most."""
    bits = max(10, min(BLOOM_BITS.bit_length() - 1, (16 * keys.count()).bit_length()))

    def run(batches):
        own = np.zeros(1 << bits, bool)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                own[at] = True
        packed = np.packbits(own).view(np.int64)
        (word,) = np.nonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(packed[word])], names=["word", "mask"])

    found = keys.select("key").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << bits >> 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return out.view(np.uint8), bits


def _passing(keys: np.ndarray, bloom: tuple[np.ndarray, int]) -> np.ndarray:
    """Whether the filter may hold each key."""
    held, bits = bloom
    own = np.ones(len(keys), bool)
    for at in _places(keys, bits):
        own &= (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return own


def _prefixes(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(key, win, place): each window's rarest shingle; windows of which no document can have a shingle are left out."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, win, place, known = [], [], [], {}
        for x in as_bytes(batch.column(0)):
            w = x.split(b" ")
            own = _shingle_keys(w, min(SHINGLE, len(w)), known)
            key.append(own)
            win += [x] * len(own)
            place += range(len(own))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([*key, np.empty(0, np.uint64)]).view(np.int64)), pa.array(win, pa.binary()), pa.array(place, pa.int32())], names=["key", "win", "place"])

    cuts = written(map_batches(wins, "key long, win binary, place int", cut), "shingles")
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(cuts))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, known = [np.empty(0, np.uint64)], {}
        for x in as_bytes(batch.column(0)):
            w = words(x)
            for size in range(1, SHINGLE + 1):
                key = _shingle_keys(w, size, known)
                found.append(key[_passing(key, shared.value)])
        key, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    counts = map_batches(docs.select("text"), "key long, n long", count).groupBy("key").agg(F.sum("n").alias("n"))
    rarest = cuts.join(counts, "key", "left").groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "place")).alias("least"))
    return written(rarest.where("least.n > 0").select("least.key", "win", "least.place"), "prefixes")


def _joined_hits(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(text_key, start, win): every occurrence of a window in a text of ``docs`` (text_key, text)."""
    prefixes = _prefixes(docs, wins)
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(prefixes))

    def candidates(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, rows, known = [], [], {}
        for text_key, x in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            w = words(x)
            for size in range(1, SHINGLE + 1):
                key = _shingle_keys(w, size, known)
                for at in np.flatnonzero(_passing(key, shared.value)).tolist():
                    first = max(0, at + size - WINDOW)
                    keys.append(key[at])
                    rows.append((text_key, at, at - first, b" ".join(w[first : at + WINDOW])))
        text_key, at, before, around = zip(*rows) if rows else ((), (), (), ())
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), *map(pa.array, (text_key, at, before, around), kinds)], names=["key", "text_key", "at", "before", "around"])

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        text_key, at, before, around, win, place = (batch.column(c).to_pylist() for c in ("text_key", "at", "before", "around", "win", "place"))
        rows = []
        for t, a, b, x, y, p in zip(text_key, at, before, around, win, place):
            have, want = x.split(b" "), y.split(b" ")
            if b >= p and have[b - p : b - p + len(want)] == want:
                rows.append((t, a - p, y))
        t, a, y = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(a, pa.int64()), pa.array(y, pa.binary())], names=["text_key", "start", "win"])

    found = map_batches(docs.select("text_key", "text"), "key long, text_key string, at long, before int, around binary", candidates)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("text_key", "at"), F.lit(SALTS)).cast("int"))
    spread = prefixes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return map_batches(salted.join(spread, ["key", "salt"]), "text_key string, start long, win binary", verify)


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _merged(spans: list[tuple[int, int]]) -> int:
    """Words covered by spans, overlaps once."""
    total, end = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def _by_index(docs: DataFrame, pairs: list[tuple[str | None, bytes]], out: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index(docs, pairs))

    def found(x: bytes, index: Index) -> tuple[int, list, set]:
        w = words(x)
        starts, hit = index.hits(index.numbers(w)) if len(index.lengths) else (np.empty(0, np.int64),) * 2
        spans = list(zip(starts.tolist(), (starts + index.lengths[hit]).tolist()))
        return len(w), spans, {i for h in np.unique(hit).tolist() for i in index.items[h]}

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [found(x, shared.value) for x in as_bytes(batch.column(1))]
        hit = [_merged(s) for _, s, _ in rows]
        columns = [[n for n, _, _ in rows], hit, [len(i) for _, _, i in rows], [_digest(i) for _, _, i in rows], [h > 0 for h in hit]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return map_batches(docs, out, whole)


def _by_join(docs: DataFrame, found: DataFrame, out: str) -> DataFrame:
    keyed = docs.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    hits = written(_joined_hits(keyed, found.select("win").distinct()).distinct(), "hits")
    size = F.size(F.split(F.col("win").cast("string"), " "))
    spans = hits.groupBy("text_key").agg(F.collect_set(F.struct("start", (F.col("start") + size).alias("end"))).alias("spans"))
    items = hits.select("text_key", "win").distinct().join(found.where("item_id IS NOT NULL"), "win").groupBy("text_key").agg(F.collect_set("item_id").alias("items"))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [len(words(x)) for x in as_bytes(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["doc_id", "text_key", "n_words"])

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = [_merged([(s["start"], s["end"]) for s in x or ()]) for x in batch.column(2).to_pylist()]
        items = [set(x or ()) for x in batch.column(3).to_pylist()]
        columns = [hit, [len(i) for i in items], [_digest(i) for i in items], [h > 0 for h in hit]]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns, kinds)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    sizes = map_batches(keyed, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key string, n_words long", counted)
    both = sizes.join(spans, "text_key", "left").join(items, "text_key", "left")
    return map_batches(both.select("doc_id", "n_words", "spans", "items"), out, rows)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """One row per document: n_words, n_hit (words inside an occurring window), n_items, items_sha256, contaminated.

    An item's windows are all its runs of ten words, or all its words if fewer. Null texts have no words. Windows of an item
    without item_id hit words but count as no item; items with the same item_id are one. Repeated documents stay repeated. Texts of any
    length are searched whole. A benchmark of more than ``index_windows`` windows is joined, with the same rows.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    found = written(windows(benchmark), "windows")
    pairs = small(found, index_windows)
    return _by_join(docs, found, out) if pairs is None else _by_index(docs, pairs, out)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """The rows of ``docs`` (text and whatever else) in which no window occurs, unchanged."""
    found = written(windows(benchmark), "windows")
    pairs = small(found, index_windows)
    if pairs is None:
        text_key = F.sha2(F.coalesce("text", F.lit("")), 256)
        hit = _joined_hits(docs.select(text_key.alias("text_key"), "text"), found.select("win").distinct()).select(F.col("text_key").alias("__hit")).distinct()
        return docs.join(hit, text_key == F.col("__hit"), "left_anti")
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(index(docs, pairs))

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = shared.value
        keep = [not len(index.lengths) or not len(index.hits(index.numbers(words(x)))[0]) for x in as_bytes(batch.column(at))]
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, docs.schema, clean)
