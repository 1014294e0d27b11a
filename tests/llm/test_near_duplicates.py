"""SimHash, components and MinHash against brute force."""

import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from hanok.llm import components, minhash, simhash

MASK = (1 << 64) - 1


def brute_simhash(text, size=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def near_texts():
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        base = [r.choice(vocab) for _ in range(r.choice([150, 300, 600]))]
        for _ in range(r.randint(1, 12)):
            words = list(base)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = r.choice(vocab)
            rows.append((n, " ".join(words)))
            n += 1
    r.shuffle(rows)
    return rows


def test_near_duplicates_are_all_pairs_within_three_bits(spark):
    rows = near_texts() + [(1000, ""), (1001, None), (1002, " \t\n"), (1003, "One Two"), (1004, "one two"), (1003, "One Two"), (1005, "one  TWO"), (None, "one two"), (1006, "lng " * 90_000)]
    docs = spark.createDataFrame([(*x, 7) for x in rows], "doc_id LONG, text STRING, fp LONG")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = {}
    for i, t in rows:
        if i is not None:
            prints[i] = brute_simhash(t)
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
    want = union_find(ids, pairs)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.fp & MASK, r.component_id) == (prints[r.doc_id], want[r.doc_id])
    assert len(set(want.values())) < len(ids) - 20


def test_links_of_given_fingerprints(spark):
    r = random.Random(12)
    values = set()
    for _ in range(40):
        centre = r.getrandbits(64)
        for _ in range(8):
            v = centre
            for bit in r.sample(range(64), r.randint(0, 4)):
                v ^= 1 << bit
            values.add(v)
    values |= {0, MASK, 1, MASK >> 1, 7, 15}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp LONG")
    for most in (0, 1, 2, 3):
        want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & MASK).count("1") <= most}
        got = simhash.links(df, most).collect()
        assert len(got) == len(want) and {(x.a, x.b) for x in got} == want
    with pytest.raises(ValueError):
        simhash.links(df, 4)


def test_the_embedding_never_exceeds_the_bit_distance(spark):
    r = random.Random(13)
    rows = [(r.getrandbits(63), r.getrandbits(63)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a LONG, b LONG")
    far = F.bit_count(simhash.embedding(F.col("a")).bitwiseXOR(simhash.embedding(F.col("b"))))
    for x in df.select("a", "b", far.alias("d")).collect():
        count = lambda v: [(v >> s & 1) + (v >> (s + 1) & 1) for s in range(0, 64, 2)]
        want = sum(abs(p - q) for p, q in zip(count(x.a), count(x.b)))
        assert x.d == want <= bin(x.a ^ x.b).count("1")


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d", "x"), (3, "A b  c d", "y"), (9, "q r s t u v", "z"), (9, "q r s t u v", "z"), (None, "a b c d", "n"), (None, "a b c d", "n")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, copy STRING")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[2], rows[4], rows[5]], key=str)
    assert simhash.keep_one(docs.limit(0)).count() == 0 and simhash.near_duplicates(docs.limit(0)).count() == 0


def test_every_component_keeps_a_row_where_ids_repeat(spark):
    rows = [(1, "a b c d e"), (5, "a b c d e"), (5, "q r s t u v"), (7, "q r s t u v"), (7, "one two three four"), (7, "one two three four"), (9, "un deux trois"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    assert sorted(map(tuple, simhash.keep_one(docs).collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[6], rows[7]], key=str)


def test_components_of_chains_stars_and_none(spark):
    r = random.Random(14)
    pairs = [(i, i + 1) for i in range(0, 120)] + [(500, i) for i in range(501, 560)] + [(700, 701), (701, 700), (702, 702)]
    pairs += [(r.randrange(800, 900), r.randrange(800, 900)) for _ in range(60)]
    r.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a LONG, b LONG")
    got = components.components(df).collect()
    linked = [(a, b) for a, b in pairs if a != b]
    want = union_find({n for p in linked for n in p}, linked)
    assert {(x.node, x.component) for x in got} == set(want.items()) and len(got) == len(want)
    assert components.components(df.limit(0)).count() == 0


# MinHash


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_minhash(text):
    words = [w for w in __import__("re").split("[ \t\n\r\f\x0b]+", (text or "").lower()) if w]
    if not words:
        return ""
    bins = [None] * 256
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        h = signed(h)
        b = (h >> 56) + 128
        bins[b] = h if bins[b] is None else min(bins[b], h)
    mixed = lambda i, n: signed(xxhash.xxh64_intdigest(struct.pack("<i", n), xxhash.xxh64_intdigest(struct.pack("<i", i), 42)))
    full = []
    for i, v in enumerate(bins):
        t = 0
        while v is None:
            v = bins[(mixed(i, 1) % 256 + t * (mixed(i, 2) % 128 * 2 + 1)) % 256]
            t += 1
        full.append(v)
    return "".join(f"{v & 15:x}" for v in full)


def test_fingerprints_and_neighbours(spark):
    r = random.Random(15)
    say = lambda n: " ".join(f"w{r.randrange(3000)}" for _ in range(n))
    texts = [say(r.choice([1, 2, 4, 5, 6, 30, 300])) for _ in range(60)] + ["", "  ", "É x y z", "one\ttwo  three"]
    rows = [(i * 7, t) for i, t in enumerate(texts)] + [(9000, None), (9001, "tail " * 30_000), (9002, texts[5]), (9002, texts[5])]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id LONG, text STRING, prints INT")
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (-x[0], x[1]))
    want = []
    for (i, t), (_, follows) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + follows[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), brute_minhash(t), brute_minhash(edited)))
    for edges in (1, 3, 4096):
        got = minhash.compare_with_edited(docs, edges).collect()
        assert sorted(tuple(x)[:5] for x in got) == sorted(want)
        assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in got)


def test_rows_of_one_doc_id_come_in_many_ranges(spark):
    r = random.Random(3)
    rows = [(7 if r.random() < 0.9 else r.randrange(20), f"{r.randrange(10**9):09} text") for _ in range(3000)] + [(None, f"{i:05} none") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(6)
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = sorted(((i, t, n) for (i, t), (_, n) in zip(order, order[1:] + order[:1])), key=str)
    for ranges in (None, 40, 100_000):
        found = minhash.with_next(docs, ["text"], ranges)
        assert sorted(map(tuple, found.collect()), key=str) == want
    edges = minhash._edges(docs, 100).collect()
    assert sum(e.place.id == ~7 for e in edges) > 40 and sum(e.place.none for e in edges) > 4


def test_likeness_is_near_the_jaccard_similarity(spark):
    r = random.Random(16)
    rows = []
    for n in range(80):
        words = [f"w{r.randrange(10_000)}" for _ in range(400)]
        cut = r.randrange(400)
        rows.append((n, " ".join(words), " ".join(words[:cut] + [f"v{r.randrange(10_000)}" for _ in range(400 - cut)])))
    df = spark.createDataFrame(rows, "n INT, a STRING, b STRING")
    df = minhash.sketch(minhash.sketch(df, "a", "pa"), "b", "pb").select("a", "b", minhash.likeness(F.col("pa"), F.col("pb")).alias("near"))
    gaps = []
    for x in df.collect():
        a, b = ({tuple(t.split()[i : i + 5]) for i in range(396)} for t in (x.a, x.b))
        gaps.append(x.near - len(a & b) / len(a | b))
    assert abs(sum(gaps) / len(gaps)) < 0.02 and max(map(abs, gaps)) < 0.15


def test_minhash_of_odd_tables(spark):
    one = spark.createDataFrame([(4, "a b c d e f g h")], "doc_id LONG, text STRING")
    x = minhash.compare_with_edited(one).first()
    assert x.near_next == 1.0 and x.n_chars == 15
    assert minhash.compare_with_edited(one.limit(0)).count() == 0
    ids = spark.createDataFrame([(None, "x y"), (None, "z"), (2, "")], "doc_id LONG, text STRING")
    got = {(r.doc_id, r.n_chars): r.edited_sha256 for r in minhash.compare_with_edited(ids).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(2, 0): sha(""), (None, 3): sha("x z"), (None, 1): sha("z")}


def test_native_operators_run_no_python(spark):
    from hanok.llm import queries

    for query in (queries.op2_chat_perspectives, queries.op8_minhash):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
