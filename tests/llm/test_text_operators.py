"""Secrets, BPE and decontamination against brute force."""

import hashlib
import math
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from hanok.llm import bpe, decontaminate, queries, secrets

SF = "/root/testdata/sf0.001"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# secrets


def brute_spans(text):
    """The contract's patterns, each over the whole text."""
    found = [
        (m.start(), "assign", m.end())
        for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 12
    ]
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ["assign", "access", "hex"]
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(found, key=lambda s: (s[0], kinds.index(s[1]))))


def secret_texts():
    r = random.Random(3)
    parts = ["token", "API_KEY", "passWd", "ſecret", "Kelvin toKen", "=", " : ", '"', "'", " ", "\n", "é", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef" * 3, "abc.def-ghi/jkl", "short", "ABCDEFGHIJ123456"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(400)]


def test_base_spans_are_those_of_the_patterns(spark):
    texts = [*secret_texts(), None, "", "x" * 200_000 + " token=abcdefghijkl"]
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id LONG, text STRING, spans STRING")
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute_spans(t or "")
        assert got[i].base_sha256 == digest(want)
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("random")] == [s for s in want.split(",") if s]
        assert got[i].n_assign + got[i].n_access + got[i].n_hex == len([s for s in want.split(",") if s])


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    words = ["".join(r.choice(["the", "er", "ing", "tion", "an", "on", "re", "st", "ble"]) for _ in range(r.randint(1, 7))) for _ in range(4000)]
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(24)) for _ in range(60)]
    return [" ".join(r.sample(words, 60)) + f" key {h}" for h in hexes]


def test_random_strings_are_told_from_identifiers(spark, corpus):
    r = random.Random(6)
    planted = ["".join(r.choice(secrets.ALPHABET[:64]) for _ in range(32)) for _ in range(20)]
    plain = ["theeringtionanonrestble", "ANDTHEREFOREINGTION", "the-erring-station-on-the-blest"]
    rows = [*corpus, *(f"see {p} here" for p in planted), *(f"see {p.lower()} here" for p in plain)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id LONG, text STRING")
    got = {x.doc_id: x for x in secrets.scan(docs).collect()}
    caught = [got[len(corpus) + i].spans == f"random:4:{4 + 32}" for i in range(len(planted))]
    assert sum(caught) >= 18
    assert not any(got[i].n_random for i in range(len(corpus)))
    assert not any(got[len(corpus) + len(planted) + i].n_random for i in range(len(plain)))


def test_random_strings_are_found_among_many_and_in_copies(spark, corpus):
    r = random.Random(7)
    planted = ["".join(r.choice(secrets.ALPHABET[:62]) for _ in range(32)) for _ in range(1001)]
    plain = ["theeringtionanonrestble", "=" * 40, "-" * 16]
    rows = [(i, f"see {p} here") for i, p in enumerate(planted)] + [(-1 - i, f"see {p} here") for i, p in enumerate(plain)]
    base = spark.createDataFrame([(None, x) for x in corpus], "doc_id LONG, text STRING")
    few = spark.createDataFrame([*rows, *[(1000, f"see {planted[1000]} here")] * 4000], base.schema)
    for times in (1, 100):
        docs = base.crossJoin(spark.range(times)).select(base.columns).unionByName(few)
        got = {(x.doc_id, x.spans, x.n_random) for x in secrets.scan(docs).collect()}
        caught = {i for i, spans, _ in got if i is not None and i >= 0 and spans == "random:4:36"}
        assert len(caught) >= 980 and 1000 in caught
        assert not any(n for i, _, n in got if i is None or i < 0)


def test_identifiers_of_random_hexadecimal_are_found_and_numbers_are_not(spark, corpus):
    r = random.Random(9)
    uuid = lambda: "-".join("".join(r.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12))
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    found = [uuid().upper() if i % 2 else uuid() for i in range(100)]
    plain = [f"2024-{number(2)}-{number(2)}-{number(2)}-{number(2)}-{number(2)}" for _ in range(40)] + [f"{number(3)}-{number(1)}-{number(5)}-{number(4)}-{number(1)}" for _ in range(40)]
    rows = [*corpus, *(f"id {x} here" for x in found + plain)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id LONG, text STRING")
    got = {x.doc_id - len(corpus): x for x in secrets.scan(docs).collect()}
    assert sum(got[i].spans == "random:3:39" for i in range(100)) >= 98
    assert not any(got[100 + i].n_random for i in range(len(plain)))
    assert secrets.scan(docs).columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def test_ratios_by_hand():
    """The models recomputed with dictionaries: shares of pairs, smoothing, and the sums along a token."""
    words, plain, drawn = ["the", "thing", "station"], ["the-erring-thing-", "stations_of_the_"], ["x9Q2", "Qx29"]

    def count(texts, edges):
        pairs = {}
        for t in texts:
            t = ["", *t, ""] if edges else list(t)
            for ab in zip(t, t[1:]):
                pairs[ab] = pairs.get(ab, 0) + 1
        return pairs

    size = len(secrets.ALPHABET) + 1
    states = ["", *secrets.ALPHABET]
    w, p, d = count(words, False), count(plain, True), count(drawn, True)
    raw = {(a, b): w.get((a, b), 0) / sum(w.values()) + p.get((a, b), 0) / (sum(p.values()) + 34 * size) for a in states for b in states}
    total = sum(raw.values())
    column = {b: sum(raw[a, b] for a in states) / total for b in states}
    ordinary = {ab: n + 0.1 * (0.2 / size + 0.8 * column[ab[1]]) * total / size for ab, n in raw.items()}
    rows = {a: sum(ordinary[a, b] for b in states) for a in states}
    random_ = {ab: d.get(ab, 0) + (34 + 0.1 * sum(d.values()) / size) / size for ab in ordinary}
    sums = {a: sum(random_[a, b] for b in states) for a in states}

    def matrix(pairs):
        out = np.zeros((size, size))
        for (a, b), n in pairs.items():
            out[states.index(a), states.index(b)] = n
        return out

    ratios = secrets._log_ratios(matrix(w), matrix(p), matrix(d))
    for token in ("the-station-thing", "Qx29Qx29Qx29Qx29x", "0123-4567-89AB-CDEF", "zzzzzzzzzzzzzzzzzz"):
        pairs = list(zip(["", *token], [*token, ""]))
        plainly = sum(math.log(ordinary[a, b] / rows[a]) for a, b in pairs)
        hexes = [sum(math.log(1 / 18 if b == "" or b in x else 1e-6) for _, b in pairs) for x in ("0123456789ABCDEF-", "0123456789abcdef-")]
        digits = sum(math.log(1 / 12 if b == "" or b in "0123456789-" else 1e-6) for _, b in pairs)
        want = [len(pairs) * math.log(1 / size), sum(math.log(random_[a, b] / sums[a]) for a, b in pairs), *hexes, digits]
        got = ratios.reshape(len(ratios), -1)[:, secrets._pairs(token)].sum(axis=1)
        assert np.allclose(got, np.array(want) - plainly)
        best = max(got[0], got[1], got[2] - max(got[4], 0), got[3] - max(got[4], 0))
        seen, own = {}, 0.0
        for n, c in enumerate(token):
            seen[c] = seen.get(c, 0) + 1
            own += math.log(seen[c]) - math.log1p(n / size)
        assert secrets.is_random(token, ratios) == (best >= math.log(1e4) * len(token) / 16 > own)


def test_redaction_replaces_spans_and_keeps_the_rest(spark, corpus):
    rows = [(1, "a token=abcdefghijkl0 b", 23, "t"), (2, None, None, "t"), (3, "clean", 5, "t"), (3, "clean", 5, "t"), (None, "password: 0123456789abcdef0", 27, "t")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_chars LONG, spans STRING")
    got = secrets.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a <secret> b", 12, "t"), (2, None, None, "t"), (3, "clean", 5, "t"), (3, "clean", 5, "t"), (None, "<secret>", 8, "t")], key=str
    )
    assert secrets.redact(docs.limit(0)).count() == 0 and secrets.scan(docs.limit(0)).count() == 0


def test_masking_joins_overlapping_spans():
    assert secrets.masked("0123456789", [(1, 0, 4), (3, 2, 6), (8, 1, 9)], "#") == "0#67#9"


# BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def model():
    return bpe.Model(queries.tokenizer_source())


def encoded_texts():
    r = random.Random(1)
    parts = ["'s", "'re", "'v", "e", "l", "th", "ing", "$", "&&&", "!!", " ", "\n", "9", "é", "é", "Σ", "ß", "İ", "한", "ᄒ", "ᅡ", "ᆫ", "<|endoftext|>", "<|endof", " ", "\x1c", "a" * 40, "thethe", "٣", "語"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(250)]


@pytest.mark.parametrize("piece", [1, 2, 7, 1 << 16])
def test_streamed_ids_and_text_are_the_librarys(library, model, piece):
    encoder, decoder = bpe.Encoder(model, piece), bpe.Decoder(model, spelled=True)
    for text in encoded_texts():
        parts = list(encoder.encode(text))
        ids = [i for p in parts for i in p]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        decoder.reset()
        assert "".join(map(decoder.feed, parts)) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_words_longer_than_the_lookahead(library, model):
    r = random.Random(2)
    for text in ("a" * 9000, "the" * 3000, "".join(r.choice("abcdefghinorst") for _ in range(9000)), "".join(r.choice("!?$#-") for _ in range(6000))):
        encoder = bpe.Encoder(model, 100)
        encoder.feed(text[:7000])
        assert encoder.long is None or len(encoder.long[0].held) <= model.window + 1
        again = bpe.Encoder(model, 100)
        assert [i for p in again.encode(text) for i in p] == library.encode(text, add_special_tokens=False).ids


def test_every_character_is_split_and_written_as_the_library_does(model, library):
    encoder = bpe.Encoder(model)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    marks = [c for c in points if unicodedata.combining(chr(c))]
    r = random.Random(8)
    texts = [" ".join(f"a{chr(c)}a {chr(c)}{chr(c)}1{chr(c)}" for c in points[at : at + 500]) for at in range(0, len(points), 500)]
    texts += [" ".join("".join(r.choice("aeqo\u0391\U00011935") + "".join(chr(r.choice(marks)) for _ in range(3)) for _ in range(3)) for _ in range(200)) for _ in range(40)]
    texts += ["".join(map(chr, (0x11935, 0x11930, 0x41, 0x301, 0x898, 0x323, 0x3A3)))]
    for text in texts:
        assert [i for ids in encoder.encode(text) for i in ids] == library.encode(text, add_special_tokens=False).ids



def test_lookahead_of_small_merge_lists():
    assert bpe.lookahead([], "") == 1
    # "b" decides about "a" only once: a chain of one
    assert bpe.lookahead([("a", "b")], "") == 1
    # whether "c d" merges decides about "b c", which decides about "a b"
    assert bpe.lookahead([("c", "d"), ("b", "c"), ("a", "b")], "") == 3
    # the other order of the list has no such chain
    assert bpe.lookahead([("a", "b"), ("b", "c"), ("c", "d")], "") == 1


def test_tokens_beyond_the_lookahead_never_change(model):
    """Whatever follows a known start, tokens that end a lookahead before its end are the same."""
    r = random.Random(4)
    for _ in range(30):
        start = [r.choice("theianrsou") for _ in range(model.lookahead + 60)]
        sure = len(start) - model.lookahead
        seen = set()
        for _ in range(4):
            rest = [r.choice("theianrsou") for _ in range(r.randint(0, 40))]
            ends, at = [], 0
            for token in bpe.merge(model, [*start, *rest]):
                at += len(token)
                ends.append(at)
            seen.add(tuple(e for e in ends if e <= sure))
        assert len(seen) == 1


def test_bytes_decode_to_the_words_of_the_text(model):
    text = "Don't  stop\nat É한 €5"
    encoder, decoder = bpe.Encoder(model), bpe.Decoder(model, spelled=False)
    ids = [i for p in encoder.encode(text) for i in p]
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == "don 't stop at é한 € 5 "
    # a byte that begins a character and is not followed by the rest
    decoder.reset()
    first = model.vocab[model.bytes["é".encode()[0]]]
    assert decoder.feed([first]) == "" and decoder.finish() == "�"


def test_tokenized_table(spark, library):
    rows = [(1, None, 0), (2, "", 0), (3, "Hello world, it's", 0), (3, "Hello world, it's", 0), (None, "x" * 100_000, 0), (4, "é " * 70_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_tokens INT")
    got = bpe.tokenize(docs, queries.tokenizer_source(), keep_ids=True).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)), ids)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.input_ids) == want[r.doc_id]
    assert bpe.tokenize(docs.limit(0), queries.tokenizer_source()).count() == 0


def test_op4_is_the_library_on_the_given_table(spark, library):
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    for r in queries.op4_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(" ".join(map(str, ids))))
        assert r.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))


# decontamination


def brute_contamination(docs, items):
    cut = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for doc_id, text in docs:
        w, hit, found = cut(text), set(), set()
        for item, t in items:
            v = cut(t)
            n = min(10, len(v))
            for i in range(len(v) - n + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit |= set(range(j, j + n))
                        found |= {str(item)} - {"None"}
        out.append((doc_id, len(w), len(hit), len(found), digest(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def passages():
    r = random.Random(9)
    vocab = ["a", "b", "C", "dé", "e1"]
    say = lambda n: r.choice([" ", ", ", "\n"]).join(r.choice(vocab) for _ in range(n))
    items = [(i, say(r.choice([1, 2, 3, 4, 9, 10, 11, 14]) if i % 3 else 12)) for i in range(25)] + [(3, say(12)), (None, say(11)), (40, None), (41, ""), (42, "...")]
    docs = []
    for i in range(120):
        text = say(r.randint(0, 40))
        if i % 3 == 0:
            text += " zz " + r.choice(items)[1].__str__() + " zz " + say(3)
        docs.append((i, text))
    return docs + [(5, docs[5][1]), (None, docs[6][1]), (900, None), (901, ""), (902, "q " * 50_000 + items[0][1])], items


@pytest.mark.parametrize("block", [200_000, 7])
def test_contamination_in_one_block_and_in_many(spark, passages, block):
    docs, items = passages
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id LONG, text STRING, n_hit INT")
    b = spark.createDataFrame([(*x, "s") for x in items], "item_id LONG, text STRING, win STRING")
    got = decontaminate.contamination(d, b, index_windows=block)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute_contamination(docs, items)
    assert sorted(map(tuple, got.collect()), key=str) == want
    clean = decontaminate.without_benchmark(d, b, index_windows=block)
    assert clean.columns == d.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(w[0]) for w in want if not w[5])


def test_contamination_of_empty_tables(spark, passages):
    d = spark.createDataFrame(passages[0], "doc_id LONG, text STRING")
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    assert not any(r.contaminated for r in decontaminate.contamination(d, none).collect())
    assert decontaminate.without_benchmark(d, none).count() == d.count()
    b = spark.createDataFrame(passages[1], "item_id LONG, text STRING")
    assert decontaminate.contamination(d.limit(0), b).count() == 0


def test_a_windows_prefix_is_its_rarest_shingle(spark):
    items = [(1, b"a b c d e f g h i j")]
    index = decontaminate.Index([(str(i), w) for i, w in items])
    docs = spark.createDataFrame([("a b c d e f g h i",)] * 3 + [("h i j",)], "text STRING")
    index.order(decontaminate._counted(docs, index))
    assert index.place.tolist() == [7]
