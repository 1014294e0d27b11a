"""Quality, licences, urls, dialogues, archives and the pipeline."""

import gzip
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import connect
from hanok.llm import chat, licenses, quality, queries, urls, warc

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rel = connect(SF).sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    want = sorted((tuple(r) for r in rel.fetchall()), key=str)
    assert rows_of(df.select(rel.columns)) == want and want


# quality


def test_marginals_are_the_sums_over_all_labellings():
    r = np.random.default_rng(1)
    lines, change = np.array([3, 1, 4]), r.normal(size=(2, 2))
    scores = r.normal(size=8)
    got, pairs = quality.marginals(scores, lines, change)
    want, seen, at = [], np.zeros((2, 2)), 0
    for n in lines:
        s = scores[at : at + n]
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(s[i] for i in range(n) if p[i]) + sum(change[p[i], p[i + 1]] for i in range(n - 1))) for p in paths])
        weight /= weight.sum()
        want += [sum(w for w, p in zip(weight, paths) if p[i]) for i in range(n)]
        for w, p in zip(weight, paths):
            for i in range(n - 1):
                seen[p[i], p[i + 1]] += w
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, seen)


def test_features_do_not_depend_on_what_else_is_in_the_batch(monkeypatch):
    texts = [b"", b"A b c.\n\nDE!! F | 12 \xc3\xa9", b"x\nx\nx", b"one two " * 500, b"\n"]
    whole = quality.line_features(texts)
    monkeypatch.setattr(quality, "SLICE", 64)
    assert all(np.allclose(a, b) for a, b in zip(whole, quality.line_features(texts)))
    alone = [quality.line_features([t]) for t in texts]
    assert np.allclose(whole[0], np.concatenate([a[0] for a in alone]))
    assert whole[2].tolist() == [t.count(b"\n") + 1 for t in texts]


def test_held_out_labels_are_predicted_and_never_read(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score(docs, labels)
    joined = got.join(labels, "doc_id")
    right = joined.where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.97
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    assert rows_of(quality.score(docs, turned)) == rows_of(got)
    crc = {r.doc_id: r.held_out for r in got.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in crc.items())


def test_what_is_fitted_has_a_set_size(spark):
    good, bad = "A line of prose, as it should be.\n" * 3, "WIN $$$ NOW | BUY | 100% !!!\n" * 3
    long_one = next(i for i in range(0, 40, 2) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs = [(i, (good, bad)[i % 2] + f"{i} more." if i != long_one else good * 4000) for i in range(40)] + [(1, bad)] * 2000
    df = spark.createDataFrame(docs, "doc_id LONG, text STRING").repartition(6)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)], "doc_id LONG, quality INT, toxic INT")
    got, fit = [], quality.fit
    quality.fit = lambda features, sizes, lines, labels: got.append((len(features), lines.tolist(), len(labels))) or fit(features, sizes, lines, labels)
    try:
        scored = quality.score(df, labels).collect()
    finally:
        quality.fit = fit
    rows, lines, documents = got[0]
    assert documents <= 40 and max(lines) == quality.MAX_LINES and rows == sum(lines) < 40 * 5 + quality.MAX_LINES
    assert len(scored) == 2040 and all(r.predicted == 1 - r.doc_id % 2 for r in scored)


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "", 5), (None, "A line.", 5), (3, "x " * 80_000 + "\n" * 3000, 5)], "doc_id LONG, text STRING, score INT")
    none = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    got = quality.score(docs, none).collect()
    assert len(got) == 5 and all(r.score == 1.0 and r.predicted == 1 for r in got)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(1, None, 0), (None, 1, 0)], "doc_id LONG, quality INT, toxic INT")
    more = docs.unionByName(spark.createDataFrame([(i, "Good words in a line." if i % 2 else "BAD!! $$$ ###", 0) for i in range(10, 40)], docs.schema))
    scores = quality.score(more, labels).collect()
    assert len(scores) == 35 and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id in (1, 2)}) == 1
    assert all(r.predicted == r.doc_id % 2 for r in scores if r.doc_id and r.doc_id >= 10)
    kept = quality.keep_good(more, labels)
    assert kept.columns == more.columns
    assert quality.score(more.limit(0), labels).count() == 0 and quality.keep_good(more.limit(0), labels).count() == 0


# licences


def test_stated_and_inherited_licences(spark):
    mit, gpl, apache = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."
    files = [
        ("LICENSE", 1, mit), ("a/LICENSE-x", 2, f"some words\n{gpl}"), ("a/b/c/own.txt", 3, f"{apache}\nand what follows"), ("a/b/c/none.txt", 4, "nothing here"),
        ("top.txt", 5, None), ("z/y.txt", 6, ""), ("a/b/license.md", 7, "no licence at all"), ("a/bb/f", 8, "x"), (None, 9, mit), (None, 10, "x"),
        ("z/y.txt", 6, ""), ("d/LICENSE-1", 11, apache), ("d/LICENSE-2", 12, mit), ("d/f", 13, "x " * 100_000),
    ]
    df = spark.createDataFrame([(*f, 1) for f in files], "path STRING, doc_id LONG, text STRING, dir INT")
    got = sorted((r.doc_id, r.licence, r.origin, r.source_dir) for r in licenses.licences(df).select("doc_id", "licence", "origin", F.coalesce("source_dir", F.lit("-")).alias("source_dir")).collect())
    assert [(a, b, c, d) for a, b, c, d in sorted(got, key=str)] == sorted([
        (1, "MIT", "own", "-"), (2, "GPL-3.0", "own", "-"), (3, "Apache-2.0", "own", "-"), (4, "GPL-3.0", "inherited", "a"), (5, "MIT", "inherited", ""),
        (6, "MIT", "inherited", ""), (6, "MIT", "inherited", ""), (7, "GPL-3.0", "inherited", "a"), (8, "GPL-3.0", "inherited", "a"), (9, "MIT", "own", "-"),
        (10, None, "none", "-"), (11, "Apache-2.0", "own", "-"), (12, "MIT", "own", "-"), (13, "Apache-2.0", "inherited", "d"),
    ], key=str)
    assert licenses.licences(df.limit(0)).count() == 0


def test_headers_amid_other_words_and_lines(spark):
    texts = {
        "Apache-2.0": [
            "Copyright 2020 Foo Inc. All rights reserved. Licensed under the Apache License, Version 2.0",
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except as said',
            "// Licensed under the Apache\n// License, Version 2.0 (read it)",
            "x\n# SPDX-License-Identifier: Apache-2.0\ny",
        ],
        "proprietary": ["Copyright (c) 2011 Foo. All rights reserved."],
        "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "/* SPDX-License-Identifier: GPL-2.0-only */"],
        "GPL-3.0": ["you can change it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or later"],
        "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"],
        "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy was not given"],
        "BSD-2-Clause": ["The BSD 2-Clause License for foo"],
        "Zlib": ["SPDX-License-Identifier: Zlib"],
        None: ["words of no licence at all", "sie kamen mit ihm und mit ihr"],
    }
    want = [(k, t) for k, ts in texts.items() for t in ts]
    files = spark.createDataFrame([(f"{i}/f.txt", i, t) for i, (_, t) in enumerate(want)], "path STRING, doc_id LONG, text STRING")
    more = spark.range(5000).select(F.concat(F.lit("m/"), "id").alias("path"), (-1 - F.col("id")).alias("doc_id"), F.concat(F.lit("the end of line "), "id", F.lit(" mit you")).alias("text"))
    got = {r.doc_id: r for r in licenses.licences(files.unionByName(more)).collect()}
    assert len(got) == len(want) + 5000
    assert [(got[i].licence, t) for i, (_, t) in enumerate(want)] == want
    assert all(r.licence is None for i, r in got.items() if i < 0)


def test_weights_of_words_beyond_the_commonest(spark, monkeypatch):
    line = "Released under MIT License by foo"
    files = spark.createDataFrame([("a", 1, line), *(("b", 2 + i, f"foo bar baz{i}\nby the qux") for i in range(300))], "path STRING, doc_id LONG, text STRING")
    cosine = lambda: [(r.licence, r.cosine) for r in licenses.licences(files).where("doc_id = 1").collect()]
    want = cosine()
    monkeypatch.setattr(licenses, "COMMON", 1)
    assert cosine() == want and want[0][0] == "MIT"


def test_spdx_expressions_and_names():
    tag = "SPDX-License-Identifier: "
    cases = {
        "MIT OR Apache-2.0": ["MIT OR Apache-2.0"], "(MIT AND BSD-3-Clause)": ["MIT AND BSD-3-Clause"], "GPL-2.0-or-later WITH Classpath-exception-2.0.": ["GPL-2.0 WITH Classpath-exception-2.0"],
        "Zlib.": ["Zlib"], "GPL-3.0+": ["GPL-3.0"], "none of these": [], "MIT OR nothing": [], "LicenseRef-own": ["LicenseRef-own"], "MIT\nOR BSD": ["MIT"],
    }
    assert {t: licenses.tagged(f"# {tag}{t}") for t in cases} == cases
    assert licenses.tagged(f"{tag}MIT\n{tag}ISC\n{tag}") == ["MIT", "ISC"]


def test_cosines_of_all_lines_and_stretches_by_hand(spark):
    import math
    from collections import Counter

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    apache, gpl = (next(t for n, t in licenses.TEMPLATES if n == name) for name in ("Apache-2.0", "GPL-3.0"))
    odd = ["", apache, f"so\n{apache} it", f"foo bar {gpl} baz qux quux", "Released under a MIT\nLicense by foo and bar", "under the Apache License", "MIT License MIT License", f"{apache} {gpl}"]
    texts |= {10_000 + i: t for i, t in enumerate(odd)} | {20_000: "SPDX-License-Identifier: MIT OR Zlib"}
    files = spark.createDataFrame([(f"{i}/f", i, t) for i, t in texts.items()], "path STRING, doc_id LONG, text STRING")
    lines = [line for t in texts.values() for line in t.split("\n")]
    df = Counter(w for line in lines for w in set(licenses.words(line)))
    vector = lambda found: {w: n * (math.log((1 + len(lines)) / (1 + df[w])) + 1) for w, n in Counter(found).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = [(n, vector(licenses.words(t)), len(licenses.words(t))) for n, t in licenses.TEMPLATES]

    def best(text):
        found, own = [w for line in text.split("\n") for w in licenses.words(line)], [(-1.0, n) for n in licenses.tagged(text)]
        for name, t, size in templates:
            rare = {w for w in t if df[w] < 100}  # no cosine without one of these
            parts = [(licenses.words(line), licenses.MIN_COSINE) for line in text.split("\n")] + [(found[i : i + size], licenses.MIN_STRETCH) for i in range(max(1, len(found) - size + 1))]
            for part, bar in parts:
                if not rare.isdisjoint(part):
                    v = vector(part)
                    cosine = sum(x * t.get(w, 0) for w, x in v.items()) / (norm(v) * norm(t))
                    if cosine >= bar:
                        own.append((-cosine, name))
        return min(own, default=(None, None))

    got = {r.doc_id: r for r in licenses.licences(files).collect()}
    found = 0
    for i, text in texts.items():
        cosine, name = best(text)
        found += name is not None
        if name is None:
            assert got[i].origin != "own" and got[i].cosine is None, text
        else:
            assert got[i].origin == "own" and got[i].licence == name and abs(got[i].cosine + cosine) < 1e-6, text
    assert found >= 8 and got[20_000].licence == "MIT OR Zlib"


# urls


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = []
    for says, text in [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]:
        domain, start = text.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(text), text, says))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://WWW.Example.COM/en/1", "https://example.com/en/", "https://a.b.example.com/en/x?y#z", "https://xexample.com/en/x", "https://example.com", "https://example.com?a=/en/", "http://m.site.net/es/9#x",
    "http://site.net/fr", "http://net/fr/", "http://com/", "ftp://a.org://b/c", "no scheme", "", None, "://", "http://É.com/é/", "http://freecasinobets.org/en/7", "http://casino-win.org/en/1", "http://ads.shop.org/x",
    "http://garden-club.org/en/1", "http://reading-room.org/en/2", "http://host:80/p", "http://" + "a" * 300 + ".org/" + "p" * 50_000, "http://1.2.3.4/x", "http://example.com/en/1\n2",
]


def test_rules_and_words_of_urls(spark):
    html = "<p>garden club reading room free the casino bets</p>" * 3
    rows = [(i, u, html if i % 2 else None, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], None, "x"), (None, URLS[1], None, "x")]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, host STRING")
    got = urls.judge(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, u, _, _ in rows:
        host, path = brute_split(u)
        rule, says = brute_rule(host, path)
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule), u
        assert by[i].verdict == (says or ("block" if by[i].score > 0 else "allow"))
    at = {u: by[i] for i, u, _, _ in rows}
    assert at["http://freecasinobets.org/en/7"].words == "free casino bets"
    assert at["http://freecasinobets.org/en/7"].verdict == at["http://casino-win.org/en/1"].verdict == "block"
    assert at["http://garden-club.org/en/1"].verdict == at["http://reading-room.org/en/2"].verdict == "allow"
    assert by[URLS.index("")].verdict == "allow"
    assert urls.judge(pages.limit(0)).count() == 0


def test_long_labels_users_ports_and_long_words(spark):
    word = "donaudampfschifffahrtsgesellschaft"
    found = {
        "http://" + "casino" * 12 + ".org/a": ("block", " ".join(["casino"] * 12)),
        "http://user:x@casino-win.org:8080/a": ("block", "casino win"),
        f"http://{word}club.org/c": ("allow", f"{word} club"),
        "http://" + "club" * 3000 + ".org/d": ("allow", " ".join(["club"] * 3000)),
    }
    html = f"<p>club club club {word}</p>"
    pages = spark.createDataFrame([(i, u, html) for i, u in enumerate(found)] + [(9 + i, f"http://club{i}.org/{i}", html) for i in range(30)], "page_id LONG, url STRING, html STRING")
    got = {r.page_id: (r.verdict, r.words) for r in urls.judge(pages).collect()}
    assert [got[i] for i in range(len(found))] == list(found.values())


def test_the_model_is_naive_bayes_over_the_examples(spark):
    rows = [
        (["casino", "win"], "/en/1", None, None), (["casino", "win"], "/en/22", None, None), (["garden"], "/x", None, None), (["win", "example"], "/en/3", "example.com/en/", "block"),
        (["rose", "garden", "rose"], "/en/b", "com/", "allow"), (None, None, None, None),
    ]
    made = urls.examples(spark.createDataFrame(rows, "words array<string>, path STRING, rule STRING, says STRING"))
    told = [("n", ["h casino", "h win", "p en", "p #"]), ("a", ["h garden", "p x"]), ("r", ["h win", "p #"]), ("a", ["h rose", "h garden", "h rose", "p en", "p b"]), ("a", [])]
    assert sorted((sorted(r.slots), r.kind) for r in made.collect()) == sorted((sorted(map(urls.bucket, t)), {"n": 1, "r": 2, "a": 3 if t in (["h garden", "p x"], []) else 0}[k]) for k, t in told)
    model = urls.train(made)
    count = lambda kind, t: sum(x.count(t) for k, x in told if k == kind)
    size = lambda kind: sum(len(x) for k, x in told if k == kind)
    for t in ("h casino", "h win", "p en", "p #", "h garden", "h rose", "p x"):
        usual = sum(count(k, t) for k in "nar") / sum(map(size, "nar"))
        chance = {k: (count(k, t) + 20 * usual) / (size(k) + 20) for k in "nar"}
        for n, k in enumerate("nr"):
            assert abs(model.weights[n][urls.bucket(t)] - np.log(chance[k] / chance["a"])) < 1e-9
    a, b = (sum(model.weights[n][urls.bucket(t)] for t in ("h win", "p en")) for n in (0, 1))
    assert abs(model.score([urls.bucket("h win"), urls.bucket("p en")]) - np.log(0.1 * (np.exp(a) + np.exp(b)))) < 1e-9


def test_words_beside_seeds_are_learned_and_without_seeds_there_is_a_model(spark):
    r = random.Random(6)
    clean = [f"{a}{b}" for a in ("garden", "river", "school", "music", "bread", "stone") for b in ("club", "house", "world", "road", "field")]
    bad = ["lucky", "spins", "payout", "dealer", "slots"]
    html = " ".join([*"garden river school music bread stone club house world road field lucky spins payout dealer slots".split()] * 3)
    known = [f"{r.choice(bad)}{r.choice(['casino', 'poker', 'jackpot'])}{r.choice(bad)}" for _ in range(300)]
    hidden = ["".join(r.sample(bad, 2)) for _ in range(60)]
    hosts = [(h, "clean") for h in clean for _ in range(20)] + [(h, "known") for h in known] + [(h, "hidden") for h in hidden]
    rows = [(i, f"http://{r.choice(['www.', ''])}{h}.org/{r.choice(['en', 'de'])}/{i}", html) for i, (h, _) in enumerate(hosts)]
    got = {x.page_id: x.verdict for x in urls.judge(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    share = lambda kind: np.mean([got[i] == "block" for i, (_, k) in enumerate(hosts) if k == kind])
    assert share("known") == 1 and share("hidden") >= 0.9 and share("clean") <= 0.02
    none = [(i, f"http://{h}.example.{r.choice(['com', 'net', 'org'])}/{r.choice(['en', 'es', 'de'])}/{i}", html) for i, h in enumerate(clean * 10)]
    found = urls.judge(spark.createDataFrame(none, "page_id LONG, url STRING, html STRING")).collect()
    assert len({x.score for x in found}) > 5 and all(x.verdict == "allow" for x in found if x.rule is None)


def test_segmentation_is_the_likeliest_of_all_cuts():
    r = random.Random(3)
    for _ in range(60):
        label = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        costs = {"".join(r.choice("abc") for _ in range(r.randint(1, 4))): r.uniform(1, 9) for _ in range(12)}
        best = min(
            sum(costs.get(label[a:b], 8.0 * (1 + b - a)) for a, b in zip((0, *cut), (*cut, len(label))))
            for n in range(len(label))
            for cut in itertools.combinations(range(1, len(label)), n)
        )
        words = urls.segment(label, costs, 8.0)
        assert "".join(words) == label
        assert abs(sum(costs.get(w, 8.0 * (1 + len(w))) for w in words) - best) < 1e-9


# dialogues


def test_every_speakers_view(spark):
    rows = [
        (1, 1, "ann", "hi"), (1, 0, "system", "be kind"), (1, 2, "bob", "é<|im_end|>"), (1, 3, "ann", None), (1, 3, "ann", None), (1, 300, "cy", "late"),
        (2, 0, "system", "alone"), (3, None, "dan", "x"), (3, 1, None, "narrated"), (None, 1, "eve", "lost"), (4, 0, "fay", "l" * 200_000),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id LONG, turn INT, role STRING, text STRING, part INT")
    got = {(r.conv_id, r.part, r.speaker): r for r in chat.perspectives(df).collect()}
    assert set(got) == {(1, 0, s) for s in ("ann", "bob", "cy")} | {(3, 0, "dan"), (4, 0, "fay")}
    for (conv, part, speaker), r in got.items():
        own = [r.text[int(a) : int(b)] for a, b in (m.split(":") for m in r.masks.split(",") if m)]
        told = sorted((t if t is not None else -1, x or "system", y or "") for c, t, x, y in rows if c == conv)
        name = lambda x: "assistant" if x == speaker else "system" if x == "system" else f"user name={x}"
        assert r.text == "".join(f"<|im_start|>{name(x)}\n{y}<|im_end|>\n" for _, x, y in told)
        assert own == [y for _, x, y in told if x == speaker] and (r.n_turns, r.n_own) == (len(told), len(own))
    assert chat.perspectives(df.limit(0)).count() == 0


def test_a_dialogue_of_many_turns_is_whole(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, i, ("ann", "bob")[i % 2], f"say {i}") for i in range(1, 3001)]
    for r in chat.perspectives(spark.createDataFrame(rows, "conv_id LONG, turn INT, role STRING, text STRING").repartition(5)).collect():
        assert r.part == 0 and r.n_turns == 3001 and r.n_own == 1500 and r.text.startswith("<|im_start|>system\nbe brief<|im_end|>\n")
        assert [r.text[int(a) : int(b)] for a, b in (m.split(":") for m in r.masks.split(","))] == [y for _, _, x, y in rows if x == r.speaker]


def test_dialogues_too_long_for_a_row_are_cut_between_turns(spark):
    rows = [(1, None, "ann", f"say {i}") for i in range(300)] + [(1, 0, "bob", "copy")] * 3000 + [(1, 600, "ann", "last"), (1, 1, "ann", "x" * 5000)] + [(2, i, "cy", "short") for i in range(3)]
    df = spark.createDataFrame(rows, "conv_id LONG, turn INT, role STRING, text STRING").repartition(7)
    whole = {(r.conv_id, r.part, r.speaker): r for r in chat.perspectives(df).collect()}
    got = {(r.conv_id, r.part, r.speaker): r for r in chat.perspectives(df, max_chars=2000).collect()}
    assert len(got) == chat.perspectives(df, max_chars=2000).count() and got[2, 0, "cy"] == whole[2, 0, "cy"]
    for speaker in ("ann", "bob"):
        mine = [got[k] for k in sorted(got) if k[0] == 1 and k[2] == speaker]
        assert [r.part for r in mine] == list(range(len(mine))) and len(mine) > 50
        assert "".join(r.text for r in mine) == whole[1, 0, speaker].text
        assert all(len(r.text) <= 4000 or r.n_turns <= 50 for r in mine)
        said = lambda r: [r.text[int(a) : int(b)] for a, b in (m.split(":") for m in r.masks.split(",") if m)]
        assert [x for r in mine for x in said(r)] == said(whole[1, 0, speaker])
        assert sum(r.n_turns for r in mine) == 3302 and sum(r.n_own for r in mine) == (302 if speaker == "ann" else 3000)


# archives


def pages_table(spark):
    r = random.Random(8)
    big, same = "".join(r.choice("abé\r\n ") for _ in range(300_000)), "s" * 1000
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, None), (3, "http://é/", ""), (4, "u", same), (9, "u", same), (7, "v", same), (5, "w", "s" * 999), (6, "w", "s" * 999), (9, "u", same), (None, "n", same), (10, "x", "\r\n\r\nWARC/1.1\r\n\r\n" * 80)]
    return spark.createDataFrame([(*x, 1) for x in rows], "page_id LONG, url STRING, html STRING, digest INT"), rows


def test_archives_round_trip_in_chunks(spark):
    df, rows = pages_table(spark)
    listed = warc.write(df, chunk=1000)
    assert listed.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read(spark, listed, chunk=700).collect()
    whole = {}
    for r in sorted(found, key=lambda r: r.chunk_no):
        assert len(r.chunk) <= 700
        whole.setdefault((r.page_id, r.url, r.record_type, r.refers_to), []).append(r)
    said = {k: b"".join(bytes(r.chunk) for r in v) for k, v in whole.items()}
    assert said[(1, "http://a/%20b%0D%0AX:%20y", "response", None)] == rows[0][2].encode()
    assert said[(2, None, "response", None)] == b"" == said[(3, "http://é/", "response", None)]
    assert said[(10, "x", "response", None)] == rows[-1][2].encode()
    assert {k[0] for k in said if k[2] == "revisit"} == {4, 7, None} and all(k[3] == 9 for k in said if k[2] == "revisit")
    path = listed.first().path.removeprefix("file://")
    assert gzip.open(path).read().startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_read_back_records(spark):
    df, rows = pages_table(spark)
    want = []
    for page, _, html, in rows:
        data = (html or "").encode()
        equal = [p for p, _, h in rows if h == html and p is not None] if len(data) >= 1000 else []
        first = max(equal, default=None)
        again = first is not None and page != first
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert rows_of(warc.archive_and_read(df)) == sorted(want, key=str)
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_a_damaged_payload_is_noticed(spark, tmp_path):
    df, _ = pages_table(spark)
    path = warc.write(df.where("page_id = 1")).where("records > 0").first().path
    data = gzip.open(path.removeprefix("file://")).read()
    bad = tmp_path / "bad.warc.gz"
    bad.write_bytes(gzip.compress(data.replace(b"ab", b"ba", 1)))
    with pytest.raises(ValueError):
        list(warc.parse(f"file://{bad}"))
    cut = tmp_path / "cut.warc.gz"
    cut.write_bytes(gzip.compress(data[:-500]))
    with pytest.raises(ValueError):
        list(warc.parse(f"file://{cut}"))
