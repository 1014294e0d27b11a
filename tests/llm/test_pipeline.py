"""The pipeline's stages against what each operator finds by brute force on the stage's own input."""

import hashlib

import pytest

import __spark_entry__
import corpus_pipeline
from hanok.llm import queries
from hanok.llm.shared import written
from test_near_duplicates import brute_simhash, union_find
from test_text_operators import brute_contamination, brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "stage"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "BPE encoding and decoding"]
    assert all(s.columns == steps[0].columns for s in steps[1:5])


def test_quality_rejects_labelled_junk_and_keeps_the_rest(spark, steps):
    kept = set(texts(steps[1]))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [i for i, q in labels.items() if (i in kept) != bool(q)]
    assert len(wrong) <= 0.03 * len(labels)
    assert len(kept) > 0.5 * steps[0].count()


def test_near_copies_leave_one(steps):
    before = texts(steps[1])
    prints = {i: brute_simhash(t) for i, t in before.items()}
    pairs = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
    assert texts(steps[2]) == {i: before[i] for i in set(union_find(sorted(prints), pairs).values())}


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(steps[2])
    some = dict(list(before.items())[:60])
    bad = {r[0] for r in brute_contamination(list(some.items()), items) if r[5]}
    assert {i for i in texts(steps[3]) if i in some} == set(some) - bad


def test_secrets_are_replaced(steps):
    before, after = texts(steps[3]), {r.doc_id: r for r in steps[4].collect()}
    assert set(before) == set(after)
    for i, t in before.items():
        assert brute_spans(after[i].text) == ""
        assert (after[i].text == t) == (brute_spans(t) == "") and after[i].n_chars == len(after[i].text)


def test_tokens_are_the_librarys(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    before = texts(steps[4])
    got = steps[5].collect()
    assert len(got) == len(before)
    for r in got:
        ids = library.encode(before[r.doc_id], add_special_tokens=False).ids
        assert r.input_ids == ids and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_run_is_the_stages_one_after_the_other(spark, steps):
    key = lambda df: sorted((r.doc_id, r.ids_sha256) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[5])


def test_empty_and_odd_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (7, None, None, None, None)], docs.schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0
        odd = written(stage(spark, odd, SF), "odd")
        assert odd.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_registered():
    named = __spark_entry__.queries()
    assert "pipeline" in named and all(any(n.startswith(f"op{i}_") for n in named) for i in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(named) and set(queries.SQL) <= set(__spark_entry__.oracle_sql())
