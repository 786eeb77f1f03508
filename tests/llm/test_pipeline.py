"""The pipeline stage by stage against plain Python, and the queries against their SQL."""

import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from checks.compare import connect, difference
from obsengine.llm import jaccard
from obsengine.llm.oracles import ORACLES
from obsengine.llm.queries import (
    BYTE_BPE,
    MIX_LEVELS,
    QUERIES,
    language_model,
    toxicity_lexicon,
)
from tests.conftest import SMALL
from tests.llm.test_native import brute_budgets
from tests.llm.test_similar import brute_jaccard


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    assert difference(spark, connect(SMALL), QUERIES[name], ORACLES[name], SMALL) is None


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [
        (None, None, None, None, None), (9001, "", "en", "src1", 0), (9002, "12 34 ?!", "en", "src1", 8),
        (9003, "the and of " * 40_000, "en", "src2", 440_000),
        (9004, "of the on that and in", "en", None, 21), (9004, "of the on that and in", "en", None, 21),
    ]
    return table.union(spark.createDataFrame(odd, table.schema)).cache()


def listed(df):
    return Counter(tuple(r) for r in df.collect())


def test_toxicity_stage(spark, documents):
    lexicon = toxicity_lexicon(spark, SMALL, documents)
    kept = listed(stage("toxicity")(spark, documents, SMALL))
    wanted = Counter({r: n for r, n in listed(documents).items() if lexicon.score(r[1] or "")[0] < 0.5})
    assert kept == wanted and len(kept) < documents.count()


def test_language_stage(spark, documents):
    model = language_model(documents)
    kept = listed(stage("language")(spark, documents, SMALL))
    wanted = {r: n for r, n in listed(documents).items() if not model.predict([r[1] or ""])[0][3]}
    assert kept == Counter(wanted)
    gone = {r[0] for r in listed(documents) - kept}
    assert gone == {None, 9001, 9002}


def test_near_duplicate_stage(spark, documents):
    kept = listed(stage("near_duplicates")(spark, documents, SMALL))
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    first = {key for key, least, _ in brute_jaccard(rows) if key == least}
    wanted = {(key, text) for key, text in rows if key in first}
    assert {(r[0], r[1]) for r in kept} == wanted and set(kept.values()) == {1}


def test_near_duplicates_of_repeated_ids(spark):
    text = " ".join(f"word{i}" for i in range(200))
    other = " ".join(f"other{i}" for i in range(80))
    table = [
        (1, text, "en", "a", 1), (5, text + " end", "en", "a", 2), (5, other, "en", "a", 3),
        (7, other, "de", "b", 4), (7, other, None, "z", 4), (7, other, "de", "a", None),
        (-3, "short", None, None, None), (None, "short", None, None, None), (8, None, "x", "y", 0),
        (8, "", "w", "y", 0), (9, "", "w", "y", 0), (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(table, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    kept = listed(stage("near_duplicates")(spark, docs, SMALL))
    # The near copy of 1 goes although its id has another row, which stays for its copies.
    assert kept == Counter(
        [table[0], table[2], table[6], (8, None, "x", "y", 0), (9, "", "w", "y", 0), (None,) * 5]
    )
    alone = spark.createDataFrame(table[3:6], docs.schema)
    assert listed(stage("near_duplicates")(spark, alone, SMALL)) == Counter([table[4]])


def test_near_duplicates_keep_the_smallest_id(spark):
    ids = [-(1 << 63), -5, -1, 0, 3, 12, (1 << 63) - 1, None]
    frame = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    keys = [r[0] for r in frame.select(jaccard.row_key("doc_id", "text")).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(ids)


def test_mixing_stage(spark, documents):
    kept = stage("mixing")(spark, documents, SMALL).collect()
    original = Counter()
    leaves = Counter()
    domains = {0: "web", 1: "books", 2: "code", 3: "news"}

    def leaf(r):
        return (domains[int(r.source[3:]) % 4] if r.source else None, r.lang, r.source)

    for r in documents.collect():
        words = len((r.text or "").split())
        original[r.doc_id, r.text] += 1
        if words:
            leaves[leaf(r)] += words
    budget = int(sum(leaves.values()) * corpus_pipeline.MIX_SHARE)
    weights = corpus_pipeline.MIX_WEIGHTS
    wanted = brute_budgets(leaves, budget, 1, weights)
    got, cut = Counter(), Counter()
    for r in kept:
        got[leaf(r)] += len(r.text.split())
        whole = (r.doc_id, r.text)
        if original[whole]:
            original[whole] -= 1
        else:  # a prefix of its text, at most one a leaf
            cut[leaf(r)] += 1
            assert any(k == r.doc_id and n and t and t.startswith(r.text) for (k, t), n in original.items())
            assert r.n_chars == len(r.text)
    assert dict(got) == {k: n for k, n in wanted.items() if n}
    assert all(n == 1 for n in cut.values()) and len(MIX_LEVELS) == 3


def test_encode_stage(spark, documents):
    library = Tokenizer.from_file(BYTE_BPE)
    found = stage("bpe")(spark, documents, SMALL)
    texts = {(r.doc_id, r.text or "") for r in documents.collect()}
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in texts}
    assert found.count() == documents.count()
    for r in found.collect():
        text = by_digest[r.decoded_sha256]
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(r.token_ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)


def test_stages_keep_the_columns_and_take_empty_tables(spark, documents):
    extra = documents.selectExpr("*", "1.5 as score", "'x' as lang_pred", "2 as n_tokens")
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, extra, SMALL).columns == extra.columns, name
        assert function(spark, extra.limit(0), SMALL).count() == 0, name
    assert stage("bpe")(spark, extra.limit(0), SMALL).count() == 0


def test_run(spark):
    found = corpus_pipeline.run(spark, SMALL)
    total = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert 0 < found.count() < total
    assert {"doc_id", "n_tokens", "token_ids"} <= set(found.columns)


def test_there_is_one_pipeline():
    stages = [p for p in Path(corpus_pipeline.__file__).parent.rglob("*.py") if "\nSTAGES = [" in p.read_text()]
    assert stages == [Path(corpus_pipeline.__file__)] and len(corpus_pipeline.STAGES) == 5
