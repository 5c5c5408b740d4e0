"""The pipeline: each stage against its operator's brute force, and what the kept corpus looks like."""

import re

import corpus_pipeline
import numpy as np
import pytest

from lexforge.llm import queries
from test_ngram_join import brute
from test_secrets import plain
from test_tokens import check_pieces, library  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "stage")
        out.append(docs)
    return [spark.read.parquet(f"{SF}/documents.parquet"), *out]


def test_columns(stages):
    assert [len(corpus_pipeline.STAGES), queries.LLM["pipeline"].sql] == [5, corpus_pipeline.ORACLE_SQL]
    for docs in stages[1:5]:
        assert docs.schema.simpleString() == stages[0].schema.simpleString()


def test_good_documents_stay(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    assert len(good - kept) <= 0.005 * len(good) and len(bad & kept) <= 0.4 * len(bad)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(key for key, _, least in brute(rows) if key == least)


def test_passages_go_once(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    assert set(before) == set(after)
    seen = set()
    for key in sorted(after):
        words = re.findall(r"\S+", after[key].lower())
        runs = {tuple(words[i:i + 50]) for i in range(len(words) - 49)}
        assert len(runs & seen) <= 0.01 * max(len(runs), 100)
        seen |= runs
    changed = [k for k in before if before[k] != after[k]]
    assert changed and len(changed) < 0.3 * len(before)
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_no_secret_is_left(stages):
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r.text for r in stages[4].collect()}
    assert sum(len(plain(t)) for t in before.values()) > 5 and not any(plain(t) for t in after.values())
    assert all(before[k] == after[k] for k in before if not plain(before[k]) and "[secret]" not in after[k])


def test_all_tokens_are_packed(stages, library):  # noqa: F811
    docs = [(r.doc_id, r.text) for r in stages[4].collect()]
    whole = check_pieces(stages[5].collect(), docs, library, 4096)
    assert np.count_nonzero(np.array(whole) == 2) >= len(docs)


def test_stage_cuts_passages_that_the_smallest_text_does_not_hold(spark):
    """A passage of one word, and one beside words that stand elsewhere in the other text, leave the larger text in the stage."""
    own = lambda name, n: [f"{name}x{i}" for i in range(n)]
    docs = {key: own(f"a{key}", 60) + ["z"] * times + own(f"b{key}", 60) for key, times in [(101, 80), (102, 120)] + [(k, 49) for k in range(12)]}
    passage, before = own("p", 50), own("q", 5)
    docs[201] = passage + own("c", 200) + before + passage[:4]
    docs[202] = before + passage + own("d", 30)
    rows = [(k, " ".join(v), "en", "web", len(" ".join(v))) for k, v in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    after = {r.doc_id: r for r in corpus_pipeline.without_repeated_passages(spark, df, SF).collect()}
    want = docs | {102: own("a102", 60) + own("b102", 60), 202: before + own("d", 30)}
    assert {k: r.text.split() for k, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for r in after.values())
