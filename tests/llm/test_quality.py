"""The quality classifier against a plain Kneser-Ney model, and its verdicts against labels."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexforge.llm import quality


def plain_model(trained, order):
    """A function from an n-gram (bytes) to its interpolated modified Kneser-Ney probability."""
    counts = {order: Counter()}
    for text in trained:
        raw = b"\0" * (order - 1) + text.encode()
        counts[order].update(raw[i:i + order] for i in range(len(raw) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    taken, totals, left = {}, defaultdict(int), defaultdict(float)
    for k, table in counts.items():
        n = [sum(c == i for c in table.values()) for i in range(1, 5)]
        if n[0] and n[1] and n[2]:
            y = n[0] / (n[0] + 2 * n[1])
            d = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
            taken[k] = [min(max(x, 0.0), i + 1.0) for i, x in enumerate(d)]
        else:
            taken[k] = [0.5, 0.75, 0.75]
        for g, c in table.items():
            totals[k, g[:-1]] += c
            left[k, g[:-1]] += taken[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k, c = len(g), counts[len(g)][g]
        if not totals[k, g[:-1]]:
            return p(g[1:])
        return (max(c - taken[k][min(c, 3) - 1], 0.0) if c else 0.0) / totals[k, g[:-1]] + left[k, g[:-1]] / totals[k, g[:-1]] * p(g[1:])

    return p


def texts(n=60):
    rnd = random.Random(9)
    syllables = ["en", "die", "schä", "ße", "the", "tion", "é", " ", " ", ". "]
    return ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 4])
def test_grams_are_those_of_the_bytes(order):
    given = ["abcab", "", "é", "x" * 9, None]
    kinds, ids, offsets = quality.grams(pa.array(given), order)
    for i, text in enumerate(given):
        raw = b"\0" * (order - 1) + (text or "").encode()
        want = [int.from_bytes(raw[j:j + order], "big") for j in range(len(raw) - order + 1)]
        assert kinds[ids[offsets[i]:offsets[i + 1]]].tolist() == want
    assert (np.diff(kinds) > 0).all()


@pytest.mark.parametrize("order, block, rows_sent", [(3, 300, 0), (4, 1 << 20, 0), (4, 300, 10**6)])
def test_perplexity_equals_the_plain_model(spark, order, block, rows_sent, monkeypatch):
    """Both with the model sent to the tasks and with its shards joined to blocks."""
    monkeypatch.setattr(quality, "MODEL_ROWS", rows_sent)
    given = texts()
    rows = [(i, t, ["de", "en", None][i % 3], 1) for i, t in enumerate(given)] + [(900, "ZZ!!%%", "xx", 0), (901, None, "de", 0), (902, "", "en", 0), (None, "die", None, 0)]
    labels = [(i, int(i % 2 == 0)) for i in range(40)] + [(0, 1), (2, 0), (None, 1), (950, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity int").repartition(3)
    out = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"), order=order, block_bytes=block).collect()
    trained = [t for i, t in enumerate(given) if i < 40 and i % 2 == 0 and i != 2]
    p = plain_model(trained, order)
    assert len(out) == len(rows)
    text_of = {r[0]: r[1] for r in rows}
    for r in out:
        text = text_of[r.doc_id]
        if not text:
            assert r.perplexity is None and not r.accepted
            continue
        raw = b"\0" * (order - 1) + text.encode()
        logs = [math.log(p(raw[i:i + order])) for i in range(len(raw) - order + 1)]
        assert math.isclose(r.perplexity, math.exp(-sum(logs) / len(logs)), rel_tol=1e-9)
        assert r.trusted == (text in trained and r.doc_id is not None and r.doc_id < 40)
    assert not next(r for r in out if r.doc_id == 900).accepted


def test_probabilities_sum_to_one():
    p = plain_model(texts(), 3)
    assert math.isclose(sum(p(b"en" + bytes([b])) for b in range(256)), 1.0, rel_tol=1e-9)


def test_labels_of_documents(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    verdicts = quality.classify(docs, labels)
    rows = verdicts.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("accepted").cast("int")).alias("a")).collect()
    share = {r.quality: r.a for r in rows}
    assert share[1] >= 0.995 and share[0] <= 0.4
    kept = quality.accepted(docs, verdicts)
    assert kept.columns == docs.columns and kept.count() == verdicts.filter("accepted").count()


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, "en"), (2, "a", None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r.doc_id, r.lang, r.accepted) for r in quality.classify(docs, none).collect()} == {(1, "en", True), (2, "en", False), (2, None, True)}
    assert quality.accepted(docs, quality.classify(docs, none)).count() == 2
    assert quality.classify(docs.limit(0), none).collect() == []
