"""Learned readings against a plain model and planted readings."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexforge.functions.symbols import characters
from lexforge.operators import joins
from lexforge.plans import learned
from lexforge.plans.learned import learn_readings, splits

SYMBOLS = "KHTS"


def plain_splits(word, reading, longest):
    if not word:
        return [[]] if not reading else []
    sizes = range(1, longest + 1) if word[0] in SYMBOLS else [1] if reading[:1] == word[0] else []
    return [[reading[:k], *rest] for k in sizes if k <= len(reading) for rest in plain_splits(word[1:], reading[k:], longest)]


def plain_shares(rows, longest, rounds):
    ways = {(w, r): [[(c, p) for c, p in zip(w, s) if c in SYMBOLS] for s in plain_splits(w, r, longest)] for w, r, _ in rows}
    shares = defaultdict(lambda: 1.0)
    for _ in range(rounds + 1):
        counts = defaultdict(float)
        for w, r, n in rows:
            weights = []
            for way in ways[w, r]:
                x = 1.0
                for pair in way:
                    x *= shares[pair]
                weights.append(x)
            for way, x in zip(ways[w, r], weights):
                for pair in way:
                    counts[pair] += n * x / sum(weights)
        total = defaultdict(float)
        for (c, _), n in counts.items():
            total[c] += n
        shares = {pair: n / total[pair[0]] for pair, n in counts.items()}
    return counts, shares


READINGS = {"K": ["ka", "kura"], "H": ["hi", "bo"], "T": ["tsu"], "S": ["sa", "me"]}


def corpus():
    rnd = random.Random(7)
    rows = {}
    for _ in range(160):
        word = "".join(rnd.choice(SYMBOLS + "xy") for _ in range(rnd.randint(1, 4)))
        if set(word) & set(SYMBOLS):
            rows[word, "".join(rnd.choice(READINGS[c]) if c in SYMBOLS else c for c in word)] = rnd.randint(1, 9)
    return [(w, r, n) for (w, r), n in rows.items()]


def learn(spark, rows, **options):
    df = spark.createDataFrame([*rows, ("xy", "xy", 5), ("K", None, 5), ("K", "ka", None), ("K", "ka", 0), ("H", "", 2), (None, "a", 1)], "w string, r string, n int").repartition(3)
    return {(r.symbol, r.part): (r["count"], r.share) for r in learn_readings(df, "w", "r", "n", f"[{SYMBOLS}]", **options).collect()}


@pytest.mark.parametrize("large", [False, True])
def test_learning_equals_the_plain_model(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(joins, "HOT_ROWS", 5)
    rows = corpus()
    got = learn(spark, rows, rounds=3, tolerance=0.0)
    counts, shares = plain_shares(rows, 4, 3)
    assert set(got) == set(counts)
    for pair, (count, share) in got.items():
        assert abs(count - counts[pair]) < 1e-6 and abs(share - shares[pair]) < 1e-9, pair


def test_rounds_of_few_pairs_shuffle_no_ways(spark, monkeypatch):
    """Pairs that fit a broadcast go to the ways: no round joins ways, and what is shuffled are sums of each task."""
    monkeypatch.setattr(learned, "_counted_by_joins", None)
    sent = []
    counted = learned._counted
    monkeypatch.setattr(learned, "_counted", lambda *a: sent.append(counted(*a)) or sent[-1])
    learn(spark, corpus(), rounds=2, tolerance=0.0)
    assert len(sent) == 3 and not any("Join" in c._jdf.queryExecution().optimizedPlan().toString() for c in sent)


def test_planted_readings_are_found(spark):
    got = learn(spark, corpus(), rounds=12)
    for c, readings in READINGS.items():
        best = sorted((p for s, p in got if s == c), key=lambda p: -got[c, p][1])[:len(readings)]
        assert sorted(best) == sorted(readings), (c, best)
        assert sum(got[c, p][1] for p in readings) > 0.9
    assert all(abs(sum(v[1] for (s, _), v in got.items() if s == c) - 1) < 1e-9 for c in READINGS)


def test_splits(spark):
    rows = [(w, r) for w, r, _ in corpus()[:40]] + [("KH", "abcdefgh"), ("KH", "abcdefghi"), ("K", ""), ("xK", "yka"), ("x", "x")]
    df = spark.createDataFrame(rows, "w string, r string")
    for r in df.select("w", "r", splits(characters(F.col("w")), F.col("r"), f"[{SYMBOLS}]").alias("s")).collect():
        assert sorted(r.s) == sorted(plain_splits(r.w, r.r, 4)), (r.w, r.r)


def test_learning_from_nothing(spark):
    assert learn_readings(spark.createDataFrame([], "w string, r string, n int"), "w", "r", "n", "[K]").collect() == []
