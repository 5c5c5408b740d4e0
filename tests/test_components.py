"""Closure, inverted index, words in texts, endings and cascades against plain models."""

import random

import pytest
from pyspark.sql import functions as F

from lexforge.operators import joins, matching, nesting
from lexforge.operators.cascade import cascade_join
from lexforge.operators.closure import carried, closure
from lexforge.operators.inverted import holding_all, posting_lists
from lexforge.operators.matching import longest_matches, texts_of_words, words_in_texts
from lexforge.plans.inflection import deinflect


@pytest.fixture(params=[False, True], ids=["small", "large"])
def bounds(request, monkeypatch):
    """Once as on small tables, once with nothing sent to the tasks and every key hot."""
    if request.param:
        monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(joins, "HOT_ROWS", 3)


def plain_closure(edges, most=10**9):
    out = {}
    nodes = {a for a, _ in edges}
    for start in nodes:
        level, depth = {start}, 0
        while level and depth < most:
            depth += 1
            level = {b for a, b in edges if a in level} - {b for (s, b) in out if s == start}
            out |= {(start, b): depth for b in level}
    return {(a, b, d) for (a, b), d in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_closure(spark, bounds, seed):
    rnd = random.Random(seed)
    edges = {(rnd.randrange(14), rnd.randrange(14)) for _ in range(18)} | {(20, 21), (21, 22), (22, 20), (30, 30)} | {(40 + i, 99) for i in range(20)} | {(99, 100)}
    rows = [*edges, *list(edges)[:5], (None, 1), (1, None)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(3)
    assert {tuple(r) for r in closure(df, "a", "b").collect()} == plain_closure(edges)
    assert {tuple(r) for r in closure(df, "a", "b", "steps", most=2).collect()} == plain_closure(edges, 2)


def test_closure_of_nothing(spark):
    assert closure(spark.createDataFrame([], "a int, b int"), "a", "b").collect() == []


def test_carried_values(spark, bounds):
    """Each node once per item, however many ways lead to it; nodes without a value count as such."""
    edges = spark.createDataFrame([("x", "y"), ("x", "z"), ("y", "w"), ("z", "w"), ("w", "x")], "a string, b string")
    items = spark.createDataFrame([(1, "y"), (1, "y"), (1, "w"), (2, "q"), (3, "z"), (None, "z")], "word int, node string")
    values = spark.createDataFrame([("x", 1), ("y", 2), ("w", 6)], "node string, rank int")
    got = {r.word: tuple(r)[1:] for r in carried(items, "word", "node", edges, "a", "b", values, "rank",
                                               [F.count("*").alias("n"), F.min("rank").alias("least"), F.avg("rank").alias("mean")]).collect()}
    assert got == {1: (4, 1, 3.0), 2: (1, None, None), 3: (4, 1, 3.0), None: (4, 1, 3.0)}


def test_nodes_are_made_once(spark):
    """What several steps read of the items and their nodes is written, not made again for each."""
    edges, values = spark.createDataFrame([("x", "y")], "a string, b string"), spark.createDataFrame([("y", 1)], "node string, rank int")
    found = carried(spark.createDataFrame([(1, "x")], "word int, node string"), "word", "node", edges, "a", "b", values, "rank", [F.count("*").alias("n")])
    assert [tuple(r) for r in found.collect()] == [(1, 2)]
    assert any("/nodes-" in f for f in found.inputFiles())


def test_component_search(spark, bounds):
    rnd = random.Random(3)
    # component 0 is in all symbols, and one symbol holds none but it
    held = {s: {0} | {c for c in range(1, 12) if rnd.random() < 1 / c} for s in range(120)}
    rows = [(s, c) for s, cs in held.items() for c in cs] + [(None, 1), (1, None), (5, 0)]
    lists = posting_lists(spark.createDataFrame(rows, "symbol int, component int").repartition(3), "symbol", "component", part_rows=17)
    flat = {}
    for r in sorted(lists.collect(), key=lambda r: (r.component, r.part)):
        flat.setdefault(r.component, []).extend(r["keys"])
        assert len(r["keys"]) <= 17 and r.n == sum(r.component in cs for cs in held.values())
    assert flat == {c: sorted(s for s in held if c in held[s]) for c in range(12)}
    asked = {"one": [0], "two": [3, 1], "many": [0, 1, 2, 3], "unknown": [1, 77], "rare": [11, 0], "none": [None], "all": list(range(12))}
    queries = spark.createDataFrame([(q, c) for q, cs in asked.items() for c in [*cs, cs[0]]], "q string, component int")
    got = {}
    for r in holding_all(lists, queries, "q", "symbol", "component").collect():
        assert r.symbol not in got.setdefault(r.q, set())
        got[r.q].add(r.symbol)
    want = {q: {s for s in held if set(cs) <= held[s]} for q, cs in asked.items()}
    assert got == {q: s for q, s in want.items() if s}
    assert holding_all(lists, queries.limit(0), "q", "symbol", "component").collect() == []


def plain_words(text, words):
    out, at = [], 0
    while at < len(text):
        best = max((w for w in words if w and text.startswith(w, at)), key=len, default=None)
        if best:
            out.append((at, best))
        at += len(best) if best else 1
    return out


def test_words_in_texts(spark, bounds):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("ab日") for _ in range(rnd.randint(1, 9))) for _ in range(40)} | {"a", "🙂b"}
    texts = {i: "".join(rnd.choice("ab日🙂c") for _ in range(rnd.randint(0, 60))) for i in range(60)} | {100: "a" * 200, 101: "", 102: None}
    df = spark.createDataFrame([*texts.items(), (None, "a")], "id int, text string").repartition(3)
    heads = spark.createDataFrame([(w,) for w in [*words, "a", "", None]], "w string")
    got = {}
    for r in words_in_texts(df, "id", "text", heads, "w").collect():
        got.setdefault(r.id, []).append((r.at, r.w))
    want = {i: plain_words(t, words) for i, t in texts.items() if t}
    assert {i: sorted(m) for i, m in got.items()} == {i: m for i, m in want.items() if m}
    lists = {}
    for r in sorted(texts_of_words(df, "id", "text", heads, "w", part_rows=7).collect(), key=lambda r: (r.w, r.part)):
        lists.setdefault(r.w, []).extend(r.texts)
    assert lists == {w: sorted(i for i, m in want.items() if w in {x for _, x in m}) for w in lists} and set(lists) == {w for m in want.values() for _, w in m}
    assert words_in_texts(df, "id", "text", heads.limit(0), "w").collect() == []


def test_a_text_meets_few_words(spark):
    """Of 5,000 words that share their first two letters a place meets those of its own beginning, not all."""
    heads = spark.createDataFrame([(f"ab{i:05d}x",) for i in range(5000)], "w string")
    df = spark.createDataFrame([(1, "ab00017x" * 50)], "id int, text string")
    found = words_in_texts(df, "id", "text", heads, "w")
    assert found.count() == 50
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("characters, shard", [(40, 3), (1 << 20, 5), (40, 1000)])
def test_blocks_and_shards(spark, monkeypatch, characters, shard):
    """Texts in small blocks and words in small shards find what all of them find at once; a word may be longer than 255 characters."""
    monkeypatch.setattr(matching, "BLOCK_CHARACTERS", characters)
    monkeypatch.setattr(matching, "SHARD_WORDS", shard)
    monkeypatch.setattr(matching, "LISTED", 16)
    rnd = random.Random(9)
    words = {"".join(rnd.choice("ab🙂") for _ in range(rnd.randint(1, 9))) for _ in range(30)} | {"ab" * 200}
    texts = {i: "".join(rnd.choice("ab🙂c") for _ in range(rnd.randint(1, 40))) for i in range(20)} | {100: "c" + "ab" * 450, 101: "c"}
    df = spark.createDataFrame([*texts.items(), *texts.items()], "id int, text string").repartition(3)
    got = {}
    for r in words_in_texts(df, "id", "text", spark.createDataFrame([(w,) for w in words], "w string"), "w").collect():
        got.setdefault(r.id, []).append((r.at, r.w))
    want = {i: plain_words(t, words) for i, t in texts.items()}
    assert {i: sorted(m) for i, m in got.items()} == {i: m for i, m in want.items() if m}


def test_places_of_texts_do_not_become_rows(spark):
    """What is shuffled for a text is the text, not a row for each of its places."""
    df = spark.createDataFrame([(1, "ab00017x" * 500)], "id int, text string")
    plan = words_in_texts(df, "id", "text", spark.createDataFrame([("ab00017x",)], "w string"), "w")._jdf.queryExecution().optimizedPlan().toString()
    assert "char_length(_text" not in plan and "Join" not in plan


def test_a_task_collects_few_long_lists(spark, monkeypatch):
    """Lists are collected in as many tasks as their rows ask for, whatever the shuffle would choose."""
    monkeypatch.setattr(nesting, "TASK_ROWS", 100)
    df = spark.createDataFrame([(i % 40, i) for i in range(4000)], "k int, v int")
    lists = nesting.nest(df, "k", F.col("v"), "vs", part_rows=50)
    assert lists.rdd.getNumPartitions() == 40
    assert sorted((r.k, r.part, r.vs) for r in lists.collect()) == [(k, p, list(range(k, 4000, 40))[50 * p:50 * p + 50]) for k in range(40) for p in range(2)]


def test_longest_matches_of_nothing(spark):
    assert spark.range(1).select(longest_matches(F.array().cast("array<struct<at:int,size:int,word:string>>"))).first()[0] == []


@pytest.mark.parametrize("word, base, steps", [
    ("食べる", "食べる", 0), ("食べました", "食べる", 3), ("飲んだ", "飲む", 1), ("書いて", "書く", 2), ("高くない", "高い", 1), ("走りませんでした", "走る", 4), ("行きたい", "行く", 2),
    ("ます", "ます", None), ("猫", "猫", None), ("かった", "かった", None)])
def test_japanese_base_forms(spark, word, base, steps):
    heads = spark.createDataFrame([(w,) for w in ["食べる", "飲む", "書く", "高い", "走る", "行く", None]], "head string")
    words = spark.createDataFrame([(word,), (word,), (None,)], "w string")
    assert [tuple(r) for r in deinflect(words, "w", heads, "head", most=5).collect()] == [(word, base, steps)]


def test_base_forms_equal_a_plain_search(spark, bounds):
    rnd = random.Random(9)
    endings = [("s", ""), ("es", ""), ("", "a"), ("ab", "b"), ("b", "ab"), ("aa", "")]
    heads = {"".join(rnd.choice("abs") for _ in range(rnd.randint(1, 4))) for _ in range(15)}
    words = {"".join(rnd.choice("abes") for _ in range(rnd.randint(1, 6))) for _ in range(120)}

    def plain(word):
        forms = {word}
        for step in range(4):
            if forms & heads:
                return (word, min(forms & heads), step)
            forms = {f[:len(f) - len(a)] + b for f in forms for a, b in endings if f.endswith(a) and len(f) > len(a)}
        return (word, word, None)

    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = deinflect(df, "w", spark.createDataFrame([(h,) for h in heads], "head string"), "head", endings, 3)
    assert {tuple(r) for r in got.collect()} == {plain(w) for w in words}
    assert {tuple(r)[1:] for r in deinflect(df, "w", df.limit(0).toDF("head"), "head", [], 3).collect()} == {(w, None) for w in words}


def test_cascade(spark, bounds):
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "q", "b"), (3, "q", None), (4, None, "c"), (5, "b", "a"), (6, "n", "a"), *[(7, "z", "hot")] * 20]
    df = spark.createDataFrame(rows, "id int, k1 string, k2 string").repartition(3)
    lookup = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30), ("n", None), ("hot", 40), (None, 50)], "key string, v int")
    got = sorted((tuple(r) for r in cascade_join(df, lookup, ["k1", "k2"], "key").collect()), key=str)
    want = [(1, "a", "x", 10, 0)] * 2 + [(2, "q", "b", 20, 1), (3, "q", None, None, None), (4, None, "c", 30, 1), (5, "b", "a", 20, 0), (6, "n", "a", None, 0)] + [(7, "z", "hot", 40, 1)] * 20
    assert got == sorted(want, key=str)
    with pytest.raises(ValueError):
        cascade_join(df, lookup, [], "key")
