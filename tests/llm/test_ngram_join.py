"""The n-gram join against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexforge.llm import ngram_join

SCHEMA = "doc_id long, text string"


def brute(rows, size=5, percent=75):
    """{(doc_id, n, component)} by comparing every two sets that share a shingle."""
    sets = []
    for _, text in rows:
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", small)
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set()))
    home = list(range(len(rows)))

    def top(i):
        while home[i] != i:
            i = home[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        near = {j for g in s for j in holders.get(g, ())}
        for j in near:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                a, b = top(i), top(j)
                home[max(a, b)] = min(a, b)
        for g in s:
            holders.setdefault(g, []).append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(least.get(top(i), key), key)
    return sorted(((key, len(s), None if key is None else least[top(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in ngram_join.similar_documents(df).collect()), key=str)


def edited(words, rate, rnd, vocabulary):
    return [rnd.choice(vocabulary) if rnd.random() < rate else w for w in words]


def test_groups_near_the_bound(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 120))]
        for _ in range(rnd.randint(1, 14)):
            rows.append(" ".join(edited(base, rnd.choice([0, 0.01, 0.02, 0.04, 0.06]), rnd, vocabulary)))
    # one passage in many texts, and a large group of near copies of one text
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows += [" ".join([rnd.choice(vocabulary) for _ in range(rnd.randint(20, 80))] + passage) for _ in range(60)]
    base = [rnd.choice(vocabulary) for _ in range(90)]
    rows += [" ".join(edited(base, 0.025, rnd, vocabulary)) for _ in range(120)]
    rnd.shuffle(rows)
    given = [(7 * i + 1, t) for i, t in enumerate(rows)]
    assert run(spark, given) == brute(given)


def test_defined_cases(spark):
    long = " ".join(f"x{i}" for i in range(3000))
    given = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, "a b c d e"), (8, "A b\tc d e"),
             (9, long), (10, long + " y"), (None, "a b c d e"), (None, None), (11, "É b c d e"), (12, "é b c d e"), (4, "one two")]
    assert run(spark, given) == brute(given)


def shared_ids(seed):
    """Texts, near copies of them and their copies, under ids that several of them share."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.randint(5, 90))] for _ in range(8)]
    texts = [" ".join(edited(rnd.choice(bases), rnd.choice([0, 0.01, 0.03]), rnd, vocabulary)) for _ in range(60)] + ["", None, "one two", " "]
    return [(rnd.choice([None, *range(-6, 25)]), rnd.choice(texts)) for _ in range(90)]


@pytest.mark.parametrize("seed", [0, 3])
def test_ids_shared_by_different_texts(spark, seed):
    rows = shared_ids(seed)
    assert run(spark, rows) == brute(rows)


def test_a_link_of_the_second_text_of_an_id(spark):
    first, second = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, first), (4, first), (4, second), (7, second + " more")]
    assert run(spark, rows) == [(1, 56, 1), (4, 56, 1), (4, 56, 4), (7, 57, 4)]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, kept)) == [(1, first), (4, second)]


@pytest.mark.parametrize("seed", [0])
def test_no_text_goes_unless_a_linked_one_stays(spark, seed):
    rows = shared_ids(10 + seed)
    kept = [tuple(r) for r in ngram_join.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    # all rows as brute-force vertices of their own, numbered so that the place tells the row
    whole = [(i, t if k is not None else None) for i, (k, t) in enumerate(rows)]
    component = {i: c for i, _, c in brute(whole)}
    empty = {i for i, n, _ in brute(whole) if n == 0}
    left = set(kept)
    assert sum(r[0] is None for r in kept) == sum(r[0] is None for r in rows)
    for i, row in enumerate(rows):
        if row[0] is not None:
            group = {rows[j] for j, c in component.items() if c == component[i]}
            assert len(group & left) == 1 and min((r[0] for r in group)) == next(iter(group & left))[0], row
            assert i not in empty or row in left
    own = [r for r in kept if r[0] is not None]
    assert len(own) == len(set(own))


def test_empty_table_and_other_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (2, "a b c d e f", 6, "y")], "doc_id long, text string, _h long, component_id string")
    assert sorted(tuple(r) for r in ngram_join.similar_documents(df).collect()) == [(1, 2, 1), (2, 2, 1)]


def test_one_of_each_keeps_columns(spark):
    rows = [(1, "a b c d e f", "p"), (2, "a b c d e f", "q"), (3, None, "r"), (3, None, "r"), (None, "a b c d e f", "s"), (4, "other words", "t")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, _gone string"))
    assert kept.columns == ["doc_id", "text", "_gone"]
    assert sorted((r.doc_id or 0, r["_gone"]) for r in kept.collect()) == [(0, "s"), (1, "p"), (3, "r"), (4, "t")]


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_documents(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").select("doc_id", "text")
    given = [tuple(r) for r in docs.collect()]
    assert sorted((tuple(r) for r in ngram_join.similar_documents(docs).collect()), key=str) == brute(given)


def test_bound_by_sizes(spark):
    """No pair that links is discarded: the least overlap seen is allowed for all sizes."""
    sizes = [(a, b) for a in range(1, 60) for b in range(a, 60)]
    rows = spark.createDataFrame(sizes, "a long, b long")
    for a, b, need, floor in rows.select("a", "b", F.ceil(F.lit(75) * (F.col("a") + F.col("b")) / 175).alias("need"),
                                         (F.ceil(F.lit(75) * F.col("b") / 100) - 1).alias("floor")).collect():
        links = [x for x in range(a + 1) if 100 * x >= 75 * (a + b - x)]
        assert not links or min(links) >= need
        assert floor == b - (b - -(-75 * b // 100) + 1)
