"""Periodic runs against plain extension of every pair of places."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lexforge.llm import periodic


def plain_runs(x, least_length=6, least_exponent=4):
    """All (start, length, period): each period extends each place as far as it goes; of equal stretches the smallest period counts."""
    found = {}
    n = len(x)
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j > i:
                if j + q - i >= max(least_length, least_exponent * q):
                    found.setdefault((i, j + q - i), q)
                i = j
            else:
                i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def lists(seed, n=60):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rnd.randrange(5)
        size = rnd.randint(0, 120)
        if kind == 0:
            x = [rnd.randrange(2) for _ in range(size)]
        elif kind == 1:
            x = [rnd.randrange(1000) for _ in range(size)]
        elif kind == 2:
            unit = [rnd.randrange(3) for _ in range(rnd.randint(1, 9))]
            x = [7] * rnd.randint(0, 9) + unit * rnd.randint(1, 12) + unit[:rnd.randint(0, len(unit))] + [8, 9] * rnd.randint(0, 4)
        elif kind == 3:  # runs inside runs
            unit = [1] * rnd.randint(4, 9) + [2] * rnd.randint(1, 7)
            x = unit * rnd.randint(3, 9) + unit[:3]
        else:
            x = [3] * size
        out.append(np.array(x, dtype=np.int32))
    return out


@pytest.mark.parametrize("options", [(6, 4), (1, 2), (6, 3), (20, 4)])
@pytest.mark.parametrize("seed", range(5))
def test_runs_equal_plain_extension(seed, options):
    texts = lists(seed)
    row, start, length, period = periodic.find_runs(texts, *options)
    got = list(zip(row.tolist(), start.tolist(), length.tolist(), period.tolist()))
    assert got == [(i, *r) for i, x in enumerate(texts) for r in plain_runs(x.tolist(), *options)]


@pytest.mark.parametrize("seed", range(6))
def test_grammar_agrees_with_the_letters(seed):
    rnd = random.Random(seed)
    x = [-1, *[rnd.randrange(1 + seed) for _ in range(200)], *([0, 1, 0] * 20), *[0] * 50, -2]
    grammar = periodic.Grammar(np.array(x))
    pairs = [(i, j) for i in range(1, len(x) - 1) for j in range(i + 1, len(x) - 1, 7)]
    i, j = (np.array(p) for p in zip(*pairs))
    ahead, back = grammar.agree(i, j), grammar.agree(i, j, backwards=True)
    for (a, b), f, r in zip(pairs, ahead.tolist(), back.tolist()):
        assert x[a:a + f] == x[b:b + f] and x[a + f] != x[b + f]
        assert x[a - r + 1:a + 1] == x[b - r + 1:b + 1] and x[a - r] != x[b - r]


def test_long_texts():
    """20,000 equal words, a long period, and words that grow apart."""
    unit = list(range(5000))
    texts = [np.zeros(20_000, np.int32), np.array(unit * 4 + unit[:17]), np.array([w for i in range(200) for w in [0] * i + [1]])]
    row, start, length, period = periodic.find_runs(texts)
    got = list(zip(row.tolist(), start.tolist(), length.tolist(), period.tolist()))
    assert got[:2] == [(0, 0, 20_000, 1), (1, 0, 20_017, 5000)]
    assert [g[1:] for g in got[2:]] == [(i * (i - 1) // 2 + i, i, 1) for i in range(6, 200)]


def digests(doc, text):
    """The row of a document by plain words alone."""
    words = text.encode().split() if text else []
    n, h = len(words), zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 200)))) for i in range(200)]
    rows += [(1, "z\t" * 50), (1, "z\t" * 50), (2, "Z z " * 9), (3, None), (None, "q " * 7), (None, None), (4, ""), (5, " \n\x0b"), (6, "a b " * 9), (7, "é \x0cé " * 9),
             (8, "a b c " * 4 + "d d d d d d d " * 5)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, runs int, _key int").repartition(3)
    found = periodic.periodic_runs(df, edit=periodic.periodic_tail)
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in periodic.run_digests(found).collect()]
    assert sorted(got, key=str) == sorted((digests(*r) for r in rows), key=str)
    assert periodic.periodic_runs(df.limit(0)).collect() == []


def test_documents(spark):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if len(r.text) < 4000]
    df = spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id long, text string")
    got = [tuple(r) for r in periodic.run_digests(periodic.periodic_runs(df, edit=periodic.periodic_tail)).collect()]
    assert sorted(got) == sorted(digests(r.doc_id, r.text) for r in docs) and any(r[1] for r in got)


def test_runs_without_an_edit(spark):
    df = spark.createDataFrame([(0, "x " + "b c " * 4 + "y")], "doc_id long, text string")
    row, = periodic.periodic_runs(df).collect()
    assert row.runs == [(1, 8, 2)] and row.collapsed == "x b c y"
    with pytest.raises(ValueError):
        periodic.find_runs([], least_exponent=1)
