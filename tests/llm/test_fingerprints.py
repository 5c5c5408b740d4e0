"""Fingerprints against the exact likeness and a plain computation of the edits."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from lexforge.llm import fingerprints as fp


def exact(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return sum((x & y).values()) / sum((x | y).values())


def test_likeness_is_generalised_jaccard():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    left, right = [], []
    for _ in range(300):
        x = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 300))] + ["the"] * rnd.randint(0, 60)
        share = rnd.random()
        y = [w if rnd.random() < share else rnd.choice(vocabulary) for w in x] + ["the"] * rnd.randint(0, 30)
        left.append(" ".join(x))
        right.append(" ".join(y))
    (a, ea), (b, eb) = fp.fingerprint_rows(pa.array(left)), fp.fingerprint_rows(pa.array(right))
    off = fp.likeness(a, b, ea, eb) - np.array([exact(x, y) for x, y in zip(left, right)])
    assert abs(off.mean()) < 0.01
    assert off.std() < 1.25 * 0.5 / np.sqrt(fp.SAMPLES)


def test_weight_steps_follow_the_plain_rule():
    """Keys of heavy terms equal the rule of the docstring, term by term."""
    terms, weights = np.array([12345678901234567], dtype=np.uint64), np.array([7])
    for turn in fp._TURNS[:5]:
        place = int((terms * turn)[0] >> np.uint64(64 - fp.POOL_BITS))
        r, b = float(fp._R[place]), float(fp._B[place])
        t = np.floor(np.log(7) / r + b)
        y = np.exp(r * (t - b))
        key = np.exp(float(fp._LN_C[place])) / (y * np.exp(r))
        assert y <= 7 * 1.0001 and np.isclose(np.log(key), float(fp._LN_C[place]) - r * (t - b + 1))
    assert fp.samples(terms, weights, np.array([0, 1])).shape == (1, fp.SAMPLES)


def run(spark, rows, schema="doc_id long, text string", parts=3):
    return fp.with_edits(spark.createDataFrame(rows, schema).repartition(parts)).collect()


def test_edits_of_all_rows(spark):
    rnd = random.Random(1)
    rows = [(i * 3, "".join(rnd.choice("aé日 \n") for _ in range(rnd.randint(0, 50)))) for i in range(200)]
    rows += [(700, None), (701, ""), (702, "x " * 50_000)]
    rnd.shuffle(rows)
    got = {r.doc_id: r for r in run(spark, rows)}
    ordered = sorted((k, t or "") for k, t in rows)
    assert len(got) == len(rows)
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(text) // 4
        changed = text[:len(text) - n] + after[:n]
        assert got[key].n_chars == len(text)
        assert got[key].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= got[key].near_edited <= 1 and 0 <= got[key].near_next <= 1
        if text.split() and changed.split():
            assert abs(got[key].near_edited - exact(text, changed)) < 0.25
    same = {}
    for key, text in ordered:
        assert same.setdefault(text, got[key].fingerprint) == got[key].fingerprint


def test_defined_cases(spark):
    assert run(spark, []) == []
    (one,) = run(spark, [(5, "a b c d")])
    assert one.near_next == 1.0 and one.n_chars == 7 and one.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest()
    rows = [(None, "b c"), (1, None), (1, "x y"), (2, None), (3, "")]
    got = run(spark, [(a, b, 1) for a, b in rows], "doc_id long, text string, fingerprint int")
    assert len(got) == 5 and {r.near_next for r in got if r.doc_id == 2} == {1.0}


def test_fingerprints_keep_columns(spark):
    df = spark.createDataFrame([(1, "a b", "old"), (2, "a b", "z")], "doc_id long, text string, fingerprint string")
    rows = fp.fingerprints(df).collect()
    assert rows[0].fingerprint == rows[1].fingerprint != "old"
