"""Line deduplication against a plain dictionary of lines."""

import hashlib
import random

import numpy as np
import pytest

from lexforge.llm import lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key_of(line):
    return line.strip(SPACE).translate(LOWER)


def plain(rows, least_chars=40, least_docs=5):
    """[(doc_id, n_lines, n_dropped, text)] by a dictionary over all rows; a row is a document."""
    held = {}
    for doc, text in rows:
        for key in {key_of(line) for line in (text or "").split("\n")}:
            if len(key) >= least_chars:
                held.setdefault(key, []).append(float("-inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        own = float("-inf") if doc is None else doc
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(held.get(key_of(x), ())) < least_docs or max(held[key_of(x)]) <= own]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(13)
    common = ["x" * 39, "y" * 40, "  Mixed CASE line of forty characters or more \t", "mixed case line of forty characters or more", "ä" * 40, "Ä" * 40, "é" * 39 + " ",
              "z" * 5000, " " + "w" * 39, "🙂" * 40, "\r" + "v" * 41 + "\x0b"]
    rows = [(i, "\n".join(rnd.choice([*common, f"own line {i} " + "o" * rnd.randint(0, 60), ""]) for _ in range(rnd.randint(0, 12)))) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (7, None), (None, "y" * 40), (None, "n" * 44), (None, ""), (400, None), (401, ""), (402, "\n"), (403, "\n\n" + "y" * 40 + "\n")]
    return rows + [(None, "n" * 44)] * 6 + [(900, "t" * 50 + "\nend")] * 6 + [(-5, "u" * 50)] * 4


def run(spark, rows, parts=5, **options):
    df = spark.createDataFrame([(a, b, "k") for a, b in rows], "doc_id long, text string, _gone string").repartition(parts)
    out = lines.without_repeated_lines(df, **options)
    assert out.columns == ["doc_id", "text", "_gone", "n_lines", "n_dropped"]
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()], key=str)


@pytest.mark.parametrize("options", [{}, {"least_docs": 1}, {"least_chars": 1, "least_docs": 2}, {"least_chars": 5000, "least_docs": 3}])
def test_lines_equal_the_plain_way(spark, options):
    rows = corpus()
    assert run(spark, rows, **options) == plain(rows, **options)


def test_one_block_a_document_and_many_shards(spark, monkeypatch):
    """Blocks of one document, shards of few keys: counts and hits come together from everywhere."""
    monkeypatch.setattr(lines, "BLOCK_KEYS", 1)
    monkeypatch.setattr(lines, "SHARD_KEYS", 3)
    rows = corpus()
    assert run(spark, rows) == plain(rows)


def test_one_line_in_all_documents(spark):
    """A line of all documents is one row a block: no task reads it once for each document."""
    rows = [(i, f"{'c' * 60}\nown {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    counted = lines.line_counts(lines.hashed_lines(df))
    assert counted.select("_n", "_last").collect() == [(4000, 3999)]
    assert run(spark, rows) == plain(rows)


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (1, ""), (None, None)]) == plain([(1, None), (1, ""), (None, None)])
    with pytest.raises(ValueError):
        lines.line_index(None, 1, 1 << 16)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 50_000])
def test_perfect_hash(n):
    rnd = np.random.default_rng(n)
    a, b = (rnd.integers(0, 1 << 62, n, dtype=np.uint64) for _ in range(2))
    a[: n // 3] = 5  # keys may share one half
    keys = lines.PerfectHash.of(a, b)
    assert sorted(keys.slots(a, b).tolist()) == list(range(n))
    assert n < 1000 or len(keys.bits) * 8 < 4 * n
    counts = rnd.integers(1, 100_000, n)
    shard = lines.Shard.unpacked(lines.Shard.of(a, b, counts, b.view(np.int64), 50_000).packed(), 50_000)
    which, last = shard.probe(a, b)
    assert which.tolist() == np.flatnonzero(counts >= 50_000).tolist() and (last == b[which].view(np.int64)).all()
    foreign = rnd.integers(0, 1 << 62, 20_000, dtype=np.uint64)
    assert not len(shard.probe(foreign, foreign)[0])


def test_digests(spark):
    df = spark.createDataFrame([(1, None), (2, "a\nb")], "doc_id long, text string")
    got = {tuple(r) for r in lines.line_digests(lines.without_repeated_lines(df)).collect()}
    assert got == {(1, 1, 0, hashlib.sha256(b"").hexdigest()), (2, 2, 0, hashlib.sha256(b"a\nb").hexdigest())}
