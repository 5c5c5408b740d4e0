"""Readings with sound changes, against a plain search of all ways."""

import random

import pytest
from pyspark.sql import functions as F

from lexforge.plans import sounds
from lexforge.plans.sounds import FIRST, LAST, SoundChange

LATIN = [SoundChange(FIRST, "k", "g", 1), SoundChange(FIRST, "h", "b", 1), SoundChange(FIRST, "h", "p", 2), SoundChange(LAST, "tu", "t", 1), SoundChange(LAST, "u", "", 2)]


def plain_variants(readings, changes):
    """{(reading, first, last): cost}"""
    out = {(r, False, False): 0 for r in readings if r}
    for place in (FIRST, LAST):
        for (r, first, last), cost in list(out.items()):
            for c in changes:
                if c.place != place:
                    continue
                if place == FIRST and r.startswith(c.old):
                    new, key = c.new + r[len(c.old):], (True, last)
                elif place == LAST and r.endswith(c.old):
                    new, key = r[:len(r) - len(c.old)] + c.new, (first, True)
                else:
                    continue
                if new:
                    out[new, *key] = min(out.get((new, *key), 99), cost + c.cost)
    return out


def plain_best(word, reading, candidates, changes, symbols, unknown=10, longest=4):
    """(cost, path) by trying everything."""
    if reading is None:
        return None
    ways = [(0, 0, [])]
    for i, c in enumerate(word):
        new = []
        for cost, used, path in ways:
            rest = reading[used:]
            if c in symbols:
                options = [(v, n) for (v, first, last), n in plain_variants(candidates.get(c, []), changes).items()
                           if not (first and i == 0) and not (last and i == len(word) - 1) and rest.startswith(v)]
                options += [(rest[:k], unknown + k) for k in range(1, min(longest, len(rest)) + 1)]
            else:
                options = [(c, 0)] if rest.startswith(c) else []
            new += [(cost + n, used + len(v), [*path, v]) for v, n in options]
        ways = new
    ends = [(cost, path) for cost, used, path in ways if used == len(reading)]
    return min(ends) if ends else None


def test_cheapest_of_all_ways(spark):
    rnd = random.Random(4)
    symbols = "KHTX"
    candidates = {"K": ["ka", "kutu", "u", "", "ka"], "H": ["ha", "hu", "hatu"], "T": ["tu", "t", "atu"]}
    rows = {}
    for _ in range(250):
        word = "".join(rnd.choice("KHT" * 4 + "Xab") for _ in range(rnd.randint(1, 5)))
        pieces = [rnd.choice([v for v, *_ in plain_variants(candidates.get(c, ["zz"]), LATIN)]) if c in symbols else c for c in word]
        if rnd.random() < 0.3:
            pieces[rnd.randrange(len(pieces))] = "".join(rnd.choice("katub") for _ in range(rnd.randint(0, 5)))
        rows[word] = "".join(pieces)
    rows |= {"K": "", "KK": None, "X": "abcdefgh", "aKb": "xkay"}
    words = spark.createDataFrame(list(rows.items()), "w string, r string").repartition(3)
    table = spark.createDataFrame(list(candidates.items()), "symbol string, readings array<string>")
    got = {r.w: r for r in sounds.align_by_cost(words, table, "w", "r", LATIN, symbol=f"[{symbols}]").collect()}
    assert set(got) == {w for w in rows if set(w) & set(symbols)}
    exact = 0
    for word, row in got.items():
        best = plain_best(word, rows[word], candidates, LATIN, symbols)
        assert row.cost == (best[0] if best else None), word
        if best:
            exact += best[0] < 10
            assert [tuple(f) for f in row.furigana] == [(c, p) for c, p in zip(word, best[1]) if c in symbols], word
    assert exact > 40 and got["KK"].cost is None and got["X"].cost is None and [tuple(f) for f in got["X"].furigana] == [("X", "abcdefgh")]


def test_variants(spark):
    df = spark.createDataFrame([(["ka", "hutu", "", None, "ka"],), ([],), (None,)], "r array<string>")
    rows = [r[0] for r in df.select(sounds.reading_variants(F.col("r"), LATIN)).collect()]
    assert {(v.reading, v.first, v.last): v.cost for v in rows[0]} == plain_variants(["ka", "hutu"], LATIN)
    assert len(rows[0]) == len(plain_variants(["ka", "hutu"], LATIN)) and rows[1] == rows[2] == []


@pytest.mark.parametrize("word, reading, furigana, cost", [
    ("手紙", "てがみ", [("手", "て"), ("紙", "がみ")], 1),          # voiced first sound
    ("学校", "がっこう", [("学", "がっ"), ("校", "こう")], 1),       # doubled consonant
    ("一本", "いっぽん", [("一", "いっ"), ("本", "ぽん")], 3),       # both, half voiced
    ("登山", "とざん", [("登", "と"), ("山", "ざん")], 3),          # shortened ending, voiced
    ("紙", "がみ", [("紙", "がみ")], 12),                          # no change at the first place of a word
    ("食べ物", "たべもの", [("食", "た"), ("物", "もの")], 0),
    ("今日", "きょう", [("今", "きょ"), ("日", "う")], 23),         # a reading of the whole word: two unknown parts
])
def test_japanese_compounds(spark, word, reading, furigana, cost):
    readings = {"手": ["て", "しゅ"], "紙": ["かみ", "し"], "学": ["がく"], "校": ["こう"], "一": ["いち", "いつ"], "本": ["ほん", "もと"], "登": ["とう", "のぼ"], "山": ["さん", "やま"],
                "食": ["た", "しょく"], "物": ["もの", "ぶつ"], "今": ["こん", "いま"], "日": ["にち", "ひ"]}
    table = spark.createDataFrame(list(readings.items()), "symbol string, readings array<string>")
    row, = sounds.align_by_cost(spark.createDataFrame([(word, reading)], "w string, r string"), table, "w", "r").collect()
    assert row.cost == cost and (cost >= 20 or [tuple(f) for f in row.furigana] == furigana)
