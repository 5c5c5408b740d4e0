"""Column functions on known values. Sample lines, lists and entries that must come out as published."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lexforge.functions import entries, kana, lists, records, symbols
from lexforge.functions.kana import to_romaji


def value(spark, data, schema, expr):
    return spark.createDataFrame([(data,)], schema).select(expr.alias("v")).first()["v"]


def text(spark, s, fn, *args):
    return value(spark, s, "t string", fn(F.col("t"), *args))


def strings(spark, xs, fn, *args):
    return value(spark, xs, "t array<string>", fn(F.col("t"), *args))


def plain(x):
    if isinstance(x, list):
        return [plain(i) for i in x]
    return tuple(plain(i) for i in x) if isinstance(x, tuple) else x


@pytest.mark.parametrize("line, word, reading, glosses", [
    ("愛 [あい] /(n) (1) love/affection/(P)/", "愛", "あい", ["love", "affection"]),
    ("する /(v) to do/", "する", None, ["to do"]),
    ("a [b] /(a (b) c)/()/x () y/", "a", "b", ["c)", "()", "x () y"]),
    ("", "", None, []),
    ("[x] /y/", "", "x", ["y"]),
    ("w\t/ \t/ g\t/", "w", None, ["g"]),
    ("w", "w", None, []),
    (None, None, None, None),
])
def test_dictionary_line(spark, line, word, reading, glosses):
    assert text(spark, line, records.headword) == word
    assert text(spark, line, records.bracket_reading) == reading
    assert text(spark, line, records.glosses) == glosses


def test_glosses_random(spark):
    """Against a scan that pairs each opening parenthesis with the next closing one."""

    def model(gloss):
        spans, at = [], 0
        while (a := gloss.find("(", at)) >= 0 and (b := gloss.find(")", a + 1)) >= 0:
            if b > a + 1:
                spans.append((a, b + 1))
            at = b + 1
        for a, b in reversed(spans):
            gloss = gloss[:a] + gloss[b:]
        return gloss.strip()

    rng = random.Random(3)
    lines = ["w /" + "/".join("".join(rng.choice("ab()  ") for _ in range(rng.randint(0, 9))) for _ in range(4)) + "/"
             for _ in range(400)]
    got = spark.createDataFrame([(x,) for x in lines], "t string").select("t", records.glosses(F.col("t"))).collect()
    for line, glosses in got:
        assert glosses == [g for g in map(model, line.split("/")[1:]) if g], line


@pytest.mark.parametrize("line, fields", [
    ("愛:d(38462,夂)", ("愛", "d", "38462", "夂")),
    ("剛:a(岡,刂)", ("剛", "a", "岡", "刂")),
    ("匁:lock(99972,㇏)", ("匁", "lock", "99972", "㇏")),
    ("森:c/t(木,林,木)", ("森", "c/t", "木", "木")),
    ("一:c()", ("一", "c", None, None)),
    ("二:c(一,)", ("二", "c", "一", "一")),
])
def test_decomposition(spark, line, fields):
    assert plain(text(spark, line, records.decomposition)) == fields
    assert text(spark, line, records.is_decomposition)


@pytest.mark.parametrize("line", ["", "12345:a(一,二)", "a:b(c,d)", "愛", "𠀋:a(一,二)", "愛x:a(b,c)"])
def test_other_lines_are_skipped(spark, line):
    assert text(spark, line, records.is_decomposition) is False


def test_decomposition_parts(spark):
    got = text(spark, "森:c(木,林,木)", records.decomposition, True)
    assert got["parts"] == ["木", "林", "木"]


def test_symbols(spark):
    assert text(spark, "日本日a", symbols.distinct_symbols) == ["日", "本"]
    assert text(spark, "いつも", symbols.has_symbol) is False
    assert text(spark, "言う", symbols.has_symbol) is True
    assert text(spark, "𠀋", symbols.has_symbol) is False
    assert text(spark, "Ab c1d é", symbols.terms) == ["ab", "c", "d", "é"]
    assert text(spark, "", symbols.terms) == []


@pytest.mark.parametrize("given, hira, kata, roma", [
    ("する", "する", "スル", "suru"),
    ("いつも", "いつも", "イツモ", "itsumo"),
    ("ジュウ", "じゅう", "ジュウ", "juu"),
    ("ユウ", "ゆう", "ユウ", "yuu"),
    ("にっぽん", "にっぽん", "ニッポン", "nippon"),
    ("レツ", "れつ", "レツ", "retsu"),
    ("を", "を", "ヲ", "wo"),
    ("しゃしん", "しゃしん", "シャシン", "shashin"),
    ("ラーメン", "らーめん", "ラーメン", "raamen"),
    ("愛a", "愛a", "愛a", "愛a"),
    ("", "", "", ""),
])
def test_scripts(spark, given, hira, kata, roma):
    assert plain(text(spark, given, kana.transliteration)) == (given, hira, kata, roma)


def _listed(spark, listed, items, kind="ja_kun", more=None):
    df = spark.createDataFrame([(listed, items, more)], "k string, e array<struct<type:string,value:string>>, m string")
    m = F.col("m") if more is not None else None
    return df.select(kana.reading_list(F.col("k"), F.col("e"), kind, m).alias("v")).first()["v"]


def test_reading_list(spark):
    items = [("ja_kun", "いと.しい"), ("ja_on", "アイ"), ("ja_kun", ""), ("ja_kun", None), ("ja_kun", "-び")]
    assert _listed(spark, "なに、なん", items) == ["なに", "なん", "いと", "-び", "なに", "なん"]
    assert _listed(spark, "なに、なん", items, "ja_on") == ["なに", "なん", "アイ", "なに", "なん"]
    assert _listed(spark, " ", items) == ["いと", "-び"]
    assert _listed(spark, None, None) == []
    assert _listed(spark, "お.る おり、", None) == ["お.る おり", "お", "おり"]
    assert _listed(spark, "あ", None, more="ひ.る -び") == ["あ", "ひ", "-び"]
    assert _listed(spark, "、", None) == []


def test_clean_readings(spark):
    got = strings(spark, ["アイ", "-あい", "いと"], lambda c: kana.clean_readings(c, c))
    assert got == ["あい", "いと"]


def test_gloss_list(spark):
    assert plain(text(spark, "day, sun, Japan", lists.gloss_list)) == [("en", "day"), ("en", "sun"), ("en", "Japan")]
    assert text(spark, None, lists.gloss_list) == []
    assert plain(text(spark, "", lists.gloss_list)) == [("en", "")]


def test_meanings(spark):
    schema = "t array<struct<m_lang:string,meaning:string>>"
    items = [("fr", "file"), ("en", None), None, (None, "x"), ("en", "row")]
    got = value(spark, items, schema, lists.normalised_meanings(F.col("t"), "m_lang"))
    assert plain(got) == [("fr", "file"), ("", ""), ("", ""), ("", ""), ("en", "row")]
    assert value(spark, None, schema, lists.normalised_meanings(F.col("t"), "m_lang")) == []
    union = lists.ordered_union(*[lists.normalised_meanings(F.col("t"), "m_lang")] * 2)
    assert plain(value(spark, items, schema, union)) == [("fr", "file"), ("", ""), ("en", "row")]
    plain_schema = "t array<struct<lang:string,meaning:string>>"
    twice = [("en", "row"), ("fr", "file"), ("en", "line"), ("en", "row")]
    assert value(spark, twice, plain_schema, lists.english_meanings(F.col("t"))) == "row, line"
    assert value(spark, None, plain_schema, lists.english_meanings(F.col("t"))) == ""


def test_bracket_pairs_and_examples(spark):
    got = text(spark, "[[en,file], [en,russian], [en,something]]", lists.bracket_pairs)
    assert plain(got) == [("en", "file"), ("en", "russian"), ("en", "something")]
    assert text(spark, '[ [ "愛（あい）", "love [n.]" ] ]', lists.example_pairs) == [["愛（あい）", "love [n.]"]]
    assert text(spark, None, lists.example_pairs) is None


def test_greedy_summary_random(spark):
    def model(items, limit=30):
        out = ""
        for i in items:
            if out == "" or len(out + i) <= limit:
                out = out + ", " + i
        return out.replace('"', "'").replace(", ", "", 1)

    rng = random.Random(5)
    cases = [["".join(rng.choice('ab, "') for _ in range(rng.randint(0, 18))) for _ in range(rng.randint(0, 7))]
             for _ in range(500)] + [[], [""], ["x" * 40, "y"], ["", "a"]]
    df = spark.createDataFrame([(c,) for c in cases], "t array<string>")
    for row in df.select("t", lists.greedy_summary(F.col("t")).alias("m")).collect():
        assert row["m"] == model(row["t"]), row["t"]
    assert strings(spark, None, lists.greedy_summary) == ""


def test_entry_line_is_json(spark):
    for key, payload in [("愛", '{"a":"q\\"q","b":"\\\\"}'), ('k"\\', "{}"), ("x", '{"n":"a\\nb"}')]:
        row = spark.createDataFrame([(key, payload)], "k string, p string")
        line = row.select(entries.entry_line(F.col("k"), F.col("k"), F.col("p")).alias("v")).first()["v"]
        assert line.endswith(",")
        item = json.loads(line[:-1])["PutRequest"]["Item"]
        assert item == {"hk": {"S": key}, "sk": {"S": key}, "data": {"S": payload}}
    assert re.match(r'\{"PutRequest": \{"Item": \{"hk": \{"S": "x"\},"sk": \{"S": "x"\},"data": \{"S": "', line)


@pytest.mark.parametrize("kana, latin", [
    ("ファン", "fan"), ("パーティー", "paatii"), ("チェック", "chekku"), ("シェフ", "shefu"), ("ジェット", "jetto"), ("フォーク", "fooku"),
    ("ヴァイオリン", "vaiorin"), ("マッチ", "matchi"), ("カヶ", "kake"), ("あっ", "a"), ("ウィーク", "wiiku"), ("デュエット", "dyuetto")])
def test_loan_words_in_latin_letters(spark, kana, latin):
    assert spark.range(1).select(to_romaji(F.lit(kana)).alias("r")).first().r == latin
