import glob
import json

import pytest
from pyspark.sql import functions as F

from fixtures import write_sources
from lexforge.operators import joins, ranking
from lexforge.plans.frequencies import compile_frequencies
from lexforge.plans import alignment, crossing, exports, meanings, readings, vocabulary
from lexforge.__main__ import main
from lexforge.operators.materialize import work_dir
from lexforge.plans.run import RunOptions, compile_all, run
from lexforge.plans.inflection import japanese_endings
from lexforge.plans.sounds import japanese_changes as vocabulary_changes
from lexforge.sources import readers, schemas


def by(df, key):
    return {r[key]: r for r in df.collect()}


def pairs(items):
    return [tuple(i) for i in items]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return compile_all(spark, write_sources(tmp_path_factory.mktemp("sources")))


def test_frequencies(tables):
    rows = by(tables["frequencies"], "freqKanji")
    assert set(rows) == {"all", "愛", "日", "言"}  # one symbol is missing from a corpus
    assert [rows["愛"][p + "Rank"] for p in schemas.CORPORA] == [2, 3, 2, 2]  # the totals hold the first rank
    assert rows["愛"]["avgRank"] == 2.25 and rows["all"]["rank"] == 1
    assert rows["日"]["rank"] == rows["言"]["rank"] == 3


def test_average_of_known_ranks(spark):
    """Known ranks in four corpora: each symbol stands at its place among fillers."""
    known = {"愛": (213, 56, 269, 494), "剛": (1758, 1149, 1201, 1273)}
    corpora = {}
    for i, prefix in enumerate(schemas.CORPORA):
        places = {ranks[i]: symbol for symbol, ranks in known.items()}
        corpora[prefix] = spark.createDataFrame(
            [(places.get(r, f"{prefix}{r}"), 5000 - r, 0.0) for r in range(1, 2001)], schemas.SYMBOL_FREQUENCY)
    rows = by(compile_frequencies(corpora), "freqKanji")
    assert {k: r["avgRank"] for k, r in rows.items()} == {"愛": 258.0, "剛": 1345.25}
    assert (rows["愛"]["rank"], rows["剛"]["rank"]) == (1, 2)


def test_meanings(spark, tables):
    rows = by(tables["meanings"], "cmLiteral")
    assert pairs(rows["愛"]["meanings"]) == [("en", "love"), ("fr", "amour"), ("en", "affection")]
    assert pairs(rows["日"]["meanings"]) == [("en", "day"), ("en", "sun"), ("en", "Japan")]
    assert pairs(rows["龘"]["meanings"]) == [("en", "dragons")]
    strict = meanings.combine_meanings(tables["kanjidic"], tables["kanji_alive"], tables["tanos"], strict_keys=True)
    assert strict.filter("cmLiteral is null").count() == 2 and strict.count() == 9


def test_vocabulary(tables):
    assert tables["vocabulary"].columns == schemas.WORD_MASTER
    rows = by(tables["vocabulary"], "word")
    assert rows["いつも"]["totalOcurrences"] == 133535
    assert tuple(rows["いつも"]["transliterations"]) == ("いつも", "いつも", "イツモ", "itsumo")
    assert rows["いつも"]["furigana"] == [] and rows["いつも"]["translations"] == ["always"]
    assert rows["愛"]["rank"] == 1 and rows["愛しい"]["rank"] == 7  # by value, not by text
    assert rows["言う"]["novelsRank"] == rows["匁"]["novelsRank"]
    assert pairs(rows["理由"]["furigana"]) == [("理", "り"), ("由", "ゆう")]
    assert pairs(rows["言う"]["furigana"]) == [("言", "い")]
    assert pairs(rows["今日"]["furigana"]) == [("今", "きょう"), ("日", "")]
    assert pairs(rows["愛しい"]["furigana"]) == [("愛", "いと")]
    assert rows["愛しい"]["baseForm"] == "愛しむ" and rows["愛"]["baseForm"] == "愛"
    assert rows["愛"]["translations"] == ["love", "affection"]


def test_readings(tables):
    rows = by(tables["dictionary_readings"], "readingsKanji")
    assert rows["愛"]["readings"] == ["いと", "まな", "あい"]
    assert rows["匁"]["readings"] == [] and rows["凸"]["readings"] == []
    inferred = by(tables["inferred_readings"], "k")
    assert [(tuple(x["furigana"]), x["Occ"]) for x in inferred["愛"]["readingsWFreq"]] == [
        (("愛", "あい"), 10500), (("愛", "いと"), 287)]
    rows = by(tables["readings"], "readingsKanji")
    assert [(r["reading"]["original"], r["frequency"]) for r in rows["愛"]["kunYomi"]] == [("いと", 287)]
    assert [(r["reading"]["original"], r["frequency"]) for r in rows["愛"]["onYomi"]] == [("アイ", 10500)]
    assert rows["凸"]["kunYomi"] == [] and rows["凸"]["onYomi"] == []


def test_copies_of_a_symbol_share_their_lists(spark, tables):
    listed = tables["dictionary_readings"].filter("readingsKanji = '愛'")
    sums = spark.createDataFrame([("愛", "あい", 5), ("愛", "いと", 3)], "k string, reading string, Occ long")
    got = readings.combine_readings(listed.union(listed), sums).collect()
    assert len(got) == 2 and got[0] == got[1] and len(got[0]["onYomi"]) == 1


def test_third_source_of_readings(spark, tables):
    got = by(readings.dictionary_readings(
        tables["levels"], tables["kanjidic"], tables["kanji_alive"], tables["tanos"], use_tanos=True), "readingsKanji")
    assert got["日"]["readings"] == ["ひ", "び", "にち", "じつ"]


def test_symbol_master(tables):
    df = tables["symbols"]
    assert df.columns == schemas.SYMBOL_MASTER
    rows = by(df, "kanji")
    assert "凸" not in rows and "匁" in rows
    ai = rows["愛"]
    assert tuple(ai["components"]) == ("愛", "d", "38462", "夂") and ai["level"] == 3 and ai["rad_stroke"] == "4"
    assert ai["aoOcu"] == 500 and ai["avgRank"] == 2.25 and rows["理"]["rank"] is None
    assert [r["kanji"] for r in df.select("kanji").collect()][:4] == ["今", "匁", "理", "由"]


def test_crossing(spark, tables):
    nested = by(tables["symbols_with_words"], "kanji")
    assert [w["word"] for w in nested["愛"]["vocabsPerKanji"]] == ["愛", "愛しい"]
    assert nested["愛"]["vocabsPerKanji"][0].asDict().keys() == set(tables["vocabulary"].columns)
    words = by(tables["words_with_symbols"], "word")
    assert "いつも" not in words
    assert [k["kanji"] for k in words["理由"]["kanjisInVocab"]] == ["理", "由"]
    per_word = crossing.symbols_per_word(tables["vocabulary"], tables["symbols"].filter("kanji = '理'"))
    assert by(per_word, "wordK")["今日"]["kanjisInVocab"] == []
    kept = crossing.words_with_symbols(tables["vocabulary"], per_word, keep_unmatched=True)
    assert kept.count() == 7
    few = crossing.words_per_symbol(tables["vocabulary"], columns=["word"])
    assert by(few, "vocabK")["愛"]["vocabsPerKanji"][0].asDict() == {"word": "愛"}


def test_long_lists_continue_with_their_own_keys(tables):
    per_symbol = crossing.words_per_symbol(tables["vocabulary"], part_rows=1)
    lines = exports.symbol_entries(crossing.symbols_with_words(tables["symbols"], per_symbol)).collect()
    items = [json.loads(r["entry"][:-1])["PutRequest"]["Item"] for r in lines]
    assert len({i["sk"]["S"] for i in items}) == len(items)
    words = [w["word"] for i in items if i["hk"]["S"] == "knj-愛" for w in json.loads(i["data"]["S"])["vocabsPerKanji"]]
    assert sorted(words) == ["愛", "愛しい"]


def test_exports(tables):
    summary = {r["w"]: r["m"] for r in tables["word_summary"].collect()}
    assert summary == {"いつも": "always", "愛": "love, affection", "理由": "reason, pretext", "今日": "today, this 'day'"}
    ai = by(tables["symbol_summary"], "kanji")["愛"]
    assert tuple(ai) == ("愛", "love, affection", "ito", "ai", "いと", "あい")
    assert by(tables["symbol_summary"], "kanji")["匁"]["romajiKun"] == ""
    entries = [json.loads(r["entry"][:-1])["PutRequest"]["Item"] for r in tables["symbol_entries"].collect()]
    data = {i["hk"]["S"]: json.loads(i["data"]["S"]) for i in entries}
    assert data["knj-愛"]["examples"] == '[ [ "愛（あい）", "love \\"n\\"" ] ]'
    assert "variant" not in data["knj-愛"] and data["knj-言"]["variant"] == {"type": "jis208", "value": "1-2"}
    assert tables["common_word_entries"].count() == 3
    assert tables["common_words"].count() == 4


def test_side_tables(tables):
    assert pairs(tables["component_lists"].collect()) == [("愛", "冖 爪 心 夂"), ("理", "王 里")]
    assert by(tables["decompositions"], "cKanji")["理"]["components"]["phonetics"] is None
    assert tables["decompositions"].count() == 3
    assert tables["sentences"].first()["englishMeaning"] == "Love."
    assert tables["wiki_radicals"].first()["stroke"] == 4


def test_as_on_large_tables(spark, tables, tmp_path, monkeypatch):
    """No broadcast, no plain window, every key hot: the same tables."""
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins, "HOT_ROWS", 0)
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 0)
    large = compile_all(spark, write_sources(tmp_path))
    for name, df in tables.items():
        assert sorted(large[name].toJSON().collect()) == sorted(df.toJSON().collect()), name


def test_copies_of_a_word_align_once(spark):
    candidates = spark.createDataFrame([("日", ["ひ"])], "symbol string, readings array<string>")
    words = spark.createDataFrame([("日日", "ひひ")] * 3, "word string, reading string")
    assert alignment.align_readings(words, candidates, "word", "reading").count() == 1


def test_no_python_in_the_plans(tables):
    for name, df in tables.items():
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name


@pytest.mark.parametrize("word, reading, want", [
    ("理由", "りゆう", [("理", "り"), ("由", "ゆう")]),
    ("私", "わたし", [("私", "わたし")]),
    ("お日日", "おひにち", [("日", "ひ"), ("日", "にち")]),
    ("取り出す", "とりだす", [("取", "と"), ("出", "だ")]),
    ("大人気ない", "おとなげない", [("大", "おとなげ"), ("人", ""), ("気", "")]),
    ("ト日", "とひ", [("日", "ひ")]),
    ("日本", "にっぽん", [("日", "にっぽん"), ("本", "")]),
])
def test_alignment(spark, word, reading, want):
    table = {"理": ["り"], "由": ["ゆ", "ゆう", "よし"], "日": ["ひ", "にち", ""], "取": ["と"], "出": ["で", "だ"], "本": ["ほん"]}
    candidates = spark.createDataFrame(list(table.items()), "symbol string, readings array<string>")
    words = spark.createDataFrame([(word, reading)], "word string, reading string")
    assert pairs(alignment.align_readings(words, candidates, "word", "reading").first()["furigana"]) == want


def test_alignment_of_long_ambiguous_words(spark):
    """Many ways to split: their number must not grow with the length of the word."""
    candidates = spark.createDataFrame([("日", ["あ", "ああ", "あああ"])], "symbol string, readings array<string>")
    words = spark.createDataFrame([("日" * 40, "あ" * 70)], "word string, reading string")
    got = alignment.align_readings(words, candidates, "word", "reading").first()["furigana"]
    assert "".join(p["reading"] for p in got) == "あ" * 70 and all(p["reading"] for p in got)


def test_base_forms_and_scripts_without_a_reading(spark):
    words = spark.createDataFrame([("日本", None), ("は", None)], "word string, reading string")
    rows = by(vocabulary.with_scripts(vocabulary.with_base_forms(words, None), "reading"), "word")
    assert rows["日本"]["transliterations"] is None and rows["は"]["transliterations"]["romaji"] == "ha"
    assert rows["日本"]["baseForm"] == "日本"


def test_run_writes_and_caches(spark, tmp_path):
    paths = write_sources(tmp_path, cache=str(tmp_path / "cache"))
    run(spark, paths, str(tmp_path / "out"), everything=True)
    assert spark.read.json(str(tmp_path / "out/word_summary")).count() == 4
    lines = spark.read.text(str(tmp_path / "out/word_entries"))
    assert lines.count() == 6 and lines.filter(~F.col("value").endswith(",")).isEmpty()
    again = compile_all(spark, paths)
    assert str(tmp_path / "cache") in again["vocabulary"].inputFiles()[0]


def test_a_changed_source_is_seen_where_it_is_used(spark, tmp_path):
    """One source is edited at a time: every table made from it changes folder, all others are read back."""
    paths = write_sources(tmp_path, cache=str(tmp_path / "cache"))
    folder = tmp_path / "cache"
    compile_all(spark, paths)
    stages = {p.name.removesuffix("-cache") for p in folder.iterdir()}

    def renewed(edit):
        before = {p: set(p.iterdir()) for p in folder.iterdir()}
        edit()
        tables = compile_all(spark, paths)
        return {p.name.removesuffix("-cache") for p in folder.iterdir() if set(p.iterdir()) != before[p]}, tables

    def append(path, line):
        def edit():
            with open(path, "a", encoding="utf-8") as f:
                f.write(line + "\n")
        return edit

    made, tables = renewed(append(paths.decompositions, "日:new(alpha,beta)"))
    assert made == {"symbols", "symbols-with-words", "words-with-symbols"}
    made, _ = renewed(append(paths.tanos, json.dumps({"kanji": "愛"})))
    assert made >= {"tanos", "meanings", "dictionary-readings"} and not made & {"levels", "kanjidic", "words", "dictionary", "frequencies"}
    made, _ = renewed(append(paths.dictionary, "愛 [あい] /(n) new gloss/"))
    assert made >= {"dictionary", "vocabulary", "reading-sums"} and not made & {"levels", "kanjidic", "tanos", "frequencies", "meanings"}
    made, _ = renewed(append(next(iter(paths.symbol_frequencies.values())), "新,5,0.1"))
    assert made == {"frequencies", "symbols", "symbols-with-words", "words-with-symbols"}
    made, _ = renewed(lambda: None)
    assert not made and len(stages) == 18


def test_options_of_the_run(spark, tmp_path):
    paths, out = write_sources(tmp_path), tmp_path / "out"
    plain = {n: t.count() for n, t in compile_all(spark, paths).items() if n in ("frequencies", "symbols", "words_with_symbols", "common_words")}
    o = RunOptions(use_tanos=True, strict_keys=True, drop_totals=True, keep_unread=True, keep_unmatched=True, common_word=0)
    other = {n: t.count() for n, t in compile_all(spark, paths, o).items() if n in plain}
    assert other["frequencies"] == plain["frequencies"] - 1 and other["symbols"] > plain["symbols"]
    assert other["words_with_symbols"] > plain["words_with_symbols"] and other["common_words"] > plain["common_words"]
    work = work_dir(spark)
    before = {p for p in glob.glob(f"{work}/**", recursive=True)}
    main([str(tmp_path), str(out), "--everything", "--report", "--batch", "2", "--word-table", "w", "--rows-per-file", "1", "--common-word", "5"])
    assert {p for p in glob.glob(f"{work}/**", recursive=True)} == before  # no work table remains
    bodies = [json.loads(r.value) for r in spark.read.text(str(out / "word_bodies")).collect()]
    assert all(1 <= len(b["RequestItems"]["w"]) <= 2 for b in bodies)
    assert sum(len(b["RequestItems"]["w"]) for b in bodies) == spark.read.text(str(out / "word_entries")).count()
    assert list(json.loads(spark.read.text(str(out / "symbol_bodies")).first().value)["RequestItems"]) == ["symbols"]
    profiles = spark.read.json(str(out / "profile"))
    assert {"vocabulary", "symbols", "word_summary"} <= {r.table for r in profiles.select("table").distinct().collect()}
    assert {r.source for r in spark.read.json(str(out / "audit")).collect()} >= {"levels", "kanjidic", "tanos"}


def test_audit(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"kanji": "愛", "level": 1}\nnot json\n')
    (tmp_path / "empty.json").write_text("")
    got = by(readers.audit({
        "bad": readers.json_lines(spark, str(tmp_path / "bad.json"), schemas.LEVELS, keep_corrupt=True),
        "empty": readers.json_lines(spark, str(tmp_path / "empty.json"), schemas.LEVELS, keep_corrupt=True),
        "other": readers.json_lines(spark, str(tmp_path / "bad.json"), "x string"),
    }), "source")
    assert tuple(got["bad"]) == ("bad", 2, 1, 0)
    assert tuple(got["empty"]) == ("empty", 0, 0, 0)
    assert tuple(got["other"]) == ("other", 2, 0, 1)


def test_components_and_sentences(tables):
    assert {tuple(r) for r in tables["component_pairs"].collect()} == {("愛", c) for c in "冖爪心夂"} | {("理", c) for c in "王里"}
    assert {(r.component, tuple(r["keys"])) for r in tables["component_index"].collect()} == {(c, ("愛",)) for c in "冖爪心夂"} | {(c, ("理",)) for c in "王里"}
    assert {r.depth for r in tables["all_components"].collect()} == {1}
    assert [(r.word, r.sentences) for r in tables["word_sentences"].collect()] == [("愛", ["1"])]


def test_word_table_with_changes_and_endings(spark):
    """A compound with a voiced sound, an inflected word, and the entry of its base form."""
    numbers = ("0",) * 7
    words = readers.numeric_word_frequencies(spark.createDataFrame([(w, *numbers) for w in ("手紙", "食べました", "猫")], schemas.WORD_FREQUENCY))
    entries = spark.createDataFrame([("手紙", "てがみ", ["letter"]), ("食べる", "たべる", ["to eat"])], "edictWord string, reading string, translations array<string>")
    candidates = spark.createDataFrame([("手", ["て"]), ("紙", ["かみ"]), ("食", ["た"])], "symbol string, readings array<string>")
    plain = by(vocabulary.compile_vocabulary(words, entries, candidates), "word")
    assert pairs(plain["手紙"].furigana) == [("手", "てがみ"), ("紙", "")] and plain["食べました"].baseForm == "食べました" and plain["食べました"].translations is None
    rows = by(vocabulary.compile_vocabulary(words, entries, candidates, changes=vocabulary_changes(), endings=japanese_endings(), second_chance=True), "word")
    assert pairs(rows["手紙"].furigana) == [("手", "て"), ("紙", "がみ")] and rows["手紙"].translations == ["letter"]
    assert rows["食べました"].baseForm == "食べる" and rows["食べました"].translations == ["to eat"] and rows["食べました"].transliterations is None
    assert rows["猫"].baseForm == "猫" and rows["猫"].translations is None and set(plain["猫"].asDict()) == set(rows["猫"].asDict())
