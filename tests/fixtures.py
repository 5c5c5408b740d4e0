"""Small source files in the shapes of the real ones.

Fixed values: column names, dictionary rows, bracket lists and log values that must be as in the published files.
"""

import json
from pathlib import Path

from lexforge.sources.readers import SourcePaths


def _lines(path, items):
    text = "\n".join(i if isinstance(i, str) else json.dumps(i, ensure_ascii=False) for i in items)
    Path(path).write_text(text + "\n", encoding="utf-8")
    return str(path)


def kd(literal, meanings, readings, **more):
    return {"literal": literal, "grade": "4", "stroke_count": "13", "freq": "640", "jlpt": "2",
            "meanings": [{"m_lang": a, "meaning": b} for a, b in meanings],
            "readings": None if readings is None else [{"type": a, "value": b} for a, b in readings], **more}


def word(text, internet, novel, subtitles, average):
    n = [internet, novel, subtitles]
    names = ["internet", "novel", "subtitles"]
    row = {"word": text, "averageRelative": average}
    for name, count in zip(names, n):
        row[f"{name}Ocurrences"] = str(count)
        row[f"{name}Relative"] = f"{count / 1e8:.9f}"
    return row


def write_sources(folder, cache=None):
    folder = Path(folder)
    return SourcePaths(
        levels=_lines(folder / "levels.json", [
            {"kanji": k, "level": n} for k, n in [("愛", 3), ("理", 2), ("由", 2), ("今", 5), ("日", 5), ("言", 4), ("凸", 1), ("匁", 1)]]),
        dictionary=_lines(folder / "dictionary.txt", [
            "愛 [あい] /(n) (1) love/affection/(P)/", "理由 [りゆう] /(n) reason/pretext/", "今日 [きょう] /(n) today/this \"day\"/",
            "言う [いう] /(v) to say/", "愛 [まな] /(pref) beloved/", "いつも /(adv) always/", "愛しい [いとしい] /(adj) lovely/",
            "匁 [もんめ] /(n) unit/"]),
        kanjidic=_lines(folder / "kanjidic.json", [
            kd("愛", [("en", "love"), ("fr", "amour")], [("ja_on", "アイ"), ("ja_kun", "いと.しい"), ("pinyin", "ai4")]),
            kd("理", [("en", "logic")], [("ja_on", "リ"), ("ja_kun", "ことわり")]),
            kd("由", [("en", "reason")], [("ja_on", "ユ"), ("ja_on", "ユウ"), ("ja_kun", "よし")]),
            kd("今", [("en", "now")], [("ja_on", "コン"), ("ja_kun", "いま")]),
            kd("日", [("en", "day")], [("ja_on", "ニチ"), ("ja_kun", "ひ"), ("ja_kun", "-び")]),
            kd("言", [("en", "say")], [("ja_on", "ゲン"), ("ja_kun", "い.う"), ("ja_kun", "こと")],
               variant={"type": "jis208", "value": "1-2"}),
            kd("匁", [("en", "monme")], None)]),
        kanji_alive=_lines(folder / "kanji-alive.json", [
            {"kanji": "愛", "kmeaning": "love, affection", "onyomi_ja": "アイ", "kunyomi_ja": "いと、まな", "kname": "ito(shii)",
             "examples": '[ [ "愛（あい）", "love \\"n\\"" ] ]', "radical": "⼼", "rad_stroke": "4"},
            {"kanji": "龘", "kmeaning": "dragons", "onyomi_ja": "トウ", "kunyomi_ja": ""}]),
        tanos=_lines(folder / "tanos.json", [
            {"Kanji": "日", "jlpt": 5, "Kunyomi": "ひ -び", "Onyomi": "ニチ ジツ", "English": "day, sun, Japan"},
            {"Kanji": "龘", "jlpt": 1, "Kunyomi": "", "Onyomi": "", "English": "dragons"}]),
        word_frequencies=_lines(folder / "word-frequencies.json", [
            word("いつも", 39753, 83941, 9841, "0.000417"), word("愛", 9000, 1000, 500, "0.5"),
            word("愛しい", 200, 80, 7, "1E-7"), word("理由", 5000, 100, 50, "0.1"), word("今日", 3000, 2000, 10, "0.2"),
            word("言う", 900, 0, 0, "0.01"), word("匁", 3, 0, 0, "0.000001")]),
        decompositions=_lines(folder / "decompositions.txt", ["愛:d(38462,夂)", "匁:lock(99972,㇏)", "12345:a(x,y)", "", "理:a()"]),
        component_lists=_lines(folder / "component-lists.txt", ["愛 : 冖 爪 心 夂", "理 : 王 里"]),
        sentences=_lines(folder / "sentences.json", [
            {"firstId": "1", "secondId": "2", "jpSentence": "愛。", "jpFurigana": "あい。", "englishMeaning": "Love."}]),
        wiki_radicals=_lines(folder / "wiki-radicals.json", [{"radical": "心", "stroke": 4}]),
        symbol_frequencies={
            p: _lines(folder / f"{p}.csv", [f'"all",{n},1', f"愛,{a},0.5", f"日,{b},0.25", f"言,{b},0.25"] + ([f"理,{a},0.1"] if p != "tw" else []))
            for p, n, a, b in [("ao", 1000, 500, 250), ("tw", 900, 100, 400), ("wk", 800, 300, 200), ("news", 700, 60, 50)]},
        lemmas=_lines(folder / "lemmas.json", [{"surface": "愛しい", "lemma": "愛しむ"}]),
        cache=cache,
    )
