"""Declared schemas of the sources (fixed values: names and types of the published files)."""

LEVELS = "kanji string, level bigint"

KANJIDIC = """
    literal string, grade string, stroke_count string, freq string, jlpt string,
    meanings array<struct<m_lang:string,meaning:string>>,
    readings array<struct<type:string,value:string>>,
    variant struct<type:string,value:string>,
    dic_numbers array<struct<value:string,type:string>>,
    query_codes array<struct<value:string,type:string>>,
    fragments array<string>, processedRadicals array<string>,
    isEUCJP boolean, isKANGXI boolean, isKanji boolean
"""
KANJIDIC_NAMES = {"freq": "kdFreq", "jlpt": "kdJlpt", "meanings": "kdMeanings", "readings": "kdReadings"}

KANJI_ALIVE = """
    kanji string, kmeaning string, onyomi string, kunyomi string, onyomi_ja string, kunyomi_ja string,
    kname string, kgrade string, kstroke string, examples string, radical string,
    rad_name string, rad_name_ja string, rad_meaning string, rad_order string,
    rad_position string, rad_position_ja string, rad_stroke string
"""
KANJI_ALIVE_NAMES = {
    "kanji": "kaKanji", "kmeaning": "kaMeanings", "onyomi": "kaOnYomi", "kunyomi": "kaKunYomi",
    "onyomi_ja": "kaOnYomi_ja", "kunyomi_ja": "kaKunYomi_ja",
}

TANOS = "Kanji string, jlpt int, Kunyomi string, Onyomi string, English string"
TANOS_NAMES = {
    "Kanji": "tanosKanji", "jlpt": "tanosJlpt", "Kunyomi": "tanosKunyomi",
    "Onyomi": "tanosOnyomi", "English": "tanosMeaning",
}

SYMBOL_FREQUENCY = "symbol string, occurrences bigint, frequency double"

# The numbers arrive as text.
WORD_FREQUENCY = """
    word string, averageRelative string, internetOcurrences string, internetRelative string,
    novelOcurrences string, novelRelative string, subtitlesOcurrences string, subtitlesRelative string
"""
WORD_COUNTS = ["internetOcurrences", "novelOcurrences", "subtitlesOcurrences"]
WORD_SHARES = ["averageRelative", "internetRelative", "novelRelative", "subtitlesRelative"]

SENTENCES = "firstId string, secondId string, jpSentence string, jpFurigana string, englishMeaning string"

# The output of the word table, in order (the spelling of the names is the published one).
WORD_MASTER = [
    "averageRelative", "internetOcurrences", "internetRelative", "novelOcurrences", "novelRelative",
    "subtitlesOcurrences", "subtitlesRelative", "word", "internetRank", "novelsRank", "subtitlesRank", "rank",
    "transliterations", "furigana", "totalOcurrences", "baseForm", "translations",
]

# The output of the symbol table, in order.
CORPORA = ["ao", "tw", "wk", "news"]
SYMBOL_MASTER = [
    "kanji", "level", "grade", "stroke_count", "variant", "examples", "kname",
    "rad_meaning", "rad_name", "rad_name_ja", "rad_order", "rad_position", "rad_position_ja", "rad_stroke",
    "radical", "components",
    *[p + f for p in CORPORA for f in ("Ocu", "Freq", "Rank")],
    "avgRank", "rank", "meanings", "kunYomi", "onYomi",
]
