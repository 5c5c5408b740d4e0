"""Scripts, base forms and alignment, on words that are derived from the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.kana import to_katakana, transliteration
from lexforge.functions.symbols import distinct_symbols, has_symbol
from lexforge.operators.materialize import materialize
from lexforge.plans.alignment import align_readings
from lexforge.plans.vocabulary import with_base_forms, with_scripts
from lexforge.queries.base import TERMS, Query, table, term_counts

# Each Latin letter stands for one kana. Words of other lengths have other letters, so that all kana occur, the small ones too; words of
# 5 to 8, 13 to 16, ... letters are written in the other script.
LATIN = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = [
    "あしちえゃきにひいりみらまんおぱかるさたうびわっよー",
    "ぁふゔてぃとぅじぇつうぉしゅちょーっくぐでどんいりあ",
    "かがきぎくぐけげこごさざしじすずせぜそぞただちぢゃゅょ",
    "つづてでとどなにぬねのはばぱひびぴふぶぷへべぺほぼぽ"
]
MORE = "まみむめもやゆよらりるれろわゐゑをんゔゕゖゎぁぃぅぇぉ"
KANA = [alphabet[:26] for alphabet in [*ALPHABETS, MORE]]


def kana_scripts(spark, sf_dir):
    length = F.char_length("term")
    kana = F.coalesce(*[F.when(length % len(KANA) == i, F.translate("term", LATIN, k)) for i, k in enumerate(KANA)])
    words = term_counts(spark, sf_dir).select("term", F.when((length - 1) % 8 >= 4, to_katakana(kana)).otherwise(kana).alias("kana"))
    return words.select("term", transliteration(F.col("kana")).alias("t")).select("term", "t.*")


# The two scripts are aligned blocks of Unicode.
HIRAGANA, KATAKANA = ("".join(map(chr, range(first, first + 86))) for first in (0x3041, 0x30A1))


def _replace_all(text: str, pairs) -> str:
    for a, b in pairs:
        text = f"replace({text}, '{a}', '{b}')"
    return text


# The whole spelling once more, for the comparison. Two kana first, then one.
TWO = """きゃ kya きゅ kyu きょ kyo しゃ sha しゅ shu しょ sho ちゃ cha ちゅ chu ちょ cho にゃ nya にゅ nyu にょ nyo ひゃ hya ひゅ hyu ひょ hyo
みゃ mya みゅ myu みょ myo りゃ rya りゅ ryu りょ ryo ぎゃ gya ぎゅ gyu ぎょ gyo じゃ ja じゅ ju じょ jo ぢゃ ja ぢゅ ju ぢょ jo びゃ bya びゅ byu びょ byo
ぴゃ pya ぴゅ pyu ぴょ pyo いぇ ye うぃ wi うぇ we うぉ wo ゔぁ va ゔぃ vi ゔぇ ve ゔぉ vo ゔゅ vyu くぁ kwa くぃ kwi くぇ kwe くぉ kwo ぐぁ gwa
しぇ she じぇ je ちぇ che つぁ tsa つぃ tsi つぇ tse つぉ tso てぃ ti でぃ di てゅ tyu でゅ dyu とぅ tu どぅ du ふぁ fa ふぃ fi ふぇ fe ふぉ fo ふゅ fyu""".split()
ONE = """あ a い i う u え e お o か ka き ki く ku け ke こ ko さ sa し shi す su せ se そ so た ta ち chi つ tsu て te と to な na に ni ぬ nu ね ne の no
は ha ひ hi ふ fu へ he ほ ho ま ma み mi む mu め me も mo や ya ゆ yu よ yo ら ra り ri る ru れ re ろ ro わ wa ゐ wi ゑ we を wo ん n
が ga ぎ gi ぐ gu げ ge ご go ざ za じ ji ず zu ぜ ze ぞ zo だ da ぢ ji づ zu で de ど do ば ba び bi ぶ bu べ be ぼ bo ぱ pa ぴ pi ぷ pu ぺ pe ぽ po
ゔ vu ゕ ka ゖ ke ぁ a ぃ i ぅ u ぇ e ぉ o ゃ ya ゅ yu ょ yo ゎ wa""".split()


def _romaji_sql(text: str) -> str:
    """The Latin spelling of hiragana. Pairs that share a kana can't overlap, since the second kana of a pair is small."""
    latin = _replace_all(_replace_all(text, zip(TWO[::2], TWO[1::2])), zip(ONE[::2], ONE[1::2]))
    doubled = f"regexp_replace(replace({latin}, 'っch', 'tch'), 'っ([bcdfghjkmnpqrstvwyz])', '\\1\\1', 'g')"
    return f"regexp_replace(replace({doubled}, 'っ', ''), '([aiueo])ー', '\\1\\1', 'g')"


_CHOSEN = " ".join(f"WHEN len(term) % {len(KANA)} = {i} THEN translate(term, '{LATIN}', '{k}')" for i, k in enumerate(KANA))
_KANA_SQL = f"""WITH {TERMS}, words AS (SELECT term, CASE {_CHOSEN} END AS kana FROM terms),
    spelled AS (SELECT term, kana, translate(kana, '{KATAKANA}', '{HIRAGANA}') AS hira, (len(term) - 1) % 8 >= 4 AS other FROM words)
    SELECT term, CASE WHEN other THEN translate(kana, '{HIRAGANA}', '{KATAKANA}') ELSE kana END AS original, hira AS hiragana,
        translate(hira, '{HIRAGANA}', '{KATAKANA}') AS katakana, {_romaji_sql('hira')} AS romaji FROM spelled"""


def letter_sets(spark, sf_dir):
    """The distinct letters of every term, and whether it has an accented one."""
    words = term_counts(spark, sf_dir)
    return words.select("term", "n", F.array_join(distinct_symbols(F.col("term"), r"\p{L}"), "").alias("letters"),
                        has_symbol(F.col("term"), "[à-ÿ]").alias("accented"))


def base_forms(spark, sf_dir):
    """A term that ends in s belongs to the term without it, if there is one."""
    terms = materialize(term_counts(spark, sf_dir), "terms")
    stems = terms.select(F.col("term").alias("lemma"))
    lemmas = terms.filter(F.endswith("term", F.lit("s"))).select(
        F.col("term").alias("surface"), F.substr("term", F.lit(1), F.char_length("term") - 1).alias("lemma")
    ).join(stems, "lemma", "left_semi")
    return with_base_forms(terms, lemmas, "term")


CONSONANT = "[b-df-hj-np-tv-z]"


def _spelled(spark, sf_dir):
    """Terms as words, consonants as symbols; the reading puts an a after some of them and drops each h."""
    terms = term_counts(spark, sf_dir)
    return terms.select("term", F.regexp_replace(F.replace("term", F.lit("h"), F.lit("")), "([bdgkpt])", "$1a").alias("reading"))


def _choices(spark, sf_dir):
    """Readings of a consonant: itself, and itself with each vowel that follows it in a part's name or type."""
    parts = table(spark, sf_dir, "part")
    texts = parts.select(F.explode(F.array("p_name", F.lower("p_type"))).alias("t")).distinct()
    pairs = texts.select(F.explode(F.regexp_extract_all("t", F.lit(f"({CONSONANT}[aeiou])"), 1)).alias("p"))
    both = F.array(F.substring("p", 1, 1), F.col("p"))
    listed = pairs.select(F.substring("p", 1, 1).alias("symbol"), F.explode(both).alias("r"))
    return listed.groupBy("symbol").agg(F.sort_array(F.collect_set("r")).alias("readings"))


def alignment(spark, sf_dir):
    words = materialize(_spelled(spark, sf_dir), "spelled")
    aligned = align_readings(words, materialize(_choices(spark, sf_dir), "choices"), "term", "reading", symbol=CONSONANT)
    return aligned.select("term", F.array_join(
        F.transform("furigana", lambda f: F.concat_ws("=", f["kanji"], f["reading"])), "|").alias("furigana"))


_ALIGN_SQL = f"""WITH RECURSIVE {TERMS}, spelled AS (
    SELECT term, regexp_replace(replace(term, 'h', ''), '([bdgkpt])', '\\1a', 'g') AS reading FROM terms
    WHERE regexp_matches(term, '{CONSONANT}')
), pairs AS (
    SELECT DISTINCT unnest(regexp_extract_all(t, '({CONSONANT}[aeiou])', 1)) AS p
    FROM (SELECT p_name AS t FROM part UNION SELECT lower(p_type) FROM part)
), choices AS (
    SELECT DISTINCT p[1] AS symbol, r FROM (SELECT p, unnest([p[1], p]) AS r FROM pairs)
), walk AS (
    SELECT term, reading, 0 AS pos, 0 AS used, []::VARCHAR[] AS path FROM spelled
    UNION ALL
    SELECT term, reading, pos + 1, used + len(o.r), list_append(path, o.r)
    FROM walk, LATERAL (
        SELECT r FROM choices WHERE symbol = term[pos + 1]
        UNION ALL SELECT term[pos + 1] WHERE NOT regexp_matches(term[pos + 1], '{CONSONANT}')
    ) AS o(r)
    WHERE pos < len(term) AND substr(reading, used + 1, len(o.r)) = o.r
), best AS (
    SELECT term, min(path) AS path FROM walk WHERE pos = len(term) AND used = len(reading) GROUP BY term
), ends AS (
    SELECT term, reading, regexp_extract(term, '^([^b-df-hj-np-tv-z]*)', 1) AS head,
        regexp_extract(term, '([^b-df-hj-np-tv-z]*)$', 1) AS tail FROM spelled
), middles AS (
    SELECT term, CASE WHEN len(reading) > len(head) + len(tail) AND starts_with(reading, head) AND ends_with(reading, tail)
        THEN substr(reading, len(head) + 1, len(reading) - len(head) - len(tail)) ELSE reading END AS middle FROM ends
), spots AS (
    SELECT m.term, unnest(string_split(m.term, '')) AS c, generate_subscripts(string_split(m.term, ''), 1) AS pos,
        path, middle FROM middles AS m LEFT JOIN best USING (term)
), kept AS (
    SELECT *, min(pos) OVER (PARTITION BY term) AS first FROM spots WHERE regexp_matches(c, '{CONSONANT}')
)
SELECT term, string_agg(c || '=' || CASE WHEN path IS NOT NULL THEN path[pos] WHEN pos = first THEN middle ELSE '' END,
    '|' ORDER BY pos) AS furigana FROM kept GROUP BY term"""


def spelled_by_reading(spark, sf_dir):
    """Scripts of words that need a reading: terms with an accent are spelled by their plain letters, if these are a term."""
    terms = materialize(term_counts(spark, sf_dir), "terms")
    plain = F.translate("term", "éèêàçñöüäßáíóú", "eeeacnouasaiou")
    words = terms.withColumn("plain", plain)
    known = terms.select(F.col("term").alias("reading"))
    joined = words.join(known, words["plain"] == known["reading"], "left")
    spelled = with_scripts(joined, "reading", "term", symbol="[^a-z]")
    return spelled.select("term", F.col("transliterations.original").alias("original"),
                          F.col("transliterations.hiragana").alias("hiragana"))


QUERIES = {
    "kana_scripts": Query(kana_scripts, _KANA_SQL),
    "letter_sets": Query(letter_sets, f"""WITH {TERMS} SELECT term, n,
        array_to_string(list_filter(string_split(term, ''), lambda x, i: list_position(string_split(term, ''), x) = i), '') AS letters,
        regexp_matches(term, '[à-ÿ]') AS accented FROM terms"""),
    # a surface and its lemma meet as rows of one key
    "base_forms": Query(base_forms, f"""WITH {TERMS}, keyed AS (
            SELECT term AS k, NULL AS term, NULL AS n FROM terms
            UNION ALL SELECT CASE WHEN ends_with(term, 's') THEN term[:-2] ELSE term END, term, n FROM terms
        ), known AS (SELECT *, bool_or(term IS NULL) OVER (PARTITION BY k) AS found FROM keyed)
        SELECT term, n, CASE WHEN found THEN k ELSE term END AS "baseForm" FROM known WHERE term IS NOT NULL"""),
    "alignment": Query(alignment, _ALIGN_SQL),
    "spelled_by_reading": Query(spelled_by_reading, f"""WITH {TERMS}, keyed AS (
            SELECT term AS k, NULL AS term FROM terms
            UNION ALL SELECT translate(term, 'éèêàçñöüäßáíóú', 'eeeacnouasaiou'), term FROM terms
        ), known AS (SELECT *, bool_or(term IS NULL) OVER (PARTITION BY k) AS found FROM keyed)
        SELECT term, CASE WHEN found OR NOT regexp_matches(term, '[^a-z]') THEN term END AS original,
            CASE WHEN NOT regexp_matches(term, '[^a-z]') THEN term WHEN found THEN k END AS hiragana
        FROM known WHERE term IS NOT NULL"""),
}
