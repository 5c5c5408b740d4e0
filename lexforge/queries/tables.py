"""The word table and the symbol table as a whole, on inputs that are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.symbols import characters, terms
from lexforge.operators.materialize import materialize
from lexforge.operators.nesting import first_by, nest
from lexforge.plans.frequencies import compile_stacked
from lexforge.plans.master import symbol_master
from lexforge.plans.meanings import combine_meanings
from lexforge.plans.readings import combine_readings, dictionary_readings, reading_sums
from lexforge.plans.vocabulary import compile_dictionary, compile_vocabulary
from lexforge.queries.base import TOKENS, Query, table, term_counts
from lexforge.queries.ranks import _stacked, letter_counts, with_shares
from lexforge.queries.readings import _BOOKS, _dictionaries, _lists_sql, _vocabulary
from lexforge.queries.symbols import CONSONANT, HIRAGANA, KATAKANA, _romaji_sql
from lexforge.sources import readers

# Every language is in one medium: those that are not named, and no language at all, in the last.
MEDIA = {"internet": ["en"], "novel": ["es", "fr"], "subtitles": None}
NAMED = [lang for langs in MEDIA.values() for lang in langs or []]
# Consonants become kana, vowels and accented letters stay.
CONSONANTS = "bcdfghjklmnpqrstvwxz"
SPELLED = "しちきにひいりみらまおぱかるさたうびわよ"


def _in_medium(langs):
    if langs is None:
        return ~F.coalesce(F.col("lang").isin(NAMED), F.lit(False))
    return F.coalesce(F.col("lang").isin(langs), F.lit(False))


def _words(spark, sf_dir):
    """Terms with their counts in three media, one for each group of languages."""
    counts = term_counts(spark, sf_dir, lang=F.col("lang")).groupBy(F.col("term").alias("word")).agg(*[
        F.sum(F.when(_in_medium(langs), F.col("n")).otherwise(0)).alias(f"{medium}Ocurrences") for medium, langs in MEDIA.items()])
    return materialize(with_shares(counts, list(MEDIA)), "words")


def _dictionary(spark, sf_dir):
    """A line per turn of a conversation: its first term, spelled in kana, and all its other terms as glosses."""
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", terms(F.col("text")).alias("t"))
    head = F.get("t", F.lit(0))
    glosses = F.array_join(F.slice("t", F.lit(2), F.greatest(F.size("t"), F.lit(0))), "/")
    line = F.concat(head, F.lit(" ["), F.translate(head, CONSONANTS, SPELLED), F.lit("] /("), "role", F.lit(") "), glosses, F.lit("/"))
    lines = found.filter(F.size("t") > 0).select(line.alias("line"), F.struct("conv_id", "turn").alias("place"))
    return compile_dictionary(readers.dictionary_entries(lines, "line", ["place"]), "place")


def vocabulary(spark, sf_dir):
    words = _words(spark, sf_dir)
    spelled = F.translate("symbol", CONSONANTS, SPELLED)
    letters = words.select(F.explode(characters(F.col("word"))).alias("symbol")).distinct()
    candidates = materialize(letters.select("symbol", F.array(spelled, F.concat(spelled, F.lit("u"))).alias("readings")), "letters")
    stems = words.select(F.col("word").alias("lemma"))
    lemmas = words.filter(F.endswith("word", F.lit("s"))).select(
        F.col("word").alias("surface"), F.substr("word", F.lit(1), F.char_length("word") - 1).alias("lemma")
    ).join(stems, "lemma", "left_semi")
    dictionary = materialize(_dictionary(spark, sf_dir), "dictionary")
    compiled = compile_vocabulary(words, dictionary, candidates, lemmas, symbol=CONSONANT)
    # all columns, lists and scripts as text
    return compiled.withColumns({
        **{c: F.col(f"transliterations.{c}") for c in ("original", "hiragana", "katakana", "romaji")},
        "translations": F.array_join("translations", "|"),
        "furigana": F.array_join(F.transform("furigana", lambda f: F.concat_ws("=", f["kanji"], f["reading"])), "|"),
    }).drop("transliterations")


def _media_sql(name: str, langs: list[str] | None) -> str:
    listed = ", ".join(f"'{x}'" for x in langs or NAMED)
    return f"count(*) FILTER (WHERE {'' if langs else 'lang IS NULL OR NOT '}lang IN ({listed})) AS {name}"


# a consonant takes a following u into its reading only where that leads to the end; the smaller way is without it
_VOCABULARY_SQL = f"""WITH {TOKENS}, counts AS (
    SELECT term AS word, {', '.join(_media_sql(m, langs) for m, langs in MEDIA.items())} FROM tokens GROUP BY term
), shares AS (
    SELECT *, internet / sum(internet) OVER ()::DOUBLE AS ir, novel / sum(novel) OVER ()::DOUBLE AS vr,
        subtitles / sum(subtitles) OVER ()::DOUBLE AS sr FROM counts
), ranked AS (
    SELECT word, internet, novel, subtitles, ir, vr, sr, dense_rank() OVER (ORDER BY ir DESC) AS "internetRank", dense_rank() OVER (ORDER BY vr DESC) AS "novelsRank",
        dense_rank() OVER (ORDER BY sr DESC) AS "subtitlesRank",
        dense_rank() OVER (ORDER BY (ir + vr + sr) / 3.0E0 DESC) AS rank,
        internet + novel + subtitles AS "totalOcurrences", regexp_matches(word, '{CONSONANT}') AS marked FROM shares
), turns AS (
    SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '\\P{{L}}+'), lambda t: t <> '') AS t FROM conversations
), dictionary AS (
    SELECT t[1] AS head, translate(t[1], '{CONSONANTS}', '{SPELLED}') AS reading,
        array_to_string(t[2:], '|') AS translations
    FROM turns WHERE len(t) > 0 QUALIFY row_number() OVER (PARTITION BY t[1] ORDER BY conv_id, turn) = 1
), keyed AS (
    SELECT *, CASE WHEN ends_with(word, 's') THEN word[:-2] ELSE word END AS k, FALSE AS lemma FROM ranked
    UNION ALL BY NAME SELECT word AS k, TRUE AS lemma FROM counts
), based AS (SELECT *, CASE WHEN bool_or(lemma) OVER (PARTITION BY k) THEN k ELSE word END AS base FROM keyed
), spelled AS (
    SELECT r.*, translations, CASE WHEN r.marked THEN reading ELSE r.word END AS spoken, reading,
        CASE WHEN r.marked AND reading IS NOT NULL THEN array_to_string(list_transform(list_filter(string_split(r.word, ''), lambda c: regexp_matches(c, '{CONSONANT}')),
            lambda c: c || '=' || translate(c, '{CONSONANTS}', '{SPELLED}')), '|') END AS f
    FROM based AS r LEFT JOIN dictionary ON head = r.word WHERE NOT r.lemma
)
SELECT s.word, internet AS "internetOcurrences", novel AS "novelOcurrences", subtitles AS "subtitlesOcurrences", ir AS "internetRelative",
    vr AS "novelRelative", sr AS "subtitlesRelative", (ir + vr + sr) / 3.0E0 AS "averageRelative",
    "internetRank", "novelsRank", "subtitlesRank", rank, "totalOcurrences", base AS "baseForm", translations,
    CASE WHEN spoken IS NOT NULL THEN s.word END AS original, translate(spoken, '{KATAKANA}', '{HIRAGANA}') AS hiragana,
    translate(spoken, '{HIRAGANA}', '{KATAKANA}') AS katakana, {_romaji_sql('spoken')} AS romaji, coalesce(f, '') AS furigana
FROM spelled AS s"""

# Documents of any other language, or of none, are news.
CORPORA = {"de": "ao", "en": "tw", "es": "wk", "fr": "news"}


def symbol_table(spark, sf_dir):
    """Letters as symbols: dictionary fields and meanings from the parts that hold them, readings from the terms."""
    parts = table(spark, sf_dir, "part")
    # languages are the corpora
    names = F.create_map(*[F.lit(x) for pair in CORPORA.items() for x in pair])
    counts = materialize(term_counts(spark, sf_dir, corpus=F.coalesce(F.try_element_at(names, "lang"), F.lit("news"))), "counts")
    frequencies = compile_stacked(_stacked(letter_counts(counts), "letter", "n"), list(CORPORA.values()))
    words = _vocabulary(counts.groupBy("term").agg(F.sum("n").alias("n")))
    hub, entries, alive, tanos = _dictionaries(spark, sf_dir, words)
    hub = materialize(hub.withColumn("level", F.ascii("kanji").cast("long")), "hub")
    holding = parts.select("*", F.explode(F.array_distinct(characters(F.col("p_name")))).alias("k"))
    facts = holding.groupBy("k").agg(
        F.min("p_type").alias("grade"), F.max("p_size").cast("string").alias("stroke_count"),
        F.struct(F.min("p_brand").alias("type"), F.max("p_brand").alias("value")).alias("variant"))
    # distinct pairs first, so that a letter's list is as long as its types are many, whatever the number of parts
    kinds = holding.select("k", F.lower("p_type").alias("meaning")).distinct()
    meant = nest(kinds, "k", F.struct(F.lit("en").alias("m_lang"), F.col("meaning")), "kdMeanings").drop("part")
    facts = facts.join(meant, "k")
    kanjidic = materialize(entries.join(facts, entries["literal"] == facts["k"], "left").drop("k"), "kanjidic")
    kanji_alive = materialize(alive.withColumns({
        "kname": F.col("kaKunYomi_ja"), "kaMeanings": F.concat("kaKanji", F.lit(", economy")),
        **{c: F.concat(F.lit(f"{c} "), "kaKanji") for c in EXTRA}}), "alive")
    tanos = materialize(tanos.withColumn("tanosMeaning", F.concat(F.lit("brand "), "tanosKanji")), "tanos")
    # a record for each distinct letter of a name; a letter's record is that of its first part
    held = parts.withColumn("c", F.explode(F.array_distinct(characters(F.col("p_name")))))
    records = held.select("p_partkey", "c", F.concat(
        "c", F.lit(":"), "p_type", F.lit("("), "p_brand", F.lit(","), F.col("p_size").cast("string"), F.lit(")")).alias("line"))
    lines = first_by(records, "c", F.col("p_partkey"))
    sums = materialize(reading_sums(words), "sums")
    listed = materialize(dictionary_readings(hub, kanjidic, kanji_alive, tanos), "listed")
    master = symbol_master(
        hub, kanjidic, kanji_alive, readers.decompositions(lines, "line", symbol=r"\p{L}"), frequencies,
        combine_meanings(kanjidic, kanji_alive, tanos), sums, combine_readings(listed, sums))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["reading"]["original"], x["frequency"].cast("string"))), "|")
    # all columns, structs and lists as text
    return master.withColumns({
        "variant": F.concat_ws("/", "variant.type", "variant.value"),
        "components": F.concat_ws("/", "components.kanji", "components.role", "components.phonetics", "components.meaning"),
        "meanings": F.array_join(F.transform("meanings", lambda m: m["meaning"]), "|"), "kunYomi": joined("kunYomi"), "onYomi": joined("onYomi"),
    })


EXTRA = ["examples", "rad_meaning", "rad_name", "rad_name_ja", "rad_order", "rad_position", "rad_position_ja", "rad_stroke", "radical"]
# per corpus: its alias among the ranked letters, and its language
_RANKED = {"ao": ("d", "de"), "tw": ("e", "en"), "wk": ("s", "es"), "news": ("f", "fr")}
_WIDE = ", ".join(f'{a}.n AS "{c}Ocu", {a}.n / {a}.total AS "{c}Freq", {a}.rk AS "{c}Rank"' for c, (a, _) in _RANKED.items())
_SYMBOL_SQL = f"""WITH {TOKENS}, terms AS (SELECT term, count(*) AS n FROM tokens GROUP BY term), spots AS (
    SELECT n, term, unnest(string_split(term, '')) AS k, generate_subscripts(string_split(term, ''), 1) AS pos FROM terms
), sums AS (
    SELECT k, CASE WHEN pos < len(term) THEN term[pos + 1] ELSE '-' END AS reading, sum(n)::BIGINT AS occ FROM spots GROUP BY 1, 2
), {_BOOKS}, {_lists_sql('c.l', 's.l')}, items AS (
    SELECT k, 'kun' AS kind, unnest(kun) AS r, generate_subscripts(kun, 1) AS pos FROM lists
    UNION ALL SELECT k, 'on', unnest(on_), generate_subscripts(on_, 1) FROM lists
), found AS (
    SELECT i.k, kind, i.r, occ, min(pos) AS pos FROM items AS i JOIN sums AS s ON s.k = i.k AND s.reading = i.r GROUP BY ALL
), joined AS (SELECT k, kind, string_agg(r || ':' || occ, '|' ORDER BY pos) AS l FROM found GROUP BY k, kind
), letters AS (SELECT lang, k, count(*)::BIGINT AS n FROM (
    SELECT CASE WHEN lang IN ('de', 'en', 'es') THEN lang ELSE 'fr' END AS lang, unnest(string_split(term, '')) AS k FROM tokens) GROUP BY lang, k
), lr AS (SELECT *, dense_rank() OVER (PARTITION BY lang ORDER BY n DESC) AS rk, sum(n) OVER (PARTITION BY lang)::DOUBLE AS total FROM letters
), wide AS (SELECT d.k, {_WIDE}, (d.rk + e.rk + s.rk + f.rk) / 4.0E0 AS av FROM lr AS d
    JOIN lr AS e ON e.k = d.k AND e.lang = 'en' JOIN lr AS s ON s.k = d.k AND s.lang = 'es' JOIN lr AS f ON f.k = d.k AND f.lang = 'fr'
    WHERE d.lang = 'de'
), ranks AS (SELECT *, dense_rank() OVER (ORDER BY av) AS rank FROM wide
), holding AS (SELECT DISTINCT p_partkey, p_type, p_size, p_brand, unnest(string_split(p_name, '')) AS k FROM part
), facts AS (SELECT k, min(p_type) AS grade, max(p_size)::VARCHAR AS strokes, min(p_brand) || '/' || max(p_brand) AS variant,
    list_sort(list(DISTINCT lower(p_type))) AS ms FROM holding GROUP BY k
), kd AS (SELECT k, facts.* EXCLUDE (k) FROM (SELECT DISTINCT k FROM (SELECT k FROM b_name UNION ALL SELECT k FROM b_type)) LEFT JOIN facts USING (k)
), ka AS (SELECT k, array_to_string(c.l, '、') AS kname FROM l_cust AS c FULL JOIN l_seg AS s USING (k)
), ta AS (SELECT k, 'brand ' || k AS m FROM l_brand
), firsts AS (SELECT k, k || '/' || p_type || '/' || p_brand || '/' || p_size AS components FROM holding
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY p_partkey) = 1
), merged AS (
    SELECT hub.k, list_concat(coalesce(kd.ms, []), CASE WHEN ta.k IS NULL THEN [] ELSE [ta.m] END,
        CASE WHEN ka.k IS NULL THEN [] ELSE [ka.k, 'economy'] END) AS l,
        kd.k IS NOT NULL OR ka.k IS NOT NULL OR ta.k IS NOT NULL AS known
    FROM hub LEFT JOIN kd USING (k) LEFT JOIN ta USING (k) LEFT JOIN ka USING (k)
)
SELECT hub.k AS kanji, ascii(hub.k)::BIGINT AS level, grade, strokes AS stroke_count, coalesce(variant, '') AS variant, kname,
    {', '.join(f"CASE WHEN ka.k IS NOT NULL THEN '{c} ' || hub.k END AS {c}" for c in EXTRA)}, coalesce(components, '') AS components,
    {', '.join(f'"{c}{f}"' for c in _RANKED for f in ('Ocu', 'Freq', 'Rank'))}, av AS "avgRank", rank,
    CASE WHEN known THEN array_to_string(list_filter(m.l, lambda x, i: list_position(m.l, x) = i), '|') END AS meanings,
    coalesce(a.l, '') AS "kunYomi", coalesce(b.l, '') AS "onYomi"
FROM hub LEFT JOIN kd USING (k) LEFT JOIN ka USING (k) LEFT JOIN firsts USING (k) LEFT JOIN ranks USING (k) LEFT JOIN merged AS m USING (k)
LEFT JOIN joined AS a ON a.k = hub.k AND a.kind = 'kun' LEFT JOIN joined AS b ON b.k = hub.k AND b.kind = 'on'"""

QUERIES = {
    "vocabulary": Query(vocabulary, _VOCABULARY_SQL),
    "symbol_table": Query(symbol_table, _SYMBOL_SQL),
}
