"""Dictionary lines, records, lists in text, meanings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.lists import bracket_pairs, example_pairs, gloss_list
from lexforge.functions.symbols import characters
from lexforge.operators.materialize import work_path
from lexforge.plans.meanings import combine_meanings
from lexforge.plans.vocabulary import compile_dictionary
from lexforge.queries.base import PART_ROWS, Query, table
from lexforge.sources import readers, sinks


def _through_text(spark, lines, column):
    """Write the lines as text files and read them back."""
    path = work_path(spark, "lines")
    sinks.write_text(lines, path, column)
    return readers.text_lines(spark, path)


def _part_lines(spark, sf_dir):
    """Dictionary lines made of the parts: repeated headwords, tags, an empty group, an empty gloss."""
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(
        "p_name", F.lit(" ["), "p_brand", F.lit("] /("), "p_type", F.lit(") size "), F.col("p_size").cast("string"),
        F.lit("/() "), "p_type", F.lit("//(P)/part (no "), F.col("p_partkey").cast("string"), F.lit(") x/"),
    ).alias("line"))


_LINES = """lines AS (SELECT p_partkey, p_name || ' [' || p_brand || '] /(' || p_type || ') size ' || p_size || '/() '
    || p_type || '//(P)/part (no ' || p_partkey || ') x/' AS line FROM part)"""
_PARSED = _LINES + r""", parsed AS (SELECT p_partkey, trim(split_part(split_part(line, '/', 1), '[', 1)) AS word,
    trim(regexp_extract(line, '^[^/\[]*\[([^\]/]*)\]', 1)) AS reading,
    list_filter(list_transform(string_split(line, '/')[2:],
        lambda g: trim(regexp_replace(g, '\([^)]+\)', '', 'g'))), lambda g: g <> '') AS glosses
    FROM lines)"""


def dictionary_parse(spark, sf_dir):
    lines = _through_text(spark, _part_lines(spark, sf_dir), "line")
    return readers.dictionary_entries(lines).select(
        F.col("edictWord").alias("word"), "reading", F.array_join("translations", "|").alias("glosses"))


def dictionary_first(spark, sf_dir):
    entries = readers.dictionary_entries(_part_lines(spark, sf_dir), "line", ["p_partkey"])
    return compile_dictionary(entries, "p_partkey").select(
        F.col("edictWord").alias("word"), "reading", F.array_join("translations", "|").alias("glosses"))


def dictionary_merged(spark, sf_dir):
    """All glosses of a headword; they come out one per row, since a list may span several rows."""
    entries = readers.dictionary_entries(_part_lines(spark, sf_dir), "line", ["p_partkey"])
    merged = compile_dictionary(entries, "p_partkey", merge=True)
    return merged.select(F.col("edictWord").alias("word"), "reading", "part", F.posexplode("translations").alias("pos", "gloss"))


def record_parse(spark, sf_dir):
    """Decomposition lines, one for each distinct letter of a part's name; those that do not start with one letter and a colon are skipped."""
    letters = table(spark, sf_dir, "part").withColumn("c", F.explode(F.array_distinct(characters(F.col("p_name")))))
    lines = letters.select(F.concat(
        F.when(F.col("p_size") > 40, F.lit("12")).otherwise(F.col("c")), F.lit(":"), F.col("p_type"),
        F.lit("("), F.col("p_brand"), F.lit(","), F.col("p_size").cast("string"), F.lit(")")).alias("line"))
    parsed = readers.decompositions(_through_text(spark, lines, "line"), symbol=r"\p{L}")
    return parsed.select("cKanji", "components.kanji", "components.role", "components.phonetics", "components.meaning")


def pair_list(spark, sf_dir):
    text = F.concat(F.lit("[[en,"), "p_name", F.lit("], [fr,"), "p_type", F.lit("], [de,"), "p_brand", F.lit("]]"))
    pairs = table(spark, sf_dir, "part").select("p_partkey", F.inline(bracket_pairs(text)))
    return pairs.groupBy("language", "word").agg(F.count("*").alias("n"))


def gloss_lists(spark, sf_dir):
    """Comma lists; a part of size above 40 has none."""
    text = F.when(F.col("p_size") <= 40, F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(", "), "p_type"))
    lists = table(spark, sf_dir, "part").select("p_partkey", gloss_list(text).alias("g"))
    return lists.select("p_partkey", F.size("g").alias("n"), F.array_join(
        F.transform("g", lambda x: F.concat_ws(":", x["lang"], x["meaning"])), "|").alias("glosses"))


def json_field(spark, sf_dir):
    """JSON held in text columns: one field, and a list of example pairs."""
    events = table(spark, sf_dir, "events")
    k = F.from_json("props", "k bigint")["k"]
    text = F.concat(F.lit('[ [ "'), "event_type", F.lit('", "'), F.col("user_id").cast("string"), F.lit('" ], [ "a\\"b", "'),
                    k.cast("string"), F.lit('" ] ]'))
    listed = F.transform(example_pairs(text), lambda p: F.array_join(p, "="))
    return events.select("event_id", k.alias("k"), F.array_join(listed, "|").alias("examples"))


def _three_sources(spark, sf_dir):
    """Customers, orders per customer, and suppliers as three dictionaries with overlapping keys."""
    first = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("literal"),
        F.array(
            F.struct(F.lit("fr").alias("m_lang"), F.col("c_mktsegment").alias("meaning")),
            F.struct(F.lit("en").alias("m_lang"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("meaning")),
            F.struct(F.lit("en").alias("m_lang"), F.lit("5-LOW").alias("meaning")),
        ).alias("kdMeanings"))
    second = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("kaKanji")).agg(
        F.concat_ws(", ", F.max("o_orderpriority"), F.min("o_orderpriority"), F.min("o_orderstatus")).alias("kaMeanings"))
    third = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 20).alias("tanosKanji"), F.concat(F.lit("5-LOW, "), "s_name").alias("tanosMeaning"))
    return first, second, third


def meaning_union(spark, sf_dir):
    combined = combine_meanings(*_three_sources(spark, sf_dir))
    return combined.select(F.col("cmLiteral").alias("key"), F.array_join(
        F.transform("meanings", lambda m: F.concat_ws(":", m["lang"], m["meaning"])), "|").alias("meanings"))


def meaning_union_strict(spark, sf_dir):
    combined = combine_meanings(*_three_sources(spark, sf_dir), strict_keys=True)
    return combined.select(F.col("cmLiteral").alias("key"), F.array_join(
        F.transform("meanings", lambda m: F.concat_ws(":", m["lang"], m["meaning"])), "|").alias("meanings"))


_SOURCES = """kd AS (SELECT c_custkey AS literal, ['fr:' || c_mktsegment,
        CASE WHEN c_acctbal > 0 THEN 'en:' || c_mktsegment ELSE ':' END, 'en:5-LOW'] AS ms FROM customer),
    ka AS (SELECT o_custkey AS k2, [concat('en:', max(o_orderpriority)), concat('en:', min(o_orderpriority)),
        concat('en:', min(o_orderstatus))] AS ms FROM orders GROUP BY o_custkey),
    ta AS (SELECT s_suppkey * 20 AS k3, ['en:5-LOW', 'en:' || s_name] AS ms FROM supplier)"""
_UNION = """SELECT key, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS meanings
    FROM (SELECT {key} AS key, list_concat(coalesce(kd.ms, []), coalesce(ta.ms, []), coalesce(ka.ms, [])) AS l FROM {join})"""

QUERIES = {
    "dictionary_parse": Query(dictionary_parse, f"""WITH {_PARSED}
        SELECT word, reading, array_to_string(glosses, '|') AS glosses FROM parsed"""),
    "dictionary_first": Query(dictionary_first, f"""WITH {_PARSED}
        SELECT word, reading, array_to_string(glosses, '|') AS glosses FROM parsed
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY p_partkey) = 1"""),
    "dictionary_merged": Query(dictionary_merged, f"""WITH {_PARSED}, items AS (
            SELECT word, p_partkey, unnest(glosses) AS gloss, generate_subscripts(glosses, 1) AS i FROM parsed
        ), firsts AS (SELECT word, gloss, min(struct_pack(p := p_partkey, i := i)) AS f FROM items GROUP BY word, gloss)
        SELECT word, r AS reading, (spot // {PART_ROWS})::INTEGER AS part, (spot % {PART_ROWS})::INTEGER AS pos, gloss
        FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY f.p, f.i) - 1 AS spot FROM firsts) JOIN (SELECT word, arg_min(reading, p_partkey) AS r FROM parsed GROUP BY word) USING (word)"""),
    "record_parse": Query(record_parse, r"""WITH letters AS (SELECT DISTINCT p_partkey, p_type, p_brand, p_size, unnest(string_split(p_name, '')) AS c FROM part),
        lines AS (SELECT CASE WHEN p_size > 40 THEN '12' ELSE c END
            || ':' || p_type || '(' || p_brand || ',' || p_size || ')' AS line FROM letters)
        SELECT substr(line, 1, 1) AS "cKanji", substr(line, 1, 1) AS kanji, regexp_extract(line, ':(.*)\(', 1) AS role,
            split_part(regexp_extract(line, '\(([^)]*)\)', 1), ',', 1) AS phonetics,
            split_part(regexp_extract(line, '\(([^)]*)\)', 1), ',', 2) AS meaning
        FROM lines WHERE regexp_matches(line, '^\p{L}:')"""),
    "pair_list": Query(pair_list, """SELECT language, word, count(*) AS n FROM (
            SELECT 'en' AS language, p_name AS word FROM part UNION ALL SELECT 'fr', p_type FROM part
            UNION ALL SELECT 'de', p_brand FROM part) GROUP BY language, word"""),
    "gloss_lists": Query(gloss_lists, """SELECT p_partkey,
            CASE WHEN p_size <= 40 THEN len(string_split(p_name, ' ')) + 1 ELSE 0 END::INTEGER AS n,
            CASE WHEN p_size <= 40 THEN 'en:' || replace(p_name, ' ', '|en:') || '|en:' || p_type ELSE '' END AS glosses
        FROM part"""),
    "json_field": Query(json_field, """SELECT event_id, (props->>'$.k')::BIGINT AS k,
            event_type || '=' || user_id || '|a"b=' || (props->>'$.k') AS examples FROM events"""),
    "meaning_union": Query(meaning_union, f"WITH {_SOURCES} " + _UNION.format(
        key="coalesce(literal, k2, k3)",
        join="kd FULL JOIN ka ON literal = k2 FULL JOIN ta ON coalesce(literal, k2) = k3")),
    "meaning_union_strict": Query(meaning_union_strict, f"WITH {_SOURCES} " + _UNION.format(
        key="literal", join="kd FULL JOIN ka ON literal = k2 FULL JOIN ta ON literal = k3")),
}
