"""Readings inferred from words and combined with listed ones; letters stand for symbols."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.symbols import characters
from lexforge.operators.materialize import materialize
from lexforge.plans.readings import combine_readings, dictionary_readings, infer_readings, reading_sums
from lexforge.queries.base import PART_ROWS, TERMS, Query, table, term_counts


def _vocabulary(counts):
    """Terms with the pairs (letter, next letter); the last letter is read as a dash."""
    chars = characters(F.col("term"))
    shifted = F.concat(F.slice("chars", F.lit(2), F.size("chars")), F.array(F.lit("-")))
    pairs = F.arrays_zip(F.col("chars").alias("kanji"), shifted.alias("reading"))
    words = counts.select("term", F.col("n").alias("totalOcurrences"), chars.alias("chars"))
    # written, as the run does: a filter that Spark infers for the explode would be computed per token
    return materialize(words.withColumn("furigana", pairs).drop("chars"), "words")


_SUMS = TERMS + """, spots AS (
    SELECT n, term, unnest(string_split(term, '')) AS k, generate_subscripts(string_split(term, ''), 1) AS pos FROM terms
), sums AS (
    SELECT k, CASE WHEN pos < len(term) THEN term[pos + 1] ELSE '-' END AS reading, sum(n)::BIGINT AS occ
    FROM spots GROUP BY 1, 2)"""


def inferred_readings(spark, sf_dir):
    nested = infer_readings(materialize(reading_sums(_vocabulary(term_counts(spark, sf_dir))), "sums"))
    return nested.select("k", "part", F.array_join(
        F.transform("readingsWFreq", lambda x: F.concat_ws(":", x["furigana"]["reading"], x["Occ"].cast("string"))), "|"
    ).alias("readings"))


def _bigrams(df, text):
    """(letter, next letter) of a text column, each once."""
    chars = df.select(text.alias("t")).distinct().select(characters(F.col("t")).alias("c"))
    # a text without letters has no pairs
    size = F.greatest(F.size("c"), F.lit(1))
    first, second = F.slice("c", F.lit(1), size - 1), F.slice("c", F.lit(2), size)
    return chars.select(F.inline(F.arrays_zip(first.alias("k"), second.alias("r")))).distinct()


def _listed(df, text, out):
    """One sorted list of next letters per letter, in one text."""
    return _bigrams(df, text).groupBy("k").agg(F.array_join(F.sort_array(F.collect_set("r")), "、").alias(out))


def _dictionaries(spark, sf_dir, words):
    """Hub: the letters of the terms. Dictionaries: next letters in part names, types, brands and segments."""
    parts, customers = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    letters = words.select(F.explode(characters(F.col("term"))).alias("kanji")).distinct()
    kinds = _bigrams(parts, F.col("p_name")).withColumn("type", F.lit("ja_kun")).unionByName(
        _bigrams(parts, F.lower("p_type")).withColumn("type", F.lit("ja_on")))
    entries = kinds.groupBy(F.col("k").alias("literal")).agg(F.sort_array(F.collect_list(
        F.struct("type", F.concat("r", F.lit("."), "k").alias("value")))).alias("kdReadings"))
    kun = _listed(customers, F.lower("c_name"), "kaKunYomi_ja")
    on = _listed(customers, F.lower("c_mktsegment"), "kaOnYomi_ja")
    alive = kun.join(on, "k", "full").withColumnRenamed("k", "kaKanji")
    tanos = _listed(parts, F.lower("p_brand"), "tanosKunyomi").withColumnRenamed("k", "tanosKanji").withColumn(
        "tanosOnyomi", F.lit(None).cast("string"))
    return letters, entries, alive, tanos


def listed_readings(spark, sf_dir):
    listed = dictionary_readings(*_dictionaries(spark, sf_dir, term_counts(spark, sf_dir)), use_tanos=True)
    originals = {"kunYomiRaw": "kun", "onYomiRaw": "on_"}
    return listed.select("readingsKanji", F.array_join("readings", "|").alias("readings"), *[
        F.array_join(F.transform(c, lambda t: t["original"]), "|").alias(a) for c, a in originals.items()])


def combined_readings(spark, sf_dir):
    words = _vocabulary(term_counts(spark, sf_dir))
    sums = materialize(reading_sums(words), "sums")
    listed = materialize(dictionary_readings(*_dictionaries(spark, sf_dir, words)), "listed")
    combined = combine_readings(listed, sums)
    return combined.select("readingsKanji", *[
        F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["reading"]["original"], x["frequency"].cast("string"))), "|").alias(a)
        for c, a in {"kunYomi": "kun", "onYomi": "on_"}.items()])


def _sql_bigrams(name, source, text):
    return f"""{name} AS (SELECT DISTINCT t[i] AS k, t[i + 1] AS r FROM (
        SELECT t, unnest(range(1, len(t))) AS i FROM (SELECT DISTINCT {text} AS t FROM {source})))"""


_BOOKS = ", ".join([
    _sql_bigrams("b_name", "part", "p_name"), _sql_bigrams("b_type", "part", "lower(p_type)"),
    _sql_bigrams("b_brand", "part", "lower(p_brand)"),
    _sql_bigrams("b_cust", "customer", "lower(c_name)"), _sql_bigrams("b_seg", "customer", "lower(c_mktsegment)"),
    "hub AS (SELECT DISTINCT unnest(string_split(term, '')) AS k FROM terms)",
    *[f"l_{b} AS (SELECT k, list(r ORDER BY r) AS l FROM b_{b} GROUP BY k)" for b in ("name", "type", "brand", "cust", "seg")],
])


def _lists_sql(kun_more: str, on_more: str) -> str:
    return f"""lists AS (SELECT k,
        list_concat(coalesce(c.l, []), coalesce(n.l, []), coalesce({kun_more}, [])) AS kun,
        list_concat(coalesce(s.l, []), coalesce(t.l, []), coalesce({on_more}, [])) AS on_
        FROM hub LEFT JOIN l_cust AS c USING (k) LEFT JOIN l_name AS n USING (k) LEFT JOIN l_seg AS s USING (k)
        LEFT JOIN l_type AS t USING (k) LEFT JOIN l_brand AS b USING (k))"""


_FIRSTS = "list_filter({l}, lambda x, i: list_position({l}, x) = i)"
_ALL = "list_transform(list_concat(kun, on_), lambda x: replace(x, '-', ''))"

QUERIES = {
    "inferred_readings": Query(inferred_readings, f"""WITH {_SUMS}
        SELECT k, (spot // {PART_ROWS})::INTEGER AS part, string_agg(reading || ':' || occ, '|' ORDER BY reading) AS readings
        FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY reading, occ) - 1 AS spot FROM sums) GROUP BY 1, 2"""),
    "listed_readings": Query(listed_readings, f"""WITH {TERMS}, {_BOOKS}, {_lists_sql('b.l', 'NULL')}
        SELECT k AS "readingsKanji", array_to_string({_FIRSTS.format(l=_ALL)}, '|') AS readings,
            array_to_string(kun, '|') AS kun, array_to_string(on_, '|') AS on_ FROM lists"""),
    "combined_readings": Query(combined_readings, f"""WITH {_SUMS}, {_BOOKS}, {_lists_sql('c.l', 's.l')},
        items AS (
            SELECT k, 'kun' AS kind, unnest(kun) AS r, generate_subscripts(kun, 1) AS pos FROM lists
            UNION ALL SELECT k, 'on', unnest(on_), generate_subscripts(on_, 1) FROM lists
        ), found AS (
            SELECT i.k, kind, i.r, occ, min(pos) AS pos FROM items AS i JOIN sums AS s ON s.k = i.k AND s.reading = i.r
            GROUP BY ALL
        ), joined AS (
            SELECT k, kind, string_agg(r || ':' || occ, '|' ORDER BY pos) AS l FROM found GROUP BY k, kind)
        SELECT hub.k AS "readingsKanji", coalesce(a.l, '') AS kun, coalesce(b.l, '') AS on_ FROM hub
        LEFT JOIN joined AS a ON a.k = hub.k AND a.kind = 'kun' LEFT JOIN joined AS b ON b.k = hub.k AND b.kind = 'on'"""),
}
