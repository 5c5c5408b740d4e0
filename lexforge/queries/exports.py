"""Summaries, key-value entries, request bodies."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.kana import transliteration
from lexforge.functions.symbols import terms
from lexforge.operators.batches import entry_batches
from lexforge.plans.exports import key_value_entries, summarize_symbols, summarize_words
from lexforge.queries.base import Query, table
from lexforge.queries.symbols import KANA, LATIN, _romaji_sql


def word_summary(spark, sf_dir):
    """Each document as a word whose translations are the terms of its whole text."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("word"), F.col("n_chars").alias("totalOcurrences"), terms(F.col("text")).alias("translations"))
    return summarize_words(documents, above=300)


def _kana(column):
    return F.translate(F.lower(column), LATIN, KANA[0])


def symbol_summary(spark, sf_dir):
    """Each part as a symbol: meanings in two languages, its type and brand as readings."""
    def meaning(lang, column):
        return F.struct(F.lit(lang).alias("lang"), F.col(column).alias("meaning"))

    def reading(column):
        return F.struct(transliteration(_kana(F.col(column))).alias("reading"), F.col("p_size").cast("long").alias("frequency"))

    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("kanji"),
        F.array(meaning("en", "p_name"), meaning("fr", "p_type"), meaning("en", "p_brand"), meaning("en", "p_name")).alias("meanings"),
        F.array(reading("p_name"), reading("p_type")).alias("kunYomi"),
        F.when(F.col("p_size") > 5, F.array(reading("p_type"))).alias("onYomi"),
    )
    return summarize_symbols(parts)


_TYPE = f"translate(lower(p_type), '{LATIN}', '{KANA[0]}')"
_NAME = f"translate(lower(p_name), '{LATIN}', '{KANA[0]}')"


def kv_entries(spark, sf_dir):
    """Events as entries; their payload holds JSON text, with quotes of its own."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.when(F.col("event_type") != "view", F.col("props")).alias("props"))
    return key_value_entries(events, "event_id", "evt-")


_KV_SQL = r"""SELECT '{"PutRequest": {"Item": {"hk": {"S": "evt-' || event_id || '"},"sk": {"S": "evt-' || event_id
    || '"},"data": {"S": "' || replace(replace(payload, '\', '\\'), '"', '\"') || '"}}}},' AS entry
    FROM (SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
        || '","value":' || value || CASE WHEN event_type <> 'view' THEN ',"props":"' || replace(props, '"', '\"') || '"' ELSE '' END
        || '}' AS payload FROM events)"""


def batches(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    lines = key_value_entries(customers.select("c_custkey", "c_name", "c_acctbal"), "c_custkey", "cst-")
    keyed = lines.withColumn("key", F.regexp_extract("entry", r"cst-(\d+)", 1).cast("long"))
    return entry_batches(keyed, "master", 25, order=[F.asc("key")]).drop("block")


def unordered_batches(spark, sf_dir):
    """Batches as the lines come; the lines of all bodies together are compared, since their order is free."""
    lines = key_value_entries(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", "sup-")
    bodies = entry_batches(lines, "master", 10)
    inner = F.regexp_extract("body", r'^\{"RequestItems":\{"master": \[(.*)\]\}\}$', 1)
    return bodies.select(F.explode(F.split(inner, r"(?<=\}\}\}\}), ")).alias("entry"))


_BATCH_SQL = r"""WITH lines AS (SELECT c_custkey, '{"PutRequest": {"Item": {"hk": {"S": "cst-' || c_custkey
    || '"},"sk": {"S": "cst-' || c_custkey || '"},"data": {"S": "{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name
    || '\",\"c_acctbal\":' || c_acctbal || '}"}}}}' AS entry FROM customer
), numbered AS (SELECT *, (row_number() OVER (ORDER BY c_custkey) - 1) // 25 AS batch FROM lines)
SELECT batch, count(*) AS n_entries,
    '{"RequestItems":{"master": [' || string_agg(entry, ', ' ORDER BY c_custkey) || ']}}' AS body FROM numbered GROUP BY batch"""

_UNORDERED_SQL = r"""SELECT '{"PutRequest": {"Item": {"hk": {"S": "sup-' || s_suppkey || '"},"sk": {"S": "sup-' || s_suppkey
    || '"},"data": {"S": "{\"s_suppkey\":' || s_suppkey || ',\"s_name\":\"' || s_name || '\"}"}}}}' AS entry FROM supplier"""

QUERIES = {
    "word_summary": Query(word_summary, r"""SELECT doc_id AS w, regexp_replace(replace(list_reduce(list_prepend('',
            list_filter(string_split_regex(lower(text), '\P{L}+'), lambda t: t <> '')),
            lambda z, i: CASE WHEN z = '' OR len(z || i) <= 30 THEN z || ', ' || i ELSE z END), '"', ''''), '^, ', '') AS m
        FROM documents WHERE n_chars > 300"""),
    "symbol_summary": Query(symbol_summary, f"""SELECT p_partkey AS kanji, p_name || ', ' || p_brand AS meanings,
            {_romaji_sql(_NAME)} || ', ' || {_romaji_sql(_TYPE)} AS "romajiKun",
            CASE WHEN p_size > 5 THEN {_romaji_sql(_TYPE)} ELSE '' END AS "romajiOn",
            {_NAME} || ', ' || {_TYPE} AS "hiraganaKun",
            CASE WHEN p_size > 5 THEN {_TYPE} ELSE '' END AS "hiraganaOn" FROM part"""),
    "kv_entries": Query(kv_entries, _KV_SQL),
    "entry_batches": Query(batches, _BATCH_SQL),
    "unordered_batches": Query(unordered_batches, _UNORDERED_SQL),
}
