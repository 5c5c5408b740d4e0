"""Sinks and sources: whole tables are written in each format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.operators.materialize import materialize, work_path
from lexforge.plans.frequencies import compile_frequencies
from lexforge.queries.base import Query, table
from lexforge.sources import readers, sinks
from lexforge.sources.cache import cached, source_fingerprint


def cache_roundtrip(spark, sf_dir):
    """Sums per part, from the cache: the second call reads what the first one wrote."""
    path = work_path(spark, "sums")
    source = f"{sf_dir}/lineitem.parquet"

    def build():
        return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
            F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))

    digest = source_fingerprint(spark, [source])
    cached(spark, path, build, fingerprint=digest)
    return cached(spark, path, build, create=False, fingerprint=digest)


def json_roundtrip(spark, sf_dir):
    """Orders as JSON lines; null fields are left out and come back as null."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), "o_orderpriority")
    path = work_path(spark, "json")
    sinks.write_json(orders, path, rows_per_file=50_000)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    return readers.json_lines(spark, path, schema)


def parquet_roundtrip(spark, sf_dir):
    path = work_path(spark, "parquet")
    sinks.write_parquet(table(spark, sf_dir, "part"), path, rows_per_file=5_000)
    return spark.read.parquet(path).select("p_partkey", "p_name", "p_size")


def _frequency_files(spark, sf_dir):
    """Quantities per part by return flag, as headerless frequency files; parts that all three hold are ranked."""
    lines = materialize(table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_partkey").agg(
        F.sum("l_quantity").cast("long").alias("n")), "quantities")
    corpora = {}
    for prefix, flag in {"ao": "A", "no": "N", "re": "R"}.items():
        path = work_path(spark, "csv")
        own = lines.filter(F.col("l_returnflag") == flag).select(
            F.col("l_partkey").cast("string").alias("symbol"), "n", (F.col("n") / F.lit(2.0)).alias("half"))
        total = own.agg(F.lit("all").alias("symbol"), F.sum("n").alias("n"), F.lit(1.0).alias("half"))
        sinks.write_csv(own.unionByName(total), path)
        corpora[prefix] = readers.symbol_frequencies(spark, path)
    return corpora


def csv_frequencies(spark, sf_dir):
    """The rows of totals take part in the ranks."""
    return compile_frequencies(_frequency_files(spark, sf_dir), key="part").drop("aoFreq", "noFreq", "reFreq")


def csv_frequencies_without_totals(spark, sf_dir):
    ranked = compile_frequencies(_frequency_files(spark, sf_dir), key="part", drop_totals=True)
    return ranked.drop("aoFreq", "noFreq", "reFreq")


def sentence_pairs(spark, sf_dir):
    """Turns of conversations as a source of sentences, under its declared names."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("firstId"), F.col("turn").cast("string").alias("secondId"),
        F.col("text").alias("jpSentence"), F.nullif("role", F.lit("user")).alias("jpFurigana"), F.col("text").alias("other"))
    path = work_path(spark, "sentences")
    sinks.write_json(turns, path)
    return readers.sentences(spark, path)


def two_field_text(spark, sf_dir):
    """Lines of two fields with blanks around them."""
    path = work_path(spark, "fields")
    lines = table(spark, sf_dir, "part").select(F.concat(
        F.col("p_partkey").cast("string"), F.lit(" : "), "p_name", F.lit(" "), "p_brand", F.lit("  ")).alias("line"))
    sinks.write_text(lines, path)
    return readers.two_fields(spark, path, ("part", "list"))


def source_audit(spark, sf_dir):
    """Event properties as a JSON source in which the errors are not JSON, and one read under a wrong schema."""
    events = table(spark, sf_dir, "events")
    path = work_path(spark, "audit")
    sinks.write_text(events.select(F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(F.col("props")).alias("line")), path)
    return readers.audit({
        "events": readers.json_lines(spark, path, "k bigint", keep_corrupt=True),
        "misread": readers.json_lines(spark, path, "other string, k bigint"),
    })


def _csv_sql(totals: str) -> str:
    return f"""WITH sums AS (
            SELECT l_returnflag AS f, l_partkey::VARCHAR AS part, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY ALL
        ), counts AS (FROM sums {totals}
        ), r AS (SELECT *, dense_rank() OVER (PARTITION BY f ORDER BY n DESC) AS rk FROM counts
        ), joined AS (SELECT a.part, a.n AS "aoOcu", n.n AS "noOcu", r.n AS "reOcu", a.rk AS "aoRank", n.rk AS "noRank",
                r.rk AS "reRank", (a.rk + n.rk + r.rk) / 3.0E0 AS "avgRank"
            FROM r AS a JOIN r AS n ON n.part = a.part AND n.f = 'N' JOIN r ON r.part = a.part AND r.f = 'R' WHERE a.f = 'A')
        SELECT *, dense_rank() OVER (ORDER BY "avgRank") AS rank FROM joined"""


QUERIES = {
    "cache_roundtrip": Query(cache_roundtrip, """SELECT l_partkey, count(*) AS n, sum(l_quantity)::BIGINT AS quantity
        FROM lineitem GROUP BY l_partkey"""),
    "json_roundtrip": Query(json_roundtrip, """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus,
        o_orderpriority FROM orders"""),
    "parquet_roundtrip": Query(parquet_roundtrip, "SELECT p_partkey, p_name, p_size FROM part"),
    "csv_frequencies": Query(csv_frequencies, _csv_sql("UNION ALL SELECT f, 'all', sum(n)::BIGINT FROM sums GROUP BY f")),
    "csv_frequencies_without_totals": Query(csv_frequencies_without_totals, _csv_sql("")),
    "sentence_pairs": Query(sentence_pairs, """SELECT conv_id::VARCHAR AS "firstId", turn::VARCHAR AS "secondId",
        text AS "jpSentence", nullif(role, 'user') AS "jpFurigana", NULL::VARCHAR AS "englishMeaning" FROM conversations"""),
    "two_field_text": Query(two_field_text, "SELECT p_partkey::VARCHAR AS part, p_name || ' ' || p_brand AS list FROM part"),
    "source_audit": Query(source_audit, """SELECT 'events' AS source, count(*) AS n_rows,
            count(*) FILTER (WHERE event_type = 'error') AS n_corrupt, 0::BIGINT AS n_null_columns FROM events
        UNION ALL SELECT 'misread', count(*), 0, 1 FROM events"""),
}
