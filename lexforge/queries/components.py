"""Components of components, and search by components: terms stand for symbols, their halves or letters for components."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.symbols import characters, terms
from lexforge.operators.closure import carried, closure
from lexforge.operators.inverted import holding_all, posting_lists
from lexforge.operators.materialize import materialize
from lexforge.operators.ranking import dense_ranks
from lexforge.queries.base import PART_ROWS, TERMS, Query, table, term_counts


def _halves(counts):
    """A term is composed of those of its halves that are terms."""
    half = F.floor(F.char_length("term") / 2).cast("int")
    halves = F.array(F.substring(F.col("term"), F.lit(1), half), F.substring(F.col("term"), half + 1, F.char_length("term")))
    parts = counts.filter(F.char_length("term") > 1).select(F.col("term").alias("whole"), F.explode(halves).alias("term"))
    return parts.join(counts.select("term"), "term", "left_semi").withColumnRenamed("term", "component")


def component_closure(spark, sf_dir):
    """All components of every term, at any depth."""
    counts = materialize(term_counts(spark, sf_dir), "terms")
    return closure(_halves(counts), "whole", "component")


def component_ranks(spark, sf_dir):
    """Turns of conversations as words and their terms as symbols: the least and the mean rank of all symbols and their components."""
    counts = materialize(term_counts(spark, sf_dir), "terms")
    ranks = dense_ranks(counts, {"rank": "n"}, written=True).select("term", "rank")
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("/", "conv_id", "turn", "role").alias("turn"), F.explode(terms(F.col("text"))).alias("term"))
    return carried(turns, "turn", "term", _halves(counts), "whole", "component", ranks, "rank", [
        F.count("*").alias("n_components"), F.count("rank").alias("n_ranked"), F.min("rank").alias("least"), F.avg("rank").alias("mean")])


def _letters(spark, sf_dir):
    return term_counts(spark, sf_dir).select("term", F.explode(F.array_distinct(characters(F.col("term")))).alias("letter"))


def _asked(spark, sf_dir):
    """Every word of a part's name or type asks for the terms that hold all its letters."""
    names = table(spark, sf_dir, "part").select(F.explode(F.array_distinct(F.concat(terms(F.col("p_name")), terms(F.col("p_type"))))).alias("name")).distinct()
    return names.select("name", F.explode(characters(F.col("name"))).alias("letter"))


def component_search(spark, sf_dir):
    lists = posting_lists(_letters(spark, sf_dir), "term", "letter", part_rows=PART_ROWS)
    return holding_all(materialize(lists, "lists"), _asked(spark, sf_dir), "name", "term", "letter")


def component_index(spark, sf_dir):
    """The terms of every letter as lists in parts."""
    lists = posting_lists(_letters(spark, sf_dir), "term", "letter")
    return lists.select("letter", "part", "n", F.size("keys").alias("held"), F.sha2(F.array_join("keys", ","), 256).alias("keys_sha256"))


_EDGES = f"""{TERMS}, halves AS (
    SELECT DISTINCT term AS whole, unnest([term[:len(term) // 2], term[len(term) // 2 + 1:]]) AS component FROM terms WHERE len(term) > 1
), edges AS (SELECT whole, component FROM halves WHERE component IN (SELECT term FROM terms))"""
_CLOSURE = f"""{_EDGES}, walk AS (
    SELECT whole, component, 1 AS depth FROM edges
    UNION SELECT w.whole, e.component, depth + 1 FROM walk AS w JOIN edges AS e ON e.whole = w.component
), reached AS (SELECT whole, component, min(depth) AS depth FROM walk GROUP BY whole, component)"""
_LETTERS_SQL = f"{TERMS}, letters AS (SELECT DISTINCT term, unnest(string_split(term, '')) AS letter FROM terms)"

QUERIES = {
    "component_closure": Query(component_closure, f"WITH RECURSIVE {_CLOSURE} SELECT * FROM reached"),
    "component_ranks": Query(component_ranks, f"""WITH RECURSIVE {_CLOSURE}, ranks AS (SELECT term, dense_rank() OVER (ORDER BY n DESC) AS rank FROM terms), own AS (
            SELECT DISTINCT turn, term FROM (SELECT concat_ws('/', conv_id, turn, role) AS turn, unnest(string_split_regex(lower(text), '\\P{{L}}+')) AS term FROM conversations)
            WHERE term <> ''
        ), nodes AS (SELECT turn, term FROM own UNION SELECT turn, component FROM own JOIN reached ON whole = term)
        SELECT turn, count(*) AS n_components, count(rank) AS n_ranked, min(rank) AS least, avg(rank) AS mean FROM nodes LEFT JOIN ranks USING (term) GROUP BY turn"""),
    "component_search": Query(component_search, f"""WITH {_LETTERS_SQL}, names AS (
            SELECT DISTINCT unnest(string_split_regex(lower(p_name || ' ' || p_type), '\\P{{L}}+')) AS name FROM part
        ), asked AS (SELECT DISTINCT name, unnest(string_split(name, '')) AS letter FROM names WHERE name <> ''
        ), sizes AS (SELECT name, count(*) AS k FROM asked GROUP BY name)
        SELECT name, term FROM asked JOIN letters USING (letter) JOIN sizes USING (name) GROUP BY name, term, k HAVING count(*) = k"""),
    "component_index": Query(component_index, f"""WITH {_LETTERS_SQL}, numbered AS (
            SELECT *, row_number() OVER (PARTITION BY letter ORDER BY term) - 1 AS i, count(*) OVER (PARTITION BY letter) AS n FROM letters)
        SELECT letter, CAST(i // {PART_ROWS} AS INT) AS part, n, CAST(count(*) AS INT) AS held, sha256(string_agg(term, ',' ORDER BY term)) AS keys_sha256
        FROM numbered GROUP BY letter, i // {PART_ROWS}, n"""),
}
