"""Changed forms of words: readings with sound changes, base forms by endings, a second chance by base form, and words in running text."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.symbols import terms
from lexforge.operators.cascade import cascade_join
from lexforge.operators.matching import texts_of_words
from lexforge.operators.materialize import materialize
from lexforge.plans.inflection import deinflect
from lexforge.plans.learned import learn_readings
from lexforge.plans.sounds import FIRST, LAST, SoundChange, align_by_cost
from lexforge.queries.base import PART_ROWS, TERMS, Query, table, term_counts
from lexforge.queries.symbols import CONSONANT, _choices, _spelled

CHANGES = [*[SoundChange(FIRST, a, b, 1) for a, b in zip("kstp", "gzdb")], SoundChange(FIRST, "b", "m", 2), SoundChange(LAST, "a", "", 2), SoundChange(LAST, "te", "tt", 1)]
UNKNOWN, LONGEST = 10, 2


def alignment_costs(spark, sf_dir):
    """The readings of the terms, their sounds voiced behind the first: consonants are symbols that change."""
    words = _spelled(spark, sf_dir).withColumn("reading", F.concat(F.substring("reading", 1, 1), F.translate(F.substring("reading", 2, 99), "kst", "gzd")))
    aligned = align_by_cost(materialize(words, "spelled"), materialize(_choices(spark, sf_dir), "choices"), "term", "reading", CHANGES, symbol=CONSONANT, unknown=UNKNOWN, longest=LONGEST)
    return aligned.select("term", "cost", F.array_join(F.transform("furigana", lambda f: F.concat_ws("=", f["kanji"], f["reading"])), "|").alias("furigana"))


def _rules(place: str) -> str:
    return ", ".join(f"('{r.old}', '{r.new}', {r.cost})" for r in CHANGES if r.place == place)


_COST_SQL = f"""WITH RECURSIVE {TERMS}, read AS (
    SELECT term, regexp_replace(replace(term, 'h', ''), '([bdgkpt])', '\\1a', 'g') AS r FROM terms WHERE regexp_matches(term, '{CONSONANT}')
), spelled AS (SELECT term, r[1] || translate(r[2:], 'kst', 'gzd') AS reading FROM read
), pairs AS (
    SELECT DISTINCT unnest(regexp_extract_all(t, '({CONSONANT}[aeiou])', 1)) AS p FROM (SELECT p_name AS t FROM part UNION SELECT lower(p_type) FROM part)
), plain AS (SELECT DISTINCT p[1] AS symbol, r FROM (SELECT p, unnest([p[1], p]) AS r FROM pairs)
), firsts AS (
    SELECT symbol, r, 0 AS cost, FALSE AS f FROM plain
    UNION ALL SELECT symbol, new || r[len(old) + 1:], c, TRUE FROM plain JOIN (VALUES {_rules(FIRST)}) AS rules(old, new, c) ON starts_with(r, old)
), lasts AS (
    SELECT symbol, r, cost, f, FALSE AS l FROM firsts
    UNION ALL SELECT symbol, r[:len(r) - len(old)] || new, cost + c, f, TRUE FROM firsts JOIN (VALUES {_rules(LAST)}) AS rules(old, new, c) ON ends_with(r, old)
), variants AS (SELECT symbol, r, f, l, min(cost) AS c FROM lasts WHERE r <> '' GROUP BY ALL
), walk AS (
    SELECT term, reading, 0 AS pos, 0 AS used, 0 AS cost, []::VARCHAR[] AS path FROM spelled
    UNION ALL
    SELECT term, reading, pos + 1, used + len(o.r), cost + o.c, list_append(path, o.r)
    FROM walk, LATERAL (
        SELECT r, c FROM variants WHERE symbol = term[pos + 1] AND NOT (f AND pos = 0) AND NOT (l AND pos = len(term) - 1)
        UNION ALL SELECT reading[used + 1:used + k], {UNKNOWN} + k FROM (VALUES {', '.join(f'({k})' for k in range(1, LONGEST + 1))}) AS sizes(k)
            WHERE regexp_matches(term[pos + 1], '{CONSONANT}') AND used + k <= len(reading)
        UNION ALL SELECT term[pos + 1], 0 WHERE NOT regexp_matches(term[pos + 1], '{CONSONANT}')
    ) AS o(r, c)
    WHERE pos < len(term) AND substr(reading, used + 1, len(o.r)) = o.r
    QUALIFY row_number() OVER (PARTITION BY term, used + len(o.r) ORDER BY cost + o.c, list_append(path, o.r)) = 1
), best AS (
    SELECT term, min(struct_pack(cost := cost, path := path)) AS b FROM walk WHERE pos = len(term) AND used = len(reading) GROUP BY term
), ends AS (
    SELECT term, reading, regexp_extract(term, '^([^b-df-hj-np-tv-z]*)', 1) AS head, regexp_extract(term, '([^b-df-hj-np-tv-z]*)$', 1) AS tail FROM spelled
), middles AS (
    SELECT term, CASE WHEN len(reading) > len(head) + len(tail) AND starts_with(reading, head) AND ends_with(reading, tail)
        THEN substr(reading, len(head) + 1, len(reading) - len(head) - len(tail)) ELSE reading END AS middle FROM ends
), spots AS (
    SELECT m.term, unnest(string_split(m.term, '')) AS c, generate_subscripts(string_split(m.term, ''), 1) AS pos, b, middle FROM middles AS m LEFT JOIN best USING (term)
), kept AS (SELECT *, min(pos) OVER (PARTITION BY term) AS first FROM spots WHERE regexp_matches(c, '{CONSONANT}'))
SELECT term, any_value(b.cost) AS cost, string_agg(c || '=' || CASE WHEN b IS NOT NULL THEN b.path[pos] WHEN pos = first THEN middle ELSE '' END, '|' ORDER BY pos) AS furigana
FROM kept GROUP BY term"""

# Endings of the made-up languages, and what they stand for.
ENDINGS = [("s", ""), ("es", "e"), ("ed", ""), ("ing", ""), ("ing", "e"), ("en", ""), ("er", ""), ("tion", "t"), ("ent", "e")]
STEPS = 3
KNOWN = 5


def _dictionary(counts):
    """Terms that occur some times are the dictionary."""
    return counts.filter(F.col("n") >= KNOWN).select(F.col("term").alias("head"))


def deinflected(spark, sf_dir):
    counts = materialize(term_counts(spark, sf_dir), "terms")
    return deinflect(counts, "term", _dictionary(counts), "head", ENDINGS, STEPS)


_BASES = f"""forms AS (
    SELECT term, term AS form, 0 AS steps FROM terms
    UNION SELECT term, form[:len(form) - len(old)] || new, steps + 1
    FROM forms JOIN (VALUES {', '.join(f"('{a}', '{b}')" for a, b in ENDINGS)}) AS endings(old, new) ON ends_with(form, old) AND len(form) > len(old) WHERE steps < {STEPS}
), hits AS (SELECT term, min(struct_pack(steps := steps, form := form)) AS h FROM forms WHERE form IN (SELECT term FROM terms WHERE n >= {KNOWN}) GROUP BY term
), bases AS (SELECT term, n, coalesce(h.form, term) AS base, h.steps AS steps FROM terms LEFT JOIN hits USING (term))"""


def second_chance(spark, sf_dir):
    """Terms with the turn that says them first; a term that no turn says gets that of its base form. Each has the count of its whole family."""
    counts = materialize(term_counts(spark, sf_dir), "terms")
    bases = deinflect(counts, "term", _dictionary(counts), "head", ENDINGS, STEPS)
    words = materialize(counts.join(bases.select("term", "baseForm"), "term"), "words")
    said = table(spark, sf_dir, "conversations").select(F.explode(F.array_distinct(terms(F.col("text")))).alias("head"), F.struct("conv_id", "turn").alias("at"))
    first = said.groupBy("head").agg(F.min("at").alias("at")).select("head", "at.*")
    families = words.groupBy("baseForm").agg(F.sum("n").alias("family"))
    return cascade_join(words, materialize(first, "said"), ["term", "baseForm"], "head").join(families, "baseForm")


ROUNDS = 2


def learned_readings(spark, sf_dir):
    """What the consonants of the terms are read like, after some rounds of learning; the reading puts an a after some of them and drops each h."""
    words = term_counts(spark, sf_dir).withColumn("reading", F.regexp_replace(F.replace("term", F.lit("h"), F.lit("")), "([bdgkpt])", "$1a"))
    found = learn_readings(materialize(words, "spelled"), "term", "reading", "n", CONSONANT, longest=2, rounds=ROUNDS, tolerance=-1.0)
    return found.select("symbol", "part", F.round("share", 6).alias("share"))


def _round_sql(i: int) -> str:
    known = "parts" if i == 0 else f"(SELECT p.*, share FROM parts AS p JOIN shares{i - 1} USING (symbol, part))"
    score = "0.0E0" if i == 0 else "sum(ln(share))"
    return f"""scores{i} AS (SELECT term, path, {score} AS score FROM {known} GROUP BY term, path
), risen{i} AS (SELECT term, path, exp(score - max(score) OVER (PARTITION BY term)) AS w FROM scores{i}
), weights{i} AS (SELECT term, path, w / sum(w) OVER (PARTITION BY term) AS w FROM risen{i}
), counts{i} AS (SELECT symbol, part, sum(n * w) AS c FROM parts JOIN weights{i} USING (term, path) GROUP BY symbol, part
), shares{i} AS (SELECT symbol, part, c / sum(c) OVER (PARTITION BY symbol) AS share FROM counts{i} WHERE c > 1e-300)"""


_LEARNED_SQL = f"""WITH RECURSIVE {TERMS}, spelled AS (
    SELECT term, n, regexp_replace(replace(term, 'h', ''), '([bdgkpt])', '\\1a', 'g') AS reading FROM terms WHERE regexp_matches(term, '{CONSONANT}')
), walk AS (
    SELECT term, n, reading, 0 AS pos, 0 AS used, []::VARCHAR[] AS path FROM spelled
    UNION ALL
    SELECT term, n, reading, pos + 1, used + len(o.r), list_append(path, o.r)
    FROM walk, LATERAL (
        SELECT reading[used + 1:used + k] FROM (VALUES (1), (2)) AS sizes(k) WHERE regexp_matches(term[pos + 1], '{CONSONANT}') AND used + k <= len(reading) - (len(term) - pos - 1)
        UNION ALL SELECT term[pos + 1] WHERE NOT regexp_matches(term[pos + 1], '{CONSONANT}')
    ) AS o(r)
    WHERE pos < len(term) AND substr(reading, used + 1, len(o.r)) = o.r
), ways AS (SELECT term, n, path FROM walk WHERE pos = len(term) AND used = len(reading)
), spots AS (SELECT term, n, path, unnest(string_split(term, '')) AS symbol, unnest(path) AS part FROM ways
), parts AS (SELECT * FROM spots WHERE regexp_matches(symbol, '{CONSONANT}')
), {', '.join(_round_sql(i) for i in range(ROUNDS + 1))}
SELECT symbol, part, round(share, 6) AS share FROM shares{ROUNDS}"""


def word_sentences(spark, sf_dir):
    """Turns of conversations as running text without spaces, and the dictionary's words of three letters or more in them."""
    texts = table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", "conv_id", "turn", "role").alias("turn"), F.array_join(terms(F.col("text")), "").alias("text")).groupBy("turn").agg(F.max("text").alias("text"))
    heads = _dictionary(materialize(term_counts(spark, sf_dir), "terms")).filter(F.char_length("head") >= 3)
    found = texts_of_words(materialize(texts, "texts"), "turn", "text", heads, "head")
    return found.select("head", "part", F.size("texts").alias("n"), F.sha2(F.array_join("texts", ","), 256).alias("texts_sha256"))


_SENTENCES_SQL = f"""WITH RECURSIVE {TERMS}, heads AS (SELECT term AS head, len(term) AS size FROM terms WHERE n >= {KNOWN} AND len(term) >= 3), sizes AS (SELECT DISTINCT size FROM heads
), texts AS (
    SELECT concat_ws('/', conv_id, turn, role) AS turn, max(coalesce(regexp_replace(lower(text), '\\P{{L}}+', '', 'g'), '')) AS text FROM conversations GROUP BY 1
), places AS (SELECT turn, text, unnest(range(len(text))) AS spot FROM texts
), spans AS (SELECT turn, spot, size, text[spot + 1:spot + size] AS s FROM places, sizes WHERE spot + size <= len(text)
), longest AS (SELECT turn, spot, max(spans.size) AS size, max_by(head, spans.size) AS head FROM spans JOIN heads ON head = s GROUP BY turn, spot
), hops AS (SELECT a.turn, a.spot, a.head, b.spot AS next FROM longest AS a ASOF LEFT JOIN longest AS b ON a.turn = b.turn AND a.spot + a.size <= b.spot
), walk AS (
    SELECT turn, spot, head, next FROM hops QUALIFY row_number() OVER (PARTITION BY turn ORDER BY spot) = 1
    UNION ALL SELECT h.turn, h.spot, h.head, h.next FROM walk AS w JOIN hops AS h ON h.turn = w.turn AND h.spot = w.next
), used AS (SELECT DISTINCT head, turn FROM walk
), numbered AS (SELECT *, (row_number() OVER (PARTITION BY head ORDER BY turn) - 1) // {PART_ROWS} AS part FROM used)
SELECT head, CAST(part AS INT) AS part, CAST(count(*) AS INT) AS n, sha256(string_agg(turn, ',' ORDER BY turn)) AS texts_sha256 FROM numbered GROUP BY head, part"""

QUERIES = {
    "alignment_costs": Query(alignment_costs, _COST_SQL),
    "deinflected": Query(deinflected, f'WITH RECURSIVE {TERMS}, {_BASES} SELECT term, base AS "baseForm", steps FROM bases'),
    "second_chance": Query(second_chance, f"""WITH RECURSIVE {TERMS}, {_BASES}, said AS (
            SELECT head, min(struct_pack(conv_id := conv_id, turn := turn)) AS at
            FROM (SELECT conv_id, turn, unnest(string_split_regex(lower(text), '\\P{{L}}+')) AS head FROM conversations) WHERE head <> '' GROUP BY head
        ), families AS (SELECT base, sum(n)::BIGINT AS family FROM bases GROUP BY base
        ), met AS (SELECT b.*, family, s.at AS own, t.at AS second FROM bases AS b JOIN families USING (base) LEFT JOIN said AS s ON s.head = b.term LEFT JOIN said AS t ON t.head = b.base)
        SELECT term, n, base AS "baseForm", family, CASE WHEN own IS NOT NULL THEN 0 WHEN second IS NOT NULL THEN 1 END AS hit,
            CASE WHEN own IS NOT NULL THEN own.conv_id ELSE second.conv_id END AS conv_id, CASE WHEN own IS NOT NULL THEN own.turn ELSE second.turn END AS turn FROM met"""),
    "word_sentences": Query(word_sentences, _SENTENCES_SQL),
    "learned_readings": Query(learned_readings, _LEARNED_SQL),
}
