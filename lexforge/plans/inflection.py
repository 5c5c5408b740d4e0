"""Base forms without a table of lemmas: endings are rewritten until the dictionary knows the form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize

# Endings of Japanese verbs and adjectives, and what they stand for one step nearer to the dictionary's form.
POLITE = {"ます": "", "ました": "ます", "ません": "ます", "ましょう": "ます", "ませんでした": "ません"}
STEMS = {"い": "う", "き": "く", "ぎ": "ぐ", "し": "す", "ち": "つ", "に": "ぬ", "び": "ぶ", "み": "む", "り": "る"}
NEGATIVE = {"わない": "う", "かない": "く", "がない": "ぐ", "さない": "す", "たない": "つ", "なない": "ぬ", "ばない": "ぶ", "まない": "む", "らない": "る", "ない": "る", "なかった": "ない"}
PAST = {"った": "う", "いた": "く", "いだ": "ぐ", "した": "す", "んだ": "む", "た": "る", "って": "った", "いて": "いた", "いで": "いだ", "して": "した", "んで": "んだ", "て": "た"}
MORE_PAST = {"った": "つ", "んだ": "ぬ"}
LAST_PAST = {"った": "る", "んだ": "ぶ"}
ADJECTIVES = {"く": "い", "くて": "い", "かった": "い", "くない": "い", "さ": "い", "ければ": "い"}
FORMS = {"られる": "る", "れる": "る", "せる": "す", "させる": "る", "たい": "", "ている": "て", "でいる": "で"}
IRREGULAR = {"します": "する", "した": "する", "して": "する", "しない": "する", "きます": "くる", "きた": "くる", "きて": "くる", "こない": "くる"}


def japanese_endings() -> list[tuple[str, str]]:
    tables = (POLITE, STEMS, NEGATIVE, PAST, MORE_PAST, LAST_PAST, ADJECTIVES, FORMS, IRREGULAR)
    # the stem of a verb that ends in る is the verb without it
    return sorted({pair for table in tables for pair in table.items()} | {("", "る")})


def deinflect(words: DataFrame, word: str, dictionary: DataFrame, headword: str, endings: Sequence[tuple[str, str]] | None = None, most: int = 4,
              base: str = "baseForm", steps: str = "steps") -> DataFrame:
    """(word, base, steps) for every distinct word: the form that the dictionary knows after the fewest rewritings of an ending, of several the smallest.

    A word that the dictionary knows is its own base. Each round asks the dictionary for the forms of the last one by one join, and only words that it doesn't know go on; after ``most``
    rewritings they are their own base, with null steps. An ending is rewritten only if some of the word stays.
    """
    endings = japanese_endings() if endings is None else endings
    heads = materialize(dictionary.select(F.col(headword).alias("_form")).filter("_form is not null").distinct().withColumn("_known", F.lit(True)), "heads")
    start = words.select(F.col(word).alias("_word")).filter("_word is not null").distinct()
    forms = start.withColumn("_form", F.col("_word"))
    found = []
    for step in range(most + 1):
        asked = materialize(lookup_join(forms, heads, ["_form"]), "forms")
        hits = asked.filter("_known").groupBy("_word").agg(F.min("_form").alias("_base")).withColumn("_steps", F.lit(step))
        hits = materialize(hits, "hits")
        found.append(hits)
        left = asked.join(hits.select("_word"), "_word", "left_anti")
        if step == most or not endings:
            break
        rewritten = [F.when(F.endswith("_form", F.lit(old)) & (F.char_length("_form") > len(old)),
                            F.concat(F.substring(F.col("_form"), F.lit(1), F.char_length("_form") - len(old)), F.lit(new))) for old, new in endings]
        forms = left.select("_word", F.explode(F.filter(F.array_distinct(F.array(*rewritten)), lambda f: f.isNotNull())).alias("_form")).distinct()
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    # no word has hits in two rounds
    return start.join(hits, "_word", "left").select(F.col("_word").alias(word), F.coalesce("_base", "_word").alias(base), F.col("_steps").alias(steps))
