"""Symbol frequencies over several corpora."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.operators.materialize import materialize
from lexforge.operators.ranking import dense_ranks

TOTAL = "all"


def compile_frequencies(corpora: Mapping[str, DataFrame], key: str = "freqKanji", drop_totals: bool = False) -> DataFrame:
    """Rank every corpus, keep the symbols that all of them hold, rank their average rank.

    ``corpora`` maps a column prefix to (symbol, occurrences, frequency) rows, one per symbol. Each
    corpus may hold a row of totals named ``all``; it takes part in the ranking unless dropped.
    """
    parts = [
        df.select(F.lit(prefix).alias("corpus"), "symbol", "occurrences", "frequency")
        for prefix, df in corpora.items()
    ]
    return compile_stacked(reduce(DataFrame.unionByName, parts), list(corpora), key, drop_totals)


def compile_stacked(counts: DataFrame, prefixes: Sequence[str], key: str = "freqKanji",
                    drop_totals: bool = False) -> DataFrame:
    """The same for one table of (corpus, symbol, occurrences, frequency).

    One grouping by symbol takes the place of a join per corpus.
    """
    if drop_totals:
        counts = counts.filter(F.col("symbol") != TOTAL)
    ranked = dense_ranks(counts, {"rank": "occurrences"}, group=["corpus"])
    fields = {"Ocu": "occurrences", "Freq": "frequency", "Rank": "rank"}
    wide = ranked.filter(F.col("symbol").isNotNull()).groupBy(F.col("symbol").alias(key)).agg(
        *[
            F.max(F.when(F.col("corpus") == prefix, F.col(source))).alias(prefix + suffix)
            for prefix in prefixes
            for suffix, source in fields.items()
        ]
    )
    total = reduce(lambda a, b: a + b, [F.col(p + "Rank") for p in prefixes])
    # the sum is null where a corpus lacks the symbol
    kept = wide.withColumn("avgRank", total / F.lit(float(len(prefixes)))).filter(F.col("avgRank").isNotNull())
    return dense_ranks(materialize(kept, "averages"), {"rank": "avgRank"}, descending=False, written=True)
