"""Time the headline queries: each runs whole, into a sink that keeps nothing. Prints one JSON line."""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from lexforge.queries import ALL

HEADLINES = [
    "corpus_ranks", "symbol_ranks", "word_ranks", "full_rank", "dictionary_parse", "dictionary_merged",
    "meaning_union", "star_master", "left_enrich", "inferred_readings", "combined_readings", "alignment",
    "kana_scripts", "symbol_words", "symbol_words_in_parts", "word_symbols", "word_summary", "symbol_summary",
    "kv_entries", "entry_batches", "json_roundtrip", "order_profile", "vocabulary", "symbol_table",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up of the session and of code generation is not part of a query
    ALL["corpus_ranks"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            ALL[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(json.dumps({"metric": "total_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
