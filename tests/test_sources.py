import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import write_sources
from lexforge.__main__ import main
from lexforge.operators.materialize import drop_work_tables, materialize, work_dir
from lexforge.sources import readers, schemas, sinks
from lexforge.sources.cache import cached, source_fingerprint


def files(folder, suffix):
    return [f for f in os.listdir(folder) if f.endswith(suffix)]


def test_cache_follows_its_inputs(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "sums")
    calls = []

    def load():
        def build():
            calls.append(1)
            return spark.read.parquet(source).agg(F.sum("id").alias("s"))
        return cached(spark, target, build, fingerprint=source_fingerprint(spark, [source])).first()["s"]

    spark.range(10).write.parquet(source)
    assert load() == 45 and load() == 45 and len(calls) == 1
    spark.range(11).write.mode("overwrite").parquet(source)
    assert load() == 55 and len(calls) == 2


def test_unfinished_cache_is_written_again(spark, tmp_path):
    target = str(tmp_path / "t")
    cached(spark, target, lambda: spark.range(3), fingerprint="x")
    os.remove(f"{target}-cache/x/_SUCCESS")
    assert cached(spark, target, lambda: spark.range(4), create=False, fingerprint="x").count() == 4
    assert not os.path.exists(f"{target}-cache/x/_SUCCESS")
    assert cached(spark, target, lambda: spark.range(5), fingerprint="x").count() == 5
    assert os.path.exists(f"{target}-cache/x/_SUCCESS")


def test_json_layouts(spark, tmp_path):
    df = spark.range(12).select("id", F.lit(None).cast("string").alias("gone")).repartition(3)
    out = str(tmp_path / "o")
    sinks.write_json(df, out, partitions=4)
    assert len(files(out, ".json")) == 4
    sinks.write_json(df, out, single_file=1_000)
    assert len(files(out, ".json")) == 1
    sinks.write_json(df, out, rows_per_file=1)
    assert len(files(out, ".json")) == 12
    first = open(os.path.join(out, files(out, ".json")[0])).read()
    assert list(json.loads(first)) == ["id"]


def test_a_single_file_holds_what_the_caller_allows(spark, tmp_path):
    sinks.write_json(spark.range(6), str(tmp_path / "o"), single_file=6)
    assert spark.read.json(str(tmp_path / "o")).count() == 6
    with pytest.raises(ValueError):
        sinks.write_json(spark.range(7), str(tmp_path / "p"), single_file=6)


def test_csv_is_flat(spark, tmp_path):
    df = spark.createDataFrame([("a", [1])], "k string, l array<int>")
    with pytest.raises(ValueError, match="l"):
        sinks.write_csv(df, str(tmp_path / "c"))
    sinks.write_csv(df.drop("l"), str(tmp_path / "c"), header=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["k"]


def test_symbol_frequencies(spark, tmp_path):
    (tmp_path / "f.csv").write_text('"all",10,1\n愛,5,5E-1\n日,x,0.1\n')
    got = [tuple(r) for r in readers.symbol_frequencies(spark, str(tmp_path / "f.csv")).collect()]
    assert got == [("all", 10, 1.0), ("愛", 5, 0.5), ("日", None, 0.1)]
    (tmp_path / "g.csv").write_text('"all",10,1\n愛,5,0.5\n')
    inferred = readers.symbol_frequencies(spark, str(tmp_path / "g.csv"), infer=True)
    assert [t for _, t in inferred.dtypes] == ["string", "int", "double"]


def test_word_numbers(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"word": "a", "averageRelative": "1E-7", "novelOcurrences": "n/a"}))
    row = readers.word_frequencies(spark, str(tmp_path / "w.json")).first()
    assert row["averageRelative"] == 1e-7 and row["novelOcurrences"] is None


def test_whole_file_json(spark, tmp_path):
    (tmp_path / "m.json").write_text('[\n {"kanji": "愛",\n "level": 1},\n {"kanji": "日", "level": 5}]')
    assert readers.json_lines(spark, str(tmp_path / "m.json"), schemas.LEVELS, multi_line=True).count() == 2


def test_two_fields(spark, tmp_path):
    (tmp_path / "k.txt").write_text("亜 : ｜ 一 口\n㐆 : ノ 勹 ヨ \n")
    got = [tuple(r) for r in readers.two_fields(spark, str(tmp_path / "k.txt")).collect()]
    assert got == [("亜", "｜ 一 口"), ("㐆", "ノ 勹 ヨ")]


def test_lines_keep_their_place(spark, tmp_path):
    """In the order of the files' blocks, also where a file is read by several tasks."""
    lines = [f"w /{i:05d}/" for i in range(5000)]
    (tmp_path / "d.txt").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = readers.text_lines(spark, str(tmp_path / "d.txt"), "at")
        assert df.rdd.getNumPartitions() > 3
        assert [r["value"] for r in df.orderBy("at").collect()] == lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_paths_by_folder():
    paths = readers.SourcePaths.in_folder("/data/", cache="/c", tanos="/other/t.json")
    assert paths.levels == "/data/levels.json" and paths.tanos == "/other/t.json" and paths.cache == "/c"
    assert paths.symbol_frequencies["wk"] == "/data/wk.csv" and paths.sentences is None


def test_command_line(spark, tmp_path):
    write_sources(tmp_path)
    main([str(tmp_path), str(tmp_path / "out"), "--lemmas", str(tmp_path / "lemmas.json")])
    assert spark.read.json(str(tmp_path / "out/symbol_summary")).count() == 7
    assert not os.path.exists(tmp_path / "out/word_entries")


def test_work_tables_can_be_dropped(spark):
    table = materialize(spark.range(3))
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    drop_work_tables(spark)
    assert not os.path.exists(path) and os.path.exists(work_dir(spark))
