import random
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexforge.operators import joins, nesting, ranking
from lexforge.operators.batches import entry_batches
from lexforge.operators.layout import order_by_rank
from lexforge.operators.materialize import materialize, work_dir
from lexforge.operators.profile import profile
from lexforge.plans.vocabulary import compile_dictionary


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def skewed(spark, n=4000, nulls=True):
    rng = random.Random(1)
    data = []
    for i in range(n):
        v = 0.0 if i % 3 == 0 else float(rng.randint(0, 700))
        data.append((i, rng.choice("abc"), None if nulls and i % 97 == 0 else v, rng.randint(0, 50)))
    return spark.createDataFrame(data, "id long, g string, v double, w long").repartition(5)


@pytest.mark.parametrize("window_rows", [100_000, 0])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("group", [[], ["g"]])
def test_dense_ranks(spark, window_rows, descending, group):
    df = skewed(spark)
    got = ranking.dense_ranks(df, {"r": "v", "s": "w"}, group, descending, window_rows)

    def rank(c):
        return F.dense_rank().over(Window.partitionBy(*group).orderBy(F.desc(c) if descending else F.asc(c))).cast("long")

    want = df.withColumn("r", rank("v")).withColumn("s", rank("w"))
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    assert rows(ranking.dense_ranks(df, {"r": "v", "s": "w"}, group, descending, window_rows, written=True)) == rows(want)


def test_dense_ranks_share_a_pass(spark):
    df = skewed(spark).withColumn("x", F.col("v") / 2)
    got = ranking.dense_ranks(df, {"r": "v", "s": "x"}, window_rows=0)
    assert got.count() == 4000 and got.filter("r != s").isEmpty()


def test_hot_values_are_salted(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    df = skewed(spark, nulls=False)
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("v"))).cast("long"))
    assert rows(ranking.dense_ranks(df, {"r": "v"}, window_rows=0)) == rows(want)


def test_large_rank_has_no_single_task_window(spark):
    plan = ranking.dense_ranks(skewed(spark), {"r": "v"}, window_rows=0)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "PythonUDF" not in plan


def test_number_rows_with_copies(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).alias("hot"), F.lit(1).alias("k")).repartition(6)
    got = ranking.number_rows(df, [F.asc("hot")])
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 3001))
    assert got.filter("hot").agg(F.min("position")).first()[0] == 2001
    grouped = ranking.number_rows(skewed(spark), [F.desc("v"), F.asc("id")], ["g"])
    want = skewed(spark).withColumn(
        "position", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")).cast("long"))
    assert rows(grouped) == rows(want)


def test_parts_in_order_are_the_whole_list(spark):
    """Cutting a list changes none of it: the parts of a key, one after the other, are its list in the declared order."""
    df = spark.range(2000).select((F.col("id") % 3 == 0).alias("key"), (F.hash("id") % 500).alias("rank"), F.col("id").cast("string").alias("word")).repartition(6)
    df = df.unionByName(df.filter("rank < 0").limit(50))
    whole, cut = (nesting.nest(df, "key", F.struct("rank", "word"), "items", [F.col("rank")], n).collect() for n in (10_000, 70))
    joined = {}
    for r in sorted(cut, key=lambda r: (r.key, r.part)):
        assert len(r["items"]) == 70 or r.part == max(x.part for x in cut if x.key == r.key)
        joined.setdefault(r.key, []).extend(r["items"])
    assert joined == {r.key: r["items"] for r in whole}


def test_merged_parts_keep_first_occurrence(spark):
    rows = [(k % 2, i, [f"g{(i * 7 + j) % 900}" for j in range(3)]) for i in range(600) for k in (i,)]
    df = spark.createDataFrame(rows, "key long, place long, glosses array<string>").repartition(4)
    whole, cut = (nesting.merged_lists(df, "key", "glosses", F.col("place"), n).collect() for n in (10_000, 60))
    joined = {}
    for r in sorted(cut, key=lambda r: (r.key, r.part)):
        joined.setdefault(r.key, []).extend(r.glosses)
    assert joined == {r.key: r.glosses for r in whole}
    want = list(dict.fromkeys(g for k, _, gs in sorted(rows, key=lambda r: r[1]) if k == 0 for g in gs))
    assert joined[0] == want


@pytest.mark.parametrize("part_rows", [50_000, 100])
def test_nest_keeps_all_items(spark, part_rows):
    df = skewed(spark).withColumn("key", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("w").cast("string")))
    nested = nesting.nest(df, "key", F.struct("id", "g"), "items", [], part_rows)
    out = nested.select("key", "part", F.size("items").alias("n"), F.inline("items"))
    assert rows(out.select("key", "id", "g")) == rows(df.select("key", "id", "g"))
    if part_rows == 100:
        assert nested.filter("key = 'hot'").count() > 5
        assert nested.agg(F.max(F.size("items"))).first()[0] < 250
    else:
        assert nested.filter("part > 0").isEmpty()
    for r in nested.collect():
        assert [i["id"] for i in r["items"]] == sorted(i["id"] for i in r["items"])


def test_copies_of_one_item_are_split(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("k").alias("key"), F.lit("same").alias("item"))
    nested = nesting.nest(df, "key", F.col("item"), "items", part_rows=600)
    sizes = [len(r["items"]) for r in nested.collect()]
    assert sum(sizes) == 4000 and max(sizes) < 4000


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_plain_join(spark, how, monkeypatch):
    big = skewed(spark).withColumn("k", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 > 0, F.col("id") % 60))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    want = rows(big.join(dim, "k", how))
    assert rows(joins.lookup_join(big, dim, ["k"], how)) == want
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert rows(joins.lookup_join(big, dim, ["k"], how)) == want
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    salted = joins.lookup_join(big, dim, ["k"], how)
    assert rows(salted) == want


def test_hot_keys_go_to_many_tasks(spark):
    """In the shuffle of a skewed join no task holds more than a small part of the hot key."""
    big = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id"))
    hot = joins.hot_keys(big.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", above=1_000)
    assert rows(hot) == [(1, 22)]
    salted = big.join(F.broadcast(hot), "k", "left").filter("_salts is not null").groupBy(
        F.pmod(joins.spread(big, 1 << 20), F.col("_salts")).alias("s")).count()
    assert salted.agg(F.max("count")).first()[0] < 1_400 and salted.agg(F.sum("count")).first()[0] == 20_001


def test_many_hot_keys(spark, monkeypatch):
    """3,750 hot keys are all taken apart; when they are too many to send, the larger ones are."""
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    big = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 4 > 0, F.col("id") % 5_000).otherwise(F.col("id")).alias("k"), "id")
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    assert joins.hot_keys(counts, ["k"], "n").count() == 3_750
    dim = spark.range(0, 200_000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    want = big.join(dim, "k", "left").agg(F.count("*"), F.sum("twice")).first()
    assert joins.lookup_join(big, dim, ["k"]).agg(F.count("*"), F.sum("twice")).first() == want
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1_000)
    assert joins.hot_keys(counts, ["k"], "n").count() <= 1_000
    assert joins.lookup_join(big, dim, ["k"]).agg(F.count("*"), F.sum("twice")).first() == want


def test_broadcast_is_size_checked(spark):
    assert joins.fits_broadcast(spark.range(10))
    assert not joins.fits_broadcast(spark.range(100), rows=99)
    assert not joins.fits_broadcast(spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t")), size=500)


def test_star_join_and_full_join(spark):
    hub = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, n int")
    d1 = spark.createDataFrame([("a", "x"), ("z", "y")], "key1 string, v string")
    d2 = spark.createDataFrame([("a", 10), ("b", 20)], "key2 string, w int")
    got = joins.star_join(hub, "k", [joins.Dimension(d1, "key1"), joins.Dimension(d2, "key2", "inner")])
    assert got.columns == ["k", "n", "v", "w"]
    assert rows(got) == [("a", 1, "x", 10), ("b", 2, None, 20)]
    full = joins.full_join_on_any([(hub, "k"), (d1, "key1"), (d2, "key2")], "key")
    assert rows(full.select("key", "v", "w")) == [("a", "x", 10), ("b", None, 20), ("c", None, None), ("z", "y", None)]


def test_dictionary_duplicates(spark, tmp_path):
    lines = ["w [a] /one/two/", "v /x/", "w [b] /two/three/", "u //", "w /four/"]
    (tmp_path / "d.txt").write_text("\n".join(lines))
    from lexforge.sources.readers import dictionary_entries, text_lines
    entries = dictionary_entries(text_lines(spark, str(tmp_path / "d.txt"), "at"), keep=["at"])
    first = compile_dictionary(entries, "at")
    assert rows(first.select("edictWord", "reading", "translations")) == [
        ("u", None, []), ("v", None, ["x"]), ("w", "a", ["one", "two"])]
    merged = compile_dictionary(entries, "at", merge=True)
    assert rows(merged.select("edictWord", "reading", "translations")) == [
        ("u", None, []), ("v", None, ["x"]), ("w", "a", ["one", "two", "three", "four"])]


def test_entry_batches(spark):
    df = spark.range(103).select(F.format_string("{\"e\": %03d},", "id").alias("entry")).repartition(4)
    got = entry_batches(df, "tbl", 25, order=[F.asc("entry")]).orderBy("batch").collect()
    assert [r["n_entries"] for r in got] == [25, 25, 25, 25, 3]
    free = entry_batches(df, "tbl", 10).collect()
    assert sum(r["n_entries"] for r in free) == 103 and max(r["n_entries"] for r in free) == 10
    assert len({(r["block"], r["batch"]) for r in free}) == len(free)
    assert got[4]["body"] == '{"RequestItems":{"tbl": [{"e": 100}, {"e": 101}, {"e": 102}]}}'


def test_order_and_profile(spark):
    df = spark.createDataFrame([("a", 2), ("b", None), ("c", 1)], "k string, r int")
    assert [r["k"] for r in order_by_rank(df, "r", "k").collect()] == ["b", "c", "a"]
    assert [r["k"] for r in order_by_rank(df, "r", "k", nulls_first=False).collect()] == ["c", "a", "b"]
    assert rows(profile(df)) == [("k", "string", 3, 0, 3), ("r", "int", 3, 1, 2)]


def _session(master, **conf):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, applicationId=f"test-{uuid.uuid4().hex}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_work_folder_is_the_named_one():
    assert work_dir(_session("yarn", **{"spark.checkpoint.dir": "hdfs:///work"})) == "hdfs:///work"
    with pytest.raises(RuntimeError):
        work_dir(_session("yarn"))
    local = _session("local[2]")
    assert work_dir(local) == work_dir(local) != ""


def test_materialize(spark):
    table = materialize(spark.range(10).repartition(3))
    assert table.count() == 10 and "Scan parquet" in table._jdf.queryExecution().toString()
