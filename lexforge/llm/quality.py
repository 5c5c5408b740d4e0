"""Quality classifier: an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

1. Tasks take ``BLOCK_BYTES`` of text at a time. Such a block gives one row for each distinct n-gram it holds, with how often trusted
   documents hold it, so what is shuffled follows the input at a small part of its size.
2. Counts of all orders are sharded tables: the highest order holds counts, each lower one the number of distinct bytes that come before an n-gram.
   Every order has its own three discounts from the numbers of n-grams that occur once to four times.
3. The probability of each distinct n-gram of the corpus, seen in training or not, comes from the shortest order up by joins with counts
   and contexts: ``p(w | h) = max(c(hw) - D, 0) / c(h) + gamma(h) * p(w | shorter h)``, over a uniform law of 256 bytes.
4. A model of ``MODEL_ROWS`` n-grams or fewer, 32 MB, is sent to the tasks, which score the documents. A larger one stays sharded: documents are written in
   blocks, each probability goes to the blocks that hold the n-gram, and a task scores the texts of one block with those.
5. A document is rejected when its perplexity per byte is above its language's threshold: the ``QUANTILE`` of the perplexity of trusted
   documents of that language, times ``MARGIN``. A language without trusted documents takes the quantile over all of them. For this a
   text counts as if ``PRIOR_BYTES`` bytes of the median perplexity came with it, so a few rare letters don't reject a short text.

Trusted documents are all whose labels are good; no sample is taken. Texts begin with ``order - 1`` zero bytes and are read whole.

Defined cases: a null or empty text has no perplexity and is rejected; a null language is a language of its own; labels that contradict each other
are not good; without any trusted document nothing is rejected but empty texts; verdicts depend on a row's text and language only, apart from
training, so repeated rows have the same; an empty table gives no rows; other columns are not read, and stay in ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.llm.batches import slices, text_buffer, written
from lexforge.operators.joins import fits_broadcast, lookup_join, null_safe_join
from lexforge.operators.materialize import materialize

ORDER = 4
BLOCK_BYTES = 8 << 20
MODEL_ROWS = 2_000_000
QUANTILE = 0.99
MARGIN = 1.25
PRIOR_BYTES = 32


def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kinds, ids, offsets): the distinct n-grams as numbers in order, and for each byte of the texts the one that ends there."""
    raw, offsets = text_buffer(texts)
    n = len(raw)
    pad = order - 1
    padded = np.zeros(n + pad * (len(offsets) - 1), dtype=np.uint8)
    at = np.arange(n) + np.repeat(np.arange(1, len(offsets)) * pad, np.diff(offsets))
    padded[at] = raw
    kinds, ids = np.arange(256, dtype=np.int64), padded[at - pad].astype(np.int64)
    for back in range(pad - 1, -1, -1):
        # the n-grams that are one longer, numbered in their order
        key = ids * 256 + padded[at - back]
        held = np.zeros(len(kinds) * 256, dtype=bool)
        held[key] = True
        found = np.flatnonzero(held)
        number = np.cumsum(held, dtype=np.int32) - 1
        kinds, ids = kinds[found >> 8] * 256 + (found & 255), number[key].astype(np.int64)
    if pad == 0:
        found, ids = np.unique(ids, return_inverse=True)
        kinds = found
    return kinds, ids, offsets


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(_block, _rows): documents in compressed blocks; a longer document is a block of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in held:
                    out.write_batch(part)
            return pa.RecordBatch.from_arrays([pa.array([(task << 24) + number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                              names=["_block", "_rows"])

        for batch in batches:
            for part in slices(batch, "_text", block_bytes // 4):
                held.append(part)
                size += pc.sum(pc.binary_length(part.column("_text"))).as_py() or 0
                if size >= block_bytes:
                    yield block()
                    number, held, size = number + 1, [], 0
        if held:
            yield block()

    return docs.mapInArrow(run, "_block long, _rows binary")


def _parts(packed: bytes) -> Iterator[pa.RecordBatch]:
    for batch in pa.ipc.open_stream(packed):
        yield from slices(batch, "_text")


def _summed(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in tables]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([c for _, c in tables]), len(keys)).astype(np.int64)


_COUNTED = "_block long, _g long, _n long"


def _counts(parts: Iterator[pa.RecordBatch], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of some documents, and how often the trusted ones hold them."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for part in parts:
        kinds, ids, offsets = grams(part.column("_text"), order)
        trusted = np.repeat(part.column("_trusted").to_numpy(zero_copy_only=False), np.diff(offsets))
        found.append((kinds, np.bincount(ids[trusted], minlength=len(kinds))))
        if len(found) > 16:
            found = [_summed(found)]
    return _summed(found)


def _counted_batch(block: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys), pa.array(counts)], names=["_block", "_g", "_n"])


def _task_grams(docs: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """(_block, _g, _n) of about ``block_bytes`` of text at a time; the block is 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "_text"):
                held.append(part)
                size += pc.sum(pc.binary_length(part.column("_text"))).as_py() or 0
                if size >= block_bytes:
                    yield _counted_batch(0, *_counts(held, order))
                    held, size = [], 0
        yield _counted_batch(0, *_counts(held, order))

    return docs.mapInArrow(run, _COUNTED)


def _block_grams(blocks: DataFrame, order: int) -> DataFrame:
    """(_block, _g, _n) of written blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column("_block").to_pylist(), batch.column("_rows")):
                yield _counted_batch(number, *_counts(_parts(packed.as_py()), order))

    return blocks.mapInArrow(run, _COUNTED)


def _last(column: str, order: int) -> Column:
    """The n-gram without its first byte, of the given length."""
    return F.col(column).bitwiseAND(F.lit((1 << 8 * order) - 1))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order, from how many of its n-grams have a count of one to four."""
    row = counts.agg(*[F.count_if(F.col("_n") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = row
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    wanted = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), i + 1.0) for i, d in enumerate(wanted))


def probabilities(counts: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """(_g, _p) for each n-gram in ``wanted`` (_g), by the counts (_g, _n) of trained n-grams."""
    tables = {order: materialize(counts, "counts")}
    for k in range(order - 1, 0, -1):
        tables[k] = materialize(tables[k + 1].groupBy(_last("_g", k).alias("_g")).agg(F.count("*").alias("_n")), "counts")
    ends = {order: wanted}
    for k in range(order - 1, 0, -1):
        ends[k] = materialize(ends[k + 1].select(_last("_g", k).alias("_g")).distinct(), "ends")
    shorter = None
    for k in range(1, order + 1):
        d1, d2, d3 = discounts(tables[k])
        n = F.col("_n")
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        context = F.shiftright("_g", 8)
        heads = tables[k].groupBy(context.alias("_h")).agg(F.sum("_n").alias("_total"), F.sum(discount).alias("_left"))
        rows = ends[k].withColumn("_h", context).join(tables[k], "_g", "left").join(heads, "_h", "left")
        if shorter is None:
            rows = rows.withColumn("_q", F.lit(1 / 256))
        else:
            rows = rows.withColumn("_e", _last("_g", k - 1)).join(shorter.select(F.col("_g").alias("_e"), F.col("_p").alias("_q")), "_e")
        own = F.coalesce(F.greatest(n - discount, F.lit(0.0)), F.lit(0.0)) / F.col("_total")
        p = F.when(F.col("_total").isNull(), F.col("_q")).otherwise(own + F.col("_left") / F.col("_total") * F.col("_q"))
        shorter = materialize(rows.select("_g", p.alias("_p")), "probabilities")
    return shorter


_SCORED = ["_key", "_lang", "_hash", "_trusted", "n_bytes", "perplexity"]


def _perplexities(part: pa.RecordBatch, keys: np.ndarray, logs: np.ndarray, order: int) -> pa.RecordBatch:
    kinds, ids, offsets = grams(part.column("_text"), order)
    # summed text by text: a text's sum does not depend on its neighbours
    own = logs[np.searchsorted(keys, kinds)][ids] if len(ids) else np.zeros(0)
    sums = [own[a:b].sum() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    sizes = np.diff(offsets)
    value = np.exp(-np.array(sums) / np.maximum(sizes, 1))
    return pa.RecordBatch.from_arrays([*[part.column(c) for c in _SCORED[:4]], pa.array(sizes, pa.int64()), pa.array(value, pa.float64(), mask=sizes == 0)],
                                      names=_SCORED)


def _scored_by_model(docs: DataFrame, learned: DataFrame, order: int, fields: str) -> DataFrame:
    """Each document with its perplexity, by a model small enough for every task."""
    table = learned.toArrow()
    keys, logs = table.column("_g").to_numpy(), np.log(table.column("_p").to_numpy())
    order_of = np.argsort(keys)
    sent = docs.sparkSession.sparkContext.broadcast((keys[order_of], logs[order_of]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, "_text"):
                yield _perplexities(part, *model, order)

    return docs.mapInArrow(run, fields)


def _scored_by_blocks(docs: DataFrame, learned: DataFrame, order: int, fields: str, block_bytes: int) -> DataFrame:
    """The same for a model of any size: the probabilities come to the blocks that hold the n-grams."""
    blocks = written(_blocks(docs, block_bytes), "blocks")
    found = written(_block_grams(blocks, order), "grams", 1)
    known = found.select("_block", "_g").join(learned, "_g")
    grouped = blocks.groupBy("_block").cogroup(known.groupBy("_block"))

    def run(packed: pa.Table, table: pa.Table) -> pa.Table:
        order_of = np.argsort(table.column("_g").to_numpy())
        keys, logs = table.column("_g").to_numpy()[order_of], np.log(table.column("_p").to_numpy())[order_of]
        return pa.Table.from_batches([_perplexities(part, keys, logs, order) for raw in packed.column("_rows") for part in _parts(raw.as_py())])

    return grouped.applyInArrow(run, fields)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             order: int = ORDER, quantile: float = QUANTILE, margin: float = MARGIN, prior_bytes: int = PRIOR_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, lang, text_hash, trusted, n_bytes, perplexity, threshold, accepted) for every row.

    ``labels`` has the key and ``quality``, 1 for good. ``text_hash`` is xxhash64 of the text, to tell rows with one id apart.
    """
    good = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("_q"))
    good = materialize(good.filter("_q = 1").select("_key", F.lit(True).alias("_trusted")), "trusted")
    rows = docs.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    marked = lookup_join(rows, good, ["_key"]).withColumns({"_trusted": F.coalesce("_trusted", F.lit(False)), "_hash": F.xxhash64("_text")})
    marked = marked.select("_key", "_lang", "_hash", "_trusted", "_text")
    counted = _task_grams(marked, order, block_bytes).groupBy("_g").agg(F.sum("_n").alias("_n"))
    counted = written(counted, "counted")
    learned = probabilities(counted.filter("_n > 0"), counted.select("_g"), order)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    fields = f"_key {kinds['_key']}, _lang {kinds['_lang']}, _hash long, _trusted boolean, n_bytes long, perplexity double"
    # a row of the model is 16 bytes, so the number of rows is its size
    small = learned.count() <= MODEL_ROWS
    scored = _scored_by_model(marked, learned, order, fields) if small else _scored_by_blocks(marked, learned, order, fields, block_bytes)
    scored = written(scored, "scored")

    trusted = scored.filter("_trusted and perplexity is not null")
    found = F.percentile_approx("perplexity", F.array(F.lit(0.5), F.lit(quantile)), F.lit(10_000))
    anywhere = trusted.agg(found.alias("q")).first()["q"] or [None, None]
    per_lang = trusted.groupBy("_lang").agg(found.alias("_q"))
    of = lambda i: F.coalesce(F.col("_q")[i], F.lit(anywhere[i]).cast("double"))
    levels = null_safe_join(scored.select("_lang").distinct(), per_lang, ["_lang"], "left")
    levels = materialize(levels.select("_lang", of(0).alias("_median"), (of(1) * margin).alias("threshold")), "levels")
    judged = null_safe_join(scored, F.broadcast(levels) if fits_broadcast(levels) else levels, ["_lang"], "left")
    n, prior = F.col("n_bytes"), F.lit(prior_bytes)
    with_prior = F.exp((n * F.log("perplexity") + prior * F.log("_median")) / (n + prior))
    fine = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (with_prior <= F.col("threshold")))
    return judged.select(F.col("_key").alias(key), F.col("_lang").alias(lang), F.col("_hash").alias("text_hash"),
                         F.col("_trusted").alias("trusted"), "n_bytes", "perplexity", "threshold", fine.alias("accepted"))


def accepted(docs: DataFrame, verdicts: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of the table that the verdicts accept, with all their columns."""
    gone = verdicts.filter("not accepted").select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col("text_hash").alias("_hash")).distinct()
    gone = materialize(gone, "rejected")
    same = docs[key].eqNullSafe(gone["_key"]) & docs[lang].eqNullSafe(gone["_lang"]) & (F.xxhash64(docs[text]) == gone["_hash"])
    return docs.join(F.broadcast(gone) if fits_broadcast(gone) else gone, same, "left_anti")
