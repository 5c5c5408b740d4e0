"""Batches for Python stages are bounded by bytes, whatever their rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from lexforge.llm import batches


def test_batches_of_long_texts_stay_small(spark):
    def run(given):
        for batch in given:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    conf = {name: spark.conf.get(name) for name in (batches.BATCH_SETTING, "spark.sql.execution.arrow.maxBytesPerBatch")}
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("a word "), 1000).alias("text"))
    rows = batches.written(texts.mapInArrow(run, "n long, size long"), "sizes", 4_000).collect()
    assert sum(r.n for r in rows) == 4000 and max(r.size for r in rows) < 1.1 * (1 << 21)
    assert conf == {name: spark.conf.get(name) for name in conf}
