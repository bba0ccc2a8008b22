"""Rows of long texts cross to Python in batches bounded by bytes."""
import pyarrow as pa
import pytest

from trackscene.llm import minhash, ngram
from trackscene.session import cap_arrow_bytes

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("module", [ngram, minhash])
def test_long_rows_cross_few_at_a_time(spark, module):
    keys = (KEY, "spark.sql.execution.arrow.maxRecordsPerBatch")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.unset(KEY)
    spark.conf.set(keys[1], "10000")
    try:
        docs = spark.range(0, 1500, 1, 1).selectExpr("id AS doc_id", "concat(id, repeat(concat(' w', id % 7), 800)) AS text")
        assert module.near_copies(docs).count() == 1500

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

        got = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
        assert len(got) > 2 and max(got) < 2 << 20
        spark.conf.set(KEY, "4096")
        cap_arrow_bytes(spark)
        assert spark.conf.get(KEY) == "4096b" or spark.conf.get(KEY) == "4096"  # never raised
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
