"""Token output takes long texts few at a time, whatever their number of rows."""
import pyarrow as pa

from trackscene.llm import tokenio

from .test_bpe_tokens import JSON

KEYS = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_texts_are_encoded_few_at_a_time(spark, scratch):
    old = {k: spark.conf.get(k, None) for k in KEYS}
    spark.conf.unset(KEYS[0])
    spark.conf.set(KEYS[1], "10000")
    try:
        docs = spark.range(0, 1500, 1, 1).selectExpr("id AS doc_id", "concat(id, repeat(concat(' w', id % 7), 800)) AS text")
        tokenio.write_tokens(docs, f"{scratch}/t", JSON, shards=2)
        assert tokenio.document_sums(spark, f"{scratch}/t").count() == 1500

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

        got = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
        assert len(got) > 2 and max(got) < 2 << 20
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
