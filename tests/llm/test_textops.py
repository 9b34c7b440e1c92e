import pyarrow as pa

from encore.llm.textops import bounded_batches


def test_batches_are_bounded_by_bytes_too(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    bounded_batches(spark)
    texts = spark.range(0, 600, 1, 1).selectExpr("repeat('x', 50000) text")
    got = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 600 and max(r.size for r in got) < 5 << 20
    few = spark.range(0, 2500, 1, 1).selectExpr("'x' text").mapInArrow(sizes, "n long, size long").collect()
    assert max(r.n for r in few) == 1000 and sum(r.n for r in few) == 2500
