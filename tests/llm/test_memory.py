from convoloom.llm.memory import BATCH_BYTES, bounded, tidy

from .helpers import edge_docs


def test_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for setting, want in (("64m", f"{BATCH_BYTES}b"), ("1m", "1m")):
            spark.conf.set(key, setting)
            bounded(edge_docs(spark))
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


def test_tidy():
    tidy()
