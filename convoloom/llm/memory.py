"""Memory that worker processes give back between tasks, since they live on for the next ones."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of an Arrow batch of texts, on either side of the pipe.
BATCH_BYTES = 4 << 20


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, with its session told to hand texts to workers in batches of few bytes; long texts then take no more memory
    than short ones. A smaller setting of the session stays."""
    spark, key = docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = spark.conf
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(key))
    if now > BATCH_BYTES:
        conf.set(key, f"{BATCH_BYTES}b")
    return docs


def tidy() -> None:
    """Returns freed memory of Arrow and of the C library to the system, where the latter can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
