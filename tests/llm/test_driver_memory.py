"""What a fit sends to its tasks is let go by the driver's JVM as soon as the fit is done."""

import time

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, language_id


def held(spark, base=0, patience=10):
    """Bytes of blocks in the driver's memory, once they have fallen near `base` or time is up."""
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().memoryStore()
    end = time.time() + patience
    while store.memoryUsed() > base + (1 << 20) and time.time() < end:
        time.sleep(0.2)
    return store.memoryUsed()


def test_fits_leave_no_broadcast_behind(spark):
    words = F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), F.col("id") % (k + 7)) for k in range(12)])
    docs = spark.range(400).select(F.col("id").alias("doc_id"), words.alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    before = held(spark, patience=0)
    latent = decontaminate.fit(docs, docs.limit(20), np.ones(1 << decontaminate.BITS, np.float32))
    assert held(spark, before) < before + (1 << 20)
    usable = docs.select("text", "lang")
    state = language_id._learnt(usable, ["de", "en"], 400)
    assert held(spark, before) < before + (1 << 20)
    assert latent.base.shape == (1 << decontaminate.BITS, decontaminate.RANK) and len(state.bias) == 2
