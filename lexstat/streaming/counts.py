"""Streaming forms: running keyed counts, windowed counts with late data, idempotent append. Beyond a batch rerun they
keep state, so the key space must be bounded or watermarked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.counts import compound_rows
from ..session import exists


def running_compounds(docs: DataFrame, **kw) -> DataFrame:
    """key, cnt over a stream of documents (output mode update or complete)."""
    return compound_rows(docs, [], **kw).groupBy("key").agg(F.count(F.lit(1)).alias("cnt"))


def windowed_counts(events: DataFrame, time: str, by: str, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """start, by, n per time window; events later than `late` are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, every), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), by, "n")


#: Folders that the keys of an appended table are hashed into.
KEY_PARTS = 256


def append_new(stream: DataFrame, path: str, key: str, checkpoint: str):
    """Appends each key of the stream once to a Parquet table; rows of keys that are there already are passed over.

    The table is partitioned by key_part, a hash of the key, and a batch reads only the keys of the parts it touches. A
    batch that is run again after a failure finds its own rows and adds none. Null keys count as one key.
    """
    part = F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int")

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key]).withColumn("key_part", part)
        if exists(spark, path):
            touched = [r[0] for r in new.select("key_part").distinct().collect()]  # at most KEY_PARTS
            done = spark.read.parquet(path).where(F.col("key_part").isin(touched)).select(F.col(key).alias("_done"), F.col("key_part").alias("_part"))
            new = new.join(done, (F.col("key_part") == F.col("_part")) & F.col(key).eqNullSafe(F.col("_done")), "left_anti")
        new.write.mode("append").partitionBy("key_part").parquet(path)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
