"""Writers. Text forms are for exchange; Parquet is what later steps read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_counts(counts: DataFrame, path: str, key: str = "key") -> None:
    """key<tab>count lines in key order; the sort is by ranges, so the files in order are one sorted table."""
    counts.orderBy(key).select(F.concat_ws("\t", key, F.col("cnt").cast("string"))).write.mode("overwrite").text(path)


def write_nouns(nouns: DataFrame, path: str) -> None:
    """word, total and alone, largest totals first; alone is left empty where it is 0."""
    n = nouns.orderBy(F.desc("total"), "word").select("word", "total", F.when(F.col("alone") > 0, F.col("alone")).alias("alone"))
    n.write.mode("overwrite").csv(path, sep="\t", nullValue="", quote="")


def write_artifact(table: DataFrame, path: str, key: str = "key", partitions: int | None = None) -> None:
    """An exact lookup table: hash-partitioned by key and sorted inside each file, so a lookup reads few row groups."""
    (table.repartition(partitions, key) if partitions else table.repartition(key)).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def write_flattened(docs: DataFrame, path: str) -> None:
    """source, out_path (path.txt), text, one folder a source."""
    docs.select("source", F.concat("path", F.lit(".txt")).alias("out_path"), "text").write.mode("overwrite").partitionBy("source").parquet(path)


def write_occurrences(rows: DataFrame, path: str, order: list[str]) -> None:
    rows.orderBy(*order).write.mode("overwrite").json(path)


def append_votes(votes: DataFrame, done: DataFrame | None, path: str) -> None:
    """Votes on words not answered yet, appended as JSON lines: a rerun adds nothing twice."""
    new = votes if done is None else votes.join(done.select("word").distinct(), "word", "left_anti")
    new.write.mode("append").json(path)


def write_class_table(words: DataFrame, path: str, prefix: str, header: list[str] = ()) -> None:
    """`word<tab>prefix.mm00...` lines in word order under # lines."""
    codes = F.array_join(F.transform("categories", lambda c: F.concat(F.lit(f"{prefix}."), c.cast("string"), F.lit("00"))), "\t")
    spark = words.sparkSession
    head = spark.createDataFrame([(i, "# " + h) for i, h in enumerate(header)], "o bigint, line string")
    body = words.select(F.lit(2**40).alias("o"), F.concat_ws("\t", "word", codes).alias("line"))
    head.unionByName(body).orderBy("o", "line").select("line").write.mode("overwrite").text(path)


def write_index(pairs: DataFrame, path: str) -> None:
    """word, entries: one JSON line a word with its entries in order."""
    pairs.groupBy("word").agg(F.array_sort(F.collect_set("entry")).alias("entries")).orderBy("word").write.mode("overwrite").json(path)


def write_stats(stats: dict, path: str) -> None:
    """A small JSON sidecar, written by the driver."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(stats, f, ensure_ascii=False, indent=1, sort_keys=True)
