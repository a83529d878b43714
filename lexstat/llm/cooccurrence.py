"""Pairs of words that occur together, with stripes.

Every map task keeps an associative array (a stripe) per word of the neighbours seen with it and writes it out when it
holds more than STRIPE_ENTRIES entries, cut into SEGMENTS by a hash of the neighbour. Partial stripes are shuffled and
sorted by word and segment, and each run of them is merged into one array; so the stripe of a word that is in a third
of all records is merged by many tasks, each holding the word's distinct neighbours of one segment at a time.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank
from ..session import staged

PLACEHOLDER = "ZZCODEZZ"
#: Entries that a map task's stripes may hold before they are written out.
STRIPE_ENTRIES = 200_000
#: Parts of a stripe that are merged apart.
SEGMENTS = 64
#: Rows of a batch of merged pairs.
OUT_ROWS = 20_000


def records(df: DataFrame) -> DataFrame:
    """occ_id, word, others (distinct words of the context without the word itself), each occ_id once.

    Rows with a null occ_id or without a word are no records; null and blank entries and the code placeholder are no words.
    """
    word = ~blank(F.col("word")) & (F.col("word") != PLACEHOLDER)
    d = df.where(F.col("occ_id").isNotNull() & word).select("occ_id", "word", "context").dropDuplicates(["occ_id"])
    others = F.array_distinct(F.filter(
        F.coalesce(F.col("context"), F.array().cast("array<string>")),
        lambda x: x.isNotNull() & ~blank(x) & (x != F.lit(PLACEHOLDER)) & (x != F.col("word")),
    ))
    return d.select("occ_id", "word", others.alias("others"))


def _stripes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stripes: dict[str, Counter] = {}
    held = 0

    def flush() -> pd.DataFrame:
        rows = []
        for a, stripe in stripes.items():
            parts = defaultdict(dict)
            for o, n in stripe.items():
                parts[zlib.crc32(o.encode()) % SEGMENTS][o] = n
            rows += [(a, k, list(x), list(x.values())) for k, x in parts.items()]
        return pd.DataFrame(rows, columns=["word_a", "segment", "neighbours", "counts"])

    for pdf in batches:
        for w, others in zip(pdf["word"], pdf["others"]):
            for o in others:
                a, b = (w, o) if w < o else (o, w)
                s = stripes.setdefault(a, Counter())
                held += b not in s
                s[b] += 1
            if held > STRIPE_ENTRIES:
                yield flush()
                stripes, held = {}, 0
    if stripes:
        yield flush()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the merged stripes; the rows come sorted by word_a and segment."""
    key, stripe = None, Counter()
    out: tuple[list, list, list] = ([], [], [])

    def close() -> None:
        if stripe:
            for col, x in zip(out, ([key[0]] * len(stripe), stripe, stripe.values())):
                col.extend(x)

    def batch() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["word_a", "word_b", "n_ab"])
        for col in out:
            col.clear()
        return done

    for b in batches:
        for a, segment, neighbours, counts in zip(*(c.to_pylist() for c in b.columns)):
            if (a, segment) != key:
                close()
                key, stripe = (a, segment), Counter()
                if len(out[0]) >= OUT_ROWS:
                    yield batch()
            if stripe:
                for o, n in zip(neighbours, counts):
                    stripe[o] += n
            else:
                stripe.update(dict(zip(neighbours, counts)))
    close()
    yield batch()


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))


def pair_counts(df: DataFrame) -> DataFrame:
    """word_a, word_b (smaller first by code point), n_ab, n_a, n_b, n, expected, lift, llr for every pair.

    n_ab: records that pair the two, either way round; n_a, n_b: records that hold each as word or context; n: records.
    llr: Dunning's log-likelihood ratio of the 2 x 2 table, signed negative when the pair is rarer than chance. Tables
    without a record give no rows.
    """
    recs = staged(records(df))  # read three times below
    stripes = recs.where("size(others) > 0").select("word", "others").mapInPandas(
        _stripes, "word_a string, segment int, neighbours array<string>, counts array<bigint>")
    pairs = stripes.repartition("word_a", "segment").sortWithinPartitions("word_a", "segment").mapInArrow(_merged, "word_a string, word_b string, n_ab bigint")
    single = (
        recs.select(F.explode(F.concat(F.array("word"), "others")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n_w"))
    )
    n = recs.agg(F.count(F.lit(1)).alias("n"))
    j = (
        pairs.join(single.select(F.col("w").alias("word_a"), F.col("n_w").alias("n_a")), "word_a")
        .join(single.select(F.col("w").alias("word_b"), F.col("n_w").alias("n_b")), "word_b")
        .join(F.broadcast(n))
    )
    k11, k12, k21 = (x.cast("double") for x in (F.col("n_ab"), F.col("n_a") - F.col("n_ab"), F.col("n_b") - F.col("n_ab")))
    k22 = (F.col("n") - F.col("n_a") - F.col("n_b") + F.col("n_ab")).cast("double")
    tot = F.col("n").cast("double")
    llr = 2 * (_xlogx(k11) + _xlogx(k12) + _xlogx(k21) + _xlogx(k22) + _xlogx(tot)
               - _xlogx(k11 + k12) - _xlogx(k21 + k22) - _xlogx(k11 + k21) - _xlogx(k12 + k22))
    expected = F.col("n_a").cast("double") * F.col("n_b") / tot
    return j.select(
        "word_a", "word_b", "n_ab", "n_a", "n_b", "n", expected.alias("expected"), (k11 / expected).alias("lift"),
        (F.when(k11 < expected, -1.0).otherwise(1.0) * F.greatest(llr, F.lit(0.0))).alias("llr"),
    )


def linked(pairs: DataFrame, min_records: int = 5, per_records: int = 10_000, min_lift: int = 10) -> DataFrame:
    """The pairs with n_ab >= min_records, n_ab * per_records >= n and at least min_lift times the chance count.

    Products are exact decimals: they do not overflow however large the counts.
    """
    n_ab, n_a, n_b, n = (F.col(c).cast("decimal(19,0)") for c in ("n_ab", "n_a", "n_b", "n"))
    enough = n_ab * F.lit(per_records).cast("decimal(9,0)") >= n
    return pairs.where((n_ab >= min_records) & enough & (n_ab * n >= n_a * n_b * F.lit(min_lift).cast("decimal(9,0)")))
