"""Frequency of every distinct term, and of the records that hold it.

Method: (kind, term, record) keys are range-partitioned and sorted externally, the deliveries of a record's term latest
first. A run-length scan of the sorted partitions keeps the first delivery of each record, sums occurrences and counts
records. A range boundary may fall between two records of one term, never inside a record, so a term that holds a third
of all rows is spread over many tasks; only the first and last run of a partition, which may be parts of a term's, are
added up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import folded
from ..session import staged

_RUNS = "kind string, term string, occurrences bigint, alone bigint, records bigint, edge boolean"


def valid_counts(df: DataFrame) -> DataFrame:
    """record_id, kind, term, total, alone, loaded_at of rows with a term, a record and a positive total."""
    return (
        df.where("total > 0 and record_id is not null and kind is not null and term is not null")
        .select("record_id", "kind", folded(F.col("term")).alias("term"), "total", "alone", "loaded_at")
        .where("term <> ''")
    )


def sorted_counts(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """kind, term, record_id, total, alone in ranges of kind, term and record, each sorted, the valid delivery of a record first.

    That is the one with the latest loaded_at, ties by larger total, then larger alone. One shuffle; the sort spills.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["kind", "term", "record_id"]
    order = [*keys, F.desc_nulls_last("loaded_at"), F.desc("total"), F.desc_nulls_last("alone")]
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*order).select(*keys, "total", "alone")


def _changes(cols: list[pa.Array], before: tuple | None) -> np.ndarray:
    """Which rows differ from the row before them in any of the columns; before: the values ahead of the first row."""
    out = np.zeros(len(cols[0]), bool)
    for c in cols:
        out[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    out[0] = before is None or any(c[0].as_py() != x for c, x in zip(cols, before))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of kind and term in sorted rows; edge: the first and the last of them."""
    open_run, last, first = None, None, True

    def emit(kind: list, term: list, sums: list, edge: list) -> pa.RecordBatch:
        cols = [pa.array(x, pa.int64()) for x in zip(*sums)]
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(term, pa.string()), *cols, pa.array(edge)], names=["kind", "term", "occurrences", "alone", "records", "edge"])

    for b in batches:
        if not len(b):
            continue
        kind, term, record = b.columns[:3]
        fresh = _changes([kind, term, record], last)
        new = _changes([kind, term], last[:2] if last else None)
        last = (kind[-1].as_py(), term[-1].as_py(), record[-1].as_py())
        start = np.flatnonzero(new)
        alone = pc.fill_null(b.column(4), 0).to_numpy(zero_copy_only=False) * fresh
        value = [b.column(3).to_numpy(zero_copy_only=False) * fresh, alone, fresh.astype(np.int64), (fresh & pc.is_valid(b.column(4)).to_numpy(zero_copy_only=False)).astype(np.int64)]
        head = start[0] if len(start) else len(b)
        if head:
            open_run[1] += [x[:head].sum() for x in value]
        if not len(start):
            continue
        sums = np.stack([np.add.reduceat(x, start) for x in value], 1)
        kinds, terms = kind.take(pa.array(start)).to_pylist(), term.take(pa.array(start)).to_pylist()
        done = [] if open_run is None else [(*open_run[0], open_run[1])]
        done += list(zip(kinds[:-1], terms[:-1], sums[:-1]))
        open_run = [(kinds[-1], terms[-1]), sums[-1].copy()]
        if done:
            rows = [(int(s[0]), int(s[1]) if s[3] else None, int(s[2])) for _, _, s in done]
            yield emit([k for k, _, _ in done], [t for _, t, _ in done], rows, [first and i == 0 for i in range(len(done))])
            first = False
    if open_run is not None:
        s = open_run[1]
        yield emit([open_run[0][0]], [open_run[0][1]], [(int(s[0]), int(s[1]) if s[3] else None, int(s[2]))], [True])


def term_frequencies(df: DataFrame, rare_below: int = 3, common_above: float = 0.2, partitions: int | None = None) -> DataFrame:
    """kind, term, occurrences, alone, records, share, verdict for every term of every kind.

    Input: record_id, kind, term, total, alone, loaded_at. Rows with a null or blank term, a null record or kind, or
    a null or non-positive total do not count. Redelivered rows count once; of corrected rows the latest loaded_at
    holds. Spellings equal after NFKC, lower case and trimming are one term. verdict: rare (occurrences <
    rare_below), common (in more than common_above of all records with a valid row), else useful; a term both rare
    and common is common. An empty table gives no rows; other columns are ignored.
    """
    valid = staged(valid_counts(df))  # spellings are folded once; the ranges, the rows and the records are read from it
    runs = staged(sorted_counts(valid, partitions).mapInArrow(_scan, _RUNS))
    edges = runs.where("edge").groupBy("kind", "term").agg(*[F.sum(c).alias(c) for c in ("occurrences", "alone", "records")])
    terms = runs.where("not edge").drop("edge").unionByName(edges)
    n = valid.select("record_id").distinct().agg(F.count(F.lit(1)).alias("n_records"))
    share = F.col("records") / F.col("n_records")
    return terms.join(F.broadcast(n)).select(
        "kind", "term", "occurrences", "alone", "records", share.alias("share"),
        F.when(F.col("records") > F.lit(common_above) * F.col("n_records"), "common")
        .when(F.col("occurrences") < rare_below, "rare").otherwise("useful").alias("verdict"),
    )
