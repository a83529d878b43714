"""Lines repeated across one source's pages, by content-defined chunking.

The letters of a line (NFKC, lower case, all else disregarded) are cut into chunks where a hash rolling over WINDOW
letters meets a mask, so cuts depend on the content alone. Rolling starts anew at a line break: the chunks of a line
are then the same on every page whatever stands around it, and a repeated line has only repeated chunks. Distinct
pages are counted per source and chunk; of lines all of whose chunks recur often enough, the pages that have the whole
line (a 64-bit hash of its letters) are counted.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from ._batches import pieces
from ._pages import latest_pages

WINDOW = 4
#: A cut is made where the rolling hash ends in this many zero bits, so every 8 letters on average.
MASK_BITS = 3
MIN_CHUNK = 4
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def line_letters(line: str) -> str:
    return "".join(filter(str.isalpha, unicodedata.normalize("NFKC", line).lower()))


def chunk_lines(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line number and 64-bit hash of every chunk, and the hash of every line, of lines of letters (none empty)."""
    size = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    n = len(codes)
    c = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(29)
    end = np.cumsum(size)
    start = end - size
    line = np.repeat(np.arange(len(lines)), size)
    at = np.arange(n) - start[line]
    roll = np.zeros(n, dtype=np.uint64)
    for j in range(WINDOW):
        if j >= n:
            break
        roll[j:] += np.where(at[j:] >= j, c[: n - j], 0).astype(np.uint64) * np.uint64(pow(_BASE, j, 2**64))
    roll ^= roll >> np.uint64(31)
    cut = ((roll * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - MASK_BITS)) == 0
    cut &= (at + 1 >= MIN_CHUNK)
    cut &= (end[line] - np.arange(n) - 1 >= MIN_CHUNK)
    cut[end - 1] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate([[0], ends[:-1]])
    power = np.ones(n + 1, dtype=np.uint64)
    np.cumprod(np.full(n, _BASE, dtype=np.uint64), out=power[1:])
    inverse = np.ones(n + 1, dtype=np.uint64)
    np.cumprod(np.full(n, _INVERSE, dtype=np.uint64), out=inverse[1:])
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(c * power[:-1], out=prefix[1:])
    span = lambda a, b: (prefix[b] - prefix[a]) * inverse[a] ^ (b - a).astype(np.uint64)
    return line[starts], span(starts, ends).view(np.int64), span(start, end).view(np.int64)


_CHUNKS = "source_name string, page_id bigint, line_no int, line_key bigint, chunks array<bigint>"


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (x for whole in batches for x in pieces(whole, 2)):
        src, page, no, letters = [], [], [], []
        for s, p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for i, x in enumerate(t.split("\n")):
                if x := line_letters(x):
                    src.append(s)
                    page.append(p)
                    no.append(i)
                    letters.append(x)
        if not letters:
            continue
        of, hashes, keys = chunk_lines(letters)
        offsets = np.searchsorted(of, np.arange(len(letters) + 1)).astype(np.int32)
        chunks = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(src), pa.array(page, pa.int64()), pa.array(no, pa.int32()), pa.array(keys), chunks],
            names=["source_name", "page_id", "line_no", "line_key", "chunks"])


def _often(counts: DataFrame, pages: DataFrame, share: float, least: int) -> DataFrame:
    return counts.join(pages, "source_name").where((F.col("n") >= least) & (F.col("n") >= F.lit(share) * F.col("n_pages")))


#: Rows of a table of frequent chunks or lines up to which it is broadcast; SALTS copies of a larger one are joined.
BROADCAST_ROWS, SALTS = 500_000, 16


def _join_frequent(rows: DataFrame, frequent: DataFrame, keys: list[str], how: str) -> DataFrame:
    """rows joined with a staged table of few rows a key, so that no task gets all rows of a hot key."""
    if frequent.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(frequent), keys, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return salted.join(frequent.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "_salt"], how).drop("_salt")


def repeated_lines(articles: DataFrame, share: float = 0.06, least: int = 3) -> DataFrame:
    """page_id, line_no, source_name, n, n_pages of every line that is in at least `share` of its source's pages and `least` of them.

    Of a page the row with the latest fetched_at holds; pages with null or empty text or a null source are left out.
    Lines (split at line feeds, 0-based) are the same if their letters agree after NFKC and lower-casing; lines without
    letters never count; a line counts once a page. An empty table gives no rows; other columns are ignored.
    """
    pages = latest_pages(articles, "source_name", "text").where("source_name is not null and text <> ''")
    lines = staged(pages.select("source_name", "page_id", "text").mapInArrow(_chunk, _CHUNKS).union(
        pages.select("source_name", "page_id", F.lit(-1), F.lit(None).cast("bigint"), F.lit(None).cast("array<bigint>"))))
    sizes = lines.where("line_no = -1").groupBy("source_name").agg(F.count(F.lit(1)).alias("n_pages"))
    lines = lines.where("line_no >= 0")
    chunks = (
        lines.groupBy("source_name", "page_id").agg(F.array_distinct(F.flatten(F.collect_list("chunks"))).alias("c"))
        .select("source_name", F.explode("c").alias("chunk"))
        .groupBy("source_name", "chunk").agg(F.count(F.lit(1)).alias("n"))
    )
    often = staged(_often(chunks, sizes, share, least).select("source_name", "chunk"))
    spread_out = lines.select("source_name", "page_id", "line_no", "line_key", F.size("chunks").alias("k"), F.explode("chunks").alias("chunk"))
    whole = staged(
        _join_frequent(spread_out, often, ["source_name", "chunk"], "left_semi")
        .groupBy("source_name", "page_id", "line_no", "line_key", "k").agg(F.count(F.lit(1)).alias("got")).where("got = k")
        .select("source_name", "page_id", "line_no", "line_key")
    )
    exact = whole.select("source_name", "page_id", "line_key").distinct().groupBy("source_name", "line_key").agg(F.count(F.lit(1)).alias("n"))
    keys = staged(_often(exact, sizes, share, least))
    return _join_frequent(whole, keys, ["source_name", "line_key"], "inner").select("page_id", "line_no", "source_name", "n", "n_pages")


def without_repeated_lines(articles: DataFrame, share: float = 0.06, least: int = 3) -> DataFrame:
    """page_id, source_name, text, n_removed: the valid version of every page without its repeated lines.

    Pages with null text or source come out as they are, with n_removed 0.
    """
    bad = repeated_lines(articles, share, least).groupBy("page_id").agg(F.collect_set("line_no").alias("bad"))
    pages = latest_pages(articles, "source_name", "text").join(bad, "page_id", "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.coalesce("bad", F.array().cast("array<int>")), i)), "\n")
    return pages.select("page_id", "source_name", F.when(F.col("bad").isNull(), F.col("text")).otherwise(kept).alias("text"),
                        F.when(F.col("bad").isNull(), 0).otherwise(F.size("bad")).alias("n_removed"))
