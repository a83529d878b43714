"""Most frequent terms in bounded memory, by exact prefix refinement.

Terms are hashed to 64 bits. A pass counts hash prefixes of 16 bits (at most 65,536 groups); prefixes whose sum cannot
reach the bound are dropped with all their terms; those left are lengthened by 8 bits at a time, then to whole terms.
A prefix's sum is never below that of any of its terms, so nothing is lost and the counts are exact. No more than
(sum of all counts / bound) prefixes outlive a pass, and the next one groups at most 256 times as many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import folded
from ..session import staged

#: Bits of the hash that the passes look at, before whole terms.
LEVELS = (16, 24, 32, 40)
#: Terms that may be left for the last pass, if there were 2^32 of them in all.
FEW = 1 << 20


def valid_lines(df: DataFrame) -> DataFrame:
    """h, term, cnt: each (run_id, line_no) once; lines with a null or blank term or a null or non-positive count left out.

    A null run_id or line_no names no line, so such a row counts as it stands.
    """
    lines = df.where("cnt > 0 and term is not null").select("run_id", "line_no", "term", "cnt")
    named = lines.where("run_id is not null and line_no is not null").dropDuplicates(["run_id", "line_no"])
    rest = lines.where("run_id is null or line_no is null")
    t = named.unionByName(rest).select(folded(F.col("term")).alias("term"), "cnt").where("term <> ''")
    return t.select(F.xxhash64("term").alias("h"), "term", "cnt")


def _prefix(bits: int) -> Column:
    return F.shiftright(F.col("h"), 64 - bits)


def _sums(lines: DataFrame, bits: int) -> DataFrame:
    return lines.groupBy(_prefix(bits).alias("p")).agg(F.sum("cnt").alias("s"))


def _within(lines: DataFrame, bits: int, prefixes: DataFrame) -> DataFrame:
    return lines.withColumn("p", _prefix(bits)).join(prefixes.select("p"), "p", "left_semi").drop("p")


def _refine(lines: DataFrame, bound: float, first: DataFrame | None = None) -> DataFrame:
    """term, total of all terms that can reach the bound; first: the sums of the first level, if they are known."""
    kept = lines
    for bits in LEVELS:
        sums = first if first is not None and bits == LEVELS[0] else staged(_sums(kept, bits))
        left = sums.where(F.col("s") >= bound)
        kept = _within(kept, bits, left)
        if left.count() << max(0, 32 - bits) <= FEW:
            break  # even of four billion terms few are under these prefixes
    return kept.groupBy("term").agg(F.sum("cnt").alias("total"))


def heavy_terms(df: DataFrame, share: float = 0.001) -> DataFrame:
    """term, total, share of all terms that make up at least `share` of the sum of all counts.

    At most 1/share prefixes survive a pass, so that is the memory needed. Redelivered lines count once, broken lines
    (null or blank term, null or non-positive count) not at all; spellings equal after NFKC, lower case and trimming
    are one term. An empty table gives no rows; other columns are ignored.
    """
    lines = staged(valid_lines(df))
    whole = lines.agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]
    terms = _refine(lines, share * whole)
    return terms.where(F.col("total") >= F.lit(share * whole)).select("term", "total", (F.col("total") / F.lit(float(max(whole, 1)))).alias("share"))


def top_terms(df: DataFrame, k: int = 100) -> DataFrame:
    """term, total, rank of the k terms with the largest totals; ties go to the smaller term by code point.

    The bound is the kth largest exact total among the terms under the k prefixes of 16 bits with the largest sums: at
    least k terms, unless there are fewer altogether, reach it. Fewer than k distinct terms: all come out. Nulls,
    repeats and spellings as in heavy_terms.
    """
    lines = staged(valid_lines(df))
    first = staged(_sums(lines, LEVELS[0]))
    under = _within(lines, LEVELS[0], first.orderBy(F.desc("s"), "p").limit(k))
    low = under.groupBy("term").agg(F.sum("cnt").alias("total")).orderBy(F.desc("total")).limit(k).agg(F.min("total"), F.count(F.lit(1))).first()
    top = _refine(lines, low[0] if low[1] == k else 0, first).orderBy(F.desc("total"), "term").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), "term")))
