"""Evaluation of detectors: matrices, intervals, sweeps, differences of runs, strata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the normal quantile of a 95 % interval.
Z = 1.96


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """Lower and upper end of Wilson's interval; 0 and 0 for no trials."""
    p, z2 = k / n, Z * Z
    mid = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    end = lambda c: F.when(n == 0, 0.0).otherwise(F.round(c, 6))
    return end(F.greatest(mid - half, F.lit(0.0))), end(F.least(mid + half, F.lit(1.0)))


def matrix(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, tp, fp, fn, tn, precision, recall and the precision's Wilson interval of rows (by, truth, flagged).

    Rows with a null truth are outside and not counted; a null flag is no flag.
    """
    t, f = F.col("truth"), F.coalesce("flagged", F.lit(False))
    g = rows.where("truth is not null").groupBy(*by).agg(
        F.count_if(t & f).alias("tp"), F.count_if(~t & f).alias("fp"), F.count_if(t & ~f).alias("fn"), F.count_if(~t & ~f).alias("tn"))
    lo, hi = wilson(F.col("tp"), F.col("tp") + F.col("fp"))
    share = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.round(F.col(a) / (F.col(a) + F.col(b)), 6))
    return g.select(*by, "tp", "fp", "fn", "tn", share("tp", "fp").alias("precision"), share("tp", "fn").alias("recall"), lo.alias("low"), hi.alias("high"))


def any_true(rows: DataFrame, by: list[str]) -> DataFrame:
    """Occurrences put together: truth and flag of a group are true if any of its rows' is."""
    return rows.groupBy(*by).agg(F.bool_or("truth").alias("truth"), F.bool_or("flagged").alias("flagged"))


def sweep(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold and matrix columns for every threshold over rows (truth, score), in one pass."""
    t = F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")
    return matrix(rows.select("truth", "score", t).select("threshold", "truth", (F.col("score") >= F.col("threshold")).alias("flagged")), ["threshold"])


def exempted(findings: DataFrame, exempt: DataFrame) -> DataFrame:
    """Findings whose normalised form (word) and surface are both outside the exempt words (word)."""
    x = exempt.where("word is not null").select("word").distinct()
    return findings.join(x, "word", "left_anti").join(x.select(F.col("word").alias("surface")), "surface", "left_anti").select(*findings.columns)


def conditions(rows: DataFrame, cases: list[tuple[str, float, list[str]]], exemptions: DataFrame) -> DataFrame:
    """condition and matrix columns for every case (name, threshold, names of exemption lists), in one pass.

    rows: word, surface, score, truth; exemptions: list, word. A row is flagged if its score reaches the threshold and
    neither its word nor its surface is in one of the case's lists.
    """
    lists = exemptions.where("word is not null").groupBy("word").agg(F.collect_set("list").alias("ls"))  # few lists
    d = rows.join(lists.select("word", F.col("ls").alias("_a")), "word", "left").join(lists.select(F.col("word").alias("surface"), F.col("ls").alias("_b")), "surface", "left")
    none = F.array().cast("array<string>")
    held = F.concat(F.coalesce("_a", none), F.coalesce("_b", none))
    case = F.explode(F.array(*[F.struct(F.lit(n).alias("condition"), F.lit(float(t)).alias("t"), F.array(*map(F.lit, ls)).cast("array<string>").alias("ls")) for n, t, ls in cases]))
    d = d.select("truth", "score", held.alias("held"), case.alias("c"))
    flagged = (F.col("score") >= F.col("c.t")) & ~F.arrays_overlap("held", "c.ls")
    return matrix(d.select(F.col("c.condition").alias("condition"), "truth", flagged.alias("flagged")), ["condition"])


def first_rows(rows: DataFrame, order: str, n: int = 50) -> DataFrame:
    """The first n rows in order; fewer are an error."""
    got = rows.orderBy(order).limit(n)
    if got.count() < n:
        raise ValueError(f"fewer than {n} rows")
    return got


def run_difference(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, change: lost, gained or kept, of two runs' distinct findings."""
    u = old.select(*keys).distinct().withColumn("o", F.lit(1)).withColumn("n", F.lit(0)).unionByName(
        new.select(*keys).distinct().withColumn("o", F.lit(0)).withColumn("n", F.lit(1)))
    g = u.groupBy(*keys).agg(F.max("o").alias("o"), F.max("n").alias("n"))
    return g.select(*keys, F.when(F.col("o") == 0, "gained").when(F.col("n") == 0, "lost").otherwise("kept").alias("change"))


def stratified_precision(strata: DataFrame, labels: DataFrame) -> DataFrame:
    """estimate, total: precision over all findings from labelled samples of each stratum.

    strata: stratum, n (findings); labels: stratum, ok. A stratum without labels counts as all wrong.
    """
    rate = labels.groupBy("stratum").agg(F.avg(F.col("ok").cast("double")).alias("p"))
    j = strata.join(rate, "stratum", "left")
    return j.agg(F.round(F.sum(F.col("n") * F.coalesce("p", F.lit(0.0))) / F.sum("n"), 6).alias("estimate"), F.sum("n").alias("total"))


def matched(findings: DataFrame, truth: DataFrame, primary: list[str], fallback: list[str]) -> DataFrame:
    """findings with the truth of the primary key, else of the fallback key, else outside = true.

    truth: the key columns and truth; of several rows with one key truth is true if any is.
    """
    by = lambda keys, name: truth.groupBy(*keys).agg(F.bool_or("truth").alias(name))
    j = findings.join(by(primary, "t1"), primary, "left").join(by(fallback, "t2"), fallback, "left")
    t = F.coalesce("t1", "t2")
    return j.select(*findings.columns, t.alias("truth"), t.isNull().alias("outside"))


def jaccard(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """both, either, jaccard of the distinct keys of two tables; null if both are empty."""
    d = run_difference(a, b, keys)
    g = d.agg(F.count_if(F.col("change") == "kept").alias("both"), F.count(F.lit(1)).alias("either"))
    return g.select("both", "either", F.when(F.col("either") > 0, F.round(F.col("both") / F.col("either"), 6)).alias("jaccard"))


def hashed_sample(rows: DataFrame, id_col: str, n: int, seed: int, strata: list[str] | None = None) -> DataFrame:
    """n rows (of every stratum) with the smallest seeded hash of their id: the same rows on every run."""
    from pyspark.sql import Window
    h = rows.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    if not strata:
        return h.orderBy("_h", id_col).limit(n).drop("_h")
    w = Window.partitionBy(*strata).orderBy("_h", id_col)
    return h.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n", "_h")


def mode_share(rows: DataFrame, group: str, value: str) -> DataFrame:
    """group, n, mode, share: each group's most frequent value (ties: the smaller) and its share; null values are left out."""
    from pyspark.sql import Window
    c = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(group)
    r = F.row_number().over(w.orderBy(F.desc("c"), value))
    d = c.withColumn("n", F.sum("c").over(w)).withColumn("_r", r).where("_r = 1")
    return d.select(group, "n", F.col(value).alias("mode"), F.round(F.col("c") / F.col("n"), 6).alias("share"))


def dominated(conditions: DataFrame) -> DataFrame:
    """The conditions (condition, tp, fp) with dominated: some other has no fewer hits and no more false ones, and differs.

    Conditions are few: one row per threshold and exemption list, so ordering them all is no matter.
    """
    from pyspark.sql import Window
    g = conditions.groupBy("tp", "fp").agg(F.collect_list("condition").alias("cs"))
    before = F.max("tp").over(Window.orderBy("fp", F.desc("tp")).rowsBetween(Window.unboundedPreceding, -1))
    d = g.withColumn("dominated", F.coalesce(before >= F.col("tp"), F.lit(False)))
    return d.select(F.explode("cs").alias("condition"), "tp", "fp", "dominated")


def review_queue(candidates: DataFrame, labels: DataFrame, findings: DataFrame, keys: list[str]) -> DataFrame:
    """keys, label, found, only_detector: every candidate with its label and whether a detector found it, then the
    detector's findings that are no candidates."""
    c = candidates.select(*keys).distinct()
    f = findings.select(*keys).distinct().withColumn("found", F.lit(True))
    lab = labels.groupBy(*keys).agg(F.max("label").alias("label"))
    mine = c.join(lab, keys, "left").join(f, keys, "left").select(*keys, "label", F.coalesce("found", F.lit(False)).alias("found"), F.lit(False).alias("only_detector"))
    rest = f.join(c, keys, "left_anti").select(*keys, F.lit(None).cast("string").alias("label"), "found", F.lit(True).alias("only_detector"))
    return mine.unionByName(rest)


def topic_words(coined: DataFrame, established: DataFrame, n: int = 50) -> DataFrame:
    """word, grp: coined and repurposed words of an evaluation file (row_no, word, category; reworded ones are left out), and
    the first n of the established ones, of which there must be so many."""
    kept = coined.where(F.col("category").isin("意味の転用", "造語")).select("word", F.col("category").alias("grp"))
    return kept.unionByName(first_rows(established, "row_no", n).select("word", F.lit("既存語").alias("grp")))
