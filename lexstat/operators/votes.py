"""Repeated classification votes: validity, majority over passes, disagreement between models, batching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Divisions whose words are concrete.
CONCRETE = (4, 5)


def last_wins(votes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that comes last by the order columns; nulls come first. Only the keys' rows meet in a task."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return votes.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(votes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    return votes.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def problems(votes: DataFrame, allowed: list[tuple[int, int]]) -> DataFrame:
    """word, model, pass_seed, lines, problems of every key of the votes with one: repeated, no_categories, empty,
    unsorted, repeated_category, outside_scheme."""
    cats = F.col("categories")
    inside = lambda x: F.reduce(F.array(*[x.between(a, b) for a, b in allowed]), F.lit(False), lambda acc, y: acc | y)
    tests = {
        "no_categories": cats.isNull(), "empty": F.size(cats) == 0, "unsorted": cats != F.array_sort(cats),
        "repeated_category": F.size(F.array_distinct(cats)) < F.size(cats), "outside_scheme": F.exists(cats, lambda x: ~inside(x)),
    }
    g = votes.groupBy("word", "model", "pass_seed").agg(F.count(F.lit(1)).alias("lines"), *[F.bool_or(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()])
    found = F.array_compact(F.array(F.when(F.col("lines") > 1, "repeated"), *[F.when(F.col(n), n) for n in tests]))
    return g.select("word", "model", "pass_seed", "lines", F.array_join(found, ",").alias("problems")).where("problems <> ''")


def finalized(passes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, votes, rule, unanimous, categories, dropped of each key's passes.

    passes: keys, categories (null: no pass). One pass: single-vote, kept as it is. Else the categories that at least
    two passes gave are kept; if there is one, the rule is majority, else unstable (so too where all passes agree on no
    category). unanimous: all passes gave the same set. dropped: given but not kept.
    """
    d = passes.where("categories is not null").withColumn("categories", F.array_sort(F.array_distinct("categories")))
    per = d.groupBy(*keys, "categories").agg(F.count(F.lit(1)).alias("_c"))  # however many passes, only distinct sets are collected
    g = per.groupBy(*keys).agg(F.sum("_c").alias("votes"), F.collect_list(F.struct("categories", "_c")).alias("sets"))
    every = F.array_sort(F.array_distinct(F.flatten("sets.categories")))
    given = lambda c: F.aggregate(F.filter("sets", lambda s: F.array_contains(s["categories"], c)), F.lit(0).cast("bigint"), lambda n, s: n + s["_c"])
    kept = F.when(F.col("votes") == 1, F.element_at("sets", 1)["categories"]).otherwise(F.filter(every, lambda c: given(c) >= 2))
    g = g.withColumn("categories", kept).withColumn("unanimous", F.size("sets") == 1)
    rule = F.when(F.col("votes") == 1, "single-vote").when(F.size("categories") > 0, "majority").otherwise("unstable")
    return g.select(*keys, "votes", rule.alias("rule"), "unanimous", "categories", F.array_except(every, F.col("categories")).alias("dropped"))


def rule_histogram(final: DataFrame) -> DataFrame:
    """rule, votes, unanimous, n."""
    return final.groupBy("rule", "votes", "unanimous").agg(F.count(F.lit(1)).alias("n"))


def divisions(cats: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(cats, lambda c: F.floor(c / 10).cast("int"))))


def is_concrete(cats: Column) -> Column:
    return (F.size(cats) > 0) & F.forall(cats, lambda c: F.floor(c / 10).isin(*CONCRETE))


def relation(a: Column, b: Column) -> Column:
    """equal, disjoint, containment or partial, of two sets; an empty set and another are disjoint."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0), "equal").when(both == 0, "disjoint").when(
        (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0), "containment").otherwise("partial")


def disagreement(final: DataFrame, first: str, second: str) -> DataFrame:
    """word, first, second, kind, concrete_split of words that both models judged.

    final: word, model, categories, one row per word and model. concrete_split: exactly one of the two is concrete.
    """
    a = final.where(F.col("model") == first).select("word", F.col("categories").alias("first"), F.col("unanimous").alias("u1"), F.col("votes").alias("v1"))
    b = final.where(F.col("model") == second).select("word", F.col("categories").alias("second"), F.col("unanimous").alias("u2"), F.col("votes").alias("v2"))
    j = a.join(b, "word")
    steady = F.when((F.col("v1") < 2) | (F.col("v2") < 2), "single").when(~(F.col("u1") & F.col("u2")), "wobble").otherwise("steady")
    return j.select("word", "first", "second", relation(F.col("first"), F.col("second")).alias("kind"),
                    (is_concrete(F.col("first")) != is_concrete(F.col("second"))).alias("concrete_split"), steady.alias("stability"))


def disagreement_summary(rows: DataFrame) -> DataFrame:
    """kind, stability, n, concrete_splits."""
    return rows.groupBy("kind", "stability").agg(F.count(F.lit(1)).alias("n"), F.count_if("concrete_split").alias("concrete_splits"))


def category_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """word, categories: the union of both maps' categories, sorted; a word of either is kept."""
    u = a.select("word", "categories").unionByName(b.select("word", "categories"))
    return u.groupBy("word").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))).alias("categories"))


def agreement(pairs: DataFrame, by: list[str]) -> DataFrame:
    """by, n, exact, overlap, concrete: shares of word pairs (a, b: category arrays) that agree fully, partly, in concreteness."""
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    a, b = F.col("a"), F.col("b")
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), share(relation(a, b) == "equal").alias("exact"), share(F.arrays_overlap(a, b)).alias("overlap"),
        share(is_concrete(a) == is_concrete(b)).alias("concrete"))


def division_agreement(pairs: DataFrame, by: list[str]) -> DataFrame:
    """by, division, n, both: of the word pairs (a, b: category arrays) of which one has a division, the share in which both have."""
    d = pairs.select(*by, divisions(F.col("a")).alias("_a"), divisions(F.col("b")).alias("_b"))
    d = d.select(*by, "_a", "_b", F.explode(F.array_union("_a", "_b")).alias("division"))
    both = F.array_contains("_a", F.col("division")) & F.array_contains("_b", F.col("division"))
    return d.groupBy(*by, "division").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(both.cast("double")), 6).alias("both"))


def batches(words: DataFrame, seed: int, size: int = 20) -> DataFrame:
    """word, chunk_id, chunk_index: distinct words shuffled by a seeded hash and cut into batches of `size`.

    Ranks are taken within hash ranges and offset by the ranges' sizes, so the whole list never meets in one task; a
    range that ends inside a batch lets the next go on with it.
    """
    d = words.where("word is not null").select("word").distinct().withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.col("word"))))
    d = d.withColumn("part", F.substring("h", 1, 3))
    per = d.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # at most 4096 rows
    off = per.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("o"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("h", "word")) - 1
    r = d.withColumn("r", rank).join(F.broadcast(off), "part").withColumn("at", F.col("r") + F.col("o"))
    return r.select("word", F.floor(F.col("at") / size).alias("chunk_id"), (F.col("at") % size).alias("chunk_index"))


def to_do(words: DataFrame, done: DataFrame) -> DataFrame:
    """Words that no earlier run has answered."""
    return words.where("word is not null").select("word").distinct().join(done.select("word"), "word", "left_anti")


def class_codes(cats: Column, prefix: str) -> Column:
    """Tab-joined class numbers like 1.1100 of a category array."""
    return F.array_join(F.transform(cats, lambda c: F.concat(F.lit(f"{prefix}."), c.cast("string"), F.lit("00"))), "\t")


def halves(rows: DataFrame, size: int = 20) -> DataFrame:
    """front, back: mean number of categories in the first and second half of a batch. rows: chunk_index, categories."""
    n = F.size("categories").cast("double")
    front = F.col("chunk_index") < size // 2
    return rows.where("categories is not null").agg(F.avg(F.when(front, n)).alias("front"), F.avg(F.when(~front, n)).alias("back"))


def imported(old: DataFrame, done: DataFrame, contexts: DataFrame, contract: str) -> DataFrame:
    """Older votes (word, categories, model, date) in today's form, with the word's context, for words not done yet."""
    d = old.join(done.select("word", "model").distinct(), ["word", "model"], "left_anti").join(contexts.select("word", "context"), "word", "left")
    return d.select("word", "categories", "model", "date", F.lit(contract).alias("contract"), F.col("context").alias("context_used"))
