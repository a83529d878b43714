"""Candidate tables, rates, sense profiles and their similarity."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def ranked_candidates(responses: DataFrame, keys: list[str]) -> DataFrame:
    """keys, candidate, votes, mean_rank: in how many responses a candidate occurs and its mean first place (from 1).

    responses: keys, candidates, one row per response; null and empty candidates are passed over but keep their place, of
    a repeated one the first place counts. Places are found inside the row, so one exchange does for all.
    """
    named = F.filter(F.array_distinct("candidates"), lambda c: c.isNotNull() & (c != ""))
    placed = F.transform(named, lambda c: F.struct(c.alias("candidate"), F.array_position("candidates", c).alias("i")))
    c = responses.select(*keys, F.explode(placed).alias("c"))
    return c.groupBy(*keys, F.col("c.candidate").alias("candidate")).agg(F.count(F.lit(1)).alias("votes"), F.round(F.avg("c.i"), 6).alias("mean_rank"))


def top_candidates(ranked: DataFrame, keys: list[str], n: int = 12) -> DataFrame:
    """The n candidates of each key with most votes; ties: smaller mean rank, then code-point order."""
    w = Window.partitionBy(*keys).orderBy(F.desc("votes"), "mean_rank", "candidate")
    return ranked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def accepted(ranked: DataFrame, rates: DataFrame, min_votes: int = 3, min_count: int = 100) -> DataFrame:
    """Candidates with enough votes that are known words (rates: word, cnt), frequent enough and not all katakana."""
    k = rates.where(F.col("cnt") >= min_count).select(F.col("word").alias("candidate"))
    return ranked.where((F.col("votes") >= min_votes) & ~F.col("candidate").rlike("^[ァ-ヶー・]+$")).join(k, "candidate", "left_semi")


def rates_per_million(counts: DataFrame, group: str, key: str = "term", value: str = "total") -> DataFrame:
    """group, key, cnt, rate: counts per million of the group's sum; null keys and values are left out."""
    d = counts.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    c = d.groupBy(group, key).agg(F.sum(value).alias("cnt"))
    t = d.groupBy(group).agg(F.sum(value).alias("tokens"))
    j = c.join(t, c[group].eqNullSafe(t[group])).drop(t[group])
    return j.select(group, key, "cnt", F.round(F.col("cnt") * 1e6 / F.col("tokens"), 6).alias("rate"))


def best_rates(counts: DataFrame, corpora: list[str], group: str = "corpus", key: str = "term", value: str = "total") -> DataFrame:
    """key, rate: the largest of a word's rates per million in the given corpora, 0 where it has none."""
    r = rates_per_million(counts.where(F.col(group).isin(*corpora)), group, key, value)
    words = counts.where(F.col(key).isNotNull()).select(key).distinct()
    return words.join(r.groupBy(key).agg(F.max("rate").alias("rate")), key, "left").select(key, F.coalesce("rate", F.lit(0.0)).alias("rate"))


def response_tallies(responses: DataFrame, keys: list[str]) -> DataFrame:
    """keys, responses, empty, errors: responses (candidates array, error string) in all, without a candidate, and failed."""
    named = F.filter(F.coalesce("candidates", F.array().cast("array<string>")), lambda c: c.isNotNull() & (c != ""))
    failed = F.coalesce("error", F.lit("")) != ""
    return responses.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("responses"), F.count_if(~failed & (F.size(named) == 0)).alias("empty"), F.count_if(failed).alias("errors"))


def fan_in(links: DataFrame, to: str, of: str, min_words: int = 2) -> DataFrame:
    """to, words: targets that at least min_words different words lead to."""
    d = links.where(F.col(to).isNotNull() & F.col(of).isNotNull()).select(to, of).distinct()
    return d.groupBy(to).agg(F.count(F.lit(1)).alias("words")).where(F.col("words") >= min_words)


def frame_merge(frames: DataFrame, keys: list[str]) -> DataFrame:
    """keys, field, general, general_only, law: counts of three corpora side by side, general less field not below 0.

    frames: keys, corpus (field, general, law), cnt.
    """
    one = lambda n: F.coalesce(F.sum(F.when(F.col("corpus") == n, F.col("cnt"))), F.lit(0)).alias(n)
    g = frames.groupBy(*keys).agg(one("field"), one("general"), one("law"))
    return g.select(*keys, "field", "general", F.greatest(F.col("general") - F.col("field"), F.lit(0)).alias("general_only"), "law")


def profiles(pairs: DataFrame) -> DataFrame:
    """word, context, n of rows (word, context)."""
    return pairs.where("word is not null and context is not null").groupBy("word", "context").agg(F.count(F.lit(1)).alias("n"))


#: Profile rows of a context from which it is split, and into how many.
HOT_ROWS, HOT_PARTS = 50_000, 64


def cosines(a: DataFrame, b: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """word_a, word_b, cosine of all pairs of profile words that share a context (the rest have 0).

    The inner product joins on the context, so its work is the sum over contexts of the words of a times those of b that
    have it: a should be the profiles of a stated set of words. A context of hot_rows words of b or more is dealt out by
    word to HOT_PARTS parts, each of which meets all of a's words; there are at most (rows of b / hot_rows) such contexts.
    """
    x = a.select(F.col("word").alias("word_a"), "context", F.col("n").alias("na"))
    y = b.select(F.col("word").alias("word_b"), "context", F.col("n").alias("nb"))
    hot = staged(y.groupBy("context").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= hot_rows).select("context", F.lit(True).alias("_hot")))
    if not hot.isEmpty():
        is_hot = F.coalesce("_hot", F.lit(False))
        y = y.join(F.broadcast(hot), "context", "left").withColumn("_part", F.when(is_hot, F.pmod(F.xxhash64("word_b"), F.lit(HOT_PARTS)).cast("int")).otherwise(0)).drop("_hot")
        x = x.join(F.broadcast(hot), "context", "left").withColumn("_part", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    keys = [c for c in ("context", "_part") if c in y.columns]
    dot = x.join(y, keys).where("word_a <> word_b").groupBy("word_a", "word_b").agg(F.sum(F.col("na") * F.col("nb")).alias("dot"))
    norm = lambda p, name, as_: p.groupBy(F.col("word").alias(name)).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias(as_))
    return dot.join(norm(a, "word_a", "la"), "word_a").join(norm(b, "word_b", "lb"), "word_b").select(
        "word_a", "word_b", F.round(F.col("dot") / (F.col("la") * F.col("lb")), 9).alias("cosine"))


def _frequent(names: DataFrame, col: str, totals: DataFrame | None, least: int) -> DataFrame:
    """Rows whose `col` occurs at least `least` times by totals (word, total); all rows without totals."""
    if totals is None:
        return names
    n = totals.where("word is not null").groupBy(F.col("word").alias(col)).agg(F.sum("total").alias("_t"))
    return names.join(n.where(F.col("_t") >= least).select(col), col, "left_semi")


def split_senses(groups: DataFrame, prof: DataFrame, most: float = 0.15, totals: DataFrame | None = None, min_occurrences: int = 100) -> DataFrame:
    """word, loan_a, loan_b, cosine: words two of whose loanwords have hardly a context in common.

    groups: word, loanword; prof: profiles of loanwords. Of a word's pairs the least similar one comes out, ties by name.
    totals: word, total, the occurrences of loanwords; with it, only those with min_occurrences are compared.
    """
    groups = _frequent(groups, "loanword", totals, min_occurrences)
    norms = prof.groupBy(F.col("word").alias("loanword")).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("l"))
    g = groups.select("word", "loanword").distinct().join(norms, "loanword")
    pairs = g.select("word", F.col("loanword").alias("loan_a"), F.col("l").alias("la")).join(
        g.select("word", F.col("loanword").alias("loan_b"), F.col("l").alias("lb")), "word").where("loan_a < loan_b")
    pa = pairs.join(prof.select(F.col("word").alias("loan_a"), "context", F.col("n").alias("na")), "loan_a")
    pb = prof.select(F.col("word").alias("loan_b"), "context", F.col("n").alias("nb"))
    dot = pa.join(pb, ["loan_b", "context"]).groupBy("word", "loan_a", "loan_b").agg(F.sum(F.col("na") * F.col("nb")).alias("dot"))
    c = pairs.join(dot, ["word", "loan_a", "loan_b"], "left").withColumn("cosine", F.round(F.coalesce("dot", F.lit(0)) / (F.col("la") * F.col("lb")), 9))
    w = Window.partitionBy("word").orderBy("cosine", "loan_a", "loan_b")
    return c.withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) & (F.col("cosine") <= most)).select("word", "loan_a", "loan_b", "cosine")


def sense_fit(occurrences: DataFrame, senses: DataFrame, prof: DataFrame, smoothing: float = 0.5) -> DataFrame:
    """occ_id, word, sense, fit of each occurrence's best sense: the mean log probability of its context words in the sense's profile.

    occurrences: occ_id, word, context (array); senses: word, sense; prof: profiles of senses (word, context, n). Counts
    are smoothed additively over the profile's vocabulary. Occurrences without context words have no fit and are left
    out; ties go to the smaller sense.
    """
    vocab = prof.select("context").distinct().agg(F.count(F.lit(1)).alias("v"))
    total = prof.groupBy(F.col("word").alias("sense")).agg(F.sum("n").alias("total"))
    c = occurrences.select("occ_id", "word", F.explode("context").alias("context")).where("context is not null").join(senses.select("word", "sense").distinct(), "word")
    p = c.join(prof.select(F.col("word").alias("sense"), "context", "n"), ["sense", "context"], "left").join(total, "sense", "left").join(F.broadcast(vocab))
    s = F.lit(smoothing)
    lp = F.log((F.coalesce("n", F.lit(0)) + s) / (F.coalesce("total", F.lit(0)) + s * F.col("v")))
    fit = p.groupBy("occ_id", "word", "sense").agg(F.round(F.avg(lp), 6).alias("fit"))
    w = Window.partitionBy("occ_id", "word").orderBy(F.desc("fit"), "sense")
    return fit.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def judged_senses(
    occurrences: DataFrame, senses: DataFrame, field: DataFrame, general: DataFrame, totals: DataFrame, vocabulary: int = 51313, smoothing: float = 0.5,
    min_occurrences: int = 50, fit_margin: float = 0.0, max_support: float = 1.0,
) -> DataFrame:
    """occ_id, word, loanword, fit, own, margin, support, flagged: in which sense each occurrence is used, and if that replaces a loanword.

    fit: the greatest mean log probability of the context in the field's profile of one of the word's loanwords that have
    min_occurrences; ties go to the smaller name. own: that in the word's own general profile. support: cosine of the
    loanword's field and the word's general profile, 0 without a common context. flagged: fit - own > fit_margin and
    support < max_support, of unrounded values.

    occurrences: occ_id, word, context (array, a repeated word counts each time); senses: word, loanword; field, general:
    profiles (word, context, n); totals: word, total, the field's occurrences. Occurrences without context words, or whose
    word has no loanword that is frequent enough, are left out.
    """
    def mean_fit(c: DataFrame, prof: DataFrame, key: str, name: str) -> DataFrame:
        p = prof.groupBy(F.col("word").alias(key), "context").agg(F.sum("n").alias("n"))
        t = p.groupBy(key).agg(F.sum("n").alias("t"))
        s = F.lit(smoothing)
        lp = F.log((F.coalesce("n", F.lit(0)) + s) / (F.coalesce("t", F.lit(0)) + s * F.lit(vocabulary)))
        ids = list(dict.fromkeys(["occ_id", "word", key]))
        return c.join(p, [key, "context"], "left").join(t, key, "left").groupBy(*ids).agg(F.avg(lp).alias(name))

    g = _frequent(senses.select("word", "loanword").where("word is not null and loanword is not null").distinct(), "loanword", totals, min_occurrences)
    c = occurrences.select("occ_id", "word", F.explode("context").alias("context")).where("context is not null")
    w = Window.partitionBy("occ_id", "word").orderBy(F.desc("fit"), "loanword")
    best = mean_fit(c.join(g, "word"), field, "loanword", "fit").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    norm = lambda p, key, as_: p.groupBy(F.col("word").alias(key)).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias(as_))
    one = lambda p: p.groupBy("word", "context").agg(F.sum("n").alias("n"))
    f, o = one(field), one(general)
    x = g.join(f.select(F.col("word").alias("loanword"), "context", F.col("n").alias("a")), "loanword").join(
        o.select("word", "context", F.col("n").alias("b")), ["word", "context"])
    cos = x.groupBy("word", "loanword").agg(F.sum(F.col("a") * F.col("b")).alias("dot")).join(norm(f, "loanword", "la"), "loanword").join(norm(o, "word", "lb"), "word")
    cos = cos.select("word", "loanword", (F.col("dot") / (F.col("la") * F.col("lb"))).alias("support"))
    j = best.join(mean_fit(c, general, "word", "own"), ["occ_id", "word"]).join(cos, ["word", "loanword"], "left").withColumn("support", F.coalesce("support", F.lit(0.0)))
    margin = F.col("fit") - F.col("own")
    flagged = (margin > fit_margin) & (F.col("support") < max_support)
    return j.select("occ_id", "word", "loanword", F.round("fit", 3).alias("fit"), F.round("own", 3).alias("own"), F.round(margin, 3).alias("margin"),
                    F.round("support", 3).alias("support"), flagged.alias("flagged"))


def frequent_parts(counts: DataFrame, min_rate: float = 5.0) -> DataFrame:
    """term, n: terms of two or more characters with at least min_rate of a million of all counts; at most 10**6 / min_rate.

    counts: term, total; nulls and counts not above 0 are left out.
    """
    c = counts.where("term is not null and total > 0").groupBy("term").agg(F.sum("total").alias("n"))
    least = F.lit(min_rate) * F.col("t")
    return c.join(F.broadcast(c.agg(F.sum("n").alias("t")))).where((F.length("term") >= 2) & (F.col("n") * F.lit(1e6) >= least)).select("term", "n")


def split_parts(word: Column, parts: list[str]) -> Column:
    """Greedy longest-match split of a word into two or more of the given parts; null if that leads to no split.

    At every place the longest part is taken and never given back.
    """
    known = frozenset(parts) - {None, ""}
    sizes = sorted({len(x) for x in known}, reverse=True)

    def split(w: str | None) -> list[str] | None:
        out, i = [], 0
        while w and i < len(w):
            n = next((n for n in sizes if i + n <= len(w) and w[i : i + n] in known), 0)
            if not n:
                return None
            out.append(w[i : i + n])
            i += n
        return out if len(out) >= 2 else None

    def run(words: pa.Array) -> pa.Array:
        return pa.array(map(split, words.to_pylist()), pa.list_(pa.string()))

    run.__annotations__ = {"words": pa.Array, "return": pa.Array}  # the names above are strings, which Spark doesn't resolve
    return F.arrow_udf(run, "array<string>")(word)


def with_samples(rows: DataFrame, samples: int) -> DataFrame:
    """Every row once for each sample_index from 0."""
    return rows.withColumn("sample_index", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))) if samples > 0 else rows.limit(0).withColumn("sample_index", F.lit(0))


def loan_languages(entries: DataFrame) -> DataFrame:
    """reading, languages: source languages of a reading, only if every entry of it names some and none is English.

    entries: reading, languages (array)."""
    ok = F.bool_and((F.size(F.coalesce("languages", F.array().cast("array<string>"))) > 0) & ~F.array_contains(F.coalesce("languages", F.array().cast("array<string>")), F.lit("eng")))
    g = entries.groupBy("reading").agg(ok.alias("ok"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("languages")))).alias("languages"))
    return g.where("ok").select("reading", "languages")
