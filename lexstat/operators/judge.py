"""Judging words against frequency artifacts, and evaluating the judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..morph import regex_morphemes
from ..session import staged
from .domains import DOMAINS, GENERAL, domain_labels
from .segment import is_whole_span

#: Default thresholds.
THRESHOLD, UPPER, LOWER = 1000, 300, 100
RULES = ("off", "established", "gray", "composition")
#: Fixed value: least count of a unit of composition.
MIN_UNIT = 3
#: Names of verdicts, reasons, and kinds of collected words.
VERDICTS = {"Established": "既存語", "Gray": "グレー", "RepurposeCandidate": "転用の候補", "Coined": "造語の候補", "NotCandidate": "候補外"}
REASONS = {"Dictionary": "辞書", "HighFrequency": "高頻度", "LowFrequency": "低頻度", "Concatenation": "連結", "Composition": "構成", "Domain": "分野", "Constituent": "部品", "Unregistered": "未登録", "Span": "区間"}
COLLECTED = ("造語", "言い換え", "意味の転用")
UNREGISTERED = "未登録"


def judged(
    words: DataFrame, buckets: DataFrame, parts: DataFrame, domains: DataFrame | None = None, units: DataFrame | None = None,
    threshold: int = THRESHOLD, rule: str = "off", upper: int = UPPER, lower: int = LOWER, document_domain: int | None = None, provider=regex_morphemes,
) -> DataFrame:
    """word, verdict, reason and, with a document's domain, domains (codes, sorted, else empty) of every distinct non-null word.

    buckets: key, bucket; parts: part, frequency; domains: word, domain; units: key, cnt. A word that is no whole span
    is no candidate. Bucket 7 makes it established by dictionary, 2 to 5 by frequency, 1 gray. An established word
    whose domains are neither general nor the document's becomes a repurpose candidate by domain. Without a bucket, words of
    three or more morphemes first go through the rule on their adjacent pairs or splits; the rest is coined, by
    constituents if every part is more frequent than threshold, else as unregistered.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if lower > upper:
        raise ValueError("lower must not exceed upper")
    if document_domain == GENERAL:
        raise ValueError("a document's domain cannot be the general one")
    w = words.where("word is not null").select("word").distinct().withColumn("ms", provider(F.col("word")))
    w = w.withColumn("candidate", is_whole_span(F.col("ms")) & (F.size("ms") > 0)).withColumn("surfaces", F.transform("ms", lambda m: m["surface"]))
    w = staged(w.withColumn("norm", F.array_join(F.transform("ms", lambda m: m["norm"]), "")).drop("ms"))
    # the words are few beside the tables they are looked up in, which are first cut down to what is asked
    i = F.sequence(F.lit(1), F.greatest(F.size("surfaces") - 1, F.lit(1)))
    pairs_of = F.when(F.size("surfaces") >= 3, F.transform(i, lambda k: F.concat(F.element_at("surfaces", k), F.element_at("surfaces", k + 1)))).otherwise(F.array().cast("array<string>"))
    b = _asked(buckets, "key", w, F.concat(F.array("word", "norm"), pairs_of)).groupBy("key").agg(F.max("bucket").alias("bucket"))
    parts = _asked(parts, "part", w, F.col("surfaces"))
    w = w.join(b.select(F.col("key").alias("word"), F.col("bucket").alias("b1")), "word", "left")
    w = w.join(b.select(F.col("key").alias("norm"), F.col("bucket").alias("b2")), "norm", "left").withColumn("bucket", F.coalesce("b1", "b2"))
    w = staged(w)  # the lookups below all start from it
    cand = w.where("candidate")

    ratio = (
        cand.select("word", F.explode("surfaces").alias("part")).join(parts.groupBy("part").agg(F.max("frequency").alias("frequency")), "part", "left")
        .groupBy("word").agg(F.min(F.coalesce("frequency", F.lit(0))).alias("ratio"))
    )
    w = w.join(ratio, "word", "left")

    verdict = [("NotCandidate", "Span", ~F.col("candidate")), ("Established", "Dictionary", F.col("bucket") == 7),
               ("Established", "HighFrequency", F.col("bucket") >= 2), ("Gray", "LowFrequency", F.col("bucket") == 1)]
    long = F.col("bucket").isNull() & (F.size("surfaces") >= 3)
    if rule in ("established", "gray"):
        pairs = cand.where(long).select("word", F.explode(pairs_of).alias("key"))
        ok = pairs.join(b, "key", "left").groupBy("word").agg(F.bool_and(F.coalesce(F.col("bucket") >= 2, F.lit(False))).alias("pairs_known"))
        w = w.join(ok, "word", "left")
        verdict.append(("Established" if rule == "established" else "Gray", "Concatenation", F.coalesce("pairs_known", F.lit(False))))
    elif rule == "composition":
        w = w.join(composition_scores(cand.where(long), units, parts), "word", "left")
        verdict += [("Coined", "Composition", long & (F.col("best") >= upper)), ("Gray", "Composition", long & (F.col("best") >= lower)), ("Coined", "Unregistered", long)]
    verdict += [("Coined", "Constituent", F.col("ratio") > threshold), ("Coined", "Unregistered", F.lit(True))]
    pick = None
    for v, r, test in verdict:
        value = F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("reason"))
        pick = F.when(test, value) if pick is None else pick.when(test, value)
    w = w.withColumn("v", pick)
    if domains is not None and document_domain is not None:
        sets = domains.groupBy("word").agg(F.collect_set("domain").alias("ds"))
        w = w.join(sets, "word", "left").join(sets.select(F.col("word").alias("norm"), F.col("ds").alias("ds2")), "norm", "left")
        ds = F.coalesce("ds", "ds2")
        strange = ds.isNotNull() & ~F.array_contains(ds, F.lit(GENERAL)) & ~F.array_contains(ds, F.lit(document_domain))
        moved = (F.col("v.verdict") == "Established") & F.coalesce(strange, F.lit(False))
        w = w.withColumn("v", F.when(moved, F.struct(F.lit("RepurposeCandidate").alias("verdict"), F.lit("Domain").alias("reason"))).otherwise(F.col("v")))
        return w.select("word", "v.verdict", "v.reason", F.array_sort(F.coalesce(ds, F.array().cast("array<int>"))).alias("domains"))
    return w.select("word", "v.verdict", "v.reason")


def _asked(table: DataFrame, key: str, words: DataFrame, keys: Column) -> DataFrame:
    """The rows of a table whose key is among the words' keys (array)."""
    return table.join(words.select(F.explode(keys).alias(key)).distinct(), key, "left_semi")


def rendered(judgments: DataFrame) -> DataFrame:
    """word, text: verdict and reason by their names, parted by a tab; a reason by domain names the word's domains."""
    name = lambda names, c: F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col(c))
    reason = name(REASONS, "reason")
    if "domains" in judgments.columns:
        reason = F.when(F.col("reason") == "Domain", F.concat(reason, F.lit("("), domain_labels(F.col("domains")), F.lit(")"))).otherwise(reason)
    return judgments.select("word", F.concat_ws("\t", name(VERDICTS, "verdict"), reason).alias("text"))


def document_domain(label: str) -> int:
    """The code of a domain's name; a document can't be of the general one."""
    code = next((k for k, v in DOMAINS.items() if v == label), None)
    if code is None or code == GENERAL:
        raise ValueError("a document's domain is one of " + "・".join(v for k, v in DOMAINS.items() if k != GENERAL))
    return code


def composition_units(*counts: DataFrame) -> DataFrame:
    """key, cnt: counts of all inputs (key, cnt) together, where they come to MIN_UNIT; null keys and counts are left out."""
    every = counts[0].select("key", "cnt")
    for c in counts[1:]:
        every = every.unionByName(c.select("key", "cnt"))
    return every.where("key is not null and cnt is not null").groupBy("key").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= MIN_UNIT)


def composition_scores(words: DataFrame, units: DataFrame, parts: DataFrame) -> DataFrame:
    """word, best: over all splits of a word in two, the largest smaller count of its halves.

    words: word, surfaces. A half of one morpheme takes its frequency as a part, a longer one its count as a unit;
    absent ones count 0.
    """
    s = words.select("word", "surfaces", F.explode(F.sequence(F.lit(1), F.size("surfaces") - 1)).alias("k"))
    side = lambda a, n: F.array_join(F.slice("surfaces", a, n), "")
    halves = s.select("word", "k", F.explode(F.array(
        F.struct(side(F.lit(1), F.col("k")).alias("key"), (F.col("k") == 1).alias("single")),
        F.struct(side(F.col("k") + 1, F.size("surfaces") - F.col("k")).alias("key"), (F.size("surfaces") - F.col("k") == 1).alias("single")))).alias("h")).select("word", "k", "h.key", "h.single")
    table = parts.select(F.col("part").alias("key"), F.lit(True).alias("single"), F.col("frequency").alias("n")).unionByName(
        units.select("key", F.lit(False).alias("single"), F.col("cnt").alias("n")))
    table = table.join(halves.select("key", "single").distinct(), ["key", "single"], "left_semi").groupBy("key", "single").agg(F.max("n").alias("n"))
    low = halves.join(table, ["key", "single"], "left").groupBy("word", "k").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))
    return low.groupBy("word").agg(F.max("n").alias("best"))


#: Partner counts of a part, in the order in which they are shown.
PARTNERS = ("prefix_foreign", "prefix_kango", "suffix_foreign", "suffix_kango")


def lookup(words: DataFrame, buckets: DataFrame, parts: DataFrame, long_units: Column | None = None, provider=regex_morphemes) -> DataFrame:
    """word, bucket (null: not registered), parts as `part:frequency:` and the four partner counts, in order.

    The bucket is the surface's, else the normalised form's. parts: part, frequency and PARTNERS, as far as they are
    there; what is missing counts 0. long_units: the word's long units (array), shown behind the parts.
    """
    w = words.where("word is not null").select("word", *([long_units.alias("_l")] if long_units is not None else [])).distinct().withColumn("ms", provider(F.col("word")))
    w = w.withColumn("_norm", F.array_join(F.transform("ms", lambda x: x["norm"]), ""))
    shown = F.transform("ms", lambda x: x["surface"])
    if long_units is not None:
        shown = F.concat(shown, F.coalesce("_l", F.array().cast("array<string>")))
    have = ["frequency", *[c for c in PARTNERS if c in parts.columns]]
    per = parts.groupBy("part").agg(*[F.max(c).alias(c) for c in have])
    m = w.select("word", "_norm", F.posexplode_outer(shown).alias("i", "part")).join(per, "part", "left")
    cell = F.concat_ws(":", "part", *[F.coalesce(c, F.lit(0)).cast("string") if c in have else F.lit("0") for c in ("frequency", *PARTNERS)])
    rows = m.groupBy("word", "_norm").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", cell.alias("s")))), lambda x: x["s"]), " ").alias("parts"))
    b = buckets.groupBy("key").agg(F.max("bucket").alias("bucket"))
    rows = rows.join(b.select(F.col("key").alias("word"), F.col("bucket").alias("_b1")), "word", "left").join(b.select(F.col("key").alias("_norm"), F.col("bucket").alias("_b2")), "_norm", "left")
    return rows.select("word", F.coalesce("_b1", "_b2").alias("bucket"), "parts")


def collected(judgments: DataFrame, rows: DataFrame) -> DataFrame:
    """row_no, word, category, verdict, reason of every row of an evaluation file; a category outside COLLECTED is an error.

    rows: row_no, word, category.
    """
    bad = F.raise_error(F.concat(F.lit("row "), F.col("row_no").cast("string"), F.lit(": no category among " + "・".join(COLLECTED))))
    checked = rows.withColumn("category", F.when(F.col("category").isin(*COLLECTED), F.col("category")).otherwise(bad.cast("string")))
    return checked.join(judgments, "word").select("row_no", "word", "category", "verdict", "reason")


def tallies(judgments: DataFrame, group: str | None = None) -> DataFrame:
    """group, verdict, reason, n."""
    keys = [*([group] if group else []), "verdict", "reason"]
    return judgments.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def confusion(judgments: DataFrame, group: str) -> DataFrame:
    """group, total, candidates, one column per verdict, and the share of candidates judged coined as text."""
    v = F.col("verdict")
    n = lambda x: F.count_if(v == x).alias(x.lower())
    g = judgments.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.count_if(v != "NotCandidate").alias("candidates"),
                                     *[n(x) for x in ("NotCandidate", "Established", "Gray", "Coined", "RepurposeCandidate")])
    return g.withColumn("coined_ratio", ratio_text(F.col("coined"), F.col("candidates")))


def ratio_text(k: Column, n: Column) -> Column:
    """n/d (p%), or 0/0; the percentage has one digit, rounded half up."""
    return F.when(n == 0, "0/0").otherwise(F.concat_ws("", k.cast("string"), F.lit("/"), n.cast("string"), F.lit(" ("), F.round(100.0 * k / n, 1).cast("decimal(6,1)").cast("string"), F.lit("%)")))
