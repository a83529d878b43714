"""Topics, domains, counts of words by domain, and registration of words with domains."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Domain codes and names.
DOMAINS = {1: "情報技術", 2: "その他の理工", 3: "文化", 4: "地理", 5: "社会", 6: "行政", 7: "法令", 8: "一般"}
#: The score from which a tag counts, the least documents of a word registered by share, and the number of
#: domains that makes it general.
MIN_SCORE, MIN_TOTAL, GENERAL_DOMAINS = 500, 5, 3
GENERAL = 8
LAW_STYLE = "法令文"
#: Topics of information technology, and how the topics of the other article domains begin.
TECHNOLOGY = ("STEM.Computing", "STEM.Technology")
TOPIC_STARTS = {2: "STEM", 3: "Culture", 4: "Geography", 5: "History_and_Society"}


def tag_score(tag: Column) -> tuple[Column, Column]:
    """Topic and score of a tag like prefix/topic*|score; both null if it has no number."""
    return F.regexp_extract(tag, r"^(?:[^/|]*/)?([^/|*]+)\*?\|\d+$", 1), F.regexp_extract(tag, r"\|(\d+)$", 1).try_cast("int")


def topic_domain(topic: Column) -> Column:
    out = F.when(topic.isin(*TECHNOLOGY), 1)
    for code, start in TOPIC_STARTS.items():
        out = out.when(topic.startswith(start), code)
    return out


def domain_labels(domains: Column) -> Column:
    """Names of an array of domain codes in code order, joined by ・."""
    names = F.create_map(*[F.lit(x) for kv in DOMAINS.items() for x in kv])
    return F.array_join(F.transform(F.array_sort(domains), lambda c: F.try_element_at(names, c)), "・")


def tag_domains(tags: Column, min_score: int = MIN_SCORE) -> Column:
    """Sorted distinct domain codes of an article's tags with enough score; null tags give an empty array."""
    def one(t: Column) -> Column:
        topic, score = tag_score(t)
        return F.when(score >= min_score, topic_domain(topic))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.coalesce(tags, F.array().cast("array<string>")), one))))


def has_topic(tags: Column, topics: list[str], min_score: int = MIN_SCORE) -> Column:
    def one(t: Column) -> Column:
        topic, score = tag_score(t)
        return F.coalesce(topic.isin(topics) & (score >= min_score), F.lit(False))
    return F.exists(tags, one)


def source_domain(name: Column, styles: Column, it_prefixes: list[str]) -> Column:
    """Law if a style says so, information technology by the name's part before the first hyphen, else administration."""
    return F.when(F.array_contains(F.coalesce(styles, F.array().cast("array<string>")), LAW_STYLE), 7).when(
        F.element_at(F.split(name, "-"), 1).isin(it_prefixes), 1).otherwise(6)


def law_era(law_id: Column) -> tuple[Column, Column]:
    """Era (1 to 5) and year of a law id; both null if its first three characters are no such digits."""
    era = F.regexp_extract(law_id, r"^([1-5])\d\d", 1)
    ok = era != ""
    return F.when(ok, era.cast("int")), F.when(ok, F.substring(law_id, 2, 2).cast("int"))


def is_classical(law_id: Column) -> Column:
    """Laws of the first two eras and of the third before year 22; null for unreadable ids."""
    era, year = law_era(law_id)
    return (era < 3) | ((era == 3) & (year < 22))


def domain_pairs(rows: DataFrame, id_col: str = "doc_id", distinct: bool = False) -> DataFrame:
    """word, domain, docs: documents of each domain that hold the word; a document of several domains counts in each.

    rows: id, word, domains. Words are made distinct per document before the domains are spread out; distinct: they are
    so already, which saves an exchange of all rows.
    """
    d = rows.where("word is not null").select(id_col, "word", "domains")
    d = d if distinct else d.dropDuplicates([id_col, "word"])
    return d.select("word", F.explode("domains").alias("domain")).groupBy("word", "domain").agg(F.count(F.lit(1)).alias("docs"))


def domain_tallies(docs: DataFrame) -> DataFrame:
    """domain, documents; domains without documents are left out."""
    return docs.select(F.explode("domains").alias("domain")).groupBy("domain").agg(F.count(F.lit(1)).alias("documents"))


def register_by_count(pairs: DataFrame, min_docs: int = 5, general_threshold: int = 5) -> DataFrame:
    """word, domain: domains with at least min_docs documents; with general_threshold or more of them, the general one alone."""
    return _folded(pairs.where(F.col("docs") >= min_docs), general_threshold)


def register_by_share(pairs: DataFrame, share: float = 0.2, min_total: int = MIN_TOTAL, general_domains: int = GENERAL_DOMAINS, general_min_total: int | None = None) -> DataFrame:
    """word, domain: domains that hold at least `share` of the sum of the word's documents over domains.

    Words of fewer than min_total are left out. General alone are words of general_min_total or more (looked at first),
    of general_domains or more domains, and those no domain of which has its share.
    """
    g = pairs.where("word is not null").groupBy("word", "domain").agg(F.sum("docs").alias("docs")).groupBy("word").agg(
        F.sum("docs").alias("total"), F.collect_list(F.struct("domain", "docs")).alias("per"))  # at most eight domains a word
    ds = F.array_sort(F.transform(F.filter("per", lambda x: x["docs"] >= F.lit(share) * F.col("total")), lambda x: x["domain"]))
    general = (F.size(ds) == 0) | (F.size(ds) >= general_domains)
    if general_min_total is not None:
        general = general | (F.col("total") >= general_min_total)
    return g.where(F.col("total") >= min_total).select("word", F.explode(F.when(general, F.array(F.lit(GENERAL))).otherwise(ds)).alias("domain"))


def _folded(d: DataFrame, general_threshold: int) -> DataFrame:
    g = d.groupBy("word").agg(F.array_sort(F.collect_set("domain")).alias("ds"))  # at most eight domains a word
    return g.select("word", F.explode(F.when(F.size("ds") >= general_threshold, F.array(F.lit(GENERAL))).otherwise(F.col("ds"))).alias("domain"))


def domain_key(domain: Column, word: Column) -> Column:
    """word<tab>code: the key of a word's registration in a domain; the word may be empty."""
    return F.concat(word, F.lit("\t"), domain.cast("string"))


def split_domain_key(key: Column) -> tuple[Column, Column]:
    """Word and code of a domain_key; both null unless it ends in a tab and a code of 1 to 8."""
    ok = key.rlike("(?s)^.*\t[1-8]$")
    return F.when(ok, F.regexp_extract(key, "(?s)^(.*)\t[1-8]$", 1)), F.when(ok, F.substring(key, -1, 1).cast("int"))


def domain_bits(domain: Column) -> Column:
    """Aggregate: the set of domain codes as bits."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), domain - 1))


#: Words whose automaton is shipped to the tasks at once.
WORD_BLOCK = 200_000


def _blocks(words: DataFrame) -> Iterator[list[str]]:
    block: list[str] = []
    for r in words.toLocalIterator():
        block.append(r[0])
        if len(block) == WORD_BLOCK:
            yield block
            block = []
    if block:
        yield block


def word_hits(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, keep, word: which of the words each text holds, overlapping hits included, each word once a text.

    The words are a stated set: blocks of WORD_BLOCK of them become an automaton that reads every text once. words: word,
    distinct and not empty. Null texts hold nothing.
    """
    texts = docs.where("text is not null").select("text", id_col, *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema[1:]) + ", word string"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(words):
        found = found.unionByName(texts.mapInArrow(_automaton(block), schema))
    return found


def _automaton(block: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        a = ahocorasick.Automaton()
        for w in block:
            a.add_word(w, w)
        a.make_automaton()
        for b in batches:
            at, out = [], []
            for i, t in enumerate(b.column(0).to_pylist()):
                hits = {w for _, w in a.iter(t)}
                at += [i] * len(hits)
                out += hits
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[1:]), pa.array(out, pa.string())], names=[*b.schema.names[1:], "word"])
    return run


def topic_distribution(docs: DataFrame, words: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """word, articles, one column per domain, it_share: articles whose text holds the word, by domain.

    docs: id (unique), text, domains; words: word. it_share has four digits, null where no article holds the word.
    """
    w = words.where("word is not null and word <> ''").select("word").distinct()
    codes = sorted({1, *TOPIC_STARTS})
    agg = word_hits(docs, w, id_col, ("domains",)).groupBy("word").agg(
        F.count(F.lit(1)).alias("articles"), *[F.count_if(F.array_contains("domains", F.lit(c))).alias(f"d{c}") for c in codes])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return w.join(agg, "word", "left").select(
        "word", zero("articles"), *[zero(f"d{c}") for c in codes], F.round(F.col("d1") / F.col("articles"), 4).alias("it_share"))
