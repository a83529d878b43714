"""Command line: the counting, building and judging commands over files, each one a plan of the operators.

    python -m lexstat.cli count --dump DUMP --out-dir OUT [--topics T ...] [--limit N] [--domains]
    python -m lexstat.cli count --text-dir DIR | --corpus-dir DIR --out-dir OUT [--exclude NAME ...]
    ... count-nouns, count-cooccurrence, count-case-frames, extract-occurrences, extract-subtrees,
        dictionary-headwords, article-titles, flatten, build, judge, query, topic-distribution
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.markup import flatten_text
from .operators import build, counts, domains, features, judge
from .session import exists, get_spark
from .sources import readers, sinks

#: Defaults of build and judge.
BUILD = {"counts_weight": 1.0, "docs_weight": 2.0, "corpus_weight": 2.0, "min_count": 3, "min_component_count": 3, "domain_min_count": 5, "general_threshold": 5}


def documents(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """doc_id, source, text, domains of the one input given; with a limit, the first documents in path or page order."""
    if a.dump:
        d = readers.articles(spark, a.dump, a.topics or None)
        d = d.select(F.col("page_id").cast("string").alias("doc_id"), F.lit("dump").alias("source"), "text", domains.tag_domains(F.col("weighted_tags")).alias("domains"))
        order = [F.col("doc_id").cast("bigint")]
    else:
        d = readers.text_tree(spark, a.text_dir or a.corpus_dir, a.exclude or [])
        d = d.select(F.col("path").alias("doc_id"), "source", "text", F.array(domains.source_domain(F.col("source"), F.lit(None).cast("array<string>"), [])).alias("domains"))
        order = [F.col("doc_id")]
    return d.orderBy(*order).limit(a.limit) if a.limit else d


def _out(a: argparse.Namespace, name: str) -> str:
    return os.path.join(a.out_dir, name)


def count(spark: SparkSession, a: argparse.Namespace) -> None:
    d = documents(spark, a)
    once = not a.dump
    unknown = not a.count_known_only
    counts.compound_counts(d, by_document=once, unknown=unknown).write.mode("overwrite").parquet(_out(a, "compounds"))
    counts.component_counts(d, by_document=once).write.mode("overwrite").parquet(_out(a, "components"))
    if a.domains:
        rows = counts.compound_rows(d, ["doc_id", "domains"], unknown).withColumnRenamed("key", "word")
        domains.domain_pairs(rows).write.mode("overwrite").parquet(_out(a, "domains"))
    counts.source_sizes(d).write.mode("overwrite").parquet(_out(a, "sources"))


def count_nouns(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_nouns(counts.noun_counts(documents(spark, a)), _out(a, "noun-counts"))


def count_cooccurrence(spark: SparkSession, a: argparse.Namespace) -> None:
    d, t = documents(spark, a), readers.target_words(spark, a.targets)
    counts.cooccurrence(d, t).write.mode("overwrite").parquet(_out(a, "pairs"))
    counts.noun_counts(d).join(t, "word", "left_semi").write.mode("overwrite").parquet(_out(a, "targets"))


def count_case_frames(spark: SparkSession, a: argparse.Namespace) -> None:
    frames = spark.read.schema("word string, `case` string, predicate string").json(a.frames)
    counts.case_frames(frames).write.mode("overwrite").parquet(_out(a, "case-frames"))


def extract_occurrences(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_occurrences(counts.occurrences(documents(spark, a), readers.target_words(spark, a.targets)), _out(a, "occurrences"), ["doc_id", "chunk_no", "start"])


def extract_subtrees(spark: SparkSession, a: argparse.Namespace) -> None:
    trees = spark.read.schema("occ_id bigint, centre bigint, nodes array<struct<id:bigint,parent:bigint,lemma:string,relation:string>>").json(a.trees)
    features.fragments(trees).write.mode("overwrite").json(_out(a, "subtrees"))


def dictionary_headwords(spark: SparkSession, a: argparse.Namespace) -> None:
    w = readers.lexicon(spark, a.lexicon_dir)
    w = w if a.proper_nouns else w.where("kind <> 'proper'")
    w.select(F.col("word").alias("key"), F.lit(build.HEADWORD_BUCKET).alias("bucket"), "kind").write.mode("overwrite").parquet(_out(a, "headwords"))


def article_titles(spark: SparkSession, a: argparse.Namespace) -> None:
    d = readers.articles(spark, a.dump)
    readers.registrable_names(d.orderBy("page_id").limit(a.limit) if a.limit else d).write.mode("overwrite").parquet(_out(a, "titles"))


def flatten(spark: SparkSession, a: argparse.Namespace) -> None:
    m = readers.raw_manifest(spark, os.path.join(a.raw_dir, "manifest.tsv")).select(F.col("name").alias("source"), "format")
    d = readers.text_tree(spark, a.raw_dir, pattern="*.{md,mdx,po,rst}").join(m, "source")
    out = d.select("source", "path", flatten_text(F.col("format"), F.col("text")).alias("text")).where("text <> ''")
    sinks.write_flattened(out, _out(a, "text"))
    written = spark.read.parquet(_out(a, "text"))
    counts.source_sizes(written).write.mode("overwrite").parquet(_out(a, "manifest"))


def build_artifacts(spark: SparkSession, a: argparse.Namespace) -> None:
    inputs = [(n, p, w) for n, p, w in (("wiki", a.counts_dir, a.counts_weight), ("docs", a.docs_counts_dir, a.docs_weight), ("corpus", a.corpus_counts_dir, a.corpus_weight)) if p]
    weights = {n: w for n, _, w in inputs}

    def union(table: str, key: str) -> DataFrame:
        parts = [spark.read.parquet(os.path.join(p, table)).select(F.lit(n).alias("input"), F.col(key).alias("key"), "cnt") for n, p, _ in inputs]
        return build.weighted_union(_all(parts), weights)

    b = build.bucketed(union("compounds", "key"), a.min_count)
    for h in (a.headwords, a.titles):
        b = build.overlay(b, spark.read.parquet(h)) if h else b
    sinks.write_artifact(b, _out(a, "buckets"))
    pieces = b.where("bucket < 7").select(F.col("key").alias("compound"), F.regexp_extract_all("key", F.lit("[A-Za-z]+|[ァ-ヶー]+|[一-龥々]{1,2}"), F.lit(0)).alias("surfaces"))
    partners = build.partner_counts(pieces).withColumn("is_long", F.lit(False))
    parts = build.components(union("components", "part").withColumnRenamed("key", "part"), partners, a.min_component_count)
    sinks.write_artifact(parts, _out(a, "components"), "part")
    have = [os.path.join(p, "domains") for _, p, _ in inputs]
    if all(exists(spark, p) for p in have):
        pairs = _all([spark.read.parquet(p) for p in have]).groupBy("word", "domain").agg(F.sum("docs").alias("docs"))
        reg = (domains.register_by_share(pairs, a.domain_share_threshold, general_min_total=a.general_min_total) if a.domain_share_threshold
               else domains.register_by_count(pairs, a.domain_min_count, a.general_threshold))
        sinks.write_artifact(reg, _out(a, "domains"), "word")
    sinks.write_stats(build.manifest(spark.read.parquet(_out(a, "buckets")), spark.read.parquet(_out(a, "components")), weights, a.version), _out(a, "manifest.json"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _judged(spark: SparkSession, a: argparse.Namespace, words: DataFrame) -> DataFrame:
    read = lambda n: spark.read.parquet(os.path.join(a.artifacts_dir, n))
    dom = read("domains") if exists(spark, os.path.join(a.artifacts_dir, "domains")) else None
    unit_dirs = [p for p in (a.counts_dir, a.docs_counts_dir) if p]
    units = judge.composition_units(*[spark.read.parquet(os.path.join(p, "compounds")) for p in unit_dirs]) if unit_dirs else None
    domain = judge.document_domain(a.document_domain) if a.document_domain else None
    return judge.judged(words, read("buckets"), read("components"), dom, units, a.threshold, a.concatenation, a.upper, a.lower, domain)


#: Rows of a written table that a command shows.
PREVIEW = 20


def _put(spark: SparkSession, a: argparse.Namespace, rows: DataFrame, name: str) -> None:
    """All rows as a table in --out-dir, else beside the artifacts, and the first of them on the screen."""
    path = os.path.join(a.out_dir or a.artifacts_dir, name)
    rows.write.mode("overwrite").parquet(path)
    spark.read.parquet(path).orderBy("word").show(PREVIEW, False)


def judge_words(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.concatenation == "composition" and not a.counts_dir:
        raise ValueError("--concatenation composition needs --counts-dir")
    if a.words:
        words = spark.createDataFrame([(w,) for w in a.words], "word string")
        judged = _judged(spark, a, words)
        _put(spark, a, judged.join(judge.rendered(judged), "word"), "judgments")
        return
    coined, established = readers.eval_words(spark, a.eval[0]), [readers.eval_words(spark, p) for p in a.eval[1:]]
    every = _all([x.select("word") for x in (coined, *established)])
    judged = _judged(spark, a, every)
    tables = [x.join(judged, "word").select(F.lit(os.path.basename(p)).alias("set"), "row_no", "word", F.lit(None).cast("string").alias("category"), "verdict", "reason") for p, x in zip(a.eval[1:], established)]
    if established or a.categories:  # the first file holds coined words by category
        rows = judge.collected(judged, coined).select(F.lit("coined").alias("set"), "row_no", "word", "category", "verdict", "reason")
    else:
        rows = coined.join(judged, "word").select(F.lit(os.path.basename(a.eval[0])).alias("set"), "row_no", "word", "category", "verdict", "reason")
    rows = _all([rows, *tables])
    _put(spark, a, rows, "judgments")
    judge.confusion(rows.withColumn("group", F.coalesce("category", "set")), "group").show(PREVIEW, False)


def query_words(spark: SparkSession, a: argparse.Namespace) -> None:
    read = lambda n: spark.read.parquet(os.path.join(a.artifacts_dir, n))
    found = judge.lookup(spark.createDataFrame([(w,) for w in a.words], "word string"), read("buckets"), read("components"))
    _put(spark, a, found.select("word", F.coalesce(F.col("bucket").cast("string"), F.lit("未登録")).alias("bucket"), "parts"), "lookups")


def topic_distribution(spark: SparkSession, a: argparse.Namespace) -> None:
    d = readers.articles(spark, a.dump)
    d = d.orderBy("page_id").limit(a.limit) if a.limit else d
    t = domains.topic_distribution(d.select("page_id", "text", domains.tag_domains(F.col("weighted_tags")).alias("domains")), readers.target_words(spark, a.words_file), "page_id")
    t.orderBy("word").write.mode("overwrite").parquet(_out(a, "topics"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexstat")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, run, text_input=False, dump_only=False, targets=False):
        c = sub.add_parser(name)
        c.set_defaults(run=run, dump=None, text_dir=None, corpus_dir=None, topics=None, exclude=None, limit=None)
        c.add_argument("--out-dir", default=".")
        if text_input or dump_only:
            c.add_argument("--limit", type=int)
        if dump_only:
            c.add_argument("--dump", required=True)
        if text_input:
            g = c.add_mutually_exclusive_group(required=True)
            g.add_argument("--dump")
            g.add_argument("--text-dir")
            g.add_argument("--corpus-dir")
            c.add_argument("--topics", nargs="*")
            c.add_argument("--exclude", nargs="*")
        if targets:
            c.add_argument("--targets", required=True)
        return c

    c = command("count", count, text_input=True)
    c.add_argument("--count-known-only", action="store_true")
    c.add_argument("--domains", action="store_true")
    command("count-nouns", count_nouns, text_input=True)
    command("count-cooccurrence", count_cooccurrence, text_input=True, targets=True)
    command("count-case-frames", count_case_frames).add_argument("--frames", required=True)
    command("extract-occurrences", extract_occurrences, text_input=True, targets=True)
    command("extract-subtrees", extract_subtrees).add_argument("--trees", required=True)
    c = command("dictionary-headwords", dictionary_headwords)
    c.add_argument("--lexicon-dir", required=True)
    c.add_argument("--proper-nouns", action="store_true")
    command("article-titles", article_titles, dump_only=True)
    command("flatten", flatten).add_argument("--raw-dir", required=True)
    c = command("build", build_artifacts)
    for n in ("counts-dir", "docs-counts-dir", "corpus-counts-dir", "headwords", "titles"):
        c.add_argument(f"--{n}", required=n == "counts-dir")
    for n, v in BUILD.items():
        c.add_argument(f"--{n.replace('_', '-')}", type=type(v), default=v)
    c.add_argument("--domain-share-threshold", type=float)
    c.add_argument("--general-min-total", type=int)
    c.add_argument("--version", default="")
    c = command("judge", judge_words)
    c.set_defaults(out_dir=None)
    c.add_argument("words", nargs="*")
    c.add_argument("--eval", nargs="+")
    c.add_argument("--categories", action="store_true")
    c.add_argument("--docs-counts-dir")
    c.add_argument("--artifacts-dir", required=True)
    c.add_argument("--counts-dir")
    c.add_argument("--threshold", type=int, default=judge.THRESHOLD)
    c.add_argument("--concatenation", choices=judge.RULES, default="off")
    c.add_argument("--upper", type=int, default=judge.UPPER)
    c.add_argument("--lower", type=int, default=judge.LOWER)
    c.add_argument("--document-domain", choices=[v for k, v in domains.DOMAINS.items() if k != domains.GENERAL])
    c = command("query", query_words)
    c.set_defaults(out_dir=None)
    c.add_argument("words", nargs="+")
    c.add_argument("--artifacts-dir", required=True)
    command("topic-distribution", topic_distribution, dump_only=True).add_argument("--words-file", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(get_spark("lexstat"), a)


if __name__ == "__main__":
    main()
