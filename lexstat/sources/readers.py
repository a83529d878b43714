"""Readers: dumps, text trees, manifests, dictionaries, counts, votes, findings. All are scans with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..morph import regex_morphemes
from ..operators.segment import is_registrable
from ..session import exists

RECORD = "namespace bigint, page_id bigint, title string, text string, weighted_tags array<string>, redirect array<struct<namespace:bigint,title:string>>"
VOTE = ("word string, categories array<int>, model string, date string, contract string, context_used string, tier string, jmdict_priority boolean, "
        "source string, chunk_id string, chunk_index int, pass_seed bigint")
CANDIDATE = ("axis string, loanword string, sense string, english string, candidates array<string>, sample_index int, model string, temperature double, "
             "prompt_version string, date string, error string")
RAW_MANIFEST = ["name", "repo", "branch", "commit", "commit_date", "paths", "format", "license"]
DONE_MANIFEST = [*RAW_MANIFEST, "output_dir", "documents", "text_bytes"]


def articles(spark: SparkSession, path: str, topics: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """title, text, weighted_tags, redirect_titles, page_id of a JSON-lines dump's namespace-0 records.

    Index lines are passed over; with topics, lines that name none of them are dropped before they are parsed. gzip
    can't be split, so the lines are spread before parsing. Lines that are no JSON object are left out.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith('{"index"'))
    if topics:
        named = F.lit(False)
        for t in topics:
            named = named | F.col("value").contains(t)
        lines = lines.where(named)
    if partitions:
        lines = lines.repartition(partitions)
    r = lines.select(F.from_json("value", RECORD).alias("r")).select("r.*").where("namespace = 0")
    names = F.transform(F.filter(F.coalesce("redirect", F.array().cast("array<struct<namespace:bigint,title:string>>")), lambda x: x["namespace"] == 0), lambda x: x["title"])
    return r.select("page_id", "title", "text", "weighted_tags", names.alias("redirect_titles"))


def with_clean_texts(dump: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The dump with bodies replaced by cleaned texts (page_id, text) where there are any: a first heading is dropped up
    to the first blank line, trailing line feeds go. replaced says which."""
    head = F.when(F.col("c").startswith("# "), F.when(F.instr("c", "\n\n") > 0, F.regexp_replace("c", r"(?s)^# .*?\n\n", "")).otherwise("")).otherwise(F.col("c"))
    c = cleaned.select("page_id", F.col("text").alias("c"))
    return dump.join(c, "page_id", "left").select(
        *[x for x in dump.columns if x != "text"], F.when(F.col("c").isNull(), F.col("text")).otherwise(F.regexp_replace(head, r"\n+$", "")).alias("text"), F.col("c").isNotNull().alias("replaced"))


def clean_text_path(page_id):
    """Where the cleaned text of a page lies: the last three digits, then the id."""
    return F.concat(F.lpad((page_id % 1000).cast("string"), 3, "0"), F.lit("/"), page_id.cast("string"), F.lit(".txt"))


def text_tree(spark: SparkSession, root: str, exclude: list[str] = (), pattern: str = "*.txt") -> DataFrame:
    """source (first folder), path (below root), text of every file; .git folders are passed over."""
    d = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    base = root.rstrip("/").split("://")[-1]
    rel = F.regexp_replace(F.col("_metadata.file_path"), "^.*" + base.replace(".", r"\.") + "/", "")
    r = d.select(rel.alias("path"), F.col("value").alias("text")).withColumn("source", F.element_at(F.split("path", "/"), 1))
    return r.where(~F.col("path").contains(".git/") & ~F.col("source").isin(list(exclude))).select("source", "path", "text")


def _tsv(spark: SparkSession, path: str, names: list[str], header: bool = True) -> DataFrame:
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.csv(path, sep="\t", header=header, schema=schema, quote="", enforceSchema=True)


def raw_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Source manifest of 8 columns; a row with fewer fails the read."""
    d = _tsv(spark, path, RAW_MANIFEST)
    return d.withColumn("license", F.when(F.col("license").isNull(), F.raise_error(F.lit("manifest row with fewer than 8 columns"))).otherwise(F.col("license")))


def flattened_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The 11-column manifest of flattened sources, only rows written as text."""
    d = _tsv(spark, path, DONE_MANIFEST)
    return d.where(F.col("output_dir") == "text").withColumns({c: F.col(c).cast("bigint") for c in ("documents", "text_bytes")})


def source_styles(spark: SparkSession, path: str) -> DataFrame:
    """source, styles, licenses of manifest.jsonl files in folders named after their sources."""
    d = spark.read.schema("license string, style string").json(path).withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    return d.groupBy("source").agg(F.array_sort(F.collect_set("style")).alias("styles"), F.array_sort(F.collect_set("license")).alias("licenses"))


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """word, kind of a lexicon CSV (no header, ragged; columns 0, 5 and 6 count): common before proper before other."""
    names = [f"c{i}" for i in range(18)]
    d = spark.read.csv(path, header=False, schema=", ".join(f"{n} string" for n in names), mode="PERMISSIVE", escape='"')
    n = d.where("c5 = '名詞' and c0 is not null")
    rank = F.when(F.col("c6") == "普通名詞", 0).when(F.col("c6") == "固有名詞", 1).otherwise(2)
    g = n.groupBy(F.col("c0").alias("word")).agg(F.min(rank).alias("k"))
    return g.select("word", F.element_at(F.array(F.lit("common"), F.lit("proper"), F.lit("other")), F.col("k") + 1).alias("kind"))


def count_table(spark: SparkSession, path: str) -> DataFrame:
    """key, cnt of lines `key<tab>count`; the last tab parts them, as keys may hold tabs. Other lines are left out."""
    d = spark.read.text(path)
    return d.select(F.regexp_extract("value", r"^(.*)\t(\d+)$", 1).alias("key"), F.regexp_extract("value", r"\t(\d+)$", 1).try_cast("bigint").alias("cnt")).where("cnt is not null")


def target_words(spark: SparkSession, path: str) -> DataFrame:
    """word: trimmed, distinct, blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def vote_lines(spark: SparkSession, path: str) -> DataFrame:
    """Votes of JSON lines with the file they came from; bad lines are left out."""
    return spark.read.schema(VOTE).json(path, mode="DROPMALFORMED").withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1))


def candidate_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CANDIDATE).json(path, mode="DROPMALFORMED")


def lint_findings(spark: SparkSession, path: str, rule: str | None = None) -> DataFrame:
    """path, line, col, severity, message, rule, excerpt, word (quoted at the message's start) of lint runs."""
    schema = "findings array<struct<path:string,line:int,col:int,severity:string,message:string,rule:string,excerpt:string>>"
    d = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("findings").alias("f")).select("f.*")
    d = d.where(F.col("rule") == rule) if rule else d
    return d.withColumn("word", F.nullif(F.regexp_extract("message", r"^'([^']+)'", 1), F.lit("")))


def semantic_table(spark: SparkSession, path: str) -> DataFrame:
    """word, codes of a tab-separated table with # comments and any number of codes."""
    d = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    return d.select(f[0].alias("word"), F.filter(F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0))), lambda x: x != "").alias("codes"))


def jmdict(spark: SparkSession, path: str) -> DataFrame:
    """kebs, rebs, pris, senses (pos, misc, glosses, fields, lsource) of a JMdict file.

    Entries are cut by their end tag, as the file's own entities make XML readers fail; `&n;` becomes `n`.
    """
    d = spark.read.text(path, lineSep="</entry>").where(F.col("value").contains("<entry>"))
    x = F.regexp_replace(F.col("value"), r"&([a-z0-9-]+);", "$1")
    every = lambda s, tag: F.regexp_extract_all(s, F.lit(rf"<{tag}\b[^>]*>([^<]*)</{tag}>"), F.lit(1))
    senses = F.transform(F.regexp_extract_all(x, F.lit(r"(?s)<sense>(.*?)</sense>"), F.lit(1)), lambda s: F.struct(
        every(s, "pos").alias("pos"), every(s, "misc").alias("misc"), every(s, "gloss").alias("glosses"), every(s, "field").alias("fields"),
        F.regexp_extract_all(s, F.lit(r'<lsource\b[^>]*xml:lang="([a-z]+)"'), F.lit(1)).alias("lsource")))
    return d.select(every(x, "keb").alias("kebs"), every(x, "reb").alias("rebs"), every(x, "ke_pri").alias("pris"), senses.alias("senses"))


def headwords(entries: DataFrame, pos_prefixes: list[str], priority_only: bool = False, longest: int = 12) -> DataFrame:
    """word: of entries with a wanted part of speech that is no expression, Japanese only and not too long: the first
    spelling, else the first reading. Entries all of whose senses are archaic or names are left out."""
    def wanted(s):
        def starts(x):
            hit = F.lit(False)
            for p in pos_prefixes:
                hit = hit | x.startswith(p)
            return hit
        return F.exists(s["pos"], starts) & ~F.array_contains(s["pos"], F.lit("exp"))
    stale = lambda s: F.exists(s["misc"], lambda m: m.isin("arch", "obs", "rare", "given", "surname", "place", "person"))
    d = entries.where(F.exists("senses", wanted) & ~F.forall("senses", stale))
    d = d.where(F.size("pris") > 0) if priority_only else d
    w = F.coalesce(F.try_element_at("kebs", F.lit(1)), F.try_element_at("rebs", F.lit(1)))
    return d.select(w.alias("word")).where(F.col("word").rlike("^[ぁ-ゖァ-ヺー一-鿿々]+$") & (F.length("word") <= longest)).distinct()


def priority_words(entries: DataFrame) -> DataFrame:
    """word: every spelling and reading of entries with a priority mark."""
    return entries.where(F.size("pris") > 0).select(F.explode(F.concat("kebs", "rebs")).alias("word")).distinct()


def wordnet_offsets(spark: SparkSession, path: str) -> DataFrame:
    """lemma, offsets of an index file: the last fields, as many as the line's own count says."""
    d = spark.read.text(path).where(~F.col("value").startswith(" "))
    f = F.split(F.trim("value"), " +")
    return d.select(f[0].alias("lemma"), F.slice(f, -f[2].cast("int"), f[2].cast("int")).alias("offsets"))


def lexnames(spark: SparkSession, path: str) -> DataFrame:
    """number, lexname of a table of lexicographer files."""
    f = F.split("value", "\t")
    return spark.read.text(path).select(f[0].try_cast("int").alias("number"), F.get(f, 1).alias("lexname")).where("number is not null and lexname is not null")


def wordnet_files(spark: SparkSession, path: str) -> DataFrame:
    """offset, number (of the lexicographer file) of a data file; its preface lines begin with two spaces."""
    f = F.split("value", " ", 3)
    return spark.read.text(path).where(~F.col("value").startswith("  ")).select(f[0].alias("offset"), F.get(f, 1).try_cast("int").alias("number")).where("number is not null")


def lemma_lexnames(index: DataFrame, files: DataFrame, names: DataFrame) -> DataFrame:
    """lemma, lexnames (sorted set): the lexicographer files of all senses of a lemma; an offset without one is passed over.

    index: lemma, offsets; files: offset, number; names: number, lexname.
    """
    at = files.join(names, "number").select("offset", "lexname")
    j = index.select("lemma", F.explode("offsets").alias("offset")).join(at, "offset", "left")
    return j.groupBy("lemma").agg(F.array_sort(F.collect_set("lexname")).alias("lexnames"))


def words_of_lexnames(glosses: DataFrame, lemmas: DataFrame, wanted: list[str]) -> DataFrame:
    """word: words one of whose first sense's glosses (first_glosses) is a lemma of one of the wanted lexicographer files."""
    g = glosses.select("word", F.explode("first_glosses").alias("gloss")).select("word", F.replace(F.trim("gloss"), F.lit(" "), F.lit("_")).alias("lemma"))
    hit = lemmas.where(F.arrays_overlap("lexnames", F.array(*map(F.lit, wanted)))).select("lemma")
    return g.join(hit, "lemma", "left_semi").select("word").distinct()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of files."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return d.select(F.col("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def dump_version(name):
    """The first run of eight digits in a file name, else null."""
    return F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))


def registrable_names(arts: DataFrame) -> DataFrame:
    """key, bucket: titles and redirects that may be registered as headwords."""
    names = arts.select(F.explode(F.concat(F.array("title"), F.coalesce("redirect_titles", F.array().cast("array<string>")))).alias("key")).where("key is not null and key <> ''").distinct()
    return names.where(is_registrable(regex_morphemes(F.col("key")))).select("key", F.lit(7).alias("bucket"))


def gloss_rows(spark: SparkSession, path: str) -> DataFrame:
    """word, first_glosses, tags of a gloss table: column 4 counts the first sense's glosses, which start in column 7;
    column 6 holds tags. Rows with fewer than 7 columns or no count are left out."""
    f = F.split("value", "\t")
    d = spark.read.text(path).where(F.size(f) >= 7).select(f[0].alias("word"), f[3].try_cast("int").alias("n"), f[5].alias("tags"), f.alias("f"))
    return d.where("n is not null and n >= 0").select("word", F.slice("f", F.lit(7), F.col("n")).alias("first_glosses"), "tags")


def novelty_table(spark: SparkSession, path: str) -> DataFrame:
    """kind, owner, grp, key, cnt of tab-separated five-tuples."""
    return spark.read.csv(path, sep="\t", schema="kind string, owner string, grp string, key string, cnt bigint", quote="")


def answer_rows(spark: SparkSession, path: str) -> DataFrame:
    """word, fragment, answer of a table with a header; rows with fewer than three columns are left out."""
    return spark.read.csv(path, sep="\t", header=True, schema="word string, fragment string, answer string", quote="").where("answer is not null")


def eval_words(spark: SparkSession, path: str, header: str = "語", word_column: int = 0, category_column: int = 3) -> DataFrame:
    """row_no (1-based line of the file), word, category (null if there is no such column) of an evaluation table.

    Cells are trimmed; the header row and rows without a word are left out. The files are small, read whole.
    """
    d = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("_i", "_line"))
    cell = lambda i: F.trim(F.get(F.split("_line", "\t"), i))
    d = d.select((F.col("_i") + 1).alias("row_no"), cell(word_column).alias("word"), cell(category_column).alias("category"))
    return d.where((F.col("word") != "") & (F.col("word") != header))


def stats(spark: SparkSession, path: str, schema: str) -> dict:
    """A small JSON record by a schema (DDL): fields must be there and of their type, else an error."""
    row = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").first()
    if row is None or any(v is None for v in row):
        raise ValueError(f"{path}: fields missing")
    return row.asDict(recursive=True)


def count_tables(spark: SparkSession, dirs: list[str], name: str) -> DataFrame:
    """key, cnt: the count tables of one name in several folders, added up; a folder without it counts nothing."""
    paths = [p for p in (f"{d.rstrip('/')}/{name}" for d in dirs) if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], "key string, cnt bigint")
    return count_table(spark, paths).groupBy("key").agg(F.sum("cnt").alias("cnt"))


def noun_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """word, total, alone of lines `word<tab>total<tab>alone`, added up over files; an empty alone is 0."""
    f = F.split("value", "\t")
    d = spark.read.text(path).select(f[0].alias("word"), F.get(f, 1).try_cast("bigint").alias("total"), F.coalesce(F.get(f, 2).try_cast("bigint"), F.lit(0)).alias("alone")).where("total is not null")
    return d.groupBy("word").agg(F.sum("total").alias("total"), F.sum("alone").alias("alone"))


def word_list(spark: SparkSession, paths: list[str]) -> DataFrame:
    """word: the union of word lists; blank lines and lines that begin with # are left out."""
    d = spark.read.text(paths).select(F.trim("value").alias("word"))
    return d.where((F.col("word") != "") & ~F.col("word").startswith("#")).distinct()
