"""Named queries over a folder of tables and the SQL that gives the same rows.

Each query runs over its whole tables. SQL is left out where an operator can't be said in it (dictionary walks,
markup state machines, tree ensembles); those are tested against plain implementations instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.markup import flatten_text
from ..functions.words import gloss_core, script
from ..morph import regex_morphemes
from ..operators import build, counts, domains, evals, features, judge, segment, substitution, votes
from ..session import spread, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f
    return put


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_CJK = "一-龥々ァ-ヶー"
_MORPH = "[A-Za-z]+|[ァ-ヶー]+|[一-龥々]{1,2}"
#: sp: spans of documents; k: distinct keys per span, by the rules of operators.segment.span_keys.
_SPANS = f"""
sp AS (SELECT doc_id, source, row_number() OVER () AS sid, s FROM (SELECT doc_id, source, unnest(regexp_extract_all(text, '[A-Za-z{_CJK}]+')) AS s FROM documents)),
"""
_KEYS = _SPANS + f"""
pt AS (SELECT doc_id, source, sid, s AS p FROM sp UNION ALL
       SELECT doc_id, source, sid, unnest(regexp_extract_all(s, '[{_CJK}]+')) FROM sp WHERE regexp_matches(s, '[A-Za-z]')),
m AS (SELECT doc_id, source, sid, regexp_extract_all(p, '{_MORPH}') AS ms FROM pt),
k0 AS (SELECT doc_id, source, sid, array_to_string(ms, '') AS key FROM m WHERE len(ms) BETWEEN 2 AND 5 UNION ALL
       SELECT doc_id, source, sid, ms[i] || ms[i + 1] FROM (SELECT *, unnest(range(1, len(ms))) AS i FROM m WHERE len(ms) >= 3)),
k AS (SELECT DISTINCT doc_id, source, sid, key FROM (SELECT doc_id, source, sid, key FROM k0 UNION ALL SELECT doc_id, source, sid, lower(key) FROM k0))
"""
_BUCKET = "CASE WHEN {0} >= 10000 THEN 5 WHEN {0} >= 1000 THEN 4 WHEN {0} >= 100 THEN 3 WHEN {0} >= 10 THEN 2 WHEN {0} >= 3 THEN 1 END"


def _docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


def _texts(s: SparkSession, d: str) -> DataFrame:
    return spread(table(s, d, "documents").select("doc_id", "source", "text"), "doc_id")


@query("WITH" + _KEYS + "SELECT key, count(*) AS cnt FROM k GROUP BY key")
def compound_occurrence_counts(s: SparkSession, d: str) -> DataFrame:
    return counts.compound_counts(_texts(s, d), bridge=False)


@query("WITH" + _KEYS + "SELECT key, count(DISTINCT doc_id) AS cnt FROM k GROUP BY key")
def compound_document_counts(s: SparkSession, d: str) -> DataFrame:
    return counts.compound_counts(_texts(s, d), by_document=True, bridge=False)


def _as_provider(text):
    """The character-class provider under another name, so that the ways for any analyser's morphemes are taken."""
    return regex_morphemes(text)


@query("WITH" + _KEYS + "SELECT key, count(*) AS cnt FROM k GROUP BY key")
def morpheme_compound_counts(s: SparkSession, d: str) -> DataFrame:
    """Compounds over spans of given morphemes."""
    return counts.compound_counts(_texts(s, d), bridge=False, provider=_as_provider)


@query("WITH" + _SPANS + f"""
m AS (SELECT regexp_extract_all(s, '{_MORPH}') AS ms FROM sp)
SELECT part, count(*) AS cnt FROM (SELECT unnest(ms) AS part FROM m WHERE len(ms) >= 2) GROUP BY part""")
def component_counts(s: SparkSession, d: str) -> DataFrame:
    return counts.component_counts(_texts(s, d), bridge=False)


@query("WITH" + _SPANS + f"""
m AS (SELECT doc_id, len(regexp_extract_all(s, '{_MORPH}')) AS n FROM sp)
SELECT doc_id, count(*) AS spans, sum(n)::BIGINT AS morphemes, max(n)::INT AS longest FROM m GROUP BY doc_id""")
def span_islands(s: SparkSession, d: str) -> DataFrame:
    r = counts.surface_rows(_texts(s, d), ["doc_id"], bridge=False).select("doc_id", F.size("surfaces").alias("n"))
    return r.groupBy("doc_id").agg(F.count(F.lit(1)).alias("spans"), F.sum("n").alias("morphemes"), F.max("n").alias("longest"))


@query("WITH" + _KEYS + f""",
p AS (SELECT DISTINCT doc_id, source, key FROM k),
w AS (SELECT key, floor(sum(CASE WHEN source < 'm' THEN 1.0 ELSE 2.0 END) + 0.5)::BIGINT AS cnt FROM p WHERE source IS NOT NULL GROUP BY key)
SELECT {_BUCKET.format('cnt')} AS bucket, count(*) AS n_keys FROM w WHERE cnt >= 3 GROUP BY 1""")
def compound_buckets(s: SparkSession, d: str) -> DataFrame:
    """Compounds counted per document, weighted by source group, put into frequency buckets."""
    rows = counts.compound_rows(_texts(s, d), ["doc_id", "source"], bridge=False).where("source is not null").distinct()
    per = rows.groupBy("key", F.when(F.col("source") < "m", "wiki").otherwise("docs").alias("input")).agg(F.count(F.lit(1)).alias("cnt"))
    b = build.bucketed(build.weighted_union(per, {"wiki": 1.0, "docs": 2.0}))
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_keys"))


_RUNS = """
r AS (SELECT run_id, line_no, any_value(input_name) AS input, any_value(term) AS key, any_value(cnt) AS cnt FROM run_lines
      WHERE term IS NOT NULL AND cnt IS NOT NULL GROUP BY run_id, line_no),
w AS (SELECT key, floor(coalesce(sum(cnt) FILTER (input = 'corpus'), 0) * 2.0 + coalesce(sum(cnt) FILTER (input = 'docs'), 0) * 2.0
                  + coalesce(sum(cnt) FILTER (input = 'wiki'), 0) * 1.0 + 0.5)::BIGINT AS cnt FROM r GROUP BY key)
"""


def _runs(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "run_lines").where("term is not null and cnt is not null")
    return r.dropDuplicates(["run_id", "line_no"]).select(F.col("input_name").alias("input"), F.col("term").alias("key"), "cnt")


@query("WITH" + _RUNS + f"SELECT key, cnt, {_BUCKET.format('cnt')} AS bucket FROM w")
def weighted_union_buckets(s: SparkSession, d: str) -> DataFrame:
    w = build.weighted_union(_runs(s, d))
    return w.withColumn("bucket", build.bucket_of(F.col("cnt")))


@query("""WITH r AS (SELECT run_id, line_no, any_value(term) AS term, any_value(cnt) AS cnt FROM run_lines WHERE term IS NOT NULL AND cnt IS NOT NULL GROUP BY ALL)
SELECT term, sum(cnt)::BIGINT AS cnt FROM (SELECT run_id, line_no, term, cnt FROM r) GROUP BY term""")
def run_merge(s: SparkSession, d: str) -> DataFrame:
    return build.merged_runs(table(s, d, "run_lines"))


@query("WITH" + _RUNS + f""",
b AS (SELECT key, {_BUCKET.format('cnt')} AS bucket FROM w WHERE cnt >= 3),
t AS (SELECT DISTINCT unnest(list_concat([title], coalesce(redirect_titles, []))) AS key FROM articles)
SELECT key, max(bucket)::INT AS bucket FROM (SELECT * FROM b UNION ALL SELECT key, 7 FROM t WHERE key IS NOT NULL) GROUP BY key""")
def headword_overlay(s: SparkSession, d: str) -> DataFrame:
    names = table(s, d, "articles").select(F.explode(F.concat(F.array("title"), F.coalesce("redirect_titles", F.array().cast("array<string>")))).alias("key"))
    return build.overlay(build.bucketed(build.weighted_union(_runs(s, d))), names.distinct())


@query(f"""WITH t AS (SELECT DISTINCT unnest(list_concat([title], coalesce(redirect_titles, []))) AS name FROM articles)
SELECT name AS key, 7 AS bucket FROM t WHERE name IS NOT NULL AND (regexp_full_match(name, '[A-Za-z]+') OR regexp_full_match(name, '[ァ-ヶー]+')
  OR (regexp_full_match(name, '[A-Za-z{_CJK}]+') AND len(regexp_extract_all(name, '{_MORPH}')) >= 2))""")
def article_titles(s: SparkSession, d: str) -> DataFrame:
    from ..sources.readers import registrable_names
    return registrable_names(table(s, d, "articles"))


@query("SELECT * FROM (VALUES (1, 3::BIGINT, 9::BIGINT), (2, 10, 99), (3, 100, 999), (4, 1000, 9999), (5, 10000, NULL)) t(bucket, low, high)")
def bucket_ranges(s: SparkSession, d: str) -> DataFrame:
    return build.bucket_ranges(s)


_PARTNERS = f"""
c AS (SELECT DISTINCT term AS compound FROM term_counts WHERE kind = 'compound' AND term IS NOT NULL),
m AS (SELECT compound, regexp_extract_all(compound, '{_MORPH}') AS ms FROM c),
i AS (SELECT compound, ms, unnest(range(1, len(ms))) AS i FROM m WHERE len(ms) >= 2),
x AS (SELECT compound, ms[i + 1] AS part, 'prefix' AS side, ms[i] AS other FROM i UNION ALL SELECT compound, ms[i], 'suffix', ms[i + 1] FROM i),
y AS (SELECT DISTINCT compound, part, side, CASE WHEN regexp_matches(other, '^[A-Za-zァ-ヺー]+$') THEN 'foreign' WHEN regexp_matches(other, '[一-鿿々]') THEN 'kango' END AS kind FROM x),
pc AS (SELECT part, count(*) FILTER (side = 'prefix' AND kind = 'foreign') AS prefix_foreign, count(*) FILTER (side = 'prefix' AND kind = 'kango') AS prefix_kango,
       count(*) FILTER (side = 'suffix' AND kind = 'foreign') AS suffix_foreign, count(*) FILTER (side = 'suffix' AND kind = 'kango') AS suffix_kango
       FROM y WHERE kind IS NOT NULL GROUP BY part)
"""


def _partners(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "term_counts").where("kind = 'compound' and term is not null").select(F.col("term").alias("compound")).distinct()
    return build.partner_counts(c.select("compound", F.regexp_extract_all("compound", F.lit(_MORPH), F.lit(0)).alias("surfaces")))


@query("WITH" + _PARTNERS + "SELECT * FROM pc")
def partner_type_counts(s: SparkSession, d: str) -> DataFrame:
    return _partners(s, d)


_PARTS = """
f AS (SELECT term AS part, sum(total)::BIGINT AS cnt FROM term_counts WHERE kind = 'component' AND term IS NOT NULL AND total > 0 GROUP BY term)
"""


def _parts(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "term_counts").where("kind = 'component' and term is not null and total > 0")
    return t.groupBy(F.col("term").alias("part")).agg(F.sum("total").alias("cnt"))


@query("WITH" + _PARTNERS + "," + _PARTS + """
SELECT part, cnt AS frequency, coalesce(prefix_foreign, 0) AS prefix_foreign, coalesce(prefix_kango, 0) AS prefix_kango,
       coalesce(suffix_foreign, 0) AS suffix_foreign, coalesce(suffix_kango, 0) AS suffix_kango FROM f LEFT JOIN pc USING (part) WHERE cnt >= 3
UNION ALL SELECT part, 0, prefix_foreign, prefix_kango, suffix_foreign, suffix_kango FROM pc
WHERE regexp_matches(part, '[ァ-ヶー]') AND part NOT IN (SELECT part FROM f WHERE cnt >= 3)""")
def component_table(s: SparkSession, d: str) -> DataFrame:
    p = _partners(s, d).withColumn("is_long", F.col("part").rlike("[ァ-ヶー]"))
    return build.components(_parts(s, d), p)


def _code(x: str, exact: int, steps: int, top: int) -> str:
    return f"(CASE WHEN {x} <= {exact} THEN {x} ELSE least({top}, {exact + 1} + floor({steps} * log2({x} / {exact + 1}.0::DOUBLE)))::BIGINT END)"


@query("WITH" + _PARTNERS + "," + _PARTS + f""",
e AS (SELECT part, {_code('cnt', 1023, 16, 2047)} AS fc, {_code('coalesce(prefix_kango, 0)', 127, 8, 255)} AS pc FROM f LEFT JOIN pc USING (part))
SELECT part, fc AS frequency_code, pc AS prefix_code, ((1::BIGINT << 61) | fc | (pc << 19)) AS packed FROM e""")
def constituent_packing(s: SparkSession, d: str) -> DataFrame:
    p = _parts(s, d).join(_partners(s, d).select("part", "prefix_kango"), "part", "left")
    zero, k = F.lit(0), F.coalesce("prefix_kango", F.lit(0))
    v = build.packed(F.col("cnt"), [zero, k, zero, zero])
    got = build.unpacked(v)
    return p.select("part", got["frequency"].alias("frequency_code"), got["prefix_kango"].alias("prefix_code"), v.alias("packed"))


_TAGDOM = """CASE WHEN t IN ('STEM.Computing', 'STEM.Technology') THEN 1 WHEN starts_with(t, 'STEM') THEN 2 WHEN starts_with(t, 'Culture') THEN 3
 WHEN starts_with(t, 'Geography') THEN 4 WHEN starts_with(t, 'History_and_Society') THEN 5 END"""
_ARTDOM = f"""
v AS (SELECT page_id, max(struct_pack(f := fetched_at, l := loaded_at, t := text, s := source_name, w := weighted_tags)) AS v FROM articles WHERE page_id IS NOT NULL GROUP BY page_id),
tg AS (SELECT page_id, unnest(v.w) AS tag FROM v),
ts AS (SELECT page_id, regexp_extract(tag, '^(?:[^/|]*/)?([^/|*]+)\\*?\\|\\d+$', 1) AS t, TRY_CAST(regexp_extract(tag, '\\|(\\d+)$', 1) AS INT) AS sc FROM tg),
dm AS (SELECT DISTINCT page_id, {_TAGDOM} AS domain FROM ts WHERE sc >= 500),
ad AS (SELECT page_id, domain FROM dm WHERE domain IS NOT NULL)
"""


def _articles(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "articles").where("page_id is not null").groupBy("page_id").agg(
        F.max(F.struct("fetched_at", "loaded_at", "text", "source_name", "weighted_tags")).alias("v"))
    return a.select("page_id", "v.text", F.col("v.source_name").alias("source"), domains.tag_domains(F.col("v.weighted_tags")).alias("domains"))


@query("WITH" + _ARTDOM + "SELECT domain, count(*) AS documents FROM ad GROUP BY domain")
def domain_tallies(s: SparkSession, d: str) -> DataFrame:
    return domains.domain_tallies(_articles(s, d))


_PAIRS = _ARTDOM + f""",
w AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(v.t, '[{_CJK}]+')) AS word FROM v),
dp AS (SELECT word, domain, count(*) AS docs FROM w JOIN ad USING (page_id) GROUP BY 1, 2)
"""


def _pairs(s: SparkSession, d: str) -> DataFrame:
    a = _articles(s, d)
    words = a.select("page_id", "domains", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"[{_CJK}]+"), F.lit(0)))).alias("word"))
    return domains.domain_pairs(words, "page_id", distinct=True)


@query("WITH" + _PAIRS + "SELECT * FROM dp")
def domain_pair_counts(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d)


_FOLD = "SELECT word, unnest(CASE WHEN len(ds) >= {0} THEN [8] ELSE ds END)::INT AS domain FROM (SELECT word, list(domain) AS ds FROM g GROUP BY word)"


@query("WITH" + _PAIRS + ", g AS (SELECT word, domain FROM dp WHERE docs >= 5) " + _FOLD.format(5))
def domain_register_count(s: SparkSession, d: str) -> DataFrame:
    return domains.register_by_count(_pairs(s, d))


@query("WITH" + _PAIRS + """, t AS (SELECT word, sum(docs) AS total FROM dp GROUP BY word HAVING sum(docs) >= 5),
g AS (SELECT word, list(domain) FILTER (docs >= 0.2::DOUBLE * total) AS ds FROM dp JOIN t USING (word) GROUP BY word)
SELECT word, unnest(CASE WHEN ds IS NULL OR len(ds) >= 3 THEN [8] ELSE ds END)::INT AS domain FROM g""")
def domain_register_share(s: SparkSession, d: str) -> DataFrame:
    return domains.register_by_share(_pairs(s, d))


@query("WITH" + _PAIRS + "SELECT word, bit_or(1 << (domain - 1))::INT AS bits, count(*) AS n FROM dp GROUP BY word")
def domain_bitsets(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d).groupBy("word").agg(domains.domain_bits(F.col("domain")).alias("bits"), F.count(F.lit(1)).alias("n"))


@query("WITH" + _ARTDOM + """,
w AS (SELECT DISTINCT word FROM occurrences WHERE word IS NOT NULL AND word <> ''),
h AS (SELECT page_id, word FROM v, w WHERE contains(v.t, word)),
g AS (SELECT word, count(*) AS articles FROM h GROUP BY word),
x AS (SELECT word, domain, count(*) AS c FROM h JOIN ad USING (page_id) GROUP BY 1, 2),
p AS (SELECT word, coalesce(sum(c) FILTER (domain = 1), 0)::BIGINT AS d1, coalesce(sum(c) FILTER (domain = 2), 0)::BIGINT AS d2, coalesce(sum(c) FILTER (domain = 3), 0)::BIGINT AS d3,
      coalesce(sum(c) FILTER (domain = 4), 0)::BIGINT AS d4, coalesce(sum(c) FILTER (domain = 5), 0)::BIGINT AS d5 FROM x GROUP BY word)
SELECT w.word, coalesce(articles, 0) AS articles, coalesce(d1, 0) AS d1, coalesce(d2, 0) AS d2, coalesce(d3, 0) AS d3, coalesce(d4, 0) AS d4, coalesce(d5, 0) AS d5,
       round(coalesce(d1, 0) / articles::DOUBLE, 4) AS it_share FROM w LEFT JOIN g USING (word) LEFT JOIN p USING (word)""")
def topic_distribution(s: SparkSession, d: str) -> DataFrame:
    return domains.topic_distribution(_articles(s, d), table(s, d, "occurrences").select("word"), "page_id")


_BK = f"""
tc AS (SELECT kind, term, sum(total)::BIGINT AS cnt FROM term_counts WHERE term IS NOT NULL AND total > 0 GROUP BY kind, term),
b AS (SELECT term AS key, {_BUCKET.format('cnt')}::INT AS bucket FROM tc WHERE kind = 'compound' AND cnt >= 3),
pr AS (SELECT term AS part, cnt AS frequency FROM tc WHERE kind = 'component'),
wd AS (SELECT DISTINCT w AS word FROM (SELECT unnest(context) AS w FROM occurrences) WHERE w IS NOT NULL),
ms AS (SELECT word, regexp_extract_all(word, '{_MORPH}') AS sf, regexp_full_match(word, '[A-Za-z{_CJK}]+') AND len(regexp_extract_all(word, '{_MORPH}')) BETWEEN 2 AND 5 AS cand FROM wd),
bw AS (SELECT ms.*, coalesce(b1.bucket, b2.bucket) AS bucket FROM ms LEFT JOIN b b1 ON b1.key = word LEFT JOIN b b2 ON b2.key = lower(word)),
rt AS (SELECT word, min(coalesce(frequency, 0)) AS ratio FROM (SELECT word, unnest(sf) AS part FROM ms WHERE cand) LEFT JOIN pr USING (part) GROUP BY word)
"""


def _judge_inputs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    tc = table(s, d, "term_counts").where("term is not null and total > 0").groupBy("kind", "term").agg(F.sum("total").alias("cnt"))
    units = tc.where("kind = 'compound'").select(F.col("term").alias("key"), "cnt")
    parts = tc.where("kind = 'component'").select(F.col("term").alias("part"), F.col("cnt").alias("frequency"))
    words = table(s, d, "occurrences").select(F.explode("context").alias("word"))
    return words, build.bucketed(units), parts, units


_HEAD = "CASE WHEN NOT cand THEN '{0}' WHEN bucket = 7 THEN '{1}' WHEN bucket >= 2 THEN '{2}' WHEN bucket = 1 THEN '{3}'"
_VERDICT = _HEAD.format("NotCandidate", "Established", "Established", "Gray")
_REASON = _HEAD.format("Span", "Dictionary", "HighFrequency", "LowFrequency")


@query("WITH" + _BK + f"SELECT word, {_VERDICT} ELSE 'Coined' END AS verdict, {_REASON} WHEN ratio > 50 THEN 'Constituent' ELSE 'Unregistered' END AS reason FROM bw LEFT JOIN rt USING (word)")
def judge_words(s: SparkSession, d: str) -> DataFrame:
    w, b, p, _ = _judge_inputs(s, d)
    return judge.judged(w, b, p, threshold=50)


_PAIRRULE = """,
pk AS (SELECT word, bool_and(coalesce(b.bucket >= 2, false)) AS known FROM (SELECT word, sf[i] || sf[i + 1] AS key FROM (SELECT word, sf, unnest(range(1, len(sf))) AS i FROM bw WHERE cand AND bucket IS NULL AND len(sf) >= 3))
       LEFT JOIN b USING (key) GROUP BY word)
"""


@query("WITH" + _BK + _PAIRRULE + f"""SELECT word, {_VERDICT} WHEN known THEN 'Established' ELSE 'Coined' END AS verdict,
{_REASON} WHEN known THEN 'Concatenation' WHEN ratio > 50 THEN 'Constituent' ELSE 'Unregistered' END AS reason FROM bw LEFT JOIN rt USING (word) LEFT JOIN pk USING (word)""")
def judge_pair_rule(s: SparkSession, d: str) -> DataFrame:
    w, b, p, _ = _judge_inputs(s, d)
    return judge.judged(w, b, p, threshold=50, rule="established")


_COMP = """,
hv AS (SELECT word, k, unnest([{'key': array_to_string(sf[1:k], ''), 'single': k = 1}, {'key': array_to_string(sf[k + 1:], ''), 'single': len(sf) - k = 1}]) AS h
       FROM (SELECT word, sf, unnest(range(1, len(sf))) AS k FROM bw WHERE cand AND bucket IS NULL AND len(sf) >= 3)),
tb AS (SELECT part AS key, true AS single, frequency AS n FROM pr UNION ALL SELECT term, false, cnt FROM tc WHERE kind = 'compound'),
lo AS (SELECT word, k, min(coalesce(n, 0)) AS n FROM hv LEFT JOIN tb ON tb.key = h.key AND tb.single = h.single GROUP BY word, k),
cs AS (SELECT word, max(n) AS best FROM lo GROUP BY word)
"""


@query("WITH" + _BK + _COMP + f"""SELECT word, {_VERDICT} WHEN best >= 10 AND best < 30 THEN 'Gray' ELSE 'Coined' END AS verdict,
{_REASON} WHEN best >= 10 THEN 'Composition' WHEN best IS NOT NULL THEN 'Unregistered' WHEN ratio > 50 THEN 'Constituent' ELSE 'Unregistered' END AS reason
FROM bw LEFT JOIN rt USING (word) LEFT JOIN cs USING (word)""")
def judge_composition(s: SparkSession, d: str) -> DataFrame:
    w, b, p, u = _judge_inputs(s, d)
    return judge.judged(w, b, p, units=u, threshold=50, rule="composition", upper=30, lower=10)


@query("WITH" + _BK + f""",
j AS (SELECT CASE WHEN regexp_matches(word, '[A-Za-z]') THEN 'latin' WHEN regexp_matches(word, '^[ァ-ヶー]+$') THEN 'katakana' ELSE 'other' END AS grp, {_VERDICT} ELSE 'Coined' END AS verdict FROM bw LEFT JOIN rt USING (word)),
g AS (SELECT grp, count(*) AS total, count(*) FILTER (verdict <> 'NotCandidate') AS candidates, count(*) FILTER (verdict = 'NotCandidate') AS notcandidate, count(*) FILTER (verdict = 'Established') AS established,
      count(*) FILTER (verdict = 'Gray') AS gray, count(*) FILTER (verdict = 'Coined') AS coined, count(*) FILTER (verdict = 'RepurposeCandidate') AS repurposecandidate FROM j GROUP BY grp)
SELECT *, CASE WHEN candidates = 0 THEN '0/0' ELSE coined || '/' || candidates || ' (' || round(100.0::DOUBLE * coined / candidates, 1)::DECIMAL(6,1) || '%)' END AS coined_ratio FROM g""")
def judge_confusion(s: SparkSession, d: str) -> DataFrame:
    w, b, p, _ = _judge_inputs(s, d)
    grp = F.when(F.col("word").rlike("[A-Za-z]"), "latin").when(F.col("word").rlike("^[ァ-ヶー]+$"), "katakana").otherwise("other")
    return judge.confusion(judge.judged(w, b, p, threshold=50).withColumn("grp", grp), "grp")


@query("WITH" + _BK + "," + _PARTNERS + """,
xw AS (SELECT word, sf, unnest(range(1, len(sf) + 1)) AS i FROM ms WHERE len(sf) > 0 AND regexp_full_match(word, '[A-Za-z一-龥々ァ-ヶー]+'))
SELECT word, coalesce(max(b1.bucket), max(b2.bucket)) AS bucket,
 string_agg(concat_ws(':', sf[i], coalesce(frequency, 0), coalesce(prefix_foreign, 0), coalesce(prefix_kango, 0), coalesce(suffix_foreign, 0), coalesce(suffix_kango, 0)), ' ' ORDER BY i) AS parts
FROM xw LEFT JOIN pr ON pr.part = sf[i] LEFT JOIN pc ON pc.part = sf[i] LEFT JOIN b b1 ON b1.key = word LEFT JOIN b b2 ON b2.key = lower(word) GROUP BY word""")
def query_words(s: SparkSession, d: str) -> DataFrame:
    w, b, p, _ = _judge_inputs(s, d)
    parts = p.join(_partners(s, d), "part", "full")
    return judge.lookup(w.where(F.col("word").rlike(f"^[A-Za-z{_CJK}]+$")), b, parts)


_SHARED = """,
st AS (SELECT word, sum(docs) AS total FROM dp GROUP BY word HAVING sum(docs) >= 5),
sd AS (SELECT word, CASE WHEN len(ds) IS NULL OR len(ds) >= 3 THEN [8] ELSE list_sort(ds) END AS ds FROM (SELECT word, list(domain) FILTER (docs >= 0.2::DOUBLE * total) AS ds FROM dp JOIN st USING (word) GROUP BY word)),
jd AS (SELECT bw.*, ratio, coalesce(s1.ds, s2.ds) AS ds FROM bw LEFT JOIN rt USING (word) LEFT JOIN sd s1 ON s1.word = bw.word LEFT JOIN sd s2 ON s2.word = lower(bw.word)),
jm AS (SELECT *, coalesce(cand AND bucket >= 2 AND NOT list_contains(ds, 8) AND NOT list_contains(ds, 1), false) AS moved FROM jd)
"""
_NAMES = "CASE {0} WHEN 1 THEN '情報技術' WHEN 2 THEN 'その他の理工' WHEN 3 THEN '文化' WHEN 4 THEN '地理' WHEN 5 THEN '社会' WHEN 6 THEN '行政' WHEN 7 THEN '法令' WHEN 8 THEN '一般' END"


def _shared_domains(s: SparkSession, d: str) -> DataFrame:
    return domains.register_by_share(_pairs(s, d))


@query("WITH" + _PAIRS.replace("w AS (", "dw AS (").replace("FROM w JOIN", "FROM dw JOIN") + "," + _BK + _SHARED + f"""
SELECT word, CASE WHEN moved THEN 'RepurposeCandidate' ELSE {_VERDICT} ELSE 'Coined' END END AS verdict, CASE WHEN moved THEN 'Domain' ELSE {_REASON} WHEN ratio > 50 THEN 'Constituent' ELSE 'Unregistered' END END AS reason,
array_to_string(coalesce(ds, []), ',') AS domains FROM jm""")
def judge_domains(s: SparkSession, d: str) -> DataFrame:
    """Judgments for a document on information technology, with the domains that the words are registered in."""
    w, b, p, _ = _judge_inputs(s, d)
    j = judge.judged(w, b, p, domains=_shared_domains(s, d), threshold=50, document_domain=judge.document_domain("情報技術"))
    return j.withColumn("domains", F.array_join(F.col("domains").cast("array<string>"), ","))


@query("WITH" + _PAIRS.replace("w AS (", "dw AS (").replace("FROM w JOIN", "FROM dw JOIN") + "," + _BK + _SHARED + f"""
SELECT word, CASE WHEN moved THEN '転用の候補' || chr(9) || '分野(' || array_to_string(list_transform(ds, lambda c: {_NAMES.format('c')}), '・') || ')'
 WHEN NOT cand THEN '候補外' || chr(9) || '区間' WHEN bucket = 7 THEN '既存語' || chr(9) || '辞書' WHEN bucket >= 2 THEN '既存語' || chr(9) || '高頻度' WHEN bucket = 1 THEN 'グレー' || chr(9) || '低頻度'
 WHEN ratio > 50 THEN '造語の候補' || chr(9) || '部品' ELSE '造語の候補' || chr(9) || '未登録' END AS text FROM jm""")
def judge_rendered(s: SparkSession, d: str) -> DataFrame:
    w, b, p, _ = _judge_inputs(s, d)
    return judge.rendered(judge.judged(w, b, p, domains=_shared_domains(s, d), threshold=50, document_domain=1))


@query("WITH" + _PAIRS + "SELECT word, domain, word || chr(9) || domain AS key, word AS back, domain::INT AS code FROM dp")
def domain_keys(s: SparkSession, d: str) -> DataFrame:
    k = _pairs(s, d).select("word", "domain", domains.domain_key(F.col("domain"), F.col("word")).alias("key"))
    w, c = domains.split_domain_key(F.col("key"))
    return k.select("word", "domain", "key", w.alias("back"), c.alias("code"))


@query("WITH" + _RUNS + "SELECT key, sum(cnt)::BIGINT AS cnt FROM r WHERE input IN ('wiki', 'docs') GROUP BY key HAVING sum(cnt) >= 3")
def composition_units(s: SparkSession, d: str) -> DataFrame:
    r = _runs(s, d)
    return judge.composition_units(r.where("input = 'wiki'"), r.where("input = 'docs'"))


@query("""WITH r AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9ァ-ヶー一-龥々]+(?:[ \t　]+[A-Za-z0-9ァ-ヶー一-龥々]+)*')) AS run FROM documents),
t AS (SELECT regexp_extract_all(run, '[A-Za-z]+|[0-9]+|[ァ-ヶー]+|[一-龥々]{1,2}') AS ts FROM r), w AS (SELECT len(ts) = 1 AS alone, unnest(ts) AS w FROM t)
SELECT lower(w) AS word, count(*) AS total, count(*) FILTER (alone) AS alone FROM w WHERE NOT regexp_matches(w, '^[0-9]') GROUP BY 1""")
def noun_counts(s: SparkSession, d: str) -> DataFrame:
    return counts.noun_counts(_texts(s, d))


@query("""WITH r AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9ァ-ヶー一-龥々]+(?:[ \t　]+[A-Za-z0-9ァ-ヶー一-龥々]+)*')) AS run FROM documents),
t AS (SELECT regexp_extract_all(run, '[A-Za-z]+|[0-9]+|[ァ-ヶー]+|[一-龥々]{1,2}') AS ts FROM r), w AS (SELECT len(ts) = 1 AS alone, unnest(ts) AS w FROM t)
SELECT lower(w) AS word, count(*) AS total, count(*) FILTER (alone) AS alone FROM w WHERE NOT regexp_matches(w, '^[0-9]') GROUP BY 1""")
def morpheme_noun_counts(s: SparkSession, d: str) -> DataFrame:
    """Nouns over given morphemes."""
    return counts.noun_counts(_texts(s, d), provider=_as_provider)


_TOKENS = """
c AS (SELECT doc_id, unnest(cs) AS c, unnest(range(len(cs)))::INT AS chunk_no FROM (SELECT doc_id, regexp_extract_all(text, '[^。\n]*[。\n]|[^。\n]+') AS cs FROM documents)),
tk AS (SELECT doc_id, chunk_no, c, regexp_extract_all(c, '[A-Za-z]+|[0-9]+|[ァ-ヶー]+|[一-龥々]{1,2}|[ぁ-ん]+|[ \t　]+|(?s:.)') AS ts FROM c),
tp AS (SELECT doc_id, chunk_no, c, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS i FROM tk),
ps AS (SELECT *, (sum(length(t)) OVER (PARTITION BY doc_id, chunk_no ORDER BY i) - length(t))::INT AS start FROM tp),
tg AS (SELECT DISTINCT word FROM occurrences WHERE word IS NOT NULL),
hit AS (SELECT * FROM ps WHERE regexp_matches(t, '^[A-Za-zァ-ヶー一-龥々]') AND lower(t) IN (SELECT word FROM tg))
"""


@query("WITH" + _TOKENS + "SELECT lower(t) AS word, count(*) AS cnt FROM hit GROUP BY 1")
def target_counts(s: SparkSession, d: str) -> DataFrame:
    return counts.target_counts(_texts(s, d), table(s, d, "occurrences").where("word is not null").select("word"))


@query("""WITH r AS (SELECT unnest(regexp_extract_all(text, '[A-Za-zァ-ヶー]+|[一-龥々]+')) AS run FROM documents), w AS (SELECT lower(unnest(regexp_extract_all(run, '[A-Za-z]+|[ァ-ヶー]+|[一-龥々]{1,2}'))) AS w FROM r)
SELECT count(*) AS tokens, count(DISTINCT w) AS "distinct" FROM w""")
def noun_totals(s: SparkSession, d: str) -> DataFrame:
    return counts.noun_totals(counts.noun_counts(_texts(s, d)))


@query(f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^。\n]*[。\n]|[^。\n]+')) AS c FROM documents),
tk AS (SELECT row_number() OVER () AS cid, regexp_extract_all(c, '[A-Za-z]+|[0-9]+|[ァ-ヶー]+|[一-龥々]{{1,2}}|[ぁ-ん]+|[ \t　]+|(?s:.)') AS ts FROM c),
p AS (SELECT cid, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS i FROM tk),
n AS (SELECT cid, i, lower(t) AS w FROM p WHERE regexp_matches(t, '^[A-Za-zァ-ヶー一-龥々]')),
tg AS (SELECT DISTINCT word FROM occurrences WHERE word IS NOT NULL)
SELECT a.w AS word, b.w AS context, count(*) AS cnt FROM n a JOIN n b ON a.cid = b.cid AND b.i BETWEEN a.i - 5 AND a.i + 5 AND a.i <> b.i WHERE a.w <> b.w AND a.w IN (SELECT word FROM tg) GROUP BY 1, 2""")
def cooccurrence_window(s: SparkSession, d: str) -> DataFrame:
    return counts.cooccurrence(_texts(s, d), table(s, d, "occurrences").where("word is not null").select("word"))


@query("WITH" + _TOKENS + "SELECT doc_id, chunk_no, start, lower(t) AS word, substring(c, greatest(start - 30, 0) + 1, start + length(t) + 30 - greatest(start - 30, 0)) AS excerpt FROM hit")
def occurrence_excerpts(s: SparkSession, d: str) -> DataFrame:
    return counts.occurrences(_texts(s, d), table(s, d, "occurrences").where("word is not null").select("word"))


@query("SELECT source, count(*) AS documents, coalesce(sum(strlen(text)), 0)::BIGINT AS text_bytes FROM documents GROUP BY source")
def source_sizes(s: SparkSession, d: str) -> DataFrame:
    return counts.source_sizes(_docs(s, d))


@query("""SELECT doc_id, len(c)::INT AS chunks, coalesce(list_max(list_transform(c, lambda x: strlen(x))), 0)::INT AS longest FROM
(SELECT doc_id, regexp_extract_all(text, '[^。\n]*[。\n]|[^。\n]+') AS c FROM documents WHERE text IS NOT NULL)""")
def chunker(s: SparkSession, d: str) -> DataFrame:
    c = _docs(s, d).where("text is not null").select("doc_id", segment.chunks(F.col("text")).alias("c"))
    return c.select("doc_id", F.size("c").alias("chunks"), F.coalesce(F.array_max(F.transform("c", F.octet_length)), F.lit(0)).alias("longest"))


_VOTES = """
vt AS (SELECT word, lower(trim(model, ' ')) AS model, pass_seed, categories, received_at FROM votes WHERE word IS NOT NULL AND model IS NOT NULL),
lw AS (SELECT word, model, pass_seed, categories FROM (SELECT DISTINCT * FROM vt) QUALIFY row_number() OVER (PARTITION BY word, model, pass_seed ORDER BY received_at DESC, categories DESC NULLS LAST) = 1)
"""


def _votes(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "votes").where("word is not null and model is not null").select("word", F.lower(F.trim("model")).alias("model"), "pass_seed", "categories", "received_at")
    return votes.last_wins(v, ["word", "model", "pass_seed"], ["received_at", "categories"]).select("word", "model", "pass_seed", "categories")


@query("WITH" + _VOTES + "SELECT * FROM lw")
def votes_last_wins(s: SparkSession, d: str) -> DataFrame:
    return _votes(s, d)


@query("""WITH t AS (SELECT word, model, pass_seed, count(*) AS lines, bool_or(categories IS NULL) AS a, bool_or(coalesce(len(categories) = 0, false)) AS b, bool_or(coalesce(categories <> list_sort(categories), false)) AS c,
 bool_or(coalesce(len(list_distinct(categories)) < len(categories), false)) AS d,
 bool_or(coalesce(len(list_filter(categories, lambda x: NOT (x BETWEEN 10 AND 19 OR x BETWEEN 20 AND 27 OR x BETWEEN 30 AND 38 OR x BETWEEN 40 AND 47 OR x BETWEEN 50 AND 57))) > 0, false)) AS e FROM votes GROUP BY 1, 2, 3)
SELECT word, model, pass_seed, lines, concat_ws(',', CASE WHEN lines > 1 THEN 'repeated' END, CASE WHEN a THEN 'no_categories' END, CASE WHEN b THEN 'empty' END, CASE WHEN c THEN 'unsorted' END,
 CASE WHEN d THEN 'repeated_category' END, CASE WHEN e THEN 'outside_scheme' END) AS problems FROM t WHERE lines > 1 OR a OR b OR c OR d OR e""")
def votes_verify(s: SparkSession, d: str) -> DataFrame:
    return votes.problems(table(s, d, "votes"), [(10, 19), (20, 27), (30, 38), (40, 47), (50, 57)])


_FINAL = _VOTES + """,
st AS (SELECT word, model, list_sort(list_distinct(categories)) AS cs FROM lw WHERE categories IS NOT NULL),
gr AS (SELECT word, model, count(*) AS votes, list(cs) AS sets, list_sort(list_distinct(flatten(list(cs)))) AS every, count(DISTINCT cs) = 1 AS unanimous FROM st GROUP BY 1, 2),
kp AS (SELECT *, CASE WHEN votes = 1 THEN sets[1] ELSE list_filter(every, lambda c: len(list_filter(sets, lambda x: list_contains(x, c))) >= 2) END AS categories FROM gr),
fn AS (SELECT word, model, votes, CASE WHEN votes = 1 THEN 'single-vote' WHEN len(categories) > 0 THEN 'majority' ELSE 'unstable' END AS rule, unanimous, categories,
       list_filter(every, lambda c: NOT list_contains(categories, c)) AS dropped FROM kp)
"""


@query("WITH" + _FINAL + "SELECT word, model, votes, rule, unanimous, array_to_string(categories, ',') AS categories, array_to_string(dropped, ',') AS dropped FROM fn")
def votes_finalize(s: SparkSession, d: str) -> DataFrame:
    f = votes.finalized(_votes(s, d), ["word", "model"])
    return f.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("categories", "dropped")})


@query("WITH" + _FINAL + "SELECT rule, votes, unanimous, count(*) AS n FROM fn GROUP BY ALL")
def votes_rules(s: SparkSession, d: str) -> DataFrame:
    return votes.rule_histogram(votes.finalized(_votes(s, d), ["word", "model"]))


_DIS = _FINAL + """,
dj AS (SELECT a.word, a.categories AS x, b.categories AS y, a.unanimous AS u1, b.unanimous AS u2, a.votes AS v1, b.votes AS v2 FROM fn a JOIN fn b USING (word) WHERE a.model = 'asahina-l2' AND b.model = 'kestrel-9'),
dr AS (SELECT *, len(list_intersect(x, y)) AS n, len(list_filter(x, lambda c: NOT list_contains(y, c))) AS xo, len(list_filter(y, lambda c: NOT list_contains(x, c))) AS yo,
       len(x) > 0 AND len(list_filter(x, lambda c: NOT (c BETWEEN 40 AND 59))) = 0 AS cx, len(y) > 0 AND len(list_filter(y, lambda c: NOT (c BETWEEN 40 AND 59))) = 0 AS cy FROM dj),
dd AS (SELECT word, CASE WHEN xo = 0 AND yo = 0 THEN 'equal' WHEN n = 0 THEN 'disjoint' WHEN xo = 0 OR yo = 0 THEN 'containment' ELSE 'partial' END AS kind, cx <> cy AS concrete_split,
       CASE WHEN v1 < 2 OR v2 < 2 THEN 'single' WHEN NOT (u1 AND u2) THEN 'wobble' ELSE 'steady' END AS stability FROM dr)
"""


@query("WITH" + _DIS + "SELECT * FROM dd")
def votes_disagreement(s: SparkSession, d: str) -> DataFrame:
    return votes.disagreement(votes.finalized(_votes(s, d), ["word", "model"]), "asahina-l2", "kestrel-9").select("word", "kind", "concrete_split", "stability")


@query("WITH" + _DIS + "SELECT kind, stability, count(*) AS n, count(*) FILTER (concrete_split) AS concrete_splits FROM dd GROUP BY 1, 2")
def votes_disagreement_summary(s: SparkSession, d: str) -> DataFrame:
    return votes.disagreement_summary(votes.disagreement(votes.finalized(_votes(s, d), ["word", "model"]), "asahina-l2", "kestrel-9"))


@query("WITH" + _FINAL + """SELECT word, array_to_string(list_sort(list_distinct(flatten(list(categories)))), ',') AS categories FROM fn WHERE model IN ('asahina-l2', 'brome-13') GROUP BY word""")
def category_union(s: SparkSession, d: str) -> DataFrame:
    f = votes.finalized(_votes(s, d), ["word", "model"])
    u = votes.category_union(f.where("model = 'asahina-l2'"), f.where("model = 'brome-13'"))
    return u.withColumn("categories", F.array_join(F.col("categories").cast("array<string>"), ","))


@query("""WITH w AS (SELECT word, row_number() OVER (ORDER BY md5('694:' || word), word) - 1 AS r FROM (SELECT DISTINCT word FROM votes WHERE word IS NOT NULL))
SELECT word, r // 20 AS chunk_id, r % 20 AS chunk_index FROM w""")
def vote_batches(s: SparkSession, d: str) -> DataFrame:
    return votes.batches(table(s, d, "votes"), 694)


@query("SELECT DISTINCT word FROM votes WHERE word IS NOT NULL AND word NOT IN (SELECT word FROM votes WHERE word IS NOT NULL AND pass_seed = 1003)")
def todo_words(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "votes")
    return votes.to_do(v, v.where("pass_seed = 1003"))


@query("SELECT lower(trim(model, ' ')) AS model, pass_seed, count(*) AS lines, count(DISTINCT word) AS words FROM votes WHERE model IS NOT NULL GROUP BY 1, 2")
def vote_manifest(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "votes").where("model is not null")
    return v.groupBy(F.lower(F.trim("model")).alias("model"), "pass_seed").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("word").alias("words"))


@query("WITH" + _VOTES + """,
pq AS (SELECT a.model, list_sort(list_distinct(a.categories)) AS x, list_sort(list_distinct(b.categories)) AS y FROM lw a JOIN lw b USING (word, model) WHERE a.pass_seed = 694 AND b.pass_seed = 1002 AND a.categories IS NOT NULL AND b.categories IS NOT NULL)
SELECT model, count(*) AS n, round(avg((x = y)::INT::DOUBLE), 6) AS exact, round(avg((len(list_intersect(x, y)) > 0)::INT::DOUBLE), 6) AS overlap,
 round(avg(((len(x) > 0 AND len(list_filter(x, lambda c: NOT (c BETWEEN 40 AND 59))) = 0) = (len(y) > 0 AND len(list_filter(y, lambda c: NOT (c BETWEEN 40 AND 59))) = 0))::INT::DOUBLE), 6) AS concrete FROM pq GROUP BY model""")
def repeat_run_agreement(s: SparkSession, d: str) -> DataFrame:
    v = _votes(s, d).where("categories is not null").withColumn("categories", F.array_sort(F.array_distinct("categories")))
    a = v.where("pass_seed = 694").select("word", "model", F.col("categories").alias("a"))
    b = v.where("pass_seed = 1002").select("word", "model", F.col("categories").alias("b"))
    return votes.agreement(a.join(b, ["word", "model"]), ["model"])


@query("WITH" + _VOTES + """,
pq AS (SELECT a.model, list_distinct(list_transform(a.categories, lambda c: c // 10)) AS x, list_distinct(list_transform(b.categories, lambda c: c // 10)) AS y FROM lw a JOIN lw b USING (word, model) WHERE a.pass_seed = 694 AND b.pass_seed = 1002 AND a.categories IS NOT NULL AND b.categories IS NOT NULL),
un AS (SELECT model, x, y, unnest(list_distinct(list_concat(x, y)))::INT AS division FROM pq)
SELECT model, division, count(*) AS n, round(avg((list_contains(x, division) AND list_contains(y, division))::INT::DOUBLE), 6) AS both FROM un GROUP BY 1, 2""".replace("AS both", 'AS "both"'))
def division_agreement(s: SparkSession, d: str) -> DataFrame:
    v = _votes(s, d).where("categories is not null")
    a = v.where("pass_seed = 694").select("word", "model", F.col("categories").alias("a"))
    b = v.where("pass_seed = 1002").select("word", "model", F.col("categories").alias("b"))
    return votes.division_agreement(a.join(b, ["word", "model"]), ["model"])


_RANKS = """
rs AS (SELECT occ_id, word, any_value(context) AS context FROM occurrences WHERE word IS NOT NULL AND occ_id IS NOT NULL GROUP BY occ_id, word),
cd AS (SELECT occ_id, word, unnest(context) AS candidate, unnest(range(1, len(context) + 1)) AS i FROM rs),
ft AS (SELECT occ_id, word, candidate, min(i) AS i FROM cd WHERE candidate IS NOT NULL AND candidate <> '' GROUP BY ALL),
rk AS (SELECT word, candidate, count(*) AS votes, round(avg(i), 6) AS mean_rank FROM ft GROUP BY 1, 2)
"""


def _ranked(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "occurrences").where("word is not null and occ_id is not null").dropDuplicates(["occ_id", "word"])
    return substitution.ranked_candidates(o.select("word", F.col("context").alias("candidates")), ["word"])


@query("WITH" + _RANKS + "SELECT word, candidate, votes, mean_rank FROM rk")
def candidate_rank_votes(s: SparkSession, d: str) -> DataFrame:
    return _ranked(s, d)


@query("WITH" + _RANKS + "SELECT word, candidate, votes, mean_rank, row_number() OVER (PARTITION BY word ORDER BY votes DESC, mean_rank, candidate)::INT AS place FROM rk QUALIFY place <= 12")
def candidate_top12(s: SparkSession, d: str) -> DataFrame:
    return substitution.top_candidates(_ranked(s, d), ["word"])


@query("WITH" + _RANKS + """, ct AS (SELECT term FROM term_counts WHERE term IS NOT NULL AND total IS NOT NULL GROUP BY term HAVING sum(total) >= 10)
SELECT word, candidate, votes, mean_rank FROM rk WHERE votes >= 1 AND NOT regexp_matches(candidate, '^[ァ-ヶー・]+$') AND candidate IN (SELECT term FROM ct)""")
def accepted_candidates(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "term_counts").where("term is not null and total is not null").groupBy(F.col("term").alias("word")).agg(F.sum("total").alias("cnt"))
    return substitution.accepted(_ranked(s, d), c, min_votes=1, min_count=10)


@query("""WITH c AS (SELECT source, term, sum(total)::BIGINT AS cnt FROM term_counts WHERE kind = 'noun' AND term IS NOT NULL AND total IS NOT NULL GROUP BY 1, 2), t AS (SELECT source, sum(cnt) AS n FROM c GROUP BY 1)
SELECT c.source, term, cnt, round(cnt * 1e6::DOUBLE / n, 6) AS rate FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source""")
def rate_per_million(s: SparkSession, d: str) -> DataFrame:
    return substitution.rates_per_million(table(s, d, "term_counts").where("kind = 'noun'"), "source")


@query("WITH c AS (SELECT DISTINCT word, unnest(context) AS o FROM occurrences WHERE word IS NOT NULL) SELECT o, count(*) AS words FROM c WHERE o IS NOT NULL GROUP BY o HAVING count(*) >= 2")
def context_fan_in(s: SparkSession, d: str) -> DataFrame:
    return substitution.fan_in(table(s, d, "occurrences").select("word", F.explode("context").alias("o")), "o", "word")


@query("""WITH f AS (SELECT kind, term, CASE WHEN source IN ('kagami-wiki', 'lumen-journal') THEN 'general' WHEN source IN ('sato-gazette', 'legal-corner') THEN 'law' ELSE 'field' END AS c, total FROM term_counts
 WHERE term IS NOT NULL AND total IS NOT NULL AND source IS NOT NULL), g AS (SELECT kind, term, coalesce(sum(total) FILTER (c = 'field'), 0)::BIGINT AS field, coalesce(sum(total) FILTER (c = 'general'), 0)::BIGINT AS general,
 coalesce(sum(total) FILTER (c = 'law'), 0)::BIGINT AS law FROM f GROUP BY 1, 2) SELECT kind, term, field, general, greatest(general - field, 0) AS general_only, law FROM g""")
def frame_merge(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "term_counts").where("term is not null and total is not null and source is not null")
    c = F.when(F.col("source").isin("kagami-wiki", "lumen-journal"), "general").when(F.col("source").isin("sato-gazette", "legal-corner"), "law").otherwise("field")
    return substitution.frame_merge(t.select("kind", "term", c.alias("corpus"), F.col("total").alias("cnt")), ["kind", "term"])


@query("""SELECT word, "case", predicate, count(*) AS cnt, grouping(word, "case", predicate) AS level FROM (SELECT l_returnflag AS word, l_linestatus AS "case", l_suppkey AS predicate FROM lineitem)
WHERE word IS NOT NULL AND "case" IS NOT NULL AND predicate IS NOT NULL GROUP BY GROUPING SETS ((word, "case", predicate), (word, "case"), ("case", predicate), (word), ("case"))""")
def case_frame_marginals(s: SparkSession, d: str) -> DataFrame:
    return counts.case_frames(table(s, d, "lineitem").select(F.col("l_returnflag").alias("word"), F.col("l_linestatus").alias("case"), F.col("l_suppkey").alias("predicate")))


_PROF = """
oc AS (SELECT occ_id, any_value(word) AS word, any_value(context) AS context FROM occurrences WHERE occ_id IS NOT NULL AND word IS NOT NULL GROUP BY occ_id),
pf AS (SELECT word, context, count(*) AS n FROM (SELECT word, unnest(context) AS context FROM oc) WHERE context IS NOT NULL GROUP BY 1, 2),
nm AS (SELECT word, sqrt(sum(n * n)::DOUBLE) AS l FROM pf GROUP BY word)
"""


def _occ(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "occurrences").where("occ_id is not null and word is not null").dropDuplicates(["occ_id"])


def _profiles(s: SparkSession, d: str) -> DataFrame:
    return substitution.profiles(_occ(s, d).select("word", F.explode("context").alias("context")))


@query("WITH" + _PROF + """,
qs AS (SELECT word FROM oc GROUP BY word HAVING min(occ_id) % 20 = 0),
dt AS (SELECT a.word AS word_a, b.word AS word_b, sum(a.n * b.n) AS dot FROM pf a JOIN pf b USING (context) WHERE a.word <> b.word AND a.word IN (SELECT word FROM qs) GROUP BY 1, 2)
SELECT word_a, word_b, round(dot / (x.l * y.l), 9) AS cosine FROM dt JOIN nm x ON x.word = word_a JOIN nm y ON y.word = word_b""")
def profile_cosine(s: SparkSession, d: str) -> DataFrame:
    """Words whose first occurrence has an id divisible by 20, as queries, against all words."""
    o = _occ(s, d)
    p = _profiles(s, d)
    asked = o.groupBy("word").agg((F.min("occ_id") % 20).alias("m")).where("m = 0").select("word")
    return substitution.cosines(p.join(asked, "word", "left_semi"), p)


@query("WITH" + _PROF + """,
gp AS (SELECT DISTINCT left(word, 2) AS word, word AS loanword FROM pf),
pp AS (SELECT a.word, a.loanword AS loan_a, b.loanword AS loan_b FROM gp a JOIN gp b ON a.word = b.word AND a.loanword < b.loanword),
dt AS (SELECT pp.word, loan_a, loan_b, sum(x.n * y.n) AS dot FROM pp JOIN pf x ON x.word = loan_a JOIN pf y ON y.word = loan_b AND x.context = y.context GROUP BY 1, 2, 3),
cs AS (SELECT pp.*, round(coalesce(dot, 0) / (a.l * b.l), 9) AS cosine FROM pp LEFT JOIN dt USING (word, loan_a, loan_b) JOIN nm a ON a.word = loan_a JOIN nm b ON b.word = loan_b)
SELECT word, loan_a, loan_b, cosine FROM cs QUALIFY row_number() OVER (PARTITION BY word ORDER BY cosine, loan_a, loan_b) = 1 AND cosine <= 0.15""")
def split_senses(s: SparkSession, d: str) -> DataFrame:
    p = _profiles(s, d)
    return substitution.split_senses(p.select(F.substring("word", 1, 2).alias("word"), F.col("word").alias("loanword")), p)


@query("WITH" + _PROF + """,
sn AS (SELECT DISTINCT left(word, 2) AS g, word AS sense FROM oc), tt AS (SELECT word AS sense, sum(n) AS total FROM pf GROUP BY 1), vv AS (SELECT count(DISTINCT context) AS v FROM pf),
ex AS (SELECT occ_id, left(word, 2) AS word, unnest(context) AS context FROM oc),
ft AS (SELECT occ_id, ex.word, sn.sense, round(avg(ln((coalesce(n, 0) + 0.5) / (coalesce(total, 0) + 0.5 * v)::DOUBLE)), 6) AS fit FROM ex JOIN sn ON sn.g = ex.word LEFT JOIN pf ON pf.word = sn.sense AND pf.context = ex.context
       LEFT JOIN tt ON tt.sense = sn.sense, vv WHERE ex.context IS NOT NULL GROUP BY 1, 2, 3)
SELECT occ_id, word, sense, fit FROM ft QUALIFY row_number() OVER (PARTITION BY occ_id, word ORDER BY fit DESC, sense) = 1""")
def sense_judge(s: SparkSession, d: str) -> DataFrame:
    o = _occ(s, d)
    first = F.substring("word", 1, 2).alias("word")
    return substitution.sense_fit(o.select("occ_id", first, "context"), o.select(first, F.col("word").alias("sense")), _profiles(s, d))


_DET = """
lb AS (SELECT doc_id, bool_or(label <> 'none') AS truth FROM content_labels WHERE label IS NOT NULL GROUP BY doc_id),
dt AS (SELECT source, n_chars, truth, regexp_matches(text, '!|！') AS flagged FROM documents JOIN lb USING (doc_id))
"""
_MATRIX = """count(*) FILTER (truth AND flagged) AS tp, count(*) FILTER (NOT truth AND flagged) AS fp, count(*) FILTER (truth AND NOT flagged) AS fn, count(*) FILTER (NOT truth AND NOT flagged) AS tn"""
_RATES = """tp, fp, fn, tn, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp)::DOUBLE, 6) END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn)::DOUBLE, 6) END AS recall,
 CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(greatest((tp / (tp + fp)::DOUBLE + 3.8416 / (2 * (tp + fp)) - 1.96 * sqrt(tp / (tp + fp)::DOUBLE * (1 - tp / (tp + fp)::DOUBLE) / (tp + fp) + 3.8416 / (4 * (tp + fp) * (tp + fp)))) / (1 + 3.8416 / (tp + fp)), 0), 6) END AS low,
 CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(least((tp / (tp + fp)::DOUBLE + 3.8416 / (2 * (tp + fp)) + 1.96 * sqrt(tp / (tp + fp)::DOUBLE * (1 - tp / (tp + fp)::DOUBLE) / (tp + fp) + 3.8416 / (4 * (tp + fp) * (tp + fp)))) / (1 + 3.8416 / (tp + fp)), 1), 6) END AS high"""


def _detected(s: SparkSession, d: str) -> DataFrame:
    lab = table(s, d, "content_labels").where("label is not null").groupBy("doc_id").agg(F.bool_or(F.col("label") != "none").alias("truth"))
    return _docs(s, d).select("doc_id", "source", "n_chars", F.coalesce(F.col("text").rlike("!|！"), F.lit(False)).alias("flagged")).join(lab, "doc_id")


@query("WITH" + _DET + f", g AS (SELECT source, {_MATRIX} FROM dt GROUP BY source) SELECT source, {_RATES} FROM g")
def detector_matrix(s: SparkSession, d: str) -> DataFrame:
    return evals.matrix(_detected(s, d), ["source"])


@query("WITH" + _DET + f", g AS (SELECT threshold::DOUBLE AS threshold, {_MATRIX.replace('flagged', '(n_chars >= threshold)')} FROM dt, (SELECT unnest([100, 300, 500, 900]) AS threshold) GROUP BY 1) SELECT threshold, {_RATES} FROM g")
def threshold_sweep(s: SparkSession, d: str) -> DataFrame:
    return evals.sweep(_detected(s, d).select("truth", F.col("n_chars").cast("double").alias("score")), [100.0, 300.0, 500.0, 900.0])


@query("""WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16'), b AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16')
SELECT user_id, event_type, CASE WHEN a.k IS NULL THEN 'gained' WHEN b.k IS NULL THEN 'lost' ELSE 'kept' END AS change FROM (SELECT *, 1 AS k FROM a) a FULL JOIN (SELECT *, 1 AS k FROM b) b USING (user_id, event_type)""")
def findings_difference(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    return evals.run_difference(e.where("ts < timestamp '2024-01-16'"), e.where("ts >= timestamp '2024-01-16'"), ["user_id", "event_type"])


@query("""WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'click'), b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'),
x AS (SELECT (SELECT count(*) FROM a JOIN b USING (user_id)) AS both_, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either_)
SELECT both_ AS "both", either_ AS either, CASE WHEN either_ > 0 THEN round(both_ / either_::DOUBLE, 6) END AS jaccard FROM x""")
def set_jaccard(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    return evals.jaccard(e.where("event_type = 'click'"), e.where("event_type = 'purchase'"), ["user_id"])


@query("WITH" + _DET + """, st AS (SELECT lang AS stratum, count(*) AS n FROM documents GROUP BY 1), lr AS (SELECT lang AS stratum, avg(truth::INT::DOUBLE) AS p FROM documents JOIN lb USING (doc_id) GROUP BY 1)
SELECT round(sum(n * coalesce(p, 0)) / sum(n), 6) AS estimate, sum(n)::BIGINT AS total FROM st LEFT JOIN lr ON st.stratum = lr.stratum""")
def stratified_precision(s: SparkSession, d: str) -> DataFrame:
    lab = table(s, d, "content_labels").where("label is not null").groupBy("doc_id").agg(F.bool_or(F.col("label") != "none").alias("ok"))
    docs = _docs(s, d).select("doc_id", F.col("lang").alias("stratum"))
    return evals.stratified_precision(docs.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), docs.join(lab, "doc_id"))


@query("SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id), doc_id) <= 5")
def hashed_sample(s: SparkSession, d: str) -> DataFrame:
    return evals.hashed_sample(_docs(s, d).select("doc_id", "source", "lang"), "doc_id", 5, 7, ["source"])


@query("""WITH c AS (SELECT source, lang, count(*) AS c FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2), t AS (SELECT *, sum(c) OVER (PARTITION BY source) AS n FROM c)
SELECT source, n::BIGINT AS n, lang AS mode, round(c / n::DOUBLE, 6) AS share FROM t QUALIFY row_number() OVER (PARTITION BY source ORDER BY c DESC, lang) = 1""")
def mode_share(s: SparkSession, d: str) -> DataFrame:
    return evals.mode_share(_docs(s, d), "source", "lang")


@query("SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL")
def sha256_digest(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("""SELECT source_name, CASE WHEN list_contains(coalesce(styles, []), '法令文') THEN 7 WHEN split_part(source_name, '-', 1) IN ('tecnote', 'mirune', 'orbis') THEN 1 ELSE 6 END AS domain, documents, text_bytes
FROM source_stats""")
def source_domains(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "source_stats")
    return t.select("source_name", domains.source_domain(F.col("source_name"), F.col("styles"), ["tecnote", "mirune", "orbis"]).alias("domain"), "documents", "text_bytes")


@query("""SELECT CASE WHEN regexp_matches(id, '^[1-5]\\d\\d') THEN left(id, 1)::INT END AS era, count(*) AS n, count(*) FILTER (coalesce(left(id, 1)::INT < 3 OR (left(id, 1)::INT = 3 AND substr(id, 2, 2)::INT < 22), false)) AS classical
FROM (SELECT o_orderkey::VARCHAR AS id FROM orders WHERE length(o_orderkey::VARCHAR) >= 3) GROUP BY 1""")
def law_eras(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("id")).where("length(id) >= 3")
    era, _ = domains.law_era(F.col("id"))
    r = ids.select(era.alias("era"), domains.is_classical(F.col("id")).alias("c"))
    return r.groupBy("era").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("c", F.lit(False))).alias("classical"))


@query("""SELECT s, count(*) AS words FROM (SELECT DISTINCT term, CASE WHEN regexp_matches(term, '^[A-Za-z0-9 ]+$') THEN 'latin' WHEN regexp_matches(term, '^[ァ-ヶー・]+$') THEN 'katakana' WHEN regexp_matches(term, '^[ぁ-ん]+$') THEN 'hiragana'
 WHEN regexp_matches(term, '^[一-龥々]+$') THEN 'kanji' ELSE 'mixed' END AS s FROM run_lines WHERE term IS NOT NULL) GROUP BY s""")
def script_classes(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "run_lines").where("term is not null").select("term").distinct()
    return t.groupBy(script(F.col("term")).alias("s")).agg(F.count(F.lit(1)).alias("words"))


@query("""WITH g AS (SELECT DISTINCT msgid FROM entries WHERE msgid IS NOT NULL), c AS (SELECT msgid, trim(lower(regexp_replace(msgid, '\\([^()]*\\)', '', 'g')), ' ') AS x FROM g)
SELECT msgid, CASE WHEN regexp_full_match(x, '[a-z][a-z'' -]*[a-z]') THEN x END AS core FROM c""")
def gloss_cores(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "entries").where("msgid is not null").select("msgid").distinct()
    return g.select("msgid", gloss_core(F.col("msgid")).alias("core"))


_NOV = """
oc AS (SELECT occ_id, any_value(word) AS word, any_value(context) AS context, any_value(file_path) AS fp FROM occurrences WHERE occ_id IS NOT NULL AND word IS NOT NULL GROUP BY occ_id),
ow AS (SELECT occ_id, word, left(word, 1) AS cls, key, count(*) AS own FROM (SELECT occ_id, word, unnest(context) AS key FROM oc) WHERE key IS NOT NULL GROUP BY ALL),
j AS (SELECT *, sum(own) OVER (PARTITION BY word, key) AS wf, sum(own) OVER (PARTITION BY cls, key) AS cf, sum(own) OVER (PARTITION BY word) AS wn, sum(own) OVER (PARTITION BY cls) AS cn FROM ow),
v AS (SELECT occ_id, wf = own AS z, -ln((wf - own + 20.0::DOUBLE * ((cf - own + 0.5::DOUBLE) / (cn - own + 1))) / (wn - own + 20.0::DOUBLE)) AS v FROM j)
"""


@query("WITH" + _NOV + "SELECT occ_id, 'context' AS grp, round(avg(v), 6) + 0.0 AS mean, round(max(v), 6) + 0.0 AS most, round(avg(z::INT::DOUBLE), 6) AS zero_share FROM v GROUP BY occ_id")
def novelty_features(s: SparkSession, d: str) -> DataFrame:
    o = _occ(s, d)
    keys = o.select("occ_id", F.lit("context").alias("grp"), F.explode("context").alias("key")).where("key is not null")
    n = features.novelty(o.select("occ_id", "word"), keys, o.select("word", F.substring("word", 1, 1).alias("cls")).distinct())
    return n.withColumns({c: F.col(c) + F.lit(0.0) for c in ("mean", "most")})


@query()
def flattened_entries(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "entries").select("entry_id", "source_name", F.explode("msgstrs").alias("text")).where("text is not null")
    f = table(s, d, "sources").select("source_name", "file_format")
    return e.join(f, "source_name", "left").select("entry_id", flatten_text(F.col("file_format"), F.col("text")).alias("text"))


@query("""WITH RECURSIVE tot AS (SELECT term, sum(total) AS n FROM term_counts WHERE kind = 'component' AND term IS NOT NULL AND total > 0 GROUP BY term),
pt AS (SELECT term AS part FROM tot WHERE length(term) >= 2 AND n * 1000000.0 / (SELECT sum(n) FROM tot) >= 5),
w AS (SELECT DISTINCT term FROM run_lines WHERE term IS NOT NULL),
st AS (SELECT term, 0 AS pos, []::VARCHAR[] AS parts FROM w
 UNION ALL SELECT term, pos + l, list_append(parts, substr(term, pos + 1, l)) FROM (SELECT s.term, s.pos, s.parts, max(length(part)) AS l FROM st s JOIN pt ON starts_with(substr(s.term, s.pos + 1), part) GROUP BY ALL))
SELECT term, array_to_string(parts, '|') AS parts FROM st WHERE pos = length(term) AND len(parts) >= 2""")
def compound_splits(s: SparkSession, d: str) -> DataFrame:
    """Words cut greedily into components of at least 5 per million."""
    parts = [r[0] for r in substitution.frequent_parts(table(s, d, "term_counts").where("kind = 'component'")).select("term").collect()]
    w = spread(table(s, d, "run_lines").where("term is not null").select("term").distinct(), "term")
    return w.select("term", F.array_join(substitution.split_parts(F.col("term"), parts), "|").alias("parts")).where("parts is not null")


@query("""SELECT doc_id, (CASE WHEN n_chars IS NULL OR n_chars <= 300 THEN -1.0::DOUBLE WHEN regexp_matches(text, '[0-9]') THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END + 0.1::DOUBLE - 0.25::DOUBLE) / 2.0::DOUBLE AS score FROM documents""")
def tree_scores(s: SparkSession, d: str) -> DataFrame:
    leaf = lambda v: {"value": v}
    tree = {"feature": "n_chars", "threshold": 300.0, "missing": "nan", "default_left": True, "left": leaf(-1.0), "right": {"feature": "has_digit", "categories": [1.0], "left": leaf(2.0), "right": leaf(0.5)}}
    model = {"features": ["n_chars", "has_digit"], "boosters": [{"weight": 1.0, "mean": 0.25, "std": 2.0, "trees": [tree, leaf(0.1)]}]}
    x = _docs(s, d).select("doc_id", F.col("n_chars").cast("double"), F.col("text").rlike("[0-9]").cast("double").alias("has_digit"))
    return features.scored(x, model, "doc_id")


def _frames(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    f = table(s, d, "lineitem").select(F.col("l_returnflag").alias("word"), F.col("l_linestatus").alias("case"), F.col("l_suppkey").alias("predicate"), (F.col("l_linenumber") == 1).alias("standalone"))
    return f, s.createDataFrame([("A",), ("R",)], "word string")


@query("""WITH f AS (SELECT l_returnflag AS word, l_linestatus AS "case", l_suppkey AS predicate, l_linenumber = 1 AS alone FROM lineitem WHERE l_returnflag IN ('A', 'R'))
SELECT word, "case", predicate, count(*) AS cnt FROM f WHERE alone GROUP BY GROUPING SETS ((word, "case", predicate), (word)) UNION ALL SELECT NULL, NULL, NULL, count(*) FROM f WHERE NOT alone""")
def frame_tables(s: SparkSession, d: str) -> DataFrame:
    return counts.frame_tables(*_frames(s, d))


@query("""SELECT l_returnflag AS word, CASE WHEN l_suppkey % 4 = 0 THEN 'の' WHEN l_suppkey % 4 = 1 THEN '連体' WHEN l_suppkey % 4 = 2 THEN 'なし' ELSE 'その他' END AS kind, l_linestatus AS modifier, count(*) AS cnt
FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linenumber = 1 GROUP BY ALL""")
def modifier_counts(s: SparkSession, d: str) -> DataFrame:
    k = F.pmod("l_suppkey", F.lit(4))
    kind = F.when(k == 0, "の").when(k == 1, "連体").when(k == 3, "x")
    m = table(s, d, "lineitem").select(F.col("l_returnflag").alias("word"), kind.alias("kind"), F.col("l_linestatus").alias("modifier"), (F.col("l_linenumber") == 1).alias("standalone"))
    return counts.modifier_counts(m, _frames(s, d)[1])


@query("WITH" + _DET + f""", k AS (SELECT * FROM (VALUES ('plain', 300, []), ('no first', 300, ['a']), ('neither', 500, ['a', 'b'])) t(condition, threshold, ls)),
x AS (SELECT condition, truth, n_chars >= threshold AND NOT coalesce(list_contains(ls, CASE WHEN source < 'k' THEN 'a' END) OR list_contains(ls, CASE WHEN lang = 'en' THEN 'b' END), false) AS flagged
      FROM (SELECT d.source, d.lang, d.n_chars, truth FROM documents d JOIN lb USING (doc_id)), k),
g AS (SELECT condition, {_MATRIX.replace('flagged', 'coalesce(flagged, false)')} FROM x GROUP BY 1) SELECT condition, {_RATES} FROM g""")
def exemption_sweep(s: SparkSession, d: str) -> DataFrame:
    """Conditions of a threshold and lists of exempt words: documents by source as word and language as surface."""
    docs = _docs(s, d)
    lab = table(s, d, "content_labels").where("label is not null").groupBy("doc_id").agg(F.bool_or(F.col("label") != "none").alias("truth"))
    rows = docs.join(lab, "doc_id").select(F.col("source").alias("word"), F.col("lang").alias("surface"), F.col("n_chars").cast("double").alias("score"), "truth")
    lists = docs.where("source < 'k'").select(F.lit("a").alias("list"), F.col("source").alias("word")).distinct().unionByName(s.createDataFrame([("b", "en")], "list string, word string"))
    return evals.conditions(rows, [("plain", 300, []), ("no first", 300, ["a"]), ("neither", 500, ["a", "b"])], lists)


@query("""WITH o AS (SELECT word, CASE WHEN occ_id % 7 = 0 THEN 'x' END AS error, context FROM occurrences WHERE word IS NOT NULL)
SELECT word, count(*) AS responses, count(*) FILTER (error IS NULL AND len(list_filter(coalesce(context, []), lambda c: c IS NOT NULL AND c <> '')) = 0) AS empty, count(*) FILTER (error IS NOT NULL) AS errors FROM o GROUP BY word""")
def response_tallies(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "occurrences").where("word is not null").select("word", F.col("context").alias("candidates"), F.when(F.pmod("occ_id", F.lit(7)) == 0, "x").alias("error"))
    return substitution.response_tallies(o, ["word"])


@query("""WITH c AS (SELECT source, term, sum(total)::BIGINT AS cnt FROM term_counts WHERE kind = 'noun' AND term IS NOT NULL AND total IS NOT NULL AND source IN ('kagami-wiki', 'lumen-journal') GROUP BY 1, 2),
t AS (SELECT source, sum(cnt) AS n FROM c GROUP BY 1), r AS (SELECT term, max(round(cnt * 1e6::DOUBLE / n, 6)) AS rate FROM c JOIN t USING (source) GROUP BY term)
SELECT term, coalesce(rate, 0) AS rate FROM (SELECT DISTINCT term FROM term_counts WHERE kind = 'noun' AND term IS NOT NULL) LEFT JOIN r USING (term)""")
def best_rates(s: SparkSession, d: str) -> DataFrame:
    return substitution.best_rates(table(s, d, "term_counts").where("kind = 'noun'"), ["kagami-wiki", "lumen-journal"], "source")


@query("SELECT (SELECT n_chars::DOUBLE FROM documents WHERE n_chars IS NOT NULL ORDER BY n_chars DESC LIMIT 1 OFFSET 123) AS line")
def score_line(s: SparkSession, d: str) -> DataFrame:
    return features.score_line(_docs(s, d).select(F.col("n_chars").alias("score")), 61.5, 2.0)


@query("SELECT term AS value, (row_number() OVER (ORDER BY term) - 1)::INT AS code FROM (SELECT DISTINCT term FROM run_lines WHERE term IS NOT NULL)")
def categorical_levels(s: SparkSession, d: str) -> DataFrame:
    return features.levels(table(s, d, "run_lines"), "term")


@query("SELECT round(avg(n_chars), 6) AS mean, round(stddev_pop(n_chars), 6) AS std FROM documents WHERE n_chars IS NOT NULL")
def score_moments(s: SparkSession, d: str) -> DataFrame:
    m = features.moments(_docs(s, d).select(F.col("n_chars").cast("double").alias("score")))
    return m.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("WITH" + _DET + f""", g AS (SELECT source AS condition, {_MATRIX} FROM dt WHERE source IS NOT NULL GROUP BY source)
SELECT condition, tp, fp, EXISTS (SELECT 1 FROM g h WHERE h.tp >= g.tp AND h.fp <= g.fp AND (h.tp, h.fp) <> (g.tp, g.fp)) AS dominated FROM g""")
def dominated_conditions(s: SparkSession, d: str) -> DataFrame:
    m = evals.matrix(_detected(s, d).where("source is not null"), ["source"])
    return evals.dominated(m.select(F.col("source").alias("condition"), "tp", "fp"))


@query("""WITH t AS (SELECT doc_id, rater, bool_or(label <> 'none') AS t FROM content_labels WHERE label IS NOT NULL AND rater IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1, 2), u AS (SELECT doc_id, bool_or(t) AS t FROM t GROUP BY 1)
SELECT f.doc_id, f.rater, coalesce(t.t, u.t) AS truth, coalesce(t.t, u.t) IS NULL AS outside FROM (SELECT doc_id, 'r01' AS rater FROM documents) f LEFT JOIN t ON t.doc_id = f.doc_id AND t.rater = f.rater LEFT JOIN u ON u.doc_id = f.doc_id""")
def matched_findings(s: SparkSession, d: str) -> DataFrame:
    truth = table(s, d, "content_labels").where("label is not null and rater is not null and doc_id is not null").select("doc_id", "rater", (F.col("label") != "none").alias("truth"))
    return evals.matched(_docs(s, d).select("doc_id", F.lit("r01").alias("rater")), truth, ["doc_id", "rater"], ["doc_id"])


@query("""WITH c AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 3 = 0), f AS (SELECT DISTINCT doc_id FROM documents WHERE text LIKE '%！%'), l AS (SELECT doc_id, max(label) AS label FROM content_labels GROUP BY 1)
SELECT c.doc_id, label, f.doc_id IS NOT NULL AS found, false AS only_detector FROM c LEFT JOIN l ON l.doc_id = c.doc_id LEFT JOIN f ON f.doc_id = c.doc_id
UNION ALL SELECT doc_id, NULL, true, true FROM f WHERE doc_id NOT IN (SELECT doc_id FROM c)""")
def review_queue(s: SparkSession, d: str) -> DataFrame:
    docs = _docs(s, d)
    return evals.review_queue(docs.where("doc_id % 3 = 0"), table(s, d, "content_labels"), docs.where(F.col("text").contains("！")), ["doc_id"])


@query("""WITH f AS (SELECT l_returnflag AS word, l_linestatus AS "case", l_suppkey AS predicate, count(*) AS cnt FROM lineitem GROUP BY ALL), n AS (SELECT word, sum(cnt) AS n FROM f GROUP BY word),
o AS (SELECT 'A' AS word, l."case", l.predicate, ln((l.cnt + 0.5) / (n.n + 1)::DOUBLE) AS l FROM f l JOIN n USING (word) WHERE word IN ('N', 'R') AND cnt >= 3)
SELECT o.word, o."case", o.predicate, round(max(l - ln((coalesce(f.cnt, 0) + 0.5) / ((SELECT n FROM n WHERE word = 'A') + 1)::DOUBLE)), 6) AS ratio
FROM o LEFT JOIN f ON f.word = o.word AND f."case" = o."case" AND f.predicate = o.predicate GROUP BY ALL""")
def loan_ratios(s: SparkSession, d: str) -> DataFrame:
    f = _frames(s, d)[0].groupBy("word", "case", "predicate").agg(F.count(F.lit(1)).alias("cnt"))
    return features.loan_ratio(f, s.createDataFrame([("A", "N"), ("A", "R")], "word string, loanword string"))
