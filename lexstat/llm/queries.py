"""Named queries of this subpackage over a folder of tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged, table
from . import abuse, consensus, cooccurrence, heavy_hitters, leakage, markup, mixing, repeated_lines, sentences, term_counts

Query = Callable[[SparkSession, str], DataFrame]
#: Vocabulary file of the tokenizer that p9 counts with.
TOKENIZER = os.environ.get("LEXSTAT_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def p1_found(s: SparkSession, d: str) -> DataFrame:
    return consensus.found(table(s, d, "votes"))


def p1_consensus(s: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(table(s, d, "votes"))


def p1_reliability(s: SparkSession, d: str) -> DataFrame:
    return consensus.reliability(table(s, d, "votes"))


def p1_agreement(s: SparkSession, d: str) -> DataFrame:
    return consensus.agreement(table(s, d, "votes"))


def p2_found(s: SparkSession, d: str) -> DataFrame:
    return p2_frequencies(s, d).where("verdict <> 'useful'").select("kind", "term", "verdict")


def p2_frequencies(s: SparkSession, d: str) -> DataFrame:
    return term_counts.term_frequencies(table(s, d, "term_counts"))


def p3_found(s: SparkSession, d: str) -> DataFrame:
    return heavy_hitters.heavy_terms(table(s, d, "run_lines")).select("term")


def p3_top100(s: SparkSession, d: str) -> DataFrame:
    return heavy_hitters.top_terms(table(s, d, "run_lines"), 100)


def p4_found(s: SparkSession, d: str) -> DataFrame:
    return markup.elements(table(s, d, "entries"), table(s, d, "sources")).select("entry_id", "element")


def p4_clean(s: SparkSession, d: str) -> DataFrame:
    return markup.cleaned(table(s, d, "entries"), table(s, d, "sources"))


def p5_found(s: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(s, d, "articles")).select("page_id", "line_no")


def p5_clean(s: SparkSession, d: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(table(s, d, "articles"))


def p6_found(s: SparkSession, d: str) -> DataFrame:
    return cooccurrence.linked(cooccurrence.pair_counts(table(s, d, "occurrences"))).select("word_a", "word_b")


def p6_pairs(s: SparkSession, d: str) -> DataFrame:
    p = cooccurrence.pair_counts(table(s, d, "occurrences"))
    return p.select("word_a", "word_b", "n_ab", "n_a", "n_b", "n", F.round("lift", 6).alias("lift"), (F.round("llr", 4) + F.lit(0.0)).alias("llr"))


def p7_found(s: SparkSession, d: str) -> DataFrame:
    t = sentences.unit_texts(table(s, d, "articles"), table(s, d, "occurrences"))
    return sentences.sentences(t, with_text=False).where("sentence_no > 0").select("field", "rec_id", "start_pos")


def p7_sentences(s: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(sentences.unit_texts(table(s, d, "articles"), table(s, d, "occurrences")))


def p8_found(s: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(s, d, "documents"), table(s, d, "eval_items")).select("doc_id", "item_id")


def p8_items(s: SparkSession, d: str) -> DataFrame:
    items = table(s, d, "eval_items")
    return leakage.leaked_items(leakage.leaks(table(s, d, "documents"), items), items)


def p9_mix(s: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(mixing.plan(table(s, d, "documents"), table(s, d, "mix_targets"), TOKENIZER))


def p9_shares(s: SparkSession, d: str) -> DataFrame:
    return mixing.shares(mixing.plan(table(s, d, "documents"), table(s, d, "mix_targets"), TOKENIZER))


def _scored(s: SparkSession, d: str) -> tuple[DataFrame, dict[str, float]]:
    docs = table(s, d, "documents")
    fitted = abuse.fit(docs, table(s, d, "content_labels"))
    scored = staged(abuse.scores(docs, fitted))
    return scored, abuse.cuts(scored, fitted)


def p10_found(s: SparkSession, d: str) -> DataFrame:
    return abuse.found(*_scored(s, d))


def p10_scores(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents")
    return abuse.scores(docs, abuse.fit(docs, table(s, d, "content_labels")))


def p10_rates(s: SparkSession, d: str) -> DataFrame:
    scored, cut = _scored(s, d)
    return abuse.source_rates(scored, table(s, d, "documents"), cut)


def queries() -> dict[str, Query]:
    made = [p1_found, p1_consensus, p1_reliability, p1_agreement, p2_found, p2_frequencies, p3_found, p3_top100, p4_found, p4_clean, p5_found, p5_clean,
            p6_found, p6_pairs, p7_found, p7_sentences, p8_found, p8_items, p9_mix, p9_shares, p10_found, p10_scores, p10_rates]
    return {f.__name__: f for f in made}


#: Records of occurrences with their words, and the counts of pairs, as the co-occurrence operator defines them.
_PAIRS = """
WITH rec AS (
  SELECT occ_id, any_value(word) AS word, any_value(context) AS context FROM occurrences
  WHERE occ_id IS NOT NULL AND word IS NOT NULL AND regexp_matches(word, '[^\\s　]') AND word <> 'ZZCODEZZ' GROUP BY occ_id),
ctx AS (
  SELECT DISTINCT occ_id, word, o FROM (SELECT occ_id, word, unnest(context) AS o FROM rec)
  WHERE o IS NOT NULL AND regexp_matches(o, '[^\\s　]') AND o <> 'ZZCODEZZ' AND o <> word),
pr AS (SELECT least(word, o) AS word_a, greatest(word, o) AS word_b, count(*) AS n_ab FROM ctx GROUP BY 1, 2),
one AS (SELECT w, count(*) AS n_w FROM (SELECT occ_id, word AS w FROM rec UNION ALL SELECT occ_id, o FROM ctx) GROUP BY w),
n AS (SELECT count(*) AS n FROM rec),
p AS (SELECT word_a, word_b, n_ab, a.n_w AS n_a, b.n_w AS n_b, n.n FROM pr JOIN one a ON a.w = word_a JOIN one b ON b.w = word_b, n)
"""

_X = "CASE WHEN {0} > 0 THEN {0} * ln({0}) ELSE 0 END"


def _llr() -> str:
    k11, k12, k21, k22 = "n_ab::DOUBLE", "(n_a - n_ab)::DOUBLE", "(n_b - n_ab)::DOUBLE", "(n - n_a - n_b + n_ab)::DOUBLE"
    plus = [k11, k12, k21, k22, "n::DOUBLE"]
    minus = ["n_a::DOUBLE", "(n - n_a)::DOUBLE", "n_b::DOUBLE", "(n - n_b)::DOUBLE"]
    total = " + ".join(f"({_X.format(x)})" for x in plus) + "".join(f" - ({_X.format(x)})" for x in minus)
    return f"(CASE WHEN n_ab < n_a::DOUBLE * n_b / n THEN -1 ELSE 1 END) * greatest(2 * ({total}), 0)"


def _folded_sql(c: str) -> str:
    """SQL of functions.text.fold for wide and half-width forms, the ones that terms and lines come in.

    Half-width kana with a voicing mark are two characters for one; all other forms are one for one.
    """
    narrow = lambda x: unicodedata.normalize("NFKC", x)
    forms = [x for x in map(chr, [0x3000, *range(0xFF01, 0xFFEF)]) if len(narrow(x)) == 1 and narrow(x) != x]
    for x in map(chr, range(0xFF66, 0xFF9E)):
        for mark in "ﾞﾟ":
            if len(narrow(x + mark)) == 1:
                c = f"replace({c}, '{x}{mark}', '{narrow(x + mark)}')"
    quote = lambda x: x.replace("'", "''")
    blanks = "".join(x for x in map(chr, range(0x3001)) if x.isspace())
    return f"trim(lower(translate({c}, '{quote(''.join(forms))}', '{quote(''.join(map(narrow, forms)))}')), '{blanks}')"


def _frequencies_sql() -> str:
    return f"""
WITH v AS (SELECT record_id, kind, {_folded_sql('term')} AS term, total, alone, loaded_at FROM term_counts
           WHERE total > 0 AND record_id IS NOT NULL AND kind IS NOT NULL AND term IS NOT NULL),
r AS (SELECT * FROM v WHERE term <> ''
      QUALIFY row_number() OVER (PARTITION BY kind, term, record_id ORDER BY loaded_at DESC NULLS LAST, total DESC, alone DESC NULLS LAST) = 1),
t AS (SELECT kind, term, sum(total)::BIGINT AS occurrences, sum(alone)::BIGINT AS alone, count(*) AS records FROM r GROUP BY 1, 2),
n AS (SELECT count(DISTINCT record_id) AS n FROM r)
SELECT kind, term, occurrences, alone, records, records / n::DOUBLE AS share,
       CASE WHEN records > 0.2::DOUBLE * n THEN 'common' WHEN occurrences < 3 THEN 'rare' ELSE 'useful' END AS verdict FROM t, n"""


def _totals_sql() -> str:
    return f"""
WITH l AS (SELECT run_id, line_no, any_value(term) AS term, any_value(cnt) AS cnt FROM run_lines
           WHERE cnt > 0 AND term IS NOT NULL AND run_id IS NOT NULL AND line_no IS NOT NULL GROUP BY run_id, line_no
           UNION ALL SELECT run_id, line_no, term, cnt FROM run_lines WHERE cnt > 0 AND term IS NOT NULL AND (run_id IS NULL OR line_no IS NULL)),
f AS (SELECT {_folded_sql('term')} AS term, cnt FROM l),
t AS (SELECT term, sum(cnt)::BIGINT AS total FROM f WHERE term <> '' GROUP BY term)"""


def _repeated_sql() -> str:
    return f"""
WITH v AS (SELECT page_id, max(struct_pack(a := fetched_at, b := loaded_at, t := text, s := source_name)) AS v FROM articles WHERE page_id IS NOT NULL GROUP BY page_id),
p AS (SELECT page_id, v.s AS source, v.t AS text FROM v WHERE v.s IS NOT NULL AND v.t <> ''),
s AS (SELECT source, count(*) AS pages FROM p GROUP BY source),
l AS (SELECT page_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INT AS line_no FROM p),
k AS (SELECT page_id, source, line_no, regexp_replace({_folded_sql('line')}, '\\P{{L}}', '', 'g') AS letters FROM l),
c AS (SELECT source, letters, count(DISTINCT page_id) AS n FROM k WHERE letters <> '' GROUP BY 1, 2)
SELECT page_id, line_no FROM k JOIN c USING (source, letters) JOIN s USING (source) WHERE n >= 3 AND n >= 0.06::DOUBLE * pages"""


def oracle_sql() -> dict[str, str]:
    top = _totals_sql() + " SELECT term, total, row_number() OVER (ORDER BY total DESC, term)::INT AS rank FROM t QUALIFY rank <= 100"
    return {
        "p2_frequencies": _frequencies_sql(),
        "p2_found": f"SELECT kind, term, verdict FROM ({_frequencies_sql()}) WHERE verdict <> 'useful'",
        "p3_found": _totals_sql() + " SELECT term FROM t WHERE total >= 0.001::DOUBLE * (SELECT sum(total) FROM t)",
        "p3_top100": top,
        "p5_found": _repeated_sql(),
        "p6_found": _PAIRS + "SELECT word_a, word_b FROM p WHERE n_ab >= 5 AND n_ab * 10000 >= n AND n_ab * n >= 10 * n_a * n_b",
        "p6_pairs": _PAIRS + f"SELECT word_a, word_b, n_ab, n_a, n_b, n, round(n_ab / (n_a::DOUBLE * n_b / n), 6) AS lift, round({_llr()}, 4) + 0.0 AS llr FROM p",
        "p1_agreement": """
WITH v AS (SELECT word, lower(trim(model, ' ')) AS model, pass_seed, categories, received_at FROM votes
           WHERE word IS NOT NULL AND model IS NOT NULL AND trim(model, ' ') <> ''),
l AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY word, model, pass_seed ORDER BY received_at DESC, (categories IS NOT NULL) DESC, categories DESC) = 1),
f AS (SELECT word, model, list_distinct(list_filter(categories, lambda c: c BETWEEN 10 AND 19 OR c BETWEEN 20 AND 27 OR c BETWEEN 30 AND 38 OR c BETWEEN 40 AND 47 OR c BETWEEN 50 AND 57)) AS cats
      FROM l WHERE categories IS NOT NULL),
w AS (SELECT word, count(*) AS n, sum(len(cats)) AS given FROM f GROUP BY word HAVING count(*) >= 2),
k AS (SELECT word, c, count(*) AS k FROM (SELECT word, unnest(cats) AS c FROM f) GROUP BY 1, 2),
d AS (SELECT sum(k.k * (w.n - k.k) / (w.n - 1)::DOUBLE) AS d FROM k JOIN w USING (word)),
t AS (SELECT count(*) AS n_words, sum(n) * 43 AS total, sum(given) AS yes FROM w)
SELECT n_words, n_words * 43 AS n_units, total::BIGINT AS n_judgments, round(1 - (total - 1) * d / (yes * (total - yes)::DOUBLE), 9) AS alpha FROM t, d""",
    }
