"""Dictionary work: segmentation of texts by a word list, contexts and sentences around hits, glosses and senses,
matching of hand-written answers to queue rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.words import fragment_form, long_vowel_variants

_KANA = re.compile("[ァ-ヶー]")
_KANJI = re.compile("[一-龥々]")
_MASK = re.compile(r"`[^`\n]*`|\[[^\]\n]*\]\([^)\n]*\)|https?://\S+")


def _script(c: str) -> int:
    return 1 if c.isascii() and c.isalnum() else 2 if _KANA.match(c) else 3 if _KANJI.match(c) else 0


def match_words(text: str, words: frozenset[str] | set[str], longest: int) -> list[tuple[int, str]]:
    """Greedy longest matches whose edges part scripts: a hit next to a character of the script of its own edge is none.
    Code, links and addresses are passed over."""
    text = _MASK.sub(lambda m: "\0" * len(m[0]), text)
    out, at = [], 0
    while at < len(text):
        for n in range(min(longest, len(text) - at), 0, -1):
            w = text[at : at + n]
            if w in words:
                left = at and _script(text[at - 1]) and _script(text[at - 1]) == _script(w[0])
                right = at + n < len(text) and _script(text[at + n]) and _script(text[at + n]) == _script(w[-1])
                if not left and not right:
                    out.append((at, w))
                    at += n
                    break
        else:
            at += 1
    return out


def dictionary_hits(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", max_words: int = 1_000_000) -> DataFrame:
    """id, start, word of greedy longest matches of a word list in every text; null texts have none.

    The list is collected and shipped to the tasks, so more than max_words is an error.
    """
    got = [r[0] for r in words.where("word is not null and word <> ''").select("word").distinct().limit(max_words + 1).collect()]
    if len(got) > max_words:
        raise ValueError(f"more than {max_words} words")
    known, longest = frozenset(got), max(map(len, got), default=0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, s, w) for i, t in zip(pdf[id_col], pdf["text"]) if t for s, w in match_words(t, known, longest)]
            yield pd.DataFrame(rows, columns=[id_col, "start", "word"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.where("text is not null").select(id_col, "text").mapInPandas(run, f"`{id_col}` {kind}, start int, word string")


def first_contexts(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", around: int = 40) -> DataFrame:
    """word, context of each word's first occurrence (smallest id, then place) that stands alone, `around` characters to either side."""
    hits = dictionary_hits(docs, words, id_col)
    first = hits.groupBy("word").agg(F.min(F.struct(id_col, "start")).alias("f"))
    j = first.select("word", F.col(f"f.{id_col}").alias(id_col), "f.start").join(docs.select(id_col, "text"), id_col)
    begin = F.greatest(F.col("start") - around, F.lit(0))
    return j.select("word", F.substring("text", begin + 1, F.col("start") + F.length("word") + around - begin).alias("context"))


def marked_sentences(hits: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, word, sentence: the sentence of each hit (up to 。 or a line feed) with the word in 【】."""
    j = hits.join(docs.select(id_col, "text"), id_col)
    before = F.regexp_extract(F.substring("text", F.lit(1), F.col("start")), "([^。\n]*)$", 1)
    after = F.regexp_extract(F.substring("text", F.col("start") + F.length("word") + 1, F.length("text")), "^([^。\n]*。?)", 1)
    return j.select(id_col, "start", "word", F.trim(F.concat(before, F.lit("【"), "word", F.lit("】"), after)).alias("sentence"))


def by_variant(words: DataFrame, index: DataFrame) -> DataFrame:
    """word and the index columns of its first variant, with or without a final long-vowel mark, that the index (key, ...) has."""
    v = words.select("word").distinct().select("word", F.posexplode(long_vowel_variants(F.col("word"))).alias("o", "key"))
    j = v.join(index, "key")
    best = j.groupBy("word").agg(F.min("o").alias("o"))
    return j.join(best, ["word", "o"]).drop("o", "key")


def senses_of(entries: DataFrame, key: str = "rebs") -> DataFrame:
    """key, sense_no, glosses, computing of every spelling or reading; senses with the same glosses count once, in order.

    entries: entry_id and the columns of readers.jmdict().
    """
    d = entries.select("entry_id", F.explode(key).alias("key"), F.posexplode("senses").alias("i", "s")).select(
        "key", "entry_id", "i", F.array_distinct("s.glosses").alias("glosses"), F.exists("s.fields", lambda x: x.contains("comp")).alias("computing"))
    once = d.withColumn("_n", F.row_number().over(Window.partitionBy("key", "glosses").orderBy("entry_id", "i"))).where("_n = 1")
    no = F.row_number().over(Window.partitionBy("key").orderBy("entry_id", "i"))
    return once.select("key", no.alias("sense_no"), "glosses", "computing")


def lexical_divisions(glosses: DataFrame, lemmas: DataFrame, offsets: DataFrame, base: DataFrame, overrides: DataFrame) -> DataFrame:
    """word, divisions: through the gloss's lemma, its offsets and their lexicographer file to divisions.

    glosses: word, lemma; lemmas: lemma, offset; offsets: offset, lexname; base and overrides: lexname, division, the
    latter stronger.
    """
    dim = base.select("lexname", F.col("division").alias("b")).join(overrides.select("lexname", F.col("division").alias("o")), "lexname", "full").select(
        "lexname", F.coalesce("o", "b").alias("division"))
    j = glosses.join(lemmas, "lemma").join(offsets, "offset").join(dim, "lexname")
    return j.groupBy("word").agg(F.array_sort(F.collect_set("division")).alias("divisions"))


def match_answers(answers: DataFrame, queue: DataFrame) -> DataFrame:
    """answer_id, row_id: hand-written answers (answer_id, word, fragment) put to queue rows (row_id, word, sentence).

    First the rows of the word whose sentence holds the fragment, if that is one row and no other answer claims it; then,
    of what is left, the word's single row with its single answer. The rest stays unmatched.
    """
    a = answers.select("answer_id", "word", fragment_form(F.col("fragment")).alias("f"))
    q = queue.select("row_id", "word", fragment_form(F.col("sentence")).alias("s"))
    hit = a.join(q, "word").where((F.col("f") != "") & F.col("s").contains(F.col("f")))
    one = lambda d: d.withColumns({"_a": F.count(F.lit(1)).over(Window.partitionBy("answer_id")), "_r": F.count(F.lit(1)).over(Window.partitionBy("row_id"))}).where(
        "_a = 1 and _r = 1").select("answer_id", "row_id")
    first = one(hit)
    rest = a.join(first, "answer_id", "left_anti").join(q.join(first, "row_id", "left_anti"), "word")
    return first.unionByName(one(rest))


def strip_templates(c: Column) -> Column:
    """Text without bracketed notes and outer blanks."""
    return F.trim(F.regexp_replace(c, r"[(（][^()（）]*[)）]", ""))
