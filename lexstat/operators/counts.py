"""Counting: compounds, components, nouns, co-occurrence within a window, case frames, occurrences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..morph import regex_morphemes
from ..morph.providers import TOKEN
from .segment import PLACEHOLDER, chunks, excerpt, is_content_word, is_counted_noun, rows_of, span_keys, span_surfaces, spans, surface_keys, with_morphemes


def span_rows(docs: DataFrame, keep: list[str], bridge: bool = True, **kw) -> DataFrame:
    """keep, chunk_no, span: one row per span of compound-forming morphemes."""
    return spans(with_morphemes(docs, keep, **kw).select(*keep, "chunk_no", "morphemes"), bridge)


def surface_rows(docs: DataFrame, keep: list[str], bridge: bool = True, text: str = "text", provider=regex_morphemes) -> DataFrame:
    """keep, surfaces: one row per span."""
    if provider is regex_morphemes:
        return rows_of(docs, keep, span_surfaces(F.col(text), bridge), "surfaces")
    return span_rows(docs, keep, bridge, text=text, provider=provider).select(*keep, F.transform("span", lambda m: m["surface"]).alias("surfaces"))


def compound_rows(docs: DataFrame, keep: list[str], unknown: bool = False, bridge: bool = True, text: str = "text", provider=regex_morphemes) -> DataFrame:
    """keep, key: one row per span and distinct key of it."""
    if provider is regex_morphemes and not unknown:
        spans_ = surface_rows(docs, keep, bridge, text).where(F.size("surfaces") >= 2)  # one morpheme alone is no compound
        return rows_of(spans_, keep, surface_keys(F.col("surfaces")), "key")
    return rows_of(span_rows(docs, keep, bridge, text=text, provider=provider), keep, span_keys(F.col("span"), unknown), "key")


def compound_counts(docs: DataFrame, by_document: bool = False, unknown: bool = False, id_col: str = "doc_id", **kw) -> DataFrame:
    """key, cnt: how often each compound key occurs, or in how many documents.

    Null and empty texts count nothing; documents with a null id count as one. Ordered by nothing. Occurrences are
    counted by distinct span first and then spread over the keys of each.
    """
    if not by_document and not unknown and kw.get("provider", regex_morphemes) is regex_morphemes:
        per = surface_rows(docs, [], **kw).where(F.size("surfaces") >= 2).groupBy("surfaces").agg(F.count(F.lit(1)).alias("_n"))
        return rows_of(per, ["_n"], surface_keys(F.col("surfaces")), "key").groupBy("key").agg(F.sum("_n").alias("cnt"))
    rows = compound_rows(docs, [id_col], unknown, **kw)
    return (rows.distinct() if by_document else rows).groupBy("key").agg(F.count(F.lit(1)).alias("cnt"))


def component_counts(docs: DataFrame, by_document: bool = False, id_col: str = "doc_id", **kw) -> DataFrame:
    """part, cnt: surfaces of every morpheme in spans of two or more."""
    rows = rows_of(surface_rows(docs, [id_col], **kw), [id_col], F.when(F.size("surfaces") >= 2, F.col("surfaces")), "part")
    return (rows.distinct() if by_document else rows).groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))


_NOUN = "^[A-Za-zァ-ヶー一-龥々]"
_RUN = "[A-Za-z0-9ァ-ヶー一-龥々]+(?:[ \t　]+[A-Za-z0-9ァ-ヶー一-龥々]+)*"


def noun_rows(docs: DataFrame, keep: list[str], text: str = "text", provider=regex_morphemes) -> DataFrame:
    """keep, word, alone: every counted noun; alone if no noun, adjectival noun or affix stands next to it (spaces passed over).

    Of the character-class provider, whose nouns and numerals are runs of their classes, the same is found by pattern.
    """
    if provider is regex_morphemes:
        runs = rows_of(docs, keep, F.regexp_extract_all(F.col(text), F.lit(_RUN), F.lit(0)), "_run")
        parts = runs.select(*keep, F.regexp_extract_all("_run", F.lit("[A-Za-z]+|[0-9]+|[ァ-ヶー]+|[一-龥々]{1,2}"), F.lit(0)).alias("_parts"))
        words = parts.select(*keep, (F.size("_parts") == 1).alias("alone"), F.explode_outer("_parts").alias("_w"))
        words = words.where(F.col("_w").rlike(_NOUN) & ~F.col("_w").contains(PLACEHOLDER))
        return words.select(*keep, F.lower("_w").alias("word"), "alone")
    m = with_morphemes(docs, keep, text=text, provider=provider).select(*keep, F.filter("morphemes", lambda m: m["pos0"] != "空白").alias("_solid"))
    ms = F.col("_solid")
    joins = lambda x, affix: F.coalesce(x["pos0"].isin("名詞", "形状詞", affix), F.lit(False))
    before = lambda i: (i > 1) & joins(F.try_element_at(ms, F.when(i > 1, i - 1).otherwise(1)), "接頭辞")
    items = F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(ms), F.lit(1))), lambda i: F.coalesce(is_counted_noun(F.try_element_at(ms, i)), F.lit(False))),
        lambda i: F.struct(F.element_at(ms, i)["norm"].alias("word"), (~before(i) & ~joins(F.try_element_at(ms, i + 1), "接尾辞")).alias("alone")))
    return rows_of(m, keep, items, "n").select(*keep, "n.word", "n.alone")


def noun_counts(docs: DataFrame, **kw) -> DataFrame:
    """word, total, alone of every counted noun."""
    return noun_rows(docs, [], **kw).groupBy("word").agg(F.count(F.lit(1)).alias("total"), F.count_if("alone").alias("alone"))


def window_contexts(docs: DataFrame, targets: DataFrame, keep: list[str], around: int = 5, text: str = "text", provider=regex_morphemes) -> DataFrame:
    """keep, word, context: content words within `around` morphemes of a target noun, in the same chunk, the target itself left out.

    targets: word; their number is checked by the planner, which broadcasts only small ones. The windows are cut first and
    looked into only where the noun is a target.
    """
    if provider is regex_morphemes:
        c = docs.select(*keep, F.explode_outer(chunks(F.col(text))).alias("_c")).where("_c is not null")
        m = c.select(*keep, F.regexp_extract_all("_c", F.lit(TOKEN), F.lit(0)).alias("_m"))
        noun = lambda x: x.rlike(_NOUN) & ~x.contains(PLACEHOLDER)
        content, norm = (lambda x: x.rlike(_NOUN)), F.lower
    else:
        m = with_morphemes(docs, keep, text=text, provider=provider).select(*keep, F.col("morphemes").alias("_m"))
        noun, content, norm = is_counted_noun, is_content_word, lambda x: x["norm"]
    ms = F.col("_m")
    i = F.filter(F.sequence(F.lit(1), F.greatest(F.size(ms), F.lit(1))), lambda k: F.coalesce(noun(F.try_element_at(ms, k)), F.lit(False)))
    windows = F.transform(i, lambda k: F.struct(
        norm(F.element_at(ms, k)).alias("word"), F.slice(ms, F.greatest(k - around, F.lit(1)), F.least(k - 1, F.lit(around))).alias("before"), F.slice(ms, k + 1, F.lit(around)).alias("after")))
    hits = rows_of(m, keep, windows, "n").select(*keep, "n.word", "n.before", "n.after").join(targets.select("word").distinct(), "word", "left_semi")
    ctx = F.transform(F.filter(F.concat("before", "after"), content), norm)
    return rows_of(hits, [*keep, "word"], ctx, "context").where("context <> word")


def cooccurrence(docs: DataFrame, targets: DataFrame, around: int = 5, **kw) -> DataFrame:
    """word, context, cnt of target nouns and the content words around them."""
    return window_contexts(docs, targets, [], around, **kw).groupBy("word", "context").agg(F.count(F.lit(1)).alias("cnt"))


def occurrences(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", around: int = 30, **kw) -> DataFrame:
    """id, chunk_no, start, word, excerpt of every occurrence of a target noun."""
    m = with_morphemes(docs, [id_col], **kw)
    rows = rows_of(m, [id_col, "chunk_no", "chunk"], F.filter("morphemes", is_counted_noun), "m")
    hits = rows.select(id_col, "chunk_no", "chunk", F.col("m.start").alias("start"), F.col("m.norm").alias("word"), F.length("m.surface").alias("_n")).join(
        targets.select("word").distinct(), "word", "left_semi")
    return hits.select(id_col, "chunk_no", "start", "word", excerpt(F.col("chunk"), F.col("start"), F.col("_n"), around).alias("excerpt"))


def case_frames(frames: DataFrame) -> DataFrame:
    """word, case, predicate, cnt, and the marginals over each of them: null stands for a column summed over.

    frames: one row per dependency (word, case, predicate); rows with a null in any are left out. level: how many of the
    three columns are kept, as bits.
    """
    d = frames.where("word is not null and `case` is not null and predicate is not null")
    return d.groupingSets(
        [[F.col("word"), F.col("case"), F.col("predicate")], [F.col("word"), F.col("case")], [F.col("case"), F.col("predicate")], [F.col("word")], [F.col("case")]],
        F.col("word"), F.col("case"), F.col("predicate"),
    ).agg(F.count(F.lit(1)).alias("cnt"), F.grouping_id().alias("level"))


def source_sizes(docs: DataFrame) -> DataFrame:
    """source, documents, text_bytes; a null source is a source of its own, null texts have no bytes."""
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("text_bytes"))


#: Kinds of a noun's modifier.
MODIFIER_KINDS = ("の", "連体", "連用", "その他", "なし")


def frame_tables(frames: DataFrame, targets: DataFrame) -> DataFrame:
    """word, case, predicate, cnt: dependencies of target nouns that stand alone; with null case and predicate the word's
    total; with a null word as well, the number of occurrences that are part of a compound (joined).

    frames: word, case, predicate, standalone; targets: word. Rows with a null in any column are left out.
    """
    d = frames.where("word is not null and `case` is not null and predicate is not null and standalone is not null").join(targets.select("word").distinct(), "word", "left_semi")
    alone = d.where("standalone").groupingSets([[F.col("word"), F.col("case"), F.col("predicate")], [F.col("word")]], F.col("word"), F.col("case"), F.col("predicate")).agg(F.count(F.lit(1)).alias("cnt"))
    joined = d.where("not standalone").agg(F.count(F.lit(1)).alias("cnt")).select(*[F.lit(None).cast(alone.schema[c].dataType).alias(c) for c in ("word", "case", "predicate")], "cnt")
    return alone.select("word", "case", "predicate", "cnt").unionByName(joined)


def modifier_counts(modifiers: DataFrame, targets: DataFrame) -> DataFrame:
    """word, kind, modifier, cnt of target nouns that stand alone; kinds outside MODIFIER_KINDS count as その他.

    modifiers: word, kind, modifier, standalone; a noun without one has kind なし and an empty modifier.
    """
    d = modifiers.where("word is not null and standalone").join(targets.select("word").distinct(), "word", "left_semi")
    kind = F.when(F.col("kind").isin(*MODIFIER_KINDS), F.col("kind")).when(F.col("kind").isNull(), "なし").otherwise("その他")
    return d.groupBy("word", kind.alias("kind"), F.coalesce("modifier", F.lit("")).alias("modifier")).agg(F.count(F.lit(1)).alias("cnt"))


def marginals(table: DataFrame, keys: list[str], sets: list[list[str]], value: str = "cnt") -> DataFrame:
    """keys, cnt: sums of a table over each of the sets of keys, null for a key summed over. Rows with a null key are left out."""
    d = table.where(" and ".join(f"`{k}` is not null" for k in keys))
    return d.groupingSets([[F.col(k) for k in x] for x in sets], *map(F.col, keys)).agg(F.sum(value).alias("cnt"), F.grouping_id().alias("level"))


def noun_totals(nouns: DataFrame) -> DataFrame:
    """tokens, distinct of a noun table (word, total)."""
    return nouns.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("distinct"))


def target_counts(docs: DataFrame, targets: DataFrame, **kw) -> DataFrame:
    """word, cnt: occurrences of target nouns, with or without a context."""
    return noun_rows(docs, [], **kw).join(targets.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
