"""Functions on words and glosses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def script(word: Column) -> Column:
    """latin, katakana, hiragana, kanji or mixed."""
    return F.when(word.rlike("^[A-Za-z0-9 ]+$"), "latin").when(word.rlike("^[ァ-ヶー・]+$"), "katakana").when(word.rlike("^[ぁ-ん]+$"), "hiragana").when(
        word.rlike("^[一-龥々]+$"), "kanji").otherwise("mixed")


def same_class(a: Column, b: Column) -> Column:
    """Whether two characters are of one script, so that a word cannot end between them."""
    kind = lambda c: F.when(c.rlike("[A-Za-z0-9]"), 1).when(c.rlike("[ァ-ヶー]"), 2).when(c.rlike("[一-龥々]"), 3)
    return F.coalesce(kind(a) == kind(b), F.lit(False))


def gloss_core(gloss: Column) -> Column:
    """The gloss without bracketed notes in lower case, if what is left is words of letters; else null."""
    x = F.trim(F.lower(F.regexp_replace(gloss, r"\([^()]*\)", "")))
    return F.when(x.rlike(r"^[a-z][a-z' -]*[a-z]$"), x)


def long_vowel_variants(word: Column) -> Column:
    """The word and its form with or without a final long-vowel mark."""
    return F.array(word, F.when(word.endswith("ー"), F.regexp_replace(word, "ー$", "")).otherwise(F.concat(word, F.lit("ー"))))


def class_top(code: Column) -> Column:
    """Division of a class code (1.4); - of anything else."""
    return F.when(code.rlike(r"^\d\.\d"), F.substring(code, 1, 3)).otherwise("-")


def class_mid(code: Column) -> Column:
    """Middle item of a class code (1.45); anything else as it is, - of null."""
    return F.coalesce(F.when(code.rlike(r"^\d\.\d\d"), F.substring(code, 1, 4)).otherwise(code), F.lit("-"))


def class_top_or_value(code: Column) -> Column:
    """Division of a class code; anything else as it is."""
    return F.when(code.rlike(r"^\d\.\d"), F.substring(code, 1, 3)).otherwise(code)


def tag_names(tags: Column) -> Column:
    """Names of a field like `0:comp;math,1:food`: all of them, in order."""
    items = F.split(tags, ",")
    return F.flatten(F.transform(items, lambda x: F.split(F.regexp_replace(x, r"^\d+:", ""), ";")))


def fragment_form(text: Column) -> Column:
    """Text without blanks, quotation marks and ellipses, for matching fragments."""
    return F.regexp_replace(text, r"[\s　「」『』\"“”…・【】]", "")
