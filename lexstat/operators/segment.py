"""From text to chunks, spans of compound-forming morphemes, and the keys counted of a span.

Everything is an expression over one row's arrays: no shuffle happens before the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from ..morph import regex_morphemes

#: Chunk limit in bytes, longest span counted whole, the noun that stands for removed code.
CHUNK_BYTES = 8192
LONGEST = 5
PLACEHOLDER = "ZZCODEZZ"


def chunks(text: Column) -> Column:
    """Sentence chunks: split after line feeds and 。; a chunk over 8192 bytes is split after 、, then cut to size.

    Their concatenation is the text. Cutting to size takes 2730 code points, which never exceed 8192 bytes in
    scripts of up to three bytes a character and 2048 for wider ones.
    """
    first = F.regexp_extract_all(text, F.lit("[^。\n]*[。\n]|[^。\n]+"), F.lit(0))
    big = lambda x: F.octet_length(x) > CHUNK_BYTES
    second = F.flatten(F.transform(first, lambda x: F.when(big(x), F.regexp_extract_all(x, F.lit("[^、]*、|[^、]+"), F.lit(0))).otherwise(F.array(x))))
    return F.flatten(F.transform(second, lambda x: F.when(big(x), F.regexp_extract_all(x, F.lit("(?s).{1,2048}"), F.lit(0))).otherwise(F.array(x))))


def rows_of(df: DataFrame, keep: list[str], items: Column, name: str) -> DataFrame:
    """keep, name: one row per non-null item of an array; none for null and empty arrays.

    An inner explode makes the optimizer repeat the array's expression in a filter before it; an outer one does not.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def with_morphemes(docs: DataFrame, keep: list[str], text: str = "text", provider=regex_morphemes) -> DataFrame:
    """keep, chunk_no, chunk, morphemes: one row per chunk of every text; null and empty texts have none."""
    d = docs.select(*keep, F.posexplode_outer(chunks(F.col(text))).alias("chunk_no", "chunk")).where("chunk is not null")
    return d.select(*keep, "chunk_no", "chunk", provider(F.col("chunk")).alias("morphemes"))


def is_compound_part(m: Column) -> Column:
    """Common and proper nouns, prefixes and suffixes form compounds."""
    return ((m["pos0"] == "名詞") & m["pos1"].isin("普通名詞", "固有名詞")) | m["pos0"].isin("接頭辞", "接尾辞")


def is_latin(s: Column) -> Column:
    return s.rlike("^[A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*$")


def is_katakana(s: Column) -> Column:
    return s.rlike("^[ァ-ヶー・]+$")


def is_unknown_run(m: Column) -> Column:
    """A word no dictionary knows that is all Latin (with a letter) or all katakana."""
    return ~m["known"] & (is_latin(m["surface"]) | is_katakana(m["surface"]))


def is_counted_noun(m: Column) -> Column:
    """Nouns other than numerals, and adjectival nouns; never the code placeholder."""
    noun = ((m["pos0"] == "名詞") & (m["pos1"] != "数詞")) | (m["pos0"] == "形状詞")
    return noun & ~m["surface"].contains(PLACEHOLDER)


def is_content_word(m: Column) -> Column:
    return ((m["pos0"] == "名詞") & (m["pos1"] != "数詞")) | (m["pos0"].isin("形状詞", "動詞", "形容詞") & (m["pos1"] != "非自立可能"))


def _latin_noun(m: Column) -> Column:
    return (m["pos0"] == "名詞") & m["surface"].rlike("^(?=.*[A-Z0-9])[A-Za-z][A-Za-z0-9]*$")


def _kanji_noun(m: Column) -> Column:
    return (m["pos0"] == "名詞") & m["surface"].rlike("[一-鿿々]")


def spans(df: DataFrame, bridge: bool = True) -> DataFrame:
    """The rows of df (with a column morphemes) once per span: a maximal run of compound-forming morphemes that touch.

    With bridge, one plain space between a kanji noun and a Latin noun with a capital or digit does not part them. The
    steps are columns of their own, as an expression inside a lambda is evaluated anew for every element.
    """
    at = lambda k: F.element_at("_parts", k)
    a, b = (lambda k: at(k - 1)), at
    parted = lambda k: a(k)["end"] != b(k)["start"]
    if bridge:
        gap = lambda k: (a(k)["end"] + 1 == b(k)["start"]) & F.array_contains("_spaces", a(k)["end"])
        kind = lambda k: (_kanji_noun(a(k)) & _latin_noun(b(k))) | (_latin_noun(a(k)) & _kanji_noun(b(k)))
        cut = lambda k: parted(k) & ~(gap(k) & kind(k))
    else:
        cut = parted
    keep = [c for c in df.columns if c != "morphemes"]
    spaces = [F.transform(F.filter("morphemes", lambda m: m["surface"] == " "), lambda m: m["start"]).alias("_spaces")] if bridge else []
    d = df.select(*keep, F.filter("morphemes", is_compound_part).alias("_parts"), *spaces)
    first = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_parts"), F.lit(1))), lambda k: F.when(k == 1, F.size("_parts") > 0).otherwise(cut(k)))
    d = d.select(*keep, "_parts", first.alias("_starts"))
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))), F.array(F.size("_parts") + 1))
    d = rows_of(d, [*keep, "_parts"], F.when(F.size("_starts") > 0, F.zip_with("_starts", ends, lambda i, j: F.struct(i.alias("i"), (j - i).alias("n")))), "_s")
    return d.select(*keep, F.slice("_parts", F.col("_s.i"), F.col("_s.n")).alias("span"))


def _joined(ms: Column, part: str) -> Column:
    return F.array_join(F.transform(ms, lambda m: m[part]), "")


def _whole_and_pairs(span: Column, unknown: bool) -> Column:
    """The span itself if it has 2 to 5 morphemes, its adjacent pairs if it has 3 or more; an unknown word alone if wanted."""
    n = F.size(span)
    both = lambda ms: F.array(_joined(ms, "surface"), _joined(ms, "norm"))
    none = F.array().cast("array<string>")
    whole = F.when(n.between(2, LONGEST), both(span)).otherwise(none)
    pairs = F.when(n >= 3, F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: both(F.slice(span, i, 2))))).otherwise(none)
    out = F.concat(whole, pairs)
    if unknown:
        out = F.concat(out, F.when((n == 1) & is_unknown_run(F.element_at(span, 1)), both(span)).otherwise(none))
    return out


def span_keys(span: Column, unknown: bool = False) -> Column:
    """The distinct keys counted of a span, surface and norm, also those of its parts between Latin nouns."""
    latin = F.exists(span, lambda m: m["surface"].rlike("^[A-Za-z]+$"))
    i = F.filter(F.sequence(F.lit(1), F.size(span)), lambda k: F.element_at(span, k)["surface"].rlike("^[A-Za-z]+$"))
    edges = F.concat(F.array(F.lit(0)), i, F.array(F.size(span) + 1))
    parts = F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda a, b: F.slice(span, a + 1, F.greatest(b - a - 1, F.lit(0))))
    inner = F.flatten(F.transform(F.filter(parts, lambda p: F.size(p) > 0), lambda p: _whole_and_pairs(p, unknown)))
    return F.array_distinct(F.concat(_whole_and_pairs(span, unknown), F.when(latin, inner).otherwise(F.array().cast("array<string>"))))


_SPAN = "[A-Za-zァ-ヶー一-龥々]+"
_PART = "[A-Za-z]+|[ァ-ヶー]+|[一-龥々]{1,2}"
_BRIDGE = r" (?=[一-龥々])(?<=[A-Z][A-Za-z]{0,40} )| (?=[a-z]*[A-Z])(?<=[一-龥々] )"


def span_surfaces(text: Column, bridge: bool = True) -> Column:
    """Spans of a whole text as arrays of surfaces: what spans() gives of regex_morphemes(), found by pattern alone.

    Chunks play no part, as their edges lie outside spans, unless a chunk had to be cut to size inside one.
    """
    pattern = f"{_SPAN}(?:(?:{_BRIDGE}){_SPAN})*" if bridge else _SPAN
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda s: F.regexp_extract_all(s, F.lit(_PART), F.lit(0)))


def surface_keys(surfaces: Column) -> Column:
    """span_keys() of a span given by its surfaces, whose norms are their lower case."""
    none = F.array().cast("array<string>")

    def keys(a: Column) -> Column:
        n = F.size(a)
        whole = F.when(n.between(2, LONGEST), F.array(F.array_join(a, ""))).otherwise(none)
        pairs = F.when(n >= 3, F.zip_with(F.slice(a, 1, F.greatest(n - 1, F.lit(0))), F.slice(a, 2, F.greatest(n - 1, F.lit(0))), lambda x, y: F.concat(x, y))).otherwise(none)
        return F.concat(whole, pairs)

    latin = lambda x: x.rlike("^[A-Za-z]")

    def parts(edges: Column) -> Column:
        return F.flatten(F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda a, b: keys(F.slice(surfaces, a + 1, F.greatest(b - a - 1, F.lit(0))))))

    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size(surfaces), F.lit(1))), lambda k: latin(F.try_element_at(surfaces, k)))
    inner = let(F.concat(F.array(F.lit(0)), at, F.array(F.size(surfaces) + 1)), parts)
    surface = F.concat(keys(surfaces), F.when((F.size(surfaces) > 2) & F.exists(surfaces, latin), inner).otherwise(none))
    return let(surface, lambda s: F.array_distinct(F.concat(s, F.transform(s, F.lower))))


def is_whole_span(morphemes: Column, unknown: bool = False) -> Column:
    """Whether a word is one compound of 2 to 5 touching morphemes (or a single unknown word, if wanted)."""
    n = F.size(morphemes)
    touch = F.forall(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: (n < 2) | (F.element_at(morphemes, i)["end"] == F.try_element_at(morphemes, i + 1)["start"]))
    whole = n.between(2, LONGEST) & F.forall(morphemes, is_compound_part) & touch
    return (whole | ((n == 1) & is_unknown_run(F.try_element_at(morphemes, F.lit(1))))) if unknown else whole


def is_registrable(morphemes: Column) -> Column:
    """A title that may be registered: one unknown word, or one span of two or more morphemes without a proper noun."""
    n = F.size(morphemes)
    one = (n == 1) & is_unknown_run(F.try_element_at(morphemes, F.lit(1)))
    touch = F.forall(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: (n < 2) | (F.element_at(morphemes, i)["end"] == F.try_element_at(morphemes, i + 1)["start"]))
    many = (n >= 2) & F.forall(morphemes, lambda m: is_compound_part(m) & (m["pos1"] != "固有名詞")) & touch
    return one | many


def excerpt(text: Column, at: Column, length: Column, around: int = 30) -> Column:
    """`around` code points to either side of a place (0-based) of the given length, clipped at the text's ends."""
    begin = F.greatest(at - around, F.lit(0))
    return F.substring(text, begin + 1, at + length + around - begin)
