"""The regex provider (pure columns) and the dictionary provider (longest match, Arrow batches)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let

MORPHEMES = "array<struct<surface:string,norm:string,pos0:string,pos1:string,start:int,end:int,known:boolean>>"

#: The classes of characters that the regex provider tells apart, in this order.
TOKEN = r"[A-Za-z]+|[0-9]+|[ァ-ヶー]+|[一-龥々]{1,2}|[ぁ-ん]+|[ \t　]+|(?s:.)"
#: Part of speech by the first character's class.
_POS = (
    (r"^[A-Za-zァ-ヶー一-龥々]", "名詞", "普通名詞"),
    (r"^[0-9]", "名詞", "数詞"),
    (r"^[ぁ-ん]", "助詞", "一般"),
    (r"^[ \t　]", "空白", "空白"),
)


def _class(first: Column) -> Column:
    """Class of a code point, as the TOKEN pattern parts them: foreign, digit, kanji, hiragana, space or sign."""
    foreign = first.between(65, 90) | first.between(97, 122) | first.between(0x30A1, 0x30F6) | (first == 0x30FC)
    return (
        F.when(foreign, "foreign").when(first.between(0x4E00, 0x9FA5) | (first == 0x3005), "kanji").when(first.between(0x3041, 0x3093), "hiragana")
        .when(first.between(48, 57), "digit").when(first.isin(32, 9, 0x3000), "space").otherwise("sign"))


def regex_morphemes(text: Column) -> Column:
    """Morphemes of a text by character class: kanji runs are cut into twos, everything else is a run of one class.

    Null gives null, an empty text an empty array.
    """
    def ends(tokens: Column) -> Column:
        return F.aggregate(
            tokens, F.array().cast("array<int>"),
            lambda acc, t: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(t))))

    def morpheme(x: Column) -> Column:
        c = x["c"]
        noun = c.isin("foreign", "kanji", "digit")
        pos0 = F.when(noun, "名詞").when(c == "hiragana", "助詞").when(c == "space", "空白").otherwise("補助記号")
        pos1 = F.when(c == "digit", "数詞").when(noun, "普通名詞").when(c == "space", "空白").otherwise("一般")
        return F.struct(x["t"].alias("surface"), F.lower(x["t"]).alias("norm"), pos0.alias("pos0"), pos1.alias("pos1"),
                        (x["e"] - F.length(x["t"])).alias("start"), x["e"].alias("end"), (c != "foreign").alias("known"))

    def segmented(tokens: Column) -> Column:
        return F.transform(F.zip_with(tokens, ends(tokens), lambda t, e: F.struct(t.alias("t"), e.alias("e"), _class(F.ascii(t)).alias("c"))), morpheme)

    return let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), segmented)


def dictionary_morphemes(df: DataFrame, words: dict[str, tuple[str, str, str]], text: str = "text", out: str = "morphemes") -> DataFrame:
    """Longest-match segmentation by a dictionary surface -> (norm, pos0, pos1); what it lacks is cut by character class.

    The dictionary is shipped to every task, so it must be small enough for that; runs in Arrow batches.
    """
    longest = max(map(len, words), default=1)
    plain = re.compile(TOKEN)

    def one(s: str) -> list[tuple]:
        at, found = 0, []
        while at < len(s):
            for n in range(min(longest, len(s) - at), 0, -1):
                if (w := words.get(s[at : at + n])) is not None:
                    found.append((s[at : at + n], w[0], w[1], w[2], at, at + n, True))
                    at += n
                    break
            else:
                t = plain.match(s, at)[0]
                p = next(((a, b) for x, a, b in _POS if re.match(x, t)), ("補助記号", "一般"))
                found.append((t, t.lower(), *p, at, at + len(t), False))
                at += len(t)
        return found

    names = ["surface", "norm", "pos0", "pos1", "start", "end", "known"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[out] = [None if s is None else [dict(zip(names, m)) for m in one(s)] for s in pdf[text]]
            yield pdf

    return df.mapInPandas(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, `{out}` {MORPHEMES}")


Provider = Callable[[Column], Column]
