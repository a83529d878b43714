"""Text normalisation as columns. Work stays in the JVM unless Unicode tables are needed."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that NFKC keeps and that have no upper case: ASCII without capitals, kana, kanji.
_PLAIN = r"^[\x21-\x40\x5b-\x7eぁ-ゔァ-ヺー一-鿿]*$"


def fold(text: str | None) -> str | None:
    """NFKC, lower case, outer blanks trimmed."""
    return None if text is None else unicodedata.normalize("NFKC", text).lower().strip()


@F.pandas_udf(StringType())
def _fold_udf(s: pd.Series) -> pd.Series:
    return s.map(fold, na_action="ignore")


def folded(c: Column) -> Column:
    """fold() of a column; only rows with characters that folding can change reach Python with a value."""
    plain = c.rlike(_PLAIN)
    return F.when(plain, c).otherwise(_fold_udf(F.when(~plain, c)))


def blank(c: Column) -> Column:
    """True for null and for nothing but Unicode white space."""
    return c.isNull() | ~c.rlike(r"[^\s   -     　]")
