"""Morpheme providers.

A provider adds the column `morphemes`, array<struct<surface, norm, pos0, pos1, start, end, known>>, to chunks of
text; start and end are code-point places in the chunk. Operators only rely on this column, so texts that were
segmented elsewhere can be read as they are.
"""

from .providers import MORPHEMES, dictionary_morphemes, regex_morphemes

__all__ = ["MORPHEMES", "dictionary_morphemes", "regex_morphemes"]
