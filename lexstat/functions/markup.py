"""Flattening of Markdown, gettext and reStructuredText documents to plain Japanese paragraphs.

Code, addresses and tags go; where an inline piece is cut out of a sentence a placeholder noun stands for it, so that
the words around it are not read as neighbours. Paragraphs with too little Japanese are dropped.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The noun for removed code, and the least share of Japanese in a paragraph.
PLACEHOLDER, JAPANESE_SHARE = "ZZCODEZZ", 0.2
_JA = re.compile("[ぁ-ヿ一-鿿]")
_MD_FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})")
_INLINE = re.compile(r"``[^`]+``|`[^`\n]+`|https?://[^\s)>」]+|<[^<>\n]+>")


def japanese_enough(text: str) -> bool:
    return bool(text) and len(_JA.findall(text)) >= JAPANESE_SHARE * len(text)


def _tidy(text: str) -> str:
    return re.sub(r"[ \t]+", " ", text).strip()


def flatten_markdown(text: str) -> str:
    """Paragraphs of a Markdown text, one per line: no front matter, code blocks or markup; links keep their words."""
    text = re.sub(r"\A---\n.*?\n---\n", "", text, flags=re.S)
    lines, fence = [], None
    for line in text.split("\n"):
        m = _MD_FENCE.match(line)
        if m and fence is None:
            fence = m[1]
            lines.append("")
        elif fence is not None:
            if line.strip().startswith(fence[:3]) and not line.strip().strip(fence[0]):
                fence = None
        else:
            lines.append(line)
    out = []
    for para in re.split(r"\n\s*\n", "\n".join(lines)):
        for piece in re.split(r"\n(?=\s*(?:[-*+>#|]|\d+\.)\s*)", para):
            p = re.sub(r"^\s*(?:#{1,6}|[-*+>]|\d+\.)\s+", "", piece.strip())
            p = re.sub(r"!\[[^\]]*\]\([^)]*\)", "", p)
            p = re.sub(r"\[([^\]]*)\]\([^)]*\)", r"\1", p)
            p = _INLINE.sub(PLACEHOLDER, p)
            p = re.sub(r"(\*\*|__|\*|~~)(?=\S)(.+?)(?<=\S)\1", r"\2", p)
            p = _tidy(p.replace("\n", ""))
            if japanese_enough(p):
                out.append(p)
    return "\n".join(out)


def po_messages(text: str) -> list[str]:
    """The translations of a gettext file: strings of one message joined, the header (empty msgid) left out."""
    out, field, msgid, msgstr = [], None, "", ""

    def close() -> None:
        if msgid and msgstr:
            out.append(re.sub(r"\\[nt]", " ", msgstr).replace('\\"', '"').replace("\\\\", "\\"))

    for line in text.split("\n"):
        line = line.strip()
        if line.startswith("msgid "):
            close()
            field, msgid, msgstr, line = "id", "", "", line[6:]
        elif re.match(r"msgstr(\[\d+\])? ", line):
            field, line = "str", line.split(" ", 1)[1]
        elif line.startswith(("msgid_plural ", "msgctxt ")):
            field, line = None, ""
        if line.startswith('"') and line.endswith('"') and len(line) >= 2:
            if field == "id":
                msgid += line[1:-1]
            elif field == "str":
                msgstr += line[1:-1]
    close()
    return out


def _rst_inline(text: str) -> str:
    text = re.sub(r":[\w:-]+:`([^`<]+?)(?:\s*<[^>]*>)?`", r"\1", text)
    text = re.sub(r"`([^`<]+?)\s*<[^>]*>`__?", r"\1", text)
    text = re.sub(r"``[^`]+``", PLACEHOLDER, text)
    text = re.sub(r"(\*\*|\*)(?=\S)(.+?)(?<=\S)\1", r"\2", text)
    return re.sub(r"\s*\[[#\w*-]+\]_", "", text)


def flatten_rst(text: str) -> str:
    """Paragraphs of a reStructuredText document: no directives, comments, literal blocks, field lists or adornment lines."""
    kept, skip, literal = [], None, False
    for line in text.split("\n"):
        indent = len(line) - len(line.lstrip())
        if skip is not None:
            if not line.strip() or indent > skip:
                kept.append("")
                continue
            skip = None
        if literal and line.strip() and indent > 0:
            kept.append("")
            continue
        if line.strip():
            literal = False
        if re.match(r"\s*\.\.(\s|$)", line):
            skip = indent
            note = re.match(r"\s*\.\. (?:note|warning|tip|caution|important|hint)::\s*(.*)", line)
            kept.append(note[1] if note else "")
            skip = None if note else skip
            continue
        if re.match(r"\s*:[^:`\s][^:`]*:(\s|$)", line) or re.fullmatch(r"\s*([=\-~^\"'`#*+.:_])\1{2,}\s*", line):
            kept.append("")
            continue
        if line.rstrip().endswith("::"):
            literal = True
            line = line.rstrip()[:-1] if line.strip() != "::" else ""
        kept.append(line)
    out = []
    for para in re.split(r"\n\s*\n", "\n".join(kept)):
        p = _tidy(_rst_inline(re.sub(r"(?m)^\s*(?:[-*+]|#\.|\d+\.)\s+", "", para)).replace("\n", ""))
        if japanese_enough(p):
            out.append(p)
    return "\n".join(out)


def clean_tables(text: str) -> str:
    """Cells of pipe tables on lines of their own, separator rows dropped, links reduced to their words."""
    out = []
    for line in text.split("\n"):
        if line.strip().startswith("|"):
            cells = [c.strip() for c in line.strip().strip("|").split("|")]
            out += [] if all(re.fullmatch(r":?-+:?", c) for c in cells) else [c for c in cells if c]
        else:
            out.append(line)
    return re.sub(r"\[([^\]]*)\]\([^)]*\)", r"\1", "\n".join(out))


def flatten(fmt: str | None, text: str | None) -> str | None:
    """A document of a format (md, mdx, po, rst) as plain paragraphs; null for other formats and for null texts."""
    kind = (fmt or "").strip().lower()
    if text is None:
        return None
    if kind in ("md", "mdx"):
        return flatten_markdown(text)
    if kind == "po":
        return "\n".join(p for p in map(_tidy, map(flatten_markdown, po_messages(text) or [text])) if p)
    if kind in ("rst", "rest"):
        return flatten_rst(text)
    return None


@F.pandas_udf(StringType())
def _flatten(fmt: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([flatten(None if pd.isna(f) else f, None if t is None else t) for f, t in zip(fmt, text)])


def flatten_text(fmt: Column, text: Column) -> Column:
    return _flatten(fmt, text)
