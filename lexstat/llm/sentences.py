"""Sentence units of texts in any language.

The standard sentence-break rules (SB6 to SB11 of Unicode's text segmentation) are applied to the Sentence_Break property
of the characters, so every script's terminators, closing marks, continuing signs and cases are covered. Tailored on top:
the abbreviations of the text's languages do not end a sentence (its declared language, as far as one is given, and those
whose commonest words it holds); a terminator inside quotation marks or brackets does not; a closing mark right after one
does unless the sentence goes on behind it; and Thai text, which has no terminators, is split at its spaces. A line break
always ends a sentence.

How far a rule looks: to the signs around a terminator, to the last LOOK characters before it for an abbreviation or
ordinal, and along the whole line for quotation marks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._pages import latest_pages


def _having(*props: str) -> frozenset[str]:
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)]))
    return frozenset(c for p in props for c in regex.findall(rf"\p{{SB={p}}}", every))


ATERM, STERM = _having("ATerm"), _having("STerm")
TERM = ATERM | STERM
LOWER, UPPER, NUMERIC = _having("Lower"), _having("Upper"), _having("Numeric")
#: Signs after which no sentence begins (SContinue), and, tailored, the ellipsis and the wide comma of vertical text.
CONTINUE = _having("SContinue") | {"…", ";", "；"}
#: Characters before a terminator that are looked at.
LOOK = 24

#: Opening and closing marks, paired by place.
OPEN, CLOSE = "「『（(［[【〈《〔｛{“„«‹｢〝", "」』）)］]】〉》〕｝}”“»›｣〟"
_PAIR = dict(zip(OPEN, CLOSE))
_CLOSERS = frozenset(CLOSE) | {"”", "“"}

#: Titles and abbreviations of each language that do not end a sentence before a name; "": of all.
TITLES = {
    "": "dr prof st mr mrs ms डॉ श्री श्रीमती प्रो कु".split(), "en": "rev hon gen col sgt capt lt jr".split(), "de": "hr fr frau herr".split(),
    "fr": "mme mlle messrs me mgr".split(), "es": "sr sra".split(), "it": "dott sig".split(),
}
ABBREVIATIONS = {
    "": "vs etc ca al ex cf no nos nr vol fig figs art max min tel".split(),
    "en": """e.g i.e approx est viz env resp sec sect ch chap pp eq eqs tab tbl app ed eds co corp inc ltd bros vols dept
        jan feb mar apr jun jul aug sep sept oct nov dec mon tue wed thu fri sat""".split(),
    "de": "bzw usw z.b d.h u.a evtl ggf inkl vgl bspw usf sog geb abs kap bd hrsg nr st resp".split(),
    "fr": "p.ex c.-à-d av apr env chap cf app éd".split(),
}
#: Of these, the ones that can close a sentence if a capital and no number follows.
_CAN_END = frozenset("co corp inc ltd jr usw al a.m p.m".split())
#: Commonest words by which a language written in Latin letters is known.
_COMMON = {
    "en": frozenset("the of and is to in that for".split()), "de": frozenset("der die das und ist nicht den mit".split()),
    "fr": frozenset("le la les des et est une du".split()), "es": frozenset("el los las que una por del".split()), "it": frozenset("il gli che di una per del".split()),
}
_LATIN = re.compile("[a-zà-ÿ]+")


@lru_cache(maxsize=256)
def _suppressed(languages: frozenset[str]) -> tuple[frozenset[str], frozenset[str]]:
    """Titles and abbreviations of some languages."""
    return tuple(frozenset(w for k in ("", *languages) for w in table.get(k, ())) for table in (TITLES, ABBREVIATIONS))


def languages(text: str, declared: str | None = None) -> frozenset[str]:
    """The declared language and those whose commonest words make up a twentieth of the words; English where none is found.

    Declared languages are missing or wrong at times, so a declared one adds its abbreviations and takes none away.
    """
    words = _LATIN.findall(text.lower())
    found = {k for k, common in _COMMON.items() if 20 * sum(w in common for w in words) >= len(words) > 0} or {"en"}
    return frozenset(found | ({declared.lower()} if declared else set()))


#: Words before an ordinal number in languages that write ordinals with a full stop.
_ORDINAL = frozenset("am den der dem des vom zum im beim das die bis ab seit und el la le".split())
#: What goes on after a closed quotation in Japanese and Chinese.
_GOES_ON = re.compile(r"って|と|の(?!ち)|を|は|が|に|で(?!は|も)|も|へ|や|など|なら|だ|から|まで|より|的|、|，|,|;|；|:|：|\.")

_CJK = "぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ＀-￯　-〿"
_IS_CJK = re.compile(f"[{_CJK}]")
_CLASS = "".join(re.escape(c) for c in sorted(TERM - {".", "!", "?"}))
_EVENT = re.compile(
    rf"[.!?{_CLASS}]|[{re.escape(OPEN + CLOSE)}\"]|(?<=[฀-๿0-9%]) +(?=[฀-๿])")
_ANY = re.compile(rf"[!?{_CLASS}]|\.(?=[\s{_CJK}\"'”“»)\]])|[฀-๿0-9%] +[฀-๿]")
_WORD = re.compile(rf"[^\s\"“„«(\[「（『,;/!?{_CJK}]+$")
#: A word that starts low but has a capital inside, as names of products do.
_NAME = re.compile(r"[^\W\d_]+?(?=[A-Z])")
_NOT_SPACE = re.compile(r"\S")
_THAI_NUMBER = re.compile(r"[฀-๿][0-9.,]*%?$")


def _opens(line: str, p: int) -> bool:
    """Whether the straight quotation mark at p opens a quotation."""
    before = line[p - 1] if p else " "
    after = line[p + 1] if p + 1 < len(line) else " "
    return (before.isspace() or before in "([{-—/“„«" or bool(_IS_CJK.match(before)) and not after.isspace()) and not after.isspace()


def _unmatched(line: str) -> tuple[int, int, bool]:
    """Closing marks without an opening one, the place of the first opening mark never closed (-1: none), whether straight marks pair up."""
    stack: list[tuple[str, int]] = []
    lone, straight = 0, 0
    for m in _EVENT.finditer(line):
        c = m[0]
        if c == '"':
            straight += 1 if _opens(line, m.start()) else -1
            if straight < 0:
                return lone, -1, False
        elif c == "“" and stack and stack[-1][0] == "„":
            stack.pop()
        elif c in _PAIR:
            stack.append((c, m.start()))
        elif c in _CLOSERS:
            if stack and _PAIR[stack[-1][0]] == c:
                stack.pop()
            elif not stack:
                lone += 1
    return lone, stack[0][1] if stack else -1, straight == 0


def _standard(line: str, at: int, end: int, after: str) -> bool:
    """SB6 to SB11 for the terminator at `at`, whose closing marks run to `end`, before `after` (blanks left out).

    Tailored: SB6 holds for a wide full stop only behind a digit too, as text in wide signs has no blanks after sentences.
    """
    n, spaced = after[0], line[end].isspace()
    if line[at] in ATERM and end == at + 1 and not spaced:
        if n in NUMERIC and (line[at] == "." or line[at - 1 : at] and line[at - 1] in NUMERIC):
            return False  # SB6
        if n in UPPER and line[at - 1 : at] and line[at - 1] in UPPER | LOWER:
            return False  # SB7
    return n not in TERM and n not in CONTINUE  # SB8a; SB11


def _ends(line: str, at: int, end: int, closed: bool, known: tuple[frozenset[str], frozenset[str]]) -> bool:
    """Whether the terminator at `at`, with all that clings to it up to `end`, ends a sentence before further text."""
    begin = _NOT_SPACE.search(line, end)
    if not begin:
        return False
    after, spaced = line[begin.start() : begin.start() + LOOK], line[end].isspace()
    n = after[0]
    if closed and _GOES_ON.match(after):
        return False
    if n in ".…":
        return False  # SB8a
    c = line[at]
    cjk = bool(_IS_CJK.match(n))
    if n in LOWER and not cjk and not _NAME.match(after) and (spaced or closed or c in ".!?"):  # SB8
        if not (c in "!?" and not spaced and not closed and at and _IS_CJK.match(line[at - 1])):
            return False
    if c not in ATERM:
        if c in "!?" and not spaced and not closed:
            return (cjk or bool(at and _IS_CJK.match(line[at - 1]))) and n not in "、。，」』）"
        return _standard(line, at, end, after)
    if c != "." and not closed:  # a wide full stop
        return _standard(line, at, end, after)
    if not spaced and not (closed and cjk):
        return c == "." and cjk and not closed and at > 0 and bool(_IS_CJK.match(line[at - 1])) and n not in "、。，"
    if n in CONTINUE or n in ",;:、，)" or line[at - 2 : at + 1] == "...":
        return n in UPPER
    if closed:
        return True
    titles, abbreviations = known
    w = _WORD.search(line, max(0, at - LOOK), at)
    w = w[0].rstrip(".").lower() if w else ""
    if w in ("a.m", "p.m"):
        return True
    if w in titles or (w in abbreviations and (w not in _CAN_END or not (n.isupper() or _NAME.match(after)))):
        return False
    if len(w) == 1 and w.isalpha() and not _IS_CJK.match(w):
        return False
    if "." in w and re.fullmatch(r"(\w\.)+\w", w) and not w[0].isdigit():
        return False
    if w.isdigit() and len(w) <= 2:
        before = re.search(r"(\w+)\s+\d+$", line[max(0, at - LOOK) : at])
        if n.isupper() and before and before[1].lower() in _ORDINAL or at <= 2 and not line[:at].strip("0123456789"):
            return False
    return True


#: Wide letters, digits and full stop to plain ones, one code point each.
_NARROW = {0xFF0E: ".", **{c: chr(c - 0xFEE0) for a, b in ((0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)) for c in range(a, b + 1)}}
_WIDE = re.compile("[Ａ-Ｚａ-ｚ]")


def _line_starts(line: str, first: bool, last: bool, known: tuple[frozenset[str], frozenset[str]]) -> list[int]:
    """Places in the line where sentences after its first start."""
    if _WIDE.search(line):
        line = line.translate(_NARROW)
    lone, open_at, straight = _unmatched(line)
    depth = lone if first else 0
    skip = -1 if last else open_at
    starts, resume, stack = [], 0, []
    n = len(line)
    for m in _EVENT.finditer(line):
        p, c = m.start(), m[0]
        if p < resume:
            continue
        if c == '"':
            if straight:
                if _opens(line, p):
                    stack.append(c)
                elif stack and stack[-1] == '"':
                    stack.pop()
            continue
        if c == "“" and stack and stack[-1] == "„":
            stack.pop()
        elif c in _PAIR:
            if p != skip:
                stack.append(c)
        elif c in _CLOSERS:
            if stack and stack[-1] != '"' and _PAIR[stack[-1]] == c:
                stack.pop()
            elif not stack and depth:
                depth -= 1
        elif c[0] == " ":
            if not stack and not depth and _THAI_NUMBER.search(line, max(0, p - 16), p):
                starts.append(m.end())
        else:
            e = p + 1
            while e < n and line[e] in TERM:
                e += 1
            closed = False
            while e < n:
                x = e + 1 if line[e] in "   " and line[e + 1 : e + 2] in ("»", "›") else e
                d = line[x : x + 1]
                if d == '"' and straight and stack and stack[-1] == '"' and not (_opens(line, x)):
                    stack.pop()
                elif d and d in _CLOSERS and stack and stack[-1] != '"' and (_PAIR[stack[-1]] == d or d == "“" and stack[-1] == "„"):
                    stack.pop()
                elif d and d in _CLOSERS and not stack and depth:
                    depth -= 1
                elif closed and d and d in TERM:
                    closed = False
                    p, e = x, x + 1
                    continue
                else:
                    break
                closed, e = True, x + 1
            resume = e
            if not stack and not depth and _ends(line, p, e, closed, known):
                while e < n and line[e].isspace():
                    e += 1
                starts.append(e)
    return starts


def sentence_spans(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """Start and end (code points, end exclusive, outer blanks left out) of every sentence of the text.

    Null, empty and blank texts have none. In the first line a closing mark without an opening one, and in the last line
    an opening one never closed, count as a quotation cut off by the text's edge.
    """
    out: list[tuple[int, int]] = []
    if not text:
        return out
    lines = re.split("[\n\x0b\x0c\x85  ]|\r\n?", text) if "\r" not in text else text.replace("\r\n", " \n").replace("\r", "\n").split("\n")
    at = 0
    known = _suppressed(languages(text, lang))
    for i, line in enumerate(lines):
        starts = _line_starts(line, i == 0, i == len(lines) - 1, known) if _ANY.search(line) else []
        b = 0
        for e in [*starts, len(line)]:
            unit = line[b:e]
            if kept := unit.strip():
                s = at + b + len(unit) - len(unit.lstrip())
                out.append((s, s + len(kept)))
            b = e
        at += len(line) + 1
    return out


def _split(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            field, rec, no, start, out = [], [], [], [], []
            for f, r, t, lang in zip(*(c.to_pylist() for c in b.columns)):
                spans = sentence_spans(t, lang)
                k = len(spans)
                field += [f] * k
                rec += [r] * k
                no += range(k)
                start += [s for s, _ in spans]
                if with_text:
                    out += [t[s:e] for s, e in spans]
            cols = [pa.array(field, pa.string()), pa.array(rec, pa.int64()), pa.array(no, pa.int32()), pa.array(start, pa.int32())]
            names = ["field", "rec_id", "sentence_no", "start_pos"]
            if with_text:
                cols, names = [*cols, pa.array(out, pa.string())], [*names, "sentence"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def sentences(texts: DataFrame, with_text: bool = True) -> DataFrame:
    """field, rec_id, sentence_no (from 0), start_pos (code points) and, unless left out, sentence of every text.

    Input: field, rec_id, text and, if known, lang. Records without text or with blank text have no sentence; repeated rows come out as often
    as they are given.
    """
    lang = F.col("lang") if "lang" in texts.columns else F.lit(None).cast("string")
    return texts.select("field", "rec_id", "text", lang.alias("lang")).where("text is not null").mapInArrow(
        _split(with_text), "field string, rec_id bigint, sentence_no int, start_pos int" + ", sentence string" * with_text)


def unit_texts(articles: DataFrame, occurrences: DataFrame) -> DataFrame:
    """field, rec_id, text, lang: the valid version of every page, and every excerpt once (with no language declared)."""
    articles = articles if "lang" in articles.columns else articles.withColumn("lang", F.lit(None).cast("string"))
    pages = latest_pages(articles, "text", "lang").select(F.lit("article").alias("field"), F.col("page_id").alias("rec_id"), "text", "lang")
    ex = occurrences.where("occ_id is not null and excerpt is not null").select("occ_id", "excerpt").dropDuplicates(["occ_id"])
    return pages.union(ex.select(F.lit("occurrence"), "occ_id", "excerpt", F.lit(None).cast("string")))
