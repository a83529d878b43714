"""Markup residue: finding which markup a text really holds, and clean text that keeps its structure.

A text is parsed into a tree: entry, texts, blocks, spans, spans inside spans. Every place that some dialect (Markdown,
MediaWiki, reStructuredText, HTML, LaTeX) would read as markup becomes a candidate node; whether it is markup, and of
which kind, is a variable of a tree-structured graphical model. The entry and its texts have a dialect; a node's parent is
the smallest node around it, else its text. The potential between a node and its parent says how often a text of a
dialect, or a node that is markup or isn't, holds such a candidate, and in which state: so what is found inside a node
speaks for or against it. A sum-product pass from the leaves to the entry and back yields every node's marginal, in time
proportional to the nodes. The tables are counted on labelled pages, which are put together from marked-up and merely
look-alike pieces of every dialect.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIALECTS = ("md", "wiki", "rst", "html", "tex", "plain")
ELEMENTS = ("heading", "list", "code", "formula", "inline")
#: Names of declared formats and the dialect that each promises (po and unknown promise none).
DECLARED = {"md": "md", "mdx": "md", "markdown": "md", "rst": "rst", "rest": "rst", "html": "html", "htm": "html", "xhtml": "html",
            "wiki": "wiki", "mediawiki": "wiki", "tex": "tex", "latex": "tex", "txt": "plain", "text": "plain", "po": "any"}

_M, _S = re.M, re.S
_TAGS = ("a|abbr|acronym|address|article|aside|b|big|blockquote|body|br|caption|center|cite|col|del|details|dfn|div|em|figure|figcaption|font|footer|"
         "header|hr|html|i|iframe|img|ins|label|link|main|mark|meta|nav|nowiki|object|p|q|rp|rt|ruby|s|section|small|span|strike|strong|style|sub|"
         "summary|sup|svg|table|tbody|td|tfoot|th|thead|title|tr|u|var|video|wbr|ref|references|gallery|noinclude|includeonly|poem|script")
_NAME = r"(?:[A-Za-z_][\w.-]*)"
_UNDER = r"=\-~^\"'`#*+.:_"

#: form, element, level (block or span), pattern; group "t" is the content. Earlier forms take a place before later ones.
_FORMS = [
    ("comment", "inline", "span", r"<!--(?P<t>.*?)-->", _S),
    ("fence", "code", "block", r"^[ ]{0,3}(?P<f>`{3,}|(?:(?<=\n\n)|(?<![\s\S]))~{3,})[^\n`]*\n(?P<t>.*?)(?:\n[ ]{0,3}(?P=f)[`~]*[ ]*$)", _M | _S),
    ("pre", "code", "block", r"<pre\b[^<>]*>\s*(?:<code\b[^<>]*>)?(?P<t>.*?)(?:</code>)?\s*</pre>", _S | re.I),
    ("codetag", "code", "span", r"<(?P<g>code|source|syntaxhighlight|tt|kbd|samp)\b[^<>]*>(?P<t>.*?)</(?P=g)>", _S | re.I),
    ("verbatim", "code", "block", r"\\begin\{(?P<g>verbatim\*?|lstlisting|minted|alltt)\}(?:\[[^\]]*\]|\{[^}]*\})*\n?(?P<t>.*?)\n?\\end\{(?P=g)\}", _S),
    ("verb", "code", "span", r"\\(?:verb\*?|lstinline)(?P<d>[|!+/@\"])(?P<t>[^\n]*?)(?P=d)", 0),
    ("texttt", "code", "span", r"\\texttt\{(?P<t>(?:[^{}]|\{[^{}]*\})*)\}", 0),
    ("mathrst", "formula", "block", r"^\.\. math::[^\n]*(?P<t>(?:\n[ \t]*)*(?:\n[ \t]+\S[^\n]*)*)", _M),
    ("coderst", "code", "block", r"^\.\. (?:code-block|sourcecode|code|highlight|literalinclude|parsed-literal)::[^\n]*(?P<t>(?:\n[ \t]*:[^\n]*)*(?:\n(?:[ \t]*|[ \t]+\S[^\n]*))*)", _M),
    ("literal", "code", "block", r"(?<!:)::\n[ \t]*\n(?P<t>(?:[ \t]+\S[^\n]*(?:\n|\Z))+)", 0),
    ("directive", "inline", "block", r"^\.\. (?:[\w-]+::|_[^:\n]+:|\[[^\]\n]+\]|\|[^|\n]+\|)(?P<t>[^\n]*)", _M),
    ("mathrole", "formula", "span", r":math:`(?P<t>[^`\n]+)`", 0),
    ("mathtag", "formula", "span", r"<(?P<g>math|chem)\b[^<>]*>(?P<t>.*?)</(?P=g)>", _S),
    ("mathspan", "formula", "span", r"<(?P<g>span|div) class=[\"'][^\"'<>]*math[^\"'<>]*[\"'][^<>]*>(?P<t>.*?)</(?P=g)>", _S),
    ("mathtpl", "formula", "span", r"\{\{(?:math|mvar|数式)\|(?P<t>(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}\}", 0),
    ("mathenv", "formula", "block", r"\\begin\{(?P<g>equation\*?|align\*?|gather\*?|multline\*?|eqnarray\*?|math|displaymath)\}(?P<t>.*?)\\end\{(?P=g)\}", _S),
    ("mathblock", "formula", "block", r"\$\$(?P<t>[^$]+?)\$\$", 0),
    ("mathparen", "formula", "span", r"(?P<b>\\\\?)\((?P<t>[^\n]+?)(?P=b)\)", 0),
    ("mathbracket", "formula", "span", r"(?P<b>\\\\?)\[(?P<t>[^\[\]]*?(?:\[[^\]]*\][^\[\]]*?)*)(?P=b)\]", 0),
    ("dollar", "formula", "span", r"(?<![\\$\w])\$(?P<t>[^\s$](?:[^$\n]*[^\s$\\])?)\$(?![\w$])", 0),
    ("mathhtml", "formula", "span", r"(?P<t>(?:<(?:i|var|em)>\w{1,3}</(?:i|var|em)>(?:\s*<su[bp]>[^<>]{1,12}</su[bp]>)+(?:\s*[-+=*/×·<>≤≥,]\s*)?)+)", 0),
    ("dbltick", "code", "span", r"(?<![`\w])``(?P<t>[^`\n](?:[^\n]*?[^`\n])?)``(?!`)", 0),
    ("headwiki", "heading", "block", r"^[ \t]*(?P<e>={1,6})(?!=)[ \t]*(?P<t>[^=\s](?:[^\n]*?[^=\s])?)[ \t]*(?P=e)[ \t]*$", _M),
    ("headover", "heading", "block", rf"^(?P<u>[{_UNDER}])(?P=u){{2,}}[ \t]*\n(?P<t>[ \t]*\S[^\n]*)\n(?P=u){{3,}}[ \t]*$", _M),
    ("headunder", "heading", "block", rf"^(?P<t>(?:[^\s|>{_UNDER}]|(?:\*\*?|``?|__?|:)(?=\w))[^\n]*)\n(?P<u>[{_UNDER}])(?P=u){{2,}}[ \t]*$", _M),
    ("headtag", "heading", "block", r"<(?P<g>h[1-6])\b[^<>]*>(?P<t>.*?)</(?P=g)\s*>", _S | re.I),
    ("headtex", "heading", "block", r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?(?:\[[^\]\n]*\])?\{(?P<t>(?:[^{}]|\{[^{}]*\})*)\}(?:\s*\\label\{[^{}]*\})?", 0),
    ("hashes", "heading", "block", r"^[ ]{0,3}#{1,6}[ \t]*[^\s#][^\n]*(?:\n[ ]{0,3}#{1,6}[ \t]*[^\s#][^\n]*)*", _M),
    ("listtag", "list", "block", r"<(?P<g>ul|ol|dl|menu)\b[^<>]*>(?P<t>.*?)</(?P=g)\s*>|<li\b[^<>]*>(?P<t2>[^\n]*)", _S | re.I),
    ("listtex", "list", "block", r"\\begin\{(?P<g>itemize|enumerate|description)\}(?:\[[^\]]*\])?(?P<t>.*?)\\end\{(?P=g)\}|^\\item\b(?P<t2>[^\n]*)", _M | _S),
    ("autonum", "list", "block", r"^[ \t]*#\.[ \t]+(?P<t>\S[^\n]*(?:\n[ \t]*(?:#\.[ \t]+)?\S[^\n]*)*)", _M),
    ("number", "list", "block", r"^[ \t]*\(?\d{1,3}[.)][ \t]+\S[^\n]*(?:\n+[ \t]*\(?\d{1,3}[.)][ \t]+\S[^\n]*)*", _M),
    ("bullet", "list", "block", r"^[ \t]*[-*+•][ \t]+\S[^\n]*(?:\n+[ \t]*[-*+•][ \t]+\S[^\n]*)*", _M),
    ("stars", "list", "block", r"^(?:\*+|;|:+(?=\s))(?![*:;])[ \t]*[^\s*:;][^\n*]*$(?:\n(?:\*+|;|:+|#+)[ \t]*[^\s*][^\n*]*$)*", _M),
    ("rule", "inline", "block", r"^[ ]{0,3}(?:-{4,}|\*{3,}|_{3,}|(?:[-*_] ){2,}[-*_])[ \t]*$", _M),
    ("quote", "inline", "block", r"^>[ \t]+(?P<t>\S[^\n]*)", _M),
    ("tablerow", "inline", "block", r"^\|[^\n]*\|[ \t]*\n\|[ :|-]+\|[ \t]*$|^\{\|[^\n]*", _M),
    ("image", "inline", "span", r"!\[(?P<t>[^\]\n]*)\](?:\([^()\n]*(?:\([^()\n]*\)[^()\n]*)*\)|\[[^\]\n]*\])", 0),
    ("wikilink", "inline", "span", r"\[\[(?:[^\[\]|\n]*\|)*(?P<t>[^\[\]|\n]+)\]\]", 0),
    ("footref", "inline", "span", r"\[\^(?P<t>[^\]\s]+)\]:?", 0),
    ("mdlink", "inline", "span", r"\[(?P<t>[^\[\]\n]+)\](?:\([^()\s]*(?:[ \t]+\"[^\"\n]*\")?\)|\[[^\[\]\n]*\])", 0),
    ("extlink", "inline", "span", r"\[(?:https?://|//|/|mailto:)\S+(?:[ \t]+(?P<t>[^\[\]\n]+))?\]", 0),
    ("autolink", "inline", "span", r"<(?P<t>(?:https?|ftp|mailto):[^\s<>]+)>", 0),
    ("role", "inline", "span", rf":{_NAME}(?::{_NAME})*:`(?P<t>[^`\n]+)`", 0),
    ("rstlink", "inline", "span", r"`(?P<t>[^`\n<>]+?)(?:\s*<[^<>\n]+>)?`__?(?!\w)", 0),
    ("rstref", "inline", "span", r"\[(?P<t>#?[\w*#-]+)\]_(?!\w)", 0),
    ("tick", "code", "span", r"(?<![`\w])`(?P<t>[^`\s](?:[^`\n]*[^`\s])?)`(?![`\w])", 0),
    ("texcmd", "inline", "span", r"(?:(?<!\})(?=\\label)|(?!\\label))~?\\(?:textbf|textit|textsc|textsf|textrm|textsl|textsuperscript|underline|emph|url|cite[pt]?\*?|footnote|ref|eqref|pageref|label|index|mbox|caption|title|author)(?:\[[^\]\n]*\])*\{(?P<t>(?:[^{}]|\{[^{}]*\})*)\}", 0),
    ("texhref", "inline", "span", r"\\(?:href|textcolor|hyperref)(?:\{[^{}]*\}|\[[^\]\n]*\])\{(?P<t>(?:[^{}]|\{[^{}]*\})*)\}", 0),
    ("texgroup", "inline", "span", r"\{\\(?:it|bf|em|sc|sf|tt|sl|rm|itshape|bfseries|large|small|footnotesize)\s+(?P<t>[^{}]*)\}", 0),
    ("texenv", "inline", "block", r"\\(?:begin|end)\{(?:quote|quotation|center|figure|table|tabular|abstract|document)\*?\}", 0),
    ("ref", "inline", "span", r"<ref\b[^<>]*?(?:/>|>(?P<t>.*?)</ref>)", _S),
    ("template", "inline", "span", r"\{\{(?P<t>[^{}|\n\d][^{}|\n]*)(?:\|[^{}\n]*)?\}\}", 0),
    ("tripleq", "inline", "span", r"'''(?P<t>[^'\n](?:[^\n]*?[^'\n])?)'''", 0),
    ("doubleq", "inline", "span", r"(?<!')''(?P<t>[^'\n](?:[^\n]*?[^'\n])?)''(?!')", 0),
    ("tag", "inline", "span", rf"</?(?:{_TAGS})(?:\s[^<>]*)?/?>", re.I),
    ("jsx", "inline", "span", r"</?[A-Z][A-Za-z]*(?:\.[A-Z][A-Za-z]*)*(?:\s+[\w:-]+=(?:\"[^\"]*\"|\{[^{}]*\}))*\s*/>|<(?P<g>[A-Z][A-Za-z]+)(?:\s[^<>]*)?>.*?</(?P=g)>", _S),
    ("entity", "inline", "span", r"&(?:#\d{1,7}|#x[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});", 0),
    ("strike", "inline", "span", r"(?<!~)~~(?P<t>[^~\s](?:[^~\n]*[^~\s])?)~~(?!~)", 0),
    ("strong", "inline", "span", r"(?<![*\\\w])\*\*(?P<t>[^*\s](?:[^*\n]*[^*\s])?)\*\*(?![*])|(?<=[ぁ-鿿])\*\*(?P<t2>[^*\s](?:[^*\n]*[^*\s])?)\*\*(?!\*)", 0),
    ("strongu", "inline", "span", r"(?<![\w_])__(?P<t>[^_\s](?:[^\n]*?[^_\s])?)__(?![\w_])|(?<=[ぁ-鿿])__(?P<t2>[^_\s](?:[^_\n]*[^_\s])?)__(?!_)", 0),
    ("emph", "inline", "span", r"(?<![*\\A-Za-z0-9])\*(?P<t>[^*\s](?:[^*\n]*[^*\s\\])?)\*(?![*A-Za-z0-9])", 0),
    ("emphu", "inline", "span", r"(?<![\w\\])_(?P<t>[^_\s](?:[^_\n]*[^_\s])?)_(?!\w)", 0),
    ("break", "inline", "span", r"\\\\[ \t]*(?=\n)|(?<=\S)[ ]{2,}(?=\n)|(?<=\S)\\(?=\n)", 0),
]
#: Characters of which a text must hold one to hold a form: those that its pattern can't do without.
_NEEDS = {c: forms.split() for c, forms in {
    "<": "comment pre codetag mathtag mathspan mathhtml headtag listtag autolink ref tag jsx", "`": "dbltick rstlink tick", "`~": "fence",
    "\\": "verbatim verb texttt mathenv mathparen mathbracket headtex listtex texcmd texhref texenv", ".": "mathrst coderst directive", ":": "literal mathrole role",
    "{": "mathtpl template texgroup", "$": "mathblock dollar", "=": "headwiki", "\n": "headover headunder break", "#": "hashes autonum", "-*+•": "bullet", "*;:": "stars", "-*_": "rule",
    ">": "quote", "|{": "tablerow", "!": "image", "[": "wikilink footref mdlink extlink rstref", "'": "tripleq doubleq", "&": "entity", "~": "strike", "*": "strong emph", "_": "strongu emphu",
    "0": "number"}.items()}  # 0 stands for any digit
_NEED = {f: frozenset(c) for c, forms in _NEEDS.items() for f in forms}
FORMS = [(f, e, lv, re.compile(p, fl), _NEED[f]) for f, e, lv, p, fl in _FORMS]
#: Spans whose content can hold further spans.
HOLDS = frozenset("wikilink mdlink extlink texcmd texhref texgroup tripleq doubleq strike strong strongu emph emphu".split())
#: Kinds that a candidate's form can stand for.
STATES = {f: ("no", "heading", "list") if f == "hashes" else ("no", e) for f, e, *_ in FORMS}


@dataclass
class Node:
    form: str
    feature: str
    start: int
    end: int
    content: str
    block: bool
    parent: int = -1
    belief: dict[str, float] = field(default_factory=dict)


def _feature(form: str, text: str, m: re.Match) -> str:
    """What about the place tells markup from look-alikes: how many lines, whether signs look doubled or numeric."""
    s = m[0]
    if form in ("hashes", "bullet", "stars", "number", "autonum"):
        lines = [x for x in s.split("\n") if x.strip()]
        many = "many" if len(lines) > 1 else "one"
        if form == "hashes":
            marks = {len(re.match(r"\s*(#+)", x)[1]) for x in lines}
            return many + ("1" if marks == {1} else "+") + ("" if re.match(r"\s*#+\s", s) else "tight") + ("closed" if re.search(r"\s#+\s*$", s) else "")
        if form == "number":
            ns = [int(re.search(r"\d+", x)[0]) for x in lines]
            return many + ("run" if ns[0] in (0, 1) and all(b - a in (0, 1) for a, b in zip(ns, ns[1:])) else "odd")
        return many + ("tight" if form == "stars" and not re.match(r"\S+\s", s) else "")
    if form in ("headunder", "headover"):
        u = m["u"]
        return ("eq" if u in "=-" else "other") + ("long" if m[0].rstrip().endswith(u * 4) else "short")
    t = m.groupdict().get("t") or m.groupdict().get("t2") or ""
    if form in ("emph", "dollar", "emphu", "strong", "strongu", "template", "mathparen", "mathbracket"):
        before = text[m.start() - 1 : m.start()]
        after = text[m.end() : m.end() + 1]
        near = "digit" if before.isdigit() or after.isdigit() or re.fullmatch(r"[\d\s.,]+", t) else "plain"
        if form == "strongu" and re.fullmatch(r"[A-Za-z0-9_]+", t):
            return "name"
        return near + ("math" if re.search(r"[\\^_={}+]", t) else "")
    return ""


class _Places:
    """The nodes found so far, by where they begin and end."""

    def __init__(self, size: int):
        self.hard = bytearray(size)  # 1: inside a node that holds none, or one of the marks of a node that holds some
        self.blocks = bytearray(size)
        self.starts: list[tuple[int, int]] = []
        self.ends: list[tuple[int, int]] = []

    def crossed(self, a: int, b: int) -> bool:
        """Whether a node begins or ends in a..b whose other end lies outside."""
        i, j = bisect_left(self.starts, (a, -1)), bisect_left(self.starts, (b, -1))
        if any(e > b for _, e in self.starts[i:j]):
            return True
        i, j = bisect_left(self.ends, (a + 1, -1)), bisect_left(self.ends, (b + 1, -1))
        return any(s < a for _, s in self.ends[i:j])

    def put(self, a: int, b: int, marks: list[tuple[int, int]], block: bool) -> None:
        insort(self.starts, (a, b))
        insort(self.ends, (b, a))
        for x, y in marks:
            self.hard[x:y] = b"\1" * (y - x)
            if block:
                self.blocks[x:y] = b"\1" * (y - x)


def parse(text: str) -> list[Node]:
    """Candidates of a text in order of place, each with the smallest other around it as parent; none overlaps another in part."""
    at = _Places(len(text))
    nodes: list[Node] = []
    open_at: list[tuple[int, int]] = []
    chars = set(text)
    if any(map(str.isdigit, chars)):
        chars.add("0")
    for form, element, level, pattern, need in FORMS:
        if need.isdisjoint(chars):
            continue
        wide = level == "block" and element in ("heading", "list") or form == "quote"
        for m in pattern.finditer(text):
            a, b = m.span()
            if a == b:
                continue
            d = m.groupdict()
            group = next((g for g in ("t", "t2") if d.get(g) is not None), 0)
            marks = [(a, m.start(group)), (m.end(group), b)] if form in HOLDS and group else [(a, b)]
            if wide:
                if at.blocks.find(1, a, b) >= 0 or at.crossed(a, b):
                    continue
            elif any(at.hard.find(1, x, y) >= 0 for x, y in marks) or form in HOLDS and at.crossed(a, b):
                continue
            node = Node(form, _feature(form, text, m), a, b, m[group], level == "block")
            if wide:  # of overlapping blocks the earlier form holds
                i = bisect_left(open_at, (a, b))
                if i < len(open_at) and open_at[i][0] < b or i and open_at[i - 1][1] > a:
                    continue
                open_at.insert(i, (a, b))
            else:
                at.put(a, b, marks, node.block)
            nodes.append(node)
    nodes.sort(key=lambda x: (x.start, -x.end))
    around: list[int] = []
    for i, x in enumerate(nodes):
        while around and nodes[around[-1]].end <= x.start:
            around.pop()
        x.parent = next((j for j in reversed(around) if nodes[j].end >= x.end), -1)
        around.append(i)
    return nodes


def _under(state: str) -> str:
    """What a node's children see of its state."""
    return "no" if state == "no" else "yes"


class Model:
    """Conditional tables: dialect given the declared format, text's dialect given the entry's, node given dialect and parent."""

    def __init__(self) -> None:
        self.declared: dict[str, np.ndarray] = defaultdict(lambda: np.ones(len(DIALECTS)) * 0.3)
        self.same = 0.95
        self.node: dict[tuple, np.ndarray] = {}
        self.rate: dict[tuple[str, str], np.ndarray] = defaultdict(lambda: np.ones(len(DIALECTS)) * 0.2)
        self.parents: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(DIALECTS)))

    def count(self, declared: str, dialect: int, nodes: list[tuple[Node, str, str]]) -> None:
        self.declared[declared][dialect] += 1
        self.parents["none"][dialect] += 1
        for n, state, parent in nodes:
            self.rate[n.form, parent][dialect] += 1
            self.parents[_under(state)][dialect] += 1
            for key in ((n.form, n.feature, dialect, parent), (n.form, n.feature, dialect), (n.form, n.feature), (n.form,)):
                self.node.setdefault(key, np.zeros(len(STATES[n.form])))[STATES[n.form].index(state)] += 1

    @lru_cache(maxsize=65536)  # noqa: B019
    def states(self, form: str, feature: str, parent: str) -> np.ndarray:
        """P(state | dialect, parent), dialects by states, smoothed from the general to the special."""
        rows = []
        for d in range(len(DIALECTS)):
            p = np.full(len(STATES[form]), 0.5)
            p[1] += 0.5  # a form that no labelled page shows counts as markup
            p /= p.sum()
            for key in ((form,), (form, feature), (form, feature, d), (form, feature, d, parent)):
                c = self.node.get(key)
                if c is not None:
                    p = (c + 2 * p) / (c.sum() + 2)
            rows.append(p)
        return np.array(rows)

    def likelihood(self, form: str, parent: str) -> np.ndarray:
        """How often a text of each dialect (parent: none), or a node that is markup (yes) or not (no), holds the form."""
        return self.rate[form, parent] / (self.parents[parent] + 1)

    @lru_cache(maxsize=65536)  # noqa: B019
    def potential(self, form: str, feature: str, parent: str) -> np.ndarray:
        """The form's occurrence and its state given the parent, dialects by states."""
        return self.states(form, feature, parent) * self.likelihood(form, parent)[:, None]

    def infer(self, declared: str, texts: list[list[Node]]) -> None:
        """Sum-product over the tree of one entry; fills the nodes' beliefs."""
        k = len(DIALECTS)
        move = np.full((k, k), (1 - self.same) / (k - 1))
        np.fill_diagonal(move, self.same)
        up, belows = [], []
        for nodes in texts:  # leaves to texts
            message = np.ones(k)
            below = [np.ones((k, len(STATES[n.form]))) for n in nodes]
            for i in range(len(nodes) - 1, -1, -1):
                n = nodes[i]
                if n.parent < 0:
                    message *= (self.potential(n.form, n.feature, "none") * below[i]).sum(1)
                    message /= message.sum()
                else:
                    sent = {c: (self.potential(n.form, n.feature, c) * below[i]).sum(1) for c in ("no", "yes")}
                    above = below[n.parent]
                    above *= np.stack([sent[_under(s)] for s in STATES[nodes[n.parent].form]], 1)
                    above /= above.max()
            up.append(message)
            belows.append(below)
        root = self.declared[declared] / self.declared[declared].sum()
        to_root = [move @ m for m in up]
        before, after = [root], [np.ones(k)]  # products of the other texts' messages
        for m in to_root[:-1]:
            before.append(before[-1] * m / m.max())
        for m in reversed(to_root[1:]):
            after.append(after[-1] * m / m.max())
        for t, (nodes, below) in enumerate(zip(texts, belows)):  # entry to texts to leaves
            others = before[t] * after[len(texts) - 1 - t]
            text = (others / others.sum()) @ move * up[t]
            text /= text.sum()
            joint: list[np.ndarray] = []
            for i, n in enumerate(nodes):
                def given(parent: str, n: Node = n, i: int = i) -> np.ndarray:
                    p = self.potential(n.form, n.feature, parent) * below[i]
                    return p / p.sum(1, keepdims=True)
                if n.parent < 0:
                    joint.append(given("none") * text[:, None])
                else:
                    no = joint[n.parent][:, 0]
                    joint.append(given("no") * no[:, None] + given("yes") * (joint[n.parent].sum(1) - no)[:, None])
                b = joint[i].sum(0)
                n.belief = dict(zip(STATES[n.form], b / b.sum()))


#: Labelled pieces of pages, by dialect: element and pattern, with W a phrase, L the lines of a list, C code, M a formula.
_PIECES: dict[str, list[tuple[str, str]]] = {
    "md": [("heading", "# W"), ("heading", "## W"), ("heading", "### W ###"), ("heading", "W\n====="), ("heading", "W\n-----"), ("list", "L- "), ("list", "L* "), ("list", "L+ "),
           ("list", "N. "), ("code", "```\nC\n```"), ("code", "~~~\nC\n~~~"), ("code", "W `C` W"), ("formula", "$$\nM\n$$"), ("formula", "W $M$ W"), ("formula", "W \\\\(M\\\\) W"),
           ("inline", "**W** W"), ("inline", "*W* W"), ("inline", "__W__ W"), ("inline", "_W_ W"), ("inline", "~~W~~ W"), ("inline", "[W](/x.html) W"), ("inline", "W ![W](x.png)"),
           ("inline", "[W][x] W"), ("inline", "W[^1] W"), ("inline", "W <br> W"), ("inline", "> W")],
    "wiki": [("heading", "== W =="), ("heading", "===W==="), ("list", "L* "), ("list", "L# "), ("list", "L*"), ("list", "L** "), ("code", "<syntaxhighlight lang=\"sh\">\nC\n</syntaxhighlight>"),
             ("code", "W <code>C</code>"), ("code", "W <source>C</source>"), ("formula", "W <math>M</math>"), ("formula", "W {{math|M}}"), ("inline", "'''W''' W"), ("inline", "''W'' W"),
             ("inline", "[[W]] W"), ("inline", "[[x|W]] W"), ("inline", "[/x W] W"), ("inline", "W<ref>x</ref>"), ("inline", "W{{要出典}} W"), ("inline", "[[File:x.jpg|thumb|W]]")],
    "rst": [("heading", "W\n========"), ("heading", "W\n~~~~~~~~"), ("heading", "W\n^^^^^^^^"), ("list", "L* "), ("list", "L- "), ("list", "L#. "), ("list", "N. "),
            ("code", "W::\n\n    C\n"), (("code"), ".. code-block:: sh\n\n    C\n"), ("code", "W ``C`` W"), ("formula", ".. math::\n\n   M\n"), ("formula", "W :math:`M` W"),
            ("inline", "**W** W"), ("inline", "*W* W"), ("inline", ":ref:`W` W"), ("inline", "`W <x.html>`_ W"), ("inline", "W [x]_ W")],
    "html": [("heading", "<h2>W</h2>"), ("heading", "<h3 id=\"s\">W</h3>"), ("list", "<ul>\n<li>W</li>\n<li>W</li></ul>"), ("list", "<ol>\n<li>W\n<li>W</ol>"), ("code", "<pre><code>C</code></pre>"),
             ("code", "W <code>C</code>"), ("formula", "W <math><mi>a</mi></math>"), ("formula", "W <i>a</i><sup>2</sup> + <i>b</i><sub>1</sub> W"), ("formula", "<span class=\"math\">\\(M\\)</span>"),
             ("inline", "<b>W</b> W"), ("inline", "<a href=\"/x\">W</a> W"), ("inline", "W&nbsp;W"), ("inline", "W<br />W"), ("inline", "<!-- x --> W"), ("inline", "<span lang=\"ja\">W</span>")],
    "tex": [("heading", "\\section{W}"), ("heading", "\\subsection*{W}"), ("list", "\\begin{itemize}\n\\item W\n\\item W\n\\end{itemize}"), ("code", "\\begin{verbatim}\nC\n\\end{verbatim}"),
            ("code", "W \\texttt{C} W"), ("code", "W \\verb|C| W"), ("formula", "\\begin{equation}\nM\n\\end{equation}"), ("formula", "W $M$ W"), ("formula", "W \\(M\\) W"), ("formula", "W \\[ M \\] W"),
            ("inline", "\\textbf{W} W"), ("inline", "\\emph{W} W"), ("inline", "{\\it W} W"), ("inline", "\\href{/x}{W} W"), ("inline", "W~\\cite{x}"), ("inline", "W\\footnote{x} W")],
    "plain": [],
}
#: Pieces of plain text that some dialect would take for markup.
_ALIKE = ["3 * 5 * 2 W", "$7 W $8 W", "5% * 3 * W", "W snake_case_name W", "__init__ W _x W", "<W> W", "x < y W y > z W", "(1) W (2) W", "{0} W", "C:\\temp\\log W", "A > B W",
          "|x| W", "a~b W", "C# W F# W", "R&D W", "W & Co. W", "-40 W", "== W", "--watch W", "~3 W", "[W] W", "2^10 W", "*1 W *2 W", "#1 W", "W #3 W", "List<u8> W", "12. W", "100. W"]
_WORDS = "route ledger token 処理 登録台帳 draft 更新保守 bench sync 管理 評価 volume 名簿 permit".split()
_CODE = ["let n = count(x);", "export a=1", "x = open('a.tsv')", "if (a > 3) { stop(); }"]
_MATH = ["x^{2} + y^2", "\\sum_{i=1}^{4} c_i", "k \\log n + 6", "\\alpha_1 \\le \\beta", "\\frac{a}{b}"]


def _piece(pattern: str, r: random.Random, inside: list[tuple[str, str]] = ()) -> tuple[str, list[tuple[int, int, str]]]:
    """A piece's text, and place and element of the markup put inside its phrases."""
    def w() -> str:
        words = " ".join(r.choice(_WORDS) for _ in range(r.randint(1, 3)))
        if not inside or r.random() > 0.25:
            return words
        element, p = r.choice(inside)
        return f"{words} \ue000{ELEMENTS.index(element)}{_piece(p, r)[0]}\ue001 {words}"

    if pattern[0] in "LN" and len(pattern) <= 4:
        n = r.randint(2, 5)
        out = "\n".join(f"{i + 1}{pattern[1:]}{w()}" if pattern[0] == "N" else pattern[1:] + w() for i in range(n))
    else:
        out = pattern.replace("C", "\0", 1) if re.search(r"C(?![:#])", pattern) and "Co." not in pattern else pattern
        out = out.replace("M", "\1", 1) if "M" in out else out
        out = re.sub("W", lambda _: w(), out).replace("\0", r.choice(_CODE)).replace("\1", r.choice(_MATH))
    text, places = "", []
    for i, part in enumerate(re.split("\ue000|\ue001", out)):
        if i % 2:
            places.append((len(text), len(text) + len(part) - 1, ELEMENTS[int(part[0])]))
            part = part[1:]
        text += part
    return text, places


@lru_cache(maxsize=1)
def trained(pages: int = 400, seed: int = 11) -> Model:
    """The tables, counted on `pages` labelled pages of each dialect."""
    model, r = Model(), random.Random(seed)
    for d, dialect in enumerate(DIALECTS):
        # what stands inside the phrases of others: the pieces that are one span among words, without these
        inside = [(e, p.removeprefix("W ").removesuffix(" W")) for e, p in _PIECES[dialect]
                  if e in ("inline", "code", "formula") and "\n" not in p and (p.startswith("W ") or p.endswith(" W")) and not p.startswith(">")]
        for _ in range(pages):
            declared = dialect if r.random() < 0.8 else r.choice([*DIALECTS, "any", "none"])
            declared = "any" if r.random() < 0.15 else declared
            parts, spans, at = [], [], 0
            for _ in range(r.randint(1, 4)):
                element, text, phrases = "no", r.choice(_ALIKE), ()
                if _PIECES[dialect] and r.random() < 0.6:
                    element, text = r.choice(_PIECES[dialect])
                    phrases = inside if element in ("heading", "list") or element == "inline" and text.count("W") == 2 else ()
                elif r.random() < 0.4:
                    text = "W"
                s, places = _piece(text, r, phrases)
                spans.append((at, at + len(s), element))
                spans += [(at + a, at + b, e) for a, b, e in places]
                parts.append(s)
                at += len(s) + 2
            nodes = parse("\n\n".join(parts))
            state = []
            for n in nodes:  # the smallest labelled piece around it
                _, e = min(((b - a, e) for a, b, e in spans if a <= n.start < b and n.end <= b + 1), default=(0, "no"))
                state.append(e if e in STATES[n.form] else "no")
            model.count(declared, d, [(n, s, "none" if n.parent < 0 else _under(state[n.parent])) for n, s in zip(nodes, state)])
    return model


def judged(declared: str | None, texts: list[str]) -> list[list[Node]]:
    """Candidates of an entry's texts with their beliefs."""
    parsed = [parse(t) for t in texts]
    trained().infer(DECLARED.get((declared or "").strip().lower(), "none"), parsed)
    return parsed


def kind(n: Node, cut: float = 0.5) -> str | None:
    """The node's element if its marginal is over cut."""
    state = max(n.belief, key=n.belief.get)
    return state if state != "no" and n.belief[state] > cut else None


def clean(text: str, nodes: list[Node], cut: float = 0.5) -> str:
    """Plain text: headings as '# ', list items as '- ', code in backticks, formulas in dollar signs, other markup taken off."""

    inside: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(nodes):
        inside[n.parent].append(i)

    def inner(a: int, b: int, parent: int) -> str:
        out, at = [], a
        for i in inside[parent]:
            n = nodes[i]
            if n.start < max(at, a) or n.end > b:
                continue
            out.append(text[at : n.start])
            out.append(render(i, n))
            at = n.end
        out.append(text[at:b])
        return "".join(out)

    def render(i: int, n: Node) -> str:
        e = kind(n, cut)
        whole = inner(n.start, n.end, i)
        if e is None:
            return whole
        begin = text.find(n.content, n.start, n.end) if inside[i] and e in ("heading", "inline") else -1
        content = inner(begin, begin + len(n.content), i) if begin >= 0 else n.content
        if e == "code":
            body = html.unescape(n.content.strip("\n")) if n.form in ("pre", "codetag") else "\n".join(x.strip() for x in n.content.strip("\n").split("\n")) if n.form in ("literal", "coderst") else n.content
            head = ":\n\n" if n.form == "literal" and text[n.start : n.start + 2] == "::" and n.start and not text[n.start - 1].isspace() else ""
            return head + (f"```\n{body.strip()}\n```" if n.block or "\n" in body.strip() else f"`{body.strip()}`")
        if e == "formula":
            body = html.unescape(re.sub(r"<[^<>]+>", "", n.content)).strip() if n.form in ("mathtag", "mathhtml", "mathspan") else n.content.strip()
            body = re.sub(r"^\\\\?[(\[]|\\\\?[)\]]$", "", body).strip()
            return f"$$\n{body}\n$$" if n.block else f"${body}$"
        if e == "heading":
            t = re.sub(r"^#+\s*|\s+#+\s*$", "", whole.strip()) if n.form == "hashes" else content
            return "# " + re.sub(r"<[^<>]+>", "", t).strip()
        if e == "list":
            body = re.sub(r"</?(?:ul|ol|dl|menu|dd)\b[^<>]*>|</(?:li|dt|dd)>", "", whole, flags=re.I)
            body = re.sub(r"\s*<(?:li|dt)\b[^<>]*>\s*", "\n- ", body, flags=re.I)
            body = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?", "", body)
            body = re.sub(r"\s*\\item\b\s*(?:\[[^\]]*\])?", "\n- ", body)
            body = re.sub(r"(?m)^[ \t]*(?:#\.|\(?\d{1,3}[.)]|[-*+•](?=\s)|[*#:;]+)[ \t]*", "- ", body) if n.form not in ("listtag", "listtex") else body
            return "\n".join(x.rstrip() for x in body.split("\n") if x.strip(" -"))
        if n.form == "entity":
            return html.unescape(n.belief and text[n.start : n.end])
        if n.form in ("tag", "comment", "ref", "rule", "footref", "directive", "texenv", "template", "rstref", "break", "tablerow"):
            return "\n" if n.form == "tag" and re.match(r"<br", text[n.start : n.end], re.I) else ""
        if n.form == "texcmd" and re.match(r"~?\\(?:cite|ref|eqref|pageref|label|index|footnote)", text[n.start : n.end]):
            return ""
        return content

    return re.sub(r"\n{3,}", "\n\n", inner(0, len(text), -1)).strip()


def _texts(msgid: str | None, msgstrs: list[str | None] | None) -> tuple[list[str], list[int]]:
    all_texts = [msgid, *(msgstrs or [])]
    kept = [i for i, t in enumerate(all_texts) if t and t.strip()]
    header = not (msgid or "").strip() and any(t and re.match(r"[\w-]+:[^\n]*\n", t) for t in msgstrs or [])
    return ([], []) if header else ([all_texts[i] for i in kept], kept)


_IN = ("entry_id", "declared", "msgid", "msgstrs")


def _run(clean_too: bool, cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, elements, masses, texts_out = [], [], [], []
            for i, f, m, ms in zip(*(b.column(k).to_pylist() for k in range(4))):
                texts, where = _texts(m, ms)
                parsed = judged(f, texts)
                best: dict[str, float] = {}
                for nodes in parsed:
                    for n in nodes:
                        if e := kind(n, cut):
                            best[e] = max(best.get(e, 0), n.belief[e])
                if clean_too:
                    out = [m, *(ms or [])]
                    for w, t, nodes in zip(where, texts, parsed):
                        out[w] = clean(t, nodes, cut)
                    ids.append(i)
                    elements.append(sorted(best))
                    texts_out.append(out)
                else:
                    for e, p in sorted(best.items()):
                        ids.append(i)
                        elements.append(e)
                        masses.append(p)
            if clean_too:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[0] for x in texts_out], pa.string()),
                                                  pa.array([x[1:] for x in texts_out], pa.list_(pa.string())), pa.array(elements, pa.list_(pa.string()))],
                                                 names=["entry_id", "msgid", "msgstrs", "elements"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(elements, pa.string()), pa.array(masses, pa.float64())],
                                                 names=["entry_id", "element", "probability"])
    return run


def _entries(entries: DataFrame, sources: DataFrame) -> DataFrame:
    declared = sources.where("source_name is not null").groupBy("source_name").agg(F.min("file_format").alias("declared"))
    e = entries.where("entry_id is not null").select("entry_id", "source_name", "msgid", "msgstrs").distinct()
    return e.join(declared, "source_name", "left").select(*_IN)


def elements(entries: DataFrame, sources: DataFrame, cut: float = 0.5) -> DataFrame:
    """entry_id, element, probability of every kind of markup in the entry's msgid or any of its msgstrs.

    The source's declared format is one clue among others. Null, empty and blank texts hold none, header entries (empty
    msgid, header lines as msgstr) neither; exact repeats come out once.
    """
    found = _entries(entries, sources).mapInArrow(_run(False, cut), "entry_id bigint, element string, probability double")
    return found.groupBy("entry_id", "element").agg(F.max("probability").alias("probability"))


def cleaned(entries: DataFrame, sources: DataFrame, cut: float = 0.5) -> DataFrame:
    """entry_id, msgid, msgstrs, elements: every entry's texts without markup, in one plain notation for what is kept."""
    return _entries(entries, sources).mapInArrow(_run(True, cut), "entry_id bigint, msgid string, msgstrs array<string>, elements array<string>")
