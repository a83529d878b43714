"""Markup, repeated lines, sentences, leaks, mixing and content scores."""

import itertools
import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from lexstat.llm import abuse, leakage, markup, mixing, repeated_lines, sentences

T0 = datetime(2026, 1, 1)
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# --- markup


@pytest.mark.parametrize("fmt,text,kinds", [
    ("md", "# Title\n\ntext", {"heading"}), ("md", "Title\n====\n\ntext", {"heading"}), ("md", "- a b\n- c d", {"list"}), ("md", "Run `x = 1` once.", {"code"}),
    ("md", "```sh\nls *a*\n```", {"code"}), ("md", "Here $x^{2}$ holds.", {"formula"}), ("md", "a **b c** d [e](f.html)", {"inline"}),
    ("wiki", "== Title ==", {"heading"}), ("wiki", "# one thing\n# two things\n# three", {"list"}), ("wiki", "a '''b''' [[c|d]]<ref>x</ref>", {"inline"}), ("wiki", "<math>x</math>", {"formula"}),
    ("rst", "Title\n~~~~~~~~\n\ntext :ref:`x`", {"heading", "inline"}), ("rst", "So::\n\n    let n = 1\n", {"code"}), ("rst", ".. math::\n\n   x + y\n", {"formula"}),
    ("html", "<h2>T</h2>\n<ul>\n<li>a</li>\n</ul>", {"heading", "list"}), ("html", "<pre><code>a &lt; b</code></pre> x&nbsp;y", {"code", "inline"}),
    ("tex", "\\section{T}\\label{x}\n\\begin{itemize}\n\\item a\n\\end{itemize} $k \\le n$", {"heading", "list", "formula"}), ("tex", "\\emph{a} and \\verb|b|", {"inline", "code"}),
    ("po", "*a b* is kept", {"inline"}), (None, "\\textbf{a}", {"inline"}),
])
def test_markup_is_found(fmt, text, kinds):
    assert {markup.kind(n) for n in markup.judged(fmt, [text])[0]} - {None} == kinds


@pytest.mark.parametrize("fmt", ["md", "wiki", "rst", "html", "tex", "txt", "po", None])
@pytest.mark.parametrize("text", [
    "$7 and $8 differ", "3 * 5 * 2 is 30", "snake_case_name stays", "(1) and (2) the rule", "C:\\temp\\log is it", "A > B and x < y and y > z", "|x| is 26", "a~b の範囲",
    "C# と F# の結合", "R&D and Smith & Co. are", "-40 度の", "== で比べて", "<名前> の欄に", "{0} or none", "#13 の手順で", "List<u8> のような型", "", " ",
])
def test_lookalikes_are_not_markup(fmt, text):
    assert {markup.kind(n) for n in markup.judged(fmt, [text])[0]} <= {None}


@pytest.mark.parametrize("texts", [["# a *b* c", "*e* f"], ["[**b** `c`](/x.html) t"], ["**[W link](x.html)** t", "*d*"]])
def test_messages_sum_to_the_joint(texts):
    """Marginals of a small tree equal those from enumerating all assignments."""
    m = markup.trained()
    texts = [markup.parse(t) for t in texts]
    m.infer("any", texts)
    k = len(markup.DIALECTS)
    root = m.declared["any"] / m.declared["any"].sum()
    move = np.full((k, k), (1 - m.same) / (k - 1))
    np.fill_diagonal(move, m.same)
    total, part = 0.0, defaultdict(float)
    every = [(t, i) for t, nodes in enumerate(texts) for i in range(len(nodes))]
    assert any(texts[t][i].parent >= 0 for t, i in every)
    for d in range(k):
        for dialects in itertools.product(range(k), repeat=len(texts)):
            for states in itertools.product(*(range(len(markup.STATES[texts[t][i].form])) for t, i in every)):
                at = dict(zip(every, states))
                v = root[d] * math.prod(move[d, x] for x in dialects)
                for (t, i), q in at.items():
                    n = texts[t][i]
                    parent = "none" if n.parent < 0 else "no" if at[t, n.parent] == 0 else "yes"
                    v *= m.states(n.form, n.feature, parent)[dialects[t], q] * m.likelihood(n.form, parent)[dialects[t]]
                total += v
                for key, q in at.items():
                    part[key, q] += v
    for t, nodes in enumerate(texts):
        for i, n in enumerate(nodes):
            for q, s in enumerate(markup.STATES[n.form]):
                assert n.belief[s] == pytest.approx(part[(t, i), q] / total, abs=1e-9)


def test_what_a_node_holds_speaks_for_it():
    m = markup.trained()
    nodes, alone = markup.parse("# a **b** c"), markup.parse("# a b c")
    assert [n.form for n in nodes] == ["hashes", "strong"] and nodes[1].parent == 0
    m.infer("any", [nodes])
    m.infer("any", [alone])
    assert nodes[0].belief["heading"] > alone[0].belief["heading"]


@pytest.mark.parametrize("text,want", [
    ("**[W link](x.html)** tail", "W link tail"), ("[**bold**](x.html) tail", "bold tail"), ("**bold** Head\n=====\n\ntext", "# bold Head\n\ntext"),
    ("# a **b** `c`\n\nd", "# a b `c`\n\nd")])
def test_nested_markup_leaves_no_residue(text, want):
    assert markup.clean(text, markup.judged("md", [text])[0]) == want


def test_long_texts_take_time_in_proportion():
    import time
    piece = "Some **bold *and* more** text with [a **b** c](/x.html) and `code`.\n\n- one\n- two\n\n"
    times = []
    for n in (50, 400):
        began = time.process_time()
        markup.judged("md", [piece * n])
        times.append(time.process_time() - began)
    assert times[1] < 24 * max(times[0], 0.02)


def test_clean_text_keeps_structure():
    t = "# Title\n\nSome **bold** and `code` with $x^2$.\n\n- one\n- two\n\n```\nls\n```"
    out = markup.clean(t, markup.judged("md", [t])[0])
    assert out == "# Title\n\nSome bold and `code` with $x^2$.\n\n- one\n- two\n\n```\nls\n```"
    h = "<h2>T</h2>\n\n<ul>\n<li>a</li>\n<li>b</li></ul>\n\nx&nbsp;<b>y</b>"
    assert markup.clean(h, markup.judged("html", [h])[0]) == "# T\n\n- a\n- b\n\nx\xa0y"


def test_entries(spark):
    e = spark.createDataFrame([(1, "s", "# A", ["*b c* d", None, ""], "x"), (1, "s", "# A", ["*b c* d", None, ""], "x"), (2, "s", "", ["Project-Id-Version: x\nContent-Type: y\n"], "x"), (3, None, None, None, "x"),
                               (4, "t", "plain", ["x" * 200_000], "x"), (None, "s", "# A", [], "x")], "entry_id bigint, source_name string, msgid string, msgstrs array<string>, declared string")
    s = spark.createDataFrame([("s", "MD"), ("s", "md"), (None, "md")], "source_name string, file_format string")
    assert {(r["entry_id"], r["element"]) for r in markup.elements(e, s).collect()} == {(1, "heading"), (1, "inline")}
    c = {r["entry_id"]: r["msgstrs"] for r in markup.cleaned(e, s).collect()}
    assert c[1] == ["b c d", None, ""] and c[3] is None or c[3] == []
    assert markup.elements(e.limit(0), s.limit(0)).collect() == []


# --- repeated lines

ART = "page_id bigint, source_name string, text string, fetched_at timestamp, loaded_at timestamp, chunk string, line_no int"


def test_repeated_lines_against_brute_force(spark):
    r = random.Random(8)
    notices = ["© 123 All rights reserved", "この記事を共有する", "短い", "広告"]
    rows = []
    for p in range(240):
        src = "hot" if r.random() < 0.4 else r.choice(["a", "b", None, "rare"])
        lines = ["本文" + "".join(r.choice("亜位宇江尾化木区毛古") for _ in range(r.randint(0, 30))) for _ in range(3)]
        if r.random() < 0.3:
            lines.insert(r.randint(0, 3), r.choice(notices).replace("123", str(p)))
        rows.append((p, src, "\n".join(lines + ["", "12 3!"]), T0 + timedelta(hours=p % 5), T0, "x", 1))
        if r.random() < 0.3:
            rows.append((p, src, "この記事を共有する", T0 - timedelta(hours=1), T0, "x", 1))
    rows += rows[:50] + [(900, "a", None, T0, T0, "x", 1), (901, "a", "", T0, T0, "x", 1), (None, "a", "z", T0, T0, "x", 1)]
    last = {}
    for p, s, t, f, *_ in rows:
        if p is not None and (p not in last or f > last[p][2]):
            last[p] = (s, t, f)
    pages, n = defaultdict(set), Counter()
    for p, (s, t, _) in last.items():
        if s is not None and t:
            n[s] += 1
            for x in t.split("\n"):
                if k := repeated_lines.line_letters(x):
                    pages[s, k].add(p)
    want = {(p, i) for p, (s, t, _) in last.items() if s is not None and t for i, x in enumerate(t.split("\n"))
            if (k := repeated_lines.line_letters(x)) and len(pages[s, k]) >= 3 and len(pages[s, k]) >= 0.06 * n[s]}
    df = spark.createDataFrame(rows, ART)
    got = {(x["page_id"], x["line_no"]) for x in repeated_lines.repeated_lines(df).collect()}
    assert got == want and want
    for x in repeated_lines.without_repeated_lines(df).collect():
        t = last[x["page_id"]][1]
        assert x["text"] == (t and "\n".join(y for i, y in enumerate(t.split("\n")) if (x["page_id"], i) not in want))
    assert repeated_lines.repeated_lines(df.limit(0)).collect() == []


def test_frequent_tables_too_large_to_broadcast_give_the_same(spark, monkeypatch):
    rows = [(i, "s", f"shared line {i % 3}\nown {'abcdefghij'[i % 10] * (i + 1)}", None, None) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id bigint, source_name string, text string, fetched_at timestamp, loaded_at timestamp")
    want = sorted(map(tuple, repeated_lines.repeated_lines(df).collect()))
    monkeypatch.setattr(repeated_lines, "BROADCAST_ROWS", 0)
    assert want and sorted(map(tuple, repeated_lines.repeated_lines(df).collect())) == want


def test_chunks_depend_on_the_line_alone():
    r = random.Random(1)
    line = "".join(r.choice("abcdefghij") for _ in range(80))
    alone = repeated_lines.chunk_lines([line])[1].tolist()
    of, hashes, keys = repeated_lines.chunk_lines(["x", "yz", line, "w" * 5000, "q"])
    assert hashes[of == 2].tolist() == alone and len(alone) > 1
    assert len(set(keys.tolist())) == 5


# --- sentences


@pytest.mark.parametrize("text,units", [
    ("一つ目。二つ目！！三つ目", ["一つ目。", "二つ目！！", "三つ目"]),
    ("彼は「行く。帰る。」と言った。次。", ["彼は「行く。帰る。」と言った。", "次。"]),
    ("「行く。帰る。」次の文。", ["「行く。帰る。」", "次の文。"]),
    ("本文（図 4.8 を参照。）。次だ。", ["本文（図 4.8 を参照。）。", "次だ。"]),
    ("まとめる．約１．５倍だ．", ["まとめる．", "約１．５倍だ．"]),
    ("No. 3 の事例では、Tarn.js 版を使う。St. ノルカ港だ。", ["No. 3 の事例では、Tarn.js 版を使う。", "St. ノルカ港だ。"]),
    ("見出し\n\n・項目\n本文だ。", ["見出し", "・項目", "本文だ。"]),
    ("Dr. A. Smith met Mr. Poe at 5 p.m. He left, e.g. by 3.5 percent. xTerra did too.", ["Dr. A. Smith met Mr. Poe at 5 p.m.", "He left, e.g. by 3.5 percent.", "xTerra did too."]),
    ('He asked, "Is it done?" and left. "It is. Really." Yes.', ['He asked, "Is it done?" and left.', '"It is. Really."', "Yes."]),
    ("Am 3. Oktober prüft Dr. Roth, z. B. den 5. Band. Ende!", ["Am 3. Oktober prüft Dr. Roth, z. B. den 5. Band.", "Ende!"]),
    ("La revue, p. ex. celle-ci, lit le t. 4 ? Oui « la table. Rien » ! Fin.", ["La revue, p. ex. celle-ci, lit le t. 4 ?", "Oui « la table. Rien » !", "Fin."]),
    ("编辑说：“更新全部。请再看。”编号 3.5 的索引。", ["编辑说：“更新全部。请再看。”", "编号 3.5 的索引。"]),
    ("डॉ. नरोल देखता है। यह 2.5 है?", ["डॉ. नरोल देखता है।", "यह 2.5 है?"]),
    ("د. سالم يراجع. نحو 3.5 طن؟ نعم!", ["د. سالم يراجع.", "نحو 3.5 طن؟", "نعم!"]),
    ("ระบบใหม่บันทึกร้อยละ2.1 เอกสารนี้จัดเก็บ", ["ระบบใหม่บันทึกร้อยละ2.1", "เอกสารนี้จัดเก็บ"]),
    ("残す。」と答えた。次", ["残す。」と答えた。", "次"]), ("", []), (None, []), (" \n\u3000\n", []), ("a\r\nb", ["a", "b"]), ("...", ["..."]), ("「" * 50, ["「" * 50]),
])
def test_sentences(text, units):
    assert [text[s:e] for s, e in sentences.sentence_spans(text)] == units


def test_sentence_spans_cover_all_but_blanks():
    r = random.Random(4)
    for _ in range(300):
        t = "".join(r.choice("ab .。！？「」\"()（）\n\u3000Aあ1ก“”„«»…—") for _ in range(40))
        spans = sentences.sentence_spans(t)
        kept = "".join(t[s:e] for s, e in spans)
        assert "".join(kept.split()) == "".join(t.split())
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("text,lang,n", [
    ("Das gilt z.B. Hans und den Kindern. Ende.", None, 2), ("Das gilt z.B. Hans. Ende.", "de", 2), ("The report of Hr. Smith is in the file. Fine.", "en", 3),
    ("Der Bericht des Hr. Smith ist nicht da. Gut.", None, 2), ("Le rapport de M. Roux et la note p.ex. Jean. Fin.", "fr", 2)])
def test_abbreviations_are_those_of_the_language(text, lang, n):
    assert len(sentences.sentence_spans(text, lang)) == n


def test_break_rules_use_character_properties():
    spans = lambda t: [t[a:b] for a, b in sentences.sentence_spans(t)]
    assert spans("৩.৫ kg ok। নতুন") == ["৩.৫ kg ok।", "নতুন"]  # SB6 with Bengali digits
    assert spans("የመጀመሪያ። ሁለተኛ።") == ["የመጀመሪያ።", "ሁለተኛ።"]  # Ethiopic full stops
    assert spans("Որ։ Նոր") == ["Որ։", "Նոր"]  # Armenian
    assert spans("Он ушёл. она осталась. Да") == ["Он ушёл. она осталась.", "Да"]  # SB8 in Cyrillic
    long = "Word " * 40_000 + ". End"
    assert len(spans(long)) == 2


def test_unit_texts(spark):
    a = spark.createDataFrame([(1, "旧。版。", T0, T0, None), (1, "新。版。", T0 + timedelta(days=1), T0, None), (2, None, T0, T0, None), (None, "x", T0, T0, None)],
                              "page_id bigint, text string, fetched_at timestamp, loaded_at timestamp, source_name string")
    o = spark.createDataFrame([(1, "一。二"), (1, "一。二"), (2, None), (None, "x")], "occ_id bigint, excerpt string")
    rows = sentences.sentences(sentences.unit_texts(a, o)).collect()
    assert sorted((r["field"], r["rec_id"], r["start_pos"], r["sentence"]) for r in rows) == [("article", 1, 0, "新。"), ("article", 1, 2, "版。"), ("occurrence", 1, 0, "一。"), ("occurrence", 1, 2, "二")]


# --- leaks


def test_leaks(spark):
    r = random.Random(9)
    text = lambda n: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(n))
    items = {i: text(120) for i in range(20)}
    noise = lambda: text(400)
    typo = lambda t: t[:30] + "々" + t[31:70] + t[71:]
    docs = [(0, noise() + items[0] + noise()), (1, noise() + typo(items[1])), (2, items[2][:70] + noise() + items[3][:40]), (3, "\n".join(items[4][i : i + 9] for i in range(0, 120, 9))),
            (4, items[5][:35] + noise() + items[5][60:100]), (5, None), (6, ""), (7, noise() * 20), (8, noise() + "短い項目だ" + noise()), (None, items[0])]
    short = [(50, "短い項目だ。"), (51, "ないよ"), (52, ""), (53, None), (None, items[6])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([*items.items(), *short, (0, items[0])], "item_id bigint, text string")
    got = {(x["doc_id"], x["item_id"]) for x in leakage.leaks(d, i).collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (3, 4), (4, 5), (8, 50)}
    assert leakage.leaks(d, i.limit(0)).collect() == [] and leakage.leaks(d.limit(0), i).collect() == []


def test_short_items_are_found_in_part(spark):
    items = [(1, "abcdefghij"), (2, "短い文です"), (3, "ab"), (4, "zyxwvutsrqp"), (5, "!?")]
    docs = [(1, "00 abcdefghix 00"), (2, "xx短い文でしたxx"), (3, "a b"), (4, "zyxwvX tsrqp"), (5, "abcd efXXX"), (6, "zyxw"), (7, ""), (8, "fghij and abcde")]
    df = spark.createDataFrame
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in leakage.leaks(df(docs, "doc_id bigint, text string"), df(items, "item_id bigint, text string")).collect()}

    def plain(doc, item):
        d, t = leakage.letters(doc), leakage.letters(item)
        n = min(len(t), max(4, -(-len(t) // 2)))
        held = {j for i in range(len(t) - n + 1) if t[i : i + n] in d for j in range(i, i + n)} if t else set()
        return len(held) / len(t) if t else 0

    want = {(i, k): plain(d, t) for i, d in docs for k, t in items if plain(d, t) >= 0.5}
    assert got == pytest.approx(want) and want[1, 1] == 0.9 and (8, 1) in want and (6, 4) not in want


def test_no_pair_over_the_cut_is_lost_before_the_exact_check():
    import pyarrow as pa
    r = random.Random(11)
    text = lambda n: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(n))
    items = [(i, text(r.randint(100, 300))) for i in range(30)] + [(30, text(18))]
    docs = [text(r.randrange(40)) + "".join("々" if k % n == n - 1 else c for k, c in enumerate(t)) + text(50) for n in (14, 15, 16, 17, 18) for _, t in items[:30]]
    docs += ["".join(t[k : k + n] + text(r.randint(5, 9)) for k in range(0, len(t), n)) for n in (12, 13, 15, 18) for _, t in items[:30]]
    docs.append(text(31) + items[30][1][3:15] + text(20))
    b = pa.RecordBatch.from_pydict({"doc_id": list(range(len(docs))), "text": docs})
    got = {(x["doc_id"], x["item_id"]) for x in next(leakage._search(items, 0.5)([b])).to_pylist()}
    assert got >= {(d, d % 30) for d in range(270)} | {(270, 30)}
    index = leakage._Index(items)
    shingles = [np.sort(leakage._grams(leakage._codes(t), leakage.SHINGLE)) for t in docs]
    assert got == {(d, o) for d, g in enumerate(shingles) for o in range(len(items)) if index.similarity(o, g) >= 0.5}


def test_item_blocks_give_the_same(spark, monkeypatch):
    items = [(i, "".join(chr(0x4E00 + (i * 97 + k * 31) % 5000) for k in range(80))) for i in range(9)]
    d = spark.createDataFrame([(1, items[2][1] + items[7][1])], "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 170)
    assert {x["item_id"] for x in leakage.leaks(d, i).collect()} == {2, 7}


def test_long_documents_are_searched_to_the_end(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK", 64)
    items = [(i, "".join(chr(0x4E00 + (i * 977 + k * 31) % 5000) for k in range(80))) for i in range(4)]
    noise = "".join(chr(0x4E00 + (k * k * 7 + k) % 6000) for k in range(3000))
    d = spark.createDataFrame([(1, noise + items[1][1] + noise[:501] + items[3][1]), (2, items[0][1][:79])], "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(x["doc_id"], x["item_id"]) for x in leakage.leaks(d, i).collect()} == {(1, 1), (1, 3), (2, 0)}


def test_pieces_hold_every_row_once():
    import pyarrow as pa
    from lexstat.llm._batches import pieces
    b = pa.RecordBatch.from_pydict({"t": ["", None, "a" * 50, "b" * 500, "c", "d" * 99, "e"] * 3})
    out = list(pieces(b, 0, chars=100, rows=4))
    assert [x for p in out for x in p.column(0).to_pylist()] == b.column(0).to_pylist()
    assert all(len(p) <= 4 and (len(p) == 1 or sum(len(x or "") for x in p.column(0).to_pylist()) <= 100) for p in out)
    assert list(pieces(b.slice(0, 0), 0)) == []


def test_all_fingerprints_within_the_radius_are_found():
    r = np.random.default_rng(0)
    index = leakage._Index([(k, "".join(chr(0x4E00 + c) for c in r.integers(0, 4000, 60))) for k in range(5)])
    base = index.fp[::7]
    probes = np.array([int(f) ^ sum(1 << int(b) for b in r.choice(64, size=n, replace=False)) for n in (0, 1, 2, 3, 4) for f in base], dtype=np.uint64)
    i, k = index.near(probes)
    want = {(a, b) for a in range(len(probes)) for b in range(len(index.fp)) if bin(int(probes[a]) ^ int(index.fp[b])).count("1") <= leakage.RADIUS}
    assert set(zip(i.tolist(), k.tolist())) == want and len(i) == len(want)


# --- mixing


def test_allotment():
    t = [("a", 0.5, None), ("b", 0.3, 2), ("c", 0.2, 1), ("d", 0.0, 1)]
    out = mixing.allot(t, {"a": 100, "b": 10, "c": 100, "d": 5}, 100)
    assert out["b"] == 20 and out["d"] == 0 and sum(out.values()) == pytest.approx(100)
    assert out["a"] / out["c"] == pytest.approx(2.5)
    assert mixing.allot(t, {}, 100) == {"a": 0, "b": 0, "c": 0, "d": 0}


def test_mix(spark):
    r = random.Random(3)
    docs = [(i, "Big " if r.random() < 0.5 else r.choice(["big", "small", "ＭＩＤ", None, "other"]), "word " * r.randint(0, 40)) for i in range(600)] + [(700, "small", None), (None, "big", "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    t = spark.createDataFrame([("big", 0.4, 3), ("mid", 0.3, None), ("small", 0.3, 1), ("absent", 0.1, None), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    p = mixing.plan(d, t, TOKENIZER, total_tokens=9000, block_tokens=64)
    rows = mixing.mixed(p).collect()
    drawn, blocks, held = Counter(), defaultdict(Counter), defaultdict(list)
    copies = defaultdict(set)
    for x in rows:
        drawn[x["source"]] += x["tokens"]
        blocks[x["source"]][x["block"]] += x["tokens"]
        copies[x["doc_id"]].add(x["copy"])
        held[x["doc_id"], x["copy"]].append((x["first_token"], x["first_token"] + x["tokens"]))
        assert x["block"] == x["at"] // 64 and x["tokens"] > 0
    for spans in held.values():  # the pieces of a copy follow one another
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for b in blocks.values():  # all blocks but the last are full
        assert set(b) == set(range(len(b))) and all(b[i] == 64 for i in range(len(b) - 1)) and b[len(b) - 1] <= 64
    assert len({(x["slot"], x["source"], x["block"]) for x in rows}) == len({x["slot"] for x in rows}) == sum(map(len, blocks.values()))
    rep = {x["source"]: x for x in mixing.shares(p).collect()}
    assert set(rep) == {"big", "mid", "small", "absent"}
    for s, x in rep.items():
        assert x["drawn_tokens"] == drawn[s] and (x["max_repeats"] is None or x["repeats"] <= x["max_repeats"])
        assert abs(drawn[s] - p.draw[s]) <= 0.5
    assert sum(x["share"] for x in rep.values()) == pytest.approx(1)
    assert all(s == set(range(len(s))) for s in copies.values())
    slots = [x["source"] for x in p.slots().orderBy("slot").collect()]
    half = Counter(slots[: len(slots) // 2])
    whole = Counter(slots)
    assert all(abs(half[s] - whole[s] / 2) <= 4 for s in whole)
    empty = mixing.plan(d.limit(0), t, TOKENIZER)
    assert mixing.mixed(empty).collect() == [] and all(x["share"] == 0 for x in mixing.shares(empty).collect())


def test_late_blocks_have_slots_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(mixing.Plan, "n_slots", staticmethod(lambda need: 5))
    d = spark.createDataFrame([(i, "ab"[i % 2], "word " * 30) for i in range(40)], "doc_id bigint, source string, text string")
    t = spark.createDataFrame([("a", 0.5, None), ("b", 0.5, None)], "source string, target_share double, max_repeats int")
    rows = mixing.mixed(mixing.plan(d, t, TOKENIZER, block_tokens=50)).collect()
    slots = {(x["source"], x["block"]): x["slot"] for x in rows}
    assert len(set(slots.values())) == len(slots)
    for s in "ab":
        assert [slots[s, b] for b in range(5)] == sorted(slots[s, b] for b in range(5))


# --- content scores


def corpus(n=240, seed=2):
    r = random.Random(seed)
    plain = ["この章では設定を見直す。", "The draft keeps the form.", "処理を記録する。", "ゴミ集めの処理が領域を解放する。", "The table is read by hand."]
    bad = {"abusive": ["お前はゴミだ、消えろ。", "you are a complete idiot"], "sexual": ["裸の二人が絡み合った。", "she moaned naked in bed"]}
    texts, y = [], []
    for _ in range(n):
        parts = [r.choice(plain) for _ in range(r.randint(3, 25))]
        label = r.choice([None, None, "abusive", "sexual"])
        if label:
            parts.insert(r.randrange(len(parts)), r.choice(bad[label]))
        texts.append("".join(parts))
        y.append([float(label == c) for c in abuse.CATEGORIES])
    return texts, np.array(y, np.float32)


def test_network_learns_and_finds_windows():
    import pyarrow as pa
    texts, y = corpus()
    model = abuse.train(texts[:180], y[:180])
    b = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts[180:]})
    out = next(iter(abuse._score(model)([b])))
    s = np.stack([out.column(i).to_numpy() for i in (1, 2, 3)], 1)
    assert ((s > 0.5) == (y[180:] > 0.5)).mean() > 0.95


def test_gradients_match_differences():
    words = ["a", "bb", "ccc", "死ね"]
    model = abuse.Model(words, sorted({g for w in words for g in abuse.grams(w)}), 3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    feats = [model.features(t) for t in words]
    ids, doc = abuse._windows([np.array([1, 2, 3, 4] * 12), np.array([2, 2])])
    target = np.array([[1.0, 0, 0], [0, 1, 0]])

    def loss():
        hs = model.states(model.project(model.embed(feats)), ids)
        logit = model.attend(hs, ids > 0)[3].astype(float)
        z = np.stack([np.log(np.exp(logit[doc == d]).sum(0)) for d in range(2)])
        return float((np.log1p(np.exp(z)) - target * z).sum() / 2)

    g = model.gradients(feats, ids, doc, target)
    for name, at in (("uf", (3, 20)), ("wb", (2, 5)), ("wo", (4, 1)), ("wa", (7, 2)), ("va", (1, 0)), ("va", (2, 1)), ("bf", (30,))):
        old, eps = model.p[name][at], 1e-3
        model.p[name][at] = old + eps
        up = loss()
        model.p[name][at] = old - eps
        down = loss()
        model.p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / (2 * eps), rel=0.05, abs=2e-4)
    rows, dx = g["word"]
    w = feats[1][0]
    old = model.p["word"][w, 3]
    model.p["word"][w, 3] = old + 1e-3
    up = loss()
    model.p["word"][w, 3] = old - 1e-3
    down = loss()
    assert dx[list(rows).index(w), 3] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-4)


def test_words_embedded_at_once_are_as_one_by_one():
    words = ["a", "死ね", "12345", "7", "abc", "くたばれ", "𠮷野", "xy", "ab"]
    for known in ([], words[:6]):
        model = abuse.Model(known, sorted({g for w in known for g in abuse.grams(w)}), 3)
        assert np.allclose(model.embed_words(words), model.embed([model.features(w) for w in words]), atol=1e-6)


def test_tokens_close_up_disguises():
    assert abuse.tokens("you are a c.o.m.p.l.e.t.e idiooooot!!") == ["you", "are", "a", "complete", "idiot", "!", "!"]
    assert abuse.tokens("喘．ぎ ｸｽﾞ") == ["喘", "ぎ", "クズ"]
    assert abuse.tokens("") == []


def test_normalization_of_parts_is_that_of_the_whole():
    import unicodedata
    r = random.Random(4)
    some = "aé゛ﾞが" + "かﾊﾟＡ１（…①㌔ﬁÅe\u0301\u3099ｶ한ᄒ\u1161\u11abำกत्\u093cا\u0651 \u3000\n々ー"
    every = [chr(c) for c in range(0x20, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for _ in range(3000):
        t = "".join(r.choice(some) if r.random() < 0.8 else r.choice(every) for _ in range(r.randint(0, 12)))
        assert abuse._normal(t) == unicodedata.normalize("NFKC", t), ascii(t)


@pytest.mark.parametrize("first,n", [(0x4E00, 13), (0x4E00, 100), (0x3042, 40), (0x30A2, 23), (ord("a"), 24), (0x0E81, 40)])
def test_no_character_pair_of_a_long_run_is_lost(first, n):
    run = "".join(c for c in map(chr, range(first, first + n)) if c.isalpha())
    own = {p for t in abuse.tokens(run) for p in abuse.grams(t)}
    assert all(run[i : i + 2] in own for i in range(len(run) - 1))
    assert abuse.tokens("1234567890123456") == ["1234567890123456"]


def test_the_tail_of_a_run_moves_the_score_by_its_characters():
    import pyarrow as pa
    model = abuse.Model([], ["滚出", "出去", "去死"])
    head = "".join(map(chr, range(0x5000, 0x5020)))
    out = next(iter(abuse._score(model)([pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [head + "滚出去死", head + "好好学习"]})])))
    assert out.column(1)[0] != out.column(1)[1]


def test_scores_of_awkward_documents(spark):
    texts, y = corpus(60)
    docs = [(i, t, "A " if i % 2 else None, 1.0) for i, t in enumerate(texts)] + [(100, None, "a", 1.0), (101, "", "a", 1.0), (102, "。。。", "a", 1.0), (103, "消えろ" * 20_000, "a", 1.0), (None, "x", "a", 1.0)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string, abusive double")
    lab = [(i, abuse.CATEGORIES[int(y[i].argmax())] if y[i].any() else "none", "r1") for i in range(60)] + [(0, None, "r2"), (None, "abusive", "r1"), (999, "abusive", None)]
    labels = spark.createDataFrame(lab, "doc_id bigint, label string, rater string")
    fitted = abuse.fit(d, labels)
    s = abuse.scores(d, fitted)
    got = {r["doc_id"]: r for r in s.collect()}
    assert len(got) == 64 and all(0 <= got[i][c] <= 1 for i in got for c in abuse.CATEGORIES)
    assert all(got[i]["abusive"] == 0 for i in (100, 101, 102))
    assert {r["category"] for r in abuse.found(s, dict.fromkeys(abuse.CATEGORIES, 0.0)).collect()} == set(abuse.CATEGORIES)
    rates = {r["source"]: r["n_docs"] for r in abuse.source_rates(s, d, abuse.cuts(s, fitted)).collect()}
    assert rates == {None: 30, "a": 34}
    unfit = abuse.fit(d, labels.limit(0))
    none = abuse.scores(d, unfit)
    assert none.count() == 64 and abuse.found(none, abuse.cuts(none, unfit)).count() == 0
    assert set(abuse.cuts(s.limit(0), fitted).values()) == {1.0}


def test_cuts_balance_recall_and_precision(spark):
    # 100 of 2,000 documents have the category; the held-out ones say that their scores lie evenly in 0.6..1
    r = random.Random(1)
    rows = [(i, 0.6 + 0.4 * (i + 0.5) / 100) for i in range(100)] + [(i, r.random() * 0.7) for i in range(100, 2000)]
    d = spark.createDataFrame(rows, "doc_id bigint, abusive double").selectExpr("*", "0.0D as hateful", "0.0D as sexual")
    step = np.arange(abuse.BINS + 1) / abuse.BINS
    caught = np.stack([np.clip((1 - step) / 0.4, 0.001, 1)] * 3)
    cut = abuse.cuts(d, abuse.Fitted(abuse.Model(), caught))
    assert 0.68 <= cut["abusive"] <= 0.71 and cut["sexual"] == 1.0


def test_the_sample_keeps_its_bounds(spark):
    d = spark.createDataFrame([(i, "x" * (10 if i % 2 else 400)) for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "abusive" if i % 4 == 0 else "none", "r") for i in range(40)], "doc_id bigint, label string, rater string")
    ids, texts, y = abuse.training_sample(d, labels, max_positive=6, max_negative=9, max_chars=1000)
    assert ids == sorted(ids) and sum(map(len, texts)) <= 1000 and (y[:, 0] > 0).sum() <= 6 and (y[:, 0] == 0).sum() <= 9
