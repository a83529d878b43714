"""Feature rows of trees against a plain computation, and the operators that were added with them."""

import json
import math

import pytest
from pyspark.sql import functions as F

from lexstat.operators import build, counts, domains, evals, features, judge, substitution, trees
from lexstat.sources import readers

#: A centre (0) with a modifier before it, under a verb with one more child, under a root.
TREE = [(0, 2, 3, "名詞", "1.4510", "が", "主語"), (1, 1, 0, "名詞", "1.1700", "の", "修飾"), (2, 3, 3, "名詞", "1.2340", "を", "目的"), (3, 4, 4, "動詞", "2.1500", "", "節"), (4, 5, None, "動詞", "動詞-一般", "", "根")]
ROOT = [(0, 1, None, "名詞", "名詞", "", "根")]


def as_map(row):
    return {x["name"]: x["key"] for x in row}


def test_shape_and_combinations(spark):
    d = spark.createDataFrame([(1, TREE), (2, ROOT), (3, []), (4, None)], f"occ_id bigint, nodes {trees.NODES}")
    got = {r["occ_id"]: r for r in d.select("occ_id", trees.shape(F.col("nodes")).alias("s"), trees.combos(F.col("nodes")).alias("k")).collect()}
    s = got[1]["s"].asDict()
    assert list(s) == trees.SHAPE
    assert s == dict(c_func="が", c_rel="主語", c_nkids=1, c_root=0, c_kid_rels="修飾", p_pos="動詞", p_top="2.1", p_mid="2.15", p_func="", p_rel="節", gp_pos="動詞", gp_top="-", n_sibs=1,
                     sib_rels="目的", sib_tops="1.2", prev_pos="名詞", prev_func="の", next_pos="名詞", next_func="を")
    assert as_map(got[1]["k"]) == dict(zip(trees.COMBOS, ["が>2.15", "が>2.1/", "の:1.17", "が>2.15[目的]", "主語<修飾", "の_が_を", "1.17>が>2.15"]))
    assert as_map(got[2]["k"]) == dict(zip(trees.COMBOS, [">-", ">-/-", "-:-", ">-[-]", "根<-", "^__$", "->>-"]))
    assert got[2]["s"]["c_root"] == 1 and got[2]["s"]["p_top"] == "-" and got[3]["s"] is None and got[4]["s"] is None


def test_counts_of_modifiers_and_frames(spark):
    m = [("段", "の", "最初", 4), ("段", "連体", "高い", 2), ("層", "の", "最初", 6), ("レイヤー", "の", "最初", 5), ("レイヤー", "の", "別", 5), (None, "の", "x", 9)]
    f = [("段", "を", "組む", 3), ("段", "を", "上がる", 1), ("レイヤー", "を", "組む", 4), ("層", "が", "組む", 1)]
    occ = [(1, "段", "の", "最初", "を", "組む", 1), (2, "段", "なし", None, None, None, 0), (3, "段", "連用", "無い", "が", "組む", 0), (4, "無", "の", "最初", "", "", None)]
    df = spark.createDataFrame
    got = {r["occ_id"]: r for r in trees.counts(
        df(occ, "occ_id bigint, word string, kind string, modifier string, case string, predicate string, own int"), df(m, "word string, kind string, modifier string, cnt bigint"),
        df(f, "word string, case string, predicate string, cnt bigint"), df([("段", "レイヤー"), ("段", "ステップ")], "word string, loanword string"),
        df([("初", "1.1651")], "word string, code string"), df([("組む", "2.1500")], "word string, code string")).collect()}
    lg = lambda x: math.log10(x + 1)
    r = got[1]
    assert (r["m_kind"], r["m_top"], r["m_mid"], r["f_case"], r["f_vtop"], r["f_vmid"]) == ("の", "1.1", "1.16", "を", "2.1", "2.15")
    want = dict(m_cnt=lg(3), m_share=3 / 5, m_freq=lg(15), m_exp=lg(4 * 15 / 20), m_loan=math.log(5.5 / 11) - math.log(3.5 / 7), f_cnt=lg(2), f_share=2 / 5, f_pfreq=lg(7), f_exp=lg(4 * 7 / 8),
                f_loan=math.log(4.5 / 11) - math.log(2.5 / 7))
    for k, v in want.items():
        assert r[k] == pytest.approx(v), k
    assert got[2]["m_top"] == "-" and got[2]["m_cnt"] is None and got[2]["f_case"] == "-" and got[2]["f_cnt"] is None
    assert got[3]["m_cnt"] == 0 and got[3]["f_cnt"] == 0 and got[3]["m_loan"] is None
    assert got[4]["m_share"] == 0 and got[4]["f_vtop"] == "-"


def test_rows(spark):
    o = spark.createDataFrame([(1, TREE), (2, ROOT)], f"occ_id bigint, nodes {trees.NODES}")
    c = spark.createDataFrame([(1, "の")], "occ_id bigint, m_kind string")
    n = spark.createDataFrame([(1, "combo_a", 1.0, 2.0, 0.5)], "occ_id bigint, grp string, mean double, most double, zero_share double")
    got = {r["occ_id"]: r for r in trees.rows(o, c, n, ["combo_a", "combo_b"]).collect()}
    assert len(got) == 2 and got[1]["combo_a_max"] == 2.0 and got[1]["combo_b_mean"] is None and got[2]["combo_a_mean"] is None
    assert 19 + 16 + 3 * 18 == 89 and len(trees.SHAPE) == 19 and len(trees.COUNTS) == 16


def test_frames_and_modifiers_of_targets(spark):
    f = spark.createDataFrame([("段", "を", "組む", True), ("段", "を", "組む", True), ("層", "を", "実装", False), ("門", "を", "通る", True), (None, "を", "x", True), ("段", None, "x", True)],
                              "word string, case string, predicate string, standalone boolean")
    t = spark.createDataFrame([("段",), ("層",)], "word string")
    assert sorted(map(tuple, counts.frame_tables(f, t).collect()), key=str) == sorted([("段", "を", "組む", 2), ("段", None, None, 2), (None, None, None, 1)], key=str)
    m = spark.createDataFrame([("段", "の", "最初", True), ("段", "謎", "x", True), ("段", None, None, True), ("層", "の", "a", False)], "word string, kind string, modifier string, standalone boolean")
    assert sorted(map(tuple, counts.modifier_counts(m, t).collect())) == sorted([("段", "の", "最初", 1), ("段", "その他", "x", 1), ("段", "なし", "", 1)])


def test_rendering_and_lookup(spark):
    j = spark.createDataFrame([("樹形図", "RepurposeCandidate", "Domain", [3, 2]), ("暗号", "Established", "Dictionary", [])], "word string, verdict string, reason string, domains array<int>")
    got = {r["word"]: r["text"] for r in judge.rendered(j).collect()}
    assert got == {"樹形図": "転用の候補\t分野(その他の理工・文化)", "暗号": "既存語\t辞書"}
    assert judge.document_domain("社会") == 5
    for bad in ("一般", "無い"):
        with pytest.raises(ValueError, match="情報技術・"):
            judge.document_domain(bad)
    df = spark.createDataFrame
    parts = df([("公開", 10, 1, 2, 3, 4), ("母集団", 7, 0, 0, 1, 1)], "part string, frequency bigint, prefix_foreign bigint, prefix_kango bigint, suffix_foreign bigint, suffix_kango bigint")
    w = df([("公開鍵", ["母集団"]), ("API鍵", None)], "word string, long array<string>")
    got = {r["word"]: (r["bucket"], r["parts"]) for r in judge.lookup(w, df([("公開鍵", 4), ("api鍵", 2)], "key string, bucket int"), parts, F.col("long")).collect()}
    assert got == {"公開鍵": (4, "公開:10:1:2:3:4 鍵:0:0:0:0:0 母集団:7:0:0:1:1"), "API鍵": (2, "API:0:0:0:0:0 鍵:0:0:0:0:0")}
    units = judge.composition_units(df([("a", 2), ("b", 1), (None, 9)], "key string, cnt bigint"), df([("a", 1), ("c", 5)], "key string, cnt bigint"))
    assert {r["key"]: r["cnt"] for r in units.collect()} == {"a": 3, "c": 5}


def test_evaluation_files(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("語\t判定者\t出典\t区分\n幽霊参照\tm\tr\t造語\n\n 樹形図 \tm\tr\t意味の転用\n")
    rows = readers.eval_words(spark, str(tmp_path / "c.tsv"))
    assert sorted(map(tuple, rows.collect())) == [(2, "幽霊参照", "造語"), (4, "樹形図", "意味の転用")]
    j = spark.createDataFrame([("幽霊参照", "Coined", "Constituent"), ("樹形図", "Established", "Dictionary")], "word string, verdict string, reason string")
    t = {r["category"]: (r["total"], r["coined"], r["established"]) for r in judge.confusion(judge.collected(j, rows), "category").collect()}
    assert t == {"造語": (1, 1, 0), "意味の転用": (1, 0, 1)}
    with pytest.raises(Exception, match="row 9"):
        judge.collected(j, spark.createDataFrame([(9, "樹形図", "x")], "row_no int, word string, category string")).collect()
    (tmp_path / "s.json").write_text(json.dumps({"documents": 3, "unknown": True}))
    assert readers.stats(spark, str(tmp_path / "s.json"), "documents bigint, unknown boolean") == {"documents": 3, "unknown": True}
    with pytest.raises(ValueError):
        readers.stats(spark, str(tmp_path / "s.json"), "documents bigint, text_bytes bigint")
    for d, n in (("a", 2), ("b", 3)):
        (tmp_path / d).mkdir()
        (tmp_path / d / "k.tsv").write_text(f"x\ty\t{n}\nz\t1\n")
        (tmp_path / d / "n.tsv").write_text(f"x\t{n}\t\ny\t4\t1\n")
    got = readers.count_tables(spark, [str(tmp_path / x) for x in "abc"], "k.tsv")
    assert {r["key"]: r["cnt"] for r in got.collect()} == {"x\ty": 5, "z": 2}
    assert readers.count_tables(spark, [str(tmp_path / "c")], "k.tsv").count() == 0
    assert sorted(map(tuple, readers.noun_table(spark, [str(tmp_path / x / "n.tsv") for x in "ab"]).collect())) == [("x", 5, 0), ("y", 8, 2)]
    (tmp_path / "w.txt").write_text("# c\n a \n\nb\n")
    assert {r[0] for r in readers.word_list(spark, [str(tmp_path / "w.txt")]).collect()} == {"a", "b"}


def test_conditions_and_tallies(spark):
    df = spark.createDataFrame
    rows = df([("a", "A", 0.9, True), ("b", "b", 0.8, False), ("c", "x", 0.7, True), (None, None, 0.95, False), ("d", "d", 0.1, True)], "word string, surface string, score double, truth boolean")
    ex = df([("l1", "b"), ("l1", None), ("l2", "x"), ("l2", "A")], "list string, word string")
    got = {r["condition"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in evals.conditions(rows, [("plain", 0.7, []), ("one", 0.7, ["l1"]), ("both", 0.7, ["l1", "l2"])], ex).collect()}
    assert got == {"plain": (2, 2, 1, 0), "one": (2, 1, 1, 1), "both": (0, 1, 3, 1)}
    assert {r["word"] for r in evals.exempted(rows, ex.select("word")).collect()} == {None, "d"}
    t = substitution.response_tallies(df([("w", ["a"], None), ("w", [], ""), ("w", ["", None], None), ("w", None, "timeout")], "word string, candidates array<string>, error string"), ["word"]).first()
    assert (t["responses"], t["empty"], t["errors"]) == (4, 2, 1)
    c = df([("field", "a", 1), ("field", "b", 3), ("wiki", "a", 1), ("law", "c", 9)], "corpus string, term string, total bigint")
    assert {r["term"]: r["rate"] for r in substitution.best_rates(c, ["field", "wiki"]).collect()} == {"a": 1e6, "b": 750000.0, "c": 0.0}
    with pytest.raises(ValueError):
        evals.first_rows(rows, "word", 9)
    assert evals.first_rows(rows, "score", 2).count() == 2


def test_keys_settings_and_digests(spark):
    d = spark.createDataFrame([("a\tb", 3), ("", 8)], "w string, c int").select("w", "c", domains.domain_key(F.col("c"), F.col("w")).alias("k"))
    w, c = domains.split_domain_key(F.col("k"))
    assert all((r["w"], r["c"]) == (r["w2"], r["c2"]) for r in d.select("w", "c", w.alias("w2"), c.alias("c2")).collect())
    bad = spark.createDataFrame([("x",), ("x\t9",)], "k string").select(domains.split_domain_key(F.col("k"))[1])
    assert [r[0] for r in bad.collect()] == [None, None]
    build.check_inputs({"a": {"unknown": True, "domains": True}, "b": {"unknown": True, "domains": True}}, {"a": 1.0}, 3)
    for inputs, weights, least in (({"a": {"unknown": True}, "b": {}}, {}, 3), ({}, {"a": float("inf")}, 3), ({}, {}, 2), ({"a": {"domains": True}, "b": {}}, {}, 3)):
        with pytest.raises(ValueError):
            build.check_inputs(inputs, weights, least)
    t = spark.range(100).selectExpr("id", "id * 2 as x")
    assert build.digest(t) == build.digest(t.orderBy(F.desc("id")).select("x", "id")) != build.digest(t.where("id > 0"))


def test_places_and_levels_over_many_rows(spark):
    x = spark.range(20_000).select((F.col("id") % 5000).cast("double").alias("score"))
    for k in (0, 3, 4, 7777, 19_999):
        assert features.score_line(x, k, 1).first()["line"] == 4999 - k // 4
    assert features.score_line(x, 20_000, 1).first()["line"] is None
    got = {r["value"]: r["code"] for r in features.levels(spark.createDataFrame([(v,) for v in ["b", "a", None, "c", "b"]], "v string"), "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_mentions_and_topic_words(spark):
    rows = [("門", "a/b", "この門を通る", True), ("門", "a", "語「門」は", False), ("門", "a", "「この門は古い」と", False), ("門", "a", "「古い」門と「新しい」門", True), ("門", "a", "「古い門", True),
            ("門", "x/tests/y", "門", False), ("の", "a", "の", False), ("ア", "a", "ア", False), ("門", None, None, True)]
    d = spark.createDataFrame(rows, "word string, path string, excerpt string, want boolean")
    assert sorted(map(str, features.usable(d, ["の"]).collect())) == sorted(map(str, d.where("want").collect()))
    c = spark.createDataFrame([(2, "a", "造語"), (3, "b", "言い換え"), (4, "c", "意味の転用")], "row_no int, word string, category string")
    e = spark.createDataFrame([(5, "z", None), (3, "x", None), (4, "y", None)], "row_no int, word string, category string")
    assert sorted(map(tuple, evals.topic_words(c, e, 2).collect())) == [("a", "造語"), ("c", "意味の転用"), ("x", "既存語"), ("y", "既存語")]


def test_staged_tables_are_dropped(spark):
    from lexstat import session
    d = session.staged(spark.range(3).toDF("i"))
    path = session._STAGED[-1]
    assert d.count() == 3 and session.exists(spark, path)
    assert session.drop_staged(spark) >= 1 and not session.exists(spark, path) and not session._STAGED


def test_hot_contexts_give_the_same_cosines(spark):
    rows = [(f"w{i}", c, 1 + i % 3) for i in range(40) for c in ("every", f"c{i % 5}")]
    p = spark.createDataFrame(rows, "word string, context string, n bigint")
    a = p.where("word in ('w1', 'w7', 'w30')")
    plain = sorted(map(tuple, substitution.cosines(a, p).collect()))
    assert len(plain) == 3 * 39 and sorted(map(tuple, substitution.cosines(a, p, hot_rows=10).collect())) == plain


def test_wordnet_files(spark, tmp_path):
    (tmp_path / "lexnames").write_text("03\tnoun.Tops\t1\n09\tnoun.cognition\t1\nx\n")
    (tmp_path / "data.noun").write_text("  1 preface\n00000010 09 n 01 idea 0 000 | a thought\n00000020 03 n 02 thing 0 it 0 000 | g\n")
    (tmp_path / "index.noun").write_text("  1 preface\nidea n 2 1 @ 2 1 00000010 00000020  \nraw_idea n 1 0 1 0 00000010  \nlost n 1 0 1 0 00000099  \n")
    lem = readers.lemma_lexnames(readers.wordnet_offsets(spark, str(tmp_path / "index.noun")), readers.wordnet_files(spark, str(tmp_path / "data.noun")), readers.lexnames(spark, str(tmp_path / "lexnames")))
    assert {r["lemma"]: r["lexnames"] for r in lem.collect()} == {"idea": ["noun.Tops", "noun.cognition"], "raw_idea": ["noun.cognition"], "lost": []}
    g = spark.createDataFrame([("概念", ["thing", " raw idea "]), ("物", ["thing"]), ("無", [])], "word string, first_glosses array<string>")
    assert [r[0] for r in readers.words_of_lexnames(g, lem, ["noun.cognition"]).collect()] == ["概念"]


def test_what_stands_at_a_place_is_attached(spark):
    df = spark.createDataFrame
    o = df([(1, 10, 0, 2), (2, 10, 5, 6), (3, 11, 0, 2)], "occ_id bigint, doc_id bigint, start int, end int")
    m = df([(10, 0, 2, "の", "最初"), (10, 0, 2, "連体", "x"), (12, 0, 2, "の", "y")], "doc_id bigint, start int, end int, kind string, modifier string")
    f = df([(10, 5, 6, "を", "組む"), (11, 0, 1, "が", "z")], "doc_id bigint, start int, end int, case string, predicate string")
    got = {r["occ_id"]: (r["kind"], r["modifier"], r["case"], r["predicate"]) for r in trees.attached(o, m, f).collect()}
    assert got == {1: ("の", "最初", None, None), 2: (None, None, "を", "組む"), 3: (None, None, None, None)}
