"""Votes, candidates, evaluation and features against worked examples and plain computations."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexstat.operators import evals, features, substitution, votes


@pytest.mark.parametrize("sets,rule,kept,dropped", [
    ([[10]], "single-vote", [10], []), ([[10, 20], [10], [20]], "majority", [10, 20], []), ([[10], [11], [12]], "unstable", [], [10, 11, 12]),
    ([[10], [10]], "majority", [10], []), ([[], []], "unstable", [], []), ([[20, 10, 10]], "single-vote", [10, 20], []),
])
def test_majority(spark, sets, rule, kept, dropped):
    df = spark.createDataFrame([("w", s) for s in sets] + [("w", None)], "word string, categories array<int>")
    r = votes.finalized(df, ["word"]).first()
    assert (r["rule"], r["categories"], r["dropped"]) == (rule, kept, dropped)
    assert r["unanimous"] == (len({tuple(sorted(set(s))) for s in sets}) == 1)


def test_relations_and_concreteness(spark):
    rows = [([1], [1], "equal"), ([1], [2], "disjoint"), ([1], [1, 2], "containment"), ([1, 2], [2, 3], "partial"), ([], [], "equal"), ([], [1], "disjoint")]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>, x string")
    assert all(r[0] == r[1] for r in df.select(votes.relation(F.col("a"), F.col("b")), "x").collect())
    c = spark.createDataFrame([([],), ([40, 55],), ([40, 30],)], "c array<int>").select(votes.is_concrete(F.col("c"))).collect()
    assert [r[0] for r in c] == [False, True, False]


def test_last_and_first_win(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", 1, "q")], "k string, t int, v string")
    assert {r["k"]: r["v"] for r in votes.last_wins(df, ["k"], ["t"]).collect()} == {"a": "y", "b": "q"}
    assert {r["k"]: r["v"] for r in votes.first_wins(df, ["k"], ["t"]).collect()} == {"a": "x", "b": "q"}


def test_batches_are_full(spark):
    df = spark.createDataFrame([(f"w{i % 103}",) for i in range(400)] + [(None,)], "word string")
    rows = votes.batches(df, 694, 20).collect()
    assert len(rows) == 103 and len({(r["chunk_id"], r["chunk_index"]) for r in rows}) == 103
    assert sorted(r["chunk_id"] * 20 + r["chunk_index"] for r in rows) == list(range(103))


def test_candidates(spark):
    df = spark.createDataFrame([(1, "k", ["a", "b", "a", ""]), (2, "k", ["b"]), (3, "k", None), (4, "k", [None])], "response_id bigint, key string, candidates array<string>")
    got = {r["candidate"]: (r["votes"], r["mean_rank"]) for r in substitution.ranked_candidates(df, ["key"]).collect()}
    assert got == {"a": (1, 1.0), "b": (2, 1.5)}
    top = substitution.top_candidates(substitution.ranked_candidates(df, ["key"]), ["key"], 1).collect()
    assert [r["candidate"] for r in top] == ["b"]


def test_cosine(spark):
    p = spark.createDataFrame([("x", "a", 1), ("x", "b", 1), ("y", "a", 1), ("y", "b", 1), ("z", "c", 4)], "word string, context string, n bigint")
    got = {(r["word_a"], r["word_b"]): r["cosine"] for r in substitution.cosines(p, p).collect()}
    assert got == {("x", "y"): 1.0, ("y", "x"): 1.0}
    g = spark.createDataFrame([("w", "x"), ("w", "y"), ("w", "z")], "word string, loanword string")
    r = substitution.split_senses(g, p).collect()
    assert [(x["loan_a"], x["loan_b"], x["cosine"]) for x in r] == [("x", "z", 0.0)]


def test_sense_fit_takes_the_likelier_sense(spark):
    occ = spark.createDataFrame([(1, "w", ["a", "a"]), (2, "w", ["c"]), (3, "w", []), (4, "w", None)], "occ_id bigint, word string, context array<string>")
    senses = spark.createDataFrame([("w", "s1"), ("w", "s2")], "word string, sense string")
    prof = spark.createDataFrame([("s1", "a", 9), ("s2", "c", 9)], "word string, context string, n bigint")
    assert {r["occ_id"]: r["sense"] for r in substitution.sense_fit(occ, senses, prof).collect()} == {1: "s1", 2: "s2"}


def test_rare_loanwords_split_no_sense(spark):
    g = spark.createDataFrame([("w", "rare"), ("w", "x"), ("w", "y")], "word string, loanword string")
    p = spark.createDataFrame([("x", "a", 100), ("x", "b", 10), ("y", "b", 100), ("y", "a", 10), ("rare", "c", 1)], "word string, context string, n bigint")
    t = spark.createDataFrame([("x", 60), ("x", 40), ("y", 100), ("rare", 99)], "word string, total bigint")
    got = [(r["loan_a"], r["loan_b"]) for r in substitution.split_senses(g, p, 0.5, t).collect()]
    assert got == [("x", "y")]
    assert substitution.split_senses(g, p, 0.15, t).collect() == []


def test_senses_are_judged_against_the_own_use(spark):
    import math
    occ = [(1, "w", ["a", "a", "z"]), (2, "w", ["c"]), (3, "w", []), (4, "v", ["a"]), (5, "u", ["a"]), (6, "w", ["d", None])]
    o = spark.createDataFrame(occ, "occ_id bigint, word string, context array<string>")
    senses = spark.createDataFrame([("w", "s1"), ("w", "s2"), ("w", "rare"), ("v", "rare"), ("u", "s1")], "word string, loanword string")
    field = {"s1": {"a": 30, "b": 10}, "s2": {"d": 40}, "rare": {"a": 99, "c": 99}}
    general = {"w": {"c": 20, "d": 5}}
    prof = lambda x: spark.createDataFrame([(w, c, n) for w, cs in x.items() for c, n in cs.items()], "word string, context string, n bigint")
    totals = spark.createDataFrame([("s1", 50), ("s2", 80), ("rare", 49)], "word string, total bigint")

    def mean(p, cs):
        return sum(math.log((p.get(c, 0) + 0.5) / (sum(p.values()) + 0.5 * 100)) for c in cs) / len(cs)

    def cos(a, b):
        return sum(a[k] * b.get(k, 0) for k in a) / (math.hypot(*a.values()) * math.hypot(*b.values())) if b else 0.0

    for margin, support in ((0.0, 1.0), (0.0, 0.1), (1.5, 1.0)):
        got = {r["occ_id"]: r for r in substitution.judged_senses(o, senses, prof(field), prof(general), totals, 100, fit_margin=margin, max_support=support).collect()}
        assert set(got) == {1, 2, 5, 6}
        for i, w, cs in occ:
            if i in got:
                cs = [c for c in cs if c]
                fit, loan = max((mean(field[s], cs), s) for s in (["s1"] if w == "u" else ["s1", "s2"]))
                own, sup = mean(general.get(w, {}), cs), cos(field[loan], general.get(w, {}))
                assert (got[i]["loanword"], got[i]["fit"], got[i]["own"]) == (loan, pytest.approx(fit, abs=6e-4), pytest.approx(own, abs=6e-4)) or i == 2
                if i != 2:
                    assert (got[i]["support"], got[i]["flagged"]) == (pytest.approx(sup, abs=6e-4), fit - own > margin and sup < support)
        assert (got[2]["loanword"], got[2]["flagged"]) == ("s1", False)


def test_greedy_parts(spark):
    df = spark.createDataFrame([("ビットマップ",), ("ビット",), ("ビットxマップ",)], "w string")
    got = [r[0] for r in df.select(substitution.split_parts(F.col("w"), ["ビット", "マップ", "ビ", "a.b"])).collect()]
    assert got == [["ビット", "マップ"], None, None]


def test_every_part_over_the_rate_splits(spark):
    counts = [(f"部{chr(0x4E00 + k)}", 1000 + k) for k in range(300)] + [("稀語", 1), ("単", 10**6), (None, 9), ("零語", 0), ("負語", -5)]
    parts = [r[0] for r in substitution.frequent_parts(spark.createDataFrame(counts, "term string, total bigint"), 5.0).collect()]
    assert sorted(parts) == sorted(t for t, n in counts[:300])
    words = ["部一部丁", "部一稀語", "部一単"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(substitution.split_parts(F.col("w"), parts)).collect()]
    assert got == [["部一", "部丁"], None, None]


def test_no_part_is_given_back(spark):
    df = spark.createDataFrame([("abcd",), ("abcabc",), ("abc",), ("",), (None,)], "w string")
    assert [r[0] for r in df.select(substitution.split_parts(F.col("w"), ["ab", "abc", "cd", "c"])).collect()] == [None, ["abc", "abc"], None, None, None]


def test_wilson_and_matrix(spark):
    lo, hi = evals.wilson(F.col("k"), F.col("n"))
    got = [tuple(r) for r in spark.createDataFrame([(0, 0), (9, 74)], "k bigint, n bigint").select(lo, hi).collect()]
    assert got[0] == (0.0, 0.0) and got[1] == (pytest.approx(0.065, abs=1e-3), pytest.approx(0.215, abs=1e-3))
    rows = [("a", True, True), ("a", False, True), ("a", True, None), ("a", False, False), ("a", None, True)]
    m = evals.matrix(spark.createDataFrame(rows, "g string, truth boolean, flagged boolean"), ["g"]).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"], m["precision"], m["recall"]) == (1, 1, 1, 1, 0.5, 0.5)


def test_differences_fallback_keys_and_jaccard(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert {r["k"]: r["change"] for r in evals.run_difference(a, b, ["k"]).collect()} == {1: "lost", 2: "kept", 3: "gained"}
    assert tuple(evals.jaccard(a, b, ["k"]).first()) == (1, 3, 0.333333)
    f = spark.createDataFrame([("d", 1, "w"), ("d", 2, "v"), ("e", 3, "w")], "doc string, line int, word string")
    t = spark.createDataFrame([("d", 1, "w", True), ("d", 9, "v", False)], "doc string, line int, word string, truth boolean")
    got = {(r["doc"], r["line"]): (r["truth"], r["outside"]) for r in evals.matched(f, t, ["doc", "line", "word"], ["doc", "word"]).collect()}
    assert got == {("d", 1): (True, False), ("d", 2): (False, False), ("e", 3): (None, True)}


def test_stratified_precision(spark):
    s = spark.createDataFrame([("a", 10), ("b", 30), ("c", 10)], "stratum string, n bigint")
    lab = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "stratum string, ok boolean")
    assert evals.stratified_precision(s, lab).first()["estimate"] == pytest.approx((10 * 0.5 + 30) / 50)


def test_subtree_keys():
    nodes = [{"id": 1, "parent": None, "lemma": "使う", "relation": ""}, {"id": 2, "parent": 1, "lemma": "鍵", "relation": "を"}, {"id": 3, "parent": 2, "lemma": "公開", "relation": "の"}]
    assert features.subtree_keys(nodes, 2) == ["*(の>公開)", "使う(を>*(の>公開))", "使う(を>*)"]
    assert features.subtree_keys(nodes, 2, 1) == []


def test_tree_values_missing_and_categories(spark):
    leaf = lambda v: {"value": v}
    x = pd.DataFrame({"a": [np.nan, -1.0, 5.0], "c": [2.0, 3.0, 2.0]})
    none = {"feature": "a", "threshold": 1.0, "missing": "none", "left": leaf(1), "right": leaf(2)}
    assert list(features.tree_values(none, x)) == [1, 1, 2]
    nan = {"feature": "a", "threshold": 1.0, "missing": "nan", "default_left": False, "left": leaf(1), "right": leaf(2)}
    assert list(features.tree_values(nan, x)) == [2, 1, 2]
    cat = {"feature": "c", "categories": [0.0, 2.0], "left": leaf(1), "right": leaf(2)}
    assert list(features.tree_values(cat, x)) == [1, 2, 1]


def test_novelty_against_plain_computation(spark):
    r = random.Random(5)
    occ = [(i, r.choice("ab")) for i in range(12)]
    keys = [(i, "g", r.choice("xyz")) for i, _ in occ for _ in range(r.randint(0, 3))]
    got = {x["occ_id"]: x["mean"] for x in features.novelty(
        spark.createDataFrame(occ, "occ_id bigint, word string"), spark.createDataFrame(keys, "occ_id bigint, grp string, key string"),
        spark.createDataFrame([("a", "k"), ("b", "k")], "word string, cls string")).collect()}
    word = dict(occ)
    for i in got:
        vals = []
        for k in {k for o, _, k in keys if o == i}:
            own = sum(o == i and x == k for o, _, x in keys)
            wf = sum(word[o] == word[i] and x == k for o, _, x in keys)
            wn = sum(word[o] == word[i] for o, _, x in keys)
            cf, cn = sum(x == k for _, _, x in keys), len(keys)
            pc = (cf - own + 0.5) / (cn - own + 1)
            vals.append(-math.log((wf - own + 20 * pc) / (wn - own + 20)))
        assert got[i] == pytest.approx(sum(vals) / len(vals), abs=1e-5)
