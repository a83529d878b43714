"""Small operators of evaluation, voting, substitution and features."""

import pytest
from pyspark.sql import functions as F

from lexstat.operators import evals, features, substitution, votes
from lexstat.sources import readers


def test_dominance(spark):
    rows = [("a", 5, 3), ("b", 5, 4), ("c", 6, 9), ("d", 5, 3), ("e", 1, 0)]
    got = {r["condition"]: r["dominated"] for r in evals.dominated(spark.createDataFrame(rows, "condition string, tp bigint, fp bigint")).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": False, "e": False}


def test_review_queue(spark):
    df = lambda rows, s: spark.createDataFrame(rows, s)
    q = evals.review_queue(df([("d", "x"), ("d", "y"), ("d", "x")], "doc string, word string"), df([("d", "x", "ok")], "doc string, word string, label string"),
                           df([("d", "y"), ("e", "z")], "doc string, word string"), ["doc", "word"])
    assert sorted(map(tuple, q.collect()), key=str) == sorted([("d", "x", "ok", False, False), ("d", "y", None, True, False), ("e", "z", None, True, True)], key=str)


def test_votes(spark):
    h = votes.halves(spark.createDataFrame([(0, [1, 2]), (9, [1]), (10, [1]), (19, []), (3, None)], "chunk_index int, categories array<int>")).first()
    assert (h["front"], h["back"]) == (1.5, 0.5)
    old = spark.createDataFrame([("a", [1], "m", "d"), ("b", [2], "m", "d")], "word string, categories array<int>, model string, date string")
    got = votes.imported(old, spark.createDataFrame([("a", "m")], "word string, model string"), spark.createDataFrame([("b", "ctx")], "word string, context string"), "v1").collect()
    assert [(r["word"], r["context_used"], r["contract"]) for r in got] == [("b", "ctx", "v1")]
    assert votes.batches(spark.createDataFrame([], "word string"), 1).collect() == []


def test_substitution(spark):
    assert [r["sample_index"] for r in substitution.with_samples(spark.createDataFrame([(1,)], "k int"), 3).collect()] == [0, 1, 2]
    assert substitution.with_samples(spark.createDataFrame([(1,)], "k int"), 0).collect() == []
    e = spark.createDataFrame([("a", ["ger"]), ("a", ["fre", "ger"]), ("b", ["ger"]), ("b", []), ("c", ["eng"]), ("d", None)], "reading string, languages array<string>")
    assert {r["reading"]: r["languages"] for r in substitution.loan_languages(e).collect()} == {"a": ["fre", "ger"]}


def test_features(spark):
    o = spark.createDataFrame([("門", "p/a.txt", "この門を"), ("門", "q/a.txt", "この門を"), ("門", "p/b.txt", "「門」とは"), ("的", "p", "x"), ("門番", "p", "x"), (None, "p", "x"), ("門", None, None)], "word string, path string, excerpt string")
    assert features.usable(o, ["的"], ["q/"]).count() == 2
    s = spark.createDataFrame([("この門を", "門"), ("門前", "門"), ("会議(月)の日", "日"), ("無い", "門"), (None, "門")], "s string, w string")
    assert [r[0] for r in s.select(features.is_poor_negative(F.col("s"), F.col("w"))).collect()] == [False, True, True, True, True]
    w = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "word string")
    got = {r["word"]: r["reason"] for r in features.target_reasons(w, [("one", w.where("word = 'a'")), ("two", w.where("word in ('a', 'b')"))]).collect()}
    assert got == {"a": "one", "b": "two", "c": None}
    m = features.moments(spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "score double")).first()
    assert (m["mean"], m["std"]) == (2.0, 1.0)
    x = spark.createDataFrame([(float(i),) for i in range(10)], "score double")
    assert features.score_line(x, 2, 1.5).first()["line"] == 6.0 and features.score_line(x, 20, 1).first()["line"] is None


def test_readers(spark, tmp_path):
    (tmp_path / "g.tsv").write_text("語\tx\tx\t2\tx\tcomp\tg1\tg2\tg3\n短\t1\n悪\tx\tx\tn\tx\tx\tg\n")
    assert [(r["word"], r["first_glosses"]) for r in readers.gloss_rows(spark, str(tmp_path / "g.tsv")).collect()] == [("語", ["g1", "g2"])]
    (tmp_path / "n.tsv").write_text("wf\t門\tcase\tを\t3\n")
    assert readers.novelty_table(spark, str(tmp_path / "n.tsv")).first()["cnt"] == 3
    (tmp_path / "a.tsv").write_text("語\t文\t確認\nw\tf\tyes\nw\tf\n")
    assert readers.answer_rows(spark, str(tmp_path / "a.tsv")).count() == 1


@pytest.mark.parametrize("n", [0, 1, 5])
def test_samples_are_the_same_every_time(spark, n):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "k int, s int")
    a = sorted(r["k"] for r in evals.hashed_sample(df, "k", n, 3).collect())
    assert a == sorted(r["k"] for r in evals.hashed_sample(df.repartition(5), "k", n, 3).collect()) and len(a) == n
    assert evals.hashed_sample(df, "k", n, 3, ["s"]).count() == 2 * n
