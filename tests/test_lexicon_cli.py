"""Dictionary operators, and the commands end to end on a small tree of files."""

import json

import pytest
from pyspark.sql import functions as F

from lexstat import cli
from lexstat.operators import lexicon


def test_longest_match_with_script_edges():
    words = {"暗号", "公開鍵暗号", "キー", "API"}
    assert lexicon.match_words("公開鍵暗号と暗号、キーワード、APIs、API", words, 5) == [(0, "公開鍵暗号"), (6, "暗号"), (20, "API")]
    assert lexicon.match_words("`暗号` [暗号](u) 暗号", words, 5) == [(13, "暗号")]


def test_hits_contexts_and_sentences(spark):
    docs = spark.createDataFrame([(1, "前。これは暗号です。後"), (2, None), (3, "")], "doc_id bigint, text string")
    w = spark.createDataFrame([("暗号",), (None,), ("無い",)], "word string")
    hits = lexicon.dictionary_hits(docs, w)
    assert [(r["doc_id"], r["start"], r["word"]) for r in hits.collect()] == [(1, 5, "暗号")]
    assert lexicon.marked_sentences(hits, docs).first()["sentence"] == "これは【暗号】です。"
    assert lexicon.first_contexts(docs, w, around=2).first()["context"] == "れは暗号です"


def test_variants_senses_and_answers(spark):
    idx = spark.createDataFrame([("サーバ", 1), ("キー", 2)], "key string, v int")
    w = spark.createDataFrame([("サーバー",), ("キー",), ("無",)], "word string")
    assert {r["word"]: r["v"] for r in lexicon.by_variant(w, idx).collect()} == {"サーバー": 1, "キー": 2}
    e = spark.createDataFrame([(1, ["a"], [(["x"], ["comp"]), (["y"], [])]), (2, ["a"], [(["x"], [])])], "entry_id bigint, rebs array<string>, senses array<struct<glosses:array<string>,fields:array<string>>>")
    assert [(r["sense_no"], r["glosses"], r["computing"]) for r in lexicon.senses_of(e).orderBy("sense_no").collect()] == [(1, ["x"], True), (2, ["y"], False)]
    a = spark.createDataFrame([(1, "w", "これは 一"), (2, "w", ""), (3, "v", "zzz")], "answer_id bigint, word string, fragment string")
    q = spark.createDataFrame([(10, "w", "「これは一つ」"), (11, "w", "別の文"), (12, "v", "xxx"), (13, "v", "yyy")], "row_id bigint, word string, sentence string")
    assert sorted(map(tuple, lexicon.match_answers(a, q).collect())) == [(1, 10), (2, 11)]


def test_commands(spark, tmp_path, capsys):
    tree = tmp_path / "tree" / "src"
    tree.mkdir(parents=True)
    for i in range(4):
        (tree / f"{i}.txt").write_text("公開鍵暗号を使う。公開鍵暗号方式。")
    (tmp_path / "t.txt").write_text("暗号\n公開\n")
    run = lambda *a: (lambda ns: ns.run(spark, ns))(cli.parser().parse_args(list(map(str, a))))
    out = tmp_path / "out"
    run("count", "--text-dir", tmp_path / "tree", "--out-dir", out, "--domains")
    c = {r["key"]: r["cnt"] for r in spark.read.parquet(str(out / "compounds")).collect()}
    assert c and set(c.values()) == {4}
    run("count-nouns", "--text-dir", tmp_path / "tree", "--out-dir", out)
    run("count-cooccurrence", "--text-dir", tmp_path / "tree", "--targets", tmp_path / "t.txt", "--out-dir", out)
    run("extract-occurrences", "--text-dir", tmp_path / "tree", "--targets", tmp_path / "t.txt", "--out-dir", out, "--limit", 1)
    assert spark.read.json(str(out / "occurrences")).count() > 0
    dump = tmp_path / "d.json"
    dump.write_text("".join(json.dumps({"namespace": 0, "page_id": i, "title": t, "text": "暗号の話", "weighted_tags": ["x/STEM.Computing|900"]}, ensure_ascii=False) + "\n" for i, t in enumerate(["公開鍵", "9月22日"])))
    run("article-titles", "--dump", dump, "--out-dir", out)
    assert [r["key"] for r in spark.read.parquet(str(out / "titles")).collect()] == ["公開鍵"]
    run("topic-distribution", "--dump", dump, "--words-file", tmp_path / "t.txt", "--out-dir", out)
    assert {r["word"]: r["articles"] for r in spark.read.parquet(str(out / "topics")).collect()} == {"暗号": 2, "公開": 0}
    art = tmp_path / "art"
    run("build", "--counts-dir", out, "--titles", out / "titles", "--out-dir", art, "--counts-weight", 1)
    b = {r["key"]: r["bucket"] for r in spark.read.parquet(str(art / "buckets")).collect()}
    assert b["公開鍵"] == 7 and set(b.values()) == {1, 7}
    assert json.loads((art / "manifest.json").read_text())["buckets"][0]["keys"] > 0
    run("judge", "公開鍵", "新規語彙案", "--artifacts-dir", art)
    run("query", "公開鍵", "無い語", "--artifacts-dir", art)
    shown = capsys.readouterr().out
    assert "Dictionary" in shown and "未登録" in shown
    raw = tmp_path / "raw" / "s"
    raw.mkdir(parents=True)
    (raw / "a.md").write_text("# 見出し\n\n本文です。\n")
    (tmp_path / "raw" / "manifest.tsv").write_text("\t".join(["name", "repo", "branch", "commit", "commit_date", "paths", "format", "license"]) + "\ns\tr\tb\tc\td\tp\tmd\tl\n")
    run("flatten", "--raw-dir", tmp_path / "raw", "--out-dir", out)
    assert spark.read.parquet(str(out / "text")).select(F.col("text")).first()[0] == "見出し\n本文です。"
    frames = tmp_path / "f.json"
    frames.write_text('{"word": "段", "case": "を", "predicate": "組む"}\n')
    run("count-case-frames", "--frames", frames, "--out-dir", out)
    trees = tmp_path / "tr.json"
    trees.write_text('{"occ_id": 1, "centre": 2, "nodes": [{"id": 1, "parent": null, "lemma": "a", "relation": ""}, {"id": 2, "parent": 1, "lemma": "b", "relation": "r"}]}\n')
    run("extract-subtrees", "--trees", trees, "--out-dir", out)
    (tmp_path / "lex.csv").write_text("暗号,1,1,1,x,名詞,普通名詞\n東京,1,1,1,x,名詞,固有名詞\n")
    run("dictionary-headwords", "--lexicon-dir", tmp_path / "lex.csv", "--out-dir", out)
    assert [r["key"] for r in spark.read.parquet(str(out / "headwords")).collect()] == ["暗号"]


def test_all_judgments_are_written(spark, tmp_path, capsys):
    run = lambda *a: (lambda ns: ns.run(spark, ns))(cli.parser().parse_args(list(map(str, a))))
    (tmp_path / "c.json").write_text("".join(json.dumps({"namespace": 0, "page_id": i, "title": "題", "text": "公開鍵暗号を使う。公開鍵暗号方式。", "weighted_tags": []}, ensure_ascii=False) + "\n" for i in range(4)))
    out = tmp_path / "out"
    run("count", "--dump", tmp_path / "c.json", "--out-dir", out)
    art = tmp_path / "art"
    run("build", "--counts-dir", out, "--out-dir", art, "--counts-weight", 1)
    words = [f"語{k}" for k in range(10_050)]
    (tmp_path / "w.txt").write_text("".join(w + "\n" for w in words))
    to = tmp_path / "to"
    run("judge", "--eval", tmp_path / "w.txt", "--artifacts-dir", art, "--out-dir", to)
    assert {r["word"] for r in spark.read.parquet(str(to / "judgments")).collect()} == set(words)
    run("query", *words[:30], "--artifacts-dir", art, "--out-dir", to)
    assert spark.read.parquet(str(to / "lookups")).count() == 30
    assert words[0] in capsys.readouterr().out
    with pytest.raises(ValueError):
        run("judge", "公開鍵", "--artifacts-dir", art, "--out-dir", to, "--concatenation", "composition")
