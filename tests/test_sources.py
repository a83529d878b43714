"""Readers, writers, flatteners and streaming forms on files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from lexstat.functions import markup
from lexstat.sources import readers, sinks
from lexstat.streaming import counts as streaming


def test_dump(spark, tmp_path):
    rec = {"namespace": 0, "page_id": 5, "title": "t", "text": "x", "weighted_tags": ["a/STEM.Computing|900"], "redirect": [{"namespace": 0, "title": "r"}, {"namespace": 14, "title": "q"}]}
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        f.write('{"index":{}}\n' + json.dumps(rec) + "\n" + json.dumps(rec | {"namespace": 1}) + "\nbroken\n")
    r = readers.articles(spark, str(tmp_path / "d.json.gz"), partitions=2).collect()
    assert [(x["page_id"], x["redirect_titles"]) for x in r] == [(5, ["r"])]
    assert readers.articles(spark, str(tmp_path / "d.json.gz"), topics=["Culture"]).collect() == []
    dump = readers.articles(spark, str(tmp_path / "d.json.gz"))
    clean = spark.createDataFrame([(5, "# head\n\nbody\n\n")], "page_id bigint, text string")
    assert readers.with_clean_texts(dump, clean).first()["text"] == "body"
    p = spark.createDataFrame([(5,), (1005000,)], "p bigint").select(readers.clean_text_path(F.col("p"))).collect()
    assert [x[0] for x in p] == ["005/5.txt", "000/1005000.txt"]


def test_text_tree_and_manifests(spark, tmp_path):
    for s in ("a", "b"):
        (tmp_path / "tree" / s / "x").mkdir(parents=True)
        (tmp_path / "tree" / s / "x" / "1.txt").write_text(f"{s}1\nline")
        (tmp_path / "tree" / s / "manifest.jsonl").write_text(json.dumps({"license": "l", "style": s}) + "\n")
    r = readers.text_tree(spark, str(tmp_path / "tree"), exclude=["b"]).collect()
    assert [(x["source"], x["path"], x["text"]) for x in r] == [("a", "a/x/1.txt", "a1\nline")]
    st = {x["source"]: x["styles"] for x in readers.source_styles(spark, str(tmp_path / "tree/*/manifest.jsonl")).collect()}
    assert st == {"a": ["a"], "b": ["b"]}
    (tmp_path / "m.tsv").write_text("\t".join(readers.RAW_MANIFEST) + "\n" + "\t".join("abcdefgh") + "\n")
    assert readers.raw_manifest(spark, str(tmp_path / "m.tsv")).first()["license"] == "h"
    (tmp_path / "m2.tsv").write_text("\t".join(readers.RAW_MANIFEST) + "\na\tb\n")
    with pytest.raises(Exception, match="fewer than 8"):
        readers.raw_manifest(spark, str(tmp_path / "m2.tsv")).collect()


def test_small_tables(spark, tmp_path):
    (tmp_path / "lex.csv").write_text('東京駅,1,1,1,"a,b",名詞,固有名詞\n東京駅,1,1,1,x,名詞,普通名詞\n走る,1,1,1,x,動詞,一般\n')
    assert {r["word"]: r["kind"] for r in readers.lexicon(spark, str(tmp_path / "lex.csv")).collect()} == {"東京駅": "common"}
    (tmp_path / "c.tsv").write_text("a\tb\t3\nx\ty\nk\t7\n")
    assert {r["key"]: r["cnt"] for r in readers.count_table(spark, str(tmp_path / "c.tsv")).collect()} == {"a\tb": 3, "k": 7}
    (tmp_path / "t.txt").write_text(" 門 \n\n門\n")
    assert [r["word"] for r in readers.target_words(spark, str(tmp_path / "t.txt")).collect()] == ["門"]
    (tmp_path / "s.tsv").write_text("# c\n語\t1.1\t1.2\n\n別\n")
    assert {r["word"]: r["codes"] for r in readers.semantic_table(spark, str(tmp_path / "s.tsv")).collect()} == {"語": ["1.1", "1.2"], "別": []}
    (tmp_path / "l.json").write_text(json.dumps({"findings": [{"path": "p", "line": 1, "message": "'語' x", "rule": "r"}, {"path": "p", "line": 2, "message": "y", "rule": "q"}]}))
    assert [r["word"] for r in readers.lint_findings(spark, str(tmp_path / "l.json"), "r").collect()] == ["語"]
    (tmp_path / "n.idx").write_text("  licence\nbank n 2 1 @ 2 1 00001 00002\n")
    assert readers.wordnet_offsets(spark, str(tmp_path / "n.idx")).first()["offsets"] == ["00001", "00002"]


def test_jmdict(spark, tmp_path):
    x = ("<JMdict>\n<entry><k_ele><keb>暗号</keb><ke_pri>ichi1</ke_pri></k_ele><r_ele><reb>あんごう</reb></r_ele><sense><pos>&n;</pos><gloss>cipher</gloss><field>&comp;</field></sense></entry>\n"
         "<entry><r_ele><reb>はしる</reb></r_ele><sense><pos>&v5r;</pos><gloss>to run</gloss></sense></entry>\n</JMdict>")
    (tmp_path / "j.xml").write_text(x)
    e = readers.jmdict(spark, str(tmp_path / "j.xml"))
    assert sorted(r["word"] for r in readers.headwords(e, ["n"]).collect()) == ["暗号"]
    assert sorted(r["word"] for r in readers.headwords(e, ["v5"]).collect()) == ["はしる"]
    assert sorted(r["word"] for r in readers.priority_words(e).collect()) == ["あんごう", "暗号"]


def test_writers(spark, tmp_path):
    c = spark.createDataFrame([("b", 2), ("a", 1)], "key string, cnt bigint")
    sinks.write_counts(c, str(tmp_path / "c"))
    assert sorted(map(tuple, readers.count_table(spark, str(tmp_path / "c")).collect())) == [("a", 1), ("b", 2)]
    sinks.write_artifact(c, str(tmp_path / "art"), partitions=2)
    assert spark.read.parquet(str(tmp_path / "art")).count() == 2
    v = spark.createDataFrame([("w", [1])], "word string, categories array<int>")
    for _ in range(2):
        done = spark.read.json(str(tmp_path / "v")).select("word") if (tmp_path / "v").exists() else None
        sinks.append_votes(v, done, str(tmp_path / "v"))
    assert spark.read.json(str(tmp_path / "v")).count() == 1
    sinks.write_class_table(v, str(tmp_path / "t"), "1", ["head"])
    assert [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()] == ["# head", "w\t1.100"]


def test_flatten():
    md = "---\na: b\n---\n# 見出し\n\n```\ncode\n```\n\nこれは`x`と[語](u)です。\n\nEnglish only here.\n\n> 引用文です"
    assert markup.flatten("md", md).split("\n") == ["見出し", "これはZZCODEZZと語です。", "引用文です"]
    po = 'msgid ""\nmsgstr "Content: x\\n"\n\nmsgid "a"\nmsgstr "訳"\n"文です"\n\nmsgid "b"\nmsgstr ""\n'
    assert markup.po_messages(po) == ["訳文です"]
    rst = "見出し\n======\n\n.. コメント\n   続き\n\n本文は ``x`` と :ref:`節 <y>` です::\n\n   code\n\n次の文。\n\n:field: 値\n"
    assert markup.flatten("rst", rst).split("\n") == ["見出し", "本文は ZZCODEZZ と 節 です:", "次の文。"]
    assert markup.flatten("html", "x") is None and markup.flatten("md", None) is None and markup.flatten(None, "x") is None
    assert markup.clean_tables("| a | b |\n|---|---|\n| c | [d](e) |\nx") == "a\nb\nc\nd\nx"


def test_streaming(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "公開鍵暗号"), (2, "公開鍵暗号")], "doc_id bigint, text string").write.parquet(str(src))
    s = spark.readStream.schema("doc_id bigint, text string").parquet(str(src))
    q = streaming.running_compounds(s).writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r["cnt"] for r in spark.table("running").collect()} == {2}
    for _ in range(2):
        streaming.append_new(s, str(tmp_path / "out"), "doc_id", str(tmp_path / f"cp{_}")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
