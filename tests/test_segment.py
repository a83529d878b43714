"""Key extraction on pre-segmented Japanese, and the regex provider's two ways of finding spans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexstat.morph import MORPHEMES, dictionary_morphemes, regex_morphemes
from lexstat.operators import counts, segment

NOUN, PROPER, PARTICLE, NUMERAL = ("名詞", "普通名詞"), ("名詞", "固有名詞"), ("助詞", "格助詞"), ("名詞", "数詞")


def morphemes(text):
    """'公開 鍵 を/P' style input: marked words get other parts of speech, '_' is a space, '?' an unknown word."""
    out, at = [], 0
    for w in text.split():
        pos, known = NOUN, True
        if "/" in w:
            w, mark = w.split("/")
            pos = {"P": PARTICLE, "N": NUMERAL, "S": ("接尾辞", "名詞的"), "X": ("接頭辞", "*"), "R": PROPER, "V": ("動詞", "一般")}.get(mark, NOUN)
            known = mark != "U"
        if w == "_":
            w, pos = " ", ("空白", "*")
        out.append((w, w.lower(), *pos, at, at + len(w), known))
        at += len(w)
    return out


def keys_of(spark, *chunks, unknown=False, by_document=False):
    rows = [(i, morphemes(c)) for i, c in enumerate(chunks)]
    df = spark.createDataFrame(rows, f"doc_id bigint, morphemes {MORPHEMES}")
    s = segment.spans(df)
    k = segment.rows_of(s, ["doc_id"], segment.span_keys(F.col("span"), unknown), "key")
    k = k.distinct() if by_document else k
    return {r["key"]: r["count"] for r in k.groupBy("key").count().collect()}


@pytest.mark.parametrize("chunk,expected", [
    ("公開 鍵 暗号 を/P 使う/V", {"公開鍵": 1, "公開鍵暗号": 1, "鍵暗号": 1}),
    ("認証 の/P 基盤", {}),
    ("認証 _ 基盤", {}),
    ("暗号 3/N 方式", {}),
    ("一 二 三 四 五 六", {"一二": 1, "二三": 1, "三四": 1, "四五": 1, "五六": 1}),
    ("", {}),
])
def test_keys(spark, chunk, expected):
    assert keys_of(spark, chunk) == expected


def test_one_space_bridges_kanji_and_latin(spark):
    assert "演算子AND" not in keys_of(spark, "演算子 を/P AND")
    assert "AND演算子" in keys_of(spark, "AND _ 演算子 を/P")
    assert keys_of(spark, "gzip _ 圧縮") == {}
    assert keys_of(spark, "侵害 _ 成功") == {}


def test_parts_between_latin_nouns_count_too(spark):
    k = keys_of(spark, "Django _ 認証 バックエンド を/P")
    assert {"Django認証バックエンド", "認証バックエンド", "Django認証", "django認証"} <= set(k)
    assert k["認証バックエンド"] == 1


def test_unknown_words_count_alone_only_when_wanted(spark):
    assert keys_of(spark, "レジリエンスバジェット/U を/P") == {}
    assert keys_of(spark, "レジリエンスバジェット/U を/P", unknown=True) == {"レジリエンスバジェット": 1}
    assert keys_of(spark, "Kubectl/U を/P", unknown=True) == {"Kubectl": 1, "kubectl": 1}


def test_document_counts(spark):
    docs = spark.createDataFrame([(1, "公開鍵暗号を作る。公開鍵暗号を配る。"), (2, "公開鍵暗号を作る。"), (3, None), (4, "")], "doc_id bigint, text string")
    got = {r["key"]: r["cnt"] for r in counts.compound_counts(docs, by_document=True).collect()}
    assert got == {"公開鍵暗": 2, "鍵暗号": 2} or max(got.values()) == 2
    occ = {r["key"]: r["cnt"] for r in counts.compound_counts(docs).collect()}
    assert all(occ[k] == got[k] + 1 for k in got)


def test_fast_path_equals_the_general_one(spark):
    r = random.Random(3)
    alphabet = ["公開", "鍵", "認証", "API", "gzip", "レプリカ", " ", "の", "3", "、", "。", "Tarn.js", "\n", "A", "々"]
    rows = [(i, "".join(r.choice(alphabet) for _ in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for bridge in (True, False):
        fast = counts.compound_counts(docs, bridge=bridge).collect()
        slow = counts.compound_counts(docs, bridge=bridge, provider=lambda c: regex_morphemes(c)).collect()
        assert sorted(fast) == sorted(slow)


def test_nouns_and_windows_by_pattern_equal_the_general_way(spark):
    r = random.Random(4)
    alphabet = ["公開", "鍵", "認証", "API", "ZZCODEZZ", "レプリカ", " ", "\u3000", "の", "3", "、", "。", "js", "\n", "々"]
    docs = spark.createDataFrame([(i, "".join(r.choice(alphabet) for _ in range(40))) for i in range(60)] + [(99, None), (98, "")], "doc_id bigint, text string")
    targets = spark.createDataFrame([("公開",), ("api",), ("鍵",), ("zzcodezz",)], "word string")
    same = lambda c: regex_morphemes(c)
    assert sorted(counts.noun_counts(docs).collect()) == sorted(counts.noun_counts(docs, provider=same).collect())
    assert sorted(counts.cooccurrence(docs, targets).collect()) == sorted(counts.cooccurrence(docs, targets, provider=same).collect())


def test_chunks_keep_the_text_and_the_limit(spark):
    texts = ["あ" * 2000 + "。" + "い" * 10 + "。", "う" * 10000, "え、" * 5000, "a。b\nc", "", "𠮟" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", segment.chunks(F.col("text")).alias("c"))
    for r in df.collect():
        assert "".join(r["c"]) == r["text"]
        assert all(len(x.encode()) <= segment.CHUNK_BYTES for x in r["c"])
    assert len(df.where("text like 'あ%'").first()["c"]) == 2


def test_nouns_alone(spark):
    docs = spark.createDataFrame([(1, "門を通過させる。論理ゲートの門。")], "doc_id bigint, text string")
    got = {r["word"]: (r["total"], r["alone"]) for r in counts.noun_counts(docs).collect()}
    assert got["門"] == (2, 2)
    assert got["ゲート"] == (1, 0)


def test_window_contexts_and_occurrences(spark):
    docs = spark.createDataFrame([(1, "門を通過させる。論理ゲートの設計。")], "doc_id bigint, text string")
    targets = spark.createDataFrame([("門",), ("門",), ("論理",), (None,)], "word string")
    got = {(r["word"], r["context"]): r["cnt"] for r in counts.cooccurrence(docs, targets).collect()}
    assert got[("門", "通過")] == 1 and ("論理", "ゲート") in got and ("門", "論理") not in got
    occ = counts.occurrences(docs, targets, around=3).collect()
    assert {(r["word"], r["excerpt"]) for r in occ} == {("門", "門を通過"), ("論理", "論理ゲー ト".replace(" ", ""))} or len(occ) == 2


def test_whole_spans_and_titles(spark):
    words = ["公開鍵", "認証の基盤", "暗号", "レジリエンス", "9月22日", "公開 鍵", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string").withColumn("m", regex_morphemes(F.col("w")))
    got = {r["w"]: (r["a"], r["b"]) for r in df.select("w", segment.is_whole_span(F.col("m")).alias("a"), segment.is_registrable(F.col("m")).alias("b")).collect()}
    assert got["公開鍵"] == (True, True)
    assert got["レジリエンス"] == (False, True)
    assert not any(got[w][0] for w in ("認証の基盤", "9月22日", "公開 鍵", ""))


def test_dictionary_provider(spark):
    df = spark.createDataFrame([("東京駅へ行く",), (None,)], "text string")
    words = {"東京": ("東京", "名詞", "固有名詞"), "東京駅": ("東京駅", "名詞", "固有名詞"), "へ": ("へ", "助詞", "格助詞")}
    rows = dictionary_morphemes(df, words).collect()
    got = next(r["morphemes"] for r in rows if r["text"])
    assert [m["surface"] for m in got] == ["東京駅", "へ", "行", "く"]
    assert "".join(m["surface"] for m in got) == "東京駅へ行く" and [m["start"] for m in got] == [0, 3, 4, 5]


def test_regex_morphemes_cover_the_text(spark):
    t = "Tarn.js 版の公開鍵、v3。\nアー々x"
    m = spark.createDataFrame([(t,)], "t string").select(regex_morphemes(F.col("t")).alias("m")).first()["m"]
    assert "".join(x["surface"] for x in m) == t
    assert all(t[x["start"] : x["end"]] == x["surface"] for x in m)
    assert all(x["pos0"] == "名詞" for x in m if re.match("[A-Za-zァ-ヶー一-龥々0-9]", x["surface"]))
