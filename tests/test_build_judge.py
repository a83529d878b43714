"""Weighted unions, buckets, overlays, partners, packing, domains and judgments against worked examples."""

import random

import pytest
from pyspark.sql import functions as F

from lexstat.operators import build, domains, judge


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


@pytest.mark.parametrize("weights,counts,total", [((1, 1, 1), (2, 1, 4), 7), ((1, 0.3, 0), (2, 5, 100), 4), ((0, 1, 0), (1000, 4, 20), 4)])
def test_weighted_sum_rounds_half_up(spark, weights, counts, total):
    rows = [(i, "x", c) for i, c in zip(("wiki", "docs", "corpus"), counts)]
    df = spark.createDataFrame(rows, "input string, key string, cnt bigint")
    assert build.weighted_union(df, dict(zip(("wiki", "docs", "corpus"), map(float, weights)))).first()["cnt"] == total


def test_release_example(spark):
    rows = [("wiki", "公開鍵", 2), ("wiki", "暗号方式", 100), ("docs", "公開鍵", 1), ("docs", "設定項目", 3), ("corpus", "設定項目", 2), ("corpus", "完了条件", 5), (None, "x", 9), ("wiki", None, 9)]
    df = spark.createDataFrame(rows, "input string, key string, cnt bigint")
    b = build.bucketed(build.weighted_union(df, {"wiki": 1.0, "docs": 1.0, "corpus": 1.0}))
    got = as_dict(build.overlay(b, spark.createDataFrame([("電子署名",), ("検証手順",), ("電子署名",)], "key string")), "key", "bucket")
    assert got == {"公開鍵": 1, "暗号方式": 3, "設定項目": 1, "完了条件": 1, "電子署名": 7, "検証手順": 7}


def test_bad_settings(spark):
    df = spark.createDataFrame([], "input string, key string, cnt bigint")
    with pytest.raises(ValueError):
        build.weighted_union(df, {"wiki": -1.0})
    with pytest.raises(ValueError):
        build.weighted_union(df, {"wiki": float("inf")})
    with pytest.raises(ValueError):
        build.bucket_of(F.col("cnt"), 2)
    assert build.weighted_union(df).collect() == []


def test_bucket_ranges_are_contiguous(spark):
    rows = build.bucket_ranges(spark).orderBy("bucket").collect()
    assert rows[0]["low"] == 3 and rows[-1]["high"] is None
    assert all(a["high"] + 1 == b["low"] for a, b in zip(rows, rows[1:]))


def test_partners(spark):
    rows = [("a", ["ビット", "演算", "子"]), ("b", ["シフト", "演算", "子"]), ("c", ["論理", "演算", "子"]), ("d", ["鍵", "鍵", "鍵"]), ("e", ["ゆとり", "教育"]), ("f", ["一"]), ("g", None)]
    df = spark.createDataFrame(rows, "compound string, surfaces array<string>")
    got = {r["part"]: tuple(r)[1:] for r in build.partner_counts(df).collect()}
    assert got["演算"] == (2, 1, 0, 3) and got["子"] == (0, 3, 0, 0) and got["ビット"] == (0, 0, 0, 1)
    assert got["鍵"] == (0, 1, 0, 1) and got["ゆとり"] == (0, 0, 0, 1) and "教育" not in got


def test_packing_round_trip(spark):
    r = random.Random(1)
    rows = [(i, r.randrange(5), r.randrange(2000), r.randrange(100), r.randrange(40000)) for i in [0, 1, 1023, 1024, 1500, 10**6, *(r.randrange(10**5) for _ in range(50))]]
    df = spark.createDataFrame(rows, "n bigint, a bigint, b bigint, c bigint, d bigint")
    v = build.packed(F.col("n"), [F.col(c) for c in "abcd"])
    got = df.select("*", *[x.alias(k) for k, x in build.unpacked(v).items()], build.encode_frequency(F.col("n")).alias("ef"), build.encode_partner(F.col("d")).alias("ed"),
                    build.decode_frequency(build.encode_frequency(F.col("n"))).alias("back")).collect()
    for x in got:
        assert x["frequency"] == x["ef"] and x["suffix_kango"] == x["ed"]
        assert x["back"] <= x["n"] or x["ef"] == 2047
        if x["n"] <= 1023:
            assert x["back"] == x["n"]
    assert next(x["ef"] for x in got if x["n"] == 1500) == 1032


def test_merged_runs_count_a_line_once(spark):
    rows = [(1, 0, "公開鍵", 2), (1, 1, "暗号方式", 3), (2, 0, "公開鍵", 5), (2, 1, "電子署名", 7), (2, 1, "電子署名", 7), (3, 0, None, 1), (3, 1, "x", None)]
    df = spark.createDataFrame(rows, "run_id bigint, line_no bigint, term string, cnt bigint")
    assert as_dict(build.merged_runs(df), "term", "cnt") == {"公開鍵": 7, "暗号方式": 3, "電子署名": 7}


def test_tags_to_domains(spark):
    rows = [(["x/STEM.Computing|803", "Culture.Linguistics*|538", "Geography.Regions|499"],), ([],), (None,), (["bad", None, "STEM.Physics|"],)]
    got = [r[0] for r in spark.createDataFrame(rows, "t array<string>").select(domains.tag_domains(F.col("t"))).collect()]
    assert got == [[1, 3], [], [], []]


def test_source_domains_and_law_ids(spark):
    df = spark.createDataFrame([("egov-law", ["法令文"]), ("jpccert-eyes", []), ("board-of-audit", None)], "n string, s array<string>")
    assert [r[0] for r in df.select(domains.source_domain(F.col("n"), F.col("s"), ["jpccert"])).collect()] == [7, 1, 6]
    ids = ["321A", "322A", "105B", "212C", "404D", "505E", "605F", "3X2G", "32"]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(domains.is_classical(F.col("i"))).collect()]
    assert got == [True, False, True, True, False, False, None, None, None]


def test_registration(spark):
    rows = [("樹形図", 3, 5), ("樹形図", 4, 2), ("公開鍵暗号", 1, 5), ("完了条件", 7, 9), *[("多い", d, 6) for d in range(1, 6)]]
    df = spark.createDataFrame(rows, "word string, domain int, docs bigint")
    got = sorted((r["word"], r["domain"]) for r in domains.register_by_count(df).collect())
    assert got == sorted([("樹形図", 3), ("公開鍵暗号", 1), ("完了条件", 7), ("多い", 8)])
    fold = sorted((r["word"], r["domain"]) for r in domains.register_by_count(df, 5, 1).collect())
    assert {d for _, d in fold} == {8}

    def shares(rows, **kw):
        df = spark.createDataFrame(rows, "word string, domain int, docs bigint")
        out = {}
        for r in domains.register_by_share(df, **kw).collect():
            out.setdefault(r["word"], set()).add(r["domain"])
        return out

    assert shares([("a", 1, 9), ("a", 2, 1), ("b", 1, 4), ("c", 1, 5)]) == {"a": {1}, "c": {1}}
    assert shares([("a", 1, 9), ("a", 2, 1)], share=0.05) == {"a": {1, 2}}
    rows = [("c", 1, 4), ("c", 3, 3), ("c", 4, 3), ("d", 1, 7), ("d", 3, 3), *[("e", i, 5) for i in range(1, 7)]]
    assert shares(rows) == {"c": {8}, "d": {1, 3}, "e": {8}}
    rows = [("a", 1, 90), ("a", 3, 10), ("b", 1, 90), ("b", 3, 9), ("c", 1, 4)]
    assert shares(rows, general_min_total=100) == {"a": {8}, "b": {1}}
    assert shares([("a", 1, 90), ("a", 3, 10)], general_min_total=101) == {"a": {1}}
    two = [("", 3, 5), ("樹形図", 3, 5), ("樹形図", 2, 2), ("公開鍵暗号", 1, 3), ("公開鍵暗号", 1, 2), ("完了条件", 7, 9), ("監視対象", 1, 4)]
    assert shares(two) == {"": {3}, "樹形図": {2, 3}, "公開鍵暗号": {1}, "完了条件": {7}}


def test_topics_of_information_technology_are_exact(spark):
    rows = [(["STEM.Computing_x|900"],), (["STEM.Technology|500"],), (["History_and_Society.Transport|600"],), (["Other|700"],)]
    got = [r[0] for r in spark.createDataFrame(rows, "t array<string>").select(domains.tag_domains(F.col("t"))).collect()]
    assert got == [[2], [1], [5], []]


def judge_one(spark, word, buckets=(), parts=(), units=(), dom=(), **kw):
    df = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    r = judge.judged(df([(word,), (None,)], "word string"), df(buckets, "key string, bucket int"), df(parts, "part string, frequency bigint"),
                     df(dom, "word string, domain int"), df(units, "key string, cnt bigint"), **kw).collect()
    assert len(r) == 1
    return r[0]["verdict"], r[0]["reason"]


def test_judgments(spark):
    assert judge_one(spark, "幽霊参照", parts=[("幽霊", 8220), ("参照", 42449)]) == ("Coined", "Constituent")
    assert judge_one(spark, "痕跡検出", parts=[("痕跡", 118), ("検出", 32179)]) == ("Coined", "Unregistered")
    assert judge_one(spark, "静的の解析") == ("NotCandidate", "Span")
    assert judge_one(spark, "電子署名", buckets=[("電子署名", 7)]) == ("Established", "Dictionary")
    assert judge_one(spark, "電子署名", buckets=[("電子署名", 2), ("電子署名", 1)]) == ("Established", "HighFrequency")
    assert judge_one(spark, "電子署名", buckets=[("電子署名", 1)]) == ("Gray", "LowFrequency")
    pair = [("検証認証", 3), ("認証データ", 2)]
    assert judge_one(spark, "検証認証データ", buckets=pair, rule="established") == ("Established", "Concatenation")
    assert judge_one(spark, "検証認証データ", buckets=pair, rule="gray") == ("Gray", "Concatenation")
    assert judge_one(spark, "検証認証データ", buckets=pair[:1], rule="established")[0] == "Coined"
    comp = dict(rule="composition", parts=[("検証", 900), ("データ", 500)], upper=300, lower=100)
    assert judge_one(spark, "検証認証データ", units=[("検証認証", 400)], **comp) == ("Coined", "Composition")
    assert judge_one(spark, "検証認証データ", units=[("検証認証", 140)], **comp) == ("Gray", "Composition")
    assert judge_one(spark, "検証認証データ", units=[("検証認証", 5)], **comp) == ("Coined", "Unregistered")
    dom = dict(buckets=[("樹形図解", 4)], dom=[("樹形図解", 2), ("樹形図解", 3)])
    assert judge_one(spark, "樹形図解", **dom, document_domain=1) == ("RepurposeCandidate", "Domain")
    assert judge_one(spark, "樹形図解", **dom, document_domain=2)[0] == "Established"
    with pytest.raises(ValueError):
        judge_one(spark, "x", rule="none")
    with pytest.raises(ValueError):
        judge_one(spark, "x", lower=5, upper=1)


def test_ratio_text(spark):
    df = spark.createDataFrame([(192, 200), (0, 0)], "k bigint, n bigint")
    assert [r[0] for r in df.select(judge.ratio_text(F.col("k"), F.col("n"))).collect()] == ["192/200 (96.0%)", "0/0"]
