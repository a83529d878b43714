"""Feature rows of a word's occurrence in a dependency tree: shape, combination keys, counts of modifiers and case frames.

nodes of an occurrence: array of structs with id (0: the centre), position, parent (null: root), pos, cls (semantic class
of the head, else its part of speech), function, relation. All but the counts are expressions over one row's array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from ..functions.words import class_mid, class_top, class_top_or_value
from .counts import marginals
from .features import lg

NODES = "array<struct<id:int,position:int,parent:int,pos:string,cls:string,function:string,relation:string>>"
#: Columns of shape and of counts.
SHAPE = ("c_func c_rel c_nkids c_root c_kid_rels p_pos p_top p_mid p_func p_rel gp_pos gp_top n_sibs sib_rels sib_tops "
         "prev_pos prev_func next_pos next_func").split()
COUNTS = "m_kind m_top m_mid m_cnt m_share m_freq m_exp m_loan f_case f_cnt f_share f_pfreq f_exp f_loan f_vtop f_vmid".split()
#: Names of the combination keys.
COMBOS = ("格・述語分類", "格・述語大分類・述語機能語", "修飾の種類・修飾語分類", "格・述語分類・兄弟の関係", "中心の関係・係り元の関係", "前後の機能語・格", "修飾語分類・格・述語分類")


def _where(nodes: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(nodes, lambda n: F.coalesce(test(n), F.lit(False)))


def _one(nodes: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(_where(nodes, test), 0)


def _names(nodes: Column, name: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(F.transform(nodes, name))), "|"), F.lit("")), F.lit("-"))


def _around(nodes: Column) -> Column:
    """The centre c, its children, parent, grandparent, siblings, and the nodes before and after it."""
    def relatives(c: Column) -> Column:
        def more(par: Column) -> Column:
            return F.struct(
                c.alias("c"), _where(nodes, lambda n: n["parent"] == c["id"]).alias("kids"), par.alias("par"), _one(nodes, lambda n: n["id"] == par["parent"]).alias("gp"),
                _where(nodes, lambda n: (n["parent"] == par["id"]) & (n["id"] != c["id"])).alias("sibs"),
                _one(nodes, lambda n: n["position"] == c["position"] - 1).alias("prev"), _one(nodes, lambda n: n["position"] == c["position"] + 1).alias("next"))
        return let(_one(nodes, lambda n: n["id"] == c["parent"]), more)
    return let(_one(nodes, lambda n: n["id"] == 0), relatives)


def _or(c: Column, other: str = "-") -> Column:
    return F.coalesce(c, F.lit(other))


def shape(nodes: Column) -> Column:
    """Struct of the SHAPE columns; all null without a centre."""
    def made(a: Column) -> Column:
        c, kids, par, gp, sibs, prev, after = (a[k] for k in ("c", "kids", "par", "gp", "sibs", "prev", "next"))
        rel = lambda n: n["relation"]
        cols = [c["function"], c["relation"], F.size(kids), c["parent"].isNull().cast("int"), _names(kids, rel), _or(par["pos"]), _or(class_top(par["cls"])), class_mid(par["cls"]),
                _or(par["function"]), _or(par["relation"]), _or(gp["pos"]), _or(class_top(gp["cls"])), F.size(sibs), _names(sibs, rel), _names(sibs, lambda n: class_top(n["cls"])),
                _or(prev["pos"]), _or(prev["function"]), _or(after["pos"]), _or(after["function"])]
        return F.when(c.isNotNull(), F.struct(*[x.alias(n) for x, n in zip(cols, SHAPE)]))
    return let(_around(nodes), made)


def combos(nodes: Column) -> Column:
    """Array of (name, key): the seven combination keys of an occurrence, with the centre word hidden."""
    def made(a: Column) -> Column:
        c, kids, par, sibs, prev, after = (a[k] for k in ("c", "kids", "par", "sibs", "prev", "next"))
        rel = lambda n: n["relation"]
        mods = F.filter(kids, lambda n: n["position"] < c["position"])
        mod = F.try_element_at(mods, F.lit(-1))
        pm, mc = class_mid(par["cls"]), class_mid(mod["cls"])
        keys = [
            F.concat(c["function"], F.lit(">"), pm),
            F.concat(c["function"], F.lit(">"), _or(class_top_or_value(par["cls"])), F.lit("/"), _or(par["function"])),
            F.concat(_or(mod["function"]), F.lit(":"), mc),
            F.concat(c["function"], F.lit(">"), pm, F.lit("["), _names(sibs, rel), F.lit("]")),
            F.concat(c["relation"], F.lit("<"), _names(kids, rel)),
            F.concat(_or(prev["function"], "^"), F.lit("_"), c["function"], F.lit("_"), _or(after["function"], "$")),
            F.concat(mc, F.lit(">"), c["function"], F.lit(">"), pm),
        ]
        return F.array(*[F.struct(F.lit(n).alias("name"), k.alias("key")) for n, k in zip(COMBOS, keys)])
    return let(_around(nodes), made)


def counts(occurrences: DataFrame, modifiers: DataFrame, frames: DataFrame, loans: DataFrame, classes: DataFrame, verbs: DataFrame, min_count: int = 3) -> DataFrame:
    """occ_id and the COUNTS columns: how usual an occurrence's modifier and case frame are for its word.

    occurrences: occ_id, word, kind, modifier, case, predicate, own (1: the occurrence is among the counted ones and is
    taken off them, else 0); modifiers: word, kind, modifier, cnt; frames: word, case, predicate, cnt; loans: word,
    loanword; classes and verbs: word, code (the first code of a noun, of a verb or adjective). An occurrence without a
    modifier (kinds の, 連体, 連用) or case has - and null there. m_loan and f_loan: the largest log ratio of the rate of a
    loanword of the word, of at least min_count, over the word's own, in units of each one's modifiers.
    """
    o = occurrences.select("occ_id", "word", F.coalesce(F.nullif("kind", F.lit("")), F.lit("-")).alias("kind"), F.nullif("modifier", F.lit("")).alias("modifier"),
                           F.nullif("case", F.lit("")).alias("case"), "predicate", F.coalesce("own", F.lit(0)).alias("own"))
    mk = marginals(modifiers, ["word", "kind", "modifier"], [["word", "kind", "modifier"], ["word"], ["word", "kind"], ["kind", "modifier"], ["kind"]])
    fk = marginals(frames, ["word", "case", "predicate"], [["word", "case", "predicate"], ["word", "case"], ["case", "predicate"], ["case"]])

    def of(table: DataFrame, keys: list[str], every: list[str], name: str) -> DataFrame:
        level = sum(1 << (len(every) - 1 - i) for i, k in enumerate(every) if k not in keys)
        return table.where(F.col("level") == level).select(*keys, F.col("cnt").alias(name))

    m3, f3 = ["word", "kind", "modifier"], ["word", "case", "predicate"]
    mw = of(mk, ["word"], m3, "mw")

    def loan(table: DataFrame, every: list[str], name: str) -> DataFrame:
        c = of(table, every, every, "lc").where(F.col("lc") >= min_count).join(mw.withColumnRenamed("mw", "lw"), "word").withColumnRenamed("word", "loanword")
        rate = F.log((F.col("lc") + 0.5) / (F.col("lw") + 1))
        return loans.select("word", "loanword").distinct().join(c, "loanword").groupBy(*every).agg(F.max(rate).alias(name))

    d = o.join(mw, "word", "left")
    for table, every, names in ((mk, m3, {"m": m3, "mwk": m3[:2], "mkm": m3[1:], "mk": ["kind"]}), (fk, f3, {"f": f3, "fwc": f3[:2], "fcv": f3[1:], "fc": ["case"]})):
        for name, keys in names.items():
            d = d.join(of(table, keys, every, name), keys, "left")
    d = d.join(loan(mk, m3, "ml"), m3, "left").join(loan(fk, f3, "fl"), f3, "left")
    noun = classes.groupBy("word").agg(F.min("code").alias("code"))
    for k, part in enumerate((F.col("modifier"), F.substring("modifier", -2, 2), F.substring("modifier", -1, 1))):
        d = d.withColumn("_part", part).join(noun.select(F.col("word").alias("_part"), F.col("code").alias(f"_c{k}")), "_part", "left").drop("_part")
    verb = verbs.groupBy("word").agg(F.min("code").alias("code"))
    d = d.join(verb.select(F.col("word").alias("modifier"), F.col("code").alias("_c3")), "modifier", "left").join(verb.select(F.col("word").alias("predicate"), F.col("code").alias("_v")), "predicate", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    has_m, has_f = F.col("kind").isin("の", "連体", "連用") & F.col("modifier").isNotNull(), F.col("case").isNotNull()
    mc, fc, total = F.greatest(n("m") - F.col("own"), F.lit(0)), F.greatest(n("f") - F.col("own"), F.lit(0)), F.greatest(n("mw") - F.col("own"), F.lit(1))
    code, verb_code = F.coalesce("_c0", "_c1", "_c2", "_c3", F.lit("-")), F.coalesce("_v", F.lit("-"))
    own_rate = lambda c: F.log((c + 0.5) / (n("mw") + 1))
    share = lambda a, b, c: lg(n(a) * n(b) / F.greatest(n(c), F.lit(1)))
    text = lambda has, c: F.when(has, c).otherwise("-")
    num = lambda has, c: F.when(has, c)
    cols = [F.col("kind"), text(has_m, class_top(code)), text(has_m, class_mid(code)), num(has_m, lg(mc)), num(has_m, mc / total), num(has_m, lg(n("mkm"))), num(has_m, share("mwk", "mkm", "mk")), num(has_m, F.col("ml") - own_rate(mc)),
            text(has_f, F.col("case")), num(has_f, lg(fc)), num(has_f, fc / total), num(has_f, lg(n("fcv"))), num(has_f, share("fwc", "fcv", "fc")), num(has_f, F.col("fl") - own_rate(fc)), text(has_f, class_top(verb_code)), text(has_f, class_mid(verb_code))]
    return d.select("occ_id", *[c.alias(x) for c, x in zip(cols, COUNTS)])


def attached(occurrences: DataFrame, modifiers: DataFrame, frames: DataFrame, place: tuple[str, ...] = ("doc_id", "start", "end")) -> DataFrame:
    """occurrences with kind, modifier, case and predicate of the noun at the same place, null where there is none.

    modifiers: place, kind, modifier; frames: place, case, predicate. Of several at one place the smallest by their values holds.
    """
    on = list(place)
    first = lambda d, cols: d.groupBy(*on).agg(F.min(F.struct(*cols)).alias("_x")).select(*on, *[F.col(f"_x.{c}").alias(c) for c in cols])
    return occurrences.join(first(modifiers, ["kind", "modifier"]), on, "left").join(first(frames, ["case", "predicate"]), on, "left")


def rows(occurrences: DataFrame, counted: DataFrame, novelty: DataFrame, groups: list[str]) -> DataFrame:
    """occ_id, the 19 columns of shape, the 16 of counts, and mean, max and zero share of novelty for each group: one row an occurrence.

    occurrences: occ_id, nodes; counted: counts(); novelty: features.novelty() (occ_id, grp, mean, most, zero_share). With
    18 groups of keys these are 89 columns. What an occurrence lacks is null.
    """
    aggs = [F.max(F.when(F.col("grp") == g, F.col(c))).alias(f"{g}_{name}") for g in groups for c, name in (("mean", "mean"), ("most", "max"), ("zero_share", "zero"))]
    wide = novelty.groupBy("occ_id").agg(*aggs)
    s = occurrences.select("occ_id", shape(F.col("nodes")).alias("s")).select("occ_id", *[F.col(f"s.{c}").alias(c) for c in SHAPE])
    return s.join(counted, "occ_id", "left").join(wide, "occ_id", "left")
