"""Consensus of several annotators who each put an item into a set of categories.

Mean-field variational confusion model. A candidate is an item and a category that at least one annotator gave it;
its class is present or absent. Of each candidate an annotator's report is one of four symbols: hit (gave the
category), below or above (did not, but gave the category one lower or higher) and miss. Class proportions per
category and every annotator's row of symbol probabilities per class carry Dirichlet priors; their variational
posteriors are updated through digamma expectations of group-by sums, in turn with the candidates' class
probabilities. Annotators that copy each other share their weight. Independent annotators agree no more than their
reliabilities explain, which are got from how each agrees with pairs of others; the weight of each is one over one
plus its summed excess agreement.

The candidates stay distributed; only sums whose size is annotators squared leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: The category numbers of the scheme, as inclusive ranges.
SCHEME = ((10, 19), (20, 27), (30, 38), (40, 47), (50, 57))

SYMBOLS = ("hit", "below", "above", "miss")
#: Annotators the model takes; more is an error, since the sums kept of annotator pairs grow with its square.
MAX_ANNOTATORS = 256
#: Dirichlet prior counts: of the symbols in class absent and present, and of the classes.
PRIOR_ROWS = np.array([[1.0, 0.5, 0.5, 6.0], [6.0, 1.0, 1.0, 2.0]])
PRIOR_CLASS = np.array([1.0, 1.0])


def _valid(c: Column) -> Column:
    test = F.lit(False)
    for lo, hi in SCHEME:
        test = test | c.between(lo, hi)
    return test


def annotator(c: Column) -> Column:
    return F.lower(F.trim(c))


def usable_lines(df: DataFrame) -> DataFrame:
    """word, model, pass_seed, cats: per word, model and pass the line with the latest received_at, if it has categories.

    Model spellings that differ in case or outer blanks are one. Lines with a null word or a null or blank model belong
    to nobody and are left out. cats is sorted, without repeats, nulls and numbers outside the scheme; it may be empty.
    """
    d = df.where(F.col("word").isNotNull()).withColumn("model", annotator(F.col("model"))).where("model is not null and model <> ''")
    latest = d.groupBy("word", "model", "pass_seed").agg(
        F.max(F.struct(F.col("received_at"), F.col("categories").isNotNull().alias("has"), F.col("categories"))).alias("l"))
    cats = F.array_sort(F.array_distinct(F.filter("l.categories", lambda x: _valid(x))))
    return latest.where("l.has").select("word", "model", "pass_seed", cats.alias("cats"))


def annotators(lines: DataFrame) -> list[str]:
    names = [r[0] for r in lines.select("model").distinct().orderBy("model").limit(MAX_ANNOTATORS + 1).collect()]
    if len(names) > MAX_ANNOTATORS:
        raise ValueError(f"more than {MAX_ANNOTATORS} annotators")
    return names


def candidates(lines: DataFrame, names: list[str]) -> DataFrame:
    """word, category, votes, n_models: votes holds for each annotator the shares of its passes with each symbol.

    Where an annotator did not judge the word its four shares are 0. Several passes of one annotator are one vote.
    """
    sets = lines.groupBy("word", "model", "cats").agg(F.count(F.lit(1)).alias("c"))  # however many passes, few distinct sets
    idx = F.create_map(*[x for i, m in enumerate(names) for x in (F.lit(m), F.lit(i))]) if names else F.create_map().cast("map<string,int>")
    words = sets.select("word", F.struct(idx[F.col("model")].alias("m"), "cats", "c").alias("j")).groupBy("word").agg(
        F.array_sort(F.collect_list("j")).alias("judged"))
    return words.mapInArrow(_expander(len(names)), "word string, category int, votes array<float>, n_models int")


def _expander(n: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, cats, votes, counts = [], [], [], []
            for word, judged in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                passes: dict[int, int] = {}
                for j in judged:
                    passes[j["m"]] = passes.get(j["m"], 0) + j["c"]
                for c in sorted({c for j in judged for c in j["cats"]}):
                    v = np.zeros((n, 4), dtype=np.float32)
                    for j in judged:
                        p = j["cats"]
                        v[j["m"], 0 if c in p else 1 if c - 1 in p else 2 if c + 1 in p else 3] += j["c"] / passes[j["m"]]
                    words.append(word)
                    cats.append(c)
                    votes.append(v.ravel())
                    counts.append(len(passes))
            if words:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array(cats, pa.int32()), pa.array(votes, pa.list_(pa.float32())), pa.array(counts, pa.int32())],
                    names=["word", "category", "votes", "n_models"])
    return expand


def digamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    out = np.zeros_like(x)
    while (small := x < 6).any():
        out[small] -= 1 / x[small]
        x[small] += 1
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f / 240)))


@dataclass
class State:
    """Variational parameters: rows[annotator, class, symbol], classes[category, class], weight[annotator]."""

    rows: np.ndarray
    classes: np.ndarray
    weight: np.ndarray

    def expectations(self) -> tuple[np.ndarray, np.ndarray]:
        e = digamma(self.rows) - digamma(self.rows.sum(-1, keepdims=True))
        c = digamma(self.classes) - digamma(self.classes.sum(-1, keepdims=True))
        return (e[:, 1] - e[:, 0]) * self.weight[:, None], c[:, 1] - c[:, 0]


def _present(votes: np.ndarray, cats: np.ndarray, ratio: np.ndarray, prior: np.ndarray) -> np.ndarray:
    z = prior[cats] + votes.reshape(len(votes), -1) @ ratio.ravel()
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _read(b: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    v = b.column(b.schema.get_field_index("votes"))
    flat = v.flatten().to_numpy(zero_copy_only=False).reshape(len(b), n, 4)
    return flat, b.column(b.schema.get_field_index("category")).to_numpy(zero_copy_only=False)


def _agreement(n: int):
    """Partial sums of a task: reports that two annotators share, and those of one on candidates that the other judged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, own = np.zeros((n, n)), np.zeros((n, n))
        for b in batches:
            v, _ = _read(b, n)
            hit, judged = v[:, :, 0].astype(float), (v.sum(2) > 0).astype(float)
            both += hit.T @ hit
            own += hit.T @ judged
        flat = np.concatenate([both.ravel(), own.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int64)), pa.array(flat)], names=["i", "x"])
    return run


def _sums(n: int, k: int, weight: np.ndarray, ratio: np.ndarray | None, prior: np.ndarray | None):
    """Partial sums of a task: symbol sums per annotator and class, class sums per category."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, classes = np.zeros((n, 2, 4)), np.zeros((k, 2))
        for b in batches:
            v, cats = _read(b, n)
            if ratio is None:  # at first, the weighted share of annotators that gave the category
                q = v[:, :, 0] @ weight / np.maximum((v.sum(2) > 0) @ weight, 1e-9)
            else:
                q = _present(v, cats, ratio, prior)
            rows[:, 1] += np.einsum("u,unv->nv", q, v)
            rows[:, 0] += np.einsum("u,unv->nv", 1 - q, v)
            np.add.at(classes[:, 1], cats, q)
            np.add.at(classes[:, 0], cats, 1 - q)
        flat = np.concatenate([rows.ravel(), classes.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int64)), pa.array(flat)], names=["i", "x"])
    return run


def _collected(cands: DataFrame, part, size: int) -> np.ndarray:
    sums = np.zeros(size)
    for i, x in cands.select("category", "votes").mapInArrow(part, "i bigint, x double").groupBy("i").agg(F.sum("x")).collect():
        sums[i] = x
    return sums


def independence(both: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Weights of annotators from the sums of _agreement().

    a[i, j], the share of reports in common, is near r[i] * r[j] for independent annotators, so a[i, j] * a[i, k] /
    a[j, k] is near r[i] squared; the median over all j, k holds while fewer than half of the pairs hold a copy of i.
    """
    n = len(both)
    a = (both + 1) / np.sqrt((own + 2) * (own.T + 2))
    np.fill_diagonal(a, np.nan)
    if n < 3:
        return np.ones(n)
    r = np.empty(n)
    for i in range(n):
        o = [j for j in range(n) if j != i]
        t = np.array([a[i, j] * a[i, k] / a[j, k] for x, j in enumerate(o) for k in o[x + 1 :]])
        r[i] = np.sqrt(np.clip(np.median(t), 1e-6, 1))
    fair = np.outer(r, r)
    excess = np.nan_to_num(np.clip((a - fair) / np.maximum(1 - fair, 1e-6), 0, 1))
    return 1 / (1 + np.clip((excess - SHARED_FROM) / SHARED_OVER, 0, 1).sum(1))


#: Excess agreement from which an annotator's errors count as shared, and from there on until they are wholly so.
SHARED_FROM, SHARED_OVER = 0.4, 0.3


def fit(cands: DataFrame, names: list[str], iterations: int = 40, tolerance: float = 0.0005) -> State:
    """Coordinate ascent; each iteration is one pass of group-by sums over the candidates.

    It ends when no posterior mean of an annotator's row moves by more than the tolerance, or after so many iterations.
    """
    n, k = len(names), SCHEME[-1][1] + 1
    weight = independence(*_collected(cands, _agreement(n), 2 * n * n).reshape(2, n, n))
    state, ratio, prior, before = None, None, None, None
    for _ in range(iterations):
        sums = _collected(cands, _sums(n, k, weight, ratio, prior), n * 8 + k * 2)
        state = State(sums[: n * 8].reshape(n, 2, 4) + PRIOR_ROWS, sums[n * 8 :].reshape(k, 2) + PRIOR_CLASS, weight)
        ratio, prior = state.expectations()
        mean = state.rows / state.rows.sum(2, keepdims=True)
        if before is not None and np.abs(mean - before).max() < tolerance:
            break
        before = mean
    return state


def _score(n: int, ratio: np.ndarray, prior: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, cats = _read(b, n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.array(_present(v, cats, ratio, prior)), pa.array(v[:, :, 0].sum(1).astype(float))],
                names=["word", "category", "n_models", "probability", "support"])
    return run


def _fitted(df: DataFrame) -> tuple[DataFrame, DataFrame, list[str], State | None]:
    lines = staged(usable_lines(df))
    names = annotators(lines)
    cands = staged(candidates(lines, names))
    return lines, cands, names, fit(cands, names) if names else None


def posteriors(df: DataFrame) -> DataFrame:
    """word, category, n_models, probability, support: of every candidate, how likely the category belongs to the word.

    n_models: annotators with usable lines of the word; support: how many gave the category (passes as shares). Input:
    word, model, pass_seed, categories, received_at. Words whose usable lines are all empty have no candidate. An empty
    table gives no rows.
    """
    _, cands, names, state = _fitted(df)
    out = "word string, category int, n_models int, probability double, support double"
    if state is None:
        return cands.sparkSession.createDataFrame([], out)
    return cands.mapInArrow(_score(len(names), *state.expectations()), out)


def consensus(df: DataFrame, min_models: int = 5, cut: float = 0.5) -> DataFrame:
    """word, categories, certainty, agreement, n_models: the categories with probability >= cut of words with min_models annotators.

    certainty: the product of the probabilities of all decisions on the word; agreement: over all pairs of its
    annotators and its candidates, the share of pairs that agree. Words left without a category have an empty list.
    """
    p = posteriors(df).where(F.col("n_models") >= min_models)
    yes = F.col("probability") >= cut
    n, k = F.col("n_models").cast("double"), F.col("support")
    return p.groupBy("word").agg(
        F.array_sort(F.collect_list(F.when(yes, F.col("category")))).alias("categories"),
        F.exp(F.sum(F.log(F.greatest(F.when(yes, F.col("probability")).otherwise(1 - F.col("probability")), F.lit(1e-12))))).alias("certainty"),
        F.avg((k * (k - 1) + (n - k) * (n - k - 1)) / (n * (n - 1))).alias("agreement"),
        F.first("n_models").alias("n_models"),
    )


def agreement(df: DataFrame) -> DataFrame:
    """n_words, n_units, n_judgments, alpha: Krippendorff's nominal alpha over every word and category of the scheme.

    A unit is a word and a category; every usable line, that is every pass of an annotator, is a judgment that says
    whether it gave the category. Words with a single judgment have no pairs and are left out. alpha is null where there is no pair or no disagreement to expect.
    """
    lines = usable_lines(df)
    words = lines.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("cats")).alias("given"), F.flatten(F.collect_list("cats")).alias("all")).where("n >= 2")
    size = sum(hi - lo + 1 for lo, hi in SCHEME)
    # disagreement within a word: per category with k of n yes, k (n - k) ordered-pair halves over n - 1
    inside = F.aggregate(
        F.array_distinct("all"), F.lit(0.0),
        lambda acc, c: acc + F.size(F.filter("all", lambda x: x == c)) * (F.col("n") - F.size(F.filter("all", lambda x: x == c))))
    s = words.select("n", "given", (inside / (F.col("n") - 1)).alias("d")).agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n"), F.sum("given").alias("yes"), F.sum("d").alias("d"))
    total = F.coalesce(F.col("n"), F.lit(0)) * size
    no = total - F.col("yes")
    return s.select(
        "n_words", (F.col("n_words") * size).alias("n_units"), total.alias("n_judgments"),
        F.when((F.col("yes") > 0) & (no > 0), F.round(1 - (total - 1) * F.col("d") / (F.col("yes") * no), 9)).alias("alpha"))


def _beta_interval(a: float, b: float, level: float = 0.95) -> tuple[float, float]:
    x = np.linspace(0, 1, 20_001)[1:-1]
    logp = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    c = np.cumsum(np.exp(logp - logp.max()))
    c /= c[-1]
    return float(x[np.searchsorted(c, (1 - level) / 2)]), float(x[min(np.searchsorted(c, (1 + level) / 2), len(x) - 1)])


def reliability(df: DataFrame) -> DataFrame:
    """model, sensitivity and its 95 % interval, false_rate and its interval, independence, n_candidates: one row per annotator.

    sensitivity: how often it gives a category that belongs to the word; false_rate: how often one that does not, though
    some annotator gave it; both with posterior intervals; independence: 1 when its errors are its own, near 1/n for n
    annotators that copy each other.
    """
    _, cands, names, state = _fitted(df)
    rows = []
    for i, m in enumerate(names):
        r = state.rows[i]
        (a0, b0), (a1, b1) = ((x[0], x.sum() - x[0]) for x in r)
        rows.append((m, a1 / (a1 + b1), *_beta_interval(a1, b1), a0 / (a0 + b0), *_beta_interval(a0, b0), float(state.weight[i]), math.floor(r.sum() - PRIOR_ROWS.sum() + 0.5)))
    return cands.sparkSession.createDataFrame(
        [tuple(float(x) if isinstance(x, (float, np.floating)) else x for x in r) for r in rows],
        "model string, sensitivity double, sensitivity_low double, sensitivity_high double, false_rate double, false_low double, false_high double, independence double, n_candidates bigint")


def found(df: DataFrame, min_models: int = 5, cut: float = 0.5) -> DataFrame:
    """word, category of the consensus; see consensus()."""
    return posteriors(df).where((F.col("n_models") >= min_models) & (F.col("probability") >= cut)).select("word", "category")
