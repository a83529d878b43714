"""Mixing sources to target shares of all tokens, by a low-discrepancy schedule.

The documents of a source, in the order of a seeded hash, form a stream of tokens that is cut into blocks of equal
token counts (documents are cut at the blocks' edges) and repeated as often as its cap lets it. Slot i of the mix takes its source from the point i times the
golden ratio (mod 1) among the cumulative weights of the sources, so every stretch of the mix has nearly the target
shares; slot and block are joined by the rank of the slot among its source's.

Ranks and running sums are taken in two steps, within chunks and over the chunks' sums, so that no source, however
large, passes through one task.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import folded
from ..session import spread, staged

#: Fixed value: how the rank files' tokenizers split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the fractional part of the golden ratio.
GOLDEN = 0.6180339887498949
SLOT_CHUNK = 50_000
#: Chunks that all sources' streams are cut into together, at most 1024 a source: what is collected and broadcast of them.
CHUNKS = 200_000


@lru_cache(maxsize=2)
def _counter(path: str):
    """A function from a list of texts to their token counts, by the kind of the vocabulary file."""
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(x) for x in t.encode_batch(texts, add_special_tokens=False)]
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(e.encode_ordinary(x)) for x in texts]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for b in batches:
            n = count([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "tokens"])
    return run


def token_sizes(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source (spellings made one; null stays null), tokens by a vocabulary file; null and empty texts have 0."""
    d = documents.where("doc_id is not null").select("doc_id", folded(F.col("source")).alias("source"), "text")
    return spread(d, "doc_id").mapInArrow(_count(tokenizer), "doc_id bigint, source string, tokens bigint")


def allot(targets: list[tuple[str, float, int | None]], held: dict[str, int], total: float) -> dict[str, float]:
    """Tokens to draw of each source: its share of total, at most cap times what it holds; what a source falls short of
    is shared out among the rest in proportion to their shares, as long as their caps let them."""
    limit = {s: (held.get(s, 0) * c if c is not None else (float("inf") if held.get(s) else 0)) for s, _, c in targets}
    share = {s: w for s, w, _ in targets if w and w > 0}
    out = {s: 0.0 for s, _, _ in targets}
    free, left = set(share), float(total)
    while free and left > 1e-9:
        w = sum(share[s] for s in free)
        full = {s for s in free if out[s] + left * share[s] / w >= limit[s]}
        if not full:
            for s in free:
                out[s] += left * share[s] / w
            break
        for s in full:
            left -= limit[s] - out[s]
            out[s] = float(limit[s])
        free -= full
    return out


class Plan:
    """Sizes, allotment and staged streams of a mix; sources are those of the targets, which must fit the driver."""

    def __init__(self, documents: DataFrame, targets: DataFrame, total_tokens: int | None, block_tokens: int, seed: int, tokenizer: str, max_sources: int):
        spark = documents.sparkSession
        rows = (
            targets.where("source is not null").select(folded(F.col("source")).alias("s"), "target_share", "max_repeats")
            .groupBy("s").agg(F.sum("target_share").alias("w"), F.max("max_repeats").alias("c"), F.max(F.col("max_repeats").isNull()).alias("free"))
            .orderBy("s").limit(max_sources + 1).collect()
        )
        if len(rows) > max_sources:
            raise ValueError(f"more than {max_sources} sources")
        self.targets = [(r["s"], float(r["w"] or 0), None if r["free"] else max(0, r["c"])) for r in rows]
        names = [s for s, _, _ in self.targets]
        sizes = token_sizes(documents, tokenizer)
        bits = max(1, min(10, (CHUNKS // max(1, len(names))).bit_length() - 1))
        self.docs = staged(sizes.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("chunk", F.shiftright("h", 64 - bits)))
        known = self.docs.where(F.col("source").isin(names) & (F.col("tokens") > 0)) if names else self.docs.limit(0)
        sums = known.groupBy("source", "chunk").agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("d")).collect()  # at most CHUNKS rows
        self.held: dict[str, int] = {}
        self.n_docs: dict[str, int] = {}
        offsets = []
        for s, c, n, d in sorted((r["source"], r["chunk"], r["n"], r["d"]) for r in sums):
            offsets.append((s, c, self.held.get(s, 0)))
            self.held[s] = self.held.get(s, 0) + n
            self.n_docs[s] = self.n_docs.get(s, 0) + d
        self.total = total_tokens or sum(self.held.get(s, 0) for s, w, _ in self.targets if w > 0)
        self.draw = allot(self.targets, self.held, self.total)
        self.block = block_tokens
        self.known = known
        self.offsets = spark.createDataFrame(offsets, "source string, chunk bigint, offset bigint")
        self.sources = spark.createDataFrame(
            [(s, self.held.get(s, 0), int(round(self.draw[s]))) for s in names if self.held.get(s) and self.draw[s] >= 1], "source string, held bigint, quota bigint")

    def stream(self) -> DataFrame:
        """source, doc_id, tokens, copy, at: every drawn copy of a document and its first token's place in its source's stream.

        Drawn are the copies that start before the quota; of the last one only the tokens up to it.
        """
        w = Window.partitionBy("source", "chunk").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        placed = (
            self.known.withColumn("within", F.coalesce(F.sum("tokens").over(w), F.lit(0)))
            .join(F.broadcast(self.offsets), ["source", "chunk"]).join(F.broadcast(self.sources), "source")
            .withColumn("first", F.col("within") + F.col("offset"))
        )
        copies = F.floor((F.col("quota") - 1 - F.col("first")) / F.col("held"))  # last copy that starts before the quota
        at = F.col("copy") * F.col("held") + F.col("first")
        return (
            placed.where("first < quota").select("source", "doc_id", "tokens", "first", "held", "quota", F.explode(F.sequence(F.lit(0).cast("bigint"), copies)).alias("copy"))
            .select("source", "doc_id", F.least("tokens", F.col("quota") - at).alias("tokens"), "copy", at.alias("at"))
        )

    def pieces(self) -> DataFrame:
        """source, block, doc_id, copy, first_token, tokens, at: the stream cut into blocks; all but a source's last are full.

        first_token: the piece's first token within its document.
        """
        size = F.lit(self.block)
        last = F.floor((F.col("at") + F.col("tokens") - 1) / size)
        begin, end = F.greatest(F.col("at"), F.col("block") * size), F.least(F.col("at") + F.col("tokens"), (F.col("block") + 1) * size)
        return self.stream().withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / size), last))).select(
            "source", "block", "doc_id", "copy", (begin - F.col("at")).alias("first_token"), (end - begin).alias("tokens"), begin.alias("at"))

    def blocks(self) -> dict[str, int]:
        """Blocks of every drawn source."""
        return {s: -(-int(round(q)) // self.block) for s, q in self.draw.items() if q >= 1}

    @staticmethod
    def n_slots(need: dict[str, int]) -> int:
        """A few slots more than blocks, as a source's slots can lag behind its share by a few."""
        return sum(need.values()) + 8 * len(need) + 8

    def slots(self) -> DataFrame:
        """slot, source, block: the mix in order; the k-th slot of a source takes the k-th block of its stream."""
        spark = self.docs.sparkSession
        need = self.blocks()
        if not need:
            return spark.createDataFrame([], "slot bigint, source string, block bigint")
        whole, total = sum(need.values()), 0
        bounds = []
        for s in sorted(need):
            total += need[s]
            bounds.append((s, total / whole))
        names, edges = [x for x, _ in bounds], np.array([x for _, x in bounds[:-1]])

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sources = pa.array(names)
            for b in batches:
                at = np.searchsorted(edges, (0.5 + b.column(0).to_numpy() * GOLDEN) % 1.0, side="right")
                yield pa.RecordBatch.from_arrays([b.column(0), sources.take(pa.array(at))], names=["slot", "source"])

        made = spark.range(self.n_slots(need)).mapInArrow(pick, "slot bigint, source string").withColumn("part", F.floor(F.col("slot") / SLOT_CHUNK))
        per = made.groupBy("source", "part").agg(F.count(F.lit(1)).alias("c"))
        before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        off = per.select("source", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("o"))
        rank = F.row_number().over(Window.partitionBy("source", "part").orderBy("slot"))
        return made.withColumn("r", rank).join(off, ["source", "part"]).select("slot", "source", (F.col("r") - 1 + F.col("o")).alias("block"))


def plan(documents: DataFrame, targets: DataFrame, tokenizer: str, total_tokens: int | None = None, block_tokens: int = 8192, seed: int = 1, max_sources: int = 10_000) -> Plan:
    """The plan of a mix of total_tokens (all tokens of the wanted sources by default), counted by a tokenizer's vocabulary file.

    Tokens are counted and summed per source and chunk here; the streams and slots are made when they are read.

    documents: doc_id, source, text; targets: source, target_share, max_repeats (null: no cap). Spellings of a source are
    one; documents of no or an unlisted source, and those without tokens, are not drawn. Shares need not sum to 1. A
    source without documents or with share 0 draws nothing. Repeated doc_ids are drawn each for itself.
    """
    return Plan(documents, targets, total_tokens, block_tokens, seed, tokenizer, max_sources)


def mixed(p: Plan) -> DataFrame:
    """slot, source, block, at, doc_id, copy, first_token, tokens: every drawn piece; ordered by slot and at it is the mix.

    Blocks whose slot would lie behind the schedule's end come last, each in a slot of its own that follows.
    """
    need = p.blocks()
    order = p.docs.sparkSession.createDataFrame([(s, i) for i, s in enumerate(sorted(need))], "source string, _i bigint")
    m = p.pieces().join(p.slots(), ["source", "block"], "left").join(F.broadcast(order), "source")
    late = F.lit(p.n_slots(need)) + F.col("block") * len(need) + F.col("_i")
    return m.select(F.coalesce("slot", late).alias("slot"), "source", "block", "at", "doc_id", "copy", "first_token", "tokens")


def shares(p: Plan) -> DataFrame:
    """source, target_share, max_repeats, held_docs, held_tokens, drawn_docs, drawn_tokens, share, repeats of every target source.

    share: of all drawn tokens (0 where nothing is drawn); repeats: the most copies of one document.
    """
    spark = p.docs.sparkSession
    t = spark.createDataFrame([(s, w, c, p.n_docs.get(s, 0), p.held.get(s, 0)) for s, w, c in p.targets],
                              "source string, target_share double, max_repeats int, held_docs bigint, held_tokens bigint")
    drawn = p.stream().groupBy("source").agg(F.count(F.lit(1)).alias("drawn_docs"), F.sum("tokens").alias("drawn_tokens"), (F.max("copy") + 1).alias("repeats"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    j = t.join(drawn, "source", "left").select(*t.columns, zero("drawn_docs"), zero("drawn_tokens"), zero("repeats"))
    whole = j.agg(F.sum("drawn_tokens").alias("whole"))
    return j.join(F.broadcast(whole)).withColumn("share", F.when(F.col("whole") > 0, F.col("drawn_tokens") / F.col("whole")).otherwise(0.0)).drop("whole")
