"""Evaluation items inside a corpus.

Texts are reduced to their letters and digits. Windows of WINDOW of them are fingerprinted with SimHash over
character trigrams: of the items at every place, of the documents at every STEP-th. A multi-index of four 16-bit
blocks finds all item fingerprints within RADIUS bits of a document's (with more blocks than the radius, one block
must agree). What is verified exactly is the share of the item, by weight, that lies under 12-character shingles which
the document has too. Shingles that many items share weigh less.

The windows lose no pair that the exact check accepts: a shared shingle holds a whole window of the document, as
WINDOW + STEP - 1 <= SHINGLE, and whatever such shingles cover of an item lies within STEP - 1 letters before and
SHINGLE letters from the beginnings of the item's windows that were found. So only pairs are passed over in which those
stretches together weigh less than the cut.

Items of fewer than SHINGLE letters have no shingle. Of these, pieces of half their letters (LEAST at least, or all if there
are fewer) are matched by an automaton, and what share of the item they cover decides.

The items are the query set: they are taken in blocks of at most BLOCK_CHARS characters, each shipped to the
tasks once; the corpus is read block-wise and never shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from ._batches import pieces

GRAM = 3
WINDOW = 9
STEP = 4
RADIUS = 3
SHINGLE = 12
#: Characters of items that are shipped to the tasks at once (an index of about 40 bytes a character).
BLOCK_CHARS = 2_000_000
#: Characters of a batch that are fingerprinted at once, a multiple of STEP.
BLOCK = 1 << 19
#: Letters of a piece of a short item at least.
LEAST = 4
_B = np.uint64(0x9E3779B97F4A7C15)
_NO = re.compile(r"[\W_]+")


def letters(text: str) -> str:
    return _NO.sub("", unicodedata.normalize("NFKC", text).lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n characters from each place on (the last n - 1 places left out)."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        h *= _B
        h += codes[j : j + m]
    return _mix(h * _B)


def _fingerprints(codes: np.ndarray, step: int) -> np.ndarray:
    """SimHash of the windows that start at multiples of step (1 or 4); bit i is set if over half of the 7 grams have it."""
    g = _grams(codes, GRAM)
    k = WINDOW - GRAM + 1
    n = len(g) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if step == STEP:
        n = (n - 1) // STEP + 1
        b = np.unpackbits(g[: n * STEP + k - STEP].view(np.uint8)).reshape(-1, 64)
        b = np.concatenate([b, np.zeros((2 * STEP - k, 64), np.uint8)]).reshape(n + 1, STEP, 64)
        part = b[:, 0] + b[:, 1] + b[:, 2]
        sums = part[:n] + b[:n, 3] + part[1:]
    else:
        bits = np.unpackbits(g.view(np.uint8)).reshape(-1, 64)
        sums = bits[:n].copy()
        for j in range(1, k):
            sums += bits[j : j + n]
    return np.packbits(sums > k // 2).view(np.uint64)


class _Index:
    """Fingerprints, shingles and weights of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        texts = [letters(t) for _, t in items]
        self.short = {k: t for k, t in enumerate(texts) if 0 < len(t) < SHINGLE}
        self.pieces = None
        if self.short:
            import ahocorasick
            places: dict[str, list[tuple[int, int]]] = {}
            for k, t in self.short.items():
                n = min(len(t), max(LEAST, -(-len(t) // 2)))
                for i in range(len(t) - n + 1):
                    places.setdefault(t[i : i + n], []).append((k, i))
            self.pieces = ahocorasick.Automaton()
            for g, at in places.items():
                self.pieces.add_word(g, (len(g), at))
            self.pieces.make_automaton()
        long = [k for k, t in enumerate(texts) if len(t) >= SHINGLE]
        grams = {k: _grams(_codes(texts[k]), SHINGLE) for k in long}
        values, counts = np.unique(np.concatenate([np.unique(g) for g in grams.values()]) if grams else np.zeros(0, dtype=np.uint64), return_counts=True)
        self.grams = grams
        self.weight = {}
        self.total = np.full(len(texts), np.inf)
        fps, owner, reach = [], [], []
        for k, g in grams.items():
            w = 1.0 / counts[np.searchsorted(values, g)]
            cover = lambda x, g=g: np.convolve(x, np.ones(SHINGLE))
            self.weight[k] = w = cover(w) / cover(np.ones(len(g)))
            self.total[k] = w.sum()
            f, which = np.unique(_fingerprints(_codes(texts[k]), 1), return_inverse=True)
            at = np.arange(len(which))
            below = np.append(0, np.cumsum(w))
            fps.append(f)
            owner.append(np.full(len(f), k))
            # all weight that shingles around a window's places can cover
            reach.append(np.bincount(which, below[np.minimum(at + SHINGLE, len(w))] - below[np.maximum(at - STEP + 1, 0)]))
        fp = np.concatenate(fps) if fps else np.zeros(0, dtype=np.uint64)
        own = np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64)
        reach = np.concatenate(reach) if reach else np.zeros(0)
        order = np.lexsort((own, fp))
        fp, own, self.reach = fp[order], own[order], reach[order]
        self.fp, first = np.unique(fp, return_index=True)
        self.own, self.first = own, np.append(first, len(own))
        self.blocks = []
        for j in range(4):
            key = ((self.fp >> np.uint64(16 * j)) & np.uint64(0xFFFF)).astype(np.int64)
            at = np.argsort(key, kind="stable")
            self.blocks.append((np.searchsorted(key[at], np.arange(65537)), at))

    def near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in fps, place in self.fp) within RADIUS bits."""
        left, right = [], []
        for j, (starts, at) in enumerate(self.blocks):
            key = ((fps >> np.uint64(16 * j)) & np.uint64(0xFFFF)).astype(np.int64)
            a, n = starts[key], starts[key + 1] - starts[key]
            i = np.repeat(np.arange(len(fps)), n)
            k = at[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)]
            x = fps[i] ^ self.fp[k]
            ok = np.bitwise_count(x) <= RADIUS
            for e in range(j):  # found by an earlier block already
                ok &= (x >> np.uint64(16 * e)) & np.uint64(0xFFFF) != 0
            left.append(i[ok])
            right.append(k[ok])
        return np.concatenate(left), np.concatenate(right)

    def short_similarities(self, text: str) -> dict[int, float]:
        """Share of each short item's letters under pieces that the text holds."""
        covered: dict[int, set[int]] = {}
        for n, at in {id(x): x for _, x in self.pieces.iter(text)}.values():
            for k, i in at:
                covered.setdefault(k, set()).update(range(i, i + n))
        return {k: len(x) / len(self.short[k]) for k, x in covered.items()}

    def similarity(self, k: int, shingles: np.ndarray) -> float:
        """Share of item k, by weight, under shingles that are among the sorted ones given."""
        g = self.grams[k]
        p = np.searchsorted(shingles, g)
        has = shingles[np.minimum(p, len(shingles) - 1)] == g
        cover = np.convolve(has, np.ones(SHINGLE)) > 0.5
        w = self.weight[k]
        return float(w[cover].sum() / w.sum())


def _search(items: list[tuple[int, str]], cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(items)
        many = max(1, 2_000_000 // max(1, len(items)))
        for whole in batches:
            for b in pieces(whole, 1, rows=min(2000, many)):
                yield _batch(index, b, cut)
    return run


def _batch(index: _Index, b: pa.RecordBatch, cut: float) -> pa.RecordBatch:
    ids, out = b.column(0), []
    texts = [letters(t) for t in b.column(1).to_pylist()]
    start, parts, n = np.zeros(len(texts), dtype=np.int64), [], 0
    for d, t in enumerate(texts):  # each document starts at a multiple of STEP, zeros keep windows apart
        start[d] = n
        pad = 16 + (-len(t)) % STEP
        parts += [t, "\0" * pad]
        n += len(t) + pad
    codes = _codes("".join(parts))
    if len(index.fp):
        m = len(index.ids)
        most = np.zeros(len(texts) * m)
        for at in range(0, len(codes), BLOCK):  # a fingerprint takes 64 bytes a character while it is made
            i, k = index.near(_fingerprints(codes[at : at + BLOCK + WINDOW], STEP))
            doc = np.searchsorted(start, i * STEP + at, side="right") - 1
            hit = np.unique(doc * len(index.fp) + k)  # a repeated window reaches no more than one
            doc, k = hit // len(index.fp), hit % len(index.fp)
            reps = index.first[k + 1] - index.first[k]
            e = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps - index.first[k], reps)
            most += np.bincount(np.repeat(doc, reps) * m + index.own[e], index.reach[e], minlength=len(most))
        need = np.tile(index.total * max(cut, 1e-9) * (1 - 1e-6), len(texts))
        out = [divmod(int(p), m) for p in np.flatnonzero(most >= need)]
    rows, seen, shingles = [], -1, None
    for d, o in out:
        if d != seen:
            seen = d
            shingles = np.sort(_grams(codes[start[d] : start[d] + len(texts[d])], SHINGLE))
        if len(shingles) and (s := index.similarity(o, shingles)) >= cut:
            rows.append((d, o, s))
    if index.short:
        rows += [(d, o, x) for d, t in enumerate(texts) for o, x in index.short_similarities(t).items() if x >= cut]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array([r[0] for r in rows], pa.int64())), pa.array([int(index.ids[r[1]]) for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())],
        names=["doc_id", "item_id", "similarity"])


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for i, t in items.where("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator():
        if block and size + len(t) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    yield block


def leaks(documents: DataFrame, items: DataFrame, cut: float = 0.5) -> DataFrame:
    """doc_id, item_id, similarity of every document that holds at least `cut` of an item, in one or more pieces.

    Case, width, punctuation, blanks and line breaks do not matter; other small alterations cost the characters they
    touch. Items of fewer than LEAST letters must be held whole, items and documents without letters hold
    nothing. Null texts and ids are left out; repeated documents come out as often as they are given; an item_id given
    with several texts counts by the best of them. An empty table gives no rows.
    """
    d = spread(documents.where("doc_id is not null and text is not null").select("doc_id", "text"), "doc_id")
    found = None
    for block in _item_blocks(items):
        part = d.mapInArrow(_search(block, cut), "doc_id bigint, item_id bigint, similarity double")
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def leaked_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, suite, n_docs, best: of every item in how many documents it leaked, 0 and null where in none."""
    n = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("similarity").alias("best"))
    return items.select("item_id", "suite").distinct().join(n, "item_id", "left").select(
        "item_id", "suite", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "best")
