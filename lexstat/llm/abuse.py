"""Abusive, hateful and sexual content by a bidirectional gated recurrent network.

A text is cut into word tokens. A token's input is the vector of its word and the mean of the vectors of its character
pairs and triples, nought where the training documents don't hold them; a bidirectional GRU reads windows of WINDOW tokens that overlap by WINDOW - STRIDE, attention pools
each window, and a window's three logits are pooled over the document. The network is trained in numpy on a bounded
sample of labelled documents (a label holds for a document, not for a place in it, so training pools all windows of a
document smoothly); every window of every document is scored. A part of the sample is held out of training; it and the
scores of all documents give the score from which a document counts, for each category its own (see cuts).
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import folded
from ..session import spread
from ._batches import pieces

CATEGORIES = ("abusive", "hateful", "sexual")
WINDOW, STRIDE = 36, 30
DIM, HIDDEN, ATTEND = 16, 12, 8
#: Labelled documents that training takes at most: with some category, with none; and their characters together.
MAX_POSITIVE, MAX_NEGATIVE, MAX_CHARS = 1500, 5000, 8_000_000
#: One labelled document in so many is held out.
HOLD = 6
#: Letters of a token at most.
PIECE = 12
#: Labelled documents with a word or character sequence from which it has a vector of its own.
MIN_DOCS = 3
#: Share of input values dropped in training, weight decay, and what the rows of the two tables move less than the rest.
DROP, DECAY, TABLE_RATE = 0.15, 0.3, 0.4
#: Windows whose logit is more than this below their document's best in every category have next to no gradient.
MARGIN = 2.0
#: Steps into which scores are binned.
BINS = 100

_TOKEN = re.compile(
    r"[a-z]+(?:'[a-z]+)?|[0-9]+|[ぁ-ゖ]+|[ァ-ヺー]+|[㐀-鿿々]+|[ऀ-ॿ]+|[؀-ۿ]+|[฀-๿]{1,6}|[^\W\d_]+|[「」『』\"“”«»„()!?]")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_]([.\-_*・·~ ])(?:[^\W\d_]\1){2,}[^\W\d_](?![^\W_])")
_INSIDE = re.compile(r"(?<=[ぁ-ヺー㐀-鿿])[.・·*_\-~|](?=[ぁ-ゖ])")
_MARKS = re.compile(r"[.\-_*・·~ ]")
_RUN = re.compile(r"(.)\1{2,}")
#: Runs of characters that NFKC may change or join to the one before them, with that one.
_UNPLAIN = re.compile(r"[\s\S]?[^\x00-\x7fÀ-ÿぁ-んァ-ヺー・一-鿿、。「」『』]+")


def _normal(text: str) -> str:
    """NFKC of a text, most of whose characters usually need none."""
    return _UNPLAIN.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)


def tokens(text: str) -> list[str]:
    """Words, runs of one script, and quotation and exclamation marks; spaced-out and stretched spellings are closed up.

    Longer ones than PIECE letters (unspaced writing) come in pieces that overlap by a letter, so that no character pair is lost.
    """
    t = _normal(text).lower()
    t = _SPACED.sub(lambda m: _MARKS.sub("", m[0]), t)
    t = _INSIDE.sub("", t)
    out = _TOKEN.findall(_RUN.sub(r"\1", t))
    if max(map(len, out), default=0) > PIECE:
        out = [x for w in out for x in ([w] if len(w) <= PIECE or w.isdigit() else [w[i : i + PIECE] for i in range(0, len(w) - 1, PIECE - 1)])]
    return out


def grams(token: str) -> list[str]:
    """Character pairs and triples of a token between its bounds."""
    t = f"<{token}>"
    return [t[i : i + n] for n in (2, 3) for i in range(len(t) - n + 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Model:
    """Vocabulary, parameters by name, the forward pass, and the backward pass for training.

    Row 0 of the word and the character table is that of everything unknown and stays nought.
    """

    def __init__(self, words: Iterable[str] = (), pairs: Iterable[str] = (), seed: int = 7):
        r = np.random.default_rng(seed)
        h, d = HIDDEN, DIM
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.words = {w: i for i, w in enumerate(words, 1)}
        self.pairs = {w: i for i, w in enumerate(pairs, 1)}
        self.p = {
            "word": (r.standard_normal((len(self.words) + 1, d)) * 0.05).astype(np.float32),
            "pair": (r.standard_normal((len(self.pairs) + 1, d)) * 0.05).astype(np.float32),
            "ba": np.zeros(ATTEND, np.float32), "va": init(ATTEND, 3), "wa": init(2 * h, ATTEND),
            "wo": init(2 * h, 3), "bo": np.full(3, -2, np.float32),
        }
        for k in ("word", "pair"):
            self.p[k][0] = 0
        for k in "fb":
            self.p |= {f"w{k}": init(d, 3 * h), f"u{k}": init(h, 3 * h), f"b{k}": np.zeros(3 * h, np.float32)}

    def features(self, token: str) -> tuple[int, list[int]]:
        """Rows of the word table and of the character table; digits all look alike."""
        if token.isdigit():
            token = "0" * min(len(token), 4)
        get = self.pairs.get
        return self.words.get(token, 0), [get(g, 0) for g in grams(token)]

    def embed(self, feats: list[tuple[int, list[int]]]) -> np.ndarray:
        """Input vectors of tokens."""
        if not feats:
            return np.zeros((0, DIM), np.float32)
        n = np.array([len(x) for _, x in feats])
        flat = np.concatenate([x for _, x in feats]).astype(np.int64)
        pairs = np.add.reduceat(self.p["pair"][flat], np.cumsum(n) - n, axis=0) / n[:, None]
        return self.p["word"][[w for w, _ in feats]] + pairs

    def embed_words(self, words: list[str]) -> np.ndarray:
        """embed() of the features of words, none empty, with the character sequences of all looked up at once."""
        words = ["0" * min(len(w), 4) if w.isdigit() else w for w in words]
        size = np.array([len(w) + 2 for w in words])
        codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32).astype(np.int64)
        end = np.cumsum(size)
        out = np.zeros((len(words), DIM), np.float32)
        for n, (known, rows) in self._sequences().items():
            key = codes[: len(codes) - n + 1].copy()
            for j in range(1, n):
                key = (key << 21) | codes[j : len(codes) - n + 1 + j]
            inside = np.ones(len(codes), bool)
            for j in range(n - 1):
                inside[end - 1 - j] = False
            key = key[inside[: len(key)]]
            at = np.searchsorted(known, key)
            row = np.where(known[np.minimum(at, len(known) - 1)] == key, rows[np.minimum(at, len(known) - 1)], 0)
            count = size - n + 1
            out += np.add.reduceat(self.p["pair"][row], np.cumsum(count) - count, axis=0)
        return self.p["word"][[self.words.get(w, 0) for w in words]] + out / (2 * size - 3)[:, None].astype(np.float32)

    def _sequences(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sorted codes of the known character pairs and triples, and their rows."""
        if not hasattr(self, "_known"):
            self._known = {}
            for n in (2, 3):
                pairs = [(sum(ord(c) << 21 * (n - 1 - j) for j, c in enumerate(g)), i) for g, i in self.pairs.items() if len(g) == n]
                code, row = np.array(sorted(pairs) or [(-1, 0)], np.int64).T
                self._known[n] = code, row
        return self._known

    def project(self, emb: np.ndarray) -> dict[str, np.ndarray]:
        """Gate inputs of token vectors for both directions; row 0 is padding, whose update gate keeps the state."""
        out = {}
        for k in "fb":
            pad = np.zeros((1, 3 * HIDDEN), np.float32)
            pad[0, :HIDDEN] = 30
            out[k] = np.concatenate([pad, emb @ self.p[f"w{k}"] + self.p[f"b{k}"]])
        return out

    def states(self, proj: dict[str, np.ndarray], ids: np.ndarray, keep: bool = False):
        """Hidden states (WINDOW, windows, 2 * HIDDEN) of windows of token rows; keep: what the backward pass needs."""
        h, n = HIDDEN, len(ids)
        out = np.empty((WINDOW, n, 2 * h), np.float32)
        kept = {"f": [], "b": []}
        for k in "fb":
            u, x, s = self.p[f"u{k}"], proj[k], np.zeros((n, h), np.float32)
            at = slice(0, h) if k == "f" else slice(h, 2 * h)
            for t in range(WINDOW) if k == "f" else range(WINDOW - 1, -1, -1):
                g = x[ids[:, t]]
                m = s @ u
                zr = g[:, : 2 * h] + m[:, : 2 * h]
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                c = np.tanh(g[:, 2 * h :] + zr[:, h:] * m[:, 2 * h :])
                if keep:
                    kept[k].append((t, s, zr, c, m[:, 2 * h :]))
                s = c + zr[:, :h] * (s - c)
                out[t, :, at] = s
        return (out, kept) if keep else out

    def attend(self, hs: np.ndarray, real: np.ndarray):
        """Attention weights (WINDOW, windows, 3), each category its own, what each state says of each category, and logits.

        Pooling states by the weights and reading the pooled state is the same as pooling what is read of the states.
        real: which places hold tokens.
        """
        a = np.tanh(hs @ self.p["wa"] + self.p["ba"])
        e = np.where(real.T[:, :, None], a @ self.p["va"], np.float32(-1e9))
        e = np.exp(e - e.max(0))
        w = e / e.sum(0)
        said = hs @ self.p["wo"]
        return a, w, said, (w * said).sum(0) + self.p["bo"]

    def gradients(self, feats: list[tuple[int, list[int]]], ids: np.ndarray, doc: np.ndarray, target: np.ndarray, mask: np.ndarray | None = None) -> dict:
        """Gradients of the log loss of documents, each the smooth maximum of its windows; mask: factors of the inputs."""
        p, h = self.p, HIDDEN
        emb = self.embed(feats)
        if mask is not None:
            emb = emb * mask
        proj = self.project(emb)
        hs, kept = self.states(proj, ids, keep=True)
        real = ids > 0
        a, w, said, logit = self.attend(hs, real)
        n_docs = len(target)
        top = np.full((n_docs, 3), -1e9, np.float32)
        np.maximum.at(top, doc, logit)
        e = np.exp(logit - top[doc])
        tot = np.zeros((n_docs, 3), np.float32)
        np.add.at(tot, doc, e)
        dz = (_sigmoid(top + np.log(tot)) - target) / n_docs
        dl = dz[doc] * e / tot[doc]
        wd = w * dl
        g = {"wo": np.tensordot(hs, wd, ((0, 1), (0, 1))), "bo": dl.sum(0)}
        dh = wd @ p["wo"].T
        dw = said * dl
        de = w * (dw - (w * dw).sum(0))
        g["va"] = np.tensordot(a, de, ((0, 1), (0, 1)))
        da = de @ p["va"].T * (1 - a * a)
        g["ba"] = da.sum((0, 1))
        g["wa"] = np.einsum("tnh,tna->ha", hs, da)
        dh += da @ p["wa"].T
        demb = np.zeros((len(emb) + 1, DIM), np.float32)
        for k in "fb":
            u, at = p[f"u{k}"], slice(0, h) if k == "f" else slice(h, 2 * h)
            du, dproj = np.zeros_like(u), np.zeros((len(emb) + 1, 3 * h), np.float32)
            ds = np.zeros((len(ids), h), np.float32)
            for t, s, zr, c, m in reversed(kept[k]):
                ds = ds + dh[t, :, at]
                z, r = zr[:, :h], zr[:, h:]
                dc = ds * (1 - z) * (1 - c * c)
                dg = np.concatenate([ds * (s - c) * z * (1 - z), dc * m * r * (1 - r), dc], 1)
                dm = np.concatenate([dg[:, : 2 * h], dc * r], 1)
                du += s.T @ dm
                ds = ds * z + dm @ u.T
                order = np.argsort(ids[:, t], kind="stable")
                tok, first = np.unique(ids[order, t], return_index=True)
                dproj[tok] += np.add.reduceat(dg[order], first, axis=0)
            dproj[0] = 0
            g[f"u{k}"] = du
            g[f"w{k}"] = emb.T @ dproj[1:]
            g[f"b{k}"] = dproj.sum(0)
            demb += dproj @ p[f"w{k}"].T
        demb = demb[1:] if mask is None else demb[1:] * mask
        n = np.array([len(x) for _, x in feats])
        g["word"] = _rows(np.array([x for x, _ in feats]), demb)
        g["pair"] = _rows(np.concatenate([x for _, x in feats]), np.repeat(demb / n[:, None], n, axis=0))
        return g


def _rows(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows and their summed gradients."""
    order = np.argsort(at, kind="stable")
    rows, first = np.unique(at[order], return_index=True)
    return rows, np.add.reduceat(x[order], first, axis=0)


class _Adam:
    """Adam steps with clipped gradients and weight decay; of the two tables only the rows a batch touches move."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.step = p, 0
        self.m1, self.m2 = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def __call__(self, g: dict, rate: float) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in (v[1] if isinstance(v, tuple) else v for v in g.values())))
        for k, x in g.items():
            at, x = x if isinstance(x, tuple) else (slice(None), x)
            x = x * np.float32(min(1, 2 / (norm + 1e-9)))
            m1 = self.m1[k][at] = np.float32(0.9) * self.m1[k][at] + np.float32(0.1) * x
            m2 = self.m2[k][at] = np.float32(0.99) * self.m2[k][at] + np.float32(0.01) * x * x
            up = (m1 / (1 - 0.9**self.step)) / (np.sqrt(m2 / (1 - 0.99**self.step)) + 1e-6)
            if k in ("word", "pair"):
                up *= TABLE_RATE
            if k[0] in "wup":
                self.p[k][at] *= np.float32(1 - DECAY * rate * (1 if k in ("word", "pair") else 0.2))
            self.p[k][at] -= (rate * up).astype(np.float32)


def _windows(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Token rows of all windows of the documents (0: padding) and each window's document; an empty document has one."""
    size = np.array([len(x) for x in rows], dtype=np.int64)
    flat = np.concatenate([*rows, np.zeros(WINDOW, dtype=np.int64)])
    n = np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE))
    doc = np.repeat(np.arange(len(rows)), n)
    begin = np.cumsum(size) - size
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE + begin[doc]
    at = start[:, None] + np.arange(WINDOW)
    return np.where(at < (begin + size)[doc][:, None], flat[np.minimum(at, len(flat) - 1)], 0), doc


def train(texts: list[str], target: np.ndarray, batch: int = 32, rate: float = 0.01, rounds: int = 2, steps: int = 80, seed: int = 7) -> Model:
    """A network fitted to documents with target[document, category] in 0..1; word vectors start from log odds.

    It starts from the documents with a category and as many random ones without, then goes over all documents in rounds,
    each on the windows that matter by the scores of the round before. As labels are sometimes wrong, the last round
    leaves out documents whose labels the network contradicts flatly. A round takes at least so many steps.
    """
    r = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    plain = lambda w: "0" * min(len(w), 4) if w.isdigit() else w
    rows = [np.array([vocab.setdefault(plain(t), len(vocab)) for t in tokens(x)], dtype=np.int64) for x in texts]
    has = np.array([len(x) > 0 for x in rows], dtype=bool)
    if not has.any():
        return Model(seed=seed)
    words = list(vocab)
    seen = np.zeros((len(vocab), 3), np.float32)
    count = np.zeros(len(vocab), np.float32)
    parts: Counter[str] = Counter()
    for d, x in enumerate(rows):
        u = np.unique(x)
        seen[u] += target[d]
        count[u] += 1
        parts.update({g for w in u for g in grams(words[w])})
    own = count >= MIN_DOCS
    model = Model((w for w, o in zip(words, own) if o), sorted(g for g, n in parts.items() if n >= MIN_DOCS), seed)
    base = target.mean(0)
    odds = np.log((seen + 2 * base + 1e-6) / (2 * base + 1e-6) * (2 - 2 * base + 1e-6) / (count[:, None] - seen + 2 - 2 * base + 1e-6))
    model.p["word"][1:, :3] = np.clip(odds[own], -2, 4) / 2
    every, owner = _windows([x + 1 for x in rows])
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    adam = _Adam(model.p)
    # Copies of documents without a category in which every word is unknown, or the head of one word and the tail of
    # another: so writing that no label covers, other languages above all, is no evidence.
    letters = np.array([False, *(w[0].isalpha() for w in words)])
    other = r.permutation(len(words))
    feats = [model.features(w) for w in words]
    feats += [model.features(w[: (len(w) + 1) // 2] + words[j][len(words[j]) // 2 :]) for w, j in zip(words, other)]
    feats.append((0, [0]))

    def disguised(ids: np.ndarray) -> np.ndarray:
        return np.where(letters[ids], ids + len(words) if r.random() < 0.5 else len(feats), ids)

    def run(docs: np.ndarray, kept: np.ndarray, epochs: int, rate: float, fade: bool = False) -> None:
        epochs = max(epochs, -(-steps * batch // max(len(docs), 1)))
        for epoch in range(epochs):
            order = r.permutation(docs)
            for i in range(0, len(order), batch):
                chosen = order[i : i + batch]
                w = [every[first[d] : first[d + 1]][kept[first[d] : first[d + 1]]] for d in chosen]
                clean = np.flatnonzero(target[chosen].max(1) == 0)[: batch // 4]
                w += [disguised(w[k]) for k in clean]
                chosen = np.concatenate([chosen, chosen[clean]])
                flat, back = np.unique(np.concatenate(w), return_inverse=True)
                if flat[0] != 0:
                    flat, back = np.concatenate([[0], flat]), back + 1
                mask = ((r.random((len(flat) - 1, DIM)) >= DROP) / (1 - DROP)).astype(np.float32)
                g = model.gradients([feats[j - 1] for j in flat[1:]], back.reshape(-1, WINDOW), np.repeat(np.arange(len(chosen)), list(map(len, w))), target[chosen], mask)
                for k in ("word", "pair"):
                    at, x = g[k]
                    g[k] = at[at > 0], x[at > 0]
                adam(g, rate * min(1, adam.step / 10 + 0.1) * (1 - (epoch + i / len(order)) / epochs if fade else 1))

    some, none = np.flatnonzero((target.max(1) > 0) & has), np.flatnonzero((target.max(1) == 0) & has)
    run(np.concatenate([some, r.permutation(none)[: max(len(some), 100)]]), np.ones(len(owner), bool), 2, rate)
    for k in range(rounds):
        top, logit = _pooled(model, feats, every, owner, len(texts))
        kept = (logit >= top[owner] - MARGIN).any(1)
        use = has
        if k == rounds - 1:
            use = has & ~(np.abs(_sigmoid(np.clip(top, -30, 30)) - target) > 0.95).any(1)
        run(np.flatnonzero(use), kept, 1, rate * 0.6 ** (k + 1), fade=k == rounds - 1)
    return model


def _pooled(model: Model, feats: list, ids: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Best logits of n documents, and the logits of all their windows."""
    proj = model.project(model.embed(feats))
    logit = np.concatenate([model.attend(model.states(proj, ids[i : i + 2048]), ids[i : i + 2048] > 0)[3] for i in range(0, len(ids), 2048)])
    top = np.full((n, 3), -1e9, np.float32)
    np.maximum.at(top, doc, logit)
    return top, logit


class _Known(dict):
    """Ids from 1 of the words met so far; fresh: those met since the list was last emptied."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self) + 1
        self.fresh.append(word)
        return i


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        table = {k: np.empty((1 << 15, 3 * HIDDEN), np.float32) for k in "fb"}
        for k, x in model.project(np.zeros((0, DIM), np.float32)).items():
            table[k][:1] = x
        for whole in batches:
            for b in pieces(whole, 1):
                if len(known) > 150_000:  # kept only to save work
                    known.clear()
                rows, had = [], len(known) + 1
                for t in b.column(1).to_pylist():
                    x = tokens(t) if t else []
                    rows.append(np.fromiter(map(known.__getitem__, x), np.int64, len(x)))
                if known.fresh:
                    for k, x in model.project(model.embed_words(known.fresh)).items():
                        if len(known) >= len(table[k]):
                            table[k] = np.concatenate([table[k], np.empty((len(known), 3 * HIDDEN), np.float32)])
                        table[k][had : len(known) + 1] = x[1:]
                    known.fresh.clear()
                ids, doc = _windows(rows)
                score = np.full((len(b), 3), -1e9, np.float32)
                for i in range(0, len(ids), 2048):
                    part = ids[i : i + 2048]
                    logit = model.attend(model.states(table, part), part > 0)[3]
                    np.maximum.at(score, doc[i : i + 2048], logit)
                score = _sigmoid(np.clip(score, -30, 30)).astype(np.float64)
                empty = np.array([not len(x) for x in rows], dtype=bool)
                score[empty] = 0
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, score.T)], names=["doc_id", *CATEGORIES])
    return run


class Fitted(NamedTuple):
    """A trained network, and the share of held-out documents of each category that score at least k / BINS."""

    model: Model
    caught: np.ndarray


def training_sample(
    documents: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE, max_chars: int = MAX_CHARS
) -> tuple[list[int], list[str], np.ndarray]:
    """doc_id, texts and targets of labelled documents: at most so many with some category, without, and characters in all.

    They are chosen by a hash of doc_id, as long as the characters of those before and their own are within the bound.
    A target is the share of raters that gave the category among them and those who found none: other categories don't
    speak against it. Ratings without label or document do not count.
    """
    per = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(
        F.count_distinct(F.when(F.col("label") == "none", F.coalesce("rater", F.lit("")))).alias("n"),
        *[F.count_distinct(F.when(F.col("label") == c, F.coalesce("rater", F.lit("")))).alias(c) for c in CATEGORIES])
    any_of = sum((F.col(c) for c in CATEGORIES[1:]), F.col(CATEGORIES[0])) > 0
    draw = F.xxhash64("doc_id")
    pick = per.where(any_of).orderBy(draw, "doc_id").limit(max_positive).unionByName(per.where(~any_of).orderBy(draw, "doc_id").limit(max_negative))
    sizes = documents.where("text is not null").groupBy("doc_id").agg(F.max(F.length("text")).alias("size")).join(F.broadcast(pick.select("doc_id")), "doc_id")
    total, ids = 0, []
    for x in sizes.orderBy(draw, "doc_id").collect():
        if total + x["size"] <= max_chars:
            total += x["size"]
            ids.append(x["doc_id"])
    chosen = documents.sparkSession.createDataFrame([(i,) for i in ids], "doc_id bigint")
    texts = documents.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))
    got = texts.join(pick, "doc_id").orderBy("doc_id").collect()
    return [x["doc_id"] for x in got], [x["text"] for x in got], np.array([[x[c] / max(x[c] + x["n"], 1) for c in CATEGORIES] for x in got], np.float32).reshape(-1, 3)


def fit(documents: DataFrame, labels: DataFrame, hold: int = HOLD, **sample: int) -> Fitted:
    """A network trained on labelled documents but for one in `hold`, and what it scores these.

    Without labels nothing is learnt and no score means anything, though all stay defined.
    """
    ids, texts, target = training_sample(documents, labels, **sample)
    out = np.array([zlib.crc32(str(i).encode()) % hold == 0 for i in ids], dtype=bool)
    model = train([t for t, o in zip(texts, out) if not o], target[~out])
    held = [tokens(t) for t, o in zip(texts, out) if o]
    vocab: dict[str, int] = {}
    every, owner = _windows([np.array([vocab.setdefault(w, len(vocab)) + 1 for w in x], dtype=np.int64) for x in held])
    score = np.zeros((0, 3))
    if held:
        score = _sigmoid(np.clip(_pooled(model, [model.features(w) for w in vocab], every, owner, len(held))[0], -30, 30))
    # Held-out documents of a category that score next to nothing count as wrongly labelled. Rates of a category lean on
    # those of all, and these on a few made-up documents, so that they are defined however few documents there are.
    step = np.arange(BINS + 1) / BINS
    has = (target[out] > 0.5) & (score >= 0.1)
    hits = np.stack([(score[has[:, c], c][:, None] >= step).sum(0) for c in range(3)])
    every_one = (hits.sum(0) + 5 * (1 - step**4)) / (has.sum() + 5)
    caught = (hits + 20 * every_one) / (has.sum(0)[:, None] + 20)
    return Fitted(model, caught)


def scores(documents: DataFrame, fitted: Fitted) -> DataFrame:
    """doc_id, abusive, hateful, sexual (0..1) of every document with a doc_id.

    Documents with null or empty text, or without any word, score 0. Repeated documents come out as often as they are given.
    """
    d = spread(documents.where("doc_id is not null").select("doc_id", "text"), "doc_id")
    return d.mapInArrow(_score(fitted.model), "doc_id bigint, " + ", ".join(f"{c} double" for c in CATEGORIES))


def _by_category(scored: DataFrame) -> DataFrame:
    pairs: list[Column] = [F.struct(F.lit(c).alias("category"), F.col(c).alias("score")) for c in CATEGORIES]
    return scored.select("doc_id", F.inline(F.array(*pairs)))


def cuts(scored: DataFrame, fitted: Fitted) -> dict[str, float]:
    """The score from which a document counts, for each category that with the best harmonic mean of recall and precision.

    Recall r(c) comes from held-out documents. Precision comes from the number n(c) of all documents that score at least
    c: if t documents have the category, t * r(c) of them are right, though no more than n(c). t is the median of
    n(c) / r(c) over the upper half of the scores (where r is at least 0.3), which holds few wrong documents. Labels of
    clean documents, some of them wrong, play no part.
    """
    rows = _by_category(scored).groupBy("category", F.floor(F.col("score") * BINS).cast("int").alias("bin")).count().collect()
    out = {}
    for c, caught in zip(CATEGORIES, fitted.caught):
        n = np.zeros(BINS + 1)
        for x in rows:
            if x["category"] == c:
                n[x["bin"]] += x["count"]
        n = n[::-1].cumsum()[::-1]
        step = np.arange(BINS + 1) * 2
        usable = (caught >= 0.3) & (step >= BINS)
        t = float(np.median(n[usable] / caught[usable])) if usable.any() else 0.0
        good = np.where(step * 2 >= BINS, np.minimum(n, t * caught) / np.maximum(n + t, 1e-9), -1)
        out[c] = float(good.argmax() / BINS) if t else 1.0
    return out


def source_rates(scored: DataFrame, documents: DataFrame, cut: dict[str, float]) -> DataFrame:
    """source, n_docs and for each category the share of documents scored at least its cut; spellings of a source are one.

    Documents without source are counted under null. Repeated documents count as often as they are given.
    """
    src = documents.select("doc_id", folded(F.col("source")).alias("source")).distinct()
    rate = lambda c: F.avg((F.col(c) >= cut[c]).cast("double")).alias(f"{c}_rate")
    return scored.join(src, "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), *map(rate, CATEGORIES))


def found(scored: DataFrame, cut: dict[str, float]) -> DataFrame:
    """doc_id, category of every score of at least the category's cut."""
    at = F.create_map(*[F.lit(v) for c in CATEGORIES for v in (c, cut[c])])
    return _by_category(scored).where(F.col("score") >= at[F.col("category")]).select("doc_id", "category").distinct()
