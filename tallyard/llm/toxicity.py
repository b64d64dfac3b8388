"""Toxicity: a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

A word enters by a hashed word embedding and by the mean of its hashed character trigrams and the strongest of
them. Windows of ``WINDOW`` words, each overlapping the next by half, are read in both directions; attention over
the states and inputs gives one vector, a logistic unit the score. A text scores as its highest window does.
Only labels of training documents are learnt from; language, source and ids never enter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordNumbers, Words, mix, ranges, text_slices

WINDOW, STRIDE = 32, 16
#: Bound of the training sample: so many documents of either label, chosen by a hash of the id; all their windows take part.
SAMPLE = 1500
#: Bound of the sample's bytes for either label: the first texts by that hash that stay below it, and one at least.
SAMPLE_BYTES = 24 << 20
#: Windows that training looks at in one go.
CHUNK = 1 << 15
WORD_ROWS, CHAR_ROWS, DIM, HIDDEN = 1 << 16, 1 << 15, 4, 8
INPUT = 3 * DIM


class Text(Words):
    """Words are runs of ASCII letters and digits and of non-ASCII bytes, in lower case."""

    def __init__(self, column: pa.Array):
        super().__init__(column, lower=True, breaks=_BREAKS)


_BREAKS = np.ones(256, bool)
_BREAKS[128:] = False
for _a, _z in ((48, 58), (65, 91), (97, 123)):
    _BREAKS[_a:_z] = False


def distinct_words(text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code of each word; and of each distinct word its hash, its trigrams' rows and their numbers."""
    codes, one = WordNumbers().of(text.raw, text.starts, text.ends)
    distinct = text.hashes()[one]
    size = text.ends[one] - text.starts[one]
    # each word between two marks: _word_
    padded = np.full(int((size + 2).sum()), 95, np.uint64)
    head = np.concatenate([[0], np.cumsum(size + 2)[:-1]]) if len(size) else np.zeros(0, np.int64)
    padded[ranges(head + 1, size)] = text.raw[ranges(text.starts[one], size)]
    grams = mix(padded[:-2] | (padded[1:-1] << np.uint64(8)) | (padded[2:] << np.uint64(16))) if len(padded) > 2 else np.zeros(0, np.uint64)
    rows = (grams[ranges(head, size)] % np.uint64(CHAR_ROWS)).astype(np.int64)
    return codes, distinct, rows, size


def word_row(distinct: np.ndarray) -> np.ndarray:
    return (distinct % np.uint64(WORD_ROWS)).astype(np.int64)


@dataclass
class Corpus:
    """Coded words of a sample of texts: codes, numbers of words of each text; rows and trigrams of distinct words."""

    codes: np.ndarray
    counts: np.ndarray
    word_rows: np.ndarray
    gram_rows: np.ndarray
    sizes: np.ndarray


def read_corpus(column: pa.Array) -> Corpus:
    """Codes a sample slice by slice, so that only its words, not its bytes, are held as numbers at once."""
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    parts = []
    for b in text_slices(iter([batch])):
        text = Text(b.column("text"))
        parts.append((text.counts, *distinct_words(text)))
    if not parts:
        return Corpus(*(np.zeros(0, np.int64) for _ in range(5)))
    which, distinct = pd.factorize(np.concatenate([p[2] for p in parts]))
    one = np.empty(len(distinct), np.int64)
    one[which[::-1]] = np.arange(len(which))[::-1]
    sizes = np.concatenate([p[4] for p in parts])
    head = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    grams = np.concatenate([p[3] for p in parts])[ranges(head[one], sizes[one])]
    shift = np.cumsum([0, *(len(p[2]) for p in parts)])
    codes = np.concatenate([which[p[1] + k] for p, k in zip(parts, shift, strict=False)])
    return Corpus(codes, np.concatenate([p[0] for p in parts]), word_row(distinct), grams, sizes[one])


def log_odds(corpus: Corpus, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log odds of the label given each row of the word and the trigram table, from documents that hold it."""
    out = []
    head = np.concatenate([[0], np.cumsum(corpus.sizes)[:-1]])
    ends = np.cumsum(corpus.counts)
    for size, grams in ((WORD_ROWS, False), (CHAR_ROWS, True)):
        n = np.zeros((2, size), np.int64)
        for label, a, z in zip(toxic.tolist(), (ends - corpus.counts).tolist(), ends.tolist(), strict=True):
            words = np.unique(corpus.codes[a:z])
            rows = corpus.gram_rows[ranges(head[words], corpus.sizes[words])] if grams else corpus.word_rows[words]
            n[label, np.unique(rows)] += 1
        odds = np.log((n[1] + 0.5) / (toxic.sum() + 1)) - np.log((n[0] + 0.5) / ((1 - toxic).sum() + 1))
        out.append(np.where(n.sum(axis=0) > 1, odds, 0).astype(np.float32))
    return out[0], out[1]


def n_windows(counts: np.ndarray) -> np.ndarray:
    """Number of windows of each text; one without words for a text without any."""
    return np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)


def windows_at(index: np.ndarray, n: np.ndarray, counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and number of words of the windows with these places in the line of all texts' windows."""
    ends = np.cumsum(n)
    doc = np.searchsorted(ends, index, side="right")
    start = np.minimum((index - (ends - n)[doc]) * STRIDE, np.maximum(counts[doc] - WINDOW, 0))
    return doc, first[doc] + start, np.minimum(counts[doc] - start, WINDOW)


def windows_of(counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and number of words of every window."""
    n = n_windows(counts)
    return windows_at(np.arange(n.sum()), n, counts, first)


def highest(score: Callable[[np.ndarray, np.ndarray], np.ndarray], n: np.ndarray, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Place of each text's window of the highest score, the earliest of equal ones; all windows are scored, a chunk at a time."""
    top, best = np.full(len(n), -np.inf), np.cumsum(n) - n
    total = int(n.sum())
    for a in range(0, total, CHUNK):
        index = np.arange(a, min(a + CHUNK, total))
        doc, start, size = windows_at(index, n, counts, first)
        found = score(start, size)
        order = np.lexsort((-found, doc))
        docs, heads = np.unique(doc, return_index=True)
        at = order[heads]
        better = found[at] > top[docs]
        top[docs[better]], best[docs[better]] = found[at[better]], index[at[better]]
    return best


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and both passes. Shapes: inputs (steps, windows, INPUT), mask (steps, windows)."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        near = lambda *s: (rng.standard_normal(s) * 0.3 / np.sqrt(s[0])).astype(np.float32)
        self.p = {"word": (rng.standard_normal((WORD_ROWS, DIM)) * 0.05).astype(np.float32), "char": (rng.standard_normal((CHAR_ROWS, DIM)) * 0.05).astype(np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": near(INPUT, 3 * HIDDEN), f"U{d}": near(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        wide = 2 * HIDDEN + INPUT
        self.p |= {"A": near(wide, HIDDEN), "a": np.zeros(HIDDEN, np.float32), "v": near(HIDDEN), "w": near(wide), "bias": np.zeros(1, np.float32)}

    def features(self, word_rows: np.ndarray, gram_rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of distinct words: word embedding, mean and strongest (by first value) trigram; and that trigram's place."""
        char = self.p["char"][gram_rows]
        head = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
        if not len(sizes):
            return np.zeros((0, INPUT), np.float32), head
        mean = np.add.reduceat(char, head, axis=0) / sizes[:, None]
        top = np.maximum.reduceat(char[:, 0], head)
        hit = np.flatnonzero(char[:, 0] == np.repeat(top, sizes))
        owner = np.repeat(np.arange(len(sizes)), sizes)[hit]
        strongest = np.empty(len(sizes), np.int64)
        strongest[owner[::-1]] = hit[::-1]
        return np.concatenate([self.p["word"][word_rows], mean, char[strongest]], axis=1).astype(np.float32), strongest

    def _direction(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool, projected: np.ndarray | None = None) -> tuple[np.ndarray, list]:
        steps, n = mask.shape
        U, c = self.p[f"U{d}"], self.p[f"c{d}"]
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        tape: list = [None] * steps
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gx = projected[t] if projected is not None else x[t] @ self.p[f"W{d}"] + c
            gh = h @ U
            zr = _sigmoid(gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(gx[:, 2 * HIDDEN :] + r * gh[:, 2 * HIDDEN :])
            m = mask[t][:, None]
            after = np.where(m, (1 - z) * new + z * h, h)
            if keep:
                tape[t] = (h, z, r, new, gh[:, 2 * HIDDEN :], m)
            out[t] = h = after
        return out, tape

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False, projected: dict | None = None) -> tuple[np.ndarray, dict]:
        p = self.p
        hf, tf = self._direction("f", x, mask, keep, projected and projected["f"])
        hb, tb = self._direction("b", x, mask, keep, projected and projected["b"])
        states = np.concatenate([hf, hb, x], axis=2)
        u = np.tanh(states @ p["A"] + p["a"])
        s = np.where(mask, u @ p["v"], -1e9)
        e = np.exp(s - s.max(axis=0)) * mask
        alpha = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnd->nd", alpha, states)
        logit = pooled @ p["w"] + p["bias"]
        return logit, {"x": x, "mask": mask, "tf": tf, "tb": tb, "states": states, "u": u, "alpha": alpha, "pooled": pooled}

    def backward(self, tape: dict, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the dense parameters, and of the inputs."""
        p, x, states, u, alpha = self.p, tape["x"], tape["states"], tape["u"], tape["alpha"]
        g = {"w": tape["pooled"].T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["w"]
        d_states = alpha[:, :, None] * d_pooled
        d_alpha = np.einsum("nd,tnd->tn", d_pooled, states)
        d_s = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", d_s, u)
        d_u = d_s[:, :, None] * p["v"] * (1 - u * u)
        g["A"] = np.einsum("tnd,tnk->dk", states, d_u)
        g["a"] = d_u.sum(axis=(0, 1))
        d_states += d_u @ p["A"].T
        d_x = d_states[:, :, 2 * HIDDEN :].copy()
        steps = x.shape[0]
        for k, d in enumerate("fb"):
            W, U = p[f"W{d}"], p[f"U{d}"]
            gW, gU, gc = np.zeros_like(W), np.zeros_like(U), np.zeros(3 * HIDDEN, np.float32)
            d_h = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, z, r, new, gh_n, m = tape[f"t{d}"][t]
                d_h = d_h + d_states[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                d_on = np.where(m, d_h, 0)
                d_new = d_on * (1 - z) * (1 - new * new)
                d_z = d_on * (h - new) * z * (1 - z)
                d_r = d_new * gh_n * r * (1 - r)
                d_gx = np.concatenate([d_z, d_r, d_new], axis=1)
                d_gh = np.concatenate([d_z, d_r, d_new * r], axis=1)
                gW += x[t].T @ d_gx
                gU += h.T @ d_gh
                gc += d_gx.sum(axis=0)
                d_x[t] += d_gx @ W.T
                d_h = np.where(m, d_on * z, d_h) + d_gh @ U.T
            g |= {f"W{d}": gW, f"U{d}": gU, f"c{d}": gc}
        return g, d_x

    def score_windows(self, features: np.ndarray, codes: np.ndarray, start: np.ndarray, size: np.ndarray, chunk: int = 4096) -> np.ndarray:
        """Logits of windows over words codes[start:start + size]; inputs are projected once for each distinct word."""
        features = np.vstack([features, np.zeros((1, INPUT), np.float32)])
        gates = {d: features @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"}
        out = np.empty(len(start), np.float32)
        steps = np.arange(WINDOW)[:, None]
        for a in range(0, len(start), chunk):
            mask = steps < size[None, a : a + chunk]
            at = np.where(mask, start[None, a : a + chunk] + steps, -1)
            word = np.where(mask, codes[at] if len(codes) else -1, len(features) - 1)
            out[a : a + chunk] = self.forward(features[word], mask, projected={d: gates[d][word] for d in "fb"})[0]
        return out


def train(column: pa.Array, toxic: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 7) -> Network:
    """Fits the network to whole texts and their labels (0 or 1).

    First values of the embeddings start as log odds of the label given the word or trigram; then, epoch by epoch,
    each toxic text teaches by its highest window, each clean one by its highest and one more.
    """
    net, rng = Network(seed), np.random.default_rng(seed)
    corpus = read_corpus(column)
    codes, word_rows, gram_rows, sizes = corpus.codes, corpus.word_rows, corpus.gram_rows, corpus.sizes
    if not len(toxic) or not len(codes) or toxic.min() == toxic.max():
        net.p["bias"][:] = -3 if not len(toxic) or toxic.min() == 0 else 3
        net.p["w"][:] = 0
        return net
    net.p["word"][:, 0], net.p["char"][:, 0] = log_odds(corpus, toxic)
    first = np.concatenate([[0], np.cumsum(corpus.counts)[:-1]])
    n = n_windows(corpus.counts)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    steps = np.arange(WINDOW)[:, None]
    for epoch in range(epochs):
        features, strongest = net.features(word_rows, gram_rows, sizes)
        strength = np.append(features[:, 0] + 2 * features[:, 2 * DIM], 0)

        def by_words(start: np.ndarray, size: np.ndarray, strength: np.ndarray = strength) -> np.ndarray:
            at = np.minimum(start[:, None] + np.arange(WINDOW), len(codes) - 1)
            return strength[np.where(np.arange(WINDOW) < size[:, None], codes[at], len(strength) - 1)].max(axis=1)

        def by_network(start: np.ndarray, size: np.ndarray, features: np.ndarray = features) -> np.ndarray:
            return net.score_windows(features, codes, start, size, chunk=1024)

        best = highest(by_network if epoch else by_words, n, corpus.counts, first)
        other = np.cumsum(n) - n + rng.integers(0, n)
        clean = np.flatnonzero(toxic == 0)
        picked = np.unique(np.concatenate([best, other[clean]]))
        rng.shuffle(picked)
        for a in range(0, len(picked), batch):
            doc, start, size = windows_at(picked[a : a + batch], n, corpus.counts, first)
            mask = steps < size[None, :]
            word = np.where(mask, codes[np.where(mask, start[None, :] + steps, 0)], 0)
            used, local = np.unique(word, return_inverse=True)
            local = local.reshape(word.shape)
            grams = ranges(np.concatenate([[0], np.cumsum(sizes)[:-1]])[used], sizes[used])
            feats, strongest = net.features(word_rows[used], gram_rows[grams], sizes[used])
            logit, tape = net.forward(feats[local] * mask[:, :, None], mask, keep=True)
            y = toxic[doc]
            d_logit = ((_sigmoid(logit) - y) / len(doc)).astype(np.float32)
            g, d_x = net.backward(tape, d_logit)
            d_feat = np.zeros_like(feats)
            np.add.at(d_feat, local.ravel(), (d_x * mask[:, :, None]).reshape(-1, INPUT))
            g["word"], g["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
            np.add.at(g["word"], word_rows[used], d_feat[:, :DIM])
            np.add.at(g["char"], gram_rows[grams], np.repeat(d_feat[:, DIM : 2 * DIM] / sizes[used][:, None], sizes[used], axis=0))
            np.add.at(g["char"], gram_rows[grams][strongest], d_feat[:, 2 * DIM :])
            step += 1
            for k, v in g.items():
                m, s = moments[k]
                m *= 0.9
                m += 0.1 * v
                s *= 0.999
                s += 0.001 * v * v
                net.p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def score_column(net: Network, column: pa.Array) -> np.ndarray:
    """The score of each whole text: that of its highest window; an empty one's is that of an empty window."""
    return scores_and_counts(net, column)[0]


def scores_and_counts(net: Network, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The score of each whole text and its number of words."""
    text = Text(column)
    codes, distinct, gram_rows, sizes = distinct_words(text)
    features, _ = net.features(word_row(distinct), gram_rows, sizes)
    doc, start, size = windows_of(text.counts, text.first)
    logit = net.score_windows(features, codes, start, size)
    top = np.full(len(text.counts), -np.inf)
    np.maximum.at(top, doc, logit)
    return _sigmoid(top), text.counts


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """Trains on at most ``sample`` documents of either label, of those that aren't held out, chosen by a hash of the id.

    The sample's texts, which the driver takes in, are bounded in bytes too. An id that repeats counts once, with its
    smallest text.
    """
    usable = labels.where("toxic IN (0, 1)").where(~is_held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for label in (0, 1):
        part = usable.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    before = F.sum(size).over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", F.coalesce(before, F.lit(0))).where((F.col("before") == 0) | (F.col("before") + size <= sample_bytes))
    rows = rows.select("doc_id", "text", "toxic").toArrow().sort_by("doc_id")
    return train(rows["text"].combine_chunks(), np.array(rows["toxic"].to_pylist(), np.int64))


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text; null counts as empty; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(net.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.__new__(Network)
        model.p = shared.value
        for b in text_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score_column(model, b.column("text")), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score is at least 0.5) of every row of ``docs``.

    Null texts count as empty; whole texts of any length are scored; rows that repeat or lack an id are scored like any
    other; other columns are ignored; an empty table gives an empty result. Without usable labels nothing is toxic.
    """
    scored = score_documents(docs, fit(docs, labels))
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the rows whose own text isn't predicted toxic, whatever their ids; texts without words have nothing toxic and stay.

    Rows stay in the tasks that read them. Repeated rows fare alike; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels).p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.__new__(Network)
        model.p = shared.value
        for b in text_slices(batches):
            score, words = scores_and_counts(model, b.column("text"))
            yield b.filter(pa.array((score < 0.5) | (words == 0)))

    return docs.mapInArrow(run, docs.schema)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
