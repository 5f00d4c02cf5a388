"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of two inputs: the embedding of its hash, and the mean of the embeddings of
its hashed character 3-grams (bytes, with marks for its begin and end). Windows of
:data:`WINDOW` words, :data:`STRIDE` apart, cover each whole text; in each, gated recurrent
units run forwards and backwards, attention weighs their states, and a linear layer gives the logit.
A text's score is the highest probability of its windows. A label holds for a whole
text, so training treats the windows as alternatives: a text is toxic when any window is.

Training is in numpy on the driver, on a bounded sample of labelled rows; scoring
runs over all rows in tasks with the weights (about 1 MB).

Rows: a null or empty text scores as one window without words. Without labels of both kinds, the
network stays untrained and scores the share of toxic labels (0.1 without any). Null ids are
scored like others and are never trained on; repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import FOLD, FOLDED_VALUES, SpanHasher, find_words, mix, text_slices

WINDOW, STRIDE = 40, 32
WORD_ROWS, CHAR_ROWS = 1 << 13, 1 << 14
DIM, HIDDEN, ATTENTION = 12, 8, 8
MIN_STEPS = 400
_BEGIN, _END = 1, 2


def init_weights(seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return r.normal(0, scale, shape).astype(np.float32)

    weights = {"word": normal(WORD_ROWS, DIM, scale=0.05), "char": normal(CHAR_ROWS, DIM, scale=0.5)}
    for side in ("f", "b"):
        weights[f"w_{side}"] = normal(DIM, 3 * HIDDEN, scale=0.5)
        weights[f"u_{side}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
        weights[f"c_{side}"] = np.zeros(3 * HIDDEN, np.float32)
    weights["attend"] = normal(2 * HIDDEN, ATTENTION, scale=0.3)
    weights["attend_c"] = np.zeros(ATTENTION, np.float32)
    weights["focus"] = normal(ATTENTION, scale=0.3)
    weights["out"] = normal(2 * HIDDEN, scale=0.3)
    weights["out_c"] = np.full(1, -3.0, np.float32)
    return weights


class Vocabulary:
    """Distinct words of a slice: rows of the word table and of the character table."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        unique, first, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        starts, ends = starts[first], ends[first]
        lengths = ends - starts + 2
        self.n = len(unique)
        self.word = (unique & np.uint64(WORD_ROWS - 1)).astype(np.int64)
        base = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        place = np.arange(total) - np.repeat(base, lengths)
        size = np.repeat(lengths, lengths)
        inner = np.clip(np.repeat(starts, lengths) + place - 1, 0, max(0, len(data) - 1))
        letters = FOLD[data[inner]] if len(data) else np.zeros(0, np.uint8)
        letters = np.where(place == 0, _BEGIN, np.where(place == size - 1, _END, letters)).astype(np.uint64)
        code = np.zeros(max(0, total - 2), np.uint64)
        for j in range(3):
            code = code * np.uint64(257) + letters[j : total - 2 + j]
        at = np.flatnonzero(place[: len(code)] + 3 <= size[: len(code)])
        self.char = (mix(code[at]) & np.uint64(CHAR_ROWS - 1)).astype(np.int64)
        # Every word has one, as its two marks count.
        self.char_n = lengths - 2
        self.char_of = np.repeat(np.arange(self.n), self.char_n)
        self.char_at = np.cumsum(self.char_n) - self.char_n

    def inputs(self, weights: dict[str, np.ndarray]) -> np.ndarray:
        """Input vector of each distinct word; every word has at least one character 3-gram."""
        if self.n == 0:
            return np.zeros((0, DIM), np.float32)
        chars = np.add.reduceat(weights["char"][self.char], self.char_at, axis=0) / self.char_n[:, None].astype(np.float32)
        return weights["word"][self.word] + chars


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word index of each place of each window (-1: none), and the text of each window.

    Every text has at least one window; windows start ``STRIDE`` words apart until they reach its end.
    """
    n_words = np.diff(first)
    n = 1 + np.maximum(0, -(-(n_words - WINDOW) // STRIDE))
    owner = np.repeat(np.arange(len(n_words)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    begin = first[:-1][owner] + step * STRIDE
    index = begin[None, :] + np.arange(WINDOW)[:, None]
    index[index >= first[1:][owner][None, :]] = -1
    return index, owner


def _recur(gates: np.ndarray, index: np.ndarray, u: np.ndarray, backwards: bool, keep: list | None = None) -> np.ndarray:
    """States over the windows. ``gates``: input part of update, reset and candidate per distinct word."""
    steps, n = index.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states = np.empty((steps, n, HIDDEN), np.float32)
    u_gates, u_cand = u[:, : 2 * HIDDEN], u[:, 2 * HIDDEN :]
    for t in range(steps - 1, -1, -1) if backwards else range(steps):
        x = gates[index[t]]
        zr = np.tanh(x[:, : 2 * HIDDEN] + h @ u_gates)  # half arguments: the weights hold the factor
        zr += 1
        zr *= 0.5
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        cand = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ u_cand)
        z = z * (index[t] >= 0)[:, None]
        before = h
        h = h + z * (cand - h)
        states[t] = h
        if keep is not None:
            keep.append((t, before, z, r, cand))
    return states


def forward(weights: dict[str, np.ndarray], inputs: np.ndarray, index: np.ndarray, cache: dict | None = None) -> np.ndarray:
    """Logit of each window."""
    states = []
    for side in ("f", "b"):
        # One more row stands for "no word"; index -1 finds it.
        gates = np.vstack([inputs @ weights[f"w_{side}"] + weights[f"c_{side}"], np.zeros((1, 3 * HIDDEN), np.float32)])
        keep = None if cache is None else cache.setdefault(f"keep_{side}", [])
        states.append(_recur(gates, index, weights[f"u_{side}"], side == "b", keep))
    both = np.concatenate(states, 2)
    hidden = np.tanh(both @ weights["attend"] + weights["attend_c"])
    score = hidden @ weights["focus"]
    score = np.where(index >= 0, score, np.float32(-30))
    score = np.exp(score - score.max(0))
    share = score / score.sum(0)
    pooled = np.einsum("tn,tnh->nh", share, both)
    if cache is not None:
        cache.update(both=both, hidden=hidden, share=share, pooled=pooled)
    return pooled @ weights["out"] + weights["out_c"][0]


def backward(weights: dict[str, np.ndarray], inputs: np.ndarray, index: np.ndarray, cache: dict, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the weights above the inputs, and of the inputs."""
    grads = {"out": cache["pooled"].T @ d_logit, "out_c": d_logit.sum(keepdims=True)}
    both, hidden, share = cache["both"], cache["hidden"], cache["share"]
    d_pooled = d_logit[:, None] * weights["out"][None, :]
    d_both = share[:, :, None] * d_pooled[None]
    d_share = np.einsum("tnh,nh->tn", both, d_pooled)
    d_score = share * (d_share - (share * d_share).sum(0))
    d_score = np.where(index >= 0, d_score, 0).astype(np.float32)
    grads["focus"] = np.einsum("tna,tn->a", hidden, d_score)
    d_pre = d_score[:, :, None] * weights["focus"] * (1 - hidden**2)
    grads["attend"] = np.einsum("tnh,tna->ha", both, d_pre, optimize=True)
    grads["attend_c"] = d_pre.sum((0, 1))
    d_both += d_pre @ weights["attend"].T
    d_inputs = np.zeros((len(inputs) + 1, DIM), np.float32)
    rows = np.where(index >= 0, index, len(inputs))
    for side, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
        u = weights[f"u_{side}"]
        d_u = np.zeros_like(u)
        d_h = np.zeros((index.shape[1], HIDDEN), np.float32)
        d_gates = np.zeros((len(inputs) + 1, 3 * HIDDEN), np.float32)
        for t, before, z, r, cand in reversed(cache[f"keep_{side}"]):
            d_h = d_h + d_both[t][:, half]
            d_z = d_h * (cand - before)
            d_cand = d_h * z * (1 - cand**2)
            d_before = d_h * (1 - z)
            d_rh = d_cand @ u[:, 2 * HIDDEN :].T
            d_before += d_rh * r
            # z is masked; z * (1 - z) is 0 where it is 0. The halves are those of the tanh form.
            d_zr = np.concatenate([d_z * z * (1 - z) * 2, d_rh * before * r * (1 - r) * 2], 1)
            d_before += d_zr @ u[:, : 2 * HIDDEN].T
            d_u[:, : 2 * HIDDEN] += before.T @ d_zr
            d_u[:, 2 * HIDDEN :] += (r * before).T @ d_cand
            add_rows(d_gates, rows[t], np.concatenate([d_zr, d_cand], 1))
            d_h = d_before
        grads[f"u_{side}"] = d_u
        grads[f"w_{side}"] = inputs.T @ d_gates[:-1]
        grads[f"c_{side}"] = d_gates[:-1].sum(0)
        d_inputs += d_gates @ weights[f"w_{side}"].T
    return grads, d_inputs[:-1]


def add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``into[rows] += values`` with repeated rows summed."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    into[rows[heads]] += np.add.reduceat(values[order], heads, axis=0)


def train(texts: list[str], toxic: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights fitted with Adam; the order of the batches follows from the seed."""
    weights = init_weights(seed)
    n_toxic = int(toxic.sum())
    if n_toxic == 0 or n_toxic == len(toxic):
        share = min(0.99, max(0.01, n_toxic / len(toxic))) if len(toxic) else 0.1
        weights["out"][:] = 0
        weights["out_c"][:] = np.log(share / (1 - share))
        return weights
    hasher, random = SpanHasher(), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step = 0
    per_epoch = -(-len(texts) // batch)
    epochs = max(epochs, -(-MIN_STEPS // per_epoch))  # small samples are gone through more often
    n_steps = epochs * per_epoch
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for begin in range(0, len(order), batch):
            chosen = order[begin : begin + batch]
            (_, _, data, offsets), *_ = text_slices(pa.array([texts[k] for k in chosen], pa.large_string()), 1 << 62)
            found = find_words(data, offsets)
            words = Vocabulary(data, found.starts, found.ends, hasher(data, found.starts, found.ends, FOLDED_VALUES))
            index, owner = windows(found.first)
            index = np.where(index >= 0, np.append(words.which, -1)[index], -1)
            inputs = words.inputs(weights)
            cache: dict = {}
            logit = np.clip(forward(weights, inputs, index, cache), -20, 20)
            p = 1 / (1 + np.exp(-logit))
            label = toxic[chosen]
            none = np.exp(np.bincount(owner, np.log1p(-p + 1e-7), minlength=len(chosen)))
            any_toxic = np.clip(1 - none, 1e-6, 1)
            d_logit = np.where(label[owner] == 1, -p * (none / any_toxic)[owner], p) / len(chosen)
            grads, d_inputs = backward(weights, inputs, index, cache, d_logit.astype(np.float32))
            grads["word"], grads["char"] = np.zeros_like(weights["word"]), np.zeros_like(weights["char"])
            add_rows(grads["word"], words.word, d_inputs)
            add_rows(grads["char"], words.char, (d_inputs / words.char_n[:, None])[words.char_of])
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            step += 1
            speed = rate * min(1.0, step / 20) * (1 - 0.9 * step / n_steps)
            for name, grad in grads.items():
                grad = grad * min(1.0, 5 / (norm + 1e-9))
                m, v = moments[name]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                weights[name] -= (speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return weights


def score_slice(weights: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher, block: int = 8192) -> np.ndarray:
    """Score of each text: the highest probability among all its windows."""
    found = find_words(data, offsets)
    words = Vocabulary(data, found.starts, found.ends, hasher(data, found.starts, found.ends, FOLDED_VALUES))
    inputs = words.inputs(weights)
    index, owner = windows(found.first)
    which = np.append(words.which, -1)
    best = np.full(len(offsets) - 1, -np.inf)
    for k in range(0, len(owner), block):
        logit = forward(weights, inputs, which[index[:, k : k + block]])
        np.maximum.at(best, owner[k : k + block], logit)
    return 1 / (1 + np.exp(-best))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, max_chars: int) -> tuple[list[str], np.ndarray]:
    """At most ``max_rows`` labelled texts of each kind, in the order of a hash of the id.

    Only texts up to ``max_chars`` characters are learnt from, since a label says less about where it
    lies in a longer one. Rows whose ``crc32(doc_id)`` leaves 2 modulo 4 are held out.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic is not null")
    usable = usable.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.length("text").between(1, max_chars))
    texts, marks = [], []
    for mark in (0, 1):
        chosen = usable.where((F.col("toxic") > 0) == F.lit(mark == 1)).select("doc_id")
        # The ids are a bounded table, so the texts are found by a broadcast join.
        ids = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * max_rows)
        found = rows.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_rows)
        got = [r["text"] for r in found.collect()]
        texts += got
        marks += [mark] * len(got)
    return texts, np.array(marks, np.int64)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    max_rows: int = 2000,
    max_chars: int = 3000,
    epochs: int = 8,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``.

    Fits on at most ``max_rows`` rows of each label of ``labels(doc_id, toxic)``.
    """
    weights = train(*training_rows(docs, labels, max_rows, max_chars), epochs=epochs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1), 2 << 20):
                value = score_slice(weights, data, offsets, hasher)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(value.astype(np.float64))], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
