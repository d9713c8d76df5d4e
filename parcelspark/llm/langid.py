"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.bpe import joined
from parcelspark.llm.common import slices, spread

#: Hidden units of each direction, and bytes that the network reads before its state starts anew.
HIDDEN, WINDOW = 6, 192
#: The network is fitted on one window of each of so many labelled documents, drawn by hash over
#: the whole table.
SAMPLE = 8000
STEPS, BATCH, RATE = 200, 192, 0.05
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
_PAD = 256


def held_out() -> Column:
    """Whether a document belongs to the fold that training never sees."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT,
                      F.lit(False))


def has_letter(col: str) -> Column:
    return F.coalesce(F.col(col).rlike(r"\p{L}"), F.lit(False))


@dataclass
class Network:
    """Weights of both directions (first axis) and of the output layer.

    Gates are, in this order, update, reset and candidate. ``inputs`` holds a byte's part of the
    gates; index 256 stands for places behind the end of a text. The logistic gates are kept as
    ``(1 + tanh) / 2`` with the halves in the weights.
    """

    labels: list[str]
    inputs: np.ndarray  # 2 x 257 x 3H
    gates: np.ndarray   # 2 x 2H x H
    cand: np.ndarray    # 2 x H x H
    out: np.ndarray     # C x 2H
    bias: np.ndarray    # C x 1

    @classmethod
    def random(cls, labels: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape):
            return rng.normal(0, 0.7 / np.sqrt(hidden), shape).astype(np.float32)

        inputs = draw(2, 257, 3 * hidden)
        inputs[:, :, :hidden] -= 0.5  # long memory to begin with
        return cls(labels, inputs, draw(2, 2 * hidden, hidden), draw(2, hidden, hidden),
                   draw(len(labels), 2 * hidden), np.zeros((len(labels), 1), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.cand, self.out, self.bias]

    def states(self, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
        """State of both directions at every place: ``T x 2H x B`` for codes ``T x B``.

        At padding the state stays zero, so a short text reads as it would alone.
        """
        steps, width = codes.shape
        hidden = self.cand.shape[1]
        h = np.zeros((2, hidden, width), self.inputs.dtype)
        x = np.empty((2, 3 * hidden, width), h.dtype)
        all_h = np.empty((steps, 2, hidden, width), h.dtype)
        padded = (codes == _PAD).any(axis=1)
        for t in range(steps):
            ends = codes[t], codes[steps - 1 - t]
            for way in (0, 1):
                np.copyto(x[way], self.inputs[way].take(ends[way], 0).T)
            g = np.matmul(self.gates, h)
            g += x[:, :2 * hidden]
            np.tanh(g, out=g)
            g += 1
            z, r = g[:, :hidden], g[:, hidden:]
            rh = r * h
            c = np.matmul(self.cand, rh)
            c += x[:, 2 * hidden:]
            np.tanh(c, out=c)
            new = c - h
            new *= z
            new *= 0.5
            new += h
            if padded[t] or padded[steps - 1 - t]:
                new *= (np.stack(ends) != _PAD)[:, None]
            if trace is not None:
                trace.append((ends, h, z, r, rh, c))
            h = new
            all_h[t, 0], all_h[steps - 1 - t, 1] = h[0], h[1]
        return all_h.reshape(steps, 2 * hidden, width)

    def probabilities(self, codes: np.ndarray, trace: list | None = None) -> tuple:
        """Class probabilities at every place, ``T x C x B``, and the states."""
        h = self.states(codes, trace)
        p = np.matmul(self.out, h)
        p += self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p, h

    def loss(self, codes: np.ndarray, target: np.ndarray) -> float:
        p, _ = self.probabilities(codes)
        real = codes != _PAD
        return -float(np.log(p[:, target, np.arange(len(target))])[real].mean())

    def gradients(self, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Backpropagation through time of the mean cross-entropy over all places."""
        trace: list = []
        d, h = self.probabilities(codes, trace)
        steps, width = codes.shape
        hidden = self.cand.shape[1]
        real = codes != _PAD
        d[:, target, np.arange(width)] -= 1
        d *= real[:, None] / d.dtype.type(max(1, int(real.sum())))
        d_out = np.einsum("tcb,thb->ch", d, h, optimize=True)
        d_bias = d.sum(axis=(0, 2))[:, None]
        d_h = np.matmul(self.out.T, d).reshape(steps, 2, hidden, width)
        d_inputs, d_gates, d_cand = map(np.zeros_like, (self.inputs, self.gates, self.cand))
        carry = np.zeros((2, hidden, width), d.dtype)
        back_gates, back_cand = self.gates.transpose(0, 2, 1), self.cand.transpose(0, 2, 1)
        for t in reversed(range(steps)):
            ends, old, z, r, rh, c = trace[t]
            dh = carry + np.stack([d_h[t, 0], d_h[steps - 1 - t, 1]])
            dh *= (np.stack(ends) != _PAD)[:, None]
            # z and r hold 1 + tanh; its derivative is z * (2 - z).
            dz = dh * (c - old) * 0.5 * z * (2 - z)
            dc = dh * 0.5 * z * (1 - c * c)
            d_rh = np.matmul(back_cand, dc)
            dr = d_rh * old * r * (2 - r)
            gates = np.concatenate([dz, dr], axis=1)
            d_cand += np.matmul(dc, rh.transpose(0, 2, 1))
            d_gates += np.matmul(gates, old.transpose(0, 2, 1))
            whole = np.concatenate([gates, dc], axis=1)
            for way in (0, 1):
                hot = np.zeros((257, width), d.dtype)
                hot[ends[way], np.arange(width)] = 1
                d_inputs[way] += hot @ whole[way].T
            carry = dh * (1 - 0.5 * z) + d_rh * r + np.matmul(back_gates, gates)
        return [d_inputs, d_gates, d_cand, d_out, d_bias]


def windows(data: np.ndarray, ends: np.ndarray, size: int = WINDOW) -> tuple:
    """Cut whole texts into windows: ``(codes size x n, text of each window, bytes in each)``."""
    lengths = np.diff(ends)
    n = -(-lengths // size)
    owner = np.repeat(np.arange(len(lengths)), n)
    index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = ends[:-1][owner] + index * size
    used = np.minimum(size, ends[1:][owner] - start)
    place = np.arange(size)[:, None]
    codes = np.append(data, np.zeros(size, np.uint8))[start + place].astype(np.int64)
    codes[place >= used] = _PAD
    return codes, owner, used


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS,
          batch: int = BATCH, rate: float = RATE, seed: int = 7) -> Network:
    """Fit a network on labelled windows with Adam; every place learns the document's label."""
    names = sorted(set(labels))
    net = Network.random(names, hidden, seed)
    y = np.array([names.index(x) for x in labels])
    ends = np.concatenate([[0], np.cumsum([min(len(t), WINDOW) for t in texts])])
    data = np.frombuffer(b"".join(t[:WINDOW] for t in texts), np.uint8)
    codes, owner, _ = windows(data, ends)
    y = y[owner]
    rng = np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        pick = rng.choice(len(y), min(batch, len(y)), replace=False)
        grads = net.gradients(codes[:, pick], y[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        lr = rate * min(1.0, step / 20) * (1 - step / (steps + 1)) ** 0.5
        for p, g, m, v in zip(net.parameters(), grads, mean, square):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (lr * (m / (1 - 0.9 ** step))
                  / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Train on labelled documents outside the held-out fold; None when there is none.

    At most ``sample`` documents are drawn, by a hash of their id; of each one a window, at a place
    that the hash decides, reaches the driver. Labels are texts, dealt by the hash like all else.
    """
    key = F.xxhash64(F.lit(11), "doc_id", "text")
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out())
    # Tasks hand on about twice the sample together, not each a whole one, however many there are.
    share = min(1.0, 2.0 * sample / max(labelled.count(), 1))
    drawn = F.pmod(F.xxhash64(F.lit(12), "doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    bytes_of = F.col("text").cast("binary")
    room = F.greatest(F.lit(1), F.length(bytes_of) - WINDOW + 1)
    rows = (labelled.filter(drawn & has_letter("text"))
            .select("lang", F.substring(bytes_of, (F.pmod(key, room) + 1).cast("int"),
                                        F.lit(WINDOW)).alias("window"), key.alias("key"))
            .orderBy("key", "lang", "window").limit(sample).collect())
    if not rows:
        return None
    return train([bytes(r["window"]) for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row of ``docs`` (doc_id, text).

    Every byte of every text gets class probabilities; their mean over the text is the document's.
    Long texts are read in windows, at whose borders the network's state starts anew. Null texts
    and texts without a letter are ``und`` with score 0, as is everything without a network.
    """
    known = docs.select("doc_id", held_out().alias("held_out"), has_letter("text").alias("letter"),
                        F.when(has_letter("text"), F.col("text")).otherwise("").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices([batch], "text", 1 << 20):
                data, ends = joined(part.column("text"))
                n = part.num_rows
                best, score = np.zeros(n, int), np.zeros(n)
                if model is not None and len(data):
                    codes, owner, used = windows(data, ends)
                    total = np.zeros((n, len(model.labels)))
                    width = max(1, (1 << 18) // WINDOW)
                    order = np.argsort(-used, kind="stable")
                    for at in range(0, len(owner), width):
                        pick = order[at:at + width]
                        p, _ = model.probabilities(codes[:used[pick[0]], pick])
                        if used[pick[-1]] < used[pick[0]]:
                            p *= (np.arange(len(p))[:, None] < used[pick])[:, None]
                        np.add.at(total, owner[pick], p.sum(axis=0, dtype=np.float64).T)
                    lengths = np.maximum(np.diff(ends), 1)
                    best, score = total.argmax(axis=1), total.max(axis=1) / lengths
                real = part.column("letter").to_numpy(zero_copy_only=False).astype(bool)
                real &= model is not None
                names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, real)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names),
                     pa.array(np.where(real, np.clip(score, 0, 1), 0.0))],
                    ["doc_id", "held_out", "lang_pred", "score"])

    return known.mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on the labels of ``docs`` (doc_id, text, lang) and predict every row.

    lang, source and doc_id are no inputs of a prediction; the id only decides the fold. Null ids
    are never held out and never sampled twice; repeated rows are predicted each. An empty table
    gives an empty result, a table without labels ``und`` throughout. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    return predict(spread(docs.drop("lang")), fit(docs, sample))
