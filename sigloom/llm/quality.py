"""Operator 5: text quality by a byte-level convolutional network in numpy.

Each learned filter spans WIDTH bytes and is a table of what every byte adds at every
place. A chunk of two halves of HALF
bytes, overlapping the next by one half, keeps each filter's largest response;
the mean and the largest over all chunks of the whole text go through one hidden
layer to a single probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import words as w
from sigloom.llm.labelled import learning, thinned

WIDTH, FILTERS, HIDDEN, HALF = 5, 16, 16, 128
#: Steps of fitting at least, however few the texts.
STEPS = 500


def padded(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in halves of their own, and the number of each text's.

    WIDTH - 1 zeros stand before a text and after the last one, so that no filter reaches another text.
    """
    n = np.diff(at)
    halves = -(-(n + WIDTH - 1) // HALF)
    begin = (np.cumsum(halves) - halves) * HALF
    out = np.zeros(int(halves.sum()) * HALF + WIDTH - 1, np.uint8)
    out[np.arange(len(data)) + np.repeat(begin + WIDTH - 1 - at[:-1], n)] = data
    return out, halves


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "table": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)),
            "bias": np.zeros(FILTERS),
            "into": rng.normal(0, 0.4, (2 * FILTERS, HIDDEN)),
            "inner": np.zeros(HIDDEN),
            "out": rng.normal(0, 0.4, HIDDEN),
            "last": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def responses(self, b: np.ndarray, places: bool = False, step: int = 256):
        """Every filter's largest response in each half and, with ``places``, where it is."""
        n = len(b) // HALF
        out, where = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64) if places else None
        for i in range(0, n, step):
            j = min(n, i + step)
            cut = b[i * HALF : j * HALF + WIDTH - 1]
            z = np.take(self.p["table"][0], cut[: (j - i) * HALF], axis=0)
            for k in range(1, WIDTH):
                z += np.take(self.p["table"][k], cut[k : k + (j - i) * HALF], axis=0)
            z = z.reshape(j - i, HALF, FILTERS)
            out[i:j] = z.max(axis=1)
            if places:
                where[i:j] = z.argmax(axis=1) + np.arange(i, j)[:, None] * HALF
        return np.maximum(out + self.p["bias"], 0), where

    @staticmethod
    def chunks(h: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunks' maxima, the half that each is from, and the first chunk of each text."""
        begin = np.cumsum(halves) - halves
        count = np.maximum(halves - 1, 1)
        first = np.cumsum(count) - count
        left = np.arange(int(count.sum())) + np.repeat(begin - first, count)
        right = np.minimum(left + 1, np.repeat(begin + halves - 1, count))
        take = h[right] > h[left]
        return np.where(take, h[right], h[left]), np.where(take, right[:, None], left[:, None]), first

    def pooled(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        b, halves = padded(data, at)
        c, _, first = self.chunks(self.responses(b)[0], halves)
        count = np.maximum(halves - 1, 1)[:, None]
        return np.column_stack([np.add.reduceat(c, first, axis=0) / count, np.maximum.reduceat(c, first, axis=0)])

    def probability(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if len(at) < 2:
            return np.zeros(0)
        p = self.p
        x = np.tanh(self.pooled(data, at) @ p["into"] + p["inner"]) @ p["out"] + p["last"]
        return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))

    def slopes(self, texts: list[bytes], label: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the mean log loss by every parameter, through the places of the maxima."""
        p = self.p
        data = np.frombuffer(b"".join(texts), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        b, halves = padded(data, at)
        h, where = self.responses(b, places=True)
        c, half, first = self.chunks(h, halves)
        count = np.maximum(halves - 1, 1)
        mean, top = np.add.reduceat(c, first, axis=0) / count[:, None], np.maximum.reduceat(c, first, axis=0)
        x = np.column_stack([mean, top]).astype(np.float32)
        a = np.tanh(x @ p["into"] + p["inner"])
        y = 1 / (1 + np.exp(-np.clip(a @ p["out"] + p["last"], -30, 30)))
        d = (y - label).astype(np.float32) / len(texts)
        g = {"out": a.T @ d, "last": d.sum(keepdims=True)}
        da = d[:, None] * p["out"] * (1 - a * a)
        g["into"], g["inner"] = x.T @ da, da.sum(axis=0)
        dx = da @ p["into"].T
        of = np.repeat(np.arange(len(texts)), count)
        dc = (dx[:, :FILTERS] / count[:, None])[of]
        is_top = c == top[of]
        ties = np.add.reduceat(is_top.astype(np.int64), first, axis=0)
        dc = dc + is_top * (dx[:, FILTERS:] / np.maximum(ties, 1))[of]
        dc = np.where(c > 0, dc, 0)
        place = np.take_along_axis(where, half, axis=0)
        g["bias"] = dc.sum(axis=0)
        g["table"] = np.zeros_like(p["table"])
        column = np.broadcast_to(np.arange(FILTERS), place.shape)
        for k in range(WIDTH):
            np.add.at(g["table"][k], (b[place + k], column), dc)
        return g

    def fit(self, texts: list[bytes], label: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 1) -> Network:
        """Minimise the log loss by Adam."""
        rng = np.random.default_rng(seed)
        p = self.p
        moment = {k: np.zeros_like(v) for k, v in p.items()}
        square = {k: np.zeros_like(v) for k, v in p.items()}
        t, epochs = 0, max(epochs, STEPS * batch // max(1, len(texts)))
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                g = self.slopes([texts[k] for k in some], label[some])
                t += 1
                pace = rate * (0.5 * (1 + np.cos(np.pi * (epoch + i / len(order)) / epochs)) + 0.02)
                for k, v in g.items():
                    v = v + (1e-4 * p[k] if k in ("table", "into", "out") else 0)
                    moment[k] = 0.9 * moment[k] + 0.1 * v
                    square[k] = 0.99 * square[k] + 0.01 * v * v
                    p[k] -= (pace * moment[k] / (1 - 0.9**t) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self


def train(docs: DataFrame, labels: DataFrame, most: int = 3000) -> Network:
    """Fit on about ``most`` whole labelled texts, twice as many at most, none of them held out; half of each label where there are enough.

    Labels of null doc_ids and null labels do not count, of several labels of one doc_id the largest does; rows that repeat
    are learnt from each, null texts as empty ones. With texts of one label or none at all the score is the same for all. Other columns are ignored.
    """
    known = learning(labels, "quality")
    # about ``most`` ids: small enough to broadcast
    chosen = thinned(known.where("label = 0"), most // 2).unionByName(thinned(known.where("label = 1"), most - most // 2))

    rows = docs.join(F.broadcast(chosen), "doc_id").select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), "label").limit(2 * most).toArrow()
    texts, label = rows["text"].to_pylist(), rows["label"].to_numpy().astype(np.float32)
    order = sorted(range(len(texts)), key=lambda i: (texts[i], label[i]))  # the same model whatever the order of rows
    network = Network()
    if len(set(label.tolist())) < 2:
        network.p["out"][:], network.p["last"][:] = 0, 2.0 if len(label) == 0 or label[0] else -2.0
        return network
    network.fit([texts[i] for i in order], label[order])
    return network


def score(docs: DataFrame, network: Network, threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 where score >= threshold). Narrow: nothing is shuffled.

    A null text is an empty one, which is all padding and has a score as well;
    repeated rows score alike; any other columns pass through, but for score and
    predicted, which are replaced. An empty table gives an empty one.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(network)
    names = docs.columns
    text = names.index("text")

    def run(batches):
        for b in batches:
            s = [shared.value.probability(data, at) for _, _, data, at in w.blocks(b.column(text))]
            s = np.concatenate(s) if s else np.zeros(0)
            yield pa.record_batch([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*(f"c{i}" for i in range(len(names))), "score", "predicted"])

    schema = docs.toDF(*(f"c{i}" for i in range(len(names)))).schema.add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(run, schema).toDF(*names, "score", "predicted")
