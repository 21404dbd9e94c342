"""Operator 6: toxicity by non-negative positive-unlabelled learning.

The classifier is linear in the presence of hashed features: words, and the
beginnings of words. It learns from confirmed toxic texts and from unlabelled
ones with the risk estimator ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``:
among unlabelled texts a share ``prior`` is toxic, and the corrected negative
risk is kept from falling below zero, where it would only measure overfitting.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import words as w
from sigloom.llm.grouping import lists
from sigloom.llm.labelled import held_out, learning, thinned
from sigloom.llm.shared import released

#: Bytes of words: letters of ASCII and all of other scripts; what lies between is no word.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
STEMS = (4, 5, 6, 7, 8)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words and of words' first bytes, and the text of each; not yet distinct."""
    start, stop, first = w.words(data, at, ~LETTERS)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    found, of = [w.word_hashes(data, start, stop, fold=True)], [text]
    for n in STEMS:
        long = stop - start > n
        found.append(w.beginnings(data, start[long], n))
        of.append(text[long])
    return np.concatenate(found), np.concatenate(of)


@dataclasses.dataclass
class Linear:
    """Weights of some features, sorted by hash, and an intercept."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.feature & w.U(0xFFFF)).astype(np.int64)] = True

    def logits(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(at) - 1, self.bias)
        if not len(self.feature):
            return out
        found, text = features(data, at)
        some = self.maybe[(found & w.U(0xFFFF)).astype(np.int64)]
        found, text = found[some], text[some]
        place = np.minimum(np.searchsorted(self.feature, found), len(self.feature) - 1)
        hit = self.feature[place] == found
        pair = np.unique(text[hit] * len(self.feature) + place[hit])
        return out + np.bincount(pair // len(self.feature), self.weight[pair % len(self.feature)], len(out))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def risk(on_unlabelled: np.ndarray, on_positive: np.ndarray, prior: float) -> float:
    """The negative class's risk as unlabelled texts show it, less what toxic ones among them add to it."""
    soft = lambda s: -np.log(np.maximum(1 - s, 1e-12)).mean()
    return soft(on_unlabelled) - prior * soft(on_positive)


#: Texts whose features are looked up at once: few of them are chosen, so that all at once would cost many times what stays.
TEXTS = 200


def counted(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of all texts, sorted, and how many texts have each; one copy of all is made, sorted in place."""
    found = np.concatenate(texts)
    found.sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    at = np.flatnonzero(new)
    return found[at], np.diff(np.append(at, len(found)))


#: Least evidence (count times log of lift) for a feature; chance reaches it about once in a million features.
EVIDENCE = 15.0


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most: int = 4096, steps: int = 1500, rate: float = 0.05, decay: float = 1e-4) -> Linear:
    """Minimise the non-negative risk over the ``most`` most telling features; each text is its distinct hashes."""
    if not positive or not unlabelled:
        return Linear(np.zeros(0, np.uint64), np.zeros(0), -4.0)
    (p, p_n), (u, u_n) = counted(positive), counted(unlabelled)
    place = np.minimum(np.searchsorted(u, p), len(u) - 1)
    in_u = np.where(u[place] == p, u_n[place], 0)
    share_p, share_u = p_n / len(positive), (in_u + 1) / (len(unlabelled) + 2)
    gain = np.where(share_p > 3 * share_u, p_n * np.log(share_p / share_u), 0)
    best = np.argsort(-gain, kind="stable")[:most]
    chosen = np.sort(p[best[gain[best] >= EVIDENCE]])
    if not len(chosen):
        return Linear(np.zeros(0, np.uint64), np.zeros(0), -4.0)

    def rows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        of, at = [], []
        for k in range(0, len(texts), TEXTS):
            some = texts[k : k + TEXTS]
            found = np.concatenate(some)
            place = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
            hit = chosen[place] == found
            of.append(np.repeat(np.arange(k, k + len(some)), [len(x) for x in some])[hit])
            at.append(place[hit])
        return np.concatenate(of), np.concatenate(at)

    (p_of, p_at), (u_of, u_at) = rows(positive), rows(unlabelled)
    weight, bias = np.zeros(len(chosen)), -1.0
    moment, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        g_p = sigmoid(bias + np.bincount(p_of, weight[p_at], len(positive)))
        g_u = sigmoid(bias + np.bincount(u_of, weight[u_at], len(unlabelled)))
        if risk(g_u, g_p, prior) >= 0:
            d_p, d_u = prior * (g_p - 1) - prior * g_p, g_u
        else:  # climb back: only the corrected negative risk is changed, upwards
            d_p, d_u = prior * g_p, -g_u
        d_p, d_u = d_p / len(positive), d_u / len(unlabelled)
        slope = np.bincount(p_at, d_p[p_of], len(chosen)) + np.bincount(u_at, d_u[u_of], len(chosen)) + decay * weight
        slope = np.append(slope, d_p.sum() + d_u.sum())
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = rate * (1.02 - step / steps) * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return Linear(chosen, weight, float(bias))


def train(docs: DataFrame, labels: DataFrame, positives: int = 2000, unlabelled: int = 5000, prior: float | None = None) -> Linear:
    """Fit on about so many confirmed toxic texts and texts of any kind, twice as many at most, none of them held out.

    ``prior`` is the share of toxic texts; if not given, that among labelled ones. Labels of null doc_ids and null labels do
    not count, of several labels of one doc_id the largest does; rows that repeat are learnt from each, null texts as empty ones.
    Without toxic or unlabelled texts the score is the same for all. Other columns are ignored.
    """
    known = learning(labels, "toxic").cache()
    if prior is None:
        prior = float(np.clip(known.agg(F.avg("label")).first()[0] or 0.05, 0.005, 0.5))

    def distinct(batches):
        for b in batches:
            for i, j, data, at in w.blocks(b.column(0)):
                found, text = features(data, at)
                order = np.lexsort((found, text))
                found, text = found[order], text[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
                cut = np.searchsorted(text[new], np.arange(j - i + 1))
                yield pa.record_batch([pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found[new].view(np.int64)))], names=["found"])

    def sample(rows: DataFrame, most: int) -> list[np.ndarray]:
        values, at = lists(rows.select("text").mapInArrow(distinct, "found array<long>").limit(2 * most).toArrow()["found"])
        return [values[x:y].view(np.uint64) for x, y in zip(at, at[1:], strict=False)]

    # about ``positives`` ids at most: small enough to broadcast
    toxic = thinned(known.where("label = 1"), positives).select("doc_id")
    docs = docs.select("doc_id", "text")
    out = fit(sample(docs.join(F.broadcast(toxic), "doc_id", "left_semi"), positives), sample(thinned(docs.where(~held_out()), unlabelled), unlabelled), prior)
    known.unpersist()
    released(docs.sparkSession)
    return out


def score(docs: DataFrame, model: Linear, threshold: float = 0.5) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 where score >= threshold). Narrow: nothing is shuffled.

    A null or empty text has the intercept's score; repeated rows score alike; any
    other columns pass through, but for score and predicted, which are replaced. An empty table gives an empty one.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    text = names.index("text")

    def run(batches):
        for b in batches:
            s = [sigmoid(shared.value.logits(data, at)) for _, _, data, at in w.blocks(b.column(text))]
            s = np.concatenate(s) if s else np.zeros(0)
            yield pa.record_batch([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*(f"c{i}" for i in range(len(names))), "score", "predicted"])

    schema = docs.toDF(*(f"c{i}" for i in range(len(names)))).schema.add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(run, schema).toDF(*names, "score", "predicted")
