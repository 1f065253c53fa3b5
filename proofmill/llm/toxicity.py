"""Toxicity with a linear-chain conditional random field over words.

Labels are of documents. Training makes word labels from them: in a toxic document a word is offending
if the word or one of its beginnings (3 to 7 bytes) is found far more often in toxic than in clean documents, at a
bounded rate of false discoveries; all other words are not. A two-state CRF (features: the word, its beginnings, its length; state changes) is fitted to these
sequences by its exact gradient. Forward-backward marginals give every word of every document a probability; the
sum (from ``FLOOR`` on) and maximum make the document's score through a logistic fit on labelled rows the CRF has not seen. Words with a marginal
of at least one half are the offending offsets.

Training reads a bounded sample: at most ``SAMPLE`` toxic and twice as many clean rows, by hash of the id, of at most ``TRAIN_BYTES`` each;
ids of the sample are chosen from the labels alone. Scoring reads every whole text: one pass,
no shuffle, words scored through a bounded cache, so a task holds one batch of texts.

Defined results. Null and empty texts are scored as a document without offending words. Rows without a label are scored
like others. Repeated rows get a row each. If one of the classes has no training row, every score is the share of the
toxic class. An empty table gives an empty result. Results come as a struct column ``toxicity``, replacing one of that name.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import folded_words, sliced, text_bytes, without
from proofmill.llm.pretokens import Known, claim
from proofmill.session import ship_code

SAMPLE = 1200
TRAIN_BYTES = 60_000
TABLE = 1 << 21
STARTS = range(3, 8)
#: A feature marks toxic documents if its share there is so many times its share in clean ones.
RATIO = 8
#: Share of the marking features that may be there by chance.
FALSE_RATE = 0.1
ROUNDS = 40
FLOOR = 0.3
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_BLOCK = 64
#: Words whose messages are held at a time while fitting.
_STEP = 200_000
TYPE = "struct<score:double,expected:double,spans:array<struct<start:int,end:int,p:double>>>"
_ARROW = pa.struct(
    [
        ("score", pa.float64()), ("expected", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))),
    ]
)


def word_features(word: bytes) -> list[int]:
    """Places of a word's features in the weight table; place 0 is the bias."""
    places = [0, 1 + min(len(word), 20), 32 + zlib.crc32(b"w:" + word) % (TABLE - 32)]
    places += [32 + zlib.crc32(b"p:" + word[:n]) % (TABLE - 32) for n in STARTS if n <= len(word)]
    return places


@dataclass
class Chain:
    """weights: of word features, for the offending state; change[i, j]: log potential of going from i to j; start: of beginning in 1."""

    weights: np.ndarray
    change: np.ndarray
    start: float
    doc: np.ndarray | None = None  # bias and weights of the document's logistic fit
    constant: float | None = None  # the score if there was nothing to learn from

    def word_score(self, word: bytes) -> float:
        return float(self.weights[word_features(word)].sum())


def _ratios(n0: np.ndarray, n1: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """x[t] = (n0 + n1 x[t-1]) / (d0 + d1 x[t-1]) along the whole array, with x[-1] = 1.

    Blocks run side by side: first each block's product of 2x2 matrices, then the value entering each block,
    then the values inside.
    """
    n = len(n0)
    if not n:
        return np.empty(0)
    blocks = -(-n // _BLOCK)
    pad = blocks * _BLOCK - n

    def cut(a: np.ndarray, fill: float) -> np.ndarray:
        return np.ascontiguousarray(np.concatenate([a, np.full(pad, fill)]).reshape(blocks, _BLOCK).T)

    n0, n1, d0, d1 = cut(n0, 0.0), cut(n1, 1.0), cut(d0, 1.0), cut(d1, 0.0)
    a, b, c, d = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)  # (a x + b) / (c x + d)
    for t in range(_BLOCK):
        a, b, c, d = n1[t] * a + n0[t] * c, n1[t] * b + n0[t] * d, d1[t] * a + d0[t] * c, d1[t] * b + d0[t] * d
        scale = 1.0 / np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a * scale, b * scale, c * scale, d * scale
    entering, x = np.empty(blocks), 1.0
    for i, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        entering[i] = x
        x = min(max((p * x + q) / max(r * x + s, 1e-300), 1e-30), 1e30)
    out, x = np.empty((_BLOCK, blocks)), entering
    for t in range(_BLOCK):
        x = np.clip((n0[t] + n1[t] * x) / (d0[t] + d1[t] * x), 1e-30, 1e30)
        out[t] = x
    return out.T.reshape(-1)[:n]


def forward_backward(scores: np.ndarray, first: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of forward and backward messages and the marginals of the offending state; ``first`` marks the first word of each document."""
    e = np.exp(np.clip(scores, -30, 30))
    A = np.exp(chain.change)
    forward = _ratios(
        np.where(first, e * np.exp(chain.start), e * A[0, 1]), np.where(first, 0.0, e * A[1, 1]),
        np.where(first, 1.0, A[0, 0]), np.where(first, 0.0, A[1, 0]),
    )
    last = np.append(first[1:], True)[::-1]  # backwards, the last word of a document comes first
    after = np.append(e[1:], 1.0)[::-1]
    backward = _ratios(
        np.where(last, 1.0, A[1, 0]), np.where(last, 0.0, A[1, 1] * after), np.where(last, 1.0, A[0, 0]), np.where(last, 0.0, A[0, 1] * after)
    )[::-1]
    odds = forward * backward
    return forward, backward, odds / (1.0 + odds)


@dataclass
class Sample:
    """Training documents as numbers: word kinds along all documents, where each document begins, and the kinds' features."""

    ids: np.ndarray
    begins: np.ndarray
    places: np.ndarray  # features of all kinds, one kind after the other
    kinds: np.ndarray  # the kind of each feature

    @classmethod
    def of(cls, docs: Iterable[list[bytes]]) -> Sample:
        known: dict[bytes, int] = {}
        ids, begins = array("i"), [0]
        for words in docs:
            ids.extend([known.setdefault(w, len(known)) for w in words])
            begins.append(len(ids))
        places, sizes = array("i"), array("i")
        for word in known:
            own = word_features(word)
            places.extend(own)
            sizes.append(len(own))
        kinds = np.repeat(np.arange(len(known), dtype=np.int32), np.frombuffer(sizes, np.int32))
        return cls(np.array(ids, np.int32), np.array(begins), np.array(places, np.int32), kinds)

    @property
    def n_kinds(self) -> int:
        return int(self.kinds[-1]) + 1 if len(self.kinds) else 0

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Score of each kind."""
        return np.bincount(self.kinds, weights[self.places], self.n_kinds)

    def parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Runs of whole documents of about ``_STEP`` words: their words, first-word marks, document numbers."""
        at, n = 0, len(self.begins) - 1
        while at < n:
            end = max(at + 1, int(np.searchsorted(self.begins, self.begins[at] + _STEP, "right")) - 1)
            words = slice(int(self.begins[at]), int(self.begins[end]))
            owner = np.repeat(np.arange(at, end), np.diff(self.begins[at : end + 1]))
            first = np.ones(len(owner), bool)
            first[1:] = owner[1:] != owner[:-1]
            yield words, first, owner
            at = end


def least_gain(gains: np.ndarray, most: np.ndarray, rate: float = FALSE_RATE) -> float:
    """The gain from which features count, so that about ``rate`` of those that do are there by chance (Benjamini and Hochberg;
    exp(-gain) bounds the chance of a gain). ``most``: the largest gain that each feature's rows allow; features too rare to pass in any case are no tests."""
    most = np.sort(most)
    tests = np.arange(1, len(most) + 1)
    enough = len(most) - np.searchsorted(most, np.log(tests / rate)) <= tests
    n = int(tests[enough.argmax()]) if enough.any() else 1
    gains = np.sort(gains)[::-1]
    passed = np.flatnonzero(gains >= np.log(n / rate / np.arange(1, len(gains) + 1)))
    return float(gains[passed[-1]]) if len(passed) else np.inf


def word_labels(sample: Sample, toxic: np.ndarray) -> np.ndarray:
    """Which word kinds the toxic documents of the sample are recognised by."""
    found = np.zeros((2, TABLE), np.int32)
    edges = np.searchsorted(sample.kinds, np.arange(sample.n_kinds + 1))
    for i, y in enumerate(toxic):
        own = np.unique(sample.ids[sample.begins[i] : sample.begins[i + 1]])
        if len(own):
            sizes = edges[own + 1] - edges[own]
            at = np.repeat(edges[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            found[int(y), np.unique(sample.places[at])] += 1
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    share = n1 / (n0 + n1)
    found[:, :32] = 0  # bias and lengths
    b, a = found.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = a * np.log(a / ((a + b) * share)) + np.where(b > 0, b * np.log(b / ((a + b) * (1 - share))), 0.0)
    toxic_more = (a > 0) & (a * n0 > RATIO * b * n1)
    sure = toxic_more & (np.where(toxic_more, gain, 0.0) >= least_gain(gain[toxic_more], (a + b)[found.any(axis=0)] * -np.log(share)))
    return np.bincount(sample.kinds, sure[sample.places], sample.n_kinds) > 0


def gradient(sample: Sample, bad: np.ndarray, toxic: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the log likelihood of the word labels: by the score of each word kind, and by the potentials of state changes."""
    kind_scores = sample.scores(chain.weights)
    A, pull, g2 = np.exp(chain.change), np.zeros(sample.n_kinds), np.zeros((2, 2))
    for words, first, owner in sample.parts():
        ids = sample.ids[words]
        scores, y = kind_scores[ids], bad[ids] & toxic[owner]
        forward, backward, p = forward_backward(scores, first, chain)
        pull += np.bincount(ids, y - p, sample.n_kinds)
        inner = ~first
        after, before = (np.exp(np.clip(scores, -30, 30)) * backward)[inner], np.roll(forward, 1)[inner]
        w = np.stack([np.full(len(before), A[0, 0]), A[0, 1] * after, before * A[1, 0], before * A[1, 1] * after])
        y0, y1 = np.roll(y, 1)[inner], y[inner]
        g2 += np.array([[np.sum(~y0 & ~y1), np.sum(~y0 & y1)], [np.sum(y0 & ~y1), np.sum(y0 & y1)]]) - (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2)
    return pull, g2


def fit_chain(sample: Sample, toxic: np.ndarray, rounds: int = ROUNDS, penalty: float = 1e-3) -> Chain:
    """Exact gradient of the conditional likelihood, AdaGrad steps, a small square penalty."""
    bad = word_labels(sample, toxic)
    chain = Chain(np.zeros(TABLE, np.float32), np.zeros((2, 2)), -3.0)
    chain.weights[0] = -3.0
    heat, heat2 = np.full(TABLE, 1e-6, np.float32), np.full((2, 2), 1e-6)
    n = max(1, len(sample.ids))
    for _ in range(rounds):
        pull, g2 = gradient(sample, bad, toxic, chain)
        g = (np.bincount(sample.places, pull[sample.kinds], TABLE) / n - penalty * chain.weights / n).astype(np.float32)
        heat += g * g
        chain.weights += 0.5 * g / np.sqrt(heat)
        g2 /= n
        g2[0, 0] = 0.0  # potentials count from here
        heat2 += g2 * g2
        chain.change = np.clip(chain.change + 0.1 * g2 / np.sqrt(heat2), -8, 8)
    return chain


def _doc_features(expected: np.ndarray, peak: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(peak)), np.log(expected + 1e-3), np.log(peak + 1e-3)], axis=1)


def _sums(p: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum and maximum of each document's marginals; those below ``FLOOR`` add nothing, or long calm texts would add up."""
    peak = np.zeros(n)
    np.maximum.at(peak, owner, p)
    return np.bincount(owner, np.where(p >= FLOOR, p, 0.0), n), peak


def fit(docs: list[bytes], toxic: list[int], rounds: int = ROUNDS) -> Chain:
    """The chain from two thirds of the rows, the document fit from the rest."""
    y = np.array(toxic, bool)
    if y.all() or not y.any():
        return Chain(np.zeros(TABLE), np.zeros((2, 2)), 0.0, constant=float(y.mean()) if len(y) else 0.0)
    rest = np.arange(len(docs)) % 3 == 2
    if len(set(y[rest])) < 2 or len(set(y[~rest])) < 2:
        train, held = np.arange(len(docs)), np.arange(len(docs))
    else:
        train, held = np.flatnonzero(~rest), np.flatnonzero(rest)
    chain = fit_chain(Sample.of(folded_words(docs[i]) for i in train), y[train], rounds)
    unseen = Sample.of(folded_words(docs[i]) for i in held)
    kind_scores, expected, peak = unseen.scores(chain.weights), np.zeros(len(held)), np.zeros(len(held))
    for words, first, owner in unseen.parts():
        e, k = _sums(forward_backward(kind_scores[unseen.ids[words]], first, chain)[2], owner, len(held))
        expected, peak = expected + e, np.maximum(peak, k)
    x, target = _doc_features(expected, peak), y[held].astype(float)
    beta = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps with a small penalty
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (q * (1 - q))) @ x + 0.05 * np.eye(len(beta)), x.T @ (target - q) - 0.05 * beta)
        beta = beta + np.clip(step, -2, 2)
    chain.doc = beta
    return chain


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, allowed, sample: int) -> tuple[list, list]:
    """At most ``sample`` toxic and twice as many clean labelled rows, chosen by hash of the id among the labels that ``allowed`` permits."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & allowed).select(F.col(id_col).alias("train_id"), F.col(label_col).alias("train_y"))
    order = [F.xxhash64("train_id"), F.col("train_id")]
    chosen = [usable.where(F.col("train_y") == y).distinct().orderBy(*order).limit(sample * (2 - y)) for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 3 * sample rows of two numbers
    rows = (
        docs.select(F.col(id_col).alias("train_id"), text_bytes(text_col).alias("data"))
        .join(ids, "train_id")
        .where(F.octet_length("data") <= TRAIN_BYTES)
        .orderBy(*order, "train_y", "data")
        .limit(3 * sample)
        .collect()
    )
    return [bytes(r["data"]) for r in rows], [r["train_y"] for r in rows]


def score_toxicity(docs: DataFrame, chain: Chain, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``name``: score, expected (offending words), spans (offsets in code points, marginal)."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        model = shared.value
        claim("toxicity")
        known = Known(model.word_score, 100_000)
        for batch in sliced(batches):
            texts = batch.to_pylist()
            words = [folded_words(t) for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            owner = np.repeat(np.arange(len(words)), sizes)
            total = int(sizes.sum())
            scores = np.fromiter((s for w in words for s in map(known.__getitem__, w)), float, total)
            first = np.ones(total, bool)
            first[1:] = owner[1:] != owner[:-1]
            _, _, p = forward_backward(scores, first, model)
            expected, peak = _sums(p, owner, len(words))
            if model.constant is not None:
                value = np.full(len(words), model.constant)
            else:
                value = 1 / (1 + np.exp(-np.clip(_doc_features(expected, peak) @ model.doc, -30, 30)))
            begins = np.concatenate([[0], np.cumsum(sizes)])
            out = []
            for i, t in enumerate(texts):
                spans = []
                if model.constant is None and peak[i] >= 0.5:
                    own = p[begins[i] : begins[i + 1]]
                    places = [m.span() for m in _WORD.finditer(t.decode())]
                    spans = [{"start": places[k][0], "end": places[k][1], "p": float(own[k])} for k in np.flatnonzero(own >= 0.5)]
                out.append({"score": float(value[i]), "expected": float(expected[i]), "spans": spans})
            yield pa.array(out, type=_ARROW)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    score = F.arrow_udf(run, TYPE).asNondeterministic()
    return without(docs, name).withColumn(name, score(text_bytes(text_col)))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Chain:
    """A chain fitted to labelled rows that are not held out."""
    return fit(*training_rows(docs, labels, id_col, text_col, label_col, ~held_out(id_col), sample))
