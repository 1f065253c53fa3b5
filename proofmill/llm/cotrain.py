"""Quality scores by co-training two views.

View 1 is the text (hashed words and the text's shape), view 2 the page's metadata (source, language, stated length); neither
sees the other's. Each view is a logistic classifier. In every round each view scores all unlabelled documents and
hands those it is surest of, per class in the proportion of the labels, to the other view's training set. At last each view is calibrated on labelled
rows kept out of all rounds, and a logistic combination of both calibrated views scores every document.

Training reads a bounded sample of labelled rows: ``SAMPLE`` per class, by hash of the id, of at most ``TRAIN_BYTES`` each; the ids are
chosen before any text is read. The unlabelled rows are not sampled: each round scores the whole table, and the ``HANDED`` rows a view is surest of
are a sorted limit over it; only their texts come to the driver. Scoring reads every whole text in one pass without a shuffle.

Defined results. Null texts count as empty, null metadata as a value of its own. Repeated rows get a row each. If one of the classes
has no training row, every score is the share of the good class. An empty table gives an empty result. Results come as a struct
column ``quality``, replacing one of that name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import folded_words, identified, sliced, stored, text_bytes, without
from proofmill.llm.toxicity import held_out
from proofmill.session import ship_code

SAMPLE, TRAIN_BYTES = 2000, 60_000
PLACES = 1 << 14
ROUNDS = 3
#: Rows that a view hands on in a round, about, and the least certainty.
HANDED, SURE = 200, 0.8
#: Order of rows that a view is equally sure of.
TIES = ["mark", "train_id", "file", "place"]
METADATA = ("source", "lang", "n_chars")
TYPE = "struct<score:double,text_view:double,metadata_view:double>"


def text_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and values: hashed words by damped frequency (unit length), and the shape of the text."""
    words = folded_words(data)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    shape = [
        1.0, np.log1p(len(words)) / 5, len(set(words)) / n, sum(map(len, words)) / n / 10, len(set(lines)) / max(1, len(lines)),
        np.log1p(len(lines)) / 5, sum(data.count(c) for c in b".,;:!?") / n, sum(data.count(b"%d" % d) for d in range(10)) / max(1, len(data)), data.count(b"|") / n,
    ]
    if words:
        places, counts = np.unique(np.fromiter((16 + zlib.crc32(w) % (PLACES - 16) for w in words), np.int64, len(words)), return_counts=True)
        values = np.log1p(counts)
        values /= np.sqrt(values @ values)
    else:
        places, values = np.empty(0, np.int64), np.empty(0)
    return np.concatenate([np.arange(len(shape)), places]), np.concatenate([np.array(shape), values])


def metadata_features(values: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of (source, language, length): one place per value, lengths in steps of half a power of two."""
    source, lang, size = values
    step = None if size is None else int(2 * np.log2(max(0, size) + 1))
    named = [f"source={source}", f"lang={lang}", f"size={step}", f"lang={lang} size={step}"]
    return np.array([0, *[16 + zlib.crc32(x.encode()) % (PLACES - 16) for x in named]]), np.ones(1 + len(named))


@dataclass
class Rows:
    """Sparse rows: places and values one after the other, and the row of each."""

    places: np.ndarray
    values: np.ndarray
    owner: np.ndarray
    n: int

    @classmethod
    def of(cls, features: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(p) for p, _ in features]
        empty = np.empty(0)
        return cls(
            np.concatenate([p for p, _ in features] or [empty.astype(np.int64)]), np.concatenate([v for _, v in features] or [empty]),
            np.repeat(np.arange(len(features)), sizes), len(features),
        )

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.places] * self.values, self.n)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_view(rows: Rows, y: np.ndarray, weight: np.ndarray, rounds: int = 120, penalty: float = 2e-4) -> np.ndarray:
    """Weighted logistic regression by AdaGrad steps; rows of weight 0 do not count."""
    w, heat = np.zeros(PLACES), np.full(PLACES, 1e-8)
    total = weight.sum()
    for _ in range(rounds):
        error = weight * (y - _sigmoid(rows.scores(w)))
        g = np.bincount(rows.places, error[rows.owner] * rows.values, PLACES) / total - penalty * w
        heat += g * g
        w += 0.3 * g / np.sqrt(heat)
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small penalty, for a handful of columns."""
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = _sigmoid(x @ beta)
        beta = beta + np.clip(np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.1 * np.eye(len(beta)), x.T @ (y - p) - 0.1 * beta), -2, 2)
    return beta


@dataclass
class Views:
    """Weights and calibration (offset, slope) of both views, their combination, or the constant score."""

    weights: tuple[np.ndarray, np.ndarray] | None = None
    calibration: tuple[np.ndarray, np.ndarray] | None = None
    both: np.ndarray | None = None
    constant: float = 0.0

    def scores(self, texts: Rows, metadata: Rows) -> np.ndarray:
        """Columns: combined, text view, metadata view."""
        if self.weights is None:
            return np.full((texts.n, 3), self.constant)
        logits = [c[0] + c[1] * r.scores(w) for r, w, c in zip((texts, metadata), self.weights, self.calibration, strict=True)]
        combined = np.stack([np.ones(texts.n), *logits], axis=1) @ self.both
        return _sigmoid(np.stack([combined, *logits], axis=1))


Example = tuple[bytes, tuple]  # text and metadata
Surest = Callable[[list[np.ndarray], float], list[list[tuple[Example, float]]]]


def fit_views(examples: list[Example], labels: list[int], surest: Surest, rounds: int = ROUNDS) -> Views:
    """Both views, fitted to the labelled examples and to what they hand each other. A quarter of the labelled rows only calibrates.

    ``surest(weights, prior)`` gives, for each view, the unlabelled examples that the other view is surest of, with their pseudo-labels;
    none comes to a view twice.
    """
    y = np.array(labels, float)
    calibrate = np.arange(len(y)) % 4 == 3
    if len(set(y[~calibrate])) < 2 or len(set(y[calibrate])) < 2:
        return Views(constant=float(y.mean()) if len(y) else 0.0)
    features = (text_features, metadata_features)
    rows = [[f(e[i]) for e, c in zip(examples, calibrate, strict=True) if not c] for i, f in enumerate(features)]
    target, weight = [list(y[~calibrate]) for _ in rows], [[1.0] * int((~calibrate).sum()) for _ in rows]
    prior = float(np.mean(target[0]))

    def fitted() -> list[np.ndarray]:
        return [fit_view(Rows.of(r), np.array(t), np.array(g)) for r, t, g in zip(rows, target, weight, strict=True)]

    weights = fitted()
    for _ in range(rounds):
        for i, handed in enumerate(surest(weights, prior)):
            for example, label in handed:
                rows[i].append(features[i](example[i]))
                target[i].append(label)
                weight[i].append(0.5)
        weights = fitted()
    kept = [e for e, c in zip(examples, calibrate, strict=True) if c]
    ones, calibration, logits = np.ones(len(kept)), [], []
    for i, w in enumerate(weights):
        raw = Rows.of([features[i](e[i]) for e in kept]).scores(w)
        c = fit_logistic(np.stack([ones, raw], axis=1), y[calibrate])
        calibration.append(c)
        logits.append(c[0] + c[1] * raw)
    both = fit_logistic(np.stack([ones, *logits], axis=1), y[calibrate])
    return Views(tuple(weights), tuple(calibration), both)


def co_train(texts: list[bytes], metadata: list[tuple], labels: list[int | None], rounds: int = ROUNDS, handed: int = HANDED) -> Views:
    """``fit_views`` of rows in memory; those labelled None are the unlabelled ones, of which equally sure ones come in their order."""
    every = list(zip(texts, metadata, strict=True))
    pool = [e for e, y in zip(every, labels, strict=True) if y is None]
    views = (Rows.of([text_features(t) for t, _ in pool]), Rows.of([metadata_features(m) for _, m in pool]))
    taken: list[set[int]] = [set(), set()]

    def surest(weights: list[np.ndarray], prior: float) -> list[list[tuple[Example, float]]]:
        chosen: list[dict[int, float]] = [{}, {}]
        for own, other in ((0, 1), (1, 0)):
            p = _sigmoid(views[own].scores(weights[own]))
            for label, n in shares(prior, handed):
                order = np.argsort(-p if label else p, kind="stable").tolist()
                sure = [i for i in order if (p[i] >= SURE if label else p[i] <= 1 - SURE) and i not in taken[other]]
                chosen[other] |= dict.fromkeys(sure[:n], label)
            taken[other] |= set(chosen[other])
        return [[(pool[i], label) for i, label in view.items()] for view in chosen]

    labelled = [(e, y) for e, y in zip(every, labels, strict=True) if y is not None]
    return fit_views([e for e, _ in labelled], [y for _, y in labelled], surest, rounds)


def shares(prior: float, handed: int) -> list[tuple[float, int]]:
    """(label, rows) that a view hands on in a round, in the proportion of the labels, at least one of each."""
    return [(1.0, max(1, int(handed * prior))), (0.0, max(1, int(handed * (1 - prior))))]


def _surest(rows: DataFrame, labelled: DataFrame, handed: int) -> Surest:
    """The choice of ``fit_views`` over a whole table (file, place, train_id, data, metadata): every round scores every row."""
    spark = rows.sparkSession
    taken: list[list[tuple[int, int]]] = [[], []]  # places of the rows that came to a view: at most rounds * handed, about

    def choose(weights: list[np.ndarray], prior: float) -> list[list[tuple[Example, float]]]:
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                texts = Rows.of([text_features(t) for t in batch.column("data").to_pylist()])
                told = zip(*(batch.column(c).to_pylist() for c in METADATA), strict=True)
                views = (texts, Rows.of([metadata_features(m) for m in told]))
                p = [pa.array(_sigmoid(v.scores(w))) for v, w in zip(views, shared.value, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.select(["file", "place", "train_id"]).columns, *p], names=["file", "place", "train_id", "p0", "p1"])

        id_type = rows.schema["train_id"].dataType.simpleString()
        scored = rows.mapInArrow(run, f"file long, place long, train_id {id_type}, p0 double, p1 double")
        scored = scored.join(labelled, "train_id", "left_anti").withColumn("mark", F.xxhash64("train_id"))
        scored = stored(scored, "co-training")
        chosen: list[dict[tuple[int, int], float]] = [{}, {}]
        for own, other in ((0, 1), (1, 0)):
            p, gone = F.col(f"p{own}"), spark.createDataFrame(taken[other], "file long, place long")
            free = scored.join(F.broadcast(gone), ["file", "place"], "left_anti")
            for label, n in shares(prior, handed):
                sure = free.where(p >= SURE).orderBy(F.desc(f"p{own}"), *TIES) if label else free.where(p <= 1 - SURE).orderBy(p, *TIES)
                chosen[other] |= {(r["file"], r["place"]): label for r in sure.limit(n).collect()}
            taken[other] += chosen[other]
        wanted = spark.createDataFrame(list({*chosen[0], *chosen[1]}), "file long, place long")
        texts = rows.join(F.broadcast(wanted), ["file", "place"]).collect()  # at most 2 * handed rows
        found = {(r["file"], r["place"]): (bytes(r["data"]), tuple(r[c] for c in METADATA)) for r in texts}
        return [[(found[k], label) for k, label in view.items()] for view in chosen]

    return choose


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, handed: int = HANDED, rounds: int = ROUNDS) -> Views:
    """Views fitted to rows that are not held out."""
    ship_code(docs.sparkSession)
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("train_id"), F.col(label_col).alias("train_y"))
    usable = usable.withColumn("mark", F.xxhash64("train_id"))
    chosen = [usable.where(F.col("train_y") == y).distinct().orderBy(*TIES[:2]).limit(sample) for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * sample rows of two numbers
    source, file, place = identified(docs, "quality-rows")
    metadata = [F.col(c).cast("long" if c == "n_chars" else "string") if c in docs.columns else F.lit(None).cast("long" if c == "n_chars" else "string").alias(c) for c in METADATA]
    rows = source.where(~held_out(id_col)).select(F.col(file).alias("file"), F.col(place).alias("place"), F.col(id_col).alias("train_id"), text_bytes(text_col).alias("data"), *metadata)
    known = rows.join(ids.drop("mark"), "train_id").withColumn("mark", F.xxhash64("train_id")).where(F.octet_length("data") <= TRAIN_BYTES).orderBy(*TIES[:2], "train_y", "data").limit(2 * sample).collect()
    examples = [(bytes(r["data"]), tuple(r[c] for c in METADATA)) for r in known]
    labelled = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast(rows.schema["train_id"].dataType).alias("train_id")).distinct()
    return fit_views(examples, [r["train_y"] for r in known], _surest(rows, labelled, handed), rounds)


def score_quality(docs: DataFrame, views: Views, text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality``: the combined score and that of each calibrated view."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(views)

    def run(batches):
        for text, source, lang, size in sliced(batches):
            texts = Rows.of([text_features(t) for t in text.to_pylist()])
            metadata = Rows.of([metadata_features(m) for m in zip(source.to_pylist(), lang.to_pylist(), size.to_pylist(), strict=True)])
            s = shared.value.scores(texts, metadata)
            yield pa.StructArray.from_arrays([pa.array(s[:, i]) for i in range(3)], names=["score", "text_view", "metadata_view"])

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    score = F.arrow_udf(run, TYPE).asNondeterministic()
    metadata = [F.col(c).cast("long" if c == "n_chars" else "string") if c in docs.columns else F.lit(None).cast("long" if c == "n_chars" else "string") for c in METADATA]
    return without(docs, "quality").withColumn("quality", score(text_bytes(text_col), *metadata))
