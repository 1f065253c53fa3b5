import random

import numpy as np
from pyspark.sql import functions as F

from proofmill.llm import cotrain as c


def corpus(n, seed):
    rng = random.Random(seed)
    texts, metadata, labels = [], [], []
    for i in range(n):
        good = rng.random() < 0.6
        vocabulary = range(0, 120) if good else range(80, 200)
        texts.append(" ".join(f"w{x}" for x in rng.choices(vocabulary, k=30)).encode())
        source = rng.choice(["a", "b"] if good == (rng.random() < 0.85) else ["c", "d"])
        metadata.append((source, "en", 100))
        labels.append(int(good))
    return texts, metadata, labels


def accuracy(views, texts, metadata, labels):
    s = views.scores(c.Rows.of([c.text_features(t) for t in texts]), c.Rows.of([c.metadata_features(m) for m in metadata]))
    return [float(((s[:, i] >= 0.5) == np.array(labels)).mean()) for i in range(3)]


def test_views_label_for_each_other():
    texts, metadata, labels = corpus(1200, 1)
    some = [y if i < 160 else None for i, y in enumerate(labels)]
    test = corpus(500, 2)
    alone = accuracy(c.co_train(texts, metadata, some, rounds=0), *test)
    together = accuracy(c.co_train(texts, metadata, some), *test)
    assert together[0] > 0.9 and together[0] >= alone[0] - 0.02
    assert together[1] > 0.85 and 0.75 < together[2] < 0.95


def test_views_see_their_own_inputs_only():
    views = c.co_train(*corpus(400, 3))
    rows, other = corpus(20, 4), corpus(20, 5)
    meta, meta2 = c.Rows.of([c.metadata_features(m) for m in rows[1]]), c.Rows.of([c.metadata_features(m) for m in other[1]])
    text = c.Rows.of([c.text_features(t) for t in rows[0]])
    assert np.allclose(views.scores(text, meta)[:, 1], views.scores(text, meta2)[:, 1])


def test_odd_rows_and_one_class(odd_docs):
    views = c.co_train(*corpus(300, 6))
    rows = c.score_quality(odd_docs, views).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["quality"]["score"] <= 1 for r in rows)
    assert c.score_quality(odd_docs.drop("source", "lang", "n_chars"), views).count() == len(rows)
    assert c.score_quality(odd_docs.limit(0), views).count() == 0
    assert c.score_quality(odd_docs, c.co_train([b"x", b"y"], [(None, None, None)] * 2, [1, 1])).first()["quality"]["score"] == 1.0


def test_training_reads_allowed_rows(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    assert c.train_quality(docs, labels, rounds=1) is not None


def test_equals_co_training_in_memory(make):
    """Rounds over a table, split in any way, against the same rounds over lists; ties, repeated rows and odd rows included."""
    texts, metadata, labels = corpus(700, 8)
    rows = [(i, t.decode(), *m) for i, (t, m) in enumerate(zip(texts, metadata))]
    rows += [(i + 1000, *r[1:]) for i, r in enumerate(rows[300:340])]  # equal certainty
    rows += [(3000, None, None, None, None), (3001, "", "a", None, -5)]
    docs = make(rows, "doc_id long, text string, source string, lang string, n_chars long")
    docs = docs.withColumns({n: F.lit(n) for n in ("file_mark", "mark", "train_id", "place", "quality")}).repartition(5)
    told = make([(i, y) for i, y in enumerate(labels) if i < 160] + [(200, None), (5000, 1)], "doc_id long, quality int")
    marks = {r["doc_id"]: (r["mark"], r["out"]) for r in docs.select("doc_id", F.xxhash64("doc_id").alias("mark"), c.held_out().alias("out")).collect()}
    ordered = sorted((marks[r[0]][0], r) for r in rows if not marks[r[0]][1])
    known = {i: labels[i] for i in range(160)}
    unlabelled = [r for _, r in ordered if r[0] not in known and r[0] != 200]
    labelled = [r for _, r in ordered if r[0] in known]
    every = labelled + unlabelled
    want = c.co_train([(r[1] or "").encode() for r in every], [r[2:] for r in every], [known.get(r[0]) for r in every], rounds=2, handed=60)
    got = c.train_quality(docs, told, handed=60, rounds=2)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip((*got.weights, *got.calibration, got.both), (*want.weights, *want.calibration, want.both), strict=True))
    alone = c.train_quality(docs, told, rounds=0)
    assert not np.allclose(alone.weights[0], got.weights[0])
    assert c.train_quality(docs.limit(0), told).constant == 0.0 and c.train_quality(docs, told.limit(0)).weights is None
