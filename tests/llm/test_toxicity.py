import itertools
import random
import re

import numpy as np
import pytest

from proofmill.llm import toxicity as t


def test_marginals_equal_all_labelings():
    rng = np.random.default_rng(0)
    chain = t.Chain(np.zeros(1), rng.normal(size=(2, 2)), -0.7)
    sizes = [1, 7, 2, 5]
    scores = rng.normal(size=sum(sizes)) * 2
    first = np.zeros(len(scores), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    _, _, p = t.forward_backward(scores, first, chain)
    at = 0
    for n in sizes:
        s, total, on = scores[at : at + n], 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(chain.start * y[0] + sum(s[i] * y[i] for i in range(n)) + sum(chain.change[a, b] for a, b in itertools.pairwise(y)))
            total += w
            on += w * np.array(y)
        assert np.allclose(on / total, p[at : at + n])
        at += n


@pytest.mark.parametrize("n", [63, 64, 65, 1000])
def test_blocks_equal_one_by_one(n):
    rng = np.random.default_rng(n)
    n0, n1, d0, d1 = rng.random((4, n)) + 0.01
    x, want = 1.0, []
    for i in range(n):
        x = (n0[i] + n1[i] * x) / (d0[i] + d1[i] * x)
        want.append(x)
    assert np.allclose(t._ratios(n0, n1, d0, d1), want)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(5, 60))
        y = i % 3 == 0
        if y:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Nasty", "awfulstem" + rng.choice("abcdefghij") + str(rng.randint(0, 99))]))
        docs.append(" ".join(w))
        labels.append(int(y))
    return docs, labels


@pytest.fixture(scope="module")
def chain():
    docs, labels = corpus(600, 1)
    return t.fit([d.encode() for d in docs], labels)


def test_held_out_accuracy_and_spans(make, chain):
    docs, labels = corpus(200, 2)
    rows = make(list(enumerate(docs)), "doc_id long, text string")
    for r in t.score_toxicity(rows, chain).collect():
        assert (r["toxicity"]["score"] >= 0.5) == bool(labels[r["doc_id"]])
        for s in r["toxicity"]["spans"]:
            assert r["text"][s["start"] : s["end"]].lower().startswith(("nasty", "awfulstem"))
        assert bool(r["toxicity"]["spans"]) == bool(labels[r["doc_id"]])


def test_odd_rows(make, odd_docs, chain):
    rows = t.score_toxicity(odd_docs, chain).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["toxicity"]["score"] < 0.5 for r in rows)
    assert t.score_toxicity(odd_docs.limit(0), chain).count() == 0


def test_offsets_count_code_points(make, chain):
    text = "中文 é nasty nasty nasty word1"
    r = t.score_toxicity(make([(text, "x")], "text string, toxicity string"), chain).first()
    assert [text[s["start"] : s["end"]] for s in r["toxicity"]["spans"]] == ["nasty"] * 3


def test_training_rows_are_those_allowed(make):
    docs = make([(i, f"text {i}") for i in range(50)] + [(None, "x")], "doc_id long, text string")
    labels = make([(i, i % 2 if i % 7 else None) for i in range(50)] + [(None, 1)], "doc_id long, toxic int")
    texts, y = t.training_rows(docs, labels, "doc_id", "text", "toxic", ~t.held_out(), 8)
    held = {r["doc_id"] for r in docs.where(t.held_out()).collect()}
    ids = [int(x.split()[1]) for x in texts]
    assert ids and not held & set(ids) and all(i % 2 == k for i, k in zip(ids, y, strict=True)) and sum(y) <= 8
    assert len(set(ids)) == len(ids)


def test_one_class_gives_its_share(make):
    chain = t.fit([b"a b", b"c"], [0, 0])
    assert t.score_toxicity(make([("x",)], "text string"), chain).first()["toxicity"]["score"] == 0.0
    assert t.fit([], []).constant == 0.0


def test_rare_offending_words_are_marked():
    """20 offending words in 9 of 200 toxic documents each, among many words of no meaning."""
    rng = random.Random(5)
    docs = [rng.choices([f"word{i}x".encode() for i in range(3000)], k=40) for _ in range(600)]
    toxic = np.arange(600) % 3 == 0
    bad = [bytes([97 + i]) * 6 + b"ish" for i in range(20)]
    for i, word in enumerate(bad):
        for at in rng.sample(range(200), 9):
            docs[3 * at].append(word)
    sample, kinds = t.Sample.of(docs), list(dict.fromkeys(w for d in docs for w in d))
    marked = {kinds[i] for i in np.flatnonzero(t.word_labels(sample, toxic))}
    assert set(bad) <= marked and len(marked - set(bad)) <= 5


def test_no_word_is_marked_by_chance_alone():
    rng = random.Random(6)
    docs = [rng.choices([f"word{i}x".encode() for i in range(3000)], k=40) for _ in range(600)]
    assert t.word_labels(t.Sample.of(docs), np.arange(600) % 3 == 0).sum() == 0


def labelings(scores, chain):
    """(labels, weight) of every labelling of a short document."""
    for y in itertools.product((0, 1), repeat=len(scores)):
        yield y, np.exp(chain.start * y[0] + sum(s * v for s, v in zip(scores, y)) + sum(chain.change[a, b] for a, b in itertools.pairwise(y)))


def test_gradient_equals_differences_of_the_likelihood():
    rng = np.random.default_rng(4)
    words = [f"w{i}".encode() for i in range(5)]
    docs = [[words[i] for i in rng.integers(0, 5, n)] for n in (1, 4, 6, 0, 3, 1)]
    sample, toxic = t.Sample.of(docs), np.array([True, False, True, True, True, False])
    bad = np.array([i % 2 == 0 for i in range(sample.n_kinds)])
    chain = t.Chain(np.zeros(t.TABLE), rng.normal(size=(2, 2)), -0.4)
    chain.weights[np.unique(sample.places)] = rng.normal(size=len(np.unique(sample.places)))

    def likelihood(kind_scores, change):
        total, moved = 0.0, t.Chain(chain.weights, change, chain.start)
        for i, y in enumerate(toxic):
            ids = sample.ids[sample.begins[i] : sample.begins[i + 1]]
            if len(ids):
                weight = dict(labelings(kind_scores[ids], moved))
                total += np.log(weight[tuple(int(bad[k] and y) for k in ids)] / sum(weight.values()))
        return total

    scores, step = sample.scores(chain.weights), 1e-5
    pull, g2 = t.gradient(sample, bad, toxic, chain)
    for k in range(sample.n_kinds):
        d = np.eye(sample.n_kinds)[k] * step
        assert np.isclose(pull[k], (likelihood(scores + d, chain.change) - likelihood(scores - d, chain.change)) / (2 * step), atol=1e-6)
    for a, b in itertools.product((0, 1), repeat=2):
        d = np.zeros((2, 2))
        d[a, b] = step
        assert np.isclose(g2[a, b], (likelihood(scores, chain.change + d) - likelihood(scores, chain.change - d)) / (2 * step), atol=1e-6)


def test_document_score_recounted(make):
    """Scores and spans from marginals over all labelings of short documents, ties and repeated rows included."""
    rng = np.random.default_rng(9)
    chain = t.Chain(rng.normal(size=t.TABLE) * 1.5, rng.normal(size=(2, 2)), -0.5, doc=np.array([0.3, 0.8, 0.6]))
    texts = [" ".join(rng.choice(["red", "Green", "blue", "gr\u00fcn", "7up"], n)) for n in (1, 2, 5, 9)]
    texts += ["red, red; red!", "red, red; red!", "", None]
    rows = make([(i, x, 1.0, x) for i, x in enumerate(texts)], "doc_id long, text string, score double, Toxicity string")
    got = {r["doc_id"]: r["toxicity"] for r in t.score_toxicity(rows, chain).collect()}
    for i, text in enumerate(texts):
        words = [w.lower().encode() for w in re.findall("[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]
        p = np.zeros(len(words))
        if words:
            every = list(labelings([chain.word_score(w) for w in words], chain))
            p = sum(w * np.array(y) for y, w in every) / sum(w for _, w in every)
        expected, peak = p[p >= t.FLOOR].sum(), max(p, default=0.0)
        x = 0.3 + 0.8 * np.log(expected + 1e-3) + 0.6 * np.log(peak + 1e-3)
        assert np.isclose(got[i]["score"], 1 / (1 + np.exp(-x)))
        at = [m.span() for m in re.finditer("[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]
        assert [(s["start"], s["end"]) for s in got[i]["spans"]] == [at[k] for k in np.flatnonzero(p >= 0.5)]
    assert got[4] == got[5] and got[6] == got[7]
