"""Phrase fingerprints against a plain parse with a set of strings."""

import hashlib
import random

import pytest

from proofmill.llm import phrase_fingerprint as pf

DOCS = "doc_id long, text string"


def plain_phrases(text):
    known, at = [], 0
    for end in range(1, len(text) + 1):
        if text[at:end] not in set(known):
            known.append(text[at:end])
            at = end
    return known


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (pf.lanes(pf.minima(plain_phrases(t))) for t in (text, edited, following))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), pf.likeness(a, b), pf.likeness(a, c)))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in pf.as_text(pf.fingerprint_pairs(frame)).collect())


def text(rng, n):
    return "".join(rng.choice("ab c\ndéß中😀") for _ in range(n))


def test_parse_and_roll_back():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 300):
        t = text(rng, n)
        for cut in {0, n // 3, n}:
            p = pf.Parse()
            front = p.phrases(t[:cut])
            p.mark()
            p.phrases(text(rng, 50))
            p.back()
            p.phrases(text(rng, 9))
            p.back()
            assert front + p.phrases(t[cut:]) == plain_phrases(t)


def test_equals_brute_force(make):
    rng = random.Random(2)
    rows = [(i * 7 - 20, text(rng, rng.choice([0, 1, 2, 3, 30, 400]))) for i in range(60)]
    assert found(make(rows, DOCS).repartition(3)) == brute(rows)
    assert found(make(rows[:1], DOCS)) == brute(rows[:1])
    assert found(make(rows[:2], DOCS)) == brute(rows[:2])


def test_odd_rows(make):
    long = "abcd efgh " * 40_000
    rows = [(1, None), (2, ""), (3, long), (4, "x"), (4, "x"), (None, "no id"), (5, " \n")]
    clash = make([(*r, 1, "t", 2, "e") for r in rows], DOCS + ", task int, edge string, tie long, fingerprint string")
    got = pf.as_text(pf.fingerprint_pairs(clash)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_chars"]) for r in got if r["doc_id"]) == sorted(
        (False, i, len(t or "")) for i, t in rows if i
    )
    none = next(r for r in got if r["doc_id"] is None)
    assert none["n_chars"] == 5 and none["edited_sha256"] == hashlib.sha256(b"no  \n").hexdigest()
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert {r["near_next"] for r in got if r["doc_id"] == 2} == {1.0}  # empty and empty
    assert {r["near_next"] for r in got if r["doc_id"] == 1} == {0.0}  # empty and not
    assert len({(r["fingerprint"], r["n_chars"]) for r in got if r["doc_id"] == 4}) == 1
    assert pf.fingerprint_pairs(make([], DOCS)).collect() == []


def test_likeness_follows_the_true_similarity(spark, data):
    texts = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect() if r["text"]]
    rng, errors = random.Random(3), []
    for t in rng.sample(texts, 60):
        other = t[: rng.randrange(len(t) + 1)] + rng.choice(texts)
        a, b = set(plain_phrases(t)), set(plain_phrases(other))
        errors.append(pf.likeness(pf.fingerprint(t), pf.fingerprint(other)) - len(a & b) / len(a | b))
    assert abs(sum(errors) / len(errors)) < 0.02
    assert max(map(abs, errors)) < 0.2


@pytest.mark.parametrize("same", ["", "a", "equal texts have equal fingerprints"])
def test_equal_texts(same):
    assert pf.fingerprint(same) == pf.fingerprint("".join(list(same)))
    assert pf.likeness(pf.fingerprint(same), pf.fingerprint(same)) == 1.0
