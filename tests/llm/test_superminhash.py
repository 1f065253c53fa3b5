import random

import numpy as np
import pytest

from proofmill.llm import superminhash as s


def words(text):
    return "".join(c.lower() if c.isascii() else c for c in (text or "")).split()


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    smallest = {}
    for g, (doc, _) in zip(group, rows, strict=True):
        if doc is not None:
            smallest[g] = min(doc, smallest.get(g, doc))
    return sorted(((doc, len(x), None if doc is None else smallest[g]) for (doc, _), x, g in zip(rows, sets, group, strict=True)), key=repr)


def test_signature_is_the_definition():
    """Against each element's whole permutation, without early stopping."""
    rng = np.random.default_rng(1)
    places = 16
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 3, 40, 400)]
    owner = np.repeat(np.arange(4), [len(x) for x in sets])
    got = s.superminhash(np.concatenate(sets), owner, 4, places)
    for i, x in enumerate(sets):
        best = np.full(places, np.inf)
        for e in x:
            order = list(range(places))
            for j in range(places):
                one = np.array([e], np.uint64)
                r = float(s._mix(one + np.uint64((2 * j + 1) * int(s._STEP) % 2**64))[0] >> np.uint64(11)) * 2.0**-53
                k = j + int(s._mix(one + np.uint64((2 * j + 2) * int(s._STEP) % 2**64))[0] % np.uint64(places - j))
                order[j], order[k] = order[k], order[j]
                best[order[j]] = min(best[order[j]], r + j)
        assert np.array_equal(best, got[i])


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = base[:2700], base[300:]
    sig = s.superminhash(np.concatenate([a, b]), np.repeat([0, 1], 2700), 2, 512)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.06
    assert np.isinf(s.superminhash(np.empty(0, np.uint64), np.empty(0, np.int64), 1)).all()


def near_copies():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, n = [], 0
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.randint(3, 120))
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((n, " ".join(copy)))
            n += 1
    chain = rng.choices(vocabulary, k=200)  # each is close to the next only
    for i in range(12):
        rows.append((n, " ".join(chain[i * 8 : i * 8 + 100])))
        n += 1
    return rows


def test_groups_equal_brute_force(make):
    rows = [*near_copies(), (1000, None), (1001, ""), (1002, "  \n"), (1003, "A b"), (1004, "a B"), (3, "other words under an id that is there"), (None, "A  b")]
    got = s.near_duplicates(make(rows, "doc_id long, text string"), k=4)
    want = brute(rows, 4, 80)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr) == want
    assert any(c is not None and c < d for d, _, c in want if d is not None)


@pytest.mark.parametrize("tile", [512, 3])
def test_exact_rest_finds_what_leaders_miss(make, monkeypatch, tile):
    monkeypatch.setattr(s, "TILE_SETS", tile)
    rows = near_copies()
    got = s.near_duplicates(make(rows, "doc_id long, text string"), k=4, leaders=0)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr) == brute(rows, 4, 80)


def test_shared_counts_by_blocks(monkeypatch):
    monkeypatch.setattr(s, "COLUMNS", 7)
    rng = np.random.default_rng(4)
    a, b = ([np.unique(rng.integers(0, 50, n).astype(np.uint64)) for n in sizes] for sizes in ((1, 30, 80), (5, 60)))
    assert s.shared_counts(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def test_one_of_each_group_stays(make, odd_docs):
    kept = s.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, None, 5, 6, 7], key=repr)
    assert s.drop_near_duplicates(odd_docs.limit(0)).count() == 0


def test_texts_of_one_id_are_told_apart(make):
    rows = [(5, "one two three four five six"), (5, "quite another text under the same number"), (6, "one two three four five six"), (5, "one two three four five six")]
    kept = s.drop_near_duplicates(make(rows, "doc_id long, text string").coalesce(1))
    assert sorted(r["text"] for r in kept.collect()) == ["one two three four five six", "quite another text under the same number"]


@pytest.mark.parametrize("drop", [False, True])
def test_row_numbers_outlive_other_splits(make, spark, monkeypatch, tmp_path, drop):
    """Executors come after the first table is written: later scans are split otherwise."""
    rows = near_copies()
    make(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "docs"))
    docs, write, split = spark.read.parquet(str(tmp_path / "docs")), s.stored, "spark.sql.files.minPartitionNum"

    def stored(df, label):
        out = write(df, label)
        spark.conf.set(split, "64")
        return out

    monkeypatch.setattr(s, "stored", stored)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(split, "1")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        want = brute(rows, 4, 80)
        if drop:
            assert sorted(r["doc_id"] for r in s.drop_near_duplicates(docs, k=4).collect()) == [d for d, _, c in sorted(want) if d == c]
        else:
            assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in s.near_duplicates(docs, k=4).collect()) == sorted(want)
    finally:
        spark.conf.unset(split)
        spark.conf.set("spark.sql.files.openCostInBytes", before)
